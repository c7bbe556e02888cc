"""Comparison of a query's rows with those of its SQL in DuckDB."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def compare(spark, folder: str, query, sql: str, tmp: str) -> None:
    df = query(spark, folder)
    df.write.mode("overwrite").parquet(tmp)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    con.execute(f"CREATE TABLE expected AS {sql}")
    con.execute(f"CREATE VIEW got AS SELECT * FROM '{tmp}/*.parquet'")
    names = [r[0] for r in con.execute("DESCRIBE expected").fetchall()]
    assert sorted(names) == sorted(df.columns)
    cols = ", ".join(f'"{c}"' for c in sorted(names))
    for a, b in (("expected", "got"), ("got", "expected")):
        odd = con.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b} LIMIT 3").fetchall()
        assert not odd, f"only in {a}: {odd}"
