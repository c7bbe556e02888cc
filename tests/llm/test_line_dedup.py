import time

from pyspark.sql import functions as F

from velatura.llm.line_dedup import boilerplate, line_dedup

from .helpers import ODD, prose, table


def corpus():
    rows = []
    for i in range(240):
        lines = [prose(i, 8), "  Subscribe now\t" if i % 2 else "Subscribe now", prose(i % 30, 6), "", f"on {i % 7} sites" if i % 12 < 7 else "x", f"site line {i % 12}"]
        rows.append((i, "\n".join(lines), f"s{i % 12}"))
    return rows


def brute(rows, least):
    sites = {}
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            if t is not None and line.strip(" \t\r"):
                sites.setdefault(line.strip(" \t\r"), set()).add(s)
    gone = {k for k, v in sites.items() if len(v) >= least}
    out = []
    for i, t, _ in rows:
        lines = t.split("\n") if t is not None else []
        left = [x for x in lines if x.strip(" \t\r") not in gone]
        out.append((i, None if t is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = corpus() + [r for r in ODD if r[0] != 906]
    for least in (2, 5, 8, 12):
        docs = table(spark, rows)
        out = line_dedup(docs, F.col("source"), min_sites=least)
        assert out.columns == [*docs.columns, "n_lines", "removed_lines"]
        assert sorted((tuple(r) for r in out.select("doc_id", "text", "n_lines", "removed_lines").collect()), key=str) == brute(rows, least)


def test_hot_line_and_margin(spark):
    rows = [(i, "everywhere\nown %d" % i, f"s{i % 40}") for i in range(400)]
    assert boilerplate(table(spark, rows), F.col("source"), min_sites=8).count() == 1
    assert boilerplate(table(spark, rows), F.col("source"), min_sites=41).count() == 0


def test_repeated_rows_clashing_columns_and_empty(spark):
    docs = table(spark, [(906, "same", "a")] * 3).withColumn("n_lines", F.lit("old"))
    out = line_dedup(docs, F.col("source")).collect()
    assert len(out) == 3 and {r["n_lines"] for r in out} == {1}
    assert line_dedup(table(spark, []), F.col("source")).count() == 0


def test_each_row_is_cleaned_by_its_own_text(spark):
    shared = [(100 + i, "boiler", f"s{i}") for i in range(9)]
    rows = [(1, "own A\nboiler\nend", "a"), (1, "precious line B\nsecond B\nboiler", "b"), (None, "boiler\nkept", "a"), (None, "kept too\nboiler", "b"), *shared]
    out = line_dedup(table(spark, rows).withColumn("_gone", F.lit(1)), F.col("source"), min_sites=8)
    assert sorted((tuple(r) for r in out.select("doc_id", "text", "n_lines", "removed_lines").collect()), key=str) == brute(rows, 8)
    assert "_gone" in out.columns


def test_text_of_very_many_boilerplate_lines(spark):
    long = "\n".join(f"line {k}" for k in range(100_000))
    began = time.time()
    out = line_dedup(table(spark, [(i, long + f"\nown {i}", f"s{i}") for i in range(9)]), F.col("source"), min_sites=8).collect()
    assert sorted(r["text"] for r in out) == sorted(f"own {i}" for i in range(9)) and time.time() - began < 120
