import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents (doc_id, text, source) with the other columns of the table, and one named like a working column."""
    full = [(i, t, "en", s, len(t) if t is not None else None, "x") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA + ", score string")


def prose(seed: int, n: int, words: tuple[str, ...] = ("the", "of", "and", "house", "river", "stone", "green", "walks", "under", "light", "every", "morning")) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(words) + (str(r.randrange(40)) if r.random() < 0.3 else "") for _ in range(n))


ODD = [(None, "null id", "a"), (900, None, "a"), (901, "", None), (902, " \t\n", None), (903, " ", "a"), (904, "ação Ünïcode 😀 " * 3, "b"), (905, "long " * 60_000, "b"), (906, "same", "a"), (907, "same", "b"), (906, "same", "a")]
