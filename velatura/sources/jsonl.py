"""JSON lines, whole texts and review dictionaries as DataFrames, and the sinks for them.

Lines are read as text and parsed here, so that bad ones are kept with a reason instead of being dropped: ``strict``
stops at them, the default sets them apart. Line numbers come from the places of lines in the blocks that tasks read.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import taxonomy as tax
from ..functions.rules import format_error

DOCUMENT = "text string, entities array<struct<type:string,value:string>>"


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$", "")


def lines(spark: SparkSession, path: str, through: bool = False) -> DataFrame:
    """(line_no, row_id, line): the lines of text files, numbered from 1 within each file, and from 0 over all lines that are not blank.

    With ``through`` lines are numbered on from file to file, in the order of their names, as if they were one file.

    Lines are counted within the blocks that tasks read, and blocks (one row each) are summed up in the order of files and offsets.
    """
    raw = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"))
    raw = raw.withColumn("_m", F.monotonically_increasing_id()).withColumn("_full", (_bare(F.col("line")) != "").cast("long"))
    blocks = raw.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_n"), F.sum("_full").alias("_rows"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    in_file, in_all = before(Window.orderBy("_f", "_b") if through else Window.partitionBy("_f").orderBy("_b")), before(Window.orderBy("_f", "_b"))
    blocks = blocks.select("_f", "_b", F.coalesce(F.sum("_n").over(in_file), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_rows").over(in_all), F.lit(0)).alias("_r0"))
    up_to = Window.partitionBy("_f", "_b").orderBy("_m").rowsBetween(Window.unboundedPreceding, 0)
    counted = raw.withColumn("_i", F.count(F.lit(1)).over(up_to)).withColumn("_r", F.sum("_full").over(up_to)).join(blocks, ["_f", "_b"])
    return counted.select((F.col("_n0") + F.col("_i")).cast("int").alias("line_no"), F.when(F.col("_full") == 1, F.col("_r0") + F.col("_r") - 1).alias("row_id"), "line")


def parsed(raw: DataFrame, schema: str = DOCUMENT, blank: str = "skip") -> DataFrame:
    """(line_no, row_id, line, <schema>, problem) of lines; blank ones are skipped or a problem, as ``blank`` says (skip or error)."""
    is_blank = _bare(F.col("line")) == ""
    record = F.from_json("line", schema, {"mode": "PERMISSIVE"})
    whole = F.try_parse_json("line")
    kind = F.schema_of_variant(whole)
    problem = F.when(is_blank, "blank").when(whole.isNull(), "bad_json").when(~kind.startswith("OBJECT"), "no_object")
    rows = raw if blank == "error" else raw.where(~is_blank)
    return rows.withColumn("problem", problem).withColumn("_r", F.when(F.col("problem").isNull(), record)).select("line_no", "row_id", "line", "_r.*", "problem")


def read_documents(spark: SparkSession, path: str, schema: str = DOCUMENT, strict: bool = False, blank: str = "skip", through: bool = False) -> DataFrame:
    """Documents of a JSON lines file, with ``line_no`` and ``problem``; ``strict`` stops at the first problem met, ``through`` is that of ``lines``."""
    rows = parsed(lines(spark, path, through), schema, blank)
    if strict:
        stop = F.when(F.col("problem").isNotNull(), F.raise_error(F.format_string("line %d: %s", "line_no", "problem"))).otherwise(F.col("line_no"))
        return rows.withColumn("line_no", stop.cast("int")).drop("problem")
    return rows


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One document per file: the whole of it."""
    return spark.read.text(path, wholetext=True).select(F.monotonically_increasing_id().alias("row_id"), F.col("value").alias("text"))


def literal_text(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame([(0, text)], "row_id long, text string")


def exactly_one(**given: str | None) -> tuple[str, str]:
    """(name, value) of the one source that is given; ``none`` and None mean not given."""
    found = [(k, v) for k, v in given.items() if v not in (None, "none")]
    if len(found) != 1:
        raise ValueError(f"exactly one of {sorted(given)} must be given; got {[k for k, _ in found]}")
    return found[0]


def read_review(spark: SparkSession, path: str, check_format: bool = False) -> DataFrame:
    """(type, value, label_ord, value_ord) of a review dictionary {label: [values]}, checked, without repeats, in its order."""
    with_order = spark.read.text(path, wholetext=True).select(F.col("value").alias("j"))
    names = with_order.select(F.posexplode(F.json_object_keys("j")).alias("label_ord", "type"), "j")
    rows = names.select("label_ord", "type", F.posexplode_outer(F.from_json("j", "map<string,array<string>>")[F.col("type")]).alias("_p", "value"))
    return review_table(rows.where("value is not null"), check_format)


def review_table(rows: DataFrame, check_format: bool = False) -> DataFrame:
    """Review entries (type, value, label_ord, _p) checked and without repeats; a broken one stops the job, naming what is wrong."""
    error = F.when(~F.col("type").isin(*tax.TYPES), "unknown_label").when(F.col("value") == "", "empty").when(F.col("value") != F.btrim("value"), "untrimmed")
    if check_format:
        error = error.when(F.col("value").rlike("[\n\r]"), "newline").otherwise(format_error(F.col("type"), F.col("value")))
    bad = rows.withColumn("error", error)
    checked = bad.withColumn("value", F.when(F.col("error").isNotNull(), F.raise_error(F.concat_ws(" ", F.lit("review:"), "error", "type", "value"))).otherwise(F.col("value")))
    first = checked.groupBy("type", "value").agg(F.min("label_ord").alias("label_ord"), F.min("_p").alias("value_ord"))
    return first.select("type", "value", "label_ord", "value_ord")


def schema_violations(docs: DataFrame, id_col: str = "row_id", check_format: bool = True) -> DataFrame:
    """(row_id, ent_idx, error): what the chunk builder refuses: empty text, unknown type, empty or absent value, format, one value under two types."""
    rows = docs.select(F.col(id_col).alias("row_id"), "text", "entities")
    empty = rows.where(F.col("text").isNull() | (F.btrim("text") == "")).select("row_id", F.lit(-1).alias("ent_idx"), F.lit("empty_text").alias("error"))
    none = rows.where(F.col("entities").isNull()).select("row_id", F.lit(-1).alias("ent_idx"), F.lit("no_entities").alias("error"))
    ents = rows.where("text is not null").select("row_id", "text", F.posexplode("entities").alias("ent_idx", "_e")).select("row_id", "ent_idx", "text", "_e.type", "_e.value")
    error = F.when(~F.col("type").isin(*tax.TYPES) | F.col("type").isNull(), "unknown_type").when(F.col("value").isNull() | (F.btrim("value") == ""), "empty").when(~F.col("text").contains(F.col("value")), "not_in_text")
    if check_format:
        error = error.otherwise(F.concat(F.lit("format:"), format_error(F.col("type"), F.col("value"))))
    broken = ents.withColumn("error", error).where("error is not null").select("row_id", "ent_idx", "error")
    twice = ents.groupBy("row_id", "value").agg(F.countDistinct("type").alias("n"), F.min("ent_idx").alias("ent_idx")).where("n > 1").select("row_id", "ent_idx", F.lit("two_types").alias("error"))
    return empty.unionByName(none).unionByName(broken).unionByName(twice)


# --- sinks --------------------------------------------------------------------------------------


def json_line(*columns: str | Column) -> Column:
    """A row as one line of JSON, keys in the order given, absent values written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, path: str, order: str | None = None, mode: str = "error") -> None:
    """JSON lines, a file per partition; with ``order`` the rows are sorted over all files, and ``order`` itself is not written."""
    rows = df.orderBy(order).drop(order) if order else df
    rows.select(json_line(*[F.col(c) for c in rows.columns]).alias("value")).write.mode(mode).text(path)


def write_review(review: DataFrame, path: str) -> None:
    """A review dictionary as one indented JSON file, labels and values in their order (a dictionary is small)."""
    out: dict[str, list[str]] = {}
    for r in review.orderBy("label_ord", "value_ord").collect():
        out.setdefault(r["type"], []).append(r["value"])
    _put(path, json.dumps(out, ensure_ascii=False, indent=2) + "\n")


def write_single(df: DataFrame, path: str | None = None) -> str:
    """The one row of ``df`` as one line of JSON, also to a file where a path is given."""
    line = df.select(json_line(*[F.col(c) for c in df.columns]).alias("j")).first()["j"]
    if path and path != "none":
        _put(path, line + "\n")
    return line


def publish_folder(built: str, target: str) -> None:
    """Put a finished folder in the place of ``target`` in one step, the old one going only after."""
    old = f"{target}.old-{os.getpid()}"
    os.makedirs(os.path.dirname(os.path.abspath(target)), exist_ok=True)
    if os.path.exists(target):
        os.replace(target, old)
    os.replace(built, target)
    if os.path.exists(old):
        import shutil

        shutil.rmtree(old)


def _put(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def thresholds(spec: str | None, kind: type = float) -> dict[str, float]:
    """Per-type bounds from a JSON object; none and empty mean no own bounds."""
    if spec is None or spec.strip() in ("", "none"):
        return {}
    found = json.loads(spec)
    wrong = kind is int and isinstance(found, dict) and any(not isinstance(v, int) for v in found.values())
    if not isinstance(found, dict) or wrong or any(not isinstance(v, (int, float)) for v in found.values()):
        raise ValueError(f"not an object of type names to numbers: {spec!r}")
    return {str(k): kind(v) for k, v in found.items()}


def as_struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
