"""Line dedup by distinct-site spread: lines found on many sites are boilerplate and go.

Each line (trimmed of spaces and tabs, not empty) is a 96-bit hash. Per hash a HyperLogLog sketch of the sites is
aggregated, with map-side combine, as the aggregate approx_count_distinct does, together with the least and largest hash of a site. Lines whose
estimate lies far above ``min_sites`` (by ``margin`` times the threshold) are boilerplate, lines on one site are not; all others have
their sites counted exactly. Under the default threshold no line on fewer sites can pass the upper bound (seven sites fill seven registers at
most, which is estimated as 9), so every line is judged rightly.

Scale. The texts are read twice or three times and never shuffled: what moves is (hash, sketch) once per
task and distinct line, the (hash, site) pairs of near-threshold lines, and the places of the lines to drop. A line that a
third of all documents share is combined before the shuffle, and the joins on hashes are plain equi-joins, broadcast by
Spark where a side proves small and else split where skewed.

Defined cases: a null text stays null and has no lines; empty lines are never dropped; a null site counts as one site; repeats
of a line in one document or site count once; each row is cleaned by its own text, whether or not its id is null or repeated; very long texts are taken apart
in time that grows with their lines; an empty table gives an empty result; extra columns are kept whatever their names, but for ``n_lines`` and ``removed_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small_side

MIN_SITES = 8
ERROR = 0.3  # asked of the sketch: 16 registers, two machine words a line
MARGIN = 0.85
BROADCAST = 500_000  # lines of 16 bytes that a join may broadcast; beyond that it shuffles


def _hashes(docs: DataFrame, text_col: str, *keep: Column) -> DataFrame:
    """(…keep, _pos, _h1, _h2) of the lines of each text."""
    lines = docs.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("_pos", "_line"))
    line = F.trim(F.regexp_replace("_line", r"^[\t\r ]+|[\t\r ]+$", ""))
    return lines.withColumn("_line", line).where("_line <> ''").select(*[c for c in lines.columns if c not in ("_line",)], F.xxhash64("_line").alias("_h1"), F.hash("_line").alias("_h2"))


def boilerplate(docs: DataFrame, site: Column, text_col: str = "text", min_sites: int = MIN_SITES, error: float = ERROR, margin: float = MARGIN) -> DataFrame:
    """(_h1, _h2) of the lines found on ``min_sites`` sites or more."""
    where = F.coalesce(F.concat(F.lit("s"), site.cast("string")), F.lit("")).alias("_site")
    lines = _hashes(docs, text_col, where)
    site_hash = F.xxhash64("_site")
    spread = lines.groupBy("_h1", "_h2").agg(F.approx_count_distinct("_site", error).alias("_n"), F.min(site_hash).alias("_lo"), F.max(site_hash).alias("_hi"))
    wide = checkpointed(spread.where("_lo <> _hi") if min_sites > 1 else spread)
    sure = wide.where(F.col("_n") > min_sites * (1 + margin)).select("_h1", "_h2")
    near = wide.where(F.col("_n") <= min_sites * (1 + margin)).select("_h1", "_h2")
    exact = lines.select("_h1", "_h2", "_site").join(small_side(near, BROADCAST), ["_h1", "_h2"], "left_semi").distinct()
    counted = exact.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    return sure.unionByName(counted.where(F.col("_n") >= min_sites).select("_h1", "_h2"))


def line_dedup(docs: DataFrame, site: Column, id_col: str = "doc_id", text_col: str = "text", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of the text, and ``n_lines``, ``removed_lines``."""
    gone = checkpointed(boilerplate(docs, site, text_col, min_sites))
    # rows with the same id and text are cleaned alike; no other rows share a key
    names = [f"_ld_{k}" for k in range(len(docs.columns))]
    own, id_, text = docs.toDF(*names), *(F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    places = _hashes(own, names[docs.columns.index(text_col)], id_.alias("_key"), F.xxhash64(text).alias("_text")).join(small_side(gone, BROADCAST), ["_h1", "_h2"], "left_semi")
    places = places.groupBy("_key", "_text").agg(F.collect_set("_pos").alias("_gone"))
    joined = own.join(places, id_.eqNullSafe(F.col("_key")) & (F.xxhash64(text) == F.col("_text")), "left")
    lines = F.split(text, "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(1), F.size(lines)), F.transform("_gone", lambda i: i + 1)), lambda i: F.element_at(lines, i))
    clean = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    out = {"n_lines": F.coalesce(F.size(lines), F.lit(0)), "removed_lines": F.coalesce(F.size("_gone"), F.lit(0))}
    rest = [(clean if c == text_col else F.col(n)).alias(c) for c, n in zip(docs.columns, names) if c not in out]
    return joined.select(*rest, *[F.when(text.isNull(), 0).otherwise(v).alias(k) for k, v in out.items()])
