"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batches import in_batches

#: A word of the op contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """``scan`` (of a table), dealt anew if it has fewer splits than there are cores: work in Python would leave cores idle."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: the one in ``spark.checkpoint.dir``, else the one set on the context; a local session gets one of its own."""
    sc = spark.sparkContext
    if named := sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir():
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="velatura-checkpoint-"))
    return sc.getCheckpointDir().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut there.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; a folder of our
    own is set only where that is unset (a local session, as in the tests).
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(0))


def unit_hash(col: Column, seed: int) -> Column:
    """A value in [0, 1) that depends on ``col`` and ``seed`` alone."""
    return F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def labelled_sample(labels: DataFrame, label: str, bound: int, keep: Column | None = None, seed: int = 11) -> DataFrame:
    """(doc_id, <label>) of about ``bound`` labelled rows at most, for fitting a classifier.

    Rows are taken by a hash of doc_id, at the one rate that brings their expected number down to
    ``bound``; all rows while there are no more than that. Null labels and ids are left out; of
    rows that repeat a doc_id the largest label counts. The result is small by construction
    (``bound`` plus a few standard deviations), so it may be broadcast.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if keep is not None:
        rows = rows.where(keep)
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    n = rows.count()
    if n > bound:
        rows = rows.where(unit_hash(F.col("doc_id"), seed) < bound / n)
    return rows


def small_side(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """``df``, marked for broadcast if it is counted to be ``rows`` short rows at most; else the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_hot(left: DataFrame, right: DataFrame, key: str, size: str, n: int, by: Column) -> DataFrame:
    """``left`` with the columns of ``right``, which has one row for every key of ``left`` and in ``size`` the number of its rows there.

    Keys with more than 1/256 of the ``n`` rows of ``left``, 256 at most, are broadcast; their rows are spread by the hash of ``by``
    in the join that serves the others, so that no key lands in one task.
    """
    rest = [c for c in right.columns if c != key]
    hot = right.where(F.col(size) * 256 > n).select(F.col(key).alias("_jh_key"), *[F.col(c).alias(f"_jh_{c}") for c in rest])
    met = left.join(F.broadcast(hot), F.col(key) == F.col("_jh_key"), "left")
    met = met.withColumn("_jh_salt", F.when(F.col("_jh_key").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(by), F.lit(1 << 20))))
    cold = right.select(F.col(key).alias("_jc_key"), F.lit(0).cast("long").alias("_jc_salt"), *[F.col(c).alias(f"_jc_{c}") for c in rest])
    both = met.join(cold, (F.col(key) == F.col("_jc_key")) & (F.col("_jh_salt") == F.col("_jc_salt")), "left")
    return both.select(*left.columns, *[F.coalesce(f"_jh_{c}", f"_jc_{c}").alias(c) for c in rest])


Run = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def give_back() -> None:
    """Hand the memory that this worker has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def lean(run: Run) -> Run:
    """``run``, after which the worker keeps no freed memory: it serves the tasks of many stages, and would hold the most that any of them took."""

    def lean_run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(batches)
        give_back()

    return lean_run
