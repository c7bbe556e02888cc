"""Publish decisions over a stream of documents: a stateless map, so no watermark and no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import taxonomy as tax
from ..operators.emit import RULES


def decided(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` (batch or stream) with ``n_found`` and ``should_be_public`` by the rules, row by row."""
    found = [(kind, F.regexp_count(F.col(text_col), F.lit(form))) for kind, form in RULES]
    zero = F.lit(0)
    total, personal = zero, zero
    for kind, n in found:
        total = total + F.coalesce(n, zero)
        personal = personal + F.coalesce(n, zero) if kind in tax.PII_TYPES else personal
    return docs.withColumn("n_found", total).withColumn("should_be_public", personal == 0)


def read_stream(spark: SparkSession, path: str, schema: str = "doc_id long, text string") -> DataFrame:
    """JSON lines files as they arrive in a folder."""
    return spark.readStream.schema(schema).json(path)


def write_stream(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Decisions as JSON lines files; exactly once, with ``checkpoint`` in shared storage."""
    return decided(docs).writeStream.format("json").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
