"""How rows are handed to Python workers, whose memory is that of their largest batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of a batch at most, or one row if that is larger.
BATCH_BYTES = 8 << 20


def in_batches(df: DataFrame, rows: int = 512) -> DataFrame:
    """``df``, to be handed to Python in batches of at most ``rows`` rows and about ``BATCH_BYTES``.

    Spark's default of 10,000 rows a batch is 1.2 GB of texts of 120 KB; the session's settings are only ever lowered.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        held = conf.get(key, str(most + 1)).removesuffix("b")  # numbers as they are, sizes with their unit
        if not held.isdigit() or not 0 < int(held) <= most:
            conf.set(key, str(most))
    return df
