"""Type-2 snapshot as a Structured Streaming job.

Every folder that lands below the extract folder is one full extract of the
source table (one snapshot run).  ``foreachBatch`` continues the stored
history (``sources.history``) with each of them, which writes only the
versions that the extract closes and the buckets of open versions that it
changes.

Runs can be repeated: an extract that is not newer than the last run has been
applied before and is passed over, and a run that was broken off is completed
when its micro-batch comes again.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.history import apply_extract, runs


#: Column that names a row's extract folder inside the job.
FOLDER = "_extract"


def current_history_path(spark: SparkSession, history_path: str) -> str | None:
    """Where the history lies; None before its first complete run."""
    return history_path if runs(spark, history_path) is not None else None


def apply_snapshot_batch(spark: SparkSession, extract: DataFrame, history_path: str, key: str,
                         check_cols: list[str], as_of: Column) -> str:
    """Apply one extract to the stored history; return its path."""
    apply_extract(spark, history_path, extract, key, check_cols, as_of)
    return history_path


def start_snapshot_stream(spark: SparkSession, extract_dir: str, schema: str, history_path: str,
                          checkpoint_path: str, key: str, check_cols: list[str], *,
                          as_of_col: str = "extracted_at", available_now: bool = True):
    """Start the stream; each micro-batch holds one or more whole extracts.

    Extract files carry ``as_of_col`` (the extraction time), one value in a
    folder.  Several extracts in one micro-batch are applied in its order; a
    folder of several times, or two of one time, end the job with an error.
    """
    # no per-trigger file cap: an extract spans several files and must be
    # applied whole, so producers publish each extract folder atomically
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(extract_dir)
    stream = stream.withColumn(FOLDER, F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            extracts = batch.groupBy(FOLDER).agg(F.min(as_of_col).alias("t"), F.max(as_of_col).alias("last")).orderBy("t").collect()  # a row a folder
            for e, after in zip(extracts, [*extracts[1:], None]):
                if e["t"] is None or e["t"] != e["last"]:
                    raise ValueError(f"snapshot: the extract {e[FOLDER]} has no or several times: {e['t']} to {e['last']}")
                if after is not None and after["t"] == e["t"]:
                    raise ValueError(f"snapshot: two extracts of {e['t']}: {e[FOLDER]}, {after[FOLDER]}")
            for e in extracts:
                part = batch.filter(F.col(FOLDER) == e[FOLDER]).drop(as_of_col, FOLDER)
                apply_snapshot_batch(spark, part, history_path, key, check_cols, F.lit(e["t"]))
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def extract_path(extract_dir: str, n: int) -> str:
    return os.path.join(extract_dir, f"extract-{n:06d}")
