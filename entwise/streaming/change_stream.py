"""The change-log load as a file stream.

Every micro-batch of newly arrived raw files runs the load that a scheduled job
runs: the days that the batch touches are normalised from the whole raw folder
and replace these days in the target. The table therefore does not depend on
which files came in which batch, and a batch that is replayed after a failure
writes the same rows again.

``trigger(availableNow=True)`` processes everything present and stops, which
fits a scheduled job; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from entwise import schemas as S
from entwise.operators.change_state import load_changes
from entwise.plans.jobs import normalize_changes
from entwise.sinks.store import Store


def start_change_stream(spark: SparkSession, raw_path: str, changes_table: str,
                        checkpoint_path: str, excluded_users: Sequence[str] = (),
                        schema: StructType = S.RAW_CHANGES_SCHEMA, fmt: str = "parquet",
                        available_now: bool = True, files_per_batch: int | None = None) -> StreamingQuery:
    """Start the stream; returns the running query (call ``awaitTermination``).
    ``files_per_batch`` bounds the files a batch looks for new days in; it does
    not change the table."""
    options = {"header": "true"} if fmt == "csv" else {}
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.load(raw_path)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        log = session.read.schema(schema).format(fmt).options(**options).load(raw_path)
        normalize_changes(session, batch, log, changes_table, excluded_users)

    writer = (raw.writeStream.foreachBatch(load_batch)
              .option("checkpointLocation", checkpoint_path)
              .queryName(f"changes_to_{changes_table.replace('.', '_')}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def start_change_stream_into(spark: SparkSession, raw_path: str, store_root: str, checkpoint_path: str,
                             excluded_users: Sequence[str] = (), schema: StructType = S.RAW_CHANGES_SCHEMA,
                             fmt: str = "parquet", available_now: bool = True,
                             files_per_batch: int | None = None) -> StreamingQuery:
    """The stream into a store with mergeable state (``operators.change_state``): a
    micro-batch reads its own files and the stored parts of the days they touch,
    not the raw folder. Each file is a load of its own, named by its path, so
    batches that are replayed, cut otherwise too, replace the same rows."""
    reader = spark.readStream.schema(schema).format(fmt).options(**({"header": "true"} if fmt == "csv" else {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.load(raw_path).select("*", F.md5("_metadata.file_path").alias("_file"))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load_changes(Store(batch.sparkSession, store_root), batch, F.col("_file"), excluded_users)

    writer = raw.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
