"""Run the incremental staging upsert whenever new report files land.

The reference re-processes a trailing window on a schedule.  Here a
Structured Streaming query watches the landing folder of a performance
report; each micro-batch only says *which days* changed.  ``foreachBatch``
then re-stages exactly those days against the full source tables — so a
campaign-day whose rows land in two micro-batches is still summed whole — and
upserts by key.  A target that does not exist yet is built in full, so days that
were in the sources before the stream began are there too.  Progress
is kept in the query checkpoint, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import EngineConfig
from ..session import intermediates, written
from ..sinks.table import read_table, recover, upsert_by_key, write_table
from ..sources.catalog import AdSources
from ..plans.incremental import STAGING_PARTITIONS, staging_keys
from ..plans.staging import STAGING


def start_staging_stream(spark: SparkSession, entity: str, landing_path: str, landing_schema: StructType,
                         sources: Callable[[SparkSession], AdSources], cfg: EngineConfig,
                         target_path: str, checkpoint_location: str,
                         available_now: bool = True, partition_by=STAGING_PARTITIONS) -> StreamingQuery:
    """Start the stream; ``sources`` builds the (full) source tables for each batch."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        with intermediates(batch.sparkSession):
            upsert(batch)

    def upsert(batch: DataFrame) -> None:
        session = batch.sparkSession
        recover(session, target_path)
        if read_table(session, target_path) is None:
            write_table(STAGING[entity](sources(session), cfg), target_path, partition_by)
            return
        days = written(batch.select(F.col("date").cast("date").alias("date")).where("date is not null").distinct())
        first = days.agg(F.min("date")).first()[0]
        if first is None:
            return
        rows = STAGING[entity](sources(session), cfg, since=first).join(days, "date", "left_semi")
        upsert_by_key(session, rows, target_path, staging_keys(entity, cfg), "sync", partition_by,
                      null_safe=not cfg.strict)

    stream = spark.readStream.schema(landing_schema).parquet(landing_path).select("date")
    writer = (stream.writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
