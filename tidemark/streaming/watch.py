"""Deliveries as a stream: new files in a tenant's folders start runs.

The file source only says that something came; a run finds the files itself and
knows them by content, so a batch that is delivered to it twice changes nothing.
Batches of one tenant follow each other, as the merge needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..plans.pipeline import RunStats, run_tenant


def watch(spark: SparkSession, config: Config, root: str, tenant_id: str, checkpoint: str, once: bool = False, told: Callable[[RunStats], None] | None = None) -> StreamingQuery:
    """Runs the tenant whenever files arrive; once: for what is there, then ends."""
    tenant = config.tenant(tenant_id)
    arrivals: DataFrame | None = None
    for pattern in tenant.sources.values():
        one = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").load(f"{config.base.rstrip('/')}/{pattern}").select("path", "length")
        arrivals = one if arrivals is None else arrivals.unionByName(one)

    def batch(rows: DataFrame, _: int) -> None:
        if rows.limit(1).count():
            stats = run_tenant(spark, config, root, tenant_id)
            if told:
                told(stats)

    writer = arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def rolling_counts(events: DataFrame, late: str = "2 hours", window: str = "1 day") -> DataFrame:
    """Event counts by window, campaign and type of a stream (occurred_at, campaign_id, type), with late ones awaited so long."""
    return (
        events.withWatermark("occurred_at", late)
        .groupBy(F.window("occurred_at", window).alias("w"), F.coalesce("campaign_id", F.lit("(none)")).alias("campaign_id"), "type")
        .count()
        .select(F.to_date("w.start").alias("day"), "campaign_id", "type", "count")
    )
