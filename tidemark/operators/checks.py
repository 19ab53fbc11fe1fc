"""Checks that say what did not happen, and the read views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CHANNEL_ORDER, SOURCE_ORDER
from ..functions import display

MONEY = "decimal(14,2)"
#: Sums over all of a mart, which MONEY may be too narrow for.
TOTAL = "decimal(24,2)"
#: The reason that conflicts are shown with, and the keys of a hold's detail in the order they are shown in.
REDELIVERED = "redelivered with different content"
DETAIL_ORDER = ("order_id", "refund_id", "event_id", "field", "alias", "value", "map", "columns", "fields", "amount", "error", "file")


def source_rank(source: Column | str = "source") -> Column:
    """Place in the fixed order, null (so last) for others."""
    return F.nullif(F.array_position(F.array(*[F.lit(s) for s in SOURCE_ORDER]), F.col(source) if isinstance(source, str) else source), F.lit(0))


def deliveries(expected: DataFrame, loads: DataFrame, as_of: Column) -> DataFrame:
    """Every promised delivery and what became of it; overdue_days counts from the day after its window closed."""
    f = loads.select("source", "batch", F.col("status").alias("_status"), F.col("rows_seen").alias("rows"), F.col("schema_version").alias("schema"))
    out = expected.join(f, ["source", "batch"], "left").withColumn("status", F.coalesce("_status", F.lit("missing")))
    overdue = F.when(F.col("status") != "loaded", display.overdue_days(F.col("covers_to"), as_of))
    return out.select("source", "batch", F.concat_ws(" to ", "covers_from", "covers_to").alias("covers"), F.col("path").alias("expected_path"), "status", "rows", "schema", overdue.alias("overdue_days"))


def finance(reported: DataFrame, mart: DataFrame) -> DataFrame:
    """The client's own daily summary against the mart: a day without mart rows counts as 0.00."""
    own = mart.groupBy("day").agg(F.sum("gross").cast(MONEY).alias("mart_gross"), F.sum("net").cast(MONEY).alias("mart_net"))
    zero = F.lit(0).cast(MONEY)
    out = reported.join(own, "day", "left").withColumn("mart_gross", F.coalesce("mart_gross", zero)).withColumn("mart_net", F.coalesce("mart_net", zero))
    gross, net = display.difference(F.col("gross_reported"), F.col("mart_gross")), display.difference(F.col("net_reported"), F.col("mart_net"))
    return out.select("day", F.col("gross_reported").alias("reported_gross"), "mart_gross", gross.alias("gross_diff"), F.col("net_reported").alias("reported_net"), "mart_net", net.alias("net_diff"), (gross == 0).alias("ties"))


def freshness(expected: DataFrame, loads: DataFrame, as_of: Column) -> DataFrame:
    """By source: the last day a loaded delivery covers, the last promised, the gap and how many are missing."""
    f = loads.select("source", "batch", "status")
    rows = expected.join(f, ["source", "batch"], "left")
    loaded = F.coalesce(F.col("status") == "loaded", F.lit(False))
    out = rows.groupBy("source").agg(F.max(F.when(loaded, F.col("covers_to"))).alias("last_covered"), F.max("covers_to").alias("expected_through"), F.count_if(~loaded).alias("missing"))
    return out.select("source", "last_covered", "expected_through", display.stale_days(F.col("last_covered"), F.col("expected_through"), as_of).alias("stale_days"), "missing")


def promised_or_loaded(expected: DataFrame, loads: DataFrame) -> DataFrame:
    """Every batch that was promised, and every one that came without a promise, in display order."""
    e = expected.select("source", "batch", "covers_from", "covers_to", F.col("path").alias("_epath"), F.lit(True).alias("_promised")).where("batch is not null")
    f = loads.select("source", "batch", F.col("path").alias("_fpath"), "status", "rows_seen", "schema_version", "loaded_at", "attempts").where("batch is not null")
    out = e.join(f, ["source", "batch"], "full")
    out = out.select(
        "source", "batch", F.coalesce("_promised", F.lit(False)).alias("expected"), "covers_from", "covers_to", F.coalesce("_epath", "_fpath").alias("path"),
        F.coalesce("status", F.lit("missing")).alias("status"), "rows_seen", "schema_version", "loaded_at", "attempts", F.coalesce(F.col("schema_version") != "v1", F.lit(False)).alias("alias"),
    )
    return out.orderBy(source_rank().asc_nulls_last(), "source", "batch")


def revenue_totals(mart: DataFrame) -> DataFrame:
    """One row: days, gross, refunds, net, incomplete_days."""
    money = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast(TOTAL).alias(c)
    return mart.agg(F.count_distinct("day").alias("days"), money("gross"), money("refunds"), money("net"), F.count_distinct(F.when(~F.col("complete"), F.col("day"))).alias("incomplete_days"))


def revenue_by_day(mart: DataFrame) -> DataFrame:
    """The mart by day, with the net of each channel as a map."""
    by_channel = F.map_from_entries(F.array_sort(F.collect_list(F.struct("channel", "net")))).alias("by_channel")
    return mart.groupBy("day").agg(
        F.sum("orders").alias("orders"), F.sum("gross").cast(MONEY).alias("gross"), F.sum("refunds").cast(MONEY).alias("refunds"), F.sum("net").cast(MONEY).alias("net"),
        F.bool_and("complete").alias("complete"), by_channel, F.min("currency").alias("currency"),
    )


def channel_totals(mart: DataFrame) -> DataFrame:
    """Net by channel in display order: known channels first, others by name."""
    rank = F.nullif(F.array_position(F.array(*[F.lit(c) for c in CHANNEL_ORDER]), F.col("channel")), F.lit(0))
    return mart.groupBy("channel").agg(F.sum("net").cast(MONEY).alias("net")).withColumn("rank", rank).orderBy(F.col("rank").asc_nulls_last(), "channel")


def restatement_days(restatements: DataFrame) -> DataFrame:
    """Restatements by day: how many, by which runs and sources, in which marts."""
    rows = restatements.withColumn("_s", display.sources_of_cause(F.col("cause")))
    return rows.groupBy("day").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("run_id")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("_s")))).alias("sources"), F.count_distinct("mart").alias("marts"))


def latest_restatements(restatements: DataFrame, most: int = 500) -> DataFrame:
    return restatements.orderBy(F.desc("day"), "mart", "dimension", "metric", "run_id").limit(most)


def holds(quarantine: DataFrame, events: DataFrame, conflicts: DataFrame, loads: DataFrame, most: int | None = 300) -> DataFrame:
    """Everything held back or flagged, with the batch and run it came from; of what is alike in kind, reference and batch the newest first."""
    f = loads.select(F.col("id").alias("file_load_id"), "batch", F.col("path").alias("_path"), "run_id")
    q = quarantine.join(f, "file_load_id", "left").select(F.lit("quarantine").alias("kind"), "source", "batch", "ref", "reason", "detail", "run_id", "at")
    merged = F.to_json(F.map_concat(F.from_json("detail", "map<string,string>"), F.create_map(F.lit("file"), F.col("_path"))))
    e = events.join(f, "file_load_id", "left").select(F.lit("schema event").alias("kind"), "source", "batch", F.lit("").alias("ref"), F.col("kind").alias("reason"), merged.alias("detail"), "run_id", "at")
    both = F.to_json(F.create_map(F.lit("previous"), F.col("previous"), F.lit("incoming"), F.col("incoming")))
    c = conflicts.join(f, "file_load_id", "left").select(F.lit("conflict").alias("kind"), "source", "batch", F.col("natural_key").alias("ref"), F.lit(REDELIVERED).alias("reason"), both.alias("detail"), "run_id", "at")
    out = q.unionByName(e).unionByName(c)
    order = ["kind", "ref", F.col("batch").asc_nulls_last(), F.desc("at"), "source", "reason", "detail"]
    return out.orderBy(*order).limit(most) if most else out


def shown_detail(detail: Column) -> Column:
    """A hold's detail (JSON) as `key: value` texts, what identifies the record first, then by name."""
    entries = F.map_entries(F.from_json(detail, "map<string,string>"))
    rank = F.array(*[F.lit(k) for k in DETAIL_ORDER])
    ranked = F.transform(entries, lambda e: F.struct(F.coalesce(F.nullif(F.array_position(rank, e["key"]), F.lit(0)), F.lit(len(DETAIL_ORDER) + 1)).alias("r"), e["key"].alias("key"), e["value"].alias("value")))
    return F.transform(F.array_sort(ranked), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("null"))))


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("id")).limit(1).select("id", "status", "finished_at")


