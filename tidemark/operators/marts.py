"""Daily marts, all dirty days at once, and what a rebuild changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"
REVENUE = ("orders", "gross", "refunds", "net")
EMAIL = ("delivered", "opens", "clicks", "unsubscribes")
#: Metric of each counted event type.
COUNTED = {"delivered": "delivered", "open": "opens", "click": "clicks", "unsubscribe": "unsubscribes"}


def on_days(rows: DataFrame, days: DataFrame | None, column: str = "posting_day") -> DataFrame:
    return rows if days is None else rows.join(days.select(F.col("day").alias(column)).distinct(), column, "left_semi")


def revenue(orders: DataFrame, refunds: DataFrame, days: DataFrame | None = None, named: DataFrame | None = None) -> DataFrame:
    """day, dimension (channel), orders, gross, refunds, net.

    orders: order_id, channel, gross, posting_day; refunds: order_id, amount,
    posting_day. Both sides are summed before they meet, so what is shuffled to the
    full join is one row a day and channel; a refund takes its order's channel,
    whatever day that order is on. named: orders that hold all that the refunds name (all
    orders by default); they are reduced to those before they meet the refunds, so a
    day's refunds don't move every order.
    """
    return both_sides(sold(on_days(orders, days)), returned(on_days(refunds, days), orders if named is None else named))


def sold(orders: DataFrame) -> DataFrame:
    """day, dimension, orders and gross."""
    return orders.groupBy(F.col("posting_day").alias("day"), F.col("channel").alias("dimension")).agg(F.count("*").alias("orders"), F.sum("gross").cast(MONEY).alias("gross"))


def returned(refunds: DataFrame, named: DataFrame) -> DataFrame:
    """day, dimension (the channel of each refund's order) and refunds."""
    named = named.select("order_id", "channel").join(refunds.select("order_id").distinct(), "order_id", "left_semi")
    back = refunds.join(named, "order_id", "left")
    return back.groupBy(F.col("posting_day").alias("day"), F.coalesce("channel", F.lit("unattributed")).alias("dimension")).agg(F.sum("amount").cast(MONEY).alias("refunds"))


def both_sides(sold: DataFrame, back: DataFrame) -> DataFrame:
    """day, dimension, orders, gross, refunds and net."""
    zero = F.lit(0).cast(MONEY)
    both = sold.join(back, ["day", "dimension"], "full")
    both = both.select("day", "dimension", F.coalesce("orders", F.lit(0).cast("long")).alias("orders"), F.coalesce("gross", zero).alias("gross"), F.coalesce("refunds", zero).alias("refunds"))
    return both.withColumn("net", (F.col("gross") - F.col("refunds")).cast(MONEY))


# ---- signed contributions: what a staged change adds to its day, and takes from it


def _signed(outcomes: DataFrame) -> DataFrame:
    """day (on which the record is booked), sign and row: what came in counts 1, what it replaced -1."""
    sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("previous").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("incoming").alias("row")))
    each = outcomes.where("outcome in ('inserted', 'updated')").select(F.col("booked").alias("day"), F.explode(sides).alias("s"))
    return each.select("day", "s.sign", "s.row").where("row is not null")


def sold_change(outcomes: DataFrame) -> DataFrame:
    """day, dimension, orders and gross that staged orders add (outcomes of their merge)."""
    return _signed(outcomes).groupBy("day", F.col("row.channel").alias("dimension")).agg(F.sum("sign").alias("orders"), F.sum(F.col("sign") * F.col("row.gross")).cast(MONEY).alias("gross")).where("orders <> 0 or gross <> 0")


def email_change(outcomes: DataFrame) -> DataFrame:
    """day, dimension, events and the counted metrics that staged email events add."""
    counts = [F.sum(F.when(F.col("row.type") == kind, F.col("sign")).otherwise(0)).alias(metric) for kind, metric in COUNTED.items()]
    out = _signed(outcomes).groupBy("day", F.coalesce("row.campaign_id", F.lit("(none)")).alias("dimension")).agg(F.sum("sign").alias("events"), *counts)
    return out.where(" or ".join(f"{c} <> 0" for c in ("events", *EMAIL)))


def added(old: DataFrame, changes: DataFrame, count: str, sums: dict[str, str]) -> DataFrame:
    """old (day, dimension, sums) with changes added; a dimension of which no record is left (count) goes."""
    both = old.select("day", "dimension", *sums).unionByName(changes.select("day", "dimension", *sums))
    return both.groupBy("day", "dimension").agg(*[F.sum(c).cast(kind).alias(c) for c, kind in sums.items()]).where(F.col(count) > 0)


def email(events: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """day, dimension (campaign), events, delivered, opens, clicks, unsubscribes; events: campaign_id, type, posting_day."""
    counts = [F.count_if(F.col("type") == kind).alias(metric) for kind, metric in COUNTED.items()]
    return on_days(events, days).groupBy(F.col("posting_day").alias("day"), F.coalesce("campaign_id", F.lit("(none)")).alias("dimension")).agg(F.count("*").alias("events"), *counts)


def restated(old: DataFrame, new: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """day, dimension, metric, previous, current of what moved.

    Both frames have day, dimension and the metrics. A dimension that is new leaves
    no row; one that is gone is restated to zero.
    """
    number = "decimal(14,2)"
    o = old.select("day", "dimension", *[F.col(m).cast(number).alias(f"_old_{m}") for m in metrics], F.lit(True).alias("_was"))
    n = new.select("day", "dimension", *[F.col(m).cast(number).alias(f"_new_{m}") for m in metrics])
    both = o.join(n, ["day", "dimension"], "left")
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"_old_{m}").alias("previous"), F.coalesce(f"_new_{m}", F.lit(0).cast(number)).alias("current")) for m in metrics])).alias("x")
    return both.select("day", "dimension", each).select("day", "dimension", "x.*").where("previous <> current")


def completeness(days: DataFrame, deliveries: DataFrame) -> DataFrame:
    """day and complete: whether each delivery of orders or refunds that covers it has loaded.

    deliveries: source, covers_from, covers_to, loaded. A delivery becomes one row
    for each day it covers, so the join is by equality.
    """
    own = deliveries.where(F.col("source").isin("orders", "refunds"))
    per_day = own.select(F.explode(F.sequence("covers_from", "covers_to", F.expr("interval 1 day"))).alias("day"), "loaded").groupBy("day").agg(F.bool_and("loaded").alias("complete"))
    return days.select("day").join(per_day, "day", "left").select("day", F.coalesce("complete", F.lit(True)).alias("complete"))


def marketing(deliveries: DataFrame, spend: DataFrame) -> DataFrame:
    """Every day that spend was promised for, with what was spent: null and not complete where nothing arrived."""
    own = deliveries.where(F.col("source") == "ad_spend")
    expected = own.select(F.explode(F.sequence("covers_from", "covers_to", F.expr("interval 1 day"))).alias("day"), "loaded").groupBy("day").agg(F.bool_and("loaded").alias("complete"))
    s = spend.select(F.col("spend_date").alias("day"), "platform", "campaign_id", "spend", "currency", "schema_version")
    return expected.join(s, "day", "left").select("day", "platform", "campaign_id", "spend", "currency", "schema_version", "complete")


def _late(rows: DataFrame, source: str, key: Column, day: Column, amount: Column, dimension: Column) -> DataFrame:
    out = rows.select(F.lit(source).alias("source"), key.alias("natural_key"), F.to_date(day).alias("event_day"), "posting_day", amount.cast(MONEY).alias("amount"), dimension.alias("dimension"))
    return out.where("posting_day <> event_day")


def late_postings(orders: DataFrame, refunds: DataFrame, events: DataFrame, spend: DataFrame) -> DataFrame:
    """Records booked on a day other than their own."""
    parts = [
        _late(orders, "orders", F.col("order_id"), F.col("created_at"), F.col("gross"), F.col("channel")),
        _late(refunds, "refunds", F.col("refund_id"), F.col("refunded_at"), F.col("amount"), F.col("order_id")),
        _late(events, "email_events", F.col("event_id"), F.col("occurred_at"), F.lit(None), F.coalesce("campaign_id", F.lit("(none)"))),
        _late(spend, "ad_spend", F.col("campaign_id"), F.col("spend_date"), F.col("spend"), F.col("platform")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def orphans(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """Refunds whose order is unknown."""
    return refunds.join(orders.select("order_id"), "order_id", "left_anti")


def resolved(held: DataFrame, refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """Held references (ref: a refund's id) whose order has come."""
    own = refunds.join(held.select(F.col("ref").alias("refund_id")).distinct(), "refund_id", "left_semi")  # few, before they meet orders
    known = own.join(orders.select("order_id"), "order_id", "left_semi").select(F.col("refund_id").alias("ref"))
    return held.join(known, "ref", "left_semi")
