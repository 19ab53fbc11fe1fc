"""Driver queries: the engine's operators over the test tables, and the same in SQL.

Money is cast to decimal(14,2) before it is summed; days are dates; nothing reads a
clock; ties in every order are broken.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import Config, Field, Source, Tenant
from .functions import coerce, display
from .operators import checks, mapping, marts, merge
from .plans.pipeline import run_tenant
from .store import TenantSession, cleaned

MONEY = "decimal(14,2)"
AS_OF = "2024-02-15"
#: Label map of the order priorities; 4-NOT SPECIFIED has no entry.
LABELS = {"1-urgent": "paid_social", "2-high": "paid_search", "3-medium": "email", "5-low": "direct"}
#: Promised deliveries of events by week: source, batch, window.
WEEKS = [("events", 1, "2024-01-01", "2024-01-07"), ("events", 2, "2024-01-08", "2024-01-14"), ("events", 3, "2024-01-15", "2024-01-21"), ("events", 4, "2024-01-22", "2024-01-28"), ("events", 5, "2024-01-29", "2024-02-04"), ("events", 6, "2024-02-05", "2024-02-11")]
WEEKS_SQL = "(VALUES " + ", ".join(f"('{s}', {b}, DATE '{x}', DATE '{y}')" for s, b, x, y in WEEKS) + ") AS w(source, batch, covers_from, covers_to)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- the tables as an order feed, a refund feed and an event feed


def orders_feed(spark: SparkSession, sf_dir: str, hidden: bool = True) -> DataFrame:
    """Orders, without every fiftieth if hidden, so that some refunds find none."""
    o = table(spark, sf_dir, "orders")
    if hidden:
        o = o.where("o_orderkey % 50 <> 0")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("channel"), F.col("o_totalprice").cast(MONEY).alias("gross"), F.to_date("o_orderdate").alias("posting_day"))


def refunds_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return r.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("refund_id"), F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").cast(MONEY).alias("amount"), F.to_date("l_shipdate").alias("posting_day"))


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as email events: a twelfth of the users each is a campaign, those of campaign 0 have none."""
    e = table(spark, sf_dir, "events")
    kind = F.create_map(*[F.lit(x) for x in ("view", "delivered", "click", "click", "signup", "open", "error", "unsubscribe")])[F.col("event_type")]
    return e.select(
        "event_id", "user_id", "event_type", F.coalesce(kind, F.lit("bounce")).alias("type"), F.when(F.col("user_id") % 12 != 0, F.concat(F.lit("c"), F.col("user_id") % 12)).alias("campaign_id"),
        F.to_date("ts").alias("posting_day"), F.col("ts").alias("occurred_at"), F.col("value").cast(MONEY).alias("amount"),
    )


ORDERS = "orders_feed AS (SELECT o_orderkey AS order_id, o_orderpriority AS channel, CAST(o_totalprice AS DECIMAL(14,2)) AS gross, CAST(o_orderdate AS DATE) AS posting_day FROM orders WHERE o_orderkey % 50 <> 0)"
REFUNDS = "refunds_feed AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS refund_id, l_orderkey AS order_id, CAST(l_extendedprice AS DECIMAL(14,2)) AS amount, CAST(l_shipdate AS DATE) AS posting_day FROM lineitem WHERE l_returnflag = 'R')"
REVENUE = f"""{ORDERS}, {REFUNDS},
o AS (SELECT posting_day AS day, channel, count(*) AS orders, sum(gross) AS gross FROM orders_feed GROUP BY ALL),
r AS (SELECT refunds_feed.posting_day AS day, coalesce(channel, 'unattributed') AS channel, sum(amount) AS refunds FROM refunds_feed LEFT JOIN orders_feed USING (order_id) GROUP BY ALL),
revenue AS (SELECT coalesce(o.day, r.day) AS day, coalesce(o.channel, r.channel) AS dimension, CAST(coalesce(orders, 0) AS BIGINT) AS orders, CAST(coalesce(gross, 0) AS DECIMAL(14,2)) AS gross, CAST(coalesce(refunds, 0) AS DECIMAL(14,2)) AS refunds, CAST(coalesce(gross, 0) - coalesce(refunds, 0) AS DECIMAL(14,2)) AS net FROM o FULL JOIN r ON o.day = r.day AND o.channel = r.channel)"""
EVENTS = """events_feed AS (SELECT event_id, user_id, event_type, CASE event_type WHEN 'view' THEN 'delivered' WHEN 'click' THEN 'click' WHEN 'signup' THEN 'open' WHEN 'error' THEN 'unsubscribe' ELSE 'bounce' END AS type,
CASE WHEN user_id % 12 <> 0 THEN 'c' || CAST(user_id % 12 AS VARCHAR) END AS campaign_id, CAST(ts AS DATE) AS posting_day, ts AS occurred_at, CAST(value AS DECIMAL(14,2)) AS amount FROM events)"""


def weeks(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(WEEKS, "source string, batch int, a string, b string")
    return rows.select("source", "batch", F.to_date("a").alias("covers_from"), F.to_date("b").alias("covers_to"), F.concat(F.lit("events/batch_"), "batch").alias("path"))


def week_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that came: events by week but the third, and an unpromised eighth that holds the late January users."""
    e = table(spark, sf_dir, "events").withColumn("batch", (F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7) + 1).cast("int"))
    e = e.where("batch <> 3").withColumn("batch", F.when(F.col("batch") == 5, 8).otherwise(F.col("batch")))
    out = e.groupBy("batch").agg(F.count("*").alias("rows_seen"))
    status = F.when(F.col("batch") == 4, "quarantined").otherwise("loaded")
    return out.select(F.lit("events").alias("source"), "batch", F.concat(F.lit("events/batch_"), "batch").alias("path"), status.alias("status"), "rows_seen", F.when(F.col("batch") == 2, "value=amount").otherwise("v1").alias("schema_version"), F.lit(None).cast("timestamp").alias("loaded_at"), F.lit(1).alias("attempts"))


LOADS = """loads AS (SELECT 'events' AS source, CASE WHEN b = 5 THEN 8 ELSE b END AS batch, count(*) AS rows_seen, CASE WHEN b = 4 THEN 'quarantined' ELSE 'loaded' END AS status, CASE WHEN b = 2 THEN 'value=amount' ELSE 'v1' END AS schema_version
FROM (SELECT CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7.0) AS INTEGER) + 1 AS b FROM events) WHERE b <> 3 GROUP BY b)"""


# ---- queries


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue(orders_feed(spark, sf_dir), refunds_feed(spark, sf_dir))


def with_status(rows: DataFrame) -> DataFrame:
    """A revenue mart as stored: complete is false on days 13 to 15 of a month."""
    return rows.withColumnRenamed("dimension", "channel").withColumn("currency", F.lit("USD")).withColumn("complete", ~F.dayofmonth("day").between(13, 15))


def daily_revenue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = checks.revenue_by_day(with_status(daily_revenue(spark, sf_dir)))
    return out.select("day", "orders", "gross", "refunds", "net", "complete", F.col("by_channel")["1-URGENT"].alias("net_urgent"), F.col("by_channel")["unattributed"].alias("net_unattributed"), "currency")


def channel_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.channel_totals(with_status(daily_revenue(spark, sf_dir))).select("channel", "net", F.col("rank").cast("int").alias("rank"))


def daily_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.email(events_feed(spark, sf_dir)).drop("events")


def money_of(*totals: Decimal | None) -> str:
    """The type that totals are shown in: MONEY, as in SQL, or a wider one if that can't hold them."""
    return MONEY if all(t is None or abs(t) < 10**12 for t in totals) else checks.TOTAL


def overview_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = checks.revenue_totals(with_status(daily_revenue(spark, sf_dir))).first()
    kind = money_of(row["gross"], row["refunds"], row["net"])
    return spark.createDataFrame([row], f"days long, gross {kind}, refunds {kind}, net {kind}, incomplete_days long")


SPEC = Source(
    "orders", "csv", ("order_id",), "created_at",
    {
        "order_id": Field(("order_key", "o_orderkey"), "string", True), "created_at": Field(("o_orderdate",), "timestamp", True), "channel": Field(("o_orderpriority",), "string", True, "channel"),
        "gross": Field(("amount", "o_totalprice"), "money", True), "currency": Field(("currency",), "string", False, "uppercase"), "customer_email": Field(("email",), "string", False, "lowercase"),
    },
)
TENANT = Tenant("bench", "Bench", "USD", {"orders": "*"}, {"channel": LABELS})


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw records: three decimals in every 11th price, a blank date in every 13th, a null alias before the price in every 17th."""
    o = table(spark, sf_dir, "orders")
    when = lambda n, c: F.when(F.col("o_orderkey") % n == 0, c)
    price = F.col("o_totalprice").cast(MONEY).cast("string")
    payload = F.map_filter(
        F.create_map(
            F.lit("o_orderkey"), F.col("o_orderkey").cast("string"), F.lit("o_orderpriority"), F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("\u00a0")),
            F.lit("o_totalprice"), when(11, F.concat(price, F.lit("5"))).otherwise(price), F.lit("o_orderdate"), when(13, F.lit("  ")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
            F.lit("amount"), when(17, F.lit("")), F.lit("email"), F.concat(F.lit("User"), F.col("o_custkey"), F.lit("@Example.COM")),
        ),
        lambda k, v: v.isNotNull(),
    )
    return o.select(F.lit(1).cast("long").alias("file_load_id"), F.col("o_orderkey").alias("line_no"), F.to_json(payload).alias("payload"), F.lit(None).cast("string").alias("error"), F.lit("v1").alias("schema_version"))


def label_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = mapping.map_rows(raw_orders(spark, sf_dir), SPEC, TENANT).where("held is null")
    return good.select("line_no", "k", "event_day", "channel", "channel_raw", "gross", "currency", "customer_email")


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = mapping.quarantined(mapping.map_rows(raw_orders(spark, sf_dir), SPEC, TENANT))
    return held.select("line_no", "ref", "reason", F.get_json_object("detail", "$.field").alias("field"), F.get_json_object("detail", "$.value").alias("value"))


RAW_SQL = """raw AS (SELECT o_orderkey AS k, o_orderpriority AS label, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS price, o_orderdate AS placed, o_custkey,
CASE WHEN o_orderkey % 13 = 0 THEN 'missing_required' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unmapped_value' WHEN o_orderkey % 17 = 0 THEN 'missing_required' WHEN o_orderkey % 11 = 0 THEN 'bad_value' END AS reason,
CASE WHEN o_orderkey % 13 = 0 THEN 'created_at' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'channel' WHEN o_orderkey % 17 = 0 THEN 'gross' WHEN o_orderkey % 11 = 0 THEN 'gross' END AS field FROM orders)"""


def coerce_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of each event's time and value, of which some are good."""
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    money = F.concat(F.lit("\u00a0 "), F.when(F.col("event_id") % 4 == 0, F.concat((F.col("event_id") % 1000).cast("string"), F.lit(".5"))).when(F.col("event_id") % 4 == 1, F.concat(F.lit("-"), (F.col("event_id") % 1000).cast("string"))).when(F.col("event_id") % 4 == 2, F.concat((F.col("event_id") % 1000).cast("string"), F.lit(".005"))).otherwise(F.lit("12,50")))
    day = F.when(F.col("event_id") % 5 == 0, F.lit("2024-02-30")).when(F.col("event_id") % 5 == 1, F.date_format("ts", "yyyy/MM/dd")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return e.select("event_id", F.convert_timezone(F.current_timezone(), F.lit("UTC"), coerce.timestamp(coerce.present(text)).cast("timestamp_ntz")).alias("at"), coerce.date(coerce.present(day)).alias("day"), coerce.money(coerce.present(money)).alias("amount"), coerce.utc_day(text).alias("utc_day"))


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    columns = [F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority"), F.col("o_totalprice").cast(MONEY).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus"))]
    return o.select("o_orderkey", coerce.content_hash(columns).alias("content_hash"), coerce.natural_key([F.col("o_orderkey").cast("string"), F.col("o_orderstatus")]).alias("natural_key"))


# Line items as redelivered records: the key isn't unique, files are the months of shipping.


def deliveries_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    file_id = F.year("l_shipdate") * 12 + F.month("l_shipdate")
    rows = li.select(
        F.concat_ws("|", "l_orderkey", "l_linenumber").alias("k"), F.col("l_suppkey").alias("supplier"), F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").cast(MONEY).alias("amount"), F.to_date("l_shipdate").alias("event_day"), file_id.cast("long").alias("file_load_id"),
        (F.col("l_partkey") * 1000 + F.col("l_quantity").cast("long")).alias("line_no"), (F.col("l_extendedprice") * 100).cast("long").alias("tie"), F.col("l_suppkey").alias("tie2"),
    )
    return rows.withColumn("content_hash", coerce.content_hash([F.col("supplier"), F.col("flag")])).withColumn("day", F.col("event_day"))


LINE_ORDER = ("file_load_id", "line_no", "tie", "tie2")


def merged_lines(spark: SparkSession, sf_dir: str) -> merge.Merged:
    return merge.merge(_no_lines(spark), deliveries_of_lines(spark, sf_dir), "k", ["supplier", "flag", "amount"], LINE_ORDER)


def _no_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "k string, supplier long, flag string, amount decimal(14,2), content_hash string, posting_day date, first_file_load_id long, last_file_load_id long, times_seen int")


def natural_key_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_lines(spark, sf_dir).state.select("k", "supplier", "flag", "posting_day", "first_file_load_id", "last_file_load_id", F.col("times_seen").cast("long").alias("times_seen"))


def upsert_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.outcome_counts(merged_lines(spark, sf_dir).outcomes)


def conflict_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = merge.conflicts(merged_lines(spark, sf_dir).outcomes)
    return c.select("natural_key", "file_load_id", "line_no", *[F.get_json_object(side, f"$.{x}").alias(f"{side}_{x}") for side in ("previous", "incoming") for x in ("supplier", "flag")])


LINES_SQL = """lines AS (SELECT CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS k, l_suppkey AS supplier, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS file_load_id,
l_partkey * 1000 + CAST(trunc(l_quantity) AS BIGINT) AS line_no, CAST(trunc(l_extendedprice * 100) AS BIGINT) AS tie FROM lineitem),
steps AS (SELECT *, lag(supplier) OVER w AS p_supplier, lag(flag) OVER w AS p_flag, row_number() OVER w AS n FROM lines WINDOW w AS (PARTITION BY k ORDER BY file_load_id, line_no, tie, supplier)),
outcomes AS (SELECT *, CASE WHEN n = 1 THEN 'inserted' WHEN supplier = p_supplier AND flag = p_flag THEN 'unchanged' ELSE 'updated' END AS outcome FROM steps)"""


#: Files from this one on (June 1997) come later.
LATER = 1997 * 12 + 6


def later_lines(spark: SparkSession, sf_dir: str, retry: bool = False) -> merge.Merged:
    """The later deliveries, merged into the state that the earlier ones left; retry: as rows let go from a hold."""
    lines = deliveries_of_lines(spark, sf_dir)
    columns = ["supplier", "flag", "amount"]
    prior = merge.merge(_no_lines(spark), lines.where(F.col("file_load_id") < LATER), "k", columns, LINE_ORDER).state
    return merge.merge(prior, lines.where(F.col("file_load_id") >= LATER), "k", columns, LINE_ORDER, retry)


def upsert_into_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return later_lines(spark, sf_dir).state.select("k", "supplier", "flag", "posting_day", "first_file_load_id", "last_file_load_id", F.col("times_seen").cast("long").alias("times_seen"))


def outcomes_on_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.outcome_counts(later_lines(spark, sf_dir).outcomes)


def retried_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return later_lines(spark, sf_dir, retry=True).state.select("k", "supplier", "flag", "posting_day", "first_file_load_id", "last_file_load_id", F.col("times_seen").cast("long").alias("times_seen"))


def orphan_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.orphans(refunds_feed(spark, sf_dir), orders_feed(spark, sf_dir)).select("refund_id", "order_id", "amount", "posting_day")


def resolved_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refunds held while every fiftieth order was hidden, let go when the half of those have come."""
    refunds = refunds_feed(spark, sf_dir)
    held = marts.orphans(refunds, orders_feed(spark, sf_dir)).select(F.col("refund_id").alias("ref")).distinct()
    arrived = orders_feed(spark, sf_dir, hidden=False).where("order_id % 100 <> 0")
    return marts.resolved(held, refunds, arrived)


def expected_vs_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = checks.promised_or_loaded(weeks(spark), week_loads(spark, sf_dir))
    return out.select("source", "batch", "expected", "covers_from", "covers_to", "path", "status", "rows_seen", "schema_version", "alias")


def check_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.deliveries(weeks(spark), week_loads(spark, sf_dir), F.lit(AS_OF).cast("date"))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.freshness(weeks(spark), week_loads(spark, sf_dir), F.lit(AS_OF).cast("date"))


def _many_promised(spark: SparkSession) -> DataFrame:
    """The weeks, promised by four sources: one out of the known order, one of which nothing came."""
    return weeks(spark).drop("source").crossJoin(F.broadcast(spark.createDataFrame([("orders",), ("ad_spend",), ("surveys",), ("refunds",)], "source string")))


def _many_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = F.array(F.lit("orders"), F.lit("surveys"), F.lit("refunds"))
    return week_loads(spark, sf_dir).withColumn("source", F.explode(of)).where("source <> 'refunds' or batch > 2")


def freshness_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.freshness(_many_promised(spark), _many_loads(spark, sf_dir), F.lit(AS_OF).cast("date"))


def expected_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promised and loaded batches of several sources, with their place in display order."""
    found = checks.promised_or_loaded(_many_promised(spark), _many_loads(spark, sf_dir))
    place = F.row_number().over(Window.orderBy(checks.source_rank().asc_nulls_last(), "source", "batch"))  # one row a batch
    return found.select(place.alias("place"), "source", "batch", "expected", "status")


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of as many runs as there are orders."""
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("succeeded").alias("status"), F.col("o_orderdate").alias("finished_at"))
    return checks.latest_run(runs)


def missing_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend by promised day, null where its week didn't load."""
    loads = week_loads(spark, sf_dir).where("status = 'loaded'").select("batch", F.lit(True).alias("l"))
    promised = weeks(spark).join(loads, "batch", "left").select(F.lit("ad_spend").alias("source"), "covers_from", "covers_to", F.coalesce("l", F.lit(False)).alias("loaded"))
    e = events_feed(spark, sf_dir).where("weekofyear(posting_day) not in (3, 4, 5)")
    spend = e.groupBy(F.col("posting_day").alias("spend_date"), "campaign_id").agg(F.sum("amount").cast(MONEY).alias("spend"))
    spend = spend.select("spend_date", "campaign_id", F.lit("email").alias("platform"), "spend", F.lit("USD").alias("currency"), F.lit("v1").alias("schema_version"))
    return marts.marketing(promised, spend)


CLOSED = [(1, "2024-01-01", "2024-01-07"), (2, "2024-01-08", "2024-01-14"), (4, "2024-01-22", "2024-01-28")]
CLOSED_SQL = "(VALUES " + ", ".join(f"({f}, DATE '{a}', DATE '{b}')" for f, a, b in CLOSED) + ") AS c(file_load_id, covers_from, covers_to)"


def frozen_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events_feed(spark, sf_dir).withColumn("event_day", F.col("posting_day")).withColumn("file_load_id", F.col("event_id") % 5)
    closed = spark.createDataFrame(CLOSED, "file_load_id long, a string, b string").select("file_load_id", F.to_date("a").alias("covers_from"), F.to_date("b").alias("covers_to"))
    return merge.posting_days(e, closed, F.lit(AS_OF).cast("date"))


def freeze_posting_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frozen_events(spark, sf_dir).select("event_id", "file_load_id", "event_day", F.col("day").alias("posting_day"))


def late_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four-branch audit over events; the other three feeds are booked on their own days, but for large orders."""
    e = frozen_events(spark, sf_dir).withColumn("posting_day", F.col("day")).select(F.col("event_id").cast("string").alias("event_id"), "occurred_at", "campaign_id", "posting_day")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderdate").alias("created_at"), F.col("o_totalprice").cast(MONEY).alias("gross"), F.col("o_orderpriority").alias("channel"), F.when(F.col("o_orderkey") % 97 == 0, F.date_add("o_orderdate", 40)).otherwise(F.to_date("o_orderdate")).alias("posting_day"))
    r = refunds_feed(spark, sf_dir).select("refund_id", F.col("posting_day").alias("refunded_at"), F.col("order_id").cast("string").alias("order_id"), "amount", F.when(F.col("order_id") % 89 == 0, F.date_add("posting_day", 9)).otherwise(F.col("posting_day")).alias("posting_day"))
    s = e.select(F.col("campaign_id"), F.to_date("occurred_at").alias("spend_date"), F.lit("email").alias("platform"), F.lit(1).cast(MONEY).alias("spend"), F.to_date("occurred_at").alias("posting_day"))
    return marts.late_postings(o, r, e, s)


#: Windows of deliveries of lines that have arrived.
ARRIVED = [("lines", "1997-06-20", "1997-07-10"), ("ad_spend", "1997-07-05", "1997-07-15")]
ARRIVED_SQL = "(VALUES " + ", ".join(f"('{n}', DATE '{x}', DATE '{y}')" for n, x, y in ARRIVED) + ") AS a(source, covers_from, covers_to)"


def dirty_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that the later deliveries of lines and all refunds dirty, with those that arrived deliveries cover."""
    changed = merge.changed_days(later_lines(spark, sf_dir).outcomes, "lines")
    r = refunds_feed(spark, sf_dir).select(F.col("posting_day").alias("day")).distinct().withColumn("sources", F.array(F.lit("refunds")))
    arrived = spark.createDataFrame(ARRIVED, "source string, a string, b string").select("source", F.to_date("a").alias("covers_from"), F.to_date("b").alias("covers_to"))
    out = merge.united_days(changed, r, merge.covered_days(arrived))
    return out.select("day", F.array_join("sources", ", ").alias("sources"), display.cause(F.col("sources")).alias("cause"))


def released_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that refunds dirty when their orders come at last."""
    refunds = refunds_feed(spark, sf_dir)
    return refunds.join(resolved_refunds(spark, sf_dir).withColumnRenamed("ref", "refund_id"), "refund_id", "left_semi").select(F.col("posting_day").alias("day")).distinct()


def restatement_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tenth of the events that came late moved, and what a withdrawn campaign takes away."""
    e = events_feed(spark, sf_dir)
    early, full = marts.email(e.where("event_id % 10 <> 0")), marts.email(e.where("coalesce(campaign_id, '') <> 'c7'"))
    return marts.restated(early, full, marts.EMAIL)


def restatements_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = restatement_diff(spark, sf_dir).withColumn("mart", F.lit("daily_email")).withColumn("run_id", F.dayofmonth("day").cast("long") % 3)
    r = r.withColumn("cause", F.when(F.col("metric") == "opens", "late or changed records in: ad_spend, refunds").otherwise("late or changed records in: email_events"))
    out = checks.restatement_days(r)
    return out.select("day", "n", F.array_join(F.transform("runs", lambda x: x.cast("string")), ",").alias("runs"), F.array_join("sources", ",").alias("sources"), "marts")


def latest_restatements(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = restatement_diff(spark, sf_dir).withColumn("mart", F.lit("daily_email")).withColumn("run_id", F.lit(1))
    return checks.latest_restatements(r).select("day", "dimension", "metric", "previous", "current")


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = week_loads(spark, sf_dir).where("status = 'loaded'").select("batch", F.lit(True).alias("l"))
    promised = weeks(spark).join(loads, "batch", "left").select(F.lit("orders").alias("source"), "covers_from", "covers_to", F.coalesce("l", F.lit(False)).alias("loaded"))
    days = events_feed(spark, sf_dir).select(F.date_add("posting_day", 20).alias("day")).distinct()
    return marts.completeness(days, promised)


def finance_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported sums of all orders by day, wrong on some days and for some days without a mart row."""
    o = orders_feed(spark, sf_dir, hidden=False)
    reported = o.groupBy(F.col("posting_day").alias("day")).agg(F.sum("gross").cast(MONEY).alias("g"))
    off = F.when(F.dayofmonth("day") == 5, F.lit(1.25)).otherwise(F.lit(0)).cast(MONEY)
    reported = reported.select("day", (F.col("g") + off).cast(MONEY).alias("gross_reported"), F.col("g").alias("net_reported"), F.lit("USD").alias("currency"))
    mart = marts.revenue(o.where("dayofmonth(posting_day) <> 9"), refunds_feed(spark, sf_dir).where("dayofmonth(posting_day) not in (1, 9)"))
    return checks.finance(reported, mart)


def all_holds(spark: SparkSession, sf_dir: str, most: int | None) -> DataFrame:
    """Every quarantined order, two schema events and every conflict of lines."""
    loads = spark.createDataFrame([(1, 3, "orders/batch_03.csv", 12), (24000, 4, "orders/batch_04.csv", 13)], "id long, batch int, path string, run_id long")
    at = lambda hours: F.lit("2024-02-01").cast("timestamp_ntz") + F.make_interval(hours=hours)
    q = quarantine_rows(spark, sf_dir).select(F.lit(1).cast("long").alias("file_load_id"), F.lit("orders").alias("source"), "ref", "reason", F.to_json(F.struct("value", "field")).alias("detail"), at(F.lit(1)).alias("at"))
    e = spark.createDataFrame([(1, "orders", "alias_used", '{"field":"gross","alias":"amount"}'), (9, "refunds", "unknown_columns", '{"columns":"x"}')], "file_load_id long, source string, kind string, detail string").withColumn("at", at(F.lit(2)))
    c = merge.conflicts(merged_lines(spark, sf_dir).outcomes).withColumn("source", F.lit("lines")).withColumn("at", at((F.col("file_load_id") % 7).cast("int")))
    return checks.holds(q, e, c, loads, most)


def holds_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_holds(spark, sf_dir, None).select("kind", "source", "batch", "ref", "reason", "run_id", "at")


def holds_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 300 of all holds, as the feed has them."""
    return all_holds(spark, sf_dir, 300).select("kind", "batch", "ref")


def hold_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of the holds of orders, what identifies them first, and of schema events with their file."""
    found = all_holds(spark, sf_dir, None).where("source <> 'lines'")
    return found.select("kind", "ref", "reason", F.array_join(checks.shown_detail(F.col("detail")), "; ").alias("detail"))


def display_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts, changes and stamps as reports show them."""
    o = table(spark, sf_dir, "orders")
    amount = (F.col("o_totalprice").cast(MONEY) - F.lit(100000).cast(MONEY)).cast(MONEY)
    currency = F.when(F.col("o_orderkey") % 3 == 0, "USD").when(F.col("o_orderkey") % 3 == 1, "EUR").otherwise("CHF")
    return o.select("o_orderkey", display.money(amount).alias("money"), display.delta(F.col("o_custkey") - 500, F.lit(False)).alias("delta"), display.metric(amount, display.is_money_metric(F.lit("daily_revenue"), F.lit("gross"))).alias("metric"), display.symbol(currency).alias("symbol"), display.stamp(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("stamp"))


# ---- whole runs over delivery files that the tables are written to


def _folder(spark: SparkSession) -> str:
    """A new folder that the driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
    path = f"{named.rstrip('/')}/deliveries-{uuid.uuid4().hex}"
    spark.sparkContext._tidemark_deliveries = [*getattr(spark.sparkContext, "_tidemark_deliveries", []), path]
    return path


def remove(spark: SparkSession) -> None:
    """Deletes the delivery files and stores that queries of this session have made; frames that read them are of no use afterwards."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in getattr(spark.sparkContext, "_tidemark_deliveries", []):
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    spark.sparkContext._tidemark_deliveries = []


def _deliver(rows: DataFrame, base: str, source: str, kind: str) -> None:
    """rows as files base/source/batch_N, one for each value of their column batch."""
    to = f"{base}/{source}"
    out = rows.repartition("batch").write.partitionBy("batch")
    if kind == "csv":
        out.csv(f"{to}-parts", header=True, quote='"', escape='"', emptyValue="")
    elif kind == "json":
        out.json(f"{to}-parts")
    else:  # lines as they are
        out.text(f"{to}-parts")
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(to).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(to))
    for folder in fs.listStatus(path(f"{to}-parts")):
        batch = folder.getPath().getName().removeprefix("batch=")
        for k, part in enumerate(f for f in (fs.listStatus(folder.getPath()) if folder.isDirectory() else []) if f.getPath().getName().startswith("part-")):
            fs.rename(part.getPath(), path(f"{to}/{'' if not k else f'{k}-'}batch_{int(batch):02}.{kind}"))


#: Sources of the run: the money column of later orders has another name.
RUN_SOURCES = {
    "orders": Source("orders", "csv", ("order_id",), "created_at", {
        "order_id": Field(("order_id",), "string", True), "created_at": Field(("created_at",), "timestamp", True), "channel": Field(("channel",), "string", True, "channel"), "gross": Field(("gross", "total"), "money", True),
        "currency": Field(("currency",), "string", False, "uppercase"), "customer_email": Field(("customer_email",), "string", False, "lowercase")}),
    "refunds": Source("refunds", "csv", ("refund_id",), "refunded_at", {
        "refund_id": Field(("refund_id",), "string", True), "refunded_at": Field(("refunded_at",), "timestamp", True), "order_id": Field(("order_id",), "string", True), "amount": Field(("amount",), "money", True), "currency": Field(("currency",), "string", False, "uppercase")}),
    "email_events": Source("email_events", "ndjson", ("event_id",), "occurred_at", {
        "event_id": Field(("event_id",), "string", True), "occurred_at": Field(("occurred_at",), "timestamp", True), "type": Field(("type",), "string", True, "event_type"), "email": Field(("email",), "string", False, "lowercase"), "campaign_id": Field(("campaign_id",), "string")}),
}
RUN_LABELS = {"channel": LABELS, "event_type": {k: k for k in ("delivered", "open", "click", "unsubscribe", "bounce")}}
STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _booked(at: str) -> Column:
    """Seven years of days on sixty, so that a run has days worth a partition each."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.datediff(at, F.lit("1995-01-01")) % 60)
    return F.date_format(day, STAMP)


def delivered(spark: SparkSession, sf_dir: str, sources: tuple[str, ...], phases: tuple[str, ...]) -> TenantSession:
    """The tenant's tables after a run over the tables' rows as files: orders and refunds by year, events by week."""
    base = _folder(spark)
    with cleaned(spark):
        if "orders" in sources:
            o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"), _booked("o_orderdate").alias("created_at"), F.concat(F.lit(" "), "o_orderpriority").alias("channel"), F.col("o_totalprice").cast(MONEY).cast("string").alias("gross"), F.lit("usd").alias("currency"), F.year("o_orderdate").alias("batch"))
            _deliver(o.where("batch < 1998"), base, "orders", "csv")
            _deliver(o.where("batch >= 1998").withColumnRenamed("gross", "total"), base, "orders-later", "csv")
        if "refunds" in sources:
            r = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
            refund_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast(MONEY), F.date_format("l_shipdate", "yyyyMMdd"))
            r = r.select(refund_id.alias("refund_id"), _booked("l_shipdate").alias("refunded_at"), F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_extendedprice").cast(MONEY).cast("string").alias("amount"), F.lit("USD").alias("currency"), F.year("l_shipdate").alias("batch"))
            _deliver(r, base, "refunds", "csv")
        if "email_events" in sources:
            e = events_feed(spark, sf_dir)
            e = e.select(F.col("event_id").cast("string").alias("event_id"), F.date_format("occurred_at", STAMP).alias("occurred_at"), F.upper("type").alias("type"), "campaign_id", F.weekofyear("occurred_at").alias("batch"))
            _deliver(e, base, "email_events", "json")
    paths = {"orders": "orders*/batch_*.csv", "refunds": "refunds/batch_*.csv", "email_events": "email_events/batch_*.json"}
    tenant = Tenant("bench", "Bench", "USD", {n: paths[n] for n in sources}, RUN_LABELS)
    run_tenant(spark, Config(base, RUN_SOURCES, {"bench": tenant}), f"{base}/store", "bench", phases=phases, now=datetime(2024, 2, 15, 12))
    return TenantSession(spark, f"{base}/store", "bench")


def delivered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after the files have come in."""
    s = delivered(spark, sf_dir, ("orders", "refunds"), ("ingest",))
    return s.read("raw.file_loads").select("source", "path", "batch", "schema_version", "status", "rows_seen", "rows_committed", "attempts", "run_id", F.array_join("columns", ",").alias("columns"))


def delivered_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue mart after a whole run."""
    return delivered(spark, sf_dir, ("orders", "refunds"), ("ingest", "stage", "marts")).read("mart.daily_revenue").select("day", "channel", "orders", "gross", "refunds", "net", "currency", "complete")


def delivered_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The email mart after a whole run."""
    return delivered(spark, sf_dir, ("email_events",), ("ingest", "stage", "marts")).read("mart.daily_email").select("day", "campaign_id", "delivered", "opens", "clicks", "unsubscribes")


def delivered_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a whole run holds: orders without a label, and refunds whose order isn't known."""
    s = delivered(spark, sf_dir, ("orders", "refunds"), ("ingest", "stage", "marts"))
    return s.read("ops.quarantine").groupBy("source", "reason").agg(F.count("*").alias("n"), F.count_distinct("ref").alias("refs"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        daily_revenue, daily_revenue_rollup, channel_totals, daily_email, overview_totals, label_normalize, quarantine_rows, coerce_strict, content_hash, natural_key_upsert, upsert_outcomes, conflict_history,
        orphan_refunds, resolved_refunds, expected_vs_loaded, check_deliveries, freshness, missing_is_null, freeze_posting_day, late_postings, dirty_days, restatement_diff, restatements_by_day, latest_restatements,
        completeness, finance_reconcile, holds_feed, holds_shown, hold_details, display_formats, upsert_into_prior, outcomes_on_prior, retried_holds, released_days, freshness_by_source, expected_by_rank, latest_run,
        delivered_files, delivered_revenue, delivered_email, delivered_holds,
    )
    return {f.__name__: f for f in own}


# ---- the same in SQL

FROZEN = f"frozen AS (SELECT events_feed.*, event_id % 5 AS file_load_id, CASE WHEN EXISTS (SELECT 1 FROM {CLOSED_SQL} WHERE c.file_load_id <> event_id % 5 AND covers_from <= events_feed.posting_day AND events_feed.posting_day <= covers_to) THEN DATE '{AS_OF}' ELSE posting_day END AS day FROM events_feed)"
EMAIL_COUNTS = "count(*) FILTER (WHERE type = 'delivered') AS delivered, count(*) FILTER (WHERE type = 'open') AS opens, count(*) FILTER (WHERE type = 'click') AS clicks, count(*) FILTER (WHERE type = 'unsubscribe') AS unsubscribes"
RESTATED = f"""{EVENTS},
old AS (SELECT posting_day AS day, coalesce(campaign_id, '(none)') AS dimension, {EMAIL_COUNTS} FROM events_feed WHERE event_id % 10 <> 0 GROUP BY ALL),
new AS (SELECT posting_day AS day, coalesce(campaign_id, '(none)') AS dimension, {EMAIL_COUNTS} FROM events_feed WHERE coalesce(campaign_id, '') <> 'c7' GROUP BY ALL),
moved AS ({" UNION ALL ".join(f"SELECT old.day, old.dimension, '{m}' AS metric, CAST(old.{m} AS DECIMAL(14,2)) AS previous, CAST(coalesce(new.{m}, 0) AS DECIMAL(14,2)) AS current FROM old LEFT JOIN new ON old.day = new.day AND old.dimension = new.dimension WHERE old.{m} <> coalesce(new.{m}, 0)" for m in ("delivered", "opens", "clicks", "unsubscribes"))})"""
ROLLED = f"{REVENUE}, stored AS (SELECT *, day(day) NOT BETWEEN 13 AND 15 AS complete FROM revenue)"
DELIVERED = f"{LOADS}, promised AS (SELECT * FROM {WEEKS_SQL})"
SPENT = f"""{EVENTS}, {DELIVERED},
days AS (SELECT CAST(d AS DATE) AS day, bool_and(loads.batch IS NOT NULL) AS complete FROM (SELECT promised.batch, unnest(generate_series(covers_from, covers_to, INTERVAL 1 DAY)) AS d FROM promised) x LEFT JOIN loads ON loads.batch = x.batch AND status = 'loaded' GROUP BY d)"""


HELD = f"""{RAW_SQL}, {LINES_SQL}, fed AS (SELECT 'quarantine' AS kind, 'orders' AS source, 3 AS batch, '1:' || CAST(k AS VARCHAR) AS ref, reason, CAST(12 AS BIGINT) AS run_id, TIMESTAMP '2024-02-01 01:00:00' AS at FROM raw WHERE reason IS NOT NULL
UNION ALL SELECT 'schema event', 'orders', 3, '', 'alias_used', 12, TIMESTAMP '2024-02-01 02:00:00' UNION ALL SELECT 'schema event', 'refunds', NULL, '', 'unknown_columns', NULL, TIMESTAMP '2024-02-01 02:00:00'
UNION ALL SELECT 'conflict', 'lines', CASE WHEN file_load_id = 24000 THEN 4 END, k, 'redelivered with different content', CASE WHEN file_load_id = 24000 THEN 13 END, TIMESTAMP '2024-02-01' + to_hours(file_load_id % 7) FROM outcomes WHERE outcome = 'updated')"""
MANY = f"""{DELIVERED}, promised_all AS (SELECT s AS source, batch, covers_from, covers_to FROM promised, unnest(['orders', 'ad_spend', 'surveys', 'refunds']) AS t(s)),
loads_all AS (SELECT s AS source, batch, status FROM loads, unnest(['orders', 'surveys', 'refunds']) AS t(s) WHERE s <> 'refunds' OR batch > 2)"""
DELIVERIES = """delivered AS (SELECT 'orders' AS source, CASE WHEN year(o_orderdate) < 1998 THEN 'orders' ELSE 'orders-later' END || '/batch_' || CAST(year(o_orderdate) AS VARCHAR) || '.csv' AS path, year(o_orderdate) AS batch, CASE WHEN year(o_orderdate) < 1998 THEN 'v1' ELSE 'gross=total' END AS schema_version,
CASE WHEN year(o_orderdate) < 1998 THEN 'order_id,created_at,channel,gross,currency' ELSE 'order_id,created_at,channel,total,currency' END AS columns FROM orders
UNION ALL SELECT 'refunds', 'refunds/batch_' || CAST(year(l_shipdate) AS VARCHAR) || '.csv', year(l_shipdate), 'v1', 'refund_id,refunded_at,order_id,amount,currency' FROM lineitem WHERE l_returnflag = 'R')"""
RUN_REVENUE = """sold AS (SELECT o_orderkey AS order_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'paid_social' WHEN '2-HIGH' THEN 'paid_search' WHEN '3-MEDIUM' THEN 'email' ELSE 'direct' END AS channel, CAST(o_totalprice AS DECIMAL(14,2)) AS gross, DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60 AS INTEGER) AS day FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'),
back AS (SELECT order_id, amount, DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', shipped) % 60 AS INTEGER) AS day FROM (SELECT DISTINCT l_orderkey AS order_id, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(14,2)) AS amount, CAST(l_shipdate AS DATE) AS shipped FROM lineitem WHERE l_returnflag = 'R')),
o AS (SELECT day, channel, count(*) AS orders, sum(gross) AS gross FROM sold GROUP BY ALL),
r AS (SELECT back.day, coalesce(channel, 'unattributed') AS channel, sum(amount) AS refunds FROM back LEFT JOIN sold ON back.order_id = sold.order_id GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    shown = lambda c: f"CASE WHEN {c} < 0 THEN '(' || format('{{:,.2f}}', -CAST({c} AS DOUBLE)) || ')' ELSE format('{{:,.2f}}', CAST({c} AS DOUBLE)) END"
    return {
        "daily_revenue": f"WITH {REVENUE} SELECT * FROM revenue",
        "daily_revenue_rollup": f"""WITH {ROLLED} SELECT day, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(gross) AS DECIMAL(14,2)) AS gross, CAST(sum(refunds) AS DECIMAL(14,2)) AS refunds, CAST(sum(net) AS DECIMAL(14,2)) AS net, bool_and(complete) AS complete,
CAST(max(net) FILTER (WHERE dimension = '1-URGENT') AS DECIMAL(14,2)) AS net_urgent, CAST(max(net) FILTER (WHERE dimension = 'unattributed') AS DECIMAL(14,2)) AS net_unattributed, 'USD' AS currency FROM stored GROUP BY day""",
        "channel_totals": f"WITH {REVENUE} SELECT dimension AS channel, CAST(sum(net) AS DECIMAL(14,2)) AS net, CASE WHEN dimension = 'unattributed' THEN 7 END AS rank FROM revenue GROUP BY dimension",
        "daily_email": f"WITH {EVENTS} SELECT posting_day AS day, coalesce(campaign_id, '(none)') AS dimension, {EMAIL_COUNTS} FROM events_feed GROUP BY ALL",
        "overview_totals": f"WITH {ROLLED} SELECT count(DISTINCT day) AS days, CAST(sum(gross) AS DECIMAL(14,2)) AS gross, CAST(sum(refunds) AS DECIMAL(14,2)) AS refunds, CAST(sum(net) AS DECIMAL(14,2)) AS net, count(DISTINCT day) FILTER (WHERE NOT complete) AS incomplete_days FROM stored",
        "label_normalize": f"""WITH {RAW_SQL} SELECT k AS line_no, CAST(k AS VARCHAR) AS k, CAST(placed AS DATE) AS event_day, CASE label WHEN '1-URGENT' THEN 'paid_social' WHEN '2-HIGH' THEN 'paid_search' WHEN '3-MEDIUM' THEN 'email' ELSE 'direct' END AS channel, label AS channel_raw,
CAST(price AS DECIMAL(14,2)) AS gross, 'USD' AS currency, 'user' || CAST(o_custkey AS VARCHAR) || '@example.com' AS customer_email FROM raw WHERE reason IS NULL""",
        "quarantine_rows": f"WITH {RAW_SQL} SELECT k AS line_no, '1:' || CAST(k AS VARCHAR) AS ref, reason, field, CASE reason WHEN 'unmapped_value' THEN label WHEN 'bad_value' THEN price || '5' END AS value FROM raw WHERE reason IS NOT NULL",
        "coerce_strict": """SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('millisecond', ts) END AS at, CASE WHEN event_id % 5 > 1 THEN CAST(ts AS DATE) END AS day,
CASE event_id % 4 WHEN 0 THEN CAST(event_id % 1000 + 0.5 AS DECIMAL(14,2)) WHEN 1 THEN CAST(-(event_id % 1000) AS DECIMAL(14,2)) END AS amount, CAST(ts AS DATE) AS utc_day FROM events""",
        "content_hash": """SELECT o_orderkey, sha256('["' || CAST(o_orderkey AS VARCHAR) || '","' || strftime(o_orderdate, '%Y-%m-%d') || '","' || o_orderpriority || '","' || CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) || '",' || CASE WHEN o_orderkey % 2 = 0 THEN '"' || o_orderstatus || '"' ELSE 'null' END || ']') AS content_hash,
CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus AS natural_key FROM orders""",
        "natural_key_upsert": f"""WITH {LINES_SQL}, last AS (SELECT k, max(n) FILTER (WHERE outcome <> 'unchanged') AS n, max(n) AS times_seen, max(file_load_id) AS last_file_load_id FROM outcomes GROUP BY k)
SELECT last.k, o.supplier, o.flag, f.day AS posting_day, f.file_load_id AS first_file_load_id, last.last_file_load_id, last.times_seen FROM last JOIN outcomes o ON o.k = last.k AND o.n = last.n JOIN outcomes f ON f.k = last.k AND f.n = 1""",
        "upsert_outcomes": f"WITH {LINES_SQL} SELECT outcome, count(*) AS n, CAST(0 AS BIGINT) AS posted_late FROM outcomes GROUP BY outcome",
        "conflict_history": f"WITH {LINES_SQL} SELECT k AS natural_key, file_load_id, line_no, CAST(p_supplier AS VARCHAR) AS previous_supplier, p_flag AS previous_flag, CAST(supplier AS VARCHAR) AS incoming_supplier, flag AS incoming_flag FROM outcomes WHERE outcome = 'updated'",
        "orphan_refunds": f"WITH {ORDERS}, {REFUNDS} SELECT refund_id, order_id, amount, posting_day FROM refunds_feed WHERE order_id NOT IN (SELECT order_id FROM orders_feed)",
        "resolved_refunds": f"WITH {ORDERS}, {REFUNDS} SELECT DISTINCT refund_id AS ref FROM refunds_feed WHERE order_id NOT IN (SELECT order_id FROM orders_feed) AND order_id IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 100 <> 0)",
        "expected_vs_loaded": f"""WITH {DELIVERED} SELECT coalesce(promised.source, loads.source) AS source, CAST(coalesce(promised.batch, loads.batch) AS INTEGER) AS batch, promised.batch IS NOT NULL AS expected, covers_from, covers_to, 'events/batch_' || CAST(coalesce(promised.batch, loads.batch) AS VARCHAR) AS path,
coalesce(status, 'missing') AS status, rows_seen, schema_version, coalesce(schema_version <> 'v1', false) AS alias FROM promised FULL JOIN loads ON promised.batch = loads.batch""",
        "check_deliveries": f"""WITH {DELIVERED} SELECT promised.source, CAST(promised.batch AS INTEGER) AS batch, CAST(covers_from AS VARCHAR) || ' to ' || CAST(covers_to AS VARCHAR) AS covers, 'events/batch_' || CAST(promised.batch AS VARCHAR) AS expected_path, coalesce(status, 'missing') AS status, rows_seen AS rows, schema_version AS schema,
CASE WHEN coalesce(status, 'missing') <> 'loaded' THEN CAST(greatest(0, date_diff('day', covers_to, DATE '{AS_OF}') - 1) AS INTEGER) END AS overdue_days FROM promised LEFT JOIN loads ON promised.batch = loads.batch""",
        "freshness": f"""WITH {DELIVERED} SELECT promised.source, max(covers_to) FILTER (WHERE status = 'loaded') AS last_covered, max(covers_to) AS expected_through, CAST(greatest(0, date_diff('day', max(covers_to) FILTER (WHERE status = 'loaded'), max(covers_to))) AS INTEGER) AS stale_days,
count(*) FILTER (WHERE coalesce(status, '') <> 'loaded') AS missing FROM promised LEFT JOIN loads ON promised.batch = loads.batch GROUP BY promised.source""",
        "missing_is_null": f"""WITH {SPENT}, spend AS (SELECT posting_day AS day, campaign_id, CAST(sum(amount) AS DECIMAL(14,2)) AS spend FROM events_feed WHERE weekofyear(posting_day) NOT IN (3, 4, 5) GROUP BY ALL)
SELECT days.day, CASE WHEN spend.day IS NOT NULL THEN 'email' END AS platform, campaign_id, spend, CASE WHEN spend.day IS NOT NULL THEN 'USD' END AS currency, CASE WHEN spend.day IS NOT NULL THEN 'v1' END AS schema_version, complete FROM days LEFT JOIN spend ON days.day = spend.day""",
        "freeze_posting_day": f"WITH {EVENTS}, {FROZEN} SELECT event_id, file_load_id, posting_day AS event_day, day AS posting_day FROM frozen",
        "late_postings": f"""WITH {EVENTS}, {FROZEN}, {REFUNDS} SELECT 'email_events' AS source, CAST(event_id AS VARCHAR) AS natural_key, posting_day AS event_day, day AS posting_day, CAST(NULL AS DECIMAL(14,2)) AS amount, coalesce(campaign_id, '(none)') AS dimension FROM frozen WHERE day <> posting_day
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 40, CAST(o_totalprice AS DECIMAL(14,2)), o_orderpriority FROM orders WHERE o_orderkey % 97 = 0
UNION ALL SELECT 'refunds', refund_id, posting_day, posting_day + 9, amount, CAST(order_id AS VARCHAR) FROM refunds_feed WHERE order_id % 89 = 0""",
        "dirty_days": f"""WITH {LINES_SQL}, {REFUNDS}, marked AS (SELECT day, 'lines' AS s FROM outcomes WHERE outcome <> 'unchanged' AND file_load_id >= {LATER} UNION SELECT posting_day, 'refunds' FROM refunds_feed
UNION SELECT CAST(unnest(generate_series(covers_from, covers_to, INTERVAL 1 DAY)) AS DATE), source FROM {ARRIVED_SQL}) SELECT day, string_agg(s, ', ' ORDER BY s) AS sources, 'late or changed records in: ' || string_agg(s, ', ' ORDER BY s) AS cause FROM marked GROUP BY day""",
        "released_days": f"WITH {ORDERS}, {REFUNDS} SELECT DISTINCT posting_day AS day FROM refunds_feed WHERE order_id NOT IN (SELECT order_id FROM orders_feed) AND order_id IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 100 <> 0)",
        "upsert_into_prior": f"""WITH {LINES_SQL}, last AS (SELECT k, max(n) FILTER (WHERE outcome <> 'unchanged') AS n, max(n) AS times_seen, max(file_load_id) AS last_file_load_id FROM outcomes GROUP BY k HAVING max(file_load_id) >= {LATER})
SELECT last.k, o.supplier, o.flag, f.day AS posting_day, f.file_load_id AS first_file_load_id, last.last_file_load_id, last.times_seen FROM last JOIN outcomes o ON o.k = last.k AND o.n = last.n JOIN outcomes f ON f.k = last.k AND f.n = 1""",
        "outcomes_on_prior": f"WITH {LINES_SQL} SELECT outcome, count(*) AS n, CAST(0 AS BIGINT) AS posted_late FROM outcomes WHERE file_load_id >= {LATER} GROUP BY outcome",
        "retried_holds": f"""WITH {LINES_SQL}, counted AS (SELECT * FROM outcomes WHERE file_load_id < {LATER} OR outcome <> 'unchanged'),
last AS (SELECT k, max(n) FILTER (WHERE outcome <> 'unchanged') AS n, count(*) AS times_seen, max(file_load_id) AS last_file_load_id FROM counted GROUP BY k HAVING max(file_load_id) >= {LATER})
SELECT last.k, o.supplier, o.flag, f.day AS posting_day, f.file_load_id AS first_file_load_id, last.last_file_load_id, last.times_seen FROM last JOIN outcomes o ON o.k = last.k AND o.n = last.n JOIN outcomes f ON f.k = last.k AND f.n = 1""",
        "freshness_by_source": f"""WITH {MANY} SELECT p.source, max(covers_to) FILTER (WHERE status = 'loaded') AS last_covered, max(covers_to) AS expected_through,
CAST(greatest(0, coalesce(date_diff('day', max(covers_to) FILTER (WHERE status = 'loaded'), max(covers_to)), date_diff('day', max(covers_to), DATE '{AS_OF}') - 1)) AS INTEGER) AS stale_days,
count(*) FILTER (WHERE coalesce(status, '') <> 'loaded') AS missing FROM promised_all p LEFT JOIN loads_all l ON p.source = l.source AND p.batch = l.batch GROUP BY p.source""",
        "expected_by_rank": f"""WITH {MANY}, found AS (SELECT coalesce(p.source, l.source) AS source, CAST(coalesce(p.batch, l.batch) AS INTEGER) AS batch, p.batch IS NOT NULL AS expected, coalesce(status, 'missing') AS status FROM promised_all p FULL JOIN loads_all l ON p.source = l.source AND p.batch = l.batch)
SELECT CAST(row_number() OVER (ORDER BY CASE source WHEN 'orders' THEN 1 WHEN 'email_events' THEN 2 WHEN 'ad_spend' THEN 3 WHEN 'refunds' THEN 4 END NULLS LAST, source, batch) AS INTEGER) AS place, * FROM found""",
        "latest_run": "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'succeeded' END AS status, o_orderdate AS finished_at FROM orders ORDER BY o_orderkey DESC LIMIT 1",
        "delivered_files": f"""WITH {DELIVERIES} SELECT source, path, CAST(batch AS INTEGER) AS batch, schema_version, 'loaded' AS status, count(*) AS rows_seen, count(*) AS rows_committed, CAST(1 AS INTEGER) AS attempts, CAST(1 AS BIGINT) AS run_id, any_value(columns) AS columns FROM delivered GROUP BY source, path, batch, schema_version""",
        "delivered_revenue": f"""WITH {RUN_REVENUE} SELECT coalesce(o.day, r.day) AS day, coalesce(o.channel, r.channel) AS channel, CAST(coalesce(orders, 0) AS BIGINT) AS orders, CAST(coalesce(gross, 0) AS DECIMAL(14,2)) AS gross, CAST(coalesce(refunds, 0) AS DECIMAL(14,2)) AS refunds,
CAST(coalesce(gross, 0) - coalesce(refunds, 0) AS DECIMAL(14,2)) AS net, 'USD' AS currency, true AS complete FROM o FULL JOIN r ON o.day = r.day AND o.channel = r.channel""",
        "delivered_email": f"WITH {EVENTS} SELECT posting_day AS day, coalesce(campaign_id, '(none)') AS campaign_id, {EMAIL_COUNTS} FROM events_feed GROUP BY ALL",
        "delivered_holds": f"""WITH {RUN_REVENUE} SELECT 'orders' AS source, 'unmapped_value' AS reason, count(*) AS n, count(*) AS refs FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
UNION ALL SELECT 'refunds', 'unresolvable_reference', count(*), count(*) FROM back WHERE order_id NOT IN (SELECT order_id FROM sold)""",
        "restatement_diff": f"WITH {RESTATED} SELECT * FROM moved",
        "restatements_by_day": f"""WITH {RESTATED}, s AS (SELECT day, unnest(CASE WHEN metric = 'opens' THEN ['ad_spend', 'refunds'] ELSE ['email_events'] END) AS s FROM moved), t AS (SELECT day, string_agg(DISTINCT s, ',' ORDER BY s) AS sources FROM s GROUP BY day)
SELECT moved.day, count(*) AS n, CAST(day(moved.day) % 3 AS VARCHAR) AS runs, any_value(sources) AS sources, CAST(1 AS BIGINT) AS marts FROM moved JOIN t ON t.day = moved.day GROUP BY moved.day""",
        "latest_restatements": f"WITH {RESTATED} SELECT * FROM moved ORDER BY day DESC, dimension, metric LIMIT 500",
        "completeness": f"WITH {SPENT} SELECT x.day, coalesce(complete, true) AS complete FROM (SELECT DISTINCT posting_day + 20 AS day FROM events_feed) x LEFT JOIN days ON days.day = x.day",
        "finance_reconcile": f"""WITH all_orders AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(14,2)) AS gross FROM orders), {REFUNDS},
reported AS (SELECT day, CAST(sum(gross) + CASE WHEN day(day) = 5 THEN 1.25 ELSE 0 END AS DECIMAL(14,2)) AS g, CAST(sum(gross) AS DECIMAL(14,2)) AS n FROM all_orders GROUP BY day),
o AS (SELECT day, sum(gross) AS gross FROM all_orders WHERE day(day) <> 9 GROUP BY day), r AS (SELECT posting_day AS day, sum(amount) AS refunds FROM refunds_feed WHERE day(posting_day) NOT IN (1, 9) GROUP BY posting_day)
SELECT reported.day, g AS reported_gross, CAST(coalesce(gross, 0) AS DECIMAL(14,2)) AS mart_gross, CAST(g - coalesce(gross, 0) AS DECIMAL(14,2)) AS gross_diff, n AS reported_net, CAST(coalesce(gross, 0) - coalesce(refunds, 0) AS DECIMAL(14,2)) AS mart_net,
CAST(n - coalesce(gross, 0) + coalesce(refunds, 0) AS DECIMAL(14,2)) AS net_diff, g = coalesce(gross, 0) AS ties FROM reported LEFT JOIN o ON o.day = reported.day LEFT JOIN r ON r.day = reported.day""",
        "holds_feed": f"WITH {HELD} SELECT kind, source, batch, ref, reason, run_id, \"at\" FROM fed",
        "holds_shown": f"WITH {HELD} SELECT kind, batch, ref FROM fed ORDER BY kind, ref, batch NULLS LAST, \"at\" DESC, source, reason LIMIT 300",
        "hold_details": f"""WITH {RAW_SQL} SELECT 'quarantine' AS kind, '1:' || CAST(k AS VARCHAR) AS ref, reason, 'field: ' || field || CASE reason WHEN 'unmapped_value' THEN '; value: ' || label WHEN 'bad_value' THEN '; value: ' || price || '5' ELSE '' END AS detail FROM raw WHERE reason IS NOT NULL
UNION ALL SELECT 'schema event', '', 'alias_used', 'field: gross; alias: amount; file: orders/batch_03.csv' UNION ALL SELECT 'schema event', '', 'unknown_columns', 'columns: x; file: null'""",
        "display_formats": f"""WITH a AS (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(14,2)) - 100000 AS DECIMAL(14,2)) AS v FROM orders) SELECT o_orderkey, {shown("v")} AS money, CASE WHEN o_custkey < 500 THEN '(' || format('{{:,}}', 500 - o_custkey) || ')' ELSE '+' || format('{{:,}}', o_custkey - 500) END AS delta,
{shown("v")} AS metric, CASE o_orderkey % 3 WHEN 0 THEN '$' WHEN 1 THEN '€' ELSE 'CHF' END AS symbol, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp FROM a""",
    }
