"""Queries over the history of two tenants: a crash, a resume, repeated and late deliveries, broken lines, promises and a finance summary.

The tables' orders and events become both tenants' files, customers and users with
even numbers being of the first. Its runs: one over three years of orders that is
stopped in the second file, one over everything, one with nothing new, and one after
a delivery that repeats every 25th order, half of them changed. All queries read the
tables after these runs, which are made once a session and folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from datetime import date, datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import queries as q
from . import reads
from .config import Config, Tenant
from .plans.pipeline import RunFailed, run_tenant
from .store import TenantSession, cleaned

EAST, WEST = "east", "west"
TENANTS = (EAST, WEST)
YEARS, PROMISED, DELTA = range(1995, 2002), range(1995, 2003), 2003
CHUNK, NOW = 50, datetime(2024, 3, 10, 12)
_made: dict[tuple[str, str], dict[str, TenantSession]] = {}


def _window(batch: int) -> tuple[date, date]:
    first = date(2024, 1, 1) + timedelta(days=8 * (batch - 1995))
    return first, first + timedelta(days=7)


def _orders(spark: SparkSession, sf_dir: str, tenant: str) -> DataFrame:
    o = q.table(spark, sf_dir, "orders").where(F.col("o_custkey") % 2 == TENANTS.index(tenant))
    return o.select(F.col("o_orderkey").cast("string").alias("order_id"), q._booked("o_orderdate").alias("created_at"), F.col("o_orderpriority").alias("channel"), F.col("o_totalprice").cast(q.MONEY).alias("gross"), F.lit("usd").alias("currency"), F.year("o_orderdate").alias("batch"))


def _delivered(spark: SparkSession, sf_dir: str, base: str, t: str) -> None:
    o = _orders(spark, sf_dir, t)
    q._deliver(o.where("batch < 1998"), base, f"{t}/orders", "csv")
    q._deliver(o.where("batch >= 1998").withColumnRenamed("gross", "total"), base, f"{t}/orders-later", "csv")
    e = q.events_feed(spark, sf_dir).where(F.col("user_id") % 2 == TENANTS.index(t))
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), F.date_format("occurred_at", q.STAMP).alias("occurred_at"), F.upper("type").alias("type"), "campaign_id"))
    line = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("not json "), "event_id")).when(F.col("event_id") % 89 == 0, F.lit("[1, 2]")).otherwise(line)
    q._deliver(e.select(line.alias("value"), F.weekofyear("occurred_at").alias("batch")), base, f"{t}/email_events", "ndjson")
    # The client's own books: a dollar more on every seventh day of the month.
    day = F.to_date("created_at")
    books = o.groupBy(day.alias("date")).agg((F.sum("gross") + F.when(F.day("date") % 7 == 0, 1).otherwise(0)).cast(q.MONEY).alias("gross_reported"))
    books.select("date", "gross_reported", F.col("gross_reported").alias("net_reported"), F.lit("USD").alias("currency")).write.csv(f"{base}/{t}/finance_summary.csv", header=True)


def _promises(spark: SparkSession, base: str) -> None:
    promised = [{"tenant": t, "source": "orders", "batch": b, "path": f"{t}/orders/batch_{b}.csv", "covers_from": str(_window(b)[0]), "covers_to": str(_window(b)[1])} for t in TENANTS for b in PROMISED]
    spark.createDataFrame([(json.dumps({"batches": promised}),)], "value string").coalesce(1).write.text(f"{base}/manifest")


def _again(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("order_id").cast("long") % 50
    changed = (F.col("gross") + F.when(key == 0, 1).otherwise(0)).cast(q.MONEY)
    return _orders(spark, sf_dir, EAST).where(key.isin(0, 25)).withColumn("gross", changed).withColumn("batch", F.lit(DELTA))


def history(spark: SparkSession, sf_dir: str) -> dict[str, TenantSession]:
    """Both tenants' tables after their runs."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _made:
        base = q._folder(spark)
        own = {t: Tenant(t, t.title(), "USD", {"orders": f"{t}/orders*/batch_*.csv", "email_events": f"{t}/email_events/batch_*.ndjson"}, q.RUN_LABELS, manifest="manifest") for t in TENANTS}
        config = Config(base, {k: v for k, v in q.RUN_SOURCES.items() if k in ("orders", "email_events")}, own)
        run = lambda t, **more: run_tenant(spark, config, f"{base}/store", t, now=NOW, **more)

        def east() -> None:
            _delivered(spark, sf_dir, base, EAST)
            first = _orders(spark, sf_dir, EAST).where("batch = 1995").count()
            with suppress(RunFailed):
                run(EAST, source="orders", batches="1995-1997", crash_after_rows=first + CHUNK + 10, chunk_rows=CHUNK)
            run(EAST)
            run(EAST)
            q._deliver(_again(spark, sf_dir), base, f"{EAST}/orders-again", "csv")
            run(EAST)

        def west() -> None:
            _delivered(spark, sf_dir, base, WEST)
            run(WEST)

        # Tenants share nothing but the manifest, so their runs go side by side.
        with cleaned(spark), ThreadPoolExecutor(len(TENANTS)) as pool:
            _promises(spark, base)
            for done in [pool.submit(inheritable_thread_target(spark)(f)) for f in (east, west)]:
                done.result()
        _made.clear()
        _made[key] = {t: TenantSession(spark, f"{base}/store", t) for t in TENANTS}
    return _made[key]


def _both(spark: SparkSession, sf_dir: str, f: Callable[[TenantSession], DataFrame]) -> DataFrame:
    parts = [f(s).withColumn("tenant", F.lit(t)) for t, s in history(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1])


def chronicle_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of both tenants, with how often each came and which run loaded it."""
    return _both(spark, sf_dir, lambda s: s.read("raw.file_loads").select("source", "path", "batch", "schema_version", "status", "rows_seen", "rows_committed", "attempts", "run_id"))


def chronicle_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each file after crash, resume and repeats: none is lost, none there twice."""
    records = lambda s: s.read("raw.records").groupBy("file_load_id").agg(F.count("*").alias("n"), F.count_distinct("line_no").alias("numbers"), F.max("line_no").alias("last"))
    return _both(spark, sf_dir, lambda s: records(s).join(s.read("raw.file_loads").select(F.col("id").alias("file_load_id"), "path"), "file_load_id").select("path", "n", "numbers", "last"))


def chronicle_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs as they are shown, newest first: how each ended, what it was asked for, and what it did."""
    rows = [(t, r["id"], r["status"], r["files"], r["duplicates"], r["inserted"], r["restatements"], r["args"]["batches"], r["args"]["source"]) for t, s in history(spark, sf_dir).items() for r in reads.runs(s)]
    return spark.createDataFrame(rows, "tenant string, id long, status string, files int, duplicates int, inserted long, restatements long, batches string, source string")


def chronicle_promises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every promise and what became of it by the day of the runs."""
    return _both(spark, sf_dir, lambda s: reads.deliveries(s, NOW.date()).select("source", "batch", "covers", "expected_path", "status", "rows", "schema", "overdue_days"))


def chronicle_promised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that were promised or came: the late delivery wasn't promised."""
    return _both(spark, sf_dir, lambda s: reads.promised(s).select("source", "batch", "expected", "path", "status", "rows_seen", "alias", "attempts"))


def chronicle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the files' headers showed."""
    return _both(spark, sf_dir, lambda s: s.read("ops.schema_events").join(s.read("raw.file_loads").select(F.col("id").alias("file_load_id"), "path"), "file_load_id").select("source", "path", "kind", "detail"))


def chronicle_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is held, by source, reason and error."""
    return _both(spark, sf_dir, lambda s: s.read("ops.quarantine").groupBy("source", "reason", F.get_json_object("detail", "$.error").alias("error")).agg(F.count("*").alias("n"), F.count_distinct("ref").alias("refs")))


def chronicle_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged orders by day, after a merge that read only what its keys needed."""
    return _both(spark, sf_dir, lambda s: s.read("stg.orders").groupBy("posting_day").agg(F.count("*").alias("n"), F.sum("gross").cast(q.MONEY).alias("gross"), F.sum("times_seen").cast("long").alias("seen"), F.count_if(F.col("first_file_load_id") != F.col("last_file_load_id")).alias("again")))


def chronicle_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that came again with another amount."""
    amount = lambda c: F.get_json_object(c, "$.gross").cast(q.MONEY)
    return _both(spark, sf_dir, lambda s: s.read("ops.conflicts").select("source", "natural_key", amount("previous").alias("previous"), amount("incoming").alias("incoming")))


def chronicle_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the late delivery restated."""
    return _both(spark, sf_dir, lambda s: s.read("ops.restatements").select("mart", "day", "dimension", "metric", "previous", "current", "run_id", "cause"))


def chronicle_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clients' books against the marts."""
    config = lambda s: Config(s.root.removesuffix(f"/store/{s.tenant_id}"), {}, {})
    return _both(spark, sf_dir, lambda s: reads.finance(s, config(s)))


def chronicle_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The card of each tenant."""
    names = ("tenant", "display_name", "currency", "expected", "loaded", "missing", "days", "gross", "net", "incomplete_days", "restatements", "holds", "late_postings")
    cards = [reads.status(s) for s in history(spark, sf_dir).values()]
    rows = [tuple(c[n] for n in names) for c in cards]
    kind = q.money_of(*(c[n] for c in cards for n in ("gross", "net")))
    return spark.createDataFrame(rows, f"tenant string, display_name string, currency string, expected long, loaded long, missing long, days long, gross {kind}, net {kind}, incomplete_days long, restatements long, holds long, late_postings long")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (chronicle_ledger, chronicle_records, chronicle_runs, chronicle_promises, chronicle_promised, chronicle_events, chronicle_holds, chronicle_orders, chronicle_conflicts, chronicle_restated, chronicle_finance, chronicle_status)
    return {f.__name__: f for f in own}


# ---- the same in SQL

_LABEL = "CASE lower(o_orderpriority) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in q.LABELS.items()) + " END"
FEED = f"""o AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 2 = 0 THEN 'east' ELSE 'west' END AS tenant, CAST(o_totalprice AS DECIMAL(14,2)) AS gross, {_LABEL} AS channel, year(o_orderdate) AS batch,
  DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60 AS INTEGER) AS day FROM orders),
e AS (SELECT event_id AS id, CASE WHEN user_id % 2 = 0 THEN 'east' ELSE 'west' END AS tenant, week(ts) AS batch FROM events),
late AS (SELECT * FROM o WHERE tenant = 'east' AND id % 50 IN (0, 25)),
files AS (
  SELECT tenant, 'orders' AS source, tenant || '/orders' || CASE WHEN batch >= 1998 THEN '-later' ELSE '' END || '/batch_' || CAST(batch AS VARCHAR) || '.csv' AS path, CAST(batch AS INTEGER) AS batch, count(*) AS n,
         CASE WHEN tenant = 'west' THEN 1 WHEN batch <= 1996 THEN 4 ELSE 3 END AS attempts, CASE WHEN tenant = 'west' OR batch = 1995 THEN 1 ELSE 2 END AS run_id, CASE WHEN batch >= 1998 THEN 'gross=total' ELSE 'v1' END AS schema_version FROM o GROUP BY tenant, batch
  UNION ALL SELECT tenant, 'email_events', tenant || '/email_events/batch_' || lpad(CAST(batch AS VARCHAR), 2, '0') || '.ndjson', CAST(batch AS INTEGER), count(*), CASE WHEN tenant = 'west' THEN 1 ELSE 3 END, CASE WHEN tenant = 'west' THEN 1 ELSE 2 END, 'v1' FROM e GROUP BY tenant, batch
  UNION ALL SELECT 'east', 'orders', 'east/orders-again/batch_2003.csv', 2003, count(*), 1, 4, 'v1' FROM late HAVING count(*) > 0),
promises AS (SELECT tenant, CAST(b AS INTEGER) AS batch, tenant || '/orders/batch_' || CAST(b AS VARCHAR) || '.csv' AS path, DATE '2024-01-01' + CAST(8 * (b - 1995) AS INTEGER) AS covers_from, DATE '2024-01-01' + CAST(8 * (b - 1995) + 7 AS INTEGER) AS covers_to FROM (VALUES ('east'), ('west')) t(tenant), range(1995, 2003) r(b)),
staged AS (SELECT o.*, gross + CASE WHEN tenant = 'east' AND id % 50 = 0 THEN 1 ELSE 0 END AS now, tenant = 'east' AND id % 50 IN (0, 25) AS again FROM o WHERE channel IS NOT NULL),
moved AS (SELECT tenant, day, channel, CAST(sum(gross) AS DECIMAL(14,2)) AS previous, CAST(sum(now) AS DECIMAL(14,2)) AS current FROM staged GROUP BY tenant, day, channel HAVING sum(gross) <> sum(now))"""


def oracle_sql() -> dict[str, str]:
    return {
        "chronicle_ledger": f"WITH {FEED} SELECT tenant, source, path, batch, schema_version, 'loaded' AS status, n AS rows_seen, n AS rows_committed, CAST(attempts AS INTEGER) AS attempts, CAST(run_id AS BIGINT) AS run_id FROM files",
        "chronicle_records": f"WITH {FEED} SELECT tenant, path, n, n AS numbers, n AS last FROM files",
        "chronicle_runs": f"""WITH {FEED}, c AS (SELECT count(*) FILTER (tenant = 'east' AND run_id < 4) AS east, count(*) FILTER (tenant = 'west') AS west, count(*) FILTER (path LIKE '%again%') AS late, sum(n) FILTER (tenant = 'west') AS nw, sum(n) FILTER (tenant = 'east' AND run_id < 4) AS ne,
  sum(n) FILTER (tenant = 'east' AND source = 'orders' AND batch = 1995) AS n95, coalesce(sum(n) FILTER (path LIKE '%again%'), 0) AS nl FROM files), r AS (SELECT count(*) AS moved FROM moved)
SELECT 'east' AS tenant, CAST(1 AS BIGINT) AS id, 'failed' AS status, CAST(3 AS INTEGER) AS files, CAST(0 AS INTEGER) AS duplicates, CAST(n95 + 50 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS restatements, '1995-1997' AS batches, 'orders' AS source FROM c
UNION ALL SELECT 'east', 2, 'succeeded', east, 1, ne - n95 - 50, 0, NULL, NULL FROM c UNION ALL SELECT 'east', 3, 'succeeded', east, east, 0, 0, NULL, NULL FROM c
UNION ALL SELECT 'east', 4, 'succeeded', east + late, east, nl, 2 * moved, NULL, NULL FROM c, r UNION ALL SELECT 'west', 1, 'succeeded', west, 0, nw, 0, NULL, NULL FROM c""",
        "chronicle_promises": f"""WITH {FEED} SELECT p.tenant, 'orders' AS source, p.batch, strftime(covers_from, '%Y-%m-%d') || ' to ' || strftime(covers_to, '%Y-%m-%d') AS covers, p.path AS expected_path, CASE WHEN n IS NULL THEN 'missing' ELSE 'loaded' END AS status, n AS "rows", schema_version AS schema,
  CASE WHEN n IS NULL THEN greatest(0, date_diff('day', covers_to, DATE '2024-03-10') - 1) END AS overdue_days FROM promises p LEFT JOIN files f ON f.tenant = p.tenant AND f.batch = p.batch AND f.source = 'orders'""",
        "chronicle_promised": f"""WITH {FEED} SELECT coalesce(p.tenant, f.tenant) AS tenant, coalesce(f.source, 'orders') AS source, coalesce(p.batch, f.batch) AS batch, p.batch IS NOT NULL AS expected, coalesce(p.path, f.path) AS path, CASE WHEN n IS NULL THEN 'missing' ELSE 'loaded' END AS status, n AS rows_seen,
  coalesce(schema_version <> 'v1', false) AS alias, CAST(attempts AS INTEGER) AS attempts FROM promises p FULL JOIN files f ON f.tenant = p.tenant AND f.batch = p.batch AND f.source = 'orders'""",
        "chronicle_events": f"""WITH {FEED} SELECT tenant, source, path, 'alias_used' AS kind, '{{"field": "gross", "alias": "total"}}' AS detail FROM files WHERE schema_version <> 'v1'
UNION ALL SELECT tenant, source, path, NULL, NULL FROM files WHERE false""",
        "chronicle_holds": f"""WITH {FEED} SELECT tenant, 'orders' AS source, 'unmapped_value' AS reason, NULL AS error, count(*) + CASE WHEN tenant = 'east' THEN (SELECT count(*) FROM late WHERE channel IS NULL) ELSE 0 END AS n, count(*) + CASE WHEN tenant = 'east' THEN (SELECT count(*) FROM late WHERE channel IS NULL) ELSE 0 END AS refs FROM o WHERE channel IS NULL GROUP BY tenant
UNION ALL SELECT tenant, 'email_events', 'unparseable', CASE WHEN id % 97 = 0 THEN 'invalid JSON' ELSE 'line is not a JSON object' END, count(*), count(*) FROM e WHERE id % 97 = 0 OR id % 89 = 0 GROUP BY ALL""",
        "chronicle_orders": f"WITH {FEED} SELECT tenant, day AS posting_day, count(*) AS n, CAST(sum(now) AS DECIMAL(14,2)) AS gross, CAST(sum(CASE WHEN again THEN 2 ELSE 1 END) AS BIGINT) AS seen, count(*) FILTER (again) AS again FROM staged GROUP BY tenant, day",
        "chronicle_conflicts": f"WITH {FEED} SELECT tenant, 'orders' AS source, CAST(id AS VARCHAR) AS natural_key, gross AS previous, CAST(now AS DECIMAL(14,2)) AS incoming FROM staged WHERE now <> gross",
        "chronicle_restated": f"WITH {FEED} SELECT tenant, 'daily_revenue' AS mart, day, channel AS dimension, metric, previous, current, CAST(4 AS BIGINT) AS run_id, 'late or changed records in: orders' AS cause FROM moved, (VALUES ('gross'), ('net')) m(metric)",
        "chronicle_finance": f"""WITH {FEED}, books AS (SELECT tenant, day, CAST(sum(gross) + CASE WHEN day(day) % 7 = 0 THEN 1 ELSE 0 END AS DECIMAL(14,2)) AS r FROM o GROUP BY tenant, day), m AS (SELECT tenant, day, CAST(sum(now) AS DECIMAL(14,2)) AS g FROM staged GROUP BY tenant, day)
SELECT b.tenant, b.day, r AS reported_gross, coalesce(g, 0.00) AS mart_gross, CAST(r - coalesce(g, 0) AS DECIMAL(14,2)) AS gross_diff, r AS reported_net, coalesce(g, 0.00) AS mart_net, CAST(r - coalesce(g, 0) AS DECIMAL(14,2)) AS net_diff, r = coalesce(g, 0) AS ties FROM books b LEFT JOIN m ON m.tenant = b.tenant AND m.day = b.day""",
        "chronicle_status": f"""WITH {FEED}, days AS (SELECT tenant, count(DISTINCT day) AS days, CAST(sum(now) AS DECIMAL(14,2)) AS gross, count(DISTINCT day) FILTER (day >= DATE '2024-01-01' + 56) AS incomplete FROM staged GROUP BY tenant),
held AS (SELECT tenant, count(*) AS n FROM o WHERE channel IS NULL GROUP BY tenant), bad AS (SELECT tenant, count(*) AS n FROM e WHERE id % 97 = 0 OR id % 89 = 0 GROUP BY tenant)
SELECT d.tenant, CASE WHEN d.tenant = 'east' THEN 'East' ELSE 'West' END AS display_name, 'USD' AS currency, CAST(8 AS BIGINT) AS expected, CAST(7 AS BIGINT) AS loaded, CAST(1 AS BIGINT) AS missing, d.days, d.gross, d.gross AS net, d.incomplete AS incomplete_days,
  CASE WHEN d.tenant = 'east' THEN (SELECT 2 * count(*) FROM moved) ELSE 0 END AS restatements, coalesce(held.n, 0) + coalesce(bad.n, 0) + CASE WHEN d.tenant = 'east' THEN (SELECT count(*) FROM late WHERE channel IS NULL) ELSE 0 END AS holds, CAST(0 AS BIGINT) AS late_postings
FROM days d LEFT JOIN held ON held.tenant = d.tenant LEFT JOIN bad ON bad.tenant = d.tenant""",
    }
