"""The read API: one tenant's state as DataFrames, for a console or a notebook."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .operators import checks, marts
from .report import run_context
from .sources import files
from .store import TenantSession, tenants

__all__ = ["deliveries", "finance", "freshness", "hold_counts", "holds", "late_postings", "marketing", "overview", "promised", "restatement_days", "restatements", "revenue", "revenue_card", "runs", "sql_session", "status", "tenants"]


def promised(s: TenantSession) -> DataFrame:
    """Source by batch: what was promised and what came."""
    return checks.promised_or_loaded(s.read("ops.expected_deliveries"), s.read("raw.file_loads"))


def deliveries(s: TenantSession, as_of: date) -> DataFrame:
    return checks.deliveries(s.read("ops.expected_deliveries"), s.read("raw.file_loads"), F.lit(as_of))


def freshness(s: TenantSession, as_of: date) -> DataFrame:
    return checks.freshness(s.read("ops.expected_deliveries"), s.read("raw.file_loads"), F.lit(as_of))


def finance(s: TenantSession, config: Config) -> DataFrame:
    return checks.finance(files.finance(s.spark, f"{config.base.rstrip('/')}/{s.tenant_id}/finance_summary.csv"), s.read("mart.daily_revenue"))


def marketing(s: TenantSession) -> DataFrame:
    loads = s.read("raw.file_loads").where("status = 'loaded'").select("source", "batch", F.lit(True).alias("_l"))
    states = s.read("ops.expected_deliveries").join(loads, ["source", "batch"], "left").select("source", "covers_from", "covers_to", F.coalesce("_l", F.lit(False)).alias("loaded"))
    return marts.marketing(states, s.read("stg.ad_spend"))


def late_postings(s: TenantSession) -> DataFrame:
    return marts.late_postings(s.read("stg.orders"), s.read("stg.refunds"), s.read("stg.email_events"), s.read("stg.ad_spend"))


def _last_run(s: TenantSession) -> dict | None:
    last = checks.latest_run(s.read("ops.runs")).first()
    return last.asDict() if last else None


def revenue(s: TenantSession) -> DataFrame:
    return checks.revenue_by_day(s.read("mart.daily_revenue")).orderBy("day")


def revenue_card(s: TenantSession) -> dict:
    """What stands beside the days: channels in display order with their net, totals, currency, last run."""
    mart = s.read("mart.daily_revenue")
    totals = mart.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(t).alias(c) for c, t in (("orders", "long"), *((m, checks.MONEY) for m in ("gross", "refunds", "net")))], F.coalesce(F.min("currency"), F.lit("")).alias("currency")).first().asDict()
    return totals | {"channels": {r["channel"]: r["net"] for r in checks.channel_totals(mart).collect()}, "last_run": _last_run(s)}


def restatements(s: TenantSession) -> DataFrame:
    return checks.latest_restatements(s.read("ops.restatements"))


def restatement_days(s: TenantSession) -> DataFrame:
    """The latest restatements by day, newest first: how many, and their runs, sources and marts."""
    return checks.restatement_days(restatements(s)).orderBy(F.desc("day"))


def holds(s: TenantSession) -> DataFrame:
    return checks.holds(s.read("ops.quarantine"), s.read("ops.schema_events"), s.read("ops.conflicts"), s.read("raw.file_loads"))


def hold_counts(s: TenantSession) -> dict[str, int]:
    """Of the holds that are shown, how many there are of each kind."""
    return {kind: 0 for kind in ("quarantine", "schema event", "conflict")} | {r[0]: r[1] for r in holds(s).groupBy("kind").count().collect()}


def runs(s: TenantSession, most: int = 50) -> list[dict]:
    out = []
    for r in s.read("ops.runs").orderBy(F.desc("id")).limit(most).collect():
        stats = json.loads(r["stats"] or "{}")
        own = stats.get("files", [])
        out.append(
            {
                "id": r["id"], "status": r["status"], "started_at": r["started_at"], "finished_at": r["finished_at"], "error": r["error"], "args": json.loads(r["args"] or "{}"), "files": len(own), "duplicates": sum(f["status"] == "duplicate" for f in own),
                "inserted": sum(f["rows_inserted"] for f in own), "restatements": (stats.get("marts") or {}).get("restatements", 0), "missing": len(stats.get("missing", [])), "context": run_context(r["status"], r["error"], stats),
            }
        )
    return out


def overview(s: TenantSession) -> dict:
    cells = promised(s).agg(F.count_if("expected").alias("expected"), F.count_if(F.col("status") == "loaded").alias("loaded"), F.count_if(F.col("status") == "missing").alias("missing")).first().asDict()
    totals = checks.revenue_totals(s.read("mart.daily_revenue")).first().asDict()
    return cells | totals | {"restatements": s.read("ops.restatements").count(), "holds": s.read("ops.quarantine").count(), "last_run": _last_run(s)}


def status(s: TenantSession) -> dict:
    """The terminal's card. Its `missing` counts what hasn't loaded, held files too."""
    loads = s.read("raw.file_loads").select("source", "batch", "status")
    d = s.read("ops.expected_deliveries").join(loads, ["source", "batch"], "left").agg(F.count("*").alias("expected"), F.count_if(F.coalesce(F.col("status") == "loaded", F.lit(False))).alias("loaded")).first()
    tenant = s.read("ops.tenants").first()
    card = overview(s) | {"expected": d["expected"], "loaded": d["loaded"], "missing": d["expected"] - d["loaded"], "late_postings": late_postings(s).count()}
    return {"tenant": s.tenant_id, "display_name": tenant and tenant["display_name"], "currency": tenant and tenant["currency"]} | card


#: Views of a tenant's session for SQL, by name.
VIEWS = {
    "orders": lambda s: s.read("stg.orders"), "refunds": lambda s: s.read("stg.refunds"), "email_events": lambda s: s.read("stg.email_events"), "ad_spend": lambda s: s.read("stg.ad_spend"),
    "daily_revenue": lambda s: s.read("mart.daily_revenue"), "daily_email": lambda s: s.read("mart.daily_email"), "daily_marketing": marketing, "late_postings": late_postings, "restatements": lambda s: s.read("ops.restatements"),
    "quarantine": lambda s: s.read("ops.quarantine"), "conflicts": lambda s: s.read("ops.conflicts"), "expected_deliveries": lambda s: s.read("ops.expected_deliveries"), "file_loads": lambda s: s.read("raw.file_loads"), "runs": lambda s: s.read("ops.runs"),
}


def sql_session(spark: SparkSession, root: str, tenant_id: str) -> SparkSession:
    """A Spark session in which SQL sees one tenant's tables as views, and files by path not at all.

    It shares nothing with other sessions but the context: temporary views are a
    session's own. The views show the version that was last when it was made.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    s = TenantSession(own, root, tenant_id)
    for name, view in VIEWS.items():
        view(s).createOrReplaceTempView(name)
    own.conf.set("spark.sql.runSQLOnFiles", "false")
    return own
