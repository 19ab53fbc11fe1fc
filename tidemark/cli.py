"""python -m tidemark.cli: every command is safe to run again. Exit 1 if a run failed or a promised batch is missing."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from . import config as configs
from . import reads
from .plans.pipeline import PHASES, RunFailed, SimulatedCrash, run_tenant
from .report import run_report, table
from .store import TenantSession


def session() -> SparkSession:
    return SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("tidemark")
    p.add_argument("--config", default="config", help="folder with sources/ and tenants/")
    p.add_argument("--base", default=".", help="folder that delivery paths are relative to")
    p.add_argument("--store", default="store", help="folder of the tables")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", *PHASES):
        c = sub.add_parser(name)
        c.add_argument("-t", "--tenant", required=True)
        c.add_argument("-s", "--source")
        c.add_argument("--only")
        c.add_argument("--batches")
        c.add_argument("--crash-after-rows", type=int)
        c.add_argument("--skip-marts", action="store_true")
    t = sub.add_parser("tenant").add_subparsers(dest="what", required=True)
    t.add_parser("list")
    t.add_parser("validate").add_argument("file")
    c = sub.add_parser("check")
    c.add_argument("what", choices=("deliveries", "freshness", "finance"))
    c.add_argument("-t", "--tenant")
    sub.add_parser("status").add_argument("-t", "--tenant")
    sub.add_parser("migrate")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    config = configs.load(a.config, a.base)
    if a.command == "tenant":
        if a.what == "validate":
            t = configs.parse_tenant(configs.read(Path(a.file)), config.sources)
            print(f'ok: tenant "{t.id}" ({t.display_name}, {t.currency}), sources: {", ".join(t.sources)}')
        else:
            print(table([{"id": t.id, "name": t.display_name, "currency": t.currency, "sources": ", ".join(t.sources)} for t in config.tenants.values()]))
        return 0
    spark = spark or session()
    today = datetime.now(UTC).date()
    chosen = [a.tenant] if getattr(a, "tenant", None) else sorted(config.tenants)
    if a.command == "migrate":
        for t in chosen:
            done = TenantSession.migrate(spark, a.store, t)
            print(f"{t}: " + (f"brought to schema {done[-1]}" if done else "nothing to do"))
        return 0
    if a.command in ("run", *PHASES):
        try:
            stats = run_tenant(spark, config, a.store, a.tenant, source=a.source, only=a.only, batches=a.batches, crash_after_rows=a.crash_after_rows, skip_marts=a.skip_marts, phases=PHASES if a.command == "run" else (a.command,))
        except RunFailed as e:
            print(run_report(e.stats))
            print(f"\nrun #{e.stats.run_id} FAILED: {e}", file=sys.stderr)
            if not isinstance(e.cause, SimulatedCrash):
                raise e.cause from e
            return 1
        print(run_report(stats))
        return 0
    bad = 0
    for t in chosen:
        s = TenantSession(spark, a.store, t)
        if a.command == "status":
            print(table([{k: v for k, v in reads.status(s).items()}]))
            continue
        frame = {"deliveries": lambda s=s: reads.deliveries(s, today), "freshness": lambda s=s: reads.freshness(s, today), "finance": lambda s=s: reads.finance(s, config)}[a.what]()
        rows = [{"tenant": t} | r.asDict() for r in frame.orderBy(frame.columns[0], frame.columns[1]).collect()]
        print(table(rows))
        if a.what != "finance":
            bad += sum(r.get("status") == "missing" or (r.get("missing") or 0) > 0 for r in rows)
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
