"""Scenarios of whole runs."""

import json
import random
from datetime import date
from decimal import Decimal

import pytest
from shop import FILES, NOW, build, snapshot

from tidemark import reads
from tidemark.operators import mapping
from tidemark.plans.pipeline import Run, RunFailed, SimulatedCrash, _recover, drift, run_tenant
from tidemark.store import CLEANED, NoTenant, TenantSession, tenants


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("clean")
    config = build(folder)
    stats = run_tenant(spark, config, str(folder / "store"), "shop", now=NOW)
    return folder, config, stats


def session(spark, folder):
    return TenantSession(spark, str(folder / "store"), "shop")


def revenue(s):
    return {(r.day, r.channel): (r.orders, r.gross, r.refunds, r.net) for r in s.read("mart.daily_revenue").collect()}


def test_one_run(spark, clean):
    folder, config, stats = clean
    s = session(spark, folder)
    d = {x.source: x for x in stats.stage}
    assert (d["orders"].inserted, d["orders"].unchanged, d["orders"].updated, d["orders"].conflicts) == (9, 1, 1, 1)
    assert (d["email_events"].inserted, d["email_events"].quarantined) == (3, 3)
    rev = revenue(s)
    assert rev[date(2026, 1, 2), "paid_search"] == (0, Decimal("0.00"), Decimal("3.00"), Decimal("-3.00"))  # r1, by its order's channel
    assert rev[date(2026, 1, 2), "unattributed"] == (0, Decimal("0.00"), Decimal("2.00"), Decimal("-2.00"))
    assert rev[date(2026, 1, 3), "paid_search"][1] == Decimal("31.00")  # the newer version
    assert rev[date(2026, 1, 1), "paid_social"] == (1, Decimal("100.00"), Decimal("7.00"), Decimal("93.00"))
    emails = {(r.day, r.campaign_id): (r.delivered, r.opens, r.clicks) for r in s.read("mart.daily_email").collect()}
    assert emails == {(date(2026, 1, 1), "c1"): (1, 0, 0), (date(2026, 1, 1), "(none)"): (0, 1, 0)}
    o3 = s.read("stg.orders").where("order_id = 'o3'").first()
    assert o3.customer_email == 'q"\nn@x.com' and o3.channel_raw == "email"
    reasons = {(r.source, r.reason): r.n for r in s.read("ops.quarantine").groupBy("source", "reason").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert reasons == {("email_events", "unparseable"): 2, ("email_events", "bad_value"): 1, ("refunds", "unresolvable_reference"): 1}


def test_overlap_counts_once(spark, clean):
    s = session(spark, clean[0])
    o4 = s.read("stg.orders").where("order_id = 'o4'").first()
    assert (o4.times_seen, o4.gross) == (2, Decimal("10.00")) and o4.first_file_load_id < o4.last_file_load_id


def test_conflict_is_kept(spark, clean):
    c = session(spark, clean[0]).read("ops.conflicts").collect()
    assert [(r.natural_key, '"gross":30.00' in r.previous, '"gross":31.00' in r.incoming) for r in c] == [("o5", True, True)]


def test_missing_is_null_not_zero(spark, clean):
    rows = {(r.day, r.spend, r.complete) for r in reads.marketing(session(spark, clean[0])).collect()}
    assert (date(2026, 1, 3), None, False) in rows and (date(2026, 1, 6), Decimal("6.00"), True) in rows and len(rows) == 6


def test_alias_is_adapted_and_told(spark, clean):
    s = session(spark, clean[0])
    assert {r.schema_version for r in s.read("stg.ad_spend").collect()} == {"v1", "spend=cost_usd"}
    assert [(r.kind, r.detail) for r in s.read("ops.schema_events").collect()] == [("alias_used", '{"field": "spend", "alias": "cost_usd"}')]


def test_reads(spark, clean):
    s = session(spark, clean[0])
    o = reads.overview(s)
    assert (o["expected"], o["loaded"], o["missing"], o["days"], o["incomplete_days"]) == (9, 9, 1, 6, 0)  # email batch 1 came unpromised
    late = {(r.source, r.batch): (r.status, r.overdue_days) for r in reads.deliveries(s, date(2026, 1, 10)).collect()}
    assert late["ad_spend", 2] == ("missing", 5) and late["orders", 1] == ("loaded", None)
    fresh = {r.source: (r.last_covered, r.stale_days, r.missing) for r in reads.freshness(s, date(2026, 1, 10)).collect()}
    assert fresh["ad_spend"] == (date(2026, 1, 6), 0, 1)
    assert reads.holds(s).where("kind = 'conflict'").count() == 1
    assert reads.hold_counts(s) == {"quarantine": 4, "schema event": 1, "conflict": 1} and "at" in reads.holds(s).columns
    card = reads.revenue_card(s)
    assert list(card["channels"]) == ["paid_social", "paid_search", "email", "direct", "unattributed"] and card["net"] == sum(card["channels"].values()) == card["gross"] - card["refunds"]
    assert (card["currency"], card["last_run"]["status"], reads.restatement_days(s).count()) == ("USD", "succeeded", 0)
    assert reads.runs(s)[0]["status"] == "succeeded"
    assert reads.status(s)["missing"] == 1
    assert tenants(spark, str(clean[0] / "store")) == ["shop"]


def test_sql_of_one_tenant(spark, clean):
    own = reads.sql_session(spark, str(clean[0] / "store"), "shop")
    assert own.sql("SELECT sum(orders) FROM daily_revenue").first()[0] == 9
    assert own.sql("SELECT count(*) FROM daily_marketing WHERE spend IS NULL").first()[0] == 2
    other = reads.sql_session(spark, str(clean[0] / "store"), "other")
    assert other.sql("SELECT count(*) FROM orders").first()[0] == 0 and not spark.catalog.tableExists("daily_revenue")
    with pytest.raises(Exception, match="(?i)not.*found|cannot be found|UNSUPPORTED"):
        other.sql(f"SELECT * FROM parquet.`{clean[0]}/store/shop/mart.daily_revenue`").collect()


def test_held_rows_are_tried_again_only_with_another_configuration(spark, clean, monkeypatch):
    folder, config, _ = clean
    tried = []
    monkeypatch.setattr("tidemark.plans.pipeline._retry_held", lambda run, spec, closed, stats: tried.append(spec.source))
    run_tenant(spark, config, str(folder / "store"), "shop", now=NOW, phases=("stage",))
    assert tried == []
    labels = {"facebook": "paid_social", "google": "paid_search", "email": "email", "direct": "direct", "pinterest": "other"}
    assert mapping.fingerprint(config.sources["orders"], build(folder, labels=labels).tenant("shop")) != mapping.fingerprint(config.sources["orders"], config.tenant("shop"))


def test_isolation(spark, clean):
    root = str(clean[0] / "store")
    assert TenantSession(spark, root, "other").read("stg.orders").count() == 0
    for bad in ("", "../shop", "Shop", None):
        with pytest.raises(NoTenant):
            TenantSession(spark, root, bad)
    s = TenantSession(spark, root, "other")
    with pytest.raises(Exception, match="another tenant"):
        s.append("stg.orders", session(spark, clean[0]).read("stg.orders"))
    assert TenantSession(spark, root, "other").read("stg.orders").count() == 0


def test_second_run_changes_nothing(spark, clean):
    folder, config, _ = clean
    before = snapshot(session(spark, folder))
    stats = run_tenant(spark, config, str(folder / "store"), "shop", now=NOW)
    assert {f.status for f in stats.files} == {"duplicate"} and all(x.inserted + x.updated + x.released == 0 for x in stats.stage)
    assert (stats.marts.days_rebuilt, stats.marts.restatements) == (0, 0)
    assert snapshot(session(spark, folder)) == before


def test_crash_then_resume_is_a_clean_run(spark, clean, tmp_path):
    config = build(tmp_path)
    with pytest.raises(RunFailed) as e:
        run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW, crash_after_rows=13, chunk_rows=2)
    assert isinstance(e.value.cause, SimulatedCrash)
    s = session(spark, tmp_path)
    # 4 rows of ad_spend and 6 of email, then 3 of the first orders file, of which one chunk of 2 was committed.
    partial = [(r.path, r.status, r.rows_committed) for r in s.read("raw.file_loads").collect() if r.status != "loaded"]
    assert partial == [("shop/orders/batch_01.csv", "loading", 2)]
    assert s.read("ops.runs").first().status == "failed"
    stats = run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW)
    assert [(f.status, f.note) for f in stats.files if f.path == "shop/orders/batch_01.csv"] == [("resumed", "after record 2")]
    assert snapshot(session(spark, tmp_path)) == snapshot(session(spark, clean[0]))


@pytest.mark.parametrize(("written", "left"), [(None, []), ([0, 2], [("shop/orders/batch_01.csv", "loading", 2), ("shop/orders/batch_02.csv", "loading", 2), ("shop/orders/batch_03.csv", "loading", 0)]), ([], None)])
def test_a_kill_keeps_whole_chunks(spark, clean, tmp_path, monkeypatch, written, left):
    """Killed after the job but before its commit, or in the job with some chunks written: of each file those up to the first that isn't there count."""
    config = build(tmp_path)
    adopt, write = TenantSession.adopt_chunks, TenantSession.write_chunks

    def orders(s, to):
        first = next(x for x in s.state["meta"]["staged"] if x["to"] == to)["chunks"][0][0][0]
        return s.read("raw.file_loads").where(f"id = {first}").first()["source"] == "orders"

    def killed_before_commit(self, to, taken):
        if orders(self, to):
            raise KeyboardInterrupt
        adopt(self, to, taken)

    def killed_in_job(self, name, to, rows, n):
        if orders(self, to):
            if written:
                write(self, name, to, rows.where(rows["_chunk"].isin(written)), n)
            raise KeyboardInterrupt
        write(self, name, to, rows, n)

    monkeypatch.setattr(TenantSession, *(("adopt_chunks", killed_before_commit) if written is None else ("write_chunks", killed_in_job)))
    with pytest.raises(KeyboardInterrupt):
        run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW, chunk_rows=2)
    monkeypatch.undo()
    s = session(spark, tmp_path)
    assert s.read("raw.records").count() == 10 and [(r.id, r.status, r.finished_at) for r in s.read("ops.runs").collect()] == [(1, "running", None)]
    run = Run(spark, config, config.tenant("shop"), s, 2, NOW)
    if left is not None:
        _recover(run, config.sources["orders"])
        assert sorted((r["path"], r["status"], r["rows_committed"]) for r in run.loads("status <> 'loaded'")) == left
        assert s.state["meta"]["staged"] == []
    stats = run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW, chunk_rows=3)
    assert stats.run_id == 2 and [(r["id"], r["status"]) for r in reads.runs(session(spark, tmp_path))] == [(2, "succeeded"), (1, "running")]
    assert snapshot(session(spark, tmp_path)) == snapshot(session(spark, clean[0]))


def test_an_ingest_is_one_write_for_each_source(spark, tmp_path, monkeypatch):
    config, write, calls = build(tmp_path), TenantSession.write_chunks, []
    monkeypatch.setattr(TenantSession, "write_chunks", lambda self, name, to, rows, n: (calls.append(n), write(self, name, to, rows, n))[1])
    run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW, chunk_rows=2, phases=("ingest",))
    assert len(calls) == 4 and sum(calls) > 10
    s = session(spark, tmp_path)
    paths = [p for own in s.state["tables"]["raw.records"].values() for p in own]
    assert all("/_chunk=" in p for p in paths) and s.state["meta"]["staged"] == []


def test_many_small_chunks_share_folders_and_stop_where_they_did(spark, clean, tmp_path, monkeypatch):
    """Folders and tasks of a write don't grow with the number of chunks; a stop on request still counts each chunk."""
    config, write, calls = build(tmp_path), TenantSession.write_chunks, []
    monkeypatch.setattr("tidemark.plans.pipeline.FOLDERS", 2)
    monkeypatch.setattr(TenantSession, "write_chunks", lambda self, name, to, rows, n: (calls.append(n), write(self, name, to, rows, n))[1])
    with pytest.raises(RunFailed):
        run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW, crash_after_rows=13, chunk_rows=1)
    s = session(spark, tmp_path)
    partial = [(r.path, r.status, r.rows_committed) for r in s.read("raw.file_loads").collect() if r.status != "loaded"]
    assert partial == [("shop/orders/batch_01.csv", "loading", 3)]
    run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW, chunk_rows=1)
    assert len(calls) == 5 and max(calls) == 2
    s = session(spark, tmp_path)
    assert snapshot(s) == snapshot(session(spark, clean[0]))
    assert s.files.folders(f"{s.root}/kept") == []


def test_a_run_keeps_on_disk_only_what_is_still_read(spark, tmp_path, monkeypatch):
    """Mapped rows have gone when staged ones are written, shuffle files go with their query, and files of the store are compressed well."""
    config, replace, seen = build(tmp_path), TenantSession.replace, []

    def looked(self, name, rows, keys=None):
        if name == "stg.refunds":
            top = f"{self.root}/kept"
            seen.append((sum(len(self.files.folders(f"{top}/{f}")) for f in self.files.folders(top)), spark.conf.get(CLEANED, None)))
        replace(self, name, rows, keys)

    before = spark.conf.get(CLEANED, None)
    monkeypatch.setattr(TenantSession, "replace", looked)
    run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW, source="refunds", phases=("ingest", "stage"))
    assert seen == [(1, "true")] and spark.conf.get(CLEANED, None) == before
    files = [p.name for t in ("raw.records", "stg.refunds") for p in (tmp_path / "store" / "shop" / t).rglob("part-*.parquet")]
    assert files and all(".zstd." in f for f in files)


def test_a_run_beside_another_fails_and_says_so(spark, tmp_path, monkeypatch):
    config, adopt = build(tmp_path), TenantSession.adopt_chunks

    def raced(self, to, taken):
        monkeypatch.setattr(TenantSession, "adopt_chunks", adopt)
        other = session(spark, tmp_path)
        other.put("ops.runs", [{"id": 7, "status": "running"}])
        adopt(self, to, taken)

    monkeypatch.setattr(TenantSession, "adopt_chunks", raced)
    with pytest.raises(RunFailed, match="another run"):
        run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW, phases=("ingest",))
    assert {r.id: r.status for r in session(spark, tmp_path).read("ops.runs").collect()} == {1: "failed", 7: "running"}
    assert {f.status for f in run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW, phases=("ingest",)).files} == {"resumed", "loaded"}


def test_late_records_restate(spark, clean, tmp_path):
    config = build(tmp_path)
    first = run_tenant(spark, config, str(tmp_path / "store"), "shop", batches="1", now=NOW)
    assert (first.marts.orphan_refunds, first.marts.restatements) == (2, 0)
    stats = run_tenant(spark, config, str(tmp_path / "store"), "shop", batches="2-3", now=NOW)
    assert (stats.marts.orphans_resolved, stats.marts.orphan_refunds) == (1, 0)
    s = session(spark, tmp_path)
    moved = {(r.day, r.dimension, r.metric): (r.previous, r.current) for r in s.read("ops.restatements").collect()}
    second = date(2026, 1, 2)
    # r1 leaves unattributed for a channel that is new on the day; o9's channel is new too, so neither leaves a row.
    assert moved == {(second, "unattributed", "refunds"): (Decimal("5.00"), Decimal("2.00")), (second, "unattributed", "net"): (Decimal("-5.00"), Decimal("-2.00"))}
    assert s.read("ops.restatements").first().cause == "late or changed records in: orders, refunds"
    assert snapshot(s) == snapshot(session(spark, clean[0])) and drift(s).count() == 0
    assert [(r.day, r.n, r.sources, r.marts) for r in reads.restatement_days(s).collect()] == [(second, 2, ["orders", "refunds"], 1)]


def test_changes_add_up_to_a_rebuild(spark, tmp_path):
    """Histories with inserts, updates and repeats, in several files and runs: marts by signed changes are those of all staged rows, and so are restatements."""
    rng, given = random.Random(4), {}
    for b in (1, 2, 3):
        ids = rng.sample(range(40), 25)
        at = lambda i: f"2026-01-0{1 + i % 6}T10:00:00Z"
        given[f"orders/batch_0{b}.csv"] = "order_id,created_at,channel,gross,currency,customer_email\n" + "".join(f"o{i},{at(i)},{rng.choice(['Facebook', 'google', 'email'])},{rng.randrange(1, 4)}.00,USD,\n" for i in ids)
        lines = [{"event_id": f"e{i}", "type": rng.choice(["delivered", "open", "bounce", "click"]), "email": "x@y.z", "campaign_id": rng.choice(["c1", None]), "occurred_at": at(i)} for i in rng.sample(range(30), 20)]
        given[f"email_events/batch_0{b}.ndjson"] = "\n".join(json.dumps(x) for x in lines)
    files = {k: v for k, v in FILES.items() if not k.startswith(("orders", "refunds", "email"))} | given
    config, before = build(tmp_path, files=files), {}
    for b in ("1", "2", "3"):
        stats = run_tenant(spark, config, str(tmp_path / "store"), "shop", batches=b, now=NOW)
        s = session(spark, tmp_path)
        assert drift(s).count() == 0 and s.keys("ops.sold_changes") == s.keys("ops.email_changes") == []
        now = {("daily_revenue", r.day, r.channel, m): float(r[m]) for r in s.read("mart.daily_revenue").collect() for m in ("orders", "gross", "refunds", "net")}
        now |= {("daily_email", r.day, r.campaign_id, m): float(r[m]) for r in s.read("mart.daily_email").collect() for m in ("delivered", "opens", "clicks", "unsubscribes")}
        told = {(r.mart, r.day, r.dimension, r.metric): (float(r.previous), float(r.current)) for r in s.read("ops.restatements").where(f"run_id = {stats.run_id}").collect()}
        assert told == {k: (v, now.get(k, 0.0)) for k, v in before.items() if v != now.get(k, 0.0)}
        before = now
    assert told


def test_freeze_books_late_records_on_arrival(spark, tmp_path):
    config = build(tmp_path, late="freeze")
    run_tenant(spark, config, str(tmp_path / "store"), "shop", batches="1-2", now=NOW)
    before = {k: v for k, v in revenue(session(spark, tmp_path)).items() if k[0] < date(2026, 1, 5)}
    stats = run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW)
    s = session(spark, tmp_path)
    after = revenue(s)
    assert {k: after.get(k) for k in before if k != (date(2026, 1, 3), "paid_search")} == {k: v for k, v in before.items() if k != (date(2026, 1, 3), "paid_search")}
    assert sum(x.posted_late for x in stats.stage) == 1 and after[NOW.date(), "paid_social"][0] == 1  # o9
    late = {(r.source, r.natural_key): r.posting_day for r in reads.late_postings(s).collect()}
    assert late["orders", "o9"] == NOW.date()


def test_unknown_header_and_unmapped_label(spark, tmp_path):
    files = dict(FILES) | {"ad_spend/batch_02.csv": "date,campaign_id,platform,cost\n2026-01-03,c1,facebook,1.00\n"}
    files["orders/batch_02.csv"] = files["orders/batch_02.csv"].replace("facebook", "Pinterest")
    config = build(tmp_path, files=files)
    stats = run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW)
    assert [f.note for f in stats.files if f.status == "quarantined"] == ["no column for spend"]
    held = session(spark, tmp_path).read("ops.quarantine").where("reason = 'unmapped_value'").collect()
    assert [(r.source, '"value":"Pinterest"' in r.detail) for r in held] == [("orders", True)]
    labels = {"facebook": "paid_social", "google": "paid_search", "email": "email", "direct": "direct", "pinterest": "other"}
    again = run_tenant(spark, build(tmp_path, files=files, labels=labels), str(tmp_path / "store"), "shop", now=NOW)
    assert sum(x.released for x in again.stage) == 1 and {f.status for f in again.files} == {"duplicate"}
    assert revenue(session(spark, tmp_path))[date(2026, 1, 4), "other"] == (1, Decimal("40.00"), Decimal("4.00"), Decimal("36.00"))


def test_fail_policy(spark, tmp_path):
    config = build(tmp_path, unknown="fail", files={"ad_spend/batch_02.csv": "date,campaign_id,platform,cost\n2026-01-03,c1,facebook,1.00\n"})
    with pytest.raises(RunFailed, match="no column for spend"):
        run_tenant(spark, config, str(tmp_path / "store"), "shop", now=NOW)
    assert session(spark, tmp_path).read("raw.file_loads").count() == 0


def test_migrations_run_once_in_order(spark, tmp_path, monkeypatch):
    from tidemark import model

    root = str(tmp_path / "store")
    s = TenantSession(spark, root, "shop")
    s.append("ops.tenants", s.frame("ops.tenants", [{"display_name": "Shop", "currency": "usd", "config_hash": "x"}]))
    steps = []

    def upper(s):
        steps.append(2)
        s.replace("ops.tenants", s.frame("ops.tenants", [r.asDict() | {"currency": r.currency.upper()} for r in s.read("ops.tenants").collect()]))

    monkeypatch.setattr(model, "VERSION", 3)
    monkeypatch.setattr(model, "MIGRATIONS", {2: upper, 3: lambda s: steps.append(3)})
    with pytest.raises(RuntimeError, match="migrate"):
        TenantSession(spark, root, "shop")
    assert TenantSession.migrate(spark, root, "shop") == [2, 3] == steps and TenantSession.migrate(spark, root, "shop") == []
    assert TenantSession(spark, root, "shop").read("ops.tenants").first().currency == "USD"
