"""The log, the index of keys, vacuum and compaction."""

import json
import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import store
from tidemark.store import Conflict, TenantSession

DAY = date(2026, 1, 1)


def tenant(name, currency="USD"):
    return {"display_name": name, "currency": currency, "config_hash": "x"}


def write(s, name):
    s.replace("ops.tenants", s.frame("ops.tenants", [tenant(name)]).coalesce(1))


def names(s):
    return [r[0] for r in s.read("ops.tenants").select("display_name").collect()]


def orders(s, ids, day=DAY):
    rows = [(i, f"o{i}", day + timedelta(days=i % 7)) for i in ids]
    frame = s.spark.createDataFrame(rows, "first_file_load_id long, order_id string, posting_day date")
    for f in store.CATALOGUE["stg.orders"].schema:
        if f.name not in frame.columns and f.name != "tenant_id":
            frame = frame.withColumn(f.name, F.lit(None).cast(f.dataType))
    return frame


def stage(s, ids):
    frame = orders(s, ids)
    with s.commit():
        s.append("stg.orders", frame)
        s.add_keys("orders", frame.select(F.col("order_id").alias("k"), "posting_day"), len(ids))


def wanted(spark, ids):
    return spark.createDataFrame([(f"o{i}",) for i in ids], "k string")


def test_of_two_commits_on_one_version_one_is_refused(spark, tmp_path):
    root = str(tmp_path)
    write(TenantSession(spark, root, "shop"), "first")
    a, b = TenantSession(spark, root, "shop"), TenantSession(spark, root, "shop")
    with pytest.raises(Conflict), a.commit():
        write(a, "a")
        with b.commit():  # both have written their folders; b is the first to commit
            write(b, "b")
    assert names(TenantSession(spark, root, "shop")) == ["b"]
    write(b, "c")
    assert names(TenantSession(spark, root, "shop")) == ["c"] and names(a) == ["first"]


def test_a_file_of_the_log_is_never_replaced(spark, tmp_path):
    files = store.Files(spark, str(tmp_path))
    assert files.create(f"{tmp_path}/x", "one") and not files.create(f"{tmp_path}/x", "two")
    assert files.read(f"{tmp_path}/x") == "one" and files.names(str(tmp_path)) == ["x"]


def test_commits_cost_the_same_however_long_the_history(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "KEPT_LOG", 8)
    s = TenantSession(spark, str(tmp_path), "shop")
    monkeypatch.setattr(TenantSession, "_write", lambda self, name, rows: {"all": [f"{name}/{self._open['version']}"]})
    for _ in range(70):
        s.replace("ops.tenants", None)
    log = tmp_path / "shop" / "_log"
    entries = sorted(p for p in os.listdir(log) if p.endswith(".json"))
    assert s.state["version"] == 70 and len(entries) <= store.CHECKPOINT + 8 + 16 and len({os.path.getsize(log / e) for e in entries}) == 1
    assert TenantSession(spark, str(tmp_path), "shop").state == s.state
    assert store.load_state(s.files, s.log, 65)["tables"] == {"ops.tenants": {"all": ["ops.tenants/64"]}}


def test_nothing_changed_is_no_commit(spark, tmp_path):
    s = TenantSession(spark, str(tmp_path), "shop")
    with s.commit():
        pass
    assert s.state["version"] == 0 and store.tenants(spark, str(tmp_path)) == []


def test_vacuum_leaves_what_kept_versions_read(spark, tmp_path):
    s = TenantSession(spark, str(tmp_path), "shop")
    for i in range(5):
        write(s, f"n{i}")
    assert s.vacuum(keep=2) == []  # too young
    assert len(s.vacuum(keep=2, older_than_hours=0)) == 2 and names(s) == ["n4"]
    old = store.load_state(s.files, s.log, 3)["tables"]["ops.tenants"]["all"]
    assert os.path.isdir(tmp_path / "shop" / old[0])
    stage(s, range(14))
    s.replace("stg.orders", orders(s, [0]), [str(DAY)])
    gone = s.vacuum(keep=0, older_than_hours=0)
    assert any("_part=2026-01-01" in g for g in gone) and s.read("stg.orders").count() == 13
    assert names(s) == ["n4"] and names(TenantSession(spark, str(tmp_path), "shop")) == ["n4"]


def test_appends_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MOST_FOLDERS", 3)
    s = TenantSession(spark, str(tmp_path), "shop")
    for i in range(6):
        s.append("ops.unchecked", s.frame("ops.unchecked", [{"ref": str(i)}]).coalesce(1))
    assert len(s.state["tables"]["ops.unchecked"]["all"]) <= 3 and s.read("ops.unchecked").count() == 6


def test_blocks_of_ids(spark, tmp_path):
    s = TenantSession(spark, str(tmp_path), "shop")
    assert s.next_id("ops.runs") == 1
    s.put("ops.runs", [{"id": i, "status": "running"} for i in (1, 99, 100, 250)])
    before = json.loads(json.dumps(s.state["tables"]["ops.runs"]))
    s.put("ops.runs", [{"id": 100, "status": "succeeded"}, {"id": 101, "status": "failed"}])
    after = s.state["tables"]["ops.runs"]
    assert {k for k in after if after[k] != before.get(k)} == {"1"} and s.next_id("ops.runs") == 251
    assert sorted((r.id, r.status) for r in s.read("ops.runs").collect()) == [(1, "running"), (99, "running"), (100, "succeeded"), (101, "failed"), (250, "running")]


def test_a_delta_of_one_key_reads_one_bucket_and_one_day(spark, tmp_path):
    s = TenantSession(spark, str(tmp_path), "shop")
    stage(s, range(300))
    assert len(s.keys("keys.orders")) == store.BUCKETS and len(s.keys("stg.orders")) == 7
    found = s.days_of("orders", wanted(spark, [123]))
    assert [(r.k, r.posting_day) for r in found.collect()] == [("o123", DAY + timedelta(days=123 % 7))]
    assert {p.split("/_part=")[1].split("/")[0] for p in found.inputFiles()} == {str(spark.range(1).select(store.bucket_of(F.lit("o123"), store.BUCKETS)).first()[0])}
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(k,o123)" in plan and "LessThanOrEqual(k,o123)" in plan
    rows = s.staged_on_days_of("orders", wanted(spark, [123, 99999]))
    assert {p.split("/_part=")[1].split("/")[0] for p in rows.inputFiles()} == {str(DAY + timedelta(days=123 % 7))}
    assert s.staged_on_days_of("orders", wanted(spark, [])).count() == 0 and s.days_of("refunds", wanted(spark, [1])).count() == 0


def test_buckets_are_split_as_keys_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "BUCKET_ROWS", 4)
    s, rng, want = TenantSession(spark, str(tmp_path), "shop"), random.Random(2), {}
    for start in range(0, 400, 80):
        stage(s, range(start, start + 80))
        want |= {f"o{i}": DAY + timedelta(days=i % 7) for i in range(start, start + 80)}
    assert s.state["meta"]["keys.orders"] == {"buckets": 256, "rows": 400}
    some = rng.sample(range(500), 60)
    assert {r.k: r.posting_day for r in s.days_of("orders", wanted(spark, some)).collect()} == {k: d for k, d in want.items() if int(k[1:]) in some}
