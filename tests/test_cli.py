"""The command line and the file stream."""

import json

from shop import FILES, SOURCES, build

from tidemark import cli
from tidemark.store import TenantSession
from tidemark.streaming import watch


def write_config(folder):
    (folder / "config/sources").mkdir(parents=True)
    (folder / "config/tenants").mkdir()
    for s in SOURCES:
        (folder / f"config/sources/{s['source']}.json").write_text(json.dumps(s))
    tenant = {"id": "shop", "display_name": "Shop", "currency": "USD", "sources": {"orders": {"path": "shop/orders/*"}}, "normalize": {"channel": {"facebook": "paid_social", "google": "paid_search", "email": "email", "direct": "direct"}}, "expected_deliveries": {"manifest": "manifest.json"}}
    (folder / "config/tenants/shop.json").write_text(json.dumps(tenant))
    (folder / "config/tenants/_draft.json").write_text("not json")
    return ["--config", str(folder / "config"), "--base", str(folder), "--store", str(folder / "store")]


def test_commands(spark, tmp_path, capsys):
    build(tmp_path, files={"orders/batch_01.csv": FILES["orders/batch_01.csv"]})
    base = write_config(tmp_path)
    assert cli.main([*base, "tenant", "list"]) == 0 and "Shop" in capsys.readouterr().out
    assert cli.main([*base, "tenant", "validate", str(tmp_path / "config/tenants/shop.json")]) == 0
    assert cli.main([*base, "run", "-t", "shop", "--crash-after-rows", "2"], spark) == 1
    assert cli.main([*base, "run", "-t", "shop"], spark) == 0 and "resumed" in capsys.readouterr().out
    assert cli.main([*base, "check", "deliveries"], spark) == 1 and "missing" in capsys.readouterr().out
    assert cli.main([*base, "status", "-t", "shop"], spark) == 0
    assert cli.main([*base, "migrate"], spark) == 0


def test_arrivals_start_runs(spark, tmp_path):
    config = build(tmp_path, files={"orders/batch_01.csv": FILES["orders/batch_01.csv"]})
    for s in config.tenants["shop"].sources:
        (tmp_path / "shop" / s).mkdir(parents=True, exist_ok=True)
    told = []
    for expected in (1, 1):  # nothing new the second time
        watch.watch(spark, config, str(tmp_path / "store"), "shop", str(tmp_path / "checkpoint"), once=True, told=told.append).awaitTermination(300)
        assert len(told) == expected
    assert TenantSession(spark, str(tmp_path / "store"), "shop").read("stg.orders").count() == 4


def test_rolling_counts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join(json.dumps({"occurred_at": f"2026-01-0{d}T10:00:00", "type": "open", "campaign_id": c}) for d, c in ((1, "c1"), (1, "c1"), (2, None), (5, "c1"))))
    events = spark.readStream.schema("occurred_at timestamp, type string, campaign_id string").json(str(tmp_path / "in"))
    q = watch.rolling_counts(events).writeStream.format("memory").queryName("rolling").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(str(r[0]), r[1], r[3]) for r in spark.table("rolling").collect()} >= {("2026-01-01", "c1", 2), ("2026-01-02", "(none)", 1)}
