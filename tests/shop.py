"""A small tenant's deliveries, written anew for each scenario."""

import json
from datetime import datetime

from tidemark import config as configs

NOW = datetime(2026, 3, 1, 12)
SOURCES = [
    {"source": "orders", "format": "csv", "natural_key": ["order_id"], "event_time": "created_at", "fields": {
        "order_id": {"from": ["order_id"], "type": "string", "required": True}, "created_at": {"from": ["created_at"], "type": "timestamp", "required": True},
        "channel": {"from": ["channel"], "type": "string", "required": True, "normalize": "channel"}, "gross": {"from": ["gross"], "type": "money", "required": True},
        "currency": {"from": ["currency"], "type": "string", "required": True, "normalize": "uppercase"}, "customer_email": {"from": ["customer_email"], "type": "string", "normalize": "lowercase"}}},
    {"source": "refunds", "format": "csv", "natural_key": ["refund_id"], "event_time": "refunded_at", "fields": {
        "refund_id": {"from": ["refund_id"], "type": "string", "required": True}, "refunded_at": {"from": ["refunded_at"], "type": "timestamp", "required": True},
        "order_id": {"from": ["order_id"], "type": "string", "required": True}, "amount": {"from": ["amount"], "type": "money", "required": True}, "currency": {"from": ["currency"], "type": "string", "required": True, "normalize": "uppercase"}}},
    {"source": "ad_spend", "format": "csv", "natural_key": ["spend_date", "campaign_id"], "event_time": "spend_date", "fields": {
        "spend_date": {"from": ["date"], "type": "date", "required": True}, "campaign_id": {"from": ["campaign_id"], "type": "string", "required": True},
        "platform": {"from": ["platform"], "type": "string", "required": True, "normalize": "platform"}, "spend": {"from": ["spend", "cost_usd"], "type": "money", "required": True}}},
    {"source": "email_events", "format": "ndjson", "natural_key": ["event_id"], "event_time": "occurred_at", "fields": {
        "event_id": {"from": ["event_id"], "type": "string", "required": True}, "occurred_at": {"from": ["occurred_at"], "type": "timestamp", "required": True},
        "type": {"from": ["type"], "type": "string", "required": True, "normalize": "event_type"}, "email": {"from": ["email"], "type": "string", "normalize": "lowercase"}, "campaign_id": {"from": ["campaign_id"], "type": "string"}}},
]
WINDOWS = {1: ("2026-01-01", "2026-01-02"), 2: ("2026-01-03", "2026-01-04"), 3: ("2026-01-05", "2026-01-06")}
FILES = {
    "orders/batch_01.csv": "﻿order_id,created_at,channel,gross,currency,customer_email\no1,2026-01-01T10:00:00Z,Facebook,100.00,usd,A@X.com\no2,2026-01-01T11:00:00Z,google,50.5,USD,\n\no3,2026-01-02T09:00:00Z,email,20,USD,\"q\"\"\nn@x.com\"\no4,2026-01-02T23:59:59Z,direct,10.00,USD,d@x.com\n",
    "orders/batch_02.csv": "order_id,created_at,channel,gross,currency,customer_email\no4,2026-01-02T23:59:59Z,direct,10.00,USD,d@x.com\no5,2026-01-03T10:00:00Z,google,30.00,USD,e@x.com\no6,2026-01-04T10:00:00Z,facebook,40.00,USD\n",
    "orders/batch_03.csv": "order_id,created_at,channel,gross,currency,customer_email\no7,2026-01-05T10:00:00Z,google,70.00,USD,\no8,2026-01-06T10:00:00Z,facebook,80.00,USD,\no9,2026-01-02T08:00:00Z,facebook,5.00,USD,\no5,2026-01-03T10:00:00Z,google,31.00,USD,e@x.com\n",
    "refunds/batch_01.csv": "refund_id,refunded_at,order_id,amount,currency\nr1,2026-01-02T10:00:00Z,o5,3.00,USD\nr2,2026-01-02T10:00:00Z,nowhere,2.00,USD\nr3,2026-01-01T12:00:00Z,o1,7.00,USD\n",
    "refunds/batch_02.csv": "refund_id,refunded_at,order_id,amount,currency\nr4,2026-01-04T10:00:00Z,o6,4.00,USD\n",
    "refunds/batch_03.csv": "refund_id,refunded_at,order_id,amount,currency\nr5,2026-01-05T10:00:00Z,o2,1.00,USD\n",
    "ad_spend/batch_01.csv": "date,campaign_id,platform,spend\n2026-01-01,c1,facebook,9.00\n2026-01-02,c1,facebook,8.00\n",
    "ad_spend/batch_03.csv": "date,campaign_id,platform,cost_usd\n2026-01-05,c1,Facebook,7.00\n2026-01-06,c1,facebook,6.00\n",
    "email_events/batch_01.ndjson": '{"event_id":"e1","occurred_at":"2026-01-01T01:00:00Z","type":"delivered","email":"A@x","campaign_id":"c1"}\n\n[1]\nnot json\n{"event_id":"e2","occurred_at":"2026-01-01T01:00:00.250Z","type":"OPEN","campaign_id":null}\n{"event_id":"e3","occurred_at":"2026-01-01T02:00:00Z","type":"bounce"}\n{"event_id":"e4","occurred_at":"2026-01-01 02:00","type":"click"}\n',
}


def build(folder, late="restate", unknown="quarantine", files=None, labels=None):
    """Writes the deliveries under folder; gives the configuration."""
    batches = [{"tenant": "shop", "source": s, "batch": b, "path": f"shop/{s}/batch_0{b}", "covers_from": w[0], "covers_to": w[1]} for s in ("orders", "refunds", "ad_spend") for b, w in WINDOWS.items()]
    (folder / "manifest.json").write_text(json.dumps({"batches": [*batches, dict(batches[0], tenant="other")]}))
    for name, text in (files or FILES).items():
        p = folder / "shop" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    sources = {s["source"]: configs.parse_source(s) for s in SOURCES}
    tenant = {
        "id": "shop", "display_name": "Shop", "currency": "USD", "sources": {s: {"path": f"shop/{s}/*"} for s in sources},
        "normalize": {"channel": labels or {"facebook": "paid_social", "google": "paid_search", "email": "email", "direct": "direct"}, "platform": {"facebook": "paid_social"}, "event_type": {"open": "open", "click": "click", "delivered": "delivered", "bounce": "bounce"}},
        "expected_deliveries": {"manifest": "manifest.json"}, "policies": {"late_arrivals": late, "unknown_schema": unknown},
    }
    return configs.Config(str(folder), sources, {"shop": configs.parse_tenant(tenant, sources)})


KEPT = ("mart.daily_revenue", "mart.daily_email", "stg.orders", "stg.refunds", "stg.ad_spend", "stg.email_events", "ops.quarantine")


def snapshot(session, tables=KEPT):
    """Rows of the tables, without clocks, runs and counters of deliveries."""
    loose = {"built_by_run", "at", "times_seen", "last_file_load_id", "first_file_load_id", "file_load_id", "ref", "line_no"}
    out = {}
    for t in tables:
        df = session.read(t)
        out[t] = sorted(map(repr, df.select(*[c for c in df.columns if c not in loose]).collect()))
    return out
