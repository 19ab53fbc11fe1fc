"""Operators of the engine on small frames, and properties of the merge."""

import hashlib
import json
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import config as configs
from tidemark.functions import coerce, display
from tidemark.operators import checks, mapping, marts, merge
from tidemark.plans import pipeline
from tidemark.report import run_context, table
from tidemark.sources import files

D = date


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in rows.select("i", f(F.col("c")).alias("x")).orderBy("i").select("x").collect()]


def test_strict_types(spark):
    assert column(spark, ["1", "-1.5", "1.005", "12,5", "1e3", "+1", ".5", "1.", "12345678901234"], coerce.money) == [Decimal("1.00"), Decimal("-1.50"), None, None, None, None, None, None, None]
    assert column(spark, ["2026-01-31", "2026-02-30", "2026-1-1", "20260101"], coerce.date) == [D(2026, 1, 31), None, None, None]
    at = column(spark, ["2026-01-16T21:33:00Z", "2026-01-16T21:33:09.534Z", "2026-01-16T21:33:09.1234567Z", "2026-01-16 21:33:00Z", "2026-02-30T00:00:00Z", "2026-01-16T21:33:00+01:00"], coerce.timestamp)
    assert [a is not None for a in at] == [True, True, False, False, False, False] and at[1].microsecond == 534000
    assert column(spark, [" a ", " b﻿", " ", "", None, "c d"], coerce.present) == ["a", "b", None, None, None, "c d"]
    assert column(spark, ["Facebook", "x"], lambda c: coerce.label(c, {"facebook": "paid_social"})) == ["paid_social", None]
    assert column(spark, ["2026-01-02T23:59:59Z"], coerce.utc_day) == [D(2026, 1, 2)]


def test_display(spark):
    money = lambda c: display.money(c.cast("decimal(14,2)"))
    assert column(spark, ["1247.12", "-95.1", None, "0"], money) == ["1,247.12", "(95.10)", "", "0.00"]
    assert column(spark, [158, -1200], lambda c: display.delta(c, F.lit(False)), "int") == ["+158", "(1,200)"]
    assert column(spark, ["late or changed records in: ad_spend, refunds", "x", "a:"], display.sources_of_cause) == [["ad_spend", "refunds"], [], []]
    assert column(spark, ["USD", "CHF"], display.symbol) == ["$", "CHF"]
    assert column(spark, ["2026-09-21T14:32:50.123Z", None], display.stamp) == ["2026-09-21 14:32:50", ""]
    assert column(spark, ["2026-01-01", "2026-01-09", "2026-01-20"], lambda c: display.overdue_days(c.cast("date"), F.lit("2026-01-10").cast("date"))) == [8, 0, 0]


def test_batches():
    assert [files.batch_number(p) for p in ("a/batch_03.csv", "batch_9/x.csv", "x_batch_12_y")] == [3, None, 12]
    assert [files.batch_allowed("1-3,7", b) for b in (1, 3, 4, 7, None)] == [True, True, False, True, False] and files.batch_allowed(None, None)


def test_csv_quirks(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('﻿a,b,c\n1,"x\ny",3\n\n2,\n3,"say ""hi""",5,6\n')
    (tmp_path / "empty.csv").write_text("a,b\n")
    got = {r["line_no"]: json.loads(r["payload"]) for r in files.records(spark, [str(p)], "csv").collect()}
    # Spark's reader doesn't tell an empty cell from one that isn't there.
    assert got == {1: {"a": "1", "b": "x\ny", "c": "3"}, 2: {"a": "2"}, 3: {"a": "3", "b": 'say "hi"', "c": "5"}}
    assert files.header(spark, str(p), "csv") == ["a", "b", "c"] and files.header(spark, str(tmp_path / "empty.csv"), "csv") == []
    assert [len(x) for x in files.fingerprints(spark, [str(p)]).values()] == [64]
    assert [(r, n) for _, r, n in files.discover(spark, str(tmp_path), "*.csv")] == [("a.csv", p.stat().st_size), ("empty.csv", 4)]


def random_csv(rng, rows):
    """A file with quoted line ends, quotes, blank lines, short and long rows, and quotes in plain values."""
    def value():
        kind = rng.random()
        if kind < 0.15:
            return '"' + "".join(rng.choice(["x", ",", "\n", '""', " ", "\n\n", "\r\n"]) for _ in range(rng.randrange(12))) + '"'
        return "" if kind < 0.2 else f'{rng.randrange(99)}" wide' if kind < 0.23 else str(rng.randrange(10**6))

    out = ["\ufeffa,b,c"]
    for _ in range(rows):
        out.append(",".join(value() for _ in range(rng.choice([3, 3, 3, 2, 4]))))
        out += [""] * (rng.random() < 0.05)
    return "\n".join(out) + rng.choice(["", "\n"])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_csv_by_byte_ranges_is_the_read_of_one_task(spark, tmp_path, seed):
    rng = random.Random(seed)
    p = tmp_path / "with blank.csv"
    with open(p, "w", newline="") as f:
        f.write(random_csv(rng, 400))
    names = ["a", "b", "c"]
    whole = [{c: v for c, v in zip(names, r, strict=True) if v is not None} for r in files._whole(spark, str(p)).select(*names).collect()]
    assert any("\n" in v for r in whole for v in r.values())
    for most in ("128m", "2000", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            found = files.records(spark, [str(p)], "csv", names)
            got = {r.line_no: json.loads(r.payload) for r in found.collect()}
            assert [got[i + 1] for i in range(len(got))] == whole
            assert most == "128m" or files._text(spark, [str(p)]).rdd.getNumPartitions() > 3
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_fingerprints_of_large_files_are_streamed(spark, tmp_path):
    p = tmp_path / "large"
    with open(p, "wb") as f:
        f.write(b"head")
        f.truncate(3 << 30)  # a sparse file, larger than a row can be
    digest = hashlib.sha256(b"head")
    rest = (3 << 30) - 4
    while rest:
        n = min(rest, 1 << 24)
        digest.update(bytes(n))
        rest -= n
    assert files.fingerprints(spark, [str(p), f"file:{p}"]) == dict.fromkeys([str(p), f"file:{p}"], digest.hexdigest())


def test_many_files_are_numbered_alone(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.ndjson").write_text("\n".join(json.dumps({"id": i}) for i in range(k + 2)) + "\n\n")
    got = files.records(spark, [str(tmp_path / f"{k}.ndjson") for k in range(3)], "ndjson").collect()
    assert sorted((r["path"][-8], r["line_no"], json.loads(r["payload"])["id"]) for r in got) == [(str(k), i + 1, i) for k in range(3) for i in range(k + 2)]


SPEC = configs.parse_source({"source": "ad_spend", "format": "csv", "natural_key": ["spend_date", "campaign_id"], "event_time": "spend_date", "fields": {
    "spend_date": {"from": ["date"], "type": "date", "required": True}, "campaign_id": {"from": ["campaign_id"], "type": "string", "required": True},
    "platform": {"from": ["platform"], "type": "string", "required": True, "normalize": "platform"}, "spend": {"from": ["spend", "cost_usd"], "type": "money", "required": True}}})
TENANT = configs.Tenant("t", "T", "EUR", {"ad_spend": "*"}, {"platform": {"facebook": "paid_social"}})


def test_resolution():
    r = mapping.resolve(SPEC, ["date", "campaign_id", "platform", "cost_usd", "extra"])
    assert (r.version, r.unknown_columns, r.missing_required, r.aliases_used) == ("spend=cost_usd", ["extra"], [], [("spend", "cost_usd")])
    held = mapping.resolve(SPEC, ["date", "campaign_id", "platform", "cost"])
    assert held.missing_required == ["spend"] and [k for k, _ in mapping.schema_events(held)] == ["unknown_columns", "missing_required"]


def test_first_present_alias_and_first_failing_field(spark):
    rows = [
        {"date": "2026-01-01", "campaign_id": "c", "platform": "FaceBook", "spend": "", "cost_usd": "5"},  # spend is there, and blank
        {"date": "2026-01-01", "campaign_id": "c", "platform": "FaceBook", "cost_usd": "5"},
        {"date": "bad", "campaign_id": "", "platform": "x", "spend": "1"},
        {"date": "2026-01-01", "campaign_id": "c", "platform": "tiktok", "spend": "1.234"},
        {"date": "2026-01-01", "campaign_id": "c", "platform": "facebook", "spend": None, "cost_usd": "5"},
    ]
    df = spark.createDataFrame([(1, i, json.dumps(r), None, "v1") for i, r in enumerate(rows)], "file_load_id long, line_no long, payload string, error string, schema_version string")
    mapped = mapping.map_rows(df, SPEC, TENANT)
    held = {r["line_no"]: (r["reason"], json.loads(r["detail"])["field"]) for r in mapping.quarantined(mapped).collect()}
    assert held == {0: ("missing_required", "spend"), 2: ("bad_value", "spend_date"), 3: ("unmapped_value", "platform"), 4: ("missing_required", "spend")}
    good = mapped.where("held is null").collect()
    assert [(r["platform"], r["platform_raw"], r["spend"], r["currency"], r["k"]) for r in good] == [("paid_social", "FaceBook", Decimal("5.00"), "EUR", "2026-01-01|c")]


PRIOR = "k string, v string, content_hash string, posting_day date, first_file_load_id long, last_file_load_id long, times_seen int"
NEW = "k string, v string, content_hash string, day date, event_day date, file_load_id long, line_no long"


@pytest.mark.parametrize("retry", [False, True])
def test_merge_is_the_row_loop(spark, retry):
    rng = random.Random(4)
    day = lambda: D(2026, 1, rng.randint(1, 5))
    for _ in range(4):
        prior = [(f"k{i}", v, v, day(), 1, 2, rng.randint(1, 3)) for i in range(6) for v in [rng.choice("ab")] if rng.random() < 0.6]
        new = [(f"k{rng.randint(0, 8)}", v, v, d, d, f, n) for f in (3, 4, 5) for n in range(6) for v, d in [(rng.choice("abc"), day())]]
        state = {r[0]: list(r[1:]) for r in prior}
        want = []
        for k, v, h, d, _, f, n in sorted(new, key=lambda r: (r[5], r[6])):
            if k not in state:
                state[k] = [v, h, d, f, f, 1]
                want.append((k, f, n, "inserted"))
            elif state[k][1] == h:
                want.append((k, f, n, "unchanged"))
                if not retry:
                    state[k][4], state[k][5] = f, state[k][5] + 1
            else:
                state[k] = [v, h, *state[k][2:4], f, state[k][5] + 1]
                want.append((k, f, n, "updated"))
        got = merge.merge(spark.createDataFrame(prior, PRIOR), spark.createDataFrame(new, NEW), "k", ["v"], retry=retry)
        assert sorted((r["k"], r["file_load_id"], r["line_no"], r["outcome"]) for r in got.outcomes.collect()) == sorted(want)
        touched = {k for k, *_, o in want if not retry or o != "unchanged"}
        assert {r["k"]: [r["v"], r["content_hash"], r["posting_day"], r["first_file_load_id"], r["last_file_load_id"], r["times_seen"]] for r in got.state.collect()} == {k: state[k] for k in touched}


def test_update_dirties_the_new_day_and_stays_on_the_old(spark):
    prior = spark.createDataFrame([("k", "a", "a", D(2026, 1, 1), 1, 1, 1)], PRIOR)
    new = spark.createDataFrame([("k", "b", "b", D(2026, 1, 3), D(2026, 1, 3), 2, 1)], NEW)
    got = merge.merge(prior, new, "k", ["v"])
    assert got.state.first()["posting_day"] == D(2026, 1, 1) and [r["day"] for r in merge.changed_days(got.outcomes, "s").collect()] == [D(2026, 1, 3)]


@pytest.mark.parametrize(("in_order", "want"), [(False, [15, 15, 2]), (True, [1, 15, 2])])
def test_freeze_by_any_other_delivery_or_by_earlier_ones(spark, in_order, want):
    rows = spark.createDataFrame([(1, 0, D(2026, 1, 1)), (5, 1, D(2026, 1, 1)), (2, 2, D(2026, 1, 2))], "file_load_id long, i int, event_day date")
    closed = spark.createDataFrame([(1, D(2026, 1, 1), D(2026, 1, 1)), (2, D(2026, 1, 1), D(2026, 1, 2))], "file_load_id long, covers_from date, covers_to date")
    got = merge.posting_days(rows, closed, F.lit(D(2026, 1, 15)), in_order).orderBy("i").collect()
    assert [r["day"].day for r in got] == want


def test_restated(spark):
    schema = "day date, dimension string, n long, v decimal(14,2)"
    old = spark.createDataFrame([(D(2026, 1, 1), "a", 1, Decimal("2.00")), (D(2026, 1, 1), "gone", 0, Decimal("3.00")), (D(2026, 1, 1), "same", 1, Decimal("1.00"))], schema)
    new = spark.createDataFrame([(D(2026, 1, 1), "a", 2, Decimal("2.00")), (D(2026, 1, 1), "new", 9, Decimal("9.00")), (D(2026, 1, 1), "same", 1, Decimal("1.00"))], schema)
    got = {(r["dimension"], r["metric"], int(r["previous"]), int(r["current"])) for r in marts.restated(old, new, ("n", "v")).collect()}
    assert got == {("a", "n", 1, 2), ("gone", "v", 3, 0)}


def test_two_files_with_one_batch_number_fan_out(spark):
    expected = spark.createDataFrame([("s", 1, "p", D(2026, 1, 1), D(2026, 1, 2))], "source string, batch int, path string, covers_from date, covers_to date")
    loads = spark.createDataFrame([("s", 1, "loaded", 5, "v1"), ("s", 1, "quarantined", 0, "v1")], "source string, batch int, status string, rows_seen long, schema_version string")
    assert checks.deliveries(expected, loads, F.lit(D(2026, 1, 9))).count() == 2
    assert checks.freshness(expected, loads, F.lit(D(2026, 1, 9))).first()["missing"] == 1


def test_config_is_strict():
    sources = {"ad_spend": SPEC}
    good = {"id": "t", "currency": "EUR", "sources": {"ad_spend": {"path": "*"}}}
    assert configs.parse_tenant(good, sources).late_arrivals == "restate"
    assert configs.parse_tenant(good | {"id": "9-a_b", "currency": "eur"}, sources).currency == "EUR"
    for bad in ({"id": "T"}, {"currency": "eu"}, {"id": "a/b"}, {"sources": {"x": {"path": "*"}}}, {"more": 1}, {"policies": {"late_arrivals": "never"}}, {"normalize": {"channel": {"Google": "paid_search"}}}, {"normalize": {"channel": {"google": "search"}}}):
        with pytest.raises(configs.ConfigError):
            configs.parse_tenant(good | bad, sources)
    with pytest.raises(configs.ConfigError):
        configs.parse_source({"source": "s", "format": "csv", "natural_key": ["x"], "event_time": "y", "fields": {"y": {"from": ["y"], "type": "date"}}})


def test_texts():
    assert table([{"a": 1, "b": None}, {"a": 22, "b": "x"}]) == "  a   b\n  --  -\n  1\n  22  x" and table([]) == "  (none)"
    stats = {"files": [{"status": "resumed", "path": "p", "note": "after record 2"}, {"status": "duplicate"}], "marts": {"orphans_resolved": 2}}
    assert run_context("succeeded", None, stats) == "resumed: p (after record 2) | known by content: 1 | orphans settled: 2"
    assert run_context("failed", "x", {}) == "failed: x" and run_context("succeeded", None, {}) is None and run_context("running", None, {})


def test_orders_are_reduced_before_they_meet_refunds(spark):
    orders = spark.range(1000).selectExpr("cast(id AS string) AS order_id", "'c' AS channel", "cast(1 AS decimal(14,2)) AS gross", "date_add(date '2026-01-01', cast(id % 100 AS int)) AS posting_day")
    refunds = spark.range(5).selectExpr("cast(id * 7 AS string) AS order_id", "cast(1 AS decimal(14,2)) AS amount", "date '2026-01-03' AS posting_day")
    days = spark.createDataFrame([(D(2026, 1, 3),)], "day date")
    out = marts.revenue(orders, refunds, F.broadcast(days))
    assert [(r.dimension, r.orders, r.refunds) for r in out.collect()] == [("c", 10, Decimal("5.00"))]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi, (order_id" in plan and plan.index("LeftOuter") < plan.index("LeftSemi, (order_id")


def test_a_filter_on_held_works_out_each_value_once(spark):
    records = spark.range(1).selectExpr("id as file_load_id", "id as line_no", "concat('{', cast(id as string), '}') as payload", "cast(null as string) as error", "'v1' as schema_version")
    plan = mapping.quarantined(mapping.map_rows(records, SPEC, TENANT))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("trim(") == len(SPEC.fields)


def test_chunks():
    row = lambda i, done=0: ("p", {"id": i, "rows_committed": done}, None)
    got = pipeline._chunks([row(1), row(2), row(3), row(4, 5), row(5), row(6)], {1: 2, 2: 3, 3: 4, 4: 12, 6: 1}, 5)
    assert [[(r["id"], a, b) for r, _, a, b in c] for c in got] == [[(1, 0, 2), (2, 0, 3)], [(3, 0, 4)], [(4, 5, 10)], [(4, 10, 15)], [(4, 15, 17)], [(5, 0, 0), (6, 0, 1)]]
