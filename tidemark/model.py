"""Tables of the store: names, columns, keys and how each is kept."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import types as T

if TYPE_CHECKING:
    from .store import TenantSession

VERSION = 1
#: What brings a store of the version before to each version: a function of the tenant's session, run in one commit.
MIGRATIONS: dict[int, Callable[[TenantSession], None]] = {}


_KINDS = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "decimal(14,2)": T.DecimalType(14, 2), "array<string>": T.ArrayType(T.StringType())}


def _schema(fields: str) -> T.StructType:
    """Fields given as `name type, name type`; needs no session."""
    return T.StructType([T.StructField(n, _KINDS[t]) for n, t in (f.split(" ") for f in fields.split(", "))])


@dataclass(frozen=True)
class Table:
    """part: the column whose values are its partitions (None: one partition), by blocks of `width` values if that is set.

    sort: the order of rows inside a file; shared: one folder may hold rows of several
    partitions.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    part: str | None = None
    width: int = 0
    sort: tuple[str, ...] = ()
    shared: bool = False


_STAGED = "posting_day date, content_hash string, first_file_load_id long, last_file_load_id long, times_seen int"

STAGING: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    # source: (natural key, columns in hashing order)
    "orders": (("order_id",), ("order_id", "created_at", "channel", "channel_raw", "gross", "currency", "customer_email")),
    "email_events": (("event_id",), ("event_id", "occurred_at", "type", "email", "campaign_id")),
    "ad_spend": (("spend_date", "campaign_id"), ("spend_date", "campaign_id", "platform", "platform_raw", "spend", "currency", "schema_version")),
    "refunds": (("refund_id",), ("refund_id", "refunded_at", "order_id", "amount", "currency")),
}
#: Columns that aren't strings.
TYPES = {"created_at": "timestamp", "occurred_at": "timestamp", "refunded_at": "timestamp", "spend_date": "date", "gross": "decimal(14,2)", "spend": "decimal(14,2)", "amount": "decimal(14,2)"}


def staged_schema(source: str) -> T.StructType:
    own = ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in STAGING[source][1])
    return _schema(f"tenant_id string, {own}, {_STAGED}")


CATALOGUE: dict[str, Table] = {
    t.name: t
    for t in (
        Table("ops.tenants", _schema("tenant_id string, display_name string, currency string, config_hash string"), ("tenant_id",)),
        Table("ops.runs", _schema("tenant_id string, id long, started_at timestamp, finished_at timestamp, status string, args string, stats string, error string"), ("id",), "id", 100),
        Table("ops.expected_deliveries", _schema("tenant_id string, source string, batch int, path string, covers_from date, covers_to date"), ("source", "batch")),
        Table(
            "raw.file_loads",
            _schema("tenant_id string, id long, source string, path string, sha256 string, byte_size long, batch int, columns array<string>, schema_version string, status string, quarantine_reason string, rows_seen long, rows_committed long, attempts int, run_id long, loaded_at timestamp, last_seen_at timestamp, staged_at timestamp"),
            ("id",),
            "id",
            1000,
        ),
        Table("raw.records", _schema("tenant_id string, source string, file_load_id long, line_no long, payload string, error string"), ("file_load_id", "line_no"), "file_load_id", shared=True),
        *(Table(f"stg.{s}", staged_schema(s), STAGING[s][0], "posting_day") for s in STAGING),
        *(Table(f"keys.{s}", _schema("tenant_id string, k string, posting_day date, bucket int"), ("k",), "bucket", sort=("k",)) for s in STAGING),
        Table("ops.quarantine", _schema("tenant_id string, source string, file_load_id long, line_no long, ref string, reason string, detail string, at timestamp"), ("source", "ref", "reason")),
        Table("ops.schema_events", _schema("tenant_id string, source string, file_load_id long, kind string, detail string, at timestamp"), ()),
        Table("ops.conflicts", _schema("tenant_id string, source string, natural_key string, file_load_id long, line_no long, previous string, incoming string, at timestamp"), ()),
        Table("ops.dirty_days", _schema("tenant_id string, day date, sources array<string>"), ("day",)),
        # Refunds that were staged or changed since marts were built, whose order hasn't been looked for.
        Table("ops.unchecked", _schema("tenant_id string, ref string"), ("ref",)),
        # What staged changes add to a day, until marts take it.
        Table("ops.sold_changes", _schema("tenant_id string, day date, dimension string, orders long, gross decimal(14,2)"), (), "day"),
        Table("ops.email_changes", _schema("tenant_id string, day date, dimension string, events long, delivered long, opens long, clicks long, unsubscribes long"), (), "day"),
        Table("ops.restatements", _schema("tenant_id string, mart string, day date, dimension string, metric string, previous decimal(14,2), current decimal(14,2), run_id long, cause string, at timestamp"), ()),
        Table("mart.daily_revenue", _schema("tenant_id string, day date, channel string, orders long, gross decimal(14,2), refunds decimal(14,2), net decimal(14,2), currency string, complete boolean, built_by_run long"), ("day", "channel"), "day"),
        Table("mart.daily_email", _schema("tenant_id string, day date, campaign_id string, events long, delivered long, opens long, clicks long, unsubscribes long, built_by_run long"), ("day", "campaign_id"), "day"),
    )
}
