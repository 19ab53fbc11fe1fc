"""Raw records to typed rows: which column is which field, and which rows are held."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Source, Tenant
from ..functions import coerce
from ..model import STAGING, TYPES

RETRIABLE = ("unmapped_value", "bad_value", "missing_required")


@dataclass(frozen=True)
class Resolved:
    fields: dict[str, str | None]
    missing_required: list[str]
    unknown_columns: list[str]
    aliases_used: list[tuple[str, str]]

    @property
    def version(self) -> str:
        return ",".join(f"{f}={a}" for f, a in self.aliases_used) or "v1"


def resolve(spec: Source, columns: list[str]) -> Resolved:
    """The first declared name of each field that a file offers."""
    there = set(columns)
    fields = {name: next((c for c in f.names if c in there), None) for name, f in spec.fields.items()}
    return Resolved(
        fields,
        [name for name, f in spec.fields.items() if f.required and fields[name] is None],
        [c for c in columns if c not in set(fields.values())],
        [(name, hit) for name, hit in fields.items() if hit is not None and hit != spec.fields[name].names[0]],
    )


def schema_events(resolved: Resolved) -> list[tuple[str, dict]]:
    out: list[tuple[str, dict]] = [("alias_used", {"field": f, "alias": a}) for f, a in resolved.aliases_used]
    if resolved.unknown_columns:
        out.append(("unknown_columns", {"columns": resolved.unknown_columns}))
    if resolved.missing_required:
        out.append(("missing_required", {"fields": resolved.missing_required}))
    return out


def fingerprint(spec: Source, tenant: Tenant) -> str:
    """A hash of all that decides how a source's records are mapped."""
    return hashlib.sha256(json.dumps([asdict(spec), tenant.normalize, tenant.currency], sort_keys=True).encode()).hexdigest()[:16]


def _held(reason: str, **detail: Column) -> Column:
    return F.struct(F.lit(reason).alias("reason"), F.to_json(F.struct(*[c.alias(k) for k, c in detail.items()])).alias("detail"))


def map_rows(records: DataFrame, spec: Source, tenant: Tenant) -> DataFrame:
    """records (file_load_id, line_no, payload, error, schema_version) with `held` (null, or a reason and detail: that of the first failing field), `k`, `content_hash`, `day` and the staging columns.

    A field takes the first of its declared names whose key the record has, even if
    the value there is null or blank. Each step below is a projection of its own, so
    that a payload is parsed once and a value trimmed and typed once.
    """
    rows = records.withColumn("_p", F.from_json("payload", "map<string,string>"))
    raws, values, goods = {}, {}, {}
    for name, f in spec.fields.items():
        raw = F.lit(None).cast("string")
        for c in reversed(f.names):
            raw = F.when(F.map_contains_key("_p", F.lit(c)), F.element_at("_p", F.lit(c))).otherwise(raw)
        raws[f"_raw_{name}"] = raw
        values[f"_value_{name}"] = coerce.present(F.col(f"_raw_{name}"))
        goods[f"_good_{name}"] = coerce.typed(F.col(f"_value_{name}"), f.type)
    rows = rows.withColumns(raws).withColumns(values).withColumns(goods)
    problems = [F.when(F.col("error").isNotNull(), _held("unparseable", error=F.col("error")))]
    strings: dict[str, Column] = {}
    for name, f in spec.fields.items():
        raw, value, good = F.col(f"_raw_{name}"), F.col(f"_value_{name}"), F.col(f"_good_{name}")
        if f.required:
            problems.append(F.when(value.isNull(), _held("missing_required", field=F.lit(name))))
        problems.append(F.when(value.isNotNull() & good.isNull(), _held("bad_value", field=F.lit(name), value=raw, error=coerce.problem(value, f.type))))
        text = good.cast("string") if f.type == "money" else value  # as stored and hashed: money to two places
        if f.normalize == "lowercase":
            text = F.lower(text)
        elif f.normalize == "uppercase":
            text = F.upper(text)
        elif f.normalize:
            known = coerce.label(text, tenant.normalize.get(f.normalize, {}))
            problems.append(F.when(value.isNotNull() & known.isNull(), _held("unmapped_value", field=F.lit(name), value=value, map=F.lit(f.normalize))))
            strings[f"{name}_raw"] = text
            text = known
        strings[name] = text
    problems.append(F.when(strings[spec.event_time].isNull(), _held("missing_required", field=F.lit(spec.event_time))))
    strings["currency"] = F.coalesce(strings.get("currency", F.lit(None).cast("string")), F.lit(tenant.currency))
    strings["schema_version"] = F.col("schema_version")
    key, columns = STAGING[spec.source]
    # Spark would push a filter on `held` below all this, and so work it out again from the payload; it doesn't push one
    # below what isn't deterministic.
    held = F.when(F.spark_partition_id() >= 0, coerce.first_of(problems))
    rows = rows.select(
        "file_load_id", "line_no", held.alias("held"), coerce.utc_day(strings[spec.event_time]).alias("event_day"),
        *[strings.get(c, F.lit(None).cast("string")).alias(f"s_{c}") for c in columns],
    )
    text = {c: F.col(f"s_{c}") for c in columns}
    return rows.select(
        "file_load_id", "line_no", "held", "event_day",
        coerce.natural_key([text[c] for c in key]).alias("k"),
        coerce.content_hash([text[c] for c in columns]).alias("content_hash"),
        *[coerce.typed(text[c], {"timestamp": "timestamp", "date": "date"}.get(TYPES.get(c, ""), "money" if c in TYPES else "string")).alias(c) for c in columns],
    )


def quarantined(mapped: DataFrame) -> DataFrame:
    """Held rows, by reference `file:line`."""
    held = mapped.where(F.col("held").isNotNull())
    return held.select("file_load_id", "line_no", F.concat_ws(":", "file_load_id", "line_no").alias("ref"), "held.reason", "held.detail")
