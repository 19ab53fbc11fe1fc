"""Source and tenant specifications, read from YAML or JSON and validated on the driver."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import asdict, dataclass, field
from pathlib import Path

#: The canonical vocabularies.
CHANNELS = ("paid_social", "paid_search", "email", "direct", "affiliate", "other")
EVENT_TYPES = ("delivered", "open", "click", "unsubscribe", "bounce")
SOURCE_ORDER = ("orders", "email_events", "ad_spend", "refunds")
CHANNEL_ORDER = (*CHANNELS, "unattributed")
FIELD_TYPES = ("string", "timestamp", "date", "money")
TENANT_ID = re.compile(r"[a-z0-9_-]+")


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Field:
    names: tuple[str, ...]
    type: str
    required: bool = False
    normalize: str | None = None


@dataclass(frozen=True)
class Source:
    source: str
    format: str
    natural_key: tuple[str, ...]
    event_time: str
    fields: dict[str, Field]


@dataclass(frozen=True)
class Tenant:
    id: str
    display_name: str
    currency: str
    sources: dict[str, str]  # source: glob
    normalize: dict[str, dict[str, str]] = field(default_factory=dict)
    campaign_map: dict[str, str] = field(default_factory=dict)
    manifest: str | None = None
    late_arrivals: str = "restate"
    unknown_schema: str = "quarantine"
    freeze_in_load_order: bool = False  # close days only by deliveries that loaded before the file

    @property
    def hash(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Config:
    base: str  # folder that globs and manifests are relative to
    sources: dict[str, Source]
    tenants: dict[str, Tenant]

    def tenant(self, tenant_id: str) -> Tenant:
        if tenant_id not in self.tenants:
            raise ConfigError(f"unknown tenant {tenant_id!r}; known: {', '.join(sorted(self.tenants))}")
        return self.tenants[tenant_id]


def _only(raw: dict, allowed: set[str], where: str) -> None:
    if unknown := set(raw) - allowed:
        raise ConfigError(f"{where}: unknown keys {', '.join(sorted(unknown))}")


def parse_source(raw: dict) -> Source:
    where = f"source {raw.get('source')}"
    _only(raw, {"source", "format", "natural_key", "event_time", "fields"}, where)
    if raw.get("format") not in ("csv", "ndjson"):
        raise ConfigError(f"{where}: format must be csv or ndjson")
    fields = {}
    for name, f in raw["fields"].items():
        _only(f, {"from", "type", "required", "normalize"}, f"{where}, field {name}")
        if f.get("type") not in FIELD_TYPES or not f.get("from"):
            raise ConfigError(f"{where}, field {name}: needs a type of {', '.join(FIELD_TYPES)} and column names")
        fields[name] = Field(tuple(f["from"]), f["type"], bool(f.get("required", False)), f.get("normalize"))
    for x in (*raw["natural_key"], raw["event_time"]):
        if x not in fields:
            raise ConfigError(f"{where}: {x} isn't a declared field")
    return Source(raw["source"], raw["format"], tuple(raw["natural_key"]), raw["event_time"], fields)


def parse_tenant(raw: dict, sources: dict[str, Source]) -> Tenant:
    where = f"tenant {raw.get('id')}"
    _only(raw, {"id", "display_name", "currency", "sources", "normalize", "campaign_map", "expected_deliveries", "policies"}, where)
    if not TENANT_ID.fullmatch(str(raw.get("id", ""))):
        raise ConfigError(f"{where}: bad id")
    if not re.fullmatch(r"[A-Za-z]{3}", str(raw.get("currency", ""))):
        raise ConfigError(f"{where}: currency must be three letters")
    for s, spec in raw["sources"].items():
        if s not in sources:
            raise ConfigError(f"{where}: unknown source {s}")
        _only(spec, {"path"}, f"{where}, source {s}")
    canonical = {"channel": CHANNELS, "platform": CHANNELS, "event_type": EVENT_TYPES}
    for kind, labels in raw.get("normalize", {}).items():
        if kind not in canonical:
            raise ConfigError(f"{where}: unknown map {kind}")
        for k, v in labels.items():
            if k != k.lower() or v not in canonical[kind]:
                raise ConfigError(f"{where}: bad entry {k}: {v} in map {kind}")
    policies = raw.get("policies", {})
    _only(policies, {"late_arrivals", "unknown_schema", "freeze_in_load_order"}, f"{where}, policies")
    late, unknown = policies.get("late_arrivals", "restate"), policies.get("unknown_schema", "quarantine")
    if late not in ("restate", "freeze") or unknown not in ("quarantine", "fail"):
        raise ConfigError(f"{where}: bad policy")
    manifest = (raw.get("expected_deliveries") or {}).get("manifest")
    return Tenant(
        raw["id"], raw.get("display_name", raw["id"]), raw["currency"].upper(), {s: x["path"] for s, x in raw["sources"].items()}, raw.get("normalize", {}), raw.get("campaign_map", {}), manifest, late, unknown, bool(policies.get("freeze_in_load_order", False))
    )


def read(path: Path) -> dict:
    text = path.read_text()
    if path.suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ModuleNotFoundError as e:
        raise ConfigError(f"{path}: YAML needs the yaml package; JSON works without it") from e
    return yaml.safe_load(text)


def load(folder: str, base: str) -> Config:
    """folder holds sources/ and tenants/; names with a leading underscore are passed over."""
    files = lambda sub: sorted(p for p in Path(folder, sub).iterdir() if p.suffix in (".yaml", ".yml", ".json") and not p.name.startswith("_"))
    sources = {s.source: s for s in (parse_source(read(p)) for p in files("sources"))}
    tenants = {t.id: t for t in (parse_tenant(read(p), sources) for p in files("tenants"))}
    return Config(base, sources, tenants)
