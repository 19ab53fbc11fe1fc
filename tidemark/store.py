"""Versioned tables on any file system that Spark reads, one tenant at a time.

Parquet has no MERGE, UPDATE or DELETE. A table is a set of partitions, each a list
of folders; a write makes new folders and touches nothing that is read. A log says
which folders a table has: one small file a commit, numbered, with only what the
commit changed. A file of the log is created or not at all, and never replaced, so of
two commits that follow the same version one wins and the other fails (compare and
swap); a reader sees all of a commit or none. Every CHECKPOINT commits the whole state
is written beside the log, so that what a reader or a commit costs doesn't grow with
history. vacuum() removes folders that no version kept refers to.

Staged rows are partitioned by the day that they are booked on. Beside them a table
`keys.<source>` tells the day of each natural key, in buckets by the key's hash, sorted
by key inside a file; a booked day never changes, so keys are only ever appended. A
merge reads the buckets of its new keys, then the days found there. Buckets are split
when they hold over BUCKET_ROWS keys on average.

A TenantSession is the only way to the tables: it reads and writes one tenant's
folders, and a row of another tenant fails the write. This is enforcement by API; a
process with access to the files can go round it.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from copy import deepcopy
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import model
from .config import TENANT_ID
from .model import CATALOGUE

ALL = "all"
#: Commits between two checkpoints; versions whose log is kept; folders of a partition beyond which an append joins them.
CHECKPOINT, KEPT_LOG, MOST_FOLDERS = 16, 256, 32
#: Buckets that an index of keys begins with, keys that a bucket should hold, and by how much buckets are split.
BUCKETS, BUCKET_ROWS, SPLIT = 16, 2_000_000, 4
#: How files are compressed: payloads and hashes in hexadecimal take less than with snappy.
CODEC = "zstd"
#: Spark's setting (from 4.1 on) by which a query's shuffle files go when the query ends.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of frames made and computed in here go when each has been computed; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANED)
        else:
            spark.conf.set(CLEANED, before)


class Files:
    """The few file operations that a log needs, on the store's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path(root).getFileSystem(self.conf)

    def _path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def read(self, p: str) -> str | None:
        if not self.fs.exists(self._path(p)):
            return None
        stream = self.fs.open(self._path(p))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, p: str, text: str) -> bool:
        """Makes the file with all its text, or gives False if there is one: a link on a local file system, else a rename that doesn't overwrite, which HDFS does in one step. A store of objects must have one of its own that is as strict."""
        new = f"{p}.{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(new), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.getUri().getScheme() == "file":
            local = [self.fs.makeQualified(self._path(x)).toUri().getPath() for x in (new, p)]
            try:
                os.link(*local)
            except FileExistsError:
                return False
            finally:
                self.delete(new)
            return True
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        uri = self.fs.makeQualified(self._path(p)).toUri()
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, self.conf).rename(self.fs.makeQualified(self._path(new)), self.fs.makeQualified(self._path(p)), options)
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            self.delete(new)
            return False
        return True

    def _list(self, p: str) -> list:
        return list(self.fs.listStatus(self._path(p))) if self.fs.exists(self._path(p)) else []

    def names(self, p: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._list(p) if s.isFile())

    def folders(self, p: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._list(p) if s.isDirectory())

    def ages(self, p: str) -> dict[str, int]:
        """Folders with the millisecond of their last change."""
        return {s.getPath().getName(): s.getModificationTime() for s in self._list(p) if s.isDirectory()}

    def delete(self, p: str) -> None:
        self.fs.delete(self._path(p), True)


# ---- the log


def _entry(version: int) -> str:
    return f"{version:020d}.json"


def _logged(files: Files, log: str) -> tuple[list[int], list[int]]:
    """Versions that the log has entries and checkpoints of."""
    names = files.names(log)
    return tuple(sorted(int(m[1]) for n in names if (m := re.fullmatch(rf"(\d{{20}})\.{kind}", n))) for kind in ("json", "checkpoint"))


def _applied(state: dict, entry: dict) -> dict:
    for name, parts in entry["set"].items():
        own = state["tables"].setdefault(name, {})
        for k, paths in parts.items():
            if paths is None:
                own.pop(k, None)
            else:
                own[k] = paths
    return {"schema": entry["schema"], "version": entry["version"], "tables": state["tables"], "meta": state["meta"] | entry["meta"]}


def load_state(files: Files, log: str, upto: int | None = None) -> dict | None:
    """The state at a version (None: the last): a checkpoint and the entries after it."""
    entries, checkpoints = _logged(files, log)
    if not entries and not checkpoints:
        return None
    last = max([*entries, *checkpoints]) if upto is None else upto
    base = max((c for c in checkpoints if c <= last), default=0)
    state = json.loads(files.read(f"{log}/{base:020d}.checkpoint")) if base else {"schema": model.VERSION, "version": 0, "tables": {}, "meta": {}}
    for v in range(base + 1, last + 1):
        raw = files.read(f"{log}/{_entry(v)}")
        if raw is None:
            raise RuntimeError(f"the log has no version {v}")
        state = _applied(state, json.loads(raw))
    return state


class NoTenant(PermissionError):
    pass


class Conflict(RuntimeError):
    """Another run has committed meanwhile."""


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class TenantSession:
    def __init__(self, spark: SparkSession, root: str, tenant_id: str, version: int | None = None):
        """version: only for migrate()."""
        self._version = model.VERSION if version is None else version
        if not TENANT_ID.fullmatch(tenant_id or ""):
            raise NoTenant(f"not a tenant id: {tenant_id!r}")
        if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
            raise RuntimeError("days are UTC days: set spark.sql.session.timeZone to UTC")
        self.spark, self.tenant_id, self.root = spark, tenant_id, f"{root.rstrip('/')}/{tenant_id}"
        self.files, self.log = Files(spark, root), f"{self.root}/_log"
        self.state = self._load()
        self._open: dict | None = None

    # ---- commits

    def _load(self) -> dict:
        state = load_state(self.files, self.log) or {"schema": self._version, "version": 0, "tables": {}, "meta": {}}
        if state["schema"] != self._version:
            raise RuntimeError(f"the store has schema {state['schema']}, not {self._version}: migrate it")
        return state

    def refresh(self) -> None:
        """Goes on from the version that is last now."""
        self.state = self._load()

    @classmethod
    def migrate(cls, spark: SparkSession, root: str, tenant_id: str) -> list[int]:
        """Brings a tenant's store to the version of now, each step once and in one commit; gives the versions it went through."""
        state = load_state(Files(spark, root), f"{root.rstrip('/')}/{tenant_id}/_log") if TENANT_ID.fullmatch(tenant_id or "") else None
        done, at = [], state["schema"] if state else model.VERSION
        while at < model.VERSION:
            s = cls(spark, root, tenant_id, at)
            with s.commit():
                model.MIGRATIONS[at + 1](s)
                s._open["schema"] = at = at + 1
            done.append(at)
        return done

    @contextmanager
    def commit(self):
        """Writes inside take effect together at the end, or not at all."""
        if self._open is not None:
            yield
            return
        self._open = deepcopy(self.state)
        try:
            yield
            self._publish()
        finally:
            self._open = None

    def _publish(self) -> None:
        old, new = self.state, self._open
        changed = {n: own for n in new["tables"] if (own := {k: new["tables"][n].get(k) for k in {**old["tables"].get(n, {}), **new["tables"][n]} if new["tables"][n].get(k) != old["tables"].get(n, {}).get(k)})}
        meta = {k: v for k, v in new["meta"].items() if v != old["meta"].get(k)}
        if not changed and not meta and new["schema"] == old["schema"]:
            return
        new["version"] = old["version"] + 1
        if not self.files.create(f"{self.log}/{_entry(new['version'])}", json.dumps({"version": new["version"], "schema": new["schema"], "set": changed, "meta": meta})):
            raise Conflict("another run has committed meanwhile")
        self.state = new
        if new["version"] % CHECKPOINT == 0:
            self._checkpoint()

    def _checkpoint(self) -> None:
        self.files.create(f"{self.log}/{self.state['version']:020d}.checkpoint", json.dumps(self.state))
        self._trim(self.state["version"] - KEPT_LOG)

    def _trim(self, before: int) -> None:
        """Removes what no version from `before` on needs of the log."""
        entries, checkpoints = _logged(self.files, self.log)
        base = max((c for c in checkpoints if c <= before), default=0)
        for v in entries:
            if v <= base:
                self.files.delete(f"{self.log}/{_entry(v)}")
        for c in checkpoints:
            if c < base:
                self.files.delete(f"{self.log}/{c:020d}.checkpoint")

    def vacuum(self, keep: int = 10, older_than_hours: float = 7 * 24) -> list[str]:
        """Removes folders that the last `keep` versions don't refer to and that haven't changed for so long (a run may be writing); gives their names."""
        first = max(self.state["version"] - keep, 0)
        entries, checkpoints = _logged(self.files, self.log)
        if first and min([*entries, *checkpoints]) > first:
            first = min(checkpoints)
        kept = {p for parts in (load_state(self.files, self.log, first) if first else {"tables": {}})["tables"].values() for paths in parts.values() for p in paths}
        for v in range(first + 1, self.state["version"] + 1):
            entry = json.loads(self.files.read(f"{self.log}/{_entry(v)}"))
            kept |= {p for parts in entry["set"].values() for paths in parts.values() for p in paths or ()}
        kept |= {s["to"] for s in self.state["meta"].get("staged", [])}
        whole = {p.split("/")[0] + "/" + p.split("/")[1] for p in kept}
        latest = self.jvm_now() - int(older_than_hours * 3600_000)
        gone = []
        for table in self.files.folders(self.root):
            for folder, changed in self.files.ages(f"{self.root}/{table}").items() if table != "_log" else ():
                path = f"{table}/{folder}"
                inside = [path] if path not in whole else [] if path in kept else [f"{path}/{f}" for f in self.files.folders(f"{self.root}/{path}") if f"{path}/{f}" not in kept]
                gone += [p for p in inside if changed <= latest]
        for p in gone:
            self.files.delete(f"{self.root}/{p}")
        self._trim(first)
        return gone

    def jvm_now(self) -> int:
        return self.spark._jvm.java.lang.System.currentTimeMillis()

    def meta(self, key: str):
        return (self._open or self.state)["meta"].get(key)

    def note(self, key: str, value) -> None:
        """Keeps a small value (as JSON has them) with the tables."""
        with self.commit():
            self._open["meta"][key] = value

    # ---- tables

    def _parts(self, name: str) -> dict[str, list[str]]:
        return (self._open or self.state)["tables"].get(name, {})

    def read(self, name: str, keys: list | None = None) -> DataFrame:
        """The tenant's rows; keys: only these partitions."""
        table = CATALOGUE[name]
        parts = self._parts(name)
        chosen = parts.values() if keys is None else [parts[str(k)] for k in keys if str(k) in parts]
        paths = list(dict.fromkeys(f"{self.root}/{p}" for own in chosen for p in own))
        if not paths:
            return self.spark.createDataFrame([], table.schema)
        rows = self.spark.read.schema(table.schema).parquet(*paths).where(F.col("tenant_id") == self.tenant_id)
        # A folder of such a table may hold rows of several partitions.
        return rows.where(F.col(table.part).isin([int(k) for k in keys])) if table.shared and keys is not None else rows

    def keys(self, name: str) -> list[str]:
        return sorted(self._parts(name))

    def _owned(self, name: str, rows: DataFrame) -> DataFrame:
        """rows with the columns of the table, all of this tenant."""
        if "tenant_id" in rows.columns:
            wrong = F.raise_error(F.concat(F.lit(f"a row of another tenant than {self.tenant_id}: "), F.coalesce("tenant_id", F.lit("null")))).cast("string")
            rows = rows.withColumn("tenant_id", F.when(F.col("tenant_id").eqNullSafe(self.tenant_id), F.col("tenant_id")).otherwise(wrong))
        else:
            rows = rows.withColumn("tenant_id", F.lit(self.tenant_id))
        extra = [c for c in rows.columns if c == "_chunk"]
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CATALOGUE[name].schema], *extra)

    def _write(self, name: str, rows: DataFrame) -> dict[str, list[str]]:
        table = CATALOGUE[name]
        rows = self._owned(name, rows)
        to = f"{name}/{uuid.uuid4().hex}"
        if table.part is None:
            rows.write.parquet(f"{self.root}/{to}", compression=CODEC)
            return {ALL: [to]}
        part = F.col(table.part) if not table.width else F.floor(F.col(table.part) / table.width)
        # Rebalanced by partition: AQE gives a large one several tasks, and one task several small ones.
        out = rows.withColumn("_part", part.cast("string")).hint("rebalance", "_part")
        if table.sort:
            out = out.sortWithinPartitions("_part", *table.sort)
        out.write.partitionBy("_part").parquet(f"{self.root}/{to}", compression=CODEC)
        return {f.removeprefix("_part="): [f"{to}/{f}"] for f in self.files.folders(f"{self.root}/{to}") if f.startswith("_part=")}

    def append(self, name: str, rows: DataFrame) -> None:
        with self.commit():
            tables = self._open["tables"].setdefault(name, {})
            for k, paths in self._write(name, rows).items():
                tables[k] = [*tables.get(k, []), *paths]
            if many := [k for k, paths in tables.items() if len(paths) > MOST_FOLDERS]:
                self.compact(name, many)

    def compact(self, name: str, keys: list[str] | None = None) -> None:
        """Puts one folder in place of a partition's many."""
        keys = [k for k, paths in self._parts(name).items() if len(paths) > 1] if keys is None else keys
        if keys and not CATALOGUE[name].shared:
            self.replace(name, self.read(name, keys), keys)

    def replace(self, name: str, rows: DataFrame, keys: list | None = None) -> None:
        """Puts rows in place of the partitions named by keys (None: of all); a named partition without rows goes."""
        with self.commit():
            tables = self._open["tables"].setdefault(name, {})
            written = self._write(name, rows)
            for k in list(tables) if keys is None else [str(k) for k in keys]:
                tables.pop(k, None)
            if keys is not None and (other := set(written) - {str(k) for k in keys}):
                raise ValueError(f"{name}: rows outside the partitions that are replaced: {sorted(other)[:5]}")
            tables.update(written)

    def drop(self, name: str, keys: list) -> None:
        """Takes partitions off a table."""
        with self.commit():
            for k in keys:
                self._open["tables"].get(name, {}).pop(str(k), None)

    def put(self, name: str, rows: list[dict]) -> None:
        """Puts rows of the table's id in place of those with the same ids; only the blocks of ids that they are in are read and written."""
        if not rows:
            return
        ids, blocks = [r["id"] for r in rows], sorted({str(r["id"] // CATALOGUE[name].width) for r in rows})
        others = self.read(name, blocks).where(~F.col("id").isin(ids))
        self.replace(name, others.unionByName(self.frame(name, rows)).coalesce(1), blocks)

    def next_id(self, name: str) -> int:
        """One more than the greatest id so far, which is in the last block."""
        last = max((int(k) for k in self._parts(name)), default=None)
        return 1 if last is None else (self.read(name, [str(last)]).agg(F.max("id")).first()[0] or 0) + 1

    def frame(self, name: str, rows: list[dict]) -> DataFrame:
        schema = CATALOGUE[name].schema
        return self.spark.createDataFrame([tuple(self.tenant_id if f.name == "tenant_id" else r.get(f.name) for f in schema) for r in rows], schema)

    def day_keys(self, rows: DataFrame, column: str) -> list[date]:
        """Distinct days of rows; a day is a partition, so these are few."""
        return sorted(r[0] for r in rows.select(column).distinct().collect())

    @contextmanager
    def scratch(self) -> Iterator[Callable[[DataFrame], DataFrame]]:
        """Gives a function that computes a frame once, into the tenant's folder, and reads it from there; what it wrote goes at the end (vacuum() takes what a killed run left)."""
        top, made = f"{self.root}/kept/{uuid.uuid4().hex}", []

        def keep(rows: DataFrame) -> DataFrame:
            made.append(f"{top}/{len(made)}")
            rows.write.parquet(made[-1], compression=CODEC)
            return self.spark.read.schema(rows.schema).parquet(made[-1])

        try:
            yield keep
        finally:
            self.files.delete(top)

    # ---- keys of staged rows

    def days_of(self, source: str, wanted: DataFrame) -> DataFrame:
        """k and posting_day of those of wanted (k) that are staged; reads the buckets that may have them, and there the range of keys."""
        name = f"keys.{source}"
        buckets = (self._open or self.state)["meta"].get(name, {}).get("buckets")
        if not buckets:
            return self.read(name).select("k", "posting_day")
        wanted = wanted.select("k").where("k is not null").distinct()
        low, high, own = wanted.agg(F.min("k"), F.max("k"), F.collect_set(bucket_of("k", buckets))).first()
        rows = self.read(name, sorted(own)).where(F.col("k").between(F.lit(low), F.lit(high)))
        return rows.join(wanted, "k", "left_semi").select("k", "posting_day")

    def staged_on_days_of(self, source: str, wanted: DataFrame) -> DataFrame:
        """Staged rows of the days on which rows with these keys (k) are booked."""
        return self.read(f"stg.{source}", self.day_keys(self.days_of(source, wanted), "posting_day"))

    def add_keys(self, source: str, fresh: DataFrame, n: int) -> None:
        """fresh: k and posting_day of n keys that weren't staged before."""
        if not n:
            return
        with self.commit():
            name = f"keys.{source}"
            meta = self._open["meta"].get(name) or {"buckets": BUCKETS, "rows": 0}
            buckets, rows = meta["buckets"], meta["rows"] + n
            while rows > buckets * BUCKET_ROWS:
                buckets *= SPLIT
            if buckets != meta["buckets"]:
                fresh = fresh.select("k", "posting_day").unionByName(self.read(name).select("k", "posting_day"))
            fresh = fresh.select("k", "posting_day", bucket_of("k", buckets).alias("bucket"))
            self._open["meta"][name] = {"buckets": buckets, "rows": rows}
            if buckets != meta["buckets"]:
                self.replace(name, fresh)
            else:
                self.append(name, fresh)

    # ---- rows written in chunks

    def stage_chunks(self, name: str, chunks: list[list[tuple[int, int, int]]]) -> str:
        """Notes that the table's chunks (each: partition, rows before, rows up to) will be written; gives their folder. Commit before writing."""
        to = f"{name}/{uuid.uuid4().hex}"
        self._open["meta"]["staged"] = [*self._open["meta"].get("staged", []), {"name": name, "to": to, "chunks": chunks}]
        return to

    def write_chunks(self, name: str, to: str, rows: DataFrame, n: int) -> None:
        """Writes rows, of which _chunk is the number of their chunk, in one job with a task a chunk.

        A task's file comes to its place when the task commits (algorithm 2), so
        whatever ends the job, the chunks that can be seen are whole.
        """
        out = self._owned(name, rows).repartitionById(n, F.col("_chunk")).sortWithinPartitions("_chunk", *CATALOGUE[name].key)
        out.write.partitionBy("_chunk").option("mapreduce.fileoutputcommitter.algorithm.version", "2").mode("append").parquet(f"{self.root}/{to}", compression=CODEC)

    def written_chunks(self, to: str) -> set[int]:
        found = (f for f in self.files.folders(f"{self.root}/{to}") if f.startswith("_chunk="))
        return {int(f.removeprefix("_chunk=")) for f in found if any(n.endswith(".parquet") for n in self.files.names(f"{self.root}/{to}/{f}"))}

    def adopt_chunks(self, to: str, taken: Iterable[int]) -> None:
        """Makes chunks part of their table, and forgets the rest of what was staged in their folder."""
        with self.commit():
            staged = next(s for s in self._open["meta"]["staged"] if s["to"] == to)
            tables = self._open["tables"].setdefault(staged["name"], {})
            for c in sorted(taken):
                for part in dict.fromkeys(str(p) for p, _, _ in staged["chunks"][c]):
                    tables[part] = [*tables.get(part, []), f"{to}/_chunk={c}"]
            self._open["meta"]["staged"] = [s for s in self._open["meta"]["staged"] if s["to"] != to]


def tenants(spark: SparkSession, root: str) -> list[str]:
    """Tenants that the store knows; the only read without a session."""
    files = Files(spark, root)
    return [f for f in files.folders(root) if files.names(f"{root.rstrip('/')}/{f}/_log")]
