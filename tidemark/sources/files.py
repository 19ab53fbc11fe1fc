"""Deliveries as files: finding, fingerprinting and reading them through Spark, from any store it reads."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORDS = "path string, line_no long, payload string, error string"
#: Bytes that are digested at once.
DIGEST_BLOCK = 4 << 20
#: How values are quoted; a value that isn't there is null, an empty one is not.
CSV = {"quote": '"', "escape": '"', "nullValue": "\x00", "emptyValue": "", "encoding": "UTF-8"}
#: A line that begins outside of quotes and ends inside: whole values, then one whose quotes stay open. Possessive, so that long lines don't nest.
OPENS = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+$'


def discover(spark: SparkSession, base: str, pattern: str) -> list[tuple[str, str, int]]:
    """(full path, path relative to base, bytes) of the files that match, sorted by path."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    top = fs.makeQualified(root).toString().rstrip("/")
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{pattern}")) or []
    out = [(s.getPath().toString(), s.getPath().toString()[len(top) + 1 :], s.getLen()) for s in found if s.isFile()]
    return sorted(out)


def batch_number(path: str) -> int | None:
    m = re.search(r"batch_(\d+)", path.rsplit("/", 1)[-1])
    return int(m[1]) if m else None


def batch_allowed(spec: str | None, batch: int | None) -> bool:
    """spec: numbers and ranges, as in "1-4" or "2,5"; a file without a number passes only if there is none."""
    if not spec:
        return True
    if batch is None:
        return False
    for part in spec.split(","):
        low, _, high = part.partition("-")
        if int(low) <= batch <= int(high or low):
            return True
    return False


def uri(spark: SparkSession, path: str) -> str:
    """The path as `_metadata.file_path` gives it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return re.sub("^file:/+", "file:/", p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString())


def _opened(path: str):
    """The file's bytes as a stream; None if neither Python nor Arrow knows its file system."""
    if "://" not in path and not path.startswith("/"):
        path = re.sub(r"^file:/*", "/", path)
    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return open(local, "rb") if os.path.isfile(local) else None
    from pyarrow import fs

    try:
        system, inside = fs.FileSystem.from_uri(path)
    except Exception:  # a scheme that Arrow doesn't know, or a library of it that isn't there
        return None
    return system.open_input_stream(inside)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        paths = b.column(0).to_pylist()
        found = []
        for path in paths:
            stream, digest = _opened(path), None
            if stream is not None:
                h = hashlib.sha256()
                with stream:
                    while block := stream.read(DIGEST_BLOCK):
                        h.update(block)
                digest = h.hexdigest()
            found.append(digest)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], names=["path", "sha256"])


def fingerprints(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """SHA-256 of each file's bytes, read in tasks block by block, so of files of any size; only where Python can't open the file system does Spark read files whole (2 GB at most)."""
    if not paths:
        return {}
    each = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    out = {r[0]: r[1] for r in each.mapInArrow(_digests, "path string, sha256 string").collect()}
    if far := [p for p in paths if out[p] is None]:
        names = {uri(spark, p): p for p in far}
        rows = spark.read.format("binaryFile").load(far).select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/"), F.sha2("content", 256))
        out |= {names[r[0]]: r[1] for r in rows.collect()}
    return out


# ---- records


def header(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Column names: the CSV header if a record follows it, or the keys of the first JSON object; none if there is no record."""
    if kind == "csv":
        rows = _whole(spark, path)
        return rows.columns if rows.head(1) else []
    first = _lines(spark, [path]).where(F.col("error").isNull()).select(F.json_object_keys("payload")).head(1)
    return list(first[0][0]) if first else []


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file read by one task, from its beginning."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, mode="PERMISSIVE", **CSV)


def _text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """value (a line without its end), _from, _from_block: files dealt to tasks by byte ranges; a line belongs to the range that it begins in."""
    lines = spark.read.option("lineSep", "\n").text(paths).select("value", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("_from"), F.col("_metadata.file_block_start").alias("_from_block"))
    return lines.withColumn("value", F.regexp_replace("value", r"^\x{FEFF}", ""))


def _blank(c: str) -> Column:
    return F.col(c).rlike(r"^[\s\p{Z}\x{FEFF}]*$")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    text = _text(spark, paths).where(~_blank("value")).withColumn("value", F.regexp_replace("value", "\r$", ""))
    parsed = F.try_parse_json("value")
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    error = F.when(parsed.isNull(), F.lit("invalid JSON")).when(~is_object, F.lit("line is not a JSON object"))
    return text.select("_from", "_from_block", F.when(error.isNull(), F.col("value")).otherwise(F.to_json(F.struct(F.col("value").alias("__raw")))).alias("payload"), error.alias("error"))


def _in_order(rows: DataFrame) -> DataFrame:
    """rows (of _from and _from_block, as scanned) with _no, from 1 in each file."""
    # Ids increase within a task, and a range is read by one task, in order. Both uses of rows below scan the same files with the
    # same settings, which Spark plans into the same partitions; the numbers rest on that.
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    ranges = rows.groupBy("_from", "_from_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))  # one row a range
    before = Window.partitionBy("_from").orderBy("_from_block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return rows.join(ranges, ["_from", "_from_block"]).withColumn("_no", F.col("_before") + F.col("_at") - F.col("_first") + 1)


class _Quotes:
    """What a line does to the state of a CSV reader that comes to it outside of quotes or inside."""

    @staticmethod
    def outside(line: str) -> bool:
        """Whether a line that begins a record ends inside quotes."""
        at, n = 0, len(line)
        while at < n:
            if line[at] == '"':
                at += 1
                while True:
                    at = line.find('"', at)
                    if at < 0:
                        return True
                    if line[at + 1 : at + 2] != '"':
                        break
                    at += 2
            at = line.find(",", at) + 1
            if not at:
                return False
        return False

    @classmethod
    def inside(cls, line: str) -> bool:
        """Whether a line that goes on in a quoted value ends inside quotes."""
        return cls.outside('"' + line)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each byte range (file, from), for either state s that it may begin in: the state that it ends in, and how many records begin in it."""
    found: dict[tuple, list[int]] = {}
    for b in batches:
        for value, path, block in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            own = found.setdefault((path, block), [0, 1, 0, 0])
            plain, empty = '"' not in value, not value.strip()
            for s in (0, 1):
                if not own[s]:
                    own[2 + s] += not empty
                    own[s] = int(not plain and _Quotes.outside(value))
                elif not plain:
                    own[s] = int(_Quotes.inside(value))
    columns = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in range(4))]
    yield pa.RecordBatch.from_arrays(columns, names=["_from", "_from_block", "end0", "end1", "n0", "n1"])


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with the number of their record: rows of a range come in order, `begins` and `before` tell its state and the records that begin before it."""
    last, state, number, seq = None, 0, 0, 0
    for b in batches:
        out: list[tuple] = []
        for value, path, block, begins, before in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            if (path, block) != last:
                last, state, number, seq = (path, block), begins, before, 0
            seq += 1
            if not state:
                if not value.strip():
                    continue
                number += 1
                ends = '"' in value and _Quotes.outside(value)
                out.append((path, block, seq, number, value, not ends))
            else:
                ends = '"' not in value or _Quotes.inside(value)
                out.append((path, block, seq, number, value, False))
            state = int(ends)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["_from", "_from_block", "_seq", "_no", "value", "alone"])


def _begins(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """_from, _from_block, begins and before of each byte range: ends of ranges are functions of two states, which are chained along each file (one row a range)."""
    sums = lines.select("value", "_from", "_from_block").mapInArrow(_summed, "_from string, _from_block long, end0 long, end1 long, n0 long, n1 long")
    files = sums.groupBy("_from").agg(F.array_sort(F.collect_list(F.struct("_from_block", "end0", "end1", "n0", "n1"))).alias("r"))
    start = F.struct(F.lit(0).cast("long").alias("state"), F.lit(0).cast("long").alias("n"), F.array().cast("array<struct<block:long,begins:long,before:long>>").alias("out"))

    def step(acc: Column, r: Column) -> Column:
        on = acc["state"] == 0
        own = F.struct(r["_from_block"].alias("block"), acc["state"].alias("begins"), acc["n"].alias("before"))
        return F.struct(F.when(on, r["end0"]).otherwise(r["end1"]).alias("state"), (acc["n"] + F.when(on, r["n0"]).otherwise(r["n1"])).alias("n"), F.concat(acc["out"], F.array(own)).alias("out"))

    chained = files.select("_from", F.explode(F.aggregate("r", start, step)["out"]).alias("o"))
    return chained.select("_from", F.col("o.block").alias("_from_block"), "o.begins", "o.before")


def _csv(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """_from, _no (records from 1, without the header) and payload of CSV files with this header, each read by as many tasks as it has byte ranges.

    Files in which no line that begins a record ends inside quotes have a record a
    line, and stay with built-in functions; others are read with the states of quotes
    at the beginnings of their ranges, and only records of several lines are shuffled.
    Lines end with a line feed, which a carriage return may precede.
    """
    text = _text(spark, paths)
    broken = {r[0] for r in text.where(F.col("value").contains('"') & F.col("value").rlike(OPENS)).select("_from").distinct().collect()}
    own = {p: uri(spark, p) in broken for p in paths}
    parts = []
    if plain := [p for p in paths if not own[p]]:
        lines = _text(spark, plain).where(~_blank("value"))
        parts.append(_in_order(lines).select("_from", "_no", "value"))
    if several := [p for p in paths if own[p]]:
        lines = _text(spark, several)
        begins = F.broadcast(_begins(spark, lines))  # one row a range
        lines = lines.join(begins, ["_from", "_from_block"]).select("value", "_from", "_from_block", "begins", "before")
        lines = lines.mapInArrow(_assembled, "_from string, _from_block long, _seq long, _no long, value string, alone boolean")
        parts.append(lines.where("alone").select("_from", "_no", "value"))
        long = lines.where("not alone").groupBy("_from", "_no").agg(F.array_sort(F.collect_list(F.struct("_from_block", "_seq", "value"))).alias("l"))
        parts.append(long.select("_from", "_no", F.array_join(F.col("l.value"), "\n").alias("value")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    names = list(dict.fromkeys(columns))
    at = {c: len(columns) - 1 - columns[::-1].index(c) for c in names}  # of columns of one name the last counts
    read = F.from_csv("value", ", ".join(f"c{i} string" for i in range(len(columns))), {"mode": "PERMISSIVE", "maxCharsPerColumn": "-1", **CSV})
    rows = rows.where("_no > 1").withColumn("value", F.regexp_replace("value", "\r$", "")).withColumn("_r", read)
    values = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*[F.col(f"_r.c{at[c]}") for c in names])), lambda k, v: v.isNotNull())
    return rows.select("_from", (F.col("_no") - 1).alias("_no"), F.to_json(values).alias("payload"))


def records(spark: SparkSession, paths: list[str], kind: str, columns: list[str] | None = None) -> DataFrame:
    """path (as uri() gives it), line_no (records from 1, headers and blank lines not counted), payload (a JSON object) and error of files that share a header (columns)."""
    if kind == "csv":
        columns = columns or header(spark, paths[0], kind)
        if not columns:
            return spark.createDataFrame([], RECORDS)
        return _csv(spark, paths, columns).select(F.col("_from").alias("path"), F.col("_no").alias("line_no"), "payload", F.lit(None).cast("string").alias("error"))
    return _in_order(_lines(spark, paths)).select(F.col("_from").alias("path"), F.col("_no").alias("line_no"), "payload", "error")


def manifest(spark: SparkSession, path: str, tenant_id: str) -> DataFrame:
    """Deliveries that the manifest promises to the tenant."""
    rows = spark.read.schema("batches array<struct<tenant string, source string, batch int, path string, covers_from string, covers_to string>>").json(path, multiLine=True)
    each = rows.select(F.explode("batches").alias("b")).select("b.*").where(F.col("tenant") == tenant_id)
    return each.select(F.col("tenant").alias("tenant_id"), "source", "batch", "path", F.to_date("covers_from").alias("covers_from"), F.to_date("covers_to").alias("covers_to"))


def finance(spark: SparkSession, path: str) -> DataFrame:
    """day, gross_reported, net_reported and currency of the client's own summary."""
    rows = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"')
    return rows.select(F.to_date("date").alias("day"), F.col("gross_reported").cast("decimal(14,2)").alias("gross_reported"), F.col("net_reported").cast("decimal(14,2)").alias("net_reported"), "currency")
