"""What the operators share: shared folders, placing rows in id order, Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: UTF-8 bytes of text that one ordered slice should hold; from MOST_SLICES slices on (3 TB) slices grow, since a shuffle has so many tasks at most. Slices are streamed, so that their size doesn't set the memory.
SLICE_BYTES, MOST_SLICES = 32 << 20, 100_000
#: Bytes of an Arrow batch: an executor holds one or two for each of its cores, in the JVM and in Python.
ARROW_BYTES = 8 << 20
#: Quantiles of the ids, and most equal steps between two of them, by which bytes are counted to cut slices: of some STEP_ROWS rows each.
QUANTILES, STEPS, STEP_ROWS = 1000, 128, 50
#: Bits of a filter of keys, by which rows are left out before they move.
KEY_BITS = 1 << 24
#: Spark's setting (from 4.1 on) by which a query's shuffle files go when the query ends.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Makes the package importable on executors, and Arrow batches no larger than ARROW_BYTES where the session has Spark's own limit."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").lower() in ("67108864b", "67108864", "64m", "64mb"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    if getattr(sc, "_tidemark_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp()) / "tidemark_package.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(to))
    sc._tidemark_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only if that is unset and all runs in one process, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = getattr(spark.sparkContext, "_tidemark_shared", None)
        if not named:
            named = spark.sparkContext._tidemark_shared = tempfile.mkdtemp(prefix="tidemark-")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    spark.sparkContext._tidemark_made = [*made(spark), path]
    return path


def made(spark: SparkSession) -> list[str]:
    """Folders that operators of this session have made in the shared folder, and that haven't been removed."""
    return getattr(spark.sparkContext, "_tidemark_made", [])


def remove(spark: SparkSession, paths: Iterable[str] | None = None) -> None:
    """Deletes such folders, all by default. Frames that read them are of no use afterwards."""
    gone = set(made(spark) if paths is None else paths)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    spark.sparkContext._tidemark_made = [p for p in made(spark) if p not in gone]


def release() -> None:
    """Gives memory that a task has freed back to the system: workers live on, and in later stages others need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


_remembered: dict[str, dict] = {}


def remembered(owner: str) -> dict:
    """What an operator's tasks remember from one to the next in a worker process; it goes when another operator that remembers has a task there."""
    if owner not in _remembered:
        _remembered.clear()
        release()
        _remembered[owner] = {}
    return _remembered[owner]


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, with no lineage behind it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder; unlike cut() its columns can be read one by one."""
    spark = df.sparkSession
    df.write.parquet(path := scratch(spark, name))
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of frames made and computed in here go when each has been computed; else they stay until the driver happens to collect its garbage.

    A frame that somebody may compute twice had better be made outside.
    """
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANED)
        else:
            spark.conf.set(CLEANED, before)


def in_fold(doc_id: Column | str) -> Column:
    """Whether a row may be learned from: crc32 of the id as text modulo 4 is not 2; a null id counts as remainder 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4, F.lit(0)) != 2


def sampled(rows: DataFrame, id_col: str, salt: str, most: int) -> list[tuple]:
    """At most `most` of rows (narrow ones; null ids left out), those whose ids have the least hashes.

    A count sets a bound that about half as many again pass, so that what tasks send
    to the driver doesn't grow with their number.
    """
    rows = rows.where(F.col(id_col).isNotNull()).withColumn("_h", F.pmod(F.xxhash64(F.lit(salt), F.col(id_col)), F.lit(1 << 32)))
    n = rows.count()
    if n > 2 * most:
        rows = rows.where(F.col("_h") < int((1.5 * most + 50) / n * (1 << 32)))
    return [tuple(r)[:-1] for r in rows.orderBy("_h", *[c for c in rows.columns if c != "_h"]).limit(most).collect()]


def perhaps_in(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be in the column key of wanted: all those that are, and those whose hash falls on one of their bits, of KEY_BITS.

    Rows don't move; what is broadcast is KEY_BITS / 64 rows at most, however many are wanted.
    """
    at = F.pmod(F.xxhash64(key), F.lit(KEY_BITS))
    words = wanted.select(at.alias("_at")).selectExpr("shiftright(_at, 6) AS _word", "shiftleft(1L, cast(_at % 64 AS int)) AS _bit").groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    placed = rows.withColumn("_at", at).withColumn("_word", F.shiftright("_at", 6))
    return placed.join(F.broadcast(words), "_word").where("(shiftright(_bits, cast(_at % 64 AS int)) & 1L) = 1L").select(*rows.columns)


def row_order(docs: DataFrame, row: str = "row") -> Column:
    """A hash of the struct column `row` of docs' columns, to tell apart rows that are otherwise alike; columns that can't be hashed don't count."""
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return F.xxhash64(*[F.col(row)[c] for c in hashed])


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def strings(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Texts of an Arrow column, null as empty."""
    return [x or "" for x in column.to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose texts hold about `most` bytes, so that work space does not follow text length."""
    for b in batches:
        if not b.num_rows:
            continue
        c = b.column(b.schema.get_field_index(column))
        if c.nbytes <= most:
            yield b
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(c), 0), dtype=np.int64)
        at, total = 0, 0
        for i, n in enumerate(lengths):
            if total and total + n > most:
                yield b.slice(at, i - at)
                at, total = i, 0
            total += int(n)
        yield b.slice(at)


def tie_order(text: Column | str) -> Column:
    """What rows of one id are ordered by, before their texts: a hash of the text, 0 or greater, by which a hot id can be split."""
    return F.shiftrightunsigned(F.xxhash64(text), 1)


class _Cuts:
    """Where slices begin: ids fall to fine ranges by `edges`, a range to a slice, or by the hash to one of several slices."""

    def __init__(self, edges: list[int], end: int, steps: int):
        self.edges, self.ends, self.steps = np.array(edges, np.int64), np.array([*edges[1:], end], np.int64), steps
        self.first = self.parts = np.zeros(0, np.int32)

    @property
    def of_null(self) -> int:
        return len(self.edges) * self.steps

    def fine(self, ids) -> np.ndarray:
        none = ids.isna().to_numpy()
        own = ids.fillna(0).to_numpy().astype(np.int64)
        k = np.maximum(np.searchsorted(self.edges, own, side="right") - 1, 0)
        wide = (self.ends[k].astype(np.float64) - self.edges[k]).clip(1)
        step = ((own.astype(np.float64) - self.edges[k]) / wide * self.steps).clip(0, self.steps - 1).astype(np.int64)
        return np.where(none, self.of_null, k * self.steps + step)

    def slot(self, ids, ties) -> np.ndarray:
        f = self.fine(ids)
        parts = self.parts[f]
        return self.first[f] + np.minimum((ties.to_numpy().astype(np.float64) / 2.0**63 * parts).astype(np.int64), parts - 1)


def ordered_slices(docs: DataFrame, id_col: str, text_col: str, with_next: bool = False) -> tuple[DataFrame, int]:
    """Deals docs to slices of consecutive ids of about SLICE_BYTES of text; slice k is partition k, sorted by id, then tie_order(), then text.

    Adds `slot` (the slice) and `lead` (false, or true for copies of the row that
    follows the slice's last one, made if with_next is set: the first row of the
    next slice that has rows, and after the last slice the first of all). Null
    ids come last. An id (or no id) with more text than a slice should hold is split
    by tie_order(). To the driver go counts of at most QUANTILES * STEPS ranges of
    ids, and one row a slice.
    """
    import pandas as pd

    spark = docs.sparkSession
    docs = docs.withColumn("tie", tie_order(text_col))
    at = [i / QUANTILES for i in range(QUANTILES)]
    low, high, n, found = docs.agg(F.min(id_col), F.max(id_col), F.count(id_col), F.percentile_approx(id_col, F.lit(at), F.lit(10 * QUANTILES))).first()
    cuts = _Cuts(sorted({low or 0, *(found or [])}), min((high or 0) + 1, (1 << 63) - 1), max(1, min(STEPS, n // (STEP_ROWS * QUANTILES))))
    fine = F.pandas_udf(lambda ids: pd.Series(cuts.fine(ids).astype(np.int32)), "int")
    sizes = docs.groupBy(fine(F.col(id_col).cast("long")).alias("f")).agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0))).alias("n"), F.min(id_col).alias("head"), (F.min(id_col).eqNullSafe(F.max(id_col))).alias("one")).collect()
    sizes.sort(key=lambda r: r["f"])
    most = max(SLICE_BYTES, sum(r["n"] for r in sizes) // MOST_SLICES)
    first, parts = np.zeros(cuts.of_null + 1, np.int32), np.ones(cuts.of_null + 1, np.int32)
    slots, held, heads, hot = 0, None, [], []
    for r in sizes:
        several = r["one"] and r["n"] > 2 * most
        if held is None or several or held + r["n"] > most:
            slots += 1
            held = 0
            if not several:
                heads.append((slots - 1, (r["head"], None)))
        first[r["f"]] = slots - 1
        held += r["n"]
        if several:
            parts[r["f"]] = -(-r["n"] // most)
            slots += int(parts[r["f"]]) - 1
            hot.append(r["head"])
            held = None
    slots = max(slots, 1)
    cuts.first, cuts.parts = first, parts

    place = F.pandas_udf(lambda ids, ties: pd.Series(cuts.slot(ids, ties).astype(np.int32)), "int")
    out = docs.withColumn("slot", place(F.col(id_col).cast("long"), F.col("tie")) if slots > 1 else F.lit(0))
    if with_next:
        if hot:  # the parts of hot ids: one row each
            of_hot = F.col(id_col).isin([h for h in hot if h is not None]) | (F.col(id_col).isNull() if None in hot else F.lit(False))
            heads += [(r[0], tuple(r[1])) for r in out.where(of_hot).groupBy("slot").agg(F.min(F.struct(id_col, "tie"))).collect()]
        heads.sort(key=lambda h: h[0])
        copied = {key: heads[i - 1][0] for i, (_, key) in enumerate(heads)}
        known = np.array(sorted({d for d, _ in copied if d is not None}), np.int64)
        to = F.nullif(F.pandas_udf(lambda ids, ties: pd.Series(_copied_to(ids, ties, copied, known)), "int")(F.col(id_col).cast("long"), F.col("tie")), F.lit(-1))
        both = F.array(F.struct("slot", F.lit(False).alias("lead")), F.struct(to.alias("slot"), F.lit(True).alias("lead")))
        out = out.withColumn("_at", F.explode(F.filter(both, lambda x: x["slot"].isNotNull())))
        out = out.withColumn("slot", F.col("_at.slot")).withColumn("lead", F.col("_at.lead")).drop("_at")
    else:
        out = out.withColumn("lead", F.lit(False))
    keys = ["slot", "lead", F.col(id_col).asc_nulls_last(), "tie", F.col(text_col)]
    return out.repartitionById(slots, F.col("slot")).sortWithinPartitions(*keys), slots


def _copied_to(ids, ties, copied: dict[tuple[int | None, int | None], int], known: np.ndarray) -> np.ndarray:
    """The slot that gets a copy of each row: that before the slice which begins with its id (and tie, of a hot id); -1 for none."""
    none = ids.isna().to_numpy()
    own, ties = ids.fillna(0).to_numpy().astype(np.int64), ties.to_numpy()
    out = np.full(len(own), -1, np.int32)
    for i in np.flatnonzero(none | np.isin(own, known)):
        d = None if none[i] else int(own[i])
        out[i] = copied[d, None] if (d, None) in copied else copied.get((d, int(ties[i])), -1)
    return out
