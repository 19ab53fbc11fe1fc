"""SimHash near duplicates by a byte-position inverted index with count filtering.

Fingerprints of 64 bits that differ in at most DISTANCE = 3 bits differ in at most
three of their eight bytes, so a linked pair shares at least MATCHES = 5 positional
bytes. Postings of single bytes hold 1/256 of all fingerprints each, and pairs out
of them grow with the square of the corpus; so the index is entered by three byte
positions at once. Its entries are all triples inside either half of the eight
positions: five equal positions put three or more in one half, so every linked pair
meets in an entry. Under an entry each of the other five positions has postings by
its byte; a pair's tally is three and the number of those postings that both are in.
Pairs with a tally under MATCHES go, the rest are verified bit by bit.

An entry of more than BLOCK fingerprints is dealt by a hash to blocks, and every two
of its blocks (and each with itself) meet in a group of their own, so that no task
holds an entry whole. A group of over FEW gives a spanning forest of its links, never
all pairs; no connection is lost.

Nulls: a null or empty text has no words and fingerprint zero, and is linked like
any other. Null ids are not ids: they link, but component_id is the smallest id
that is not null (null if there is none). Ties: rows that are alike in id and text
hash are told apart by a hash of the whole row where one of them has to stay.
Repeated rows each give a row. Texts of any length are hashed whole, in batches of a
few MB. Other columns, whatever their names, are passed by. An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import common

SEED, SHINGLE, DISTANCE, MATCHES = 42, 3, 3, 5
#: Fingerprints of one entry that are compared with one another at once; groups up to FEW by neighbours, all groups at once.
BLOCK, FEW = 4096, 16
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
LANES = np.uint64(0x0101010101010101)


# ---- fingerprints


def _votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    n = len(hashes)
    if n % 255:
        hashes = np.concatenate([hashes, np.zeros(255 - n % 255, np.uint64)])
    blocks = hashes.reshape(-1, 255)
    out = np.empty((8, 8), np.int64)  # bit in the byte, byte
    for i in range(8):
        lanes = ((blocks >> np.uint64(i)) & LANES).sum(axis=1, dtype=np.uint64)  # 255 at most in each byte
        out[i] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.T.ravel()


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both take ASCII alone on bytes
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxh64_intdigest(joined, SEED)
    ends = [*accumulate(map((1).__add__, map(len, words)))]
    starts = [0, *ends]
    hashes = np.array([xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])], np.uint64)  # noqa: B905
    bits = 2 * _votes(hashes) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.small_batches(batches, "text"):
        prints = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints), b.column(2)], names=["doc_id", "fp", "text_hash"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long) and text_hash of every row."""
    common.prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return rows.mapInArrow(_prints, "doc_id long, fp long, text_hash long")


# ---- links


def _tally(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many positional bytes each of a shares with each of b (both rows of eight bytes)."""
    out = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]), np.uint8)
    for p in range(8):
        out += a[..., p] == b[..., p]
    return out


def _bytes(fps: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8)


class _Forest:
    """Union-find over places in one group; keeps the links that joined something."""

    def __init__(self, n: int):
        self.of = list(range(n))
        self.links: list[tuple[int, int]] = []

    def top(self, x: int) -> int:
        while self.of[x] != x:
            self.of[x] = x = self.of[self.of[x]]
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.top(a), self.top(b)
        if x != y:
            self.of[max(x, y)] = min(x, y)
            self.links.append((a, b))


def group_links(fps: np.ndarray, right: np.ndarray, step: int = 1024) -> list[tuple[int, int]]:
    """A spanning forest, as places, of the links of a group: among all, or, if some are right, between those and the rest."""
    forest = _Forest(len(fps))
    two = bool(right.any())
    lefts, rights = (np.flatnonzero(~right), np.flatnonzero(right)) if two else (np.arange(len(fps)),) * 2
    parts = _bytes(fps)
    for i in range(0, len(lefts), step):
        a = lefts[i : i + step]
        for j in range(0 if two else i, len(rights), step):
            b = rights[j : j + step]
            x, y = np.nonzero(_tally(parts[a][:, None], parts[b][None]) >= MATCHES)
            x, y = a[x], b[y]
            near = (x != y) & (np.bitwise_count(fps[x] ^ fps[y]) <= DISTANCE)
            for u, v in zip(x[near].tolist(), y[near].tolist(), strict=True):
                forest.join(u, v)
    return forest.links


def _few_links(group: np.ndarray, fps: np.ndarray, right: np.ndarray, few: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All links of groups of up to FEW: neighbours at each offset, all groups at once."""
    parts = _bytes(fps)
    for d in range(1, min(FEW, len(group))):
        at = np.flatnonzero((group[d:] == group[:-d]) & few[d:])
        at = at[_tally(parts[at], parts[at + d]) >= MATCHES]
        yield fps[at], fps[at + d]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each group (entry, i, j); batches are sorted by group, and a group may span some."""

    def links(group: np.ndarray, fps: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(group)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(group)]])
        n = ends - starts
        found = list(_few_links(group, fps, right, np.repeat(n <= FEW, n)))
        for k in np.flatnonzero(n > FEW):
            own = fps[starts[k] : ends[k]]
            at = np.array(group_links(own, right[starts[k] : ends[k]]), np.int64).reshape(-1, 2)
            found.append((own[at[:, 0]], own[at[:, 1]]))
        near = [(a, b) for a, b in ((a, b) for a, b in found) if len(a)]
        a, b = (np.concatenate([x[i] for x in near] or [fps[:0]]) for i in (0, 1))
        keep = np.bitwise_count(a ^ b) <= DISTANCE
        a, b = a[keep].view(np.int64), b[keep].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    held: list[tuple[np.ndarray, ...]] = []  # columns, and after them each row's group
    ahead, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        entry, i, j, right, fps = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
        fresh = np.ones(len(entry), bool)
        fresh[1:] = (entry[1:] != entry[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        fresh[0] = (entry[0], i[0], j[0]) != last
        group = ahead + np.cumsum(fresh)
        ahead, last = int(group[-1]), (entry[-1], i[-1], j[-1])
        held.append((group, fps.view(np.uint64), right))
        cut = int(np.searchsorted(group, group[-1]))
        if cut:  # what came before the last group is whole
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            keep = int(np.searchsorted(whole[0], group[-1]))
            yield links(*(x[:keep] for x in whole))
            held = [tuple(x[keep:] for x in whole)]
    if held:
        yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))


def similar_prints(nodes: DataFrame) -> DataFrame:
    """Links (a < b) among distinct fingerprints fp: enough of them to connect all within DISTANCE, each within it."""
    keys = []
    for k, positions in enumerate(TRIPLES):
        key = F.lit(k << 24).cast("long")
        for j, p in enumerate(positions):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(F.col("fp"), 8 * p).bitwiseAND(255), 8 * (2 - j)))
        keys.append(key)
    postings = nodes.select(F.explode(F.array(*keys)).alias("entry"), "fp")
    large = common.kept(postings.groupBy("entry").count().where(F.col("count") > BLOCK), "entries")
    blocks = F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), F.col("_n")).cast("int")
    dealt = postings.join(large, "entry", "left").withColumn("_n", blocks).withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n").cast("int") - 1)))
    meet = dealt.select("entry", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), (F.col("_own") > F.col("_other")).alias("right"), "fp")
    return meet.repartition("entry", "i", "j").sortWithinPartitions("entry", "i", "j").mapInArrow(_groups, "a long, b long").distinct()


# ---- components


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root (its component's smallest node) of every node in links (a, b), by star contraction.

    Each round is cut off in the shared folder; the driver gets two numbers a round, and
    the rounds end when these stay.
    """
    edges = common.cut(links.where("a <> b").distinct())
    was = None
    for _ in range(most_rounds):
        both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select(F.col("b"), F.col("a")))
        # Large star: greater neighbours go to the smallest one.
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        # Distinct before the next join, so that what a dense cluster says again and again of one node is said once.
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("b"), F.col("m").alias("a")).distinct()
        # Small star: smaller neighbours and the node itself go to the smallest one.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.explode(F.array(F.struct("b", F.col("m").alias("a")), F.struct(F.col("a").alias("b"), F.col("m").alias("a")))).alias("e"))
        edges = common.cut(small.select("e.a", "e.b").where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components did not settle")
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.union(edges.select(F.col("a"), F.col("a")).distinct())


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, text_hash, root (the fingerprint that names the group) and component_id of every row of docs."""
    prints = common.cut(fingerprints(docs, id_col, text_col))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    of = components(similar_prints(nodes.select("fp")))
    named = nodes.join(of.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = common.cut(named)
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = named.select("fp", "root").join(lows, "root")
    return prints.join(classes, "fp", "left").select("doc_id", "fp", "text_hash", "root", "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of docs, one of each group: that with the smallest id (null ids last), of those that tie one chosen by its text's hash."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("f")
    stay = groups(docs, id_col, text_col).groupBy("root").agg(first).select(F.col("f.doc_id").alias("_id"), F.col("f.text_hash").alias("_hash"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("key"), F.xxhash64(text_col).alias("hash"))
    left = keyed.join(stay, F.col("key").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left_semi")
    order = Window.partitionBy("key", "hash").orderBy(common.row_order(docs))
    return left.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("row.*")
