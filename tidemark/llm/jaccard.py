"""N-gram Jaccard join: sets of word shingles that share four fifths of their union, by parity sketches.

A document's set holds its distinct shingles of SHINGLE words, each hashed to 64 bits
(two shingles of one pair that collide are not expected in this world). If sets A and
B link, their symmetric difference has at most (|A| + |B|) / 9 shingles, and at most a
quarter of either.

Parity sketch: every shingle flips bits of one of `parts` words, by xor with its hash.
A shingle that one set alone has changes one word at most, so the words in which two
sketches differ are no more than the symmetric difference. Sizes fall in bands
[2^c, 2^(c+1)); a band has more words than any difference d inside it, so of two linked
sets' words all but d agree. If both list their words in one order, the first d + 1
of either hold the first one on which they agree (pigeonhole). So a set is entered
under d + 1 of its words, those with the most shingles, which few other sets have by
chance; and in the next band too if a set there may be near enough in size.

Joining: a task combines its sets with equal words first and passes on one leader a
word, then words meet. Of the sets of a word three are leaders, by different orders,
and every set is tried with the TRIED leaders that it shares most words with. That
connects almost all; what it may have missed lies under words whose sets are in
different components still. Those sets meet all to all, block by block where they are
many, and pairs of different components are tried too. A pair that is tried goes on if
the parity bits of its sets (one bit flipped by a shingle; another lower bound) differ
in no more than a link allows, and is then verified exactly, over the sets themselves,
which are made again from the texts of those documents alone. Of a word with many sets
pairs that go on may be as many as its sets' square, so none but a spanning forest of
them leaves the task; the sets that forests connect are a family, in which all sets of
different components are verified with one another, in one task or block by block, and
again a spanning forest of links is all that comes out. No link between different
components is lost. Sets that share a word because they share a long passage
and not much else are compared by their bits alone, but in all pairs.

Nodes of the join are distinct sets, named by 64 bits of a hash of the whole set, so
copies cost nothing; sets of one name and another size are not expected either.

Nulls: null, empty and blank texts have an empty set and link with nothing; their
component_id is their own id. Null ids are not ids: such documents link, but
component_id is the smallest id that is not null, or null. Ties: documents of equal
sets are linked. Repeated rows each give a row. Texts of any length are read whole.
Other columns, whatever their names, are passed by. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import common
from .simhash import components

SHINGLE = 5
#: Words of a band's sketch for each shingle of the largest difference in it.
SPARE = 1.25
#: Sets of one word that are compared with one another at once, and up to how many by a join of pairs; leaders that a set is tried with.
BLOCK, FEW, TRIED = 4096, 6, 4
#: Shingles of the sets that are verified with one another at once.
BLOCK_SHINGLES = 1 << 20
#: Entries that a task combines at once; words that it remembers of texts; bits of the filter of ids.
COMBINED, REMEMBERED, FILTER_BITS = 2_000_000, 500_000, 1 << 24

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


# ---- sets


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxh64_intdigest(word)
        return h


def shingles(text: str | None, words: dict | None = None) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of the whole sequence if it is shorter than one."""
    words = _Words() if words is None else words
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both take ASCII alone on bytes
    h = np.fromiter(map(words.__getitem__, own), np.uint64, len(own))
    if not len(h):
        return h
    n = min(SHINGLE, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = _mixed(out ^ h[i : len(h) - n + 1 + i]) + np.uint64(i)
    return np.unique(out)


def name_of(hashes: np.ndarray) -> int:
    return int(np.array(xxh64_intdigest(hashes.tobytes(), len(hashes)), np.uint64).view(np.int64))


# ---- sketches


def band(size: int) -> int:
    return size.bit_length() - 1


def parts_of(c: int) -> int:
    """Words of the sketches of band c: more than sets of it may differ in."""
    most = 2 * ((2 << c) - 1) // 9
    return int((most + 1) * SPARE) + 1


def differing(size: int, c: int) -> int:
    """Most shingles in which a set of this size differs from one that it links with, if band c is that of the larger."""
    return min(size // 4, (size + min(size * 5 // 4, (2 << c) - 1)) // 9)


def entries(hashes: np.ndarray) -> np.ndarray:
    """What the set is entered under: keys of the richest words of its sketch, in its band and perhaps the next."""
    n, found = len(hashes), []
    own = band(n)
    for c in (own, own + 1) if n * 5 // 4 >= 2 << own else (own,):
        d = differing(n, c)
        if not d:
            continue  # equal sets only, which are one already
        k = parts_of(c)
        part = ((hashes >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        part, h = part[order], hashes[order]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        word, held, part = np.bitwise_xor.reduceat(h, starts), np.diff(np.append(starts, len(h))), part[starts]
        key = _mixed(_mixed(word) ^ (part * np.uint64(64) + np.uint64(c) + np.uint64(1)))
        if len(key) < d + 1:  # words without shingles agree as well; they come last
            none = np.setdiff1d(np.arange(k, dtype=np.uint64), part)
            key, held = np.append(key, _mixed(none * np.uint64(64) + np.uint64(c) + np.uint64(1))), np.append(held, np.zeros(len(none), held.dtype))
        found.append(key[np.lexsort((key, -held))[: d + 1]])
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def parity_bits(hashes: np.ndarray) -> np.ndarray:
    """The set's parity sketch as bytes: four to eight bits a shingle, a power of two."""
    m = max(64, 8 << band(max(len(hashes), 1)))
    odd = np.bincount((hashes & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _folded(bits: np.ndarray, to: int) -> np.ndarray:
    while bits.shape[-1] > to:  # a bit is an index modulo m, so halves fall on each other
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


# ---- the scan


_SCANNED = "doc_id long, n long, node long, keys array<long>, bits binary"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (size of the set) and node (the set's name; null if empty) of every row, kept in the shared folder; of the first of equal sets in a task also its keys and parity bits."""
    common.prepare(docs.sparkSession)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), set()
        for b in common.small_batches(batches, "text"):
            n, nodes, keys, bits = [], [], [], []
            for text in b.column(1).to_pylist():
                h = shingles(text, words)
                node = name_of(h) if len(h) else None
                n.append(len(h))
                nodes.append(node)
                fresh = node is not None and node not in seen
                if fresh:
                    seen.add(node)
                keys.append(entries(h).view(np.int64) if fresh else None)
                bits.append(parity_bits(h).tobytes() if fresh else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())], names=["doc_id", "n", "node", "keys", "bits"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return common.kept(rows.mapInArrow(scanned, _SCANNED), "sets")


# ---- pairs with leaders


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, node and leader: of each key in what a task holds at once, its smallest node (as leader of itself) and every other one with that."""

    def rows(keys: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        leader = np.repeat(node[first], np.diff(np.append(first, len(key))))
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(leader)], names=["key", "node", "leader"])

    keys, nodes, n = [], [], 0
    for b in batches:
        lists = b.column(1)
        lengths = np.diff(lists.offsets.to_numpy())
        keys.append(lists.flatten().to_numpy())
        nodes.append(np.repeat(b.column(0).to_numpy(), lengths))
        n += len(keys[-1])
        if n >= COMBINED:
            yield rows(keys, nodes)
            keys, nodes, n = [], [], 0
    if n:
        yield rows(keys, nodes)


def led(scanned: DataFrame) -> DataFrame:
    """key, node and leader (a smaller node with that key) of every entry that isn't alone, kept; all nodes of a key are connected by its rows."""
    own = scanned.where("keys is not null").select("node", "keys").mapInArrow(_combined, "key long, node long, leader long")
    # Leaders of tasks meet by key, one row for each key and task; nodes that have a leader already are dealt out by themselves.
    lane = F.when(F.col("node") != F.col("leader"), F.col("node"))
    first = F.min("leader").over(Window.partitionBy("key", "lane"))
    return common.kept(own.withColumn("lane", lane).withColumn("leader", first).where("leader < node").select("key", "node", "leader"), "leaders")


def tried(leaders: DataFrame) -> DataFrame:
    """Pairs (a < b) of each node and those leaders of its keys that it shares most keys with."""
    members = leaders.select("key", "node").union(leaders.select("key", "leader")).distinct()
    by = [F.min_by("node", F.xxhash64("node", F.lit(r))) for r in (1, 2)]
    heads = members.groupBy("key").agg(F.array_distinct(F.array(F.min("node"), *by)).alias("heads"))
    pairs = members.join(heads, "key").select("node", F.explode("heads").alias("head")).where("node <> head")
    order = Window.partitionBy("node").orderBy(F.desc("count"), "head")
    best = pairs.groupBy("node", "head").count().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= TRIED)
    return best.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


# ---- verification


class _IdFilter:
    """FILTER_BITS bits, one of them set for each id that may be wanted; ids by hash, so others may pass too."""

    def __init__(self, ids: DataFrame):
        at = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
        words = ids.select(at.alias("at")).selectExpr("shiftright(at, 6) AS word", "shiftleft(1L, cast(at % 64 AS int)) AS bit").groupBy("word").agg(F.bit_or("bit").alias("bits"))
        self.words = np.zeros(FILTER_BITS >> 6, np.int64)
        for word, bits in words.collect():  # FILTER_BITS / 64 rows at most
            self.words[word] = bits

    def column(self, spark: SparkSession) -> Column:
        shared = spark.sparkContext.broadcast(self.words.view(np.uint64))

        @F.pandas_udf("boolean")
        def passes(at):
            import pandas as pd

            at = at.to_numpy()
            return pd.Series((shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1)

        return passes(F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)))


def sets_of(docs: DataFrame, scanned: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node and hashes of these nodes' sets, made from the texts of one document each, kept."""
    spark = docs.sparkSession
    # Summed up before they meet: copies of a set are one row a task.
    wanted = scanned.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(nodes, "node", "left_semi")
    wanted = common.kept(wanted, "wanted")  # for the filter and the join

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in common.small_batches(batches, "text", 2 << 20):
            found = [shingles(t, words) for t in b.column(1).to_pylist()]
            names = [name_of(h) if len(h) else None for h in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.int64()), pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))], names=["doc_id", "node", "hashes"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where(_IdFilter(wanted).column(spark)).mapInArrow(made, "doc_id long, node long, hashes array<long>")
    rows = rows.withColumnRenamed("node", "_node").withColumnRenamed("doc_id", "_id")
    out = rows.join(wanted, (F.col("_node") == F.col("node")) & F.col("_id").eqNullSafe(F.col("doc_id"))).select("node", "hashes")
    return common.kept(out.dropDuplicates(["node"]), "hashes")


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, sizes m and n, bits x and y) whose parity bits allow a link."""
    for b in batches:
        m, n = b.column(2).to_numpy(), b.column(3).to_numpy()
        keep = np.zeros(len(m), bool)
        for i, (x, y) in enumerate(zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)):
            if 4 * m[i] <= 5 * n[i] and 4 * n[i] <= 5 * m[i]:
                one, two, to = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8), min(len(x), len(y))
                keep[i] = int(np.bitwise_count(_folded(one, to) ^ _folded(two, to)).sum()) <= (m[i] + n[i]) // 9
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))


def near(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that sizes and parity bits (node, n, bits) allow to link."""
    one, two = (bits.select(F.col("node").alias(x), F.col("n").alias(f"_n{x}"), F.col("bits").alias(f"_{x}")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "_na", "_nb", "_a", "_b")
    return both.mapInArrow(_near, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link."""
    one, two = (sets.select(F.col("node").alias(x), F.col("hashes").alias(f"_{x}")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b")
    both = both.select("a", "b", F.size("_a").alias("_m"), F.size("_b").alias("_n"), F.size(F.array_intersect("_a", "_b")).alias("_both"))
    return both.where("100 * cast(_both as long) >= 80 * cast(_m + _n - _both as long)").select("a", "b")


# ---- what leaders may have missed


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Places of pairs (a, b) of n things that connect whatever all the pairs connect, fewer than n."""
    label, at, chosen = np.arange(n), np.arange(len(a)), []
    while True:
        x, y = label[a[at]], label[b[at]]
        at, x, y = (v[x != y] for v in (at, x, y))
        if not len(at):
            return np.concatenate([np.zeros(0, np.int64), *chosen])
        low, high = np.minimum(x, y), np.maximum(x, y)
        order = np.lexsort((low, high))
        first = order[np.flatnonzero(np.concatenate([[True], np.diff(high[order]) != 0]))]
        chosen.append(at[first])
        label_of = np.arange(n)
        label_of[high[first]] = low[first]
        while (label_of != (further := label_of[label_of])).any():
            label_of = further
        label = label_of[label]


def near_in_group(nodes: np.ndarray, component: np.ndarray, sizes: np.ndarray, bits: list[bytes], right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of a group, by place, of different components whose sizes and parity bits allow a link, as many as connect what all of them do; between right and other places if some are right, else among all."""
    left_at, right_at = (np.flatnonzero(~right), np.flatnonzero(right)) if right.any() else (np.arange(len(nodes)),) * 2
    widths = np.array([len(b) for b in bits])
    a_kept, b_kept = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for w in np.unique(widths[left_at]):
        for v in np.unique(widths[right_at]):
            if max(w, v) > 2 * min(w, v):
                continue  # sizes over a band apart
            to = min(w, v)
            one, two = left_at[widths[left_at] == w], right_at[widths[right_at] == v]
            words = [np.ascontiguousarray(_folded(np.frombuffer(b"".join(bits[i] for i in at), np.uint8).reshape(len(at), -1), to)).view(np.uint64) for at in (one, two)]
            step = max(1, (8 << 20) // max(1, len(two) * int(to)))
            for i in range(0, len(one), step):
                a = one[i : i + step]
                may = component[a][:, None] != component[two][None]
                m, n = sizes[a][:, None], sizes[two][None]
                may &= (5 * m >= 4 * n) & (5 * n >= 4 * m)
                if not right.any():
                    may &= a[:, None] < two[None]
                x, y = np.nonzero(may)
                for j in range(0, len(x), 1 << 20):
                    p, q = x[j : j + (1 << 20)], y[j : j + (1 << 20)]
                    apart = np.bitwise_count(words[0][i + p] ^ words[1][q]).sum(axis=1)
                    near = apart <= (sizes[a[p]] + sizes[two[q]]) // 9
                    both = np.concatenate([a_kept, a[p[near]]]), np.concatenate([b_kept, two[q[near]]])
                    keep = forest(*both, len(nodes))
                    a_kept, b_kept = both[0][keep], both[1][keep]
    return a_kept, b_kept


def _of_group(table: pa.Table) -> pa.Table:
    table = table.sort_by("node")  # groups of much the same nodes give the same pairs
    nodes, component, sizes = (table[c].to_numpy() for c in ("node", "root", "n"))
    a, b = near_in_group(nodes, component, sizes, table["bits"].to_pylist(), table["right"].to_numpy())
    a, b = nodes[a], nodes[b]
    return pa.table([np.minimum(a, b), np.maximum(a, b)], names=["a", "b"])


def _dealt(members: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Nodes of a group dealt by a hash to so many blocks, every two of which meet: group, i, j, right (of the block j) and the other columns."""
    dealt = members.withColumn("_n", blocks.cast("int"))
    dealt = dealt.withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    rest = [c for c in members.columns if c != group]
    return dealt.select(group, F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), (F.col("_own") > F.col("_other")).alias("right"), *rest)


def missed(leaders: DataFrame, bits: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a < b) of different components that share a key and may link by size and parity bits: all those of keys with at most FEW nodes; and of other keys as many as connect what all of their pairs do.

    roots: node and root of every node in leaders. Keys whose nodes are of one
    component have nothing to add. Nodes of a key with more than FEW are compared in one
    group, those of one with more than BLOCK in blocks, by a hash, every two of which meet.
    """
    of = leaders.join(roots, "node").withColumnRenamed("root", "_root").join(roots.select(F.col("node").alias("leader"), "root"), "leader")
    open_keys = of.where("_root <> root").select("key").distinct()
    members = leaders.join(open_keys, "key", "left_semi")
    members = common.kept(members.select("key", "node").union(members.select("key", "leader")).distinct(), "members")  # for both kinds of keys
    counts = members.groupBy("key").agg(F.count("*").alias("_count"))
    # Most keys have two or three nodes: their pairs, each once however many keys it has, are cheaper to make by a join.
    few = members.join(counts.where(F.col("_count") <= FEW).select("key"), "key", "left_semi").join(roots, "node")
    pairs = few.select("key", F.col("node").alias("a"), F.col("root").alias("_x")).join(few.select("key", F.col("node").alias("b"), F.col("root").alias("_y")), "key").where("a < b and _x <> _y")
    close = near(pairs.select("a", "b").distinct(), bits)
    many = members.join(counts.where(F.col("_count") > FEW), "key")
    meet = _dealt(many, "key", F.ceil(F.col("_count") / BLOCK)).drop("_count")
    return close, meet.join(bits.join(roots, "node"), "node").groupBy("key", "i", "j").applyInArrow(_of_group, "a long, b long").distinct()


def links_in_family(component: np.ndarray, sets: list[np.ndarray], right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places that link, as many as connect different components that any pair's link connects; between right and other places if some are right, else among all."""
    sizes = np.array([len(x) for x in sets], np.int64)
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts, held = np.concatenate([[0], np.cumsum(sizes)]), np.zeros(len(flat) + 1, bool)
    label = np.unique(component, return_inverse=True)[1]
    lefts, rights = (np.flatnonzero(~right), np.flatnonzero(right)) if right.any() else (np.arange(len(sets)),) * 2
    found = []
    for i in lefts.tolist():
        others = rights if right.any() else np.arange(i + 1, len(sets))
        own = flat[starts[i] : starts[i + 1]]
        m, n = sizes[i], sizes[others]
        others = others[(label[others] != label[i]) & (5 * m >= 4 * n) & (5 * n >= 4 * m)]
        if not len(others):
            continue
        held[own] = True
        n = sizes[others]
        begins = np.cumsum(n) - n
        both = np.add.reduceat(held[flat[np.repeat(starts[others] - begins, n) + np.arange(n.sum())]], begins, dtype=np.int64)
        held[own] = False
        linked = others[100 * both >= 80 * (m + n - both)]
        # One link for each of the components that i meets.
        found += [(i, j) for j in linked[np.unique(label[linked], return_index=True)[1]].tolist()]
        label[np.isin(label, label[linked])] = label[i]
    at = np.array(found, np.int64).reshape(-1, 2)
    return at[:, 0], at[:, 1]


def _of_family(table: pa.Table) -> pa.Table:
    nodes = table["node"].to_numpy()
    lists = table["hashes"].combine_chunks()
    sets = np.split(lists.flatten().to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())[:-1])
    a, b = links_in_family(table["root"].to_numpy(), sets, table["right"].to_numpy())
    a, b = nodes[a], nodes[b]
    return pa.table([np.minimum(a, b), np.maximum(a, b)], names=["a", "b"])


def linked_in_families(families: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a < b) between different components within each family (node, family): enough of them to connect all that link.

    A family is compared set by set in one task, one with more than BLOCK sets or
    BLOCK_SHINGLES shingles in blocks, by a hash, every two of which meet. What comes out
    are links, fewer than a task has sets, however many pairs were compared.
    """
    members = families.join(sets.withColumn("n", F.size("hashes").cast("long")).select("node", "n"), "node")
    counts = members.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("_blocks"))
    meet = _dealt(members.select("node", "family").join(counts, "family"), "family", F.col("_blocks")).drop("_blocks")
    return meet.join(roots, "node").join(sets, "node").groupBy("family", "i", "j").applyInArrow(_of_family, "a long, b long").distinct()


# ---- the join


def _named(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node and root of every one of nodes."""
    return nodes.join(components(links), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """node and root of the same nodes, with links (a, b) added; between roots alone, since all that a component holds has its root already."""
    one, two = (roots.select(F.col("node").alias(x), F.col("root").alias(f"_{x}")) for x in "ab")
    tops = components(links.join(one, "a").join(two, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    return roots.join(tops.select(F.col("node").alias("root"), F.col("root").alias("_top")), "root", "left").select("node", F.coalesce("_top", "root").alias("root"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, node (the set's name), root (the set that names the component) and component_id of every row of docs."""
    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def sets(of: DataFrame) -> DataFrame:
        return sets_of(docs, scanned, of, id_col, text_col)

    with common.cleaned(docs.sparkSession):
        scanned = scan(docs, id_col, text_col)
        leaders = led(scanned)
        nodes = common.cut(leaders.select("node").union(leaders.select("leader")).distinct())
        bits = common.kept(scanned.where("keys is not null").select("node", "n", "bits").join(nodes, "node", "left_semi").dropDuplicates(["node"]), "bits")
        pairs = common.cut(near(tried(leaders), bits))
        roots = common.cut(_named(nodes, verified(pairs, sets(ends(pairs)))))  # components() cuts off what it is given
        close, forests = missed(leaders, bits, roots)
        close = common.cut(close)
        families = common.cut(components(forests).withColumnRenamed("root", "family"))
        hashes = sets(ends(close).union(families.select("node")).distinct())
        roots = common.cut(_merged(roots, verified(close, hashes).union(linked_in_families(families, hashes, roots))))
        rows = scanned.select("doc_id", "n", "node")
        lows = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("_low")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        lows = common.cut(lows)
    lowest = lows.groupBy("root").agg(F.min("_low").alias("component_id"))
    classes = lows.select(F.col("node").alias("_node"), "root").join(lowest, "root")
    out = rows.join(classes, F.col("node") == F.col("_node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "node", "root", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
