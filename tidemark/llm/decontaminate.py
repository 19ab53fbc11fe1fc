"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over the benchmark's words; document frequencies are
counted over all documents, in one pass for all items. A distributed randomised SVD
of passages (of at most SAMPLE_ITEMS items and SAMPLE_DOCS documents, chosen by
hashes; both halves weigh the same) gives a latent space of RANK dimensions; of a
benchmark with more than ROWS words some words share a row of it, which blurs
candidates and nothing else. Every window of every document is a candidate for an
item if its latent vector reaches SHARE of the item's own along it and has a cosine
of COSINE with it. A window reaches no more of any item than the sum, over its words,
of the most that each adds to one; windows in which that sum is under SHARE are
passed over without loss. Candidates are verified by the longest common subsequence
of words: SURE of the item's words in order within the window and half a window
around it, or LIKELY of them if the answer (the last ANSWER_WORDS words of a longer
item) is there too.

The benchmark is the query set: its distinct words and its items go through the
driver to executors, the items in blocks of about ITEM_WORDS words. All documents are
read once to count words and once for each block, which is one for some 20,000 items.

Nulls: null and empty texts, of documents or items, have no words and match
nothing. An item of a few words is found wherever they stand in order; since that says
little, keep_uncontaminated() drops documents for items of LEAST_WORDS words or more
only, while search() reports all. Ties: items
with the same text are each reported; of windows that hold an item alike the one with
the greatest cosine counts, then the first. Null ids pass through. Repeated rows are
each reported. Texts of any length are searched whole, in blocks of words. Other
columns, whatever their names, are passed by. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

RANK, EXTRA, POWER, SAMPLE_DOCS, SAMPLE_ITEMS, SAMPLE_PARTS = 256, 16, 2, 1000, 2000, 8
SHARE, COSINE, SURE, LIKELY, ANSWER_WORDS, ANSWER_SHARE = 0.5, 0.5, 0.8, 0.65, 8, 0.5
BLOCK_WORDS, FIT_WINDOW = 1 << 16, 64
#: Words of an item, as many as a shingle has, that a document must not hold.
LEAST_WORDS = 5
#: Rows of the latent space (at 256 dimensions 134 MB), rows that the driver gets as one value, and words of the items that are searched for in one pass.
ROWS, ROW_BLOCK, ITEM_WORDS = 1 << 17, 1024, 2_000_000
WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def width_of(n: int) -> int:
    """The window width for items of n words: the next of 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, ..."""
    w = 1 if n <= 1 else 2
    while w < n:
        w = w * 3 // 2 if w & (w - 1) == 0 else w // 3 * 4
    return w


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for y in b:
        if m := places.get(y):
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


class Space:
    """The benchmark's words and their latent vectors."""

    def __init__(self, vocabulary: dict[str, int], vectors: np.ndarray):
        self.vocabulary = vocabulary
        self.vectors = vectors  # idf times latent row, a zero row last
        self.rows = np.append(np.arange(len(vocabulary)) % max(1, len(vectors) - 1), len(vectors) - 1).astype(np.int32)  # of each word, and of all others


@dataclass
class Index:
    """What executors need: the space, and a block of items by width."""

    space: Space
    items: list[tuple[int | None, list[int]]]
    by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)  # places of items, their vectors, the most each word adds

    def prepare(self) -> None:
        groups: dict[int, list[int]] = {}
        rows, vectors = self.space.rows, self.space.vectors
        for k, (_, ids) in enumerate(self.items):
            groups.setdefault(width_of(len(ids)), []).append(k)
        for w, at in sorted(groups.items()):
            v = np.stack([vectors[rows[self.items[k][1]]].sum(axis=0) for k in at])
            aim = v / np.maximum((v**2).sum(axis=1, keepdims=True), 1e-12)
            most = np.zeros(len(vectors), np.float32)
            for i in range(0, len(aim), 256):
                np.maximum(most, (vectors @ aim[i : i + 256].T).max(axis=1), out=most)
            self.by_width[w] = (np.array(at), v, most[rows].astype(np.float64))

    def ids(self, text: str | None) -> np.ndarray:
        got, none = self.space.vocabulary.get, len(self.space.vocabulary)
        return np.array([got(w, none) for w in words(text)], np.int32)

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(item's place, window's start, width, cosine) of candidate windows in a block of word ids."""
        vectors, rows = self.space.vectors, self.space.rows
        for w, (at, v, most) in self.by_width.items():
            sums = np.concatenate([[0.0], np.cumsum(most[ids])])
            step = max(1, w // 4)
            starts = np.arange(0, max(1, len(ids) - w + step), step)
            ends = np.minimum(starts + w, len(ids))
            starts = starts[sums[ends] - sums[starts] >= SHARE - 1e-6]
            if not len(starts):
                continue
            own = np.linalg.norm(v, axis=1)
            padded = rows[np.concatenate([ids, np.full(w, len(rows) - 1, ids.dtype)])]
            size = max(1, min(512, 16384 // w))
            for a in range(0, len(starts), size):
                s = starts[a : a + size]
                p = vectors[padded[s[:, None] + np.arange(w)]].sum(axis=1)
                norm = np.linalg.norm(p, axis=1)[:, None]
                for i in range(0, len(v), 4096):
                    one, length = v[i : i + 4096], own[i : i + 4096]
                    dots = p @ one.T
                    hit = (dots >= SHARE * length**2) & (dots >= COSINE * length * np.maximum(norm, 1e-9)) & (length > 0)
                    for x, y in zip(*np.nonzero(hit), strict=True):
                        yield int(at[i + y]), int(s[x]), w, float(dots[x, y] / (length[y] * norm[x, 0]))

    def matches(self, text: str | None) -> list[tuple[int | None, float, float, int]]:
        """(item_id, share of its words found in order, cosine, first word of the window) of the items that text holds."""
        ids = self.ids(text)
        if not len(ids) or not self.by_width:
            return []
        widest = max(self.by_width)
        best: dict[int, tuple[float, float, int]] = {}
        tried = set()
        for block in range(0, max(1, len(ids) - widest), BLOCK_WORDS):
            own = ids[block : block + BLOCK_WORDS + 2 * widest]
            for k, start, w, cosine in self.candidates(own):
                start += block
                if (k, start) in tried or (k in best and best[k][0] >= 1):
                    continue
                tried.add((k, start))
                item = self.items[k][1]
                region = ids[max(0, start - w // 2) : start + w + w // 2].tolist()
                share = lcs(item, region) / len(item)
                if share < LIKELY or (share < SURE and not self._answered(item, region)):
                    continue
                if k not in best or (share, cosine, -start) > (*best[k][:2], -best[k][2]):
                    best[k] = (share, cosine, start)
        return [(self.items[k][0], *best[k]) for k in sorted(best)]

    @staticmethod
    def _answered(item: list[int], region: list[int]) -> bool:
        answer = item[-ANSWER_WORDS:]
        return len(item) > len(answer) and lcs(answer, region) >= ANSWER_SHARE * len(answer)


# ---- fitting


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.small_batches(batches, "text"):
        yield pa.RecordBatch.from_arrays([pa.array(sorted({w for text in b.column(0).to_pylist() for w in words(text)}), pa.string())], names=["w"])


def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary: dict[str, int]) -> Iterator[pa.RecordBatch]:
    counts, n, known = Counter(), 0, vocabulary.keys()
    for b in common.small_batches(batches, "text"):
        for text in b.column(0).to_pylist():
            n += 1
            counts.update(known & set(words(text)))
    out = [(-1, n), *((vocabulary[w], k) for w, k in counts.items())]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.int64())], names=["w", "n"])


def _passages(batches: Iterator[pa.RecordBatch], vocabulary: dict[str, int], n_rows: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows of the words of each text's passages (or of each text whole), without words outside the vocabulary."""
    for b in common.small_batches(batches, "text"):
        out = []
        for text in b.column(0).to_pylist():
            ids = [vocabulary[w] % n_rows if w in vocabulary else -1 for w in words(text)]
            for a in [0] if whole else range(0, len(ids), FIT_WINDOW // 2):
                if own := [i for i in (ids if whole else ids[a : a + FIT_WINDOW]) if i >= 0]:
                    out.append(own)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], names=["ids"])


def _gram(batches: Iterator[pa.RecordBatch], idf: np.ndarray, basis: np.ndarray) -> Iterator[pa.RecordBatch]:
    """This partition's part of A'(A basis), A's rows being TF-IDF passages of length one, in blocks of rows."""
    out, part = np.zeros_like(basis), -1
    for b in batches:
        for ids, weight, part in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):  # noqa: B007
            at, tf = np.unique(np.array(ids), return_counts=True)
            x = tf * idf[at]
            x = x / max(np.linalg.norm(x), 1e-12)
            out[at] += (weight * x)[:, None] * (x @ basis[at])
    if part >= 0:
        for k in range(0, len(out), ROW_BLOCK):
            values = out[k : k + ROW_BLOCK].astype(np.float32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([values], pa.binary())], names=["k", "part", "values"])


def _summed(parts: pa.Table) -> pa.Table:
    """The sum of one block of rows over all partitions, in their order."""
    parts = parts.sort_by("part")
    total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in parts.column("values"))
    return pa.table({"k": parts.column("k")[:1], "values": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def latent_space(passages: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 11) -> np.ndarray:
    """The leading right singular vectors of the weighted passages' TF-IDF matrix, by a randomised range finder with power steps.

    passages (ids, weight, part) is a bounded sample; at a step the driver gets one
    block of len(idf) by (rank + EXTRA) sums.
    """
    n = len(idf)
    width = min(n, rank + EXTRA)
    sent = passages.sparkSession.sparkContext.broadcast

    def times(basis: np.ndarray) -> np.ndarray:
        both = sent((idf, basis))
        parts = passages.mapInArrow(lambda it: _gram(it, *both.value), "k int, part int, values binary")
        out = np.zeros((n, width))
        for r in parts.groupBy("k").applyInArrow(_summed, "k int, values binary").collect():
            own = np.frombuffer(bytes(r[1]), np.float32).reshape(-1, width)
            out[r[0] : r[0] + len(own)] = own
        both.destroy()
        return out

    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, width)))[0]
    for _ in range(POWER):
        q = np.linalg.qr(times(q))[0]
    small = q.T @ times(q)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][: min(rank, width)]
    return q @ turn[:, order]


def fit(docs: DataFrame, benchmark: DataFrame) -> Space | None:
    """The latent space of docs (i, text) and benchmark (item_id, text); None if the benchmark has no words."""
    spark = docs.sparkSession
    found = sorted(r[0] for r in benchmark.select("text").mapInArrow(_distinct_words, "w string").distinct().collect())
    if not found:
        return None
    vocabulary = {w: k for k, w in enumerate(found)}
    n_rows = min(len(vocabulary), ROWS)
    sent = spark.sparkContext.broadcast(vocabulary)
    counts = docs.select("text").mapInArrow(lambda it: _frequencies(it, sent.value), "w int, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(n_rows)
    total = sum(r[1] for r in counts if r[0] < 0)
    for r in counts:
        if r[0] >= 0:
            df[r[0] % n_rows] += r[1]
    idf = np.log(np.maximum((total + len(found) + 1) / (df + 1), 1.01))
    own = spark.createDataFrame(common.sampled(docs.select(F.col("i").cast("long").alias("_i")), "_i", "latent", SAMPLE_DOCS), "_i long")
    sample = docs.join(F.broadcast(own), docs["i"].cast("long") == F.col("_i"), "left_semi").select("text")
    items = benchmark.select("text").orderBy(F.xxhash64("text"), "text").limit(SAMPLE_ITEMS)
    passages = [part.mapInArrow(lambda it, w=whole: _passages(it, sent.value, n_rows, w), "ids array<int>").withColumn("of_item", F.lit(whole)) for part, whole in ((sample, False), (items, True))]
    passages = passages[0].union(passages[1]).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(SAMPLE_PARTS)).cast("int"))
    passages = common.cut(passages.repartition(SAMPLE_PARTS, "part").sortWithinPartitions("part", "ids"))
    of = {r[0]: r[1] for r in passages.groupBy("of_item").count().collect()}
    items_weigh = max(1.0, of.get(False, 0) / max(1, of.get(True, 0)))
    latent = latent_space(passages.select("ids", F.when(F.col("of_item"), items_weigh).otherwise(1.0).alias("weight"), "part"), idf)
    return Space(vocabulary, np.vstack([latent * idf[:, None], np.zeros((1, latent.shape[1]))]).astype(np.float32))


def indexes(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 1) -> Iterator[Index]:
    """The index of each block of items with that many words at least, all in one latent space."""
    common.prepare(docs.sparkSession)
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    space = fit(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text")), benchmark)
    if space is None:
        return
    n = max(1, -(-benchmark.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit(r"\w+"))), F.lit(0))).first()[0] // ITEM_WORDS))
    for k in range(n):
        own = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()  # about ITEM_WORDS words
        items = [(i, [space.vocabulary[w] for w in words(t)]) for i, t in sorted(map(tuple, own), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))]
        index = Index(space, [(i, ids) for i, ids in items if len(ids) >= least_words])
        if index.items:
            index.prepare()
            yield index


def _found(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    index = sent.value
    for b in common.small_batches(batches, "text"):
        out = [(d, *m) for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m in index.matches(text)]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()), strict=True)],
                names=["doc_id", "item_id", "lcs_share", "cosine", "first_word"],
            )


def search(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, lcs_share, cosine and first_word of each item found in each row of docs."""
    spark = docs.sparkSession
    fields = "doc_id long, item_id long, lcs_share double, cosine double, first_word long"
    out = spark.createDataFrame([], fields)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    for index in indexes(docs, benchmark, id_col, text_col):
        sent = spark.sparkContext.broadcast(index)
        out = out.union(rows.mapInArrow(lambda it, s=sent: _found(it, s), fields))
    return out


def _holds(texts, sent):
    import pandas as pd

    return pd.Series([bool(sent.value.matches(t)) for t in texts], dtype=bool)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Rows of docs in which no item of the benchmark with least_words words or more is found."""
    left = docs
    for index in indexes(docs, benchmark, id_col, text_col, least_words):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        holds = F.pandas_udf(lambda texts, s=sent: _holds(texts, s), "boolean")
        left = left.where(~holds(F.col(text_col)))
    return left


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
