r"""Ranked lexical search over an index of two levels: byte impacts, then exact integers.

Terms are maximal runs of ASCII letters and digits and of all characters from U+0080
on, with A-Z lower-cased. The index is a table of postings by slice, some SLICE_BYTES
of text that one task reads at once: for a slice and a term the documents that hold
it, each one's impact rounded up to a byte (a multiple of STEP, so that byte * STEP
is at or above the impact and (byte - 1) * STEP below it), and the exact count of the
term. A document lies in one slice whole, so postings never move by term.

A search reads the slices' postings of the items' terms. In a slice, weighted bytes
give each document an upper and a lower bound of its score; every document whose upper
bound reaches the k-th lower bound of the slice is scored again with exact integers,
and the k best of these stay. The k-th lower bound of all slices is no smaller than
that of one, so every document whose bound reaches it is among those that are scored
again: the result is exact, not approximate. The best of the slices then meet in two
steps, so that no task gets them all.

Items go to tasks in blocks of some BLOCK_PAIRS pairs of item and term, by a hash.

Nulls: a null text has no terms and is in no result; null ids are last among equal
scores. Null items have no terms, hence no result. Ties: equal scores rank by id, rows
that are alike in both can't be told apart in a result. Repeated rows, of documents
and of items, each count and are each ranked. Texts of any length are read whole.
Other columns, whatever their names, are passed by. Without documents or without items
there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

TOP = 50
#: Fixed values of the score: an impact is SCALE * tf div (TF * tf + LENGTH * m), m is FLAT + SLOPE * n * N div L.
SCALE, TF, LENGTH, FLAT, SLOPE = 1_000_000_000, 1000, 20, 50, 50
#: Impacts are under SCALE / TF; a byte counts this much of them.
STEP = -(-SCALE // TF // 255)
SLICE_BYTES, BLOCK_PAIRS = 16 << 20, 200_000
#: Groups in which the best of an item's slices meet first.
LANES = 256

#: Bytes that are no part of a term become spaces, A-Z become a-z; every byte from 0x80 on belongs to a character that is part of one.
_TERM = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _TERM[_low : _high + 1] = True
_FOLDED = bytes(b if _TERM[b] else 0x20 for b in bytes(range(256)).lower())


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLDED).split()


@dataclass(frozen=True)
class Index:
    """postings: slice, term, held (documents), at (their places in the slice), impact (a byte each), tf; and of each slice one row with no term, but ids and sizes (terms with repeats) of its documents."""

    postings: DataFrame
    documents: int  # N: those with a term
    terms: int  # L: all their terms, with repeats


# ---- building


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    documents = terms = 0
    for b in batches:
        for text in b.column(0).to_pylist():
            held = _TERM[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
            if n := int(held[:1].sum()) + int(np.count_nonzero(held[1:] & ~held[:-1])):
                documents, terms = documents + 1, terms + n
    yield pa.RecordBatch.from_arrays([pa.array([documents], pa.int64()), pa.array([terms], pa.int64())], names=["documents", "terms"])


def length_norms(sizes: list[int], documents: int, terms: int) -> np.ndarray:
    """m of documents by their number of terms."""
    return np.array([100 - FLAT + SLOPE * n * documents // terms for n in sizes], np.int64)


def exact_impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return SCALE * tf // (TF * tf + LENGTH * m)


class _Codes(dict):
    def __missing__(self, term: bytes) -> int:
        n = self[term] = len(self)
        return n


_POSTINGS = pa.schema([("slice", pa.int64()), ("term", pa.string()), ("held", pa.int32()), ("at", pa.list_(pa.int32())), ("impact", pa.binary()), ("tf", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])
_POSTINGS_SQL = "slice long, term string, held int, at array<int>, impact binary, tf array<int>, ids array<long>, sizes array<long>"


def _slice_rows(number: int, ids: list[int | None], texts: list[str | None], documents: int, terms: int) -> pa.RecordBatch:
    codes, each = _Codes(), []
    for t in texts:
        own = terms_of(t)
        each.append(np.fromiter(map(codes.__getitem__, own), np.int64, len(own)))
    sizes = [len(x) for x in each]
    keys = np.concatenate(each) * len(ids) + np.repeat(np.arange(len(ids)), sizes)
    keys, tf = np.unique(keys, return_counts=True)
    code, at = np.divmod(keys, len(ids))
    impact = exact_impacts(tf, length_norms(sizes, documents, terms)[at] if len(at) else at)
    level = (-(-impact // STEP)).astype(np.uint8).tobytes()
    starts = np.searchsorted(code, np.arange(len(codes) + 1)).astype(np.int32)
    held = np.diff(starts)
    none = lambda n, kind: pa.nulls(n, kind)
    lists = lambda values: pa.ListArray.from_arrays(pa.array(starts), pa.array(values.astype(np.int32)))
    n = len(codes)
    body = [pa.array(np.full(n, number)), pa.array([t.decode("utf-8", "surrogatepass") for t in codes], pa.string()), pa.array(held.astype(np.int32)), lists(at), pa.array([level[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary()), lists(tf), none(n, pa.list_(pa.int64())), none(n, pa.list_(pa.int64()))]
    head = [pa.array([number]), none(1, pa.string()), none(1, pa.int32()), none(1, pa.list_(pa.int32())), none(1, pa.binary()), none(1, pa.list_(pa.int32())), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.concat_arrays([h, b]) for h, b in zip(head, body, strict=True)], schema=_POSTINGS)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Indexes every row of docs, in the shared folder."""
    common.prepare(docs.sparkSession)
    documents, terms = docs.select(text_col).mapInArrow(_counted, "documents long, terms long").agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for s in common.small_batches(iter([b]), "text", SLICE_BYTES):
                yield _slice_rows(number, s.column(0).to_pylist(), s.column(1).to_pylist(), documents, terms)
                number += 1

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    return Index(common.kept(texts.mapInArrow(rows, _POSTINGS_SQL), "postings"), documents, terms)


# ---- searching


def item_terms(items: DataFrame, text_col: str = "text") -> DataFrame:
    """item (the row's number) and term of each term that a row of items (which has `item`) holds, once each."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.small_batches(batches, "text"):
            found = [(i, t.decode("utf-8", "surrogatepass")) for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for t in set(terms_of(x))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([t for _, t in found], pa.string())], names=["item", "term"])

    return items.select("item", F.col(text_col).alias("text")).mapInArrow(pairs, "item long, term string")


class _Block:
    """Items of a block: the terms of each, by number, with their weights."""

    def __init__(self, pairs: pa.Table):
        self.items, of_item = np.unique(pairs["item"].to_numpy(), return_inverse=True)
        coded = pairs["term"].combine_chunks().dictionary_encode()
        self.number = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}
        order = np.argsort(of_item, kind="stable")
        self.terms, self.weights = coded.indices.to_numpy()[order], pairs["w"].to_numpy()[order]
        self.starts = np.searchsorted(of_item[order], np.arange(len(self.items) + 1))


def best_of_slice(block: _Block, rows: pa.Table, documents: int, terms: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, places, scores) of the `most` best documents of one slice for each item; rows: the slice's head and its postings of the block's terms."""
    head = rows.filter(rows["term"].is_null())
    ids, sizes = head["ids"][0].values, head["sizes"][0].values.to_numpy()
    order = np.argsort(np.argsort(np.array([(1 << 63) if i is None else i for i in ids.to_pylist()], object), kind="stable"))  # null ids last
    body = rows.filter(rows["term"].is_valid())
    own: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for term, at, impact, tf in zip(body["term"].to_pylist(), body["at"], body["impact"], body["tf"], strict=True):
        own[block.number[term]] = at.values.to_numpy(), np.frombuffer(impact.as_py(), np.uint8).astype(np.int64), tf.values.to_numpy()
    for i, item in enumerate(block.items.tolist()):
        span = slice(block.starts[i], block.starts[i + 1])
        mine = [(int(w), *own[t]) for t, w in zip(block.terms[span].tolist(), block.weights[span].tolist(), strict=True) if t in own]
        if not mine:
            continue
        upper, slack = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for w, at, level, _ in mine:
            upper[at] += w * level
            slack[at] += w * (level > 0)
        lower = upper - slack
        least = max(int(np.partition(lower, len(lower) - most)[len(lower) - most]) if len(lower) > most else 0, 1)
        found = np.flatnonzero(upper >= least)
        m, score = length_norms(sizes[found].tolist(), documents, terms), np.zeros(len(found), np.int64)
        for w, at, _, tf in mine:
            place = np.searchsorted(at, found).clip(max=len(at) - 1)
            hit = at[place] == found
            score[hit] += w * exact_impacts(tf[place[hit]], m[hit])
        found, score = found[score > 0], score[score > 0]
        best = np.lexsort((order[found], -score))[:most]
        yield item, found[best], score[best]


def _searched(rows: DataFrame, block: _Block, documents: int, terms: int, most: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def of_slice(table: pa.Table) -> pa.Table:
        ids = table.filter(table["term"].is_null())["ids"][0].values
        number = table["slice"][0].as_py()
        parts = [(np.full(len(at), item), ids.take(pa.array(at)), score) for item, at, score in best_of_slice(shared.value, table, documents, terms, most) if len(at)]
        lane = pa.array(np.full(sum(len(p[0]) for p in parts), (number ^ (number >> 32)) % LANES, np.int32))
        columns = [np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)]), pa.concat_arrays([p[1] for p in parts] or [pa.array([], pa.int64())]), np.concatenate([p[2] for p in parts] or [np.zeros(0, np.int64)]), lane]
        return pa.table(columns, names=["item", "doc_id", "score", "lane"])

    return rows.groupBy("slice").applyInArrow(of_slice, "item long, doc_id long, score long, lane int")


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text", most: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the `most` best documents with a score above 0 for each row of items."""
    common.prepare(items.sparkSession)
    items = common.kept(items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).withColumn("item", F.monotonically_increasing_id()), "items")
    pairs = item_terms(items)
    asked = pairs.select("term").distinct()
    held = index.postings.where("term is not null").select("term", "held").join(asked, "term", "left_semi").groupBy("term").agg(F.sum("held").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(index.documents) + 2) / (2.0 * F.col("df") + 1))).cast("long")
    pairs = common.kept(pairs.join(held, "term").select("item", "term", weight.alias("w")), "item-terms")
    blocks = -(-pairs.count() // BLOCK_PAIRS)
    found = []
    heads = index.postings.where("term is null").select("slice", "term", "at", "impact", "tf", "ids", "sizes")
    for b in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        block = own.toArrow()  # BLOCK_PAIRS rows or so
        if block.num_rows:
            body = index.postings.where("term is not null").select(*heads.columns).join(own.select("term").distinct(), "term", "left_semi")
            found.append(_searched(heads.unionByName(body), _Block(block), index.documents, index.terms, most))
    if not found:
        return items.where("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    for group in (["item", "lane"], ["item"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))).where(F.col("rank") <= most)
    return rows.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build(common.table(spark, sf_dir, "documents")), common.table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH terms AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, CAST(doc_id AS BIGINT) AS doc_id, text FROM documents)),
counts AS (SELECT row, doc_id, term, count(*) AS tf FROM terms GROUP BY row, doc_id, term),
sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY row),
totals AS (SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM sizes),
norms AS (SELECT sizes.row, 100 - 50 + ((50 * sizes.n * totals.N) // L) AS m FROM sizes, totals),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * max(totals.N) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM counts, totals GROUP BY term),
items AS (
  SELECT DISTINCT item, item_id, term FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark))),
scores AS (
  SELECT item, item_id, counts.row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN norms ON norms.row = counts.row GROUP BY item, item_id, counts.row, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
