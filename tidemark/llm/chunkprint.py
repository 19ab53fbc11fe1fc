"""Document fingerprints by content-defined chunking.

A gear hash (a sum of shifted per-byte random numbers over the last 32 bytes) sets
chunk boundaries, with normalised chunking: a strict mask up to NORMAL bytes, a
loose one beyond, so lengths gather near NORMAL. Boundaries depend on nearby bytes
alone, so an insertion or a cut shifts text without changing chunks elsewhere. A
fingerprint is the sorted set of (chunk digest, chunk length) entries; the likeness
of two is the length of shared chunks over the lesser of the two total lengths
(containment).

Nulls: a null text is empty and has an empty fingerprint. Two empty ones have
likeness 1, an empty and another one 0. Null ids come last in order; rows that tie
in doc_id stand in the order of a hash of their texts, then of the texts, and repeated
rows each give a row. Texts of any length are cut whole, in batches of a few MB. Other
columns, whatever their names, are passed by. One document is its own next. An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from . import common

LEAST, NORMAL, MOST = 16, 48, 192
#: Bits that must be zero: more before NORMAL bytes, fewer after.
STRICT, LOOSE = np.uint32(0xFC000000), np.uint32(0xF0000000)
#: Hex digits of a chunk's digest and of its length.
DIGEST, LENGTH = 12, 2
GEAR = np.random.default_rng(20240501).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(raw: bytes) -> np.ndarray:
    """The gear hash at each byte, over the 32 bytes that end there (fewer at the start)."""
    h = GEAR[np.frombuffer(raw, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        if k >= len(h):
            break
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    return h


def chunk_ends(raw: bytes) -> list[int]:
    n = len(raw)
    if n <= LEAST:
        return [n] if n else []
    h = gear_hashes(raw)
    loose = np.flatnonzero(h & LOOSE == 0)
    strict = (h[loose] & STRICT == 0).tolist()
    places = loose.tolist()
    places.append(n + MOST)
    strict.append(True)
    ends, start, k = [], 0, 0
    while n - start > LEAST:
        least, normal = start + LEAST - 1, start + NORMAL - 1
        most = min(start + MOST, n)
        while places[k] < least:
            k += 1
        j = k
        while places[j] < normal and not strict[j]:
            j += 1
        start = min(places[j] + 1, most)
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def chunk_set(text: str) -> set[int]:
    """Entries (digest << 8 | length) of the text's chunks."""
    raw = text.encode("utf-8", "surrogatepass")
    out, a = set(), 0
    for b in chunk_ends(raw):
        out.add(xxh3_64_intdigest(raw[a:b]) >> 16 << 8 | b - a)
        a = b
    return out


def fingerprint(chunks: set[int]) -> str:
    return np.array(sorted(chunks), ">u8").view(np.uint8).reshape(-1, 8)[:, 1:].tobytes().hex()


def parse(print_: str) -> set[int]:
    step = DIGEST + LENGTH
    return {int(print_[i : i + step], 16) for i in range(0, len(print_), step)}


def likeness(a: set[int], b: set[int]) -> float:
    """Length of the shared chunks over the lesser of the two sets' lengths."""
    if not a or not b:
        return float(not a and not b)
    least = min(sum([x & 255 for x in a]), sum([x & 255 for x in b]))
    return sum([x & 255 for x in a & b]) / least


def edited(text: str, following: str) -> str:
    """text with its last half replaced by the first half as many code points of following."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _rows(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches hold whole slices, sorted; the copy of the row that follows a slice ends it."""
    before: tuple | None = None
    slot, ended = None, False

    def row(a: tuple, b: tuple) -> dict:
        changed = edited(a[1], b[1])
        mine = chunk_set(changed)
        return {
            "doc_id": a[0], "n_chars": len(a[1]), "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": fingerprint(a[2]), "edited_fingerprint": fingerprint(mine), "near_edited": likeness(a[2], mine), "near_next": likeness(a[2], b[2]),
        }

    for batch in batches:
        for piece in common.small_batches(iter([batch]), "text"):
            out = []
            for k, lead, d, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), piece.column(2).to_pylist(), common.strings(piece.column(3)), strict=True):
                if k != slot:
                    slot, before, ended = k, None, False
                if ended:
                    continue  # more rows with the id that follows
                now = (d, text, chunk_set(text))
                if before is not None:
                    out.append(row(before, now))
                before, ended = now, lead
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row."""
    common.prepare(docs.sparkSession)
    placed, _ = common.ordered_slices(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text", with_next=True)
    fields = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in fields.split(", ")])
    return placed.select("slot", "lead", "doc_id", "text").mapInArrow(lambda it: _rows(it, schema), fields)


def op2_chunk_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(common.table(spark, sf_dir, "documents"))
