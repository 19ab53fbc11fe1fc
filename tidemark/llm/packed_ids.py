"""Token ids in patched frame-of-reference files.

A file is a table of shards (in a folder that all executors share); a shard's
`payload` has whole documents in ascending doc_id order. Inside it, ids stand in
blocks of BLOCK: the block's minimum is subtracted, differences are packed at the
bit width of the PERCENTILE-th of them (rounded up to even), and larger ones are
exceptions, kept as (place, value) beside the block. The block index has each
block's minimum, width, number of exceptions and starts, so any block can be read
alone.

Nulls: a null text is empty (one end id); null ids come last. Rows that tie in
doc_id stand in the order of a hash of their texts, then of the texts; repeated rows
each have their own entry. Texts of any length are encoded whole, in batches of a few
MB. Other columns, whatever their names, are passed by. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BLOCK, PERCENTILE, MAGIC = 512, 0.95, b"TPF1"
#: Ids after which a shard's part is written and a new one begun.
PART_IDS = 1 << 20
HEAD = struct.Struct("<4sIQQI")  # magic, block size, ids, documents, blocks
assert sys.byteorder == "little" and array("I").itemsize == 4
INDEX = np.dtype([("base", "<u4"), ("width", "<u2"), ("exceptions", "<u2"), ("at", "<u8"), ("exception_at", "<u8")])
ENTRY = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("n", "<u8")])


# ---- blocks


def _pack(rest: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width, four to 4 * width bits."""
    if not width:
        return np.zeros((len(rest), 0), np.uint8)
    if width > 16:
        return np.ascontiguousarray(rest.astype("<u4")).view(np.uint8)
    four = rest.reshape(len(rest), -1, 4).astype(np.uint64)
    word = four[..., 0] | four[..., 1] << np.uint64(width) | four[..., 2] << np.uint64(2 * width) | four[..., 3] << np.uint64(3 * width)
    return np.ascontiguousarray(word.astype("<u8").view(np.uint8).reshape(*word.shape, 8)[..., : width // 2]).reshape(len(rest), -1)


def _unpack(raw: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros((len(raw), BLOCK), np.uint32)
    if width > 16:
        return np.ascontiguousarray(raw).view("<u4").astype(np.uint32)
    words = np.zeros((len(raw), BLOCK // 4, 8), np.uint8)
    words[..., : width // 2] = raw.reshape(len(raw), -1, width // 2)
    word = words.view("<u8")[..., 0]
    mask = np.uint64((1 << width) - 1)
    return np.stack([(word >> np.uint64(k * width)) & mask for k in range(4)], axis=-1).reshape(len(raw), BLOCK).astype(np.uint32)


def _size(width: int) -> int:
    return BLOCK * 4 if width > 16 else BLOCK * width // 8


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The block index and the blocks of ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    index = np.zeros(blocks, INDEX)
    if not n:
        return index, b""
    full = np.concatenate([ids.astype(np.uint32), np.full(blocks * BLOCK - n, ids[-1], np.uint32)]).reshape(blocks, BLOCK)
    base = full.min(axis=1)
    rest = full - base[:, None]
    high = np.partition(rest, int(PERCENTILE * (BLOCK - 1)), axis=1)[:, int(PERCENTILE * (BLOCK - 1))]
    width = np.ceil(np.log2(high.astype(np.float64) + 1)).astype(np.int64)
    width += width % 2
    width[width > 16] = 32
    over = rest.astype(np.uint64) >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    index["base"], index["width"], index["exceptions"] = base, width, over.sum(axis=1)
    lengths = np.array([_size(int(w)) for w in width])
    index["at"] = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    index["exception_at"] = np.concatenate([[0], np.cumsum(index["exceptions"].astype(np.int64))[:-1]])
    body = np.zeros(int(lengths.sum()), np.uint8)
    low = np.where(over, 0, rest)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        packed = _pack(low[rows], int(w))
        if packed.shape[1]:
            body[(index["at"][rows].astype(np.int64)[:, None] + np.arange(packed.shape[1])).ravel()] = packed.ravel()
    row, place = np.nonzero(over)
    return index, body.tobytes() + place.astype("<u2").tobytes() + rest[row, place].astype("<u4").tobytes()


def decode_ids(index: np.ndarray, body: bytes, n: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of blocks first to last (exclusive); by default all n ids."""
    last = len(index) if last is None else last
    part = index[first:last]
    if not len(part):
        return np.zeros(0, np.uint32)
    packed = int(index["at"][-1]) + _size(int(index["width"][-1]))
    exceptions = int(index["exceptions"].astype(np.int64).sum())
    raw = np.frombuffer(body, np.uint8)
    place = np.frombuffer(body, "<u2", exceptions, packed)
    value = np.frombuffer(body, "<u4", exceptions, packed + 2 * exceptions)
    out = np.zeros((len(part), BLOCK), np.uint32)
    for w in np.unique(part["width"]):
        rows = np.flatnonzero(part["width"] == w)
        if size := _size(int(w)):
            out[rows] = _unpack(raw[part["at"][rows].astype(np.int64)[:, None] + np.arange(size)], int(w))
    counts = part["exceptions"].astype(np.int64)
    if counts.sum():
        row = np.repeat(np.arange(len(part)), counts)
        begin = int(part["exception_at"][0])
        out[row, place[begin : begin + counts.sum()]] = value[begin : begin + counts.sum()]
    out += part["base"][:, None]
    return out.ravel()[: max(0, min(n, last * BLOCK) - first * BLOCK)]


def write_part(docs: list[tuple[int | None, int]], ids: np.ndarray) -> bytes:
    """docs: (doc_id, number of ids) of each document in ids."""
    index, body = encode_ids(ids)
    entries = np.array([(d or 0, d is not None, n) for d, n in docs], ENTRY)
    return HEAD.pack(MAGIC, BLOCK, len(ids), len(docs), len(index)) + entries.tobytes() + index.tobytes() + body


def open_part(payload: bytes) -> tuple[np.ndarray, np.ndarray, bytes, int]:
    """Document entries, block index, blocks and number of ids."""
    magic, block, n, docs, blocks = HEAD.unpack_from(payload)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a part of packed ids")
    at = HEAD.size
    entries = np.frombuffer(payload, ENTRY, docs, at)
    at += entries.nbytes
    index = np.frombuffer(payload, INDEX, blocks, at)
    return entries, index, payload[at + index.nbytes :], n


def read_block(payload: bytes, k: int) -> np.ndarray:
    """The ids of block k alone."""
    _, index, body, n = open_part(payload)
    return decode_ids(index, body, n, k, k + 1)


# ---- tokens

#: The parts of a tokenizer file by which texts may be encoded chunk by chunk, and their split pattern for ASCII without white space.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ſ]+|[0-9]|[^a-z0-9À-ÖØ-öø-ſ]+")
#: Printable ASCII and Latin letters, but for the one whose small letter is two characters: composed as they are, each with a small letter of its own.
SIMPLE = re.compile(r"[!-~À-ÖØ-öø-įı-ſ]+")
#: How the splitter writes those letters: each byte as a character, itself if it can be printed, else the next one from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTE = {b: chr(b) for b in _SHOWN} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
AS_BYTES = {c: "".join(_BYTE[b] for b in chr(c).encode()) for c in range(0xC0, 0x180)}
#: Texts of these letters and blanks alone are cut into pieces at once: no piece reaches over a blank.
SIMPLE_TEXT = re.compile(r"[\n !-~À-ÖØ-öø-įı-ſ]*")
PIECE_OF_TEXT = re.compile(PIECE.pattern.replace("[^a-z", "[^\n a-z"))
#: Pieces and chunks that are kept; characters of what is kept, and of texts whose pieces are listed at once.
MOST_CACHED, LONGEST_KEPT, LISTED = 150_000, 64, 1 << 20


class _Pieces(dict):
    """The model's ids of pieces; of those not met for long, the ids go."""

    def __init__(self, model):
        super().__init__()
        self.model, self.older = model, {}

    def __missing__(self, piece: str) -> bytes:
        if (got := self.older.get(piece)) is None:
            got = array("I", [t.id for t in self.model.tokenize(piece if piece.isascii() else piece.translate(AS_BYTES))]).tobytes()
        if len(piece) <= LONGEST_KEPT:
            self[piece] = got
        return got

    def make_room(self) -> None:
        if len(self) > MOST_CACHED:
            self.older = dict(self)
            self.clear()

    def forget(self) -> None:
        self.clear()
        self.older.clear()


class Encoder(dict):
    """The tokenizer's ids of whole texts, as little-endian unsigned 32-bit integers.

    A tokenizer with NORMALIZER and SPLITTER never joins what a space or line feed
    separates. Texts of plain ASCII and Latin letters are cut into the splitter's pieces,
    which go straight to the tokenizer's model; pieces are far fewer than words with the
    marks beside them, so their ids are kept. Of other texts ids are kept by chunk between
    spaces, and chunks that aren't plain go through the whole tokenizer. Any other
    tokenizer gets whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        part = lambda x: json.loads(x.__getstate__()) if x else None  # noqa: E731 -- as it stands in the file
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.chunked = part(self.tokenizer.normalizer) == NORMALIZER and part(self.tokenizer.pre_tokenizer) == SPLITTER and all("<|" in t.content for t in added)
        self.older: dict[str, bytes] = {}
        self.pieces = _Pieces(self.model)

    def __missing__(self, chunk: str) -> bytes:
        if (got := self.older.get(chunk)) is not None:
            self[chunk] = got
            return got
        if SIMPLE.fullmatch(chunk) and "<|" not in chunk:
            low = chunk.lower()
            found = [low] if low.isalpha() else PIECE.findall(low)
            got = b"".join(map(self.pieces.__getitem__, found))
        else:
            got = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= LONGEST_KEPT:
            self[chunk] = got
        return got

    def forget(self) -> None:
        """Drops what is kept by chunk and piece."""
        self.clear()
        self[""] = b""
        self.older.clear()
        self.pieces.forget()

    def ids(self, text: str) -> bytes:
        if not self.chunked:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self.pieces.make_room()
        if SIMPLE_TEXT.fullmatch(text) and "<|" not in text:
            text = text.lower()  # as the normaliser does
            pieces = PIECE_OF_TEXT.findall(text) if len(text) <= LISTED else (m[0] for m in PIECE_OF_TEXT.finditer(text))
            return b"".join(map(self.pieces.__getitem__, pieces))
        if len(self) > MOST_CACHED:
            self.older = dict(self)
            self.clear()
        if text.isascii() and "<|" not in text:
            text = text.lower()  # fewer chunks to keep
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _parts(batches: Iterable[pa.RecordBatch], path: str, end_id: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    encoders = common.remembered("token ids")
    if path not in encoders:
        encoders[path] = Encoder(path)
    encoder = encoders[path]
    end = np.array([end_id], "<u4").tobytes()
    docs: list[tuple[int | None, int]] = []
    ids: list[bytes] = []
    slot, part, start, held = None, 0, 0, 0

    def flush() -> pa.RecordBatch:
        payload = write_part(docs, np.frombuffer(b"".join(ids), "<u4"))
        return pa.RecordBatch.from_pylist([{"shard": slot, "part": part, "start": start, "n_ids": held, "n_docs": len(docs), "payload": payload}], schema)

    try:
        for batch in common.small_batches(batches, "text"):
            for k, d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.strings(batch.column(2)), strict=True):
                if docs and (k != slot or held >= PART_IDS):
                    yield flush()
                    part, start = (part + 1, start + held) if k == slot else (0, 0)
                    docs, ids, held = [], [], 0
                slot = k
                ids.append(encoder.ids(text) + end)
                docs.append((d, len(ids[-1]) // 4))
                held += docs[-1][1]
        if docs:
            yield flush()
    finally:  # workers live on, and in later stages others need the memory
        encoder.forget()
        ids.clear()
        common.release()


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes the ids of all docs, in ascending id order, to a new folder at path."""
    common.prepare(docs.sparkSession)
    placed, _ = common.ordered_slices(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("n_docs", pa.int64()), ("payload", pa.binary())])
    (
        placed.select("slot", "doc_id", "text")
        .mapInArrow(lambda it: _parts(it, tokenizer_path, end_id, schema), "shard int, part int, start long, n_ids long, n_docs long, payload binary")
        .write.parquet(path)
    )
    return path


def _documents(batches: Iterable[pa.RecordBatch], base: dict[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, start, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            entries, index, body, n = open_part(payload)
            raw = memoryview(decode_ids(index, body, n).astype("<u4").tobytes())
            ends = np.cumsum(entries["n"].astype(np.int64))
            starts = ends - entries["n"].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(entries["doc_id"], pa.int64(), mask=entries["known"] == 0),
                    pa.array(starts + (base[shard] + start), pa.int64()),
                    pa.array(entries["n"].astype(np.int64)),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files; the driver keeps one number a shard."""
    common.prepare(spark)
    parts = spark.read.parquet(path)
    sums = parts.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    base, at = {}, 0
    for r in sums:
        base[r["shard"]], at = at, at + r["n"]
    return parts.select("shard", "start", "payload").mapInArrow(lambda it: _documents(it, base), "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Writes all docs and gives what the files hold of each."""
    spark = docs.sparkSession
    return read(spark, write(docs, common.scratch(spark, "ids"), tokenizer_path or tokenizer_file()))


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(common.table(spark, sf_dir, "documents"))
