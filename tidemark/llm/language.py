"""Language identification by error-correcting output codes.

Each language has a codeword of bits. One binary classifier a bit, over hashed
character n-grams (one to three) of the whole text, predicts the bit; loss-weighted
decoding gives each language the sum of its bits' logistic losses, each weighted by
the classifier's accuracy in training, and takes the least. A text whose second
language is within MARGIN of the first is flagged ambiguous.

Learning reads at most PER_LANGUAGE texts of each language (fewer if there are many
languages: MOST_TEXTS in all, but LEAST_TEXTS of each), those with the least hashes of
id and text, from the learning fold; prediction reads only the text. The driver gets
one count a language and the features of those texts, 16 kB each.

Nulls: a null text or one without letters is `und` with score 0; with nothing to
learn from every text is. Null languages aren't learned. Null ids pass through and
may be learned from. Ties: of languages with equal losses the first by code point is
taken, and the text is flagged. Repeated rows each give a row. Texts of any length are
read whole. Other columns, whatever their names, are passed by. An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

PER_LANGUAGE, MOST_TEXTS, LEAST_TEXTS, BUCKETS, ROUNDS, MARGIN = 400, 16_000, 8, 4096, 150, 0.1
LETTER = regex.compile(r"\p{L}")
_is_letter = np.array([chr(i).isalpha() for i in range(1 << 16)])


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a whole text, lower-cased, other than letters as spaces."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.where((points >= 1 << 16) | _is_letter[np.minimum(points, (1 << 16) - 1)], points, np.uint32(32))
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]]).astype(np.uint32)
    one = points * np.uint32(0x9E3779B1)
    two = one[:-1] * np.uint32(31) + one[1:]
    three = two[:-1] * np.uint32(31) + one[2:]
    out = np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - 12)
    for salt, h in ((1, one), (3, two), (7, three)):
        x = (h ^ np.uint32(salt * 0x01000193)) * np.uint32(0x85EBCA6B)
        out += np.bincount((x >> shift).astype(np.int64), minlength=BUCKETS)
    return out


def features(c: np.ndarray) -> np.ndarray:
    """Square roots of shares: every text has length one."""
    return np.sqrt(c / np.maximum(c.sum(axis=-1, keepdims=True), 1)).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of +1 and -1: all bits that part n languages in two, or the best of some random codes if those are many."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        bits = [[1, *[1 if (k >> i) & 1 else -1 for i in range(n - 1)]] for k in range(2 ** (n - 1) - 1)]
        return np.array(bits, np.int8).T
    rng = np.random.default_rng(seed)
    width, best, least = int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, width))
        apart = min(int((a != b).sum()) for a, b in combinations(code, 2)) if n <= 200 else width
        if apart > least and all(len(set(col)) == 2 for col in code.T):
            best, least = code, apart
    return best if best is not None else code


def train(x: np.ndarray, y: np.ndarray, languages: list[str]) -> dict:
    """Logistic regressions of each bit by AdaGrad over all rows at once."""
    code = codewords(len(languages))
    sides = code[y].astype(np.float32)  # rows, bits
    mean = x.mean(axis=0)
    x = (x - mean) * 8
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    gw, gb = np.full_like(w, 1e-6), np.full_like(b, 1e-6)
    share = np.stack([np.where(sides[:, k] > 0, 0.5 / max(1, (sides[:, k] > 0).sum()), 0.5 / max(1, (sides[:, k] < 0).sum())) for k in range(code.shape[1])], axis=1).astype(np.float32)
    for _ in range(ROUNDS):
        g = -sides / (1 + np.exp(np.clip(sides * (x @ w + b), -30, 30))) * share
        dw, db = x.T @ g + 1e-5 * w, g.sum(axis=0)
        gw += dw * dw
        gb += db * db
        w -= 0.1 * dw / np.sqrt(gw)
        b -= 0.1 * db / np.sqrt(gb)
    right = ((sides * (x @ w + b)) > 0).mean(axis=0)
    weight = np.log((right + 1e-3) / (1 - right + 1e-3)).clip(0.05)
    return {"languages": languages, "code": code.astype(np.float32), "w": w * 8, "b": b - (mean * 8) @ w, "weight": (weight / weight.sum()).astype(np.float32)}


def predict(model: dict, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the language, score and ambiguity of each row of counts."""
    margins = features(c) @ model["w"] + model["b"]  # rows, bits
    losses = np.stack([(np.logaddexp(0, -margins * bits) * model["weight"]).sum(axis=1) for bits in model["code"]], axis=1)
    best = losses.argmin(axis=1)
    p = np.exp(-(losses - losses.min(axis=1, keepdims=True)) * len(model["weight"]))
    score = 1 / p.sum(axis=1)
    second = np.partition(losses, 1, axis=1)[:, 1] if losses.shape[1] > 1 else losses[:, 0] + 1
    return best, score, second - losses.min(axis=1) < MARGIN


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.small_batches(batches, "text"):
        found = [features(counts(text)).tobytes() for text in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], names=["lang", "h", "x"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict | None:
    """The model; None without a text to learn from."""
    spark = docs.sparkSession
    common.prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(common.in_fold("doc_id") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    found = rows.groupBy("lang").count().collect()  # one row a language
    if not found:
        return None
    most = max(LEAST_TEXTS, min(PER_LANGUAGE, MOST_TEXTS // len(found)))
    # A bound of the hash by language that about half as many again pass, so that no task and no window gets a language whole.
    bounds = [(r[0], int(min(1.0, (1.5 * most + 50) / r[1]) * (1 << 32))) for r in found]
    near = rows.withColumn("h", F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(1 << 32)))
    near = near.join(F.broadcast(spark.createDataFrame(bounds, "l string, bound long")), F.col("lang") == F.col("l")).where("h < bound")
    got = sorted(((r[0], r[1], bytes(r[2])) for r in near.select("lang", "h", "text").mapInArrow(_counted, "lang string, h long, x binary").limit(3 * most * len(found)).collect()))
    taken: dict[str, list[bytes]] = {}
    for lang, _, x in got:
        own = taken.setdefault(lang, [])
        if len(own) < most:
            own.append(x)
    languages = sorted(taken)
    return train(np.stack([np.frombuffer(x, np.float32) for lang in languages for x in taken[lang]]), np.repeat(np.arange(len(languages)), [len(taken[lang]) for lang in languages]), languages)


def _predicted(batches: Iterator[pa.RecordBatch], model: dict | None) -> Iterator[pa.RecordBatch]:
    for whole in common.small_batches(batches, "text"):
        for b in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
            texts = common.strings(b.column(2))
            known = [bool(model and LETTER.search(t)) for t in texts]
            at, score, unsure = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts), bool)
            if any(known):
                c = np.stack([counts(t) for t, k in zip(texts, known, strict=True) if k])
                at[known], score[known], unsure[known] = predict(model, c)
            langs = [model["languages"][i] if k else "und" for i, k in zip(at, known, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(unsure)], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])


def identify(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every row."""
    common.prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~common.in_fold(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda it: _predicted(it, sent.value), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
