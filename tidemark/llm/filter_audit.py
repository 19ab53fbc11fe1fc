"""How filters interact: what each of five drops in each of their orders, from a histogram of failure masks.

A document's mask has one bit for each filter that it fails. The filters that read
the text alone are column expressions; the fifth needs the smallest id of each text,
a grouping by the text's SHA-256 (two texts with one digest aren't known to exist).
Masks are counted by part: at most 32 cells each, with how many of a cell's documents
are labelled good and toxic. Everything else comes from cells. What a filter removes
at a step depends only on the set of filters before it, so there are 80 outcomes a
part (a filter and a set of others), and each of the 120 orders looks its five up.

Texts are read once; what is shuffled is a row of some 50 bytes a document. A text
with many copies is summed before the shuffle where its smallest id is sought, and on
the way back only texts with several ids are joined, where AQE splits a hot one.

Nulls: a null text is empty, a null source is the part of the empty string, together
with sources that are empty. Null ids are not ids: such a document repeats nothing and
is repeated by nothing. Ties: documents with equal text and equal id (repeated rows)
do not repeat each other; each counts. Labels of an id with several rows count if any
has them; null labels don't. Texts of any length are read whole. Other columns,
whatever their names, are passed by. An empty table has no parts, so gives no rows.
"""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: The conditions' bounds. A: least words; B: distinct words in a hundred; C: capitals in a hundred characters; D: characters that no text may hold.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SIGNS = 200, 50, 2, "[#$%&*|]"
FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
SPACES = "\x20\t\n\x0b\x0c\r"


def text_mask(text: Column, words: Column, distinct: Column) -> Column:
    """Bits of the filters that read one text; words and distinct: how many it has. Sums, so that no condition is skipped and what they share is computed once."""
    failed = {
        "A": words < LEAST_WORDS,
        "B": 100 * distinct < DISTINCT_PERCENT * words,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITAL_PERCENT * F.length(text),
        "D": text.rlike(SIGNS),
    }
    out = F.lit(0)
    for f, holds in failed.items():
        out = out + holds.cast("int") * BIT[f]
    return out


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """doc_id, part and mask (all five bits) of every row of docs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    bare = F.btrim("text", F.lit(SPACES))
    rows = rows.withColumn("_words", F.when(F.length(bare) > 0, F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")))
    mask = text_mask(F.col("text"), F.size("_words"), F.size(F.array_distinct("_words")))
    rows = common.kept(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("_mask")), "audit")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).where("_last > _first").select(F.col("digest").alias("_digest"), "_first")
    both = rows.join(first, F.col("digest") == F.col("_digest"), "left")
    repeats = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False)).cast("int") * BIT["E"]
    return both.select("doc_id", "part", (F.col("_mask") + repeats).alias("mask"))


def cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good and toxic: at most 32 rows a part."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id"))
    known = known.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic")).where("_good or _toxic")
    rows = masks.join(known, F.col("doc_id") == F.col("_id"), "left")
    return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("_good").alias("good"), F.count_if("_toxic").alias("toxic"))


def _outcomes() -> list[tuple[int, int, int]]:
    """(bits of the filters before, bit of a filter, orders in which exactly those stand before it)."""
    orders = (1, 1, 2, 6, 24)
    out = []
    for f in FILTERS:
        others = [BIT[x] for x in FILTERS if x != f]
        out += [(sum(c), BIT[f], orders[n] * orders[4 - n]) for n in range(5) for c in combinations(others, n)]
    return out


def _orders() -> list[tuple[str, int, int, int]]:
    """(filter_order, step, bits before, bit of the step's filter) of all orders."""
    return [("".join(o), i + 1, sum(BIT[f] for f in o[:i]), BIT[o[i]]) for o in permutations(FILTERS) for i in range(5)]


def audit(counts: DataFrame) -> DataFrame:
    """counts: part, mask, n, good, toxic. One row for each part, order and step."""
    spark = counts.sparkSession
    each = F.explode(F.array(*[F.struct(F.lit(before).alias("before"), F.lit(bit).alias("bit"), F.lit(orders).alias("orders")) for before, bit, orders in _outcomes()])).alias("o")
    rows = counts.select("part", "mask", "n", "good", "toxic", each).select("part", "mask", "n", "good", "toxic", "o.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0
    total = lambda of, when: F.sum(F.when(when, F.col(of)).otherwise(0)).cast("long")
    found = rows.groupBy("part", "before", "bit", "orders").agg(
        total("n", ~fails & ~gone).alias("kept"), total("n", fails & ~gone).alias("removed"), total("n", fails & gone).alias("redundant"), total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"), total("toxic", fails & ~gone).alias("toxic_lost"),
    )
    found = common.cut(found)  # 80 rows a part
    shares = found.groupBy("part", F.col("bit").alias("_bit")).agg(F.sum(F.col("orders") * F.col("removed")).cast("long").alias("shapley"))
    found = found.join(shares.withColumnRenamed("part", "_part"), (F.col("part") == F.col("_part")) & (F.col("bit") == F.col("_bit")))
    orders = F.broadcast(spark.createDataFrame(_orders(), "filter_order string, step int, _before int, _step_bit int"))  # 600 rows
    out = found.join(orders, (F.col("before") == F.col("_before")) & (F.col("bit") == F.col("_step_bit")))
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(cells(masked(common.table(spark, sf_dir, "documents")), common.table(spark, sf_dir, "labels")))


OP12_SQL = r"""
WITH texts AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
firsts AS (SELECT text AS t, min(doc_id) AS first FROM texts GROUP BY text),
marked AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
  FROM worded JOIN firsts ON text = t),
labelled AS (SELECT doc_id AS i, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM marked LEFT JOIN labelled ON doc_id = i GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, coalesce(list_sum(bits[1:i - 1]), 0)::INTEGER AS before FROM orders, range(1, 6) AS r(i)),
told AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told
"""
