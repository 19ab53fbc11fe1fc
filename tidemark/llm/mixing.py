"""Mixing sources to target word budgets by Efraimidis-Spirakis sampling.

Every document has an exponential key -ln(u) / w: u is a hash of its id (of its text
if it has none), w its quality weight. A source's target is met by whole passes (epochs) over all its
documents, then by the documents first in key order until the rest of the budget
is used; the document on the edge is taken if that comes nearer the target.

All of it is built from DataFrame functions. Only per-source sums (one row a
source) are windowed without a key; running sums go by (source, key bucket), so
that a hot source is dealt over many tasks.

Nulls: a null text has size 0; a null source is a source of its own, last in
order; a null id has no quality label. Ties: keys that are alike stand in the order
of id, size and text hash. Repeated rows each count, take part and are taken alone.
Documents of size 0 are taken 0 words. Texts of any length are counted whole. Other
columns, whatever their names, are passed by, and apply() returns them. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS, SHARE, MOST_EPOCHS = (3.0, 1.0, 2.0), 1.5, 2.0
#: Words of a text.
WORD = r"[^\x20\x09-\x0D]+"
#: Sampling weight of a document by its quality label, and without one.
GOOD, UNKNOWN, POOR = 2.0, 1.0, 0.5
#: Key buckets of each source: 4 billion documents of one source are windows of a million rows.
BUCKETS = 4096


def size_of(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target of each row of sizes (source, source_size).

    Filling to a common level: a source is capped if weight * level is above most
    times its size. With sources by size to weight, the first k are capped for the
    smallest k at which the level of the others caps none of them.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_w", F.element_at(kinds, (F.row_number().over(order) - 1) % len(weights) + 1))
    ranked = ranked.withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    by_ratio = Window.orderBy((F.col("_cap") / F.col("_w")), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    ranked = (
        ranked.withColumn("_all", F.sum("source_size").over(everyone) * F.lit(float(share)))
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_weight", F.sum("_w").over(everyone) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
        .withColumn("_level", (F.col("_all") - F.col("_capped")) / F.col("_weight"))
        .withColumn("_over", F.col("_level") * F.col("_w") > F.col("_cap"))
    )
    first = F.min(F.when(~F.col("_over"), F.struct(F.col("_cap") / F.col("_w"), "_level"))).over(everyone)
    ranked = ranked.withColumn("_at", first["_level"])
    target = F.when(F.col("_at").isNull(), F.col("_cap")).otherwise(F.least(F.col("_at") * F.col("_w"), F.col("_cap")))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """doc_id, text_hash, size, source, source_size, target, epochs (times taken) and taken of every row of docs."""
    known = F.coalesce(F.col(id_col).cast("long").cast("string"), F.concat(F.lit("-"), F.coalesce(text_col, F.lit(""))))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), size_of(text_col).alias("size"), F.col(source_col).cast("string").alias("source"),
        F.conv(F.substring(F.md5(F.concat(F.lit("mix"), known)), 1, 13), 16, 10).cast("long").alias("draw"),
    )
    rows = common.kept(rows, "sizes")
    if labels is not None:
        quality = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("quality").alias("_quality"))
        rows = rows.join(quality, F.col("doc_id") == F.col("_id"), "left")
        weight = F.when(F.col("_quality") >= 1, GOOD).when(F.col("_quality") < 1, POOR).otherwise(UNKNOWN)
    else:
        weight = F.lit(UNKNOWN)
    u = (F.col("draw") + 0.5) / F.lit(float(1 << 52))
    rows = rows.withColumn("_key", -F.log(u) / weight).withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * BUCKETS).cast("int"))
    rows = rows.select("doc_id", "text_hash", "size", "source", "_key", "_bucket")

    sums = common.cut(rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_n")))
    per_source = targets(sums.groupBy("source").agg(F.sum("_n").alias("source_size")), weights, share)
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    # One row for each source and bucket, with all a document of it needs to know.
    plan = sums.join(per_source.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("source").alias("_source"), F.col("_bucket").alias("_b"), "_before", "source_size", "target"
    )
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b")))
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", F.col("doc_id").asc_nulls_last(), "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    full = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.floor(F.col("target") / F.col("source_size")).cast("double"))
    rest = F.col("target") - full * F.col("source_size")
    ahead = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = (full + F.when(ahead + F.col("size") / 2 <= rest, 1.0).otherwise(0.0)).cast("int")
    rows = rows.withColumn("epochs", F.least(epochs, F.lit(int(MOST_EPOCHS))))
    return rows.select("doc_id", "text_hash", "size", "source", "source_size", "target", "epochs", (F.col("epochs") * F.col("size")).cast("long").alias("taken"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs")


def apply(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Rows of docs as often as the mix takes them."""
    found = mix(docs, labels)
    times = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("source").alias("_source")).agg(F.sum("epochs").alias("all"), F.count("*").alias("same")).where("all > 0")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), F.col("source").cast("string").alias("source"))
    joined = keyed.join(times, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")) & F.col("source").eqNullSafe(F.col("_source")))
    # Rows that are alike in id, text and source share what their like took between them.
    nth = F.row_number().over(Window.partitionBy("id", "hash", "source").orderBy(common.row_order(docs)))
    copies = F.floor(F.col("all") / F.col("same")) + F.when(nth <= F.col("all") % F.col("same"), 1).otherwise(0)
    taken = joined.withColumn("copies", copies.cast("int")).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


OP3_SQL = r"""
WITH docs AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, source,
         (CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '-' || coalesce(text, ''))), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
quality AS (SELECT doc_id AS i, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
keyed AS (SELECT docs.*, -ln(u) / CASE WHEN q >= 1 THEN 2.0::DOUBLE WHEN q < 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS key FROM docs LEFT JOIN quality ON doc_id = i),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS cap FROM sizes),
levels AS (
  SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / ((sum(w) OVER ()) - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM weighed),
settled AS (SELECT arg_min(level, cap / w) AS held FROM levels WHERE level * w <= cap),
targets AS (SELECT source, source_size, CASE WHEN held IS NULL THEN cap ELSE least(held * w, cap) END AS target FROM levels, settled),
placed AS (
  SELECT doc_id, size, k.source, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY k.key, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
         CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE floor(target / source_size) END AS whole
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source),
told AS (SELECT *, CAST(least(whole + CASE WHEN ahead + size / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END, 2) AS INTEGER) AS epochs FROM placed)
SELECT doc_id, size, source_size, target, CAST(epochs * size AS BIGINT) AS taken, source, epochs FROM told
"""
