"""URL filter by a temporal list join.

A list is a table of dated entries: (kind, value, action, at), with kind `domain`
(the host and all under it), `host` (the host alone) or `prefix` (host and path
beginning, by whole path parts), and action `add` or `remove`. The entries of one
(kind, value) become validity intervals: from an add to the next entry. A capture
(url, fetched) is evaluated against the entries active when it was fetched: each
URL gives its lookup keys (one a host suffix, one the host, one a path part, as far as
the list has entries so long), and an
as-of join finds the last interval of each key that began by then, which holds if it
hasn't ended. The join is a union of lookups and intervals, in one window by key and
time: a capture meets one interval of a key, however many the key has. A key with
more than LOOKUPS lookups is dealt to several windows by a hash, its intervals going
to each; if the list doesn't have it, its lookups are left out before. Blocked are captures with any
active entry. Hosts are compared in lower case, paths as they are.

Nulls: a null or unparsable URL, or a null time, has no keys and is never blocked.
Entries with a null value, action or time don't count; of entries for one key at
one time, a remove wins; a repeated add is no new interval. An entry holds from its
very time on. Repeated captures each give a row, null ids too. URLs of any length and
with any number of parts are looked up whole. Other columns, whatever their names,
are passed by. An empty table gives no rows, an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#@]*\]|[^/?#:@]+)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(/[^?#]*)"
#: Lookups of one key in one window; intervals of a list whose keys are broadcast, so that lookups it doesn't have are left out at once.
LOOKUPS, FEW = 1 << 10, 100_000


def host_of(url: Column) -> Column:
    """The lower-case host, null if there is none."""
    return F.nullif(F.lower(F.rtrim(F.regexp_extract(url, HOST, 1), F.lit("."))), F.lit(""))


def keys_of(url: Column, labels_: int, parts_: int) -> Column:
    """`kind:value` of each entry that a URL could match, if no domain of the list has more labels and no prefix more parts than that. The bounds are the list's own, so no entry is missed, and a long URL gives no more keys than a list can have."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.greatest(n - labels_ + 1, F.lit(1)), F.greatest(n, F.lit(1))), lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, n), ".")))
    parts = F.slice(F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda p: p != ""), 1, max(parts_, 1))
    steps = F.size(parts) if parts_ else F.lit(0)
    paths = F.when(steps > 0, F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda i: F.concat(F.lit("prefix:"), host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.array_union(F.concat(suffixes, F.array(F.concat(F.lit("host:"), host))), paths))


def intervals(entries: DataFrame) -> DataFrame:
    """key, valid_from, valid_to (null while it holds) of a list's entries."""
    good = entries.where("kind is not null and value is not null and action in ('add', 'remove') and at is not null")
    host = F.lower(F.substring_index("value", "/", 1))
    value = F.when(F.col("kind") == "prefix", F.concat(host, F.substring("value", F.length(host) + 1, F.length("value")))).otherwise(F.lower("value"))
    keyed = good.select(F.concat_ws(":", F.col("kind"), value).alias("key"), F.col("at").alias("valid_from"), "action")
    one = keyed.groupBy("key", "valid_from").agg(F.max("action").alias("action"))  # remove sorts after add
    order = Window.partitionBy("key").orderBy("valid_from")
    changed = one.withColumn("before", F.lag("action").over(order)).where("before is null or before <> action")
    return changed.withColumn("valid_to", F.lead("valid_from").over(order)).where("action = 'add'").select("key", "valid_from", "valid_to")


def as_of(looked: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of looked (key, url, fetched; distinct) with an interval of held (key, valid_from, valid_to) that holds then."""
    if held.count() <= FEW:
        looked = looked.join(F.broadcast(held.select("key").distinct()), "key", "left_semi")
    often = looked.groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > LOOKUPS)
    listed = held.select("key").distinct().withColumn("_listed", F.lit(True))
    hot = common.kept(often.join(listed, "key", "left"), "hot-keys")  # at most one in LOOKUPS lookups
    parts = F.coalesce(F.ceil(F.col("_n") / LOOKUPS), F.lit(1)).cast("int")
    lookups = looked.join(hot, "key", "left").where("_n is null or _listed").select("key", F.pmod(F.xxhash64("url", "fetched"), parts).cast("int").alias("part"), F.col("fetched").alias("at"), "url")
    ends = held.join(hot, "key", "left").select("key", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("valid_from").alias("at"), F.lit(None).cast("string").alias("url"), F.struct(F.col("valid_to").alias("to")).alias("held"))
    lookups = lookups.withColumn("held", F.lit(None).cast(ends.schema["held"].dataType))
    in_time = Window.partitionBy("key", "part").orderBy("at", F.col("url").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    met = lookups.unionByName(ends).withColumn("held", F.last("held", ignorenulls=True).over(in_time))
    return met.where("url is not null and held is not null and (held.to is null or at < held.to)").select("key", "url", F.col("at").alias("fetched"))


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """id, url, time, blocked, n_active and first_key (the smallest active key) of every capture.

    Keys of equal (url, time) are looked up once, so a hot page adds no rows to the join.
    """
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched"))
    distinct = rows.where("url is not null and fetched is not null").select("url", "fetched").distinct()
    held = common.kept(intervals(entries), "intervals")
    longest = lambda kind, sign: F.coalesce(F.max(F.when(F.startswith("key", F.lit(f"{kind}:")), F.size(F.split("key", sign)))), F.lit(0))
    labels, parts = held.agg(longest("domain", r"\."), longest("prefix", "/") - 1).first()
    looked = distinct.withColumn("key", F.explode(keys_of(F.col("url"), max(labels, 1), max(parts, 0))))
    found = as_of(looked, held).groupBy("url", "fetched").agg(F.count("*").alias("n_active"), F.min("key").alias("first_key"))
    out = rows.join(found, ["url", "fetched"], "left")
    return out.select("page_id", "url", "fetched", F.col("n_active").isNotNull().alias("blocked"), F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), "first_key")


# ---- the query: pages have no fetch times and no list, so both follow from the data by rule


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time: page_id hours after the start of 2024, within a year."""
    at = F.timestamp_add("HOUR", F.pmod(F.col("page_id"), F.lit(8760)).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    return pages.select("page_id", "url", at.alias("fetched"))


def _day(md5: Column, at: int) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.conv(F.substring(md5, at, 2), 16, 10).cast("int"))).cast("timestamp_ntz")


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list over the pages' own hosts, by the digits of each host's md5.

    Hosts whose first digit is 0 to 3 are listed whole (host, or domain if their
    second is under 8) from one day on, taken off on a later day and, for some, put
    on again. The first path part of hosts beginning with 4 to 7 is listed once.
    """
    own = pages.where("url is not null").select(host_of(F.col("url")).alias("host"), F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+/([^/?#]+)", 1).alias("part")).where("host is not null").distinct()
    own = own.withColumn("m", F.md5("host"))
    listed = own.where("substring(m, 1, 1) < '4'").select("host", "m").distinct()
    kind = F.when(F.substring("m", 2, 1) < "8", F.lit("domain")).otherwise(F.lit("host"))
    dates = [(F.lit("add"), _day(F.col("m"), 3)), (F.lit("remove"), F.timestamp_add("DAY", F.lit(60), _day(F.col("m"), 3))), (F.when(F.substring("m", 5, 1) < "8", F.lit("add")), F.timestamp_add("DAY", F.lit(90), _day(F.col("m"), 3)))]
    whole = listed.select(kind.alias("kind"), F.col("host").alias("value"), F.explode(F.array(*[F.struct(a.alias("action"), t.alias("at")) for a, t in dates])).alias("e")).select("kind", "value", "e.action", "e.at")
    paths = own.where("substring(m, 1, 1) between '4' and '7' and part <> ''").select(F.lit("prefix").alias("kind"), F.concat_ws("/", "host", "part").alias("value"), F.lit("add").alias("action"), _day(F.col("m"), 3).alias("at"))
    return whole.where("action is not null").union(paths)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    return evaluate(captures_of(pages), entries_of(pages))


OP4_SQL = r"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_hours(CAST(((page_id % 8760) + 8760) % 8760 AS INTEGER)) AS fetched,
         nullif(rtrim(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#@]*\]|[^/?#:@]+)', 1)), '.'), '') AS host,
         regexp_extract_all(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(/[^?#]*)', 1), '[^/]+') AS parts
  FROM pages),
own AS (SELECT DISTINCT host, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS part, md5(host) AS m FROM captures WHERE host IS NOT NULL),
dated AS (
  SELECT DISTINCT host, m, substr(m, 1, 1) AS d, CAST(('0x' || substr(m, 3, 2)) AS INTEGER) AS day FROM own),
entries AS (
  SELECT CASE WHEN substr(m, 2, 1) < '8' THEN 'domain:' ELSE 'host:' END || host AS key, TIMESTAMP '2024-01-01' + to_days(day) AS valid_from, TIMESTAMP '2024-01-01' + to_days(day + 60) AS valid_to FROM dated WHERE d < '4'
  UNION ALL
  SELECT CASE WHEN substr(m, 2, 1) < '8' THEN 'domain:' ELSE 'host:' END || host, TIMESTAMP '2024-01-01' + to_days(day + 90), NULL FROM dated WHERE d < '4' AND substr(m, 5, 1) < '8'
  UNION ALL
  SELECT 'prefix:' || host || '/' || part, TIMESTAMP '2024-01-01' + to_days(CAST(('0x' || substr(m, 3, 2)) AS INTEGER)), NULL FROM own WHERE substr(m, 1, 1) BETWEEN '4' AND '7' AND part <> ''),
keyed AS (
  SELECT url, fetched, 'host:' || host AS key FROM captures WHERE host IS NOT NULL
  UNION SELECT url, fetched, 'domain:' || array_to_string(list_slice(string_split(host, '.'), i, 1000), '.') FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM captures WHERE host IS NOT NULL)
  UNION SELECT url, fetched, 'prefix:' || host || '/' || array_to_string(list_slice(parts, 1, i), '/') FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM captures WHERE host IS NOT NULL)),
found AS (
  SELECT url, fetched, count(DISTINCT keyed.key) AS n, min(keyed.key) AS k FROM keyed JOIN entries ON keyed.key = entries.key AND valid_from <= fetched AND (valid_to IS NULL OR fetched < valid_to) GROUP BY url, fetched)
SELECT page_id, captures.url, captures.fetched, n IS NOT NULL AS blocked, CAST(coalesce(n, 0) AS BIGINT) AS n_active, k AS first_key
FROM captures LEFT JOIN found ON captures.url = found.url AND captures.fetched = found.fetched
"""
