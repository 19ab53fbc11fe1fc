"""Upsert by natural key without MERGE: outcomes, conflicts and the rows to rewrite, from one window."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def posting_days(rows: DataFrame, deliveries: DataFrame | None, as_of: Column, in_load_order: bool = False) -> DataFrame:
    """rows with `day`: event_day, or the day of arrival if event_day is closed.

    deliveries (file_load_id, covers_from, covers_to) are those of the source that
    have loaded; None: no day is ever closed. A day is closed by any other of them
    that covers it (with in_load_order, by an earlier one): of the files that cover a
    day, the least or the greatest is another one. Windows become days, so the join
    is by equality; its right side is one row a day that is covered.
    """
    if deliveries is None:
        return rows.withColumn("day", F.col("event_day"))
    each = deliveries.where("covers_from <= covers_to").select(F.explode(F.sequence("covers_from", "covers_to", F.expr("interval 1 day"))).alias("event_day"), F.col("file_load_id").alias("_f"))
    covered = each.groupBy("event_day").agg(F.min("_f").alias("_least"), F.max("_f").alias("_most"))
    other = F.col("_least") < F.col("file_load_id")
    if not in_load_order:
        other = other | (F.col("_most") > F.col("file_load_id"))
    out = rows.join(F.broadcast(covered), "event_day", "left")  # 365 rows a year
    return out.withColumn("day", F.when(other, as_of).otherwise(F.col("event_day"))).drop("_least", "_most")


@dataclass
class Merged:
    outcomes: DataFrame  # every new row, with outcome, the day that it is booked on and what it replaced
    state: DataFrame  # the state after, of each key that new rows count for
    steps: DataFrame | None = None  # what both are columns of, if they are of one frame
    columns: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    def kept(self, keep: Callable[[DataFrame], DataFrame]) -> Merged:
        """The same, read from what keep() makes of the rows, so that they are merged once."""
        if self.steps is None:
            return Merged(keep(self.outcomes), keep(self.state))
        return _of_steps(keep(self.steps), self.columns, self.order)


def _of_steps(steps: DataFrame, columns: tuple[str, ...], order: tuple[str, ...]) -> Merged:
    outcomes = steps.select("k", *[F.col(f"_o{i}").alias(o) for i, o in enumerate(order)], "outcome", "event_day", "day", "booked", "previous", "incoming")
    state = steps.where("_next is null").select("k", *[F.col(f"incoming.{c}").alias(c) for c in columns], F.col("booked").alias("posting_day"), "content_hash", "first_file_load_id", "last_file_load_id", "times_seen")
    return Merged(outcomes, state, steps, columns, order)


def merge(prior: DataFrame, new: DataFrame, key: Column | str, columns: list[str], order: tuple[str, ...] = ("file_load_id", "line_no"), retry: bool = False) -> Merged:
    """prior: k, columns, content_hash, posting_day, first_file_load_id, last_file_load_id, times_seen.
    new: k, columns, content_hash, day and the order columns (file_load_id first).

    Rows of a key take effect in order, prior first: inserted if there is none
    before, unchanged if the content is the same, else updated (a conflict). A new
    version replaces the columns; posting_day and first_file_load_id stay as first
    booked. retry: rows released from a hold, which count only where they change
    something.
    """
    content = F.struct(*columns)
    own = prior.join(new.select("k").distinct(), "k", "left_semi")
    no = lambda t: F.lit(None).cast(t)
    fields = [F.col("k"), F.col("content_hash"), content.alias("_row")]
    a = own.select(*fields, F.lit(0).alias("_new"), *[F.lit(0).cast("long").alias(f"_o{i}") for i in range(len(order))], no("date").alias("day"), no("date").alias("event_day"), "posting_day", "first_file_load_id", "last_file_load_id", "times_seen")
    b = new.select(
        *fields, F.lit(1).alias("_new"), *[F.col(o).cast("long").alias(f"_o{i}") for i, o in enumerate(order)], "day", "event_day", F.col("day").alias("posting_day"),
        F.col(order[0]).cast("long").alias("first_file_load_id"), F.col(order[0]).cast("long").alias("last_file_load_id"), F.lit(1).alias("times_seen"),
    )
    at = ["_new", *[f"_o{i}" for i in range(len(order))]]
    w = Window.partitionBy("k").orderBy(*at)
    rows = a.unionByName(b).withColumn("_before", F.lag(F.struct("content_hash", "_row")).over(w))
    outcome = F.when(F.col("_new") == 0, "prior").when(F.col("_before").isNull(), "inserted").when(F.col("_before.content_hash") == F.col("content_hash"), "unchanged").otherwise("updated")
    rows = rows.withColumn("outcome", outcome)
    # Of each key the last row, with what led to it: its content is that of the last change, since an unchanged row has the
    # content before it. The same order serves both windows, and a key that only has a prior row ends with that.
    upto = w.rowsBetween(Window.unboundedPreceding, 0)

    def stepped(own: DataFrame) -> Merged:
        steps = own.select(
            "k", *[f"_o{i}" for i in range(len(order))], "outcome", "event_day", "day", F.first("posting_day").over(upto).alias("booked"), F.col("_before._row").alias("previous"), F.col("_row").alias("incoming"), "content_hash",
            F.first("first_file_load_id").over(upto).alias("first_file_load_id"), "last_file_load_id", F.sum("times_seen").over(upto).cast("int").alias("times_seen"), "_new", F.lead("_new").over(w).alias("_next"),
        )
        return _of_steps(steps.where("_new = 1").drop("_new"), tuple(columns), order)

    out = stepped(rows)
    return Merged(out.outcomes, stepped(rows.where("outcome <> 'unchanged'")).state) if retry else out


def conflicts(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("outcome = 'updated'").select(F.col("k").alias("natural_key"), "file_load_id", "line_no", F.to_json("previous", {"ignoreNullFields": "false"}).alias("previous"), F.to_json("incoming", {"ignoreNullFields": "false"}).alias("incoming"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    late = F.count_if((F.col("outcome") == "inserted") & (F.col("day") != F.col("event_day")))
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"), late.alias("posted_late"))


def changed_days(outcomes: DataFrame, source: str) -> DataFrame:
    """Days that inserted or updated rows dirty: the day each would be booked on, even if it stays where it was."""
    return outcomes.where("outcome in ('inserted', 'updated')").select("day").distinct().withColumn("sources", F.array(F.lit(source)))


def covered_days(deliveries: DataFrame) -> DataFrame:
    """Each day of the windows (source, covers_from, covers_to)."""
    days = F.explode(F.sequence("covers_from", "covers_to", F.expr("interval 1 day"))).alias("day")
    return deliveries.select(days, F.array("source").alias("sources"))


def united_days(*parts: DataFrame) -> DataFrame:
    """day and the sorted set of its sources."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("day").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("sources"))
