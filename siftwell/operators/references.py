"""References to records that do not exist.

Every key carries two signed counts that follow from change deltas: how often it is referred to and
how often it exists. Keys with positive references and zero existence are the orphans. For a report as
of the time of each reference the existence deltas of a key are kept as a short timeline (one entry
per net change), so the count at any time is a prefix sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.ids import canonical_uuid
from siftwell.functions.paths import plain_path
from siftwell.runtime import Workspace

LEDGER_KEY = ["kind", "key"]

#: Referring tables and columns.
REFERENCE_COLUMNS = [
    ("point_source", "id"), ("point_source", "path"), ("clusters", "id"),
    ("search_result", "query_id"), ("search_result", "neighbor_id"), ("wrong_ext", "path"),
]


def merge_ledger(state: DataFrame | None, deltas: DataFrame, counts: tuple[str, ...] = ("refs", "exists")) -> DataFrame:
    """New ledger (kind, key, refs, exists) from the old one and signed deltas of the same columns.

    Deltas may hold any number of rows a key; they are summed before the shuffle. NULL counts are 0,
    NULL keys refer to nothing and are left out. Keys whose ``counts`` are all zero leave the ledger.
    """
    columns = [*LEDGER_KEY, *counts]
    rows = deltas.select(*columns)
    if state is not None:
        rows = state.select(*columns).unionByName(rows)
    summed = rows.where("key is not null").groupBy(*LEDGER_KEY)
    return summed.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts)).where(" or ".join(f"{c} <> 0" for c in counts))


def ledger_orphans(state: DataFrame) -> DataFrame:
    """Keys with positive references and no existence."""
    return state.where("refs > 0 and exists <= 0")


def timeline_from_deltas(deltas: DataFrame) -> DataFrame:
    """(kind, key, timeline) from rows (kind, key, at, sign); entries are net changes in order of time.

    Equal times of a key are summed first, so repeated deltas do not lengthen the timeline.
    """
    net = deltas.where("key is not null and at is not null").groupBy(*LEDGER_KEY, "at").agg(F.sum("sign").alias("sign"))
    return (
        net.where("sign <> 0")
        .groupBy(*LEDGER_KEY)
        .agg(F.sort_array(F.collect_list(F.struct("at", F.col("sign").cast("int").alias("sign")))).alias("timeline"))
    )


def point_timeline(points: DataFrame) -> DataFrame:
    """Timeline of each point: +1 when created, -1 when its current record says deleted.

    The current record is that with the latest updated_at (ties: the greater idx). A point without
    created_at has an empty timeline: it exists in a record, but at no time.
    """
    current = points.where("id is not null").groupBy(canonical_uuid("id").alias("key")).agg(
        F.min("created_at").alias("born"),
        F.max(F.struct("updated_at", "idx", "deleted_at"))["deleted_at"].alias("died"),
    )
    entry = lambda c, sign: F.struct(F.col(c).alias("at"), F.lit(sign).alias("sign"))
    line = F.sort_array(F.filter(F.array(entry("born", 1), entry("died", -1)), lambda e: e["at"].isNotNull()))
    return current.select(F.lit("point").alias("kind"), "key", line.alias("timeline"))


def object_timeline(listing: DataFrame) -> DataFrame:
    """Timeline of each object: +1 at the first snapshot of a stay, -1 at the first one without it.

    One shuffle by path; the set of an object's snapshots is as long as there are snapshots at most.
    The times of all snapshots (one row per delivery) are the only thing the driver holds.
    """
    times = sorted(r[0] for r in listing.where("taken_at is not null").select(F.unix_micros("taken_at")).distinct().collect())
    steps = listing.sparkSession.createDataFrame(list(zip(times, [*times[1:], None])), "a bigint, b bigint")
    following = steps.select(F.timestamp_micros("a").alias("taken_at"), F.timestamp_micros("b").alias("next_at"))
    here = (
        listing.where((F.col("mode") == "FILE") & ~F.coalesce(F.col("is_deleted"), F.lit(False)))
        .where("path is not null")
        .select("taken_at", plain_path("path").alias("key"))
        .join(F.broadcast(following), "taken_at")
    )
    stays = here.groupBy("key").agg(
        F.collect_set("taken_at").alias("present"), F.collect_set("next_at").alias("absent_from")
    )
    plus = F.transform(
        F.array_except("present", "absent_from"), lambda t: F.struct(t.alias("at"), F.lit(1).alias("sign"))
    )
    minus = F.transform(
        F.array_except("absent_from", "present"), lambda t: F.struct(t.alias("at"), F.lit(-1).alias("sign"))
    )
    return stays.select(F.lit("object").alias("kind"), "key", F.sort_array(F.concat(plus, minus)).alias("timeline"))


def _references(df: DataFrame, table: str, column: str, kind: str, key: Column, time: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("ref_table"),
        F.lit(column).alias("ref_column"),
        F.col("row_id").alias("ref_row"),
        F.lit(kind).alias("kind"),
        key.alias("key"),
        F.col(time).alias("t"),
    ).where("key is not null and t is not null")


def collect_references(
    point_source: DataFrame, clusters: DataFrame, search_result: DataFrame, wrong_ext: DataFrame
) -> DataFrame:
    """All references as (ref_table, ref_column, ref_row, kind, key, t); NULL keys and times refer to nothing."""
    point = lambda df, table, column, time: _references(df, table, column, "point", canonical_uuid(column), time)
    thing = lambda df, table, time: _references(df, table, "path", "object", plain_path("path"), time)
    parts = [
        point(point_source, "point_source", "id", "recorded_at"),
        thing(point_source, "point_source", "recorded_at"),
        point(clusters, "clusters", "id", "assigned_at"),
        point(search_result, "search_result", "query_id", "searched_at"),
        point(search_result, "search_result", "neighbor_id", "searched_at"),
        thing(wrong_ext, "wrong_ext", "found_at"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def orphan_references(references: DataFrame, timelines: DataFrame) -> DataFrame:
    """References whose key has an existence count of zero at their time, with reason and month.

    reason: 'missing' if the key has no timeline, 'deleted' if it came into being at or before the time,
    else 'late'. Repeated deliveries of a row give one result. A hot key is a join skew on the side of
    the references, which adaptive execution splits; the timeline of a key is one short row.
    """
    joined = references.join(timelines, LEDGER_KEY, "left")
    past = F.filter("timeline", lambda e: e["at"] <= F.col("t"))
    count = F.aggregate(past, F.lit(0), lambda acc, e: acc + e["sign"])
    reason = (
        F.when(F.col("timeline").isNull(), F.lit("missing"))
        .when(F.coalesce(count, F.lit(0)) > 0, F.lit(None).cast("string"))
        .when(F.exists(past, lambda e: e["sign"] > 0), F.lit("deleted"))
        .otherwise(F.lit("late"))
    )
    month = _month("t")
    return (
        joined.select(
            "ref_table", "ref_column", "ref_row", reason.alias("reason"), month.alias("period")
        )
        .where("reason is not null")
        .distinct()
    )


def _month(at: str) -> Column:
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM")


def ledger_by_period(references: DataFrame, timelines: DataFrame) -> DataFrame:
    """(ref_table, ref_column, period, keys, refs): the orphan keys at the end of every month with references, and the references to them.

    The ledger is maintained: each month's signed deltas, summed per key, are merged into the state that the
    months before have left, and the orphans of the new state are reported. Repeated deliveries of a reference
    count once. Of the data the driver holds the months only; states are written tables.
    """
    work = Workspace(references.sparkSession, "ledger")
    names = tuple(f"refs_{i}" for i in range(len(REFERENCE_COLUMNS)))
    counts = ("exists", *names)
    made = references.dropDuplicates(["ref_table", "ref_column", "ref_row"]).withColumn("period", _month("t"))
    of = [F.when((F.col("ref_table") == t) & (F.col("ref_column") == c), 1).otherwise(0).alias(n) for n, (t, c) in zip(names, REFERENCE_COLUMNS)]
    made = made.select(*LEDGER_KEY, "period", F.lit(0).alias("exists"), *of)
    live = timelines.select(*LEDGER_KEY, F.explode("timeline").alias("e")).select(*LEDGER_KEY, _month("e.at").alias("period"), F.col("e.sign").alias("exists"), *(F.lit(0).alias(n) for n in names))
    deltas = made.unionByName(live).groupBy(*LEDGER_KEY, "period").agg(*(F.sum(c).alias(c) for c in counts))
    deltas = work.save(deltas, "period")
    months = [r[0] for r in deltas.where(" or ".join(f"{n} <> 0" for n in names)).select("period").distinct().orderBy("period").collect()]
    state, before, out = None, "", None
    for month in months:
        batch = deltas.where((F.col("period") > before) & (F.col("period") <= month))
        after = work.save(merge_ledger(state, batch, counts))
        work.drop(state)
        state, before = after, month
        orphans = state.where("exists <= 0").agg(*(f(n) for n in names for f in (lambda n: F.count(F.when(F.col(n) > 0, 1)).alias("k" + n), lambda n: F.sum(n).alias(n))))
        lines = F.array(*(F.struct(F.lit(t).alias("ref_table"), F.lit(c).alias("ref_column"), F.lit(month).alias("period"), F.col("k" + n).alias("keys"), F.col(n).alias("refs")) for n, (t, c) in zip(names, REFERENCE_COLUMNS)))
        report = work.save(orphans.select(F.explode(lines).alias("line")).select("line.*").where("keys > 0"))
        out = report if out is None else out.unionByName(report)
    if out is None:
        return references.sparkSession.createDataFrame([], "ref_table string, ref_column string, period string, keys bigint, refs bigint")
    return out


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Number of orphan references per table, column, reason and month."""
    return orphans.groupBy("ref_table", "ref_column", "period", "reason").agg(F.count("*").alias("n"))
