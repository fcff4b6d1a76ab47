"""Best representative of each duplicate group.

Which of two values of a field is the newer one is known where both rows carry a time. Where a time is
missing it is reasoned out: transitions between values seen in timestamped histories give precedences
(a before b, if seen more often than b before a). Their transitive closure, with cycles broken at the
weakest votes, orders the values of every group in part, and the topologically latest one is taken.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.ids import canonical_uuid
from siftwell.functions.tags import plain_tags
from siftwell.llm.cooccurrence import current_records
from siftwell.operators.components import star_components
from siftwell.runtime import Workspace

FIELDS = ("height", "width", "size")


def positive_fields(rows: DataFrame) -> DataFrame:
    """height, width, size as positive numbers or NULL; the width may stand in ``weight``."""
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    keep = [c for c in rows.columns if c not in ("height", "width", "weight", "size")]
    return rows.select(
        *keep, positive("height").alias("height"), F.coalesce(positive("width"), positive("weight")).alias("width"), positive("size").alias("size")
    )


def _long_fields(rows: DataFrame, *keep: str) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in FIELDS))
    return rows.select(*keep, F.explode(pairs).alias("p")).select(*keep, "p.*").where("value is not null")


def learn_precedence(history: DataFrame, entity: str = "id", time: str = "updated_at") -> DataFrame:
    """(field, older, newer, votes) from timestamped rows: net transitions between consecutive values.

    Rows without a time, entity or value teach nothing; equal consecutive values are no transition. Of
    two opposite transitions only the one seen more often stays, with the difference as its votes; equally
    frequent ones cancel, so the relation has no cycles of two.
    """
    rows = _long_fields(positive_fields(history.where(F.col(entity).isNotNull() & F.col(time).isNotNull())), entity, time)
    # one row per entity, field and time, in windows of a day, so that a hot entity is spread over tasks
    rows = rows.groupBy(entity, "field", F.date_trunc("day", time).alias("_day"), F.col(time).alias("_at")).agg(F.max("value").alias("value"))
    within = Window.partitionBy(entity, "field", "_day").orderBy("_at")
    inside = rows.select("field", F.lag("value").over(within).alias("older"), "value")
    days = rows.groupBy(entity, "field", "_day").agg(F.min_by("value", "_at").alias("value"), F.max_by("value", "_at").alias("last"))
    over = days.select("field", F.lag("last").over(Window.partitionBy(entity, "field").orderBy("_day")).alias("older"), "value")
    moves = inside.unionByName(over).where("older is not null and older <> value")
    signed = moves.groupBy(
        "field", F.least("older", "value").alias("lo"), F.greatest("older", "value").alias("hi")
    ).agg(F.sum(F.when(F.col("older") < F.col("value"), 1).otherwise(-1)).alias("net"))
    up = F.col("net") > 0
    return signed.where("net <> 0").select(
        "field",
        F.when(up, F.col("lo")).otherwise(F.col("hi")).alias("older"),
        F.when(up, F.col("hi")).otherwise(F.col("lo")).alias("newer"),
        F.abs("net").alias("votes"),
    )


def _strong_components(nodes: list, out: dict) -> list[list]:
    """Strongly connected components of a graph (node -> successors), by Tarjan's algorithm without recursion."""
    number, low, stack, on, found = {}, {}, [], set(), []
    for root in nodes:
        if root in number:
            continue
        work = [(root, iter(out.get(root, ())))]
        number[root] = low[root] = len(number)
        stack.append(root)
        on.add(root)
        while work:
            node, following = work[-1]
            for nxt in following:
                if nxt not in number:
                    number[nxt] = low[nxt] = len(number)
                    stack.append(nxt)
                    on.add(nxt)
                    work.append((nxt, iter(out.get(nxt, ()))))
                    break
                if nxt in on:
                    low[node] = min(low[node], number[nxt])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == number[node]:
                    part = []
                    while not part or part[-1] != node:
                        part.append(stack.pop())
                        on.discard(part[-1])
                    found.append(part)
    return found


def order_values(edges: list[tuple]) -> dict:
    """value -> length of the longest chain of precedences (older, newer, votes) that leads to it.

    Cycles are broken first: within each strongly connected part the edges of the fewest votes go, until no
    part is left. Edges outside of cycles all stay, so a value comes after everything it follows directly or
    through others.
    """
    kept, open_ = [], edges
    while open_:
        out: dict = {}
        for a, b, _ in open_:
            out.setdefault(a, []).append(b)
        nodes = sorted({x for a, b, _ in open_ for x in (a, b)})
        part = {x: k for k, xs in enumerate(_strong_components(nodes, out)) for x in xs}
        kept += [e for e in open_ if part[e[0]] != part[e[1]]]
        inner = [e for e in open_ if part[e[0]] == part[e[1]]]
        weakest: dict = {}
        for a, _, votes in inner:
            weakest[part[a]] = min(votes, weakest.get(part[a], votes))
        open_ = [e for e in inner if e[2] > weakest[part[e[0]]]]
    level: dict = {x: 0 for a, b, _ in edges for x in (a, b)}
    out, before = {}, dict.fromkeys(level, 0)
    for a, b, _ in kept:
        out.setdefault(a, []).append(b)
        before[b] += 1
    ready = [x for x, n in before.items() if n == 0]
    while ready:
        a = ready.pop()
        for b in out.get(a, ()):
            level[b] = max(level[b], level[a] + 1)
            before[b] -= 1
            if before[b] == 0:
                ready.append(b)
    return level


def currency_levels(precedence: DataFrame, work: Workspace, part_rows: int = 50_000) -> DataFrame:
    """(field, value, level): a value has a higher level than all that precede it, directly or through others.

    Connected parts of a field's relation stay together, about ``part_rows`` rows of them in a task: a row is
    a pair of values, however many records showed it. A larger part is in one task too.
    """
    node = lambda c: F.struct("field", F.col(c).alias("value"))
    held = work.save(precedence.select("field", "older", "newer", "votes"), rows=F.count(F.lit(1)))
    parts = max(1, -(-work.metric(held) // part_rows))
    roots = work.save(star_components(held.select(node("older").alias("u"), node("newer").alias("v")), work))
    named = held.withColumn("x", node("older")).join(roots, "x")
    named = named.select(F.pmod(F.xxhash64("root"), F.lit(parts)).alias("part"), "field", "older", "newer", "votes").repartition(parts, "part")

    def rank(frame: pd.DataFrame) -> pd.DataFrame:
        field = frame["field"].tolist()
        levels = order_values(list(zip(zip(field, frame["older"].tolist()), zip(field, frame["newer"].tolist()), frame["votes"].tolist())))
        return pd.DataFrame({"field": [f for f, _ in levels], "value": [v for _, v in levels], "level": list(levels.values())})

    return named.groupBy("part").applyInPandas(rank, "field string, value bigint, level bigint")


def latest_values(members: DataFrame, levels: DataFrame, group: str) -> DataFrame:
    """(group, field, value): the value of the most trusted, then latest, then topologically latest row, then of the greatest id.

    ``members`` has trust, at and id; where ``at`` is NULL the level decides, 0 for values of which nothing is
    learned. A row with a time goes before one without. A value that many groups share is a join skew on
    the side of the members, which adaptive execution splits; the choice is combined before the shuffle.
    """
    rows = members.join(levels, ["field", "value"], "left")
    level = F.when(F.col("at").isNull(), F.coalesce("level", F.lit(0)))
    return rows.groupBy(group, "field").agg(F.max_by("value", F.struct("trust", "at", level, "id")).alias("value"))


def _members(clusters: DataFrame, points: DataFrame, writers: DataFrame) -> DataFrame:
    current = current_records(points, "height", "width", "weight", "size", "categories", "writer", "updated_at")
    current = current.withColumn("id", canonical_uuid("id"))
    trusted = writers.where("writer is not null").groupBy("writer").agg(F.max("trust").alias("trust"))
    pairs = clusters.where("cluster_id is not null").select("cluster_id", canonical_uuid("id").alias("id")).where("id is not null").distinct()
    rows = pairs.join(positive_fields(current), "id").join(trusted, "writer", "left")
    return rows.withColumn("trust", F.coalesce("trust", F.lit(0)))


def _assemble(members: DataFrame, fields: DataFrame) -> DataFrame:
    best = members.groupBy("cluster_id").agg(F.max(F.struct(F.coalesce("size", F.lit(0)).alias("s"), "id"))["id"].alias("keep_id"))
    tags = members.select("cluster_id", F.explode(plain_tags(F.col("categories"))).alias("tag")).groupBy("cluster_id").agg(
        F.array_join(F.array_sort(F.collect_set("tag")), "|").alias("categories")
    )
    wide = fields.groupBy("cluster_id").agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS))
    out = best.join(wide, "cluster_id", "left").join(tags, "cluster_id", "left")
    return out.select(
        "cluster_id", "keep_id", *(F.coalesce(f, F.lit(-1)).cast("bigint").alias(f) for f in FIELDS),
        F.coalesce("categories", F.lit("")).alias("categories"),
    )


def cluster_survivors(clusters: DataFrame, points: DataFrame, writers: DataFrame, use_times: bool = True) -> DataFrame:
    """One row per cluster with a member among the points: keep_id, height, width, size, categories.

    Each field takes the positive value of the most trusted writer, then the latest, then that of the
    greatest id; -1 if there is none. Latest is the later updated_at; among members without a time, or
    for all if ``use_times`` is false, it is the value that comes last in the order learned from transitions. A
    member with a time goes before one without. keep_id has the largest size (NULL or not positive is 0,
    ties to the greatest id); categories are all plain tags, sorted and joined by '|', '' if none.
    """
    work = Workspace(points.sparkSession, "survivors")
    members = work.save(_members(clusters, points, writers))
    time = F.col("updated_at") if use_times else F.lit(None).cast("timestamp")
    values = _long_fields(members.withColumn("at", time), "cluster_id", "id", "trust", "at")
    levels = currency_levels(learn_precedence(points), work)
    return _assemble(members, latest_values(values, levels, "cluster_id"))
