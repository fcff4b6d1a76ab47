"""Co-occurrence and survivors."""

import datetime as dt
import itertools
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftwell.llm import cooccurrence, survivors

UTC = dt.timezone.utc


def day(n):
    return dt.datetime(2024, 1, n, tzinfo=UTC)


POINTS = "idx bigint, id string, categories array<string>, updated_at timestamp, weight bigint, height bigint, width bigint, size bigint, writer string, tag_a string"


def points(spark, rows):
    """rows: (idx, id, categories, day, weight, height, width, size, writer)"""
    return spark.createDataFrame([(r[0], r[1], r[2], day(r[3]) if r[3] else None, *r[4:], "x") for r in rows], POINTS)


def tagged(*bags):
    return [(i, f"p{i}", bag, 1, None, None, None, None, None) for i, bag in enumerate(bags)]


def test_pair_counts_against_brute_force(spark):
    bags = [["a", "b"], ["B", "a ", "c"], ["a"], ["", None], None, ["c", "b_x", "b-x"], ["a", "b"], ["b x", "c"]] * 3
    got = {(r["tag_a"], r["tag_b"]): (r["n_ab"], r["n_a"], r["n_b"], r["n"]) for r in cooccurrence.point_tag_pairs(points(spark, tagged(*bags))).collect()}
    clean = [sorted({" ".join(t.lower().replace("_", " ").replace("-", " ").split()) for t in bag or [] if t} - {""}) for bag in bags]
    single, pair = Counter(t for b in clean for t in b), Counter(p for b in clean for p in itertools.combinations(b, 2))
    n = sum(1 for b in clean if b)
    assert got == {p: (k, single[p[0]], single[p[1]], n) for p, k in pair.items()}


def test_current_record_counts_once(spark):
    rows = [(1, "p", ["old", "tag"], 1, None, None, None, None, None), (0, "p", ["a", "b"], 2, None, None, None, None, None), (0, "p", ["a", "b"], 2, None, None, None, None, None)]
    assert [(r["tag_a"], r["tag_b"], r["n_ab"]) for r in cooccurrence.point_tag_pairs(points(spark, rows)).collect()] == [("a", "b", 1)]


def test_frequent_pairs_bound(spark):
    bags = [["a", "b"]] * 3 + [["c"]] * 6  # 3 * 9 >= 3 * 3 * 3
    stats = cooccurrence.point_tag_pairs(points(spark, tagged(*bags)))
    assert cooccurrence.frequent_pairs(stats).count() == 1
    assert cooccurrence.frequent_pairs(cooccurrence.point_tag_pairs(points(spark, tagged(*bags[:8])))).count() == 0
    row = stats.first()
    assert (row["lift"], row["conviction"]) == (3.0, None)


def test_pairs_empty_and_hot_basket(spark):
    assert cooccurrence.point_tag_pairs(points(spark, [])).count() == 0
    hot = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.col("id").cast("string"))).alias("tags"))
    rows = cooccurrence.pair_statistics(cooccurrence.collapse_baskets(hot, "tags")).collect()
    assert [(r["n_ab"], r["n"]) for r in rows] == [(3000, 9000)]


def survive(spark, clusters, rows, use_times=True):
    c = spark.createDataFrame([(*x, "z") for x in clusters], "cluster_id bigint, id string, categories string")
    w = spark.createDataFrame([("good", 4), ("bad", 1), (None, 9)], "writer string, trust int")
    out = survivors.cluster_survivors(c, points(spark, rows), w, use_times).collect()
    return {r["cluster_id"]: tuple(r)[1:] for r in out}


P, Q, R = (f"00000000-0000-0000-0000-00000000000{i}" for i in (1, 2, 3))


def test_survivor_fields(spark):
    rows = [
        (1, P, ["B b"], 3, 640, 100, None, 10, "bad"),
        (2, Q, ["a", "b_b"], 2, None, 200, 0, None, "good"),
        (3, R, None, 5, None, -1, 800, 10, None),
    ]
    clusters = [(1, P), (1, Q.upper()), (1, "{" + R + "}"), (1, P), (2, "3"), (3, "nobody"), (None, P), (4, None)]
    assert survive(spark, clusters, rows) == {1: (R, 200, 640, 10, "a|b b"), 2: (R, -1, 800, 10, "")}


def test_survivor_latest_then_greatest_id(spark):
    rows = [(1, P, None, 2, None, 5, None, 1, "good"), (2, Q, None, 3, None, 6, None, 1, "good"), (3, R, None, 3, None, 7, None, 1, "good")]
    assert survive(spark, [(1, P), (1, Q), (1, R)], rows)[1][:2] == (R, 7)


def test_precedence_is_learned_and_used(spark):
    history = []
    for i in range(4):  # 100 turns into 120 four times, once the other way
        history += [(i, f"h{i}", None, 1, None, 100, None, None, "good"), (i + 10, f"h{i}", None, 2, None, 120, None, None, "good")]
    history += [(30, "k", None, 1, None, 120, None, None, "good"), (31, "k", None, 2, None, 100, None, None, "good")]
    table = points(spark, history)
    assert {tuple(r) for r in survivors.learn_precedence(table).collect()} == {("height", 100, 120, 3)}
    rows = [*history, (50, P, None, None, None, 120, None, None, "good"), (51, Q, None, None, None, 100, None, None, "good")]
    assert survive(spark, [(1, P), (1, Q)], rows)[1][1] == 120  # by id alone it would be 100
    timed = [*history, (50, P, None, 4, None, 120, None, None, "good"), (51, Q, None, 3, None, 100, None, None, "good")]
    assert survive(spark, [(1, P), (1, Q)], timed)[1][1] == 120
    assert survive(spark, [(1, P), (1, Q)], timed, use_times=False)[1][1] == 120
    part = [*history, (50, P, None, None, None, 120, None, None, "good"), (51, Q, None, 3, None, 100, None, None, "good")]
    assert survive(spark, [(1, P), (1, Q)], part)[1][1] == 100  # a known time goes before none


def test_precedence_chain_and_opposites(spark):
    rows = []
    for i, (a, b) in enumerate([(1, 2), (2, 3), (5, 6), (6, 5)]):
        rows += [(2 * i, f"h{i}", None, 1, None, a, None, None, None), (2 * i + 1, f"h{i}", None, 2, None, b, None, None, None)]
    assert {tuple(r)[1:3] for r in survivors.learn_precedence(points(spark, rows)).collect()} == {(1, 2), (2, 3)}


def test_survivors_empty(spark):
    assert survive(spark, [], []) == {}
    assert survive(spark, [(1, P)], []) == {}


def test_chains_through_values_outside_the_group(spark):
    history = []
    for i in range(9):  # 1 turns into 2, elsewhere 2 into 3
        for k, (a, b) in enumerate([(1, 2), (2, 3)]):
            history += [(i, f"h{k}{i}", None, 1, None, a, None, None, None), (i + 10, f"h{k}{i}", None, 2, None, b, None, None, None)]
    for first, second in ((1, 3), (3, 1)):
        rows = [*history, (50, P, None, None, None, first, None, None, "good"), (51, Q, None, None, None, second, None, None, "good")]
        assert survive(spark, [(1, P), (1, Q)], rows)[1][1] == 3
    # a value the learned order knows nothing of does not go before a known latest one, trust goes before all
    rows = [*history, (50, P, None, None, None, 3, None, None, "bad"), (51, Q, None, None, None, 1, None, None, "good")]
    assert survive(spark, [(1, P), (1, Q)], rows)[1][1] == 1


def test_transitions_within_and_between_days(spark):
    at = lambda d, h: dt.datetime(2024, 1, d, h, tzinfo=UTC)
    steps = [(at(1, 1), 5), (at(1, 7), 6), (at(1, 9), 6), (at(3, 0), 7), (at(3, 5), 8), (at(9, 1), 9)]
    rows = spark.createDataFrame([("a", t, v, None, None, None) for t, v in steps], "id string, updated_at timestamp, height bigint, width bigint, weight bigint, size bigint")
    assert {tuple(r)[1:3] for r in survivors.learn_precedence(rows).collect()} == {(5, 6), (6, 7), (7, 8), (8, 9)}


def test_order_of_values_breaks_cycles_at_the_weakest_votes():
    level = survivors.order_values([(1, 2, 5), (2, 3, 4), (3, 1, 1)])
    assert level[1] < level[2] < level[3]
    # what leads into a cycle comes before it, however weak its votes
    level = survivors.order_values([(9, 1, 1), (1, 2, 5), (2, 3, 4), (3, 1, 2), (3, 8, 1)])
    assert level[9] < level[1] < level[2] < level[3] < level[8]
    assert survivors.order_values([]) == {}
    level = survivors.order_values([(i, i + 1, 1) for i in range(20_000)])
    assert level[20_000] == 20_000


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.tuples(st.integers(0, 7), st.integers(0, 7)).filter(lambda p: p[0] != p[1]), st.integers(1, 4), max_size=16))
def test_order_of_values_against_closure(votes):
    level = survivors.order_values([(a, b, n) for (a, b), n in votes.items()])
    reach = set(votes)
    for k, a, b in itertools.product(range(8), repeat=3):
        if (a, k) in reach and (k, b) in reach:
            reach.add((a, b))
    for a, b in votes:
        if (b, a) not in reach:  # on no cycle
            assert level[a] < level[b]


def test_wide_baskets_and_large_weights(spark):
    wide = spark.range(1).select(F.transform(F.sequence(F.lit(1000), F.lit(1699)), lambda x: x.cast("string")).alias("items"), F.lit(4_000_000_000).alias("weight"))
    rows = cooccurrence.pair_statistics(wide.unionByName(wide.select(F.slice("items", 1, 2).alias("items"), F.lit(6_000_000_000).alias("weight"))))
    assert rows.count() == 700 * 699 // 2 and rows.select("tag_a", "tag_b").distinct().count() == 700 * 699 // 2
    assert rows.where("tag_a >= tag_b").count() == 0
    row = rows.where("tag_a = '1000' and tag_b = '1001'").first()
    assert (row["n_ab"], row["n_a"], row["n"], row["lift"]) == (10**10, 10**10, 10**10, 1.0)
    assert cooccurrence.frequent_pairs(rows, least_lift=1).count() == 700 * 699 // 2
