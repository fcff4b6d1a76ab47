import random

import pytest
from pyspark.sql import functions as F

from siftwell.llm.matches import match_groups


def expected(pairs):
    near = {}
    for a, b in pairs:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out, seen = {}, set()
    for start in near:
        if start in seen:
            continue
        stack, part = [start], []
        seen.add(start)
        while stack:
            x = stack.pop()
            part.append(x)
            for y in near[x] - seen:
                seen.add(y)
                stack.append(y)
        out.update(dict.fromkeys(part, min(part)))
    return out


def grouped(spark, pairs, kind="bigint"):
    df = spark.createDataFrame([(*p, "x") for p in pairs], f"a {kind}, b {kind}, id string")
    return {r["id"]: r["group_id"] for r in match_groups(df, "a", "b").collect()}


SHAPES = {
    "chain": [(i, i + 1) for i in range(40)],
    "cycle": [(i, (i + 1) % 17) for i in range(17)],
    "triangle": [(1, 2), (2, 3), (3, 1)],
    "star": [(0, i) for i in range(1, 60)],
    "core": [(i, j) for i in range(6) for j in range(i)] + [(5, 10), (10, 11), (11, 0), (20, 21)],
    "two_cores": [(i, j) for i in range(5) for j in range(i)] + [(i, j) for i in range(50, 55) for j in range(50, i)] + [(4, 60), (60, 61), (61, 50)],
    "odd": [(1, 1), (None, 2), (3, None), (4, 5), (5, 4), (4, 5)],
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes(spark, name):
    assert grouped(spark, SHAPES[name]) == expected(SHAPES[name])


@pytest.mark.parametrize("seed", range(3))
def test_random(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(150), rng.randrange(150)) for _ in range((90, 160, 320)[seed])]
    assert grouped(spark, pairs) == expected(pairs)


def test_text_ids(spark):
    assert grouped(spark, [("b", "a"), ("b", "c"), ("z", "y")], "string") == {"a": "a", "b": "a", "c": "a", "y": "y", "z": "y"}


def test_empty(spark):
    assert grouped(spark, []) == {} and grouped(spark, [(1, 1)]) == {}


def test_hub_of_a_third_of_all_rows(spark):
    pairs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") * 10).alias("a"), (F.col("id") * 10 + 1).alias("b"))
    rows = match_groups(pairs, "a", "b").groupBy("group_id").count().collect()
    sizes = sorted(r["count"] for r in rows)
    assert sizes[-1] == 1001 and sizes[:-1] == [2] * 2000
