"""Every query with reference SQL gives the same rows on the smallest tables."""

import pytest

import __spark_entry__ as entry
from siftwell.plans import curation, integrity
from tests.against_sql import compare, connect

QUERIES = {**curation.QUERIES, **integrity.QUERIES}
ORACLES = {**curation.ORACLES, **integrity.ORACLES}
#: What queries without SQL return: the columns and, in SQL, the number of rows.
SHAPES = {
    "hdbscan": ("vec_id cluster_id", "SELECT count(*) FROM embeddings"),
    "optics_sample": ("vec_id position reachability cluster_id", "SELECT count(*) FILTER (WHERE label = 3) + least(200, count(*) FILTER (WHERE label <> 3)) FROM embeddings"),
    "optics_neighbours": ("vec_id position reachability cluster_id", None),
    "pacmap_embedding": ("vec_id step vec", "SELECT 9 * count(*) FROM embeddings"),
}


@pytest.fixture(scope="module")
def duck(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, tiny, name):
    compare(QUERIES[name](spark, tiny), duck, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_shape(spark, duck, tiny, name):
    columns, rows = SHAPES[name]
    df = QUERIES[name](spark, tiny)
    got = df.collect()
    assert df.columns == columns.split() and got
    if rows:
        assert len(got) == duck.execute(rows).fetchone()[0]
    if name.startswith("optics"):
        assert sorted(r["position"] for r in got) == list(range(len(got)))
        assert len({r["vec_id"] for r in got}) == len(got)
    if name == "pacmap_embedding":
        assert all(len(r["vec"]) == 10 for r in got) and {r["step"] for r in got} == {None, *range(100, 900, 100)}
    if name == "hdbscan":
        assert all(r["cluster_id"] is None or r["cluster_id"] <= r["vec_id"] for r in got)


def test_optics_takes_every_neighbour(spark, tiny):
    points = {r["vec_id"] for r in QUERIES["optics_neighbours"](spark, tiny).collect()}
    assert points == {r["neighbor_id"] for r in QUERIES["knn_neighbour_set"](spark, tiny).collect()}


def test_animations_are_spread_over_tasks(spark):
    """Their ids are few bytes, the work is not: so many rows make a task."""
    rows = spark.range(90).selectExpr("1L as cluster_id", "lpad(hex(id * 2), 2, '0') as id", "'gif_triage' as action")
    gifs = curation._point_gifs(rows.union(rows), 3)
    assert gifs.rdd.getNumPartitions() == 3 and gifs.count() == 90


@pytest.mark.parametrize("name", ["settled_gifs", "points_after_transfer", "tag_transfer"])
def test_queries_spread_their_animations(spark, monkeypatch, tiny, name):
    seen = []
    made = curation._point_gifs
    monkeypatch.setattr(curation, "_GIFS_A_TASK", 2)
    monkeypatch.setattr(curation, "_point_gifs", lambda triaged, tasks: seen.append((triaged.where("action = 'gif_triage'").count(), tasks)) or made(triaged, tasks))
    QUERIES[name](spark, tiny)
    assert seen[0][0] > 2 and seen[0][1] == -(-seen[0][0] // 2)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_entry_does_without_the_subpackage(monkeypatch):
    import importlib

    whole = importlib.import_module

    def broken(name, *rest):
        if name.startswith("siftwell.llm"):
            raise ImportError(name)
        return whole(name, *rest)

    monkeypatch.setattr(importlib, "import_module", broken)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)
