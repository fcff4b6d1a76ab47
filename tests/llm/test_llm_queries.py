"""The queries of the subpackage: against SQL where there is some, else against brute force or what must hold."""

import numpy as np
import pytest

from siftwell.llm import queries
from siftwell.runtime import read_table
from tests.against_sql import compare, connect


@pytest.fixture(scope="module")
def duck(tiny):
    return connect(tiny)


@pytest.fixture(scope="module")
def unit(spark, tiny):
    """(ids in the order of arrival, unit vectors)"""
    rows = read_table(spark, tiny, "point_metadata").select("idx", "id", "text_info").collect()
    held = {}
    for r in sorted(rows, key=lambda r: r["idx"]):
        v = r["text_info"] and r["text_info"]["text_vector"]
        if v and len(v) == 64 and None not in v and np.isfinite(v).all() and any(v):
            held.setdefault(r["id"], np.array(v) / np.linalg.norm(v))
    return list(held), np.array(list(held.values()))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, duck, tiny, name):
    compare(queries.QUERIES[name](spark, tiny), duck, queries.ORACLES[name])


def test_p2_found(spark, tiny, unit):
    ids, x = unit
    s = x @ x.T
    np.fill_diagonal(s, -2)
    want = {tuple(sorted((ids[i], ids[j]))) for i in range(len(ids)) for j in np.lexsort((ids, -s[i].round(12)))[:10]}
    assert {tuple(r) for r in queries.p2_found(spark, tiny).collect()} == want


def test_p4_found(spark, duck, tiny, unit):
    ids, x = unit
    accepted, cases = [], set()
    for i in range(len(ids)):
        if accepted and (x[accepted] @ x[i]).max() > 0.9:
            cases.add(ids[i])
        else:
            accepted.append(i)
    got = queries.p4_found(spark, tiny).collect()
    assert {r["rec_key"] for r in got if r["rec_table"] == "point_metadata"} == cases
    rows = {r["row_id"] for r in read_table(spark, tiny, "wrong_ext").where("path is not null").collect()}
    assert {int(r["rec_key"]) for r in got if r["rec_table"] == "wrong_ext"} < rows


def test_p7_method(spark, tiny):
    found, method = ({r["cluster_id"]: r for r in queries.QUERIES[n](spark, tiny).collect()} for n in ("p7_found", "p7_method"))
    assert found.keys() == method.keys()
    for c, r in method.items():
        assert (r["keep_id"], r["categories"]) == (found[c]["keep_id"], found[c]["categories"])
        assert all((r[f] == -1) == (found[c][f] == -1) for f in ("height", "width", "size"))


def test_p8(spark, tiny):
    packed = queries.p8_packing(spark, tiny).toPandas()
    documents = read_table(spark, tiny, "documents").count()
    for (_, capacity), part in packed.groupby(["spec_id", "capacity"]):
        assert part["doc_id"].nunique() == documents
        assert part.groupby("container_no")["size"].sum().max() <= capacity
    report = queries.p8_fill(spark, tiny).toPandas()
    assert (report["containers"] - report["least_containers"]).max() <= 1


def test_p9(spark, tiny):
    found = {tuple(r) for r in queries.p9_found(spark, tiny).collect()}
    passages = queries.p9_passages(spark, tiny).collect()
    assert found == {(r["doc_id"], r["item_id"]) for r in passages} and all(r["words"] >= 12 and r["start"] < r["end"] for r in passages)


def test_p10(spark, tiny):
    documents = queries.p10_documents(spark, tiny).collect()
    wrong = {(r["doc_id"], x) for r in documents if r["label"] != r["langs"] for x in r["langs"]}
    assert {tuple(r) for r in queries.p10_found(spark, tiny).collect()} == wrong
    assert len(documents) == read_table(spark, tiny, "documents").count()
    segments = queries.p10_segments(spark, tiny).collect()
    assert {(r["doc_id"], r["lang"]) for r in segments if r["counted"]} == {(r["doc_id"], x) for r in documents for x in r["langs"]}
