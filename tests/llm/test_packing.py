import os
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftwell.llm import packing

TOKENIZERS = os.path.dirname(packing.TOKENIZER_PATH)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=12))
def test_plan_uses_everything_and_fits(histogram):
    used, bins = Counter(), 0
    for p in packing.plan_patterns(histogram, 50):
        assert sum(length * k for length, k in p.lengths.items()) <= 50
        bins += p.times
        for length, k in p.lengths.items():
            used[length] += k * p.times
    assert used == Counter(histogram)
    total = sum(length * n for length, n in histogram.items())
    assert bins <= max(2 * -(-total // 50), 1) if histogram else bins == 0


def test_exact_complements():
    import numpy as np

    counts = np.zeros(20, np.int64)
    counts[[3, 4, 5]] = [2, 1, 1]
    index = packing.ExactComplement(counts)
    assert index.find(4) == [4]
    assert sorted(index.find(6)) == [3, 3] and sorted(index.find(9)) == [4, 5]
    assert sorted(index.find(11)) == [3, 3, 5] and index.find(15) is None
    counts[3] = 1
    assert index.find(6) is None and counts.tolist()[3:6] == [1, 1, 1]


def test_complements_close_gaps():
    assert [p.times for p in packing.plan_patterns({6: 3, 4: 3}, 10)] == [3]
    assert sum(p.times for p in packing.plan_patterns({7: 1, 2: 1, 1: 1, 5: 1, 3: 1, 10: 1}, 10)) == 3


def test_too_long_for_the_plan():
    with pytest.raises(ValueError):
        packing.plan_patterns({11: 1}, 10)


def packed(spark, lengths, capacity):
    rows = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "doc_id bigint, tokens bigint, size string")
    return packing.pack(rows, capacity).collect()


@pytest.mark.parametrize("seed", range(3))
def test_pack_round_trip(spark, seed):
    rng = random.Random(seed)
    capacity = 64
    lengths = [rng.choice([0, 3, rng.randint(1, 64), rng.randint(1, 200), 64, 128]) for _ in range(500)]
    fill, pieces = defaultdict(int), defaultdict(list)
    for r in packed(spark, lengths, capacity):
        fill[r["container_no"]] += r["size"]
        pieces[r["doc_id"]].append((r["piece_no"], r["size"]))
    assert max(fill.values()) <= capacity and set(fill) == set(range(len(fill)))
    for i, n in enumerate(lengths):
        parts = sorted(pieces[i])
        assert [p for p, _ in parts] == list(range(len(parts))) and sum(s for _, s in parts) == n
        assert n > capacity or len(parts) == 1
        assert all(s == capacity for _, s in parts[:-1])
    assert len(fill) <= 1.02 * sum(lengths) / capacity + 1


def test_pack_edges(spark):
    assert packed(spark, [], 10) == []
    assert [(r["container_no"], r["size"]) for r in packed(spark, [0, 0], 10)] == [(0, 0), (0, 0)]
    assert sorted((r["container_no"], r["piece_no"], r["size"]) for r in packed(spark, [20], 10)) == [(0, 0, 10), (1, 1, 10)]


def test_one_length_for_a_third_of_all_rows(spark):
    lengths = [7 if i % 3 == 0 else 1 + i % 11 for i in range(6000)]
    fill = Counter()
    for r in packed(spark, lengths, 32):
        fill[r["container_no"]] += r["size"]
    assert max(fill.values()) <= 32 and len(fill) <= 1.01 * sum(lengths) / 32 + 1


def test_documents(spark):
    texts = [(1, "Some words, and more."), (2, ""), (3, None), (4, "word " * 3000)]
    documents = spark.createDataFrame([(*t, 9, "c") for t in texts], "doc_id bigint, text string, tokens int, capacity string")
    specs = spark.createDataFrame([(1, 16), (2, 4096), (3, 0), (1, 16)], "spec_id int, capacity bigint")
    rows = packing.pack_documents(documents, specs).collect()
    assert {r["spec_id"] for r in rows} == {1, 2} and {r["doc_id"] for r in rows} == {1, 2, 3, 4}
    report = {r["spec_id"]: r for r in packing.fill_report(packing.pack_documents(documents, specs)).collect()}
    assert report[1]["fullest"] == 16 and report[2]["containers"] == report[2]["least_containers"]
    assert packing.pack_documents(documents, specs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_tokenizers(name):
    count = packing.load_counter(f"{TOKENIZERS}/{name}")
    got = count(["", "Two words", "<|endoftext|>", "größe 猫"])
    assert got[0] == 0 and got[1] >= 2 and got[2] >= 1 and got[3] >= 2


def test_same_vocabulary_in_two_formats():
    a, b = (packing.load_counter(f"{TOKENIZERS}/byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
    texts = ["It's 12 cats,  and\n\nmore …", "größe 猫猫 🙂", "x" * 300]
    assert a(texts) == b(texts)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=10), st.lists(st.integers(1, 70), max_size=12))
def test_complements_against_brute_force(histogram, gaps):
    import itertools

    import numpy as np

    counts = np.zeros(71, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    index = packing.ExactComplement(counts)
    for gap in gaps:
        pieces = [x for x in range(71) for _ in range(counts[x])]
        fewest = next((k for k in (1, 2, 3) if any(sum(c) == gap for c in itertools.combinations(pieces, k))), None)
        found = index.find(gap)
        assert (found is None) == (fewest is None)
        if found:
            assert len(found) == fewest and sum(found) == gap and not Counter(found) - Counter(pieces)
            for x in found:
                counts[x] -= 1
