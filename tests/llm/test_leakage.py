import random

import pytest

from siftwell.llm.leakage import Folder, ItemIndex, leaked_items, unmark

ITEM = "Supposé le dépôt Zogi garde 66995 vecteurs et que l'index en retire la moitié. Quel membre du groupe reste si les tailles sont 3080 et 82616 ?"
WORDS = ITEM.split()


def index(run=12):
    return ItemIndex([(7, ITEM)], run)


@pytest.mark.parametrize(
    "dress",
    [
        lambda t: t.upper(),
        lambda t: t.replace(" ", "\n> "),
        lambda t: t.replace("é", "e").replace("ô", "o"),
        lambda t: t.replace("é", "é"),
        lambda t: t.replace("garde", "gar-\nde").replace("vecteurs", "vec­teurs"),
        lambda t: "<p>" + t.replace("garde", "<b class=\"x\">garde</b>") + "</p>",
        lambda t: t.replace("é", "&eacute;").replace("'", "&#39;").replace(" ", "&nbsp;"),
        lambda t: t.replace("é", "&amp;eacute;"),
        lambda t: t.replace("garde", "**garde**").replace("groupe", "[groupe](http://a.example/b_c)"),
        lambda t: t.replace("garde", "garde[12]"),
        lambda t: "​".join(t),
        lambda t: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in t),
        lambda t: t.replace("fi", "ﬁ").replace("...", "…"),
        lambda t: t.replace(" ", "   \t"),
        lambda t: t.replace("garde", "‮edrag‬"),
    ],
)
def test_typesetting_makes_no_difference(dress):
    text = "Avant tout. " + dress(ITEM) + " Après tout."
    words, start, end = index().find(text)[7]
    assert words == len([w for w in WORDS if w != "?"])
    assert text[:start].endswith(("Avant tout. ", ">")) or start <= len("Avant tout. ") + 2


def test_run_length_is_exact():
    part = lambda i, n: "x " + " ".join(WORDS[i : i + n]) + " y"
    for start in range(0, 10):
        assert 7 in index().find(part(start, 12)), start
        assert 7 not in index().find(part(start, 11)), start


def test_parts_of_words_do_not_count():
    words = WORDS[:12]
    assert 7 not in index().find("re" + " ".join(words))
    assert 7 not in index().find(" ".join(words) + "s")
    assert 7 in index().find("re-" + " ".join(words) + "-s")


def test_a_missing_or_changed_word_breaks_the_run():
    words = WORDS[:20]
    assert 7 not in index().find(" ".join(words[:8] + words[9:]))
    assert 7 not in index().find(" ".join([*words[:9], "autre", *words[10:19]]))


def test_offsets():
    text = "ﬁrst " + ITEM
    words, start, end = index().find(text)[7]
    assert text[start:end] == ITEM[:-2]


def test_against_brute_force():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(k, " ".join(rng.choices(vocabulary, k=30))) for k in range(20)]
    held = ItemIndex(items, 6)
    folder = Folder()
    for _ in range(60):
        words = rng.choices(vocabulary, k=25)
        if rng.random() < 0.7:
            k, i, n = rng.randrange(20), rng.randrange(20), rng.randint(4, 9)
            words[5:5] = items[k][1].split()[i : i + n]
        text = " ".join(words)
        want = set()
        for k, item in items:
            w = item.split()
            if any(f" {' '.join(w[i : i + 6])} " in f" {text} " for i in range(len(w) - 5)):
                want.add(k)
        assert set(held.find(text)) == want
    assert folder.reduce("")[0] == ""


def test_unmark_keeps_offsets():
    text = "a &amp;lt; b <i>c</i> [d](e) &#x41; &nosuch; &"
    assert len(unmark(text)) == len(text)


def test_tables(spark):
    documents = spark.createDataFrame(
        [(1, "x " + ITEM, "a"), (2, "", "b"), (3, None, "c"), (4, "y" * 200_000 + " " + ITEM, "d"), (1, ITEM, "e"), (5, " ".join(WORDS[:11]), "f")],
        "doc_id bigint, text string, item_id string",
    )
    items = spark.createDataFrame([(7, ITEM, "s"), (8, "too short", "s"), (9, None, "s"), (7, ITEM, "s")], "item_id bigint, text string, suite string")
    got = sorted((r["doc_id"], r["item_id"]) for r in leaked_items(documents, items).collect())
    assert got == [(1, 7), (1, 7), (4, 7)]
    assert leaked_items(documents, items.limit(0)).count() == 0 and leaked_items(documents.limit(0), items).count() == 0
    more = items.unionByName(spark.createDataFrame([(10, ITEM + " encore", "s"), (11, ITEM.upper(), "s")], items.schema))
    whole, parts = (sorted(map(tuple, leaked_items(documents, more, part_bytes=n).collect())) for n in (1 << 20, 100))
    assert whole == parts and {r[1] for r in whole} == {7, 10, 11}


@pytest.mark.parametrize("length", [250, 310, 5000, 300_000])
def test_mark_up_of_any_length(length):
    for mark in ("<a href=\"%s\">", "<!-- %s -->", "[x](%s)", "[x](%s \"a title\")", "[x](a_(%s)_b)"):
        text = " ".join(WORDS[:7]) + " " + (mark % ("y" * length)).replace("[x]", "[" + WORDS[7] + "]") + " " + " ".join(WORDS[8 if "[x]" in mark else 7 : 14])
        assert index().find(text)[7][0] >= 13, (mark, length)
    assert 7 in index().find(" ".join(WORDS[:6]) + "[" + "1" * length + "] " + " ".join(WORDS[6:13]))
    assert 7 in index().find(ITEM.replace("é", "&#" + "0" * length + "233;").replace("garde", "garde&#" + "9" * length + ";"))


@pytest.mark.parametrize("piece", ["<a ", "<!-- ", "](", "[x](a ", "&amp;", "&#1", "a(b(", "[1", "\u202e"])
def test_broken_mark_up_takes_linear_time(piece):
    text = piece * 100_000 + " " + ITEM
    assert len(unmark(text)) == len(text)
    assert index().find(piece * 100_000) == {}


JA = "この絵では重複の隣で座っている猫が古い索引を灰色の縮小画像の組に移した。"


def test_scripts_without_spaces():
    held = ItemIndex([(1, JA), (2, "短い文"), (3, "GIF版の" + JA[:30] + " and some words")], 12)
    assert held.find("前置き" + JA[3:27] + "後書き")[1][0] == 12  # 24 characters are twelve words
    assert 1 not in held.find("前置き" + JA[3:26] + "後書き")
    assert 1 in held.find("前\n".join(["x", JA[4:16] + "\n" + JA[16:29]]))
    text = "x。" + JA
    words, start, end = held.find(text)[1]
    assert text[start:end] == JA[:-1]
    assert 3 in held.find("gif版の" + JA[:30] + "and")
