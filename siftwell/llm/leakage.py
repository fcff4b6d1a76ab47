"""Evaluation texts inside a corpus: one Aho-Corasick automaton, one scan of each whole text.

Texts are reduced to their letters and digits with a map to the original offsets. A run of ``run`` words of
an item, begin where it may, holds one of its aligned blocks of half as many, so the automaton holds the
aligned blocks only; each hit is widened word by word to the longest run around it. In scripts written
without spaces every character is a unit of its own that counts as half a word.
"""

from __future__ import annotations

import html
import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters that compatibility decomposition leaves whole (fixed values).
_WHOLE_LETTERS = {"œ": "oe", "æ": "ae", "ø": "o", "ł": "l", "đ": "d", "ı": "i"}
_OVERRIDE = re.compile("‮([^‬\n]*)(?=‬|\n|$)")
_MARKUP = re.compile(r"</?[A-Za-z][^<>]*+>|\[\^?\d++\]|&(?:#\d++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);")
_LINK = re.compile(r"\]\(|[()]|\s+(?:\"[^\"\n]*+\"|'[^'\n]*+')\s*+(?=\))|\s")
#: Blocks of characters of scripts that are written without spaces (fixed values, Unicode).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_PIECES = re.compile(f"{_UNSPACED.pattern}|[^{_UNSPACED.pattern[1:-1]}]+")


def _fold(char: str) -> str:
    folded = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", char).casefold())
    return "".join(_WHOLE_LETTERS.get(c, c) for c in folded if c.isalnum())


class Folder:
    """Reduction of texts to folded letters and digits, with offsets; code points are folded once each."""

    def __init__(self) -> None:
        self.length = np.full(0x110000, -1, np.int16)
        self.first = np.zeros(0x110000, np.uint32)
        self.longer: dict[int, str] = {}

    def _learn(self, codes: np.ndarray) -> None:
        for code in np.unique(codes[self.length[codes] < 0]).tolist():
            out = "" if 0xD800 <= code <= 0xDFFF else _fold(chr(code))
            self.length[code] = len(out)
            if out:
                self.first[code] = ord(out[0])
            if len(out) > 1:
                self.longer[code] = out

    def reduce(self, text: str) -> tuple[str, np.ndarray]:
        """(reduced text, original offset of each of its characters)."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self._learn(codes)
        lengths = self.length[codes]
        if lengths.max(initial=0) <= 1:
            at = np.flatnonzero(lengths)
            return self.first[codes[at]].astype("<u4").tobytes().decode("utf-32-le"), at
        at = np.repeat(np.arange(len(codes)), lengths)
        chars = self.first[codes[at]]
        begin = np.cumsum(lengths) - lengths
        for i in np.flatnonzero(lengths > 1).tolist():
            out = self.longer[int(codes[i])]
            chars[begin[i] : begin[i] + len(out)] = [ord(c) for c in out]
        return chars.astype("<u4").tobytes().decode("utf-32-le"), at


def _blank(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for start, end in spans:
        out += [text[at:start], "\0" * (end - start)]
        at = end
    return "".join([*out, text[at:]])


def _comments(text: str) -> list[tuple[int, int]]:
    spans, at = [], text.find("<!--")
    while at >= 0:
        end = text.find("-->", at + 4)
        if end < 0:
            break
        spans.append((at, end + 3))
        at = text.find("<!--", end + 3)
    return spans


def _link_targets(text: str) -> list[tuple[int, int]]:
    """Targets in brackets behind a closing square bracket, of any length, with a title and brackets of their own."""
    spans: list[tuple[int, int]] = []
    open_: list[tuple[int, bool]] = []
    for m in _LINK.finditer(text):
        held = m.group()
        if held == "](":
            open_.append((m.start() + 1, True))
        elif held == "(":
            open_.append((m.start(), False))
        elif held == ")":
            start, target = open_.pop() if open_ else (0, False)
            if target:
                while spans and spans[-1][0] > start:
                    spans.pop()
                spans.append((start, m.end()))
        elif len(held) == 1 or held.isspace():
            open_.clear()  # a target has no blanks
    return spans


def _character(m: re.Match) -> str:
    held = m.group()
    if held[0] != "&":
        return "\0" * len(held)
    if held[1] == "#":
        digits = held[2:-1].lstrip("xX0")
        kind = "x" if held[2] in "xX" else ""
        char = "\0" if len(digits) > 7 else html.unescape(f"&#{kind}{digits or 0};")
    else:
        char = html.unescape(held)
    return char + "\0" * (len(held) - len(char)) if char != held and len(char) <= len(held) else held


def unmark(text: str) -> str:
    """The text without mark-up at the same length, so that offsets stay.

    Tags, comments, link targets and note marks of any length turn into blanks, entities into their character
    and blanks, and right-to-left overrides into the order in which they are read. The work is linear in the text.
    """
    if "\u202e" in text:
        text = _OVERRIDE.sub(lambda m: "\u202e" + m.group(1)[::-1], text)
    if "<!--" in text:
        text = _blank(text, _comments(text))
    if "](" in text:
        text = _blank(text, _link_targets(text))
    if "&amp;" in text:  # an escaped entity hides another one
        text = re.sub(r"&(?:amp;)++(?=#?\w++;)", lambda m: "\0" * (len(m.group()) - 1) + "&", text)
    return _MARKUP.sub(_character, text)


def _units(text: str, folder: Folder) -> list[str]:
    """Reduced words of a text; characters of scripts without spaces each for itself."""
    found: list[str] = []
    for word in unmark(text).split():
        reduced = folder.reduce(word)[0]
        if reduced:
            found += _PIECES.findall(reduced) if not reduced.isascii() else [reduced]
    return found


def _weight(unit: str) -> int:
    """Half words that a unit counts as."""
    return 1 if _UNSPACED.match(unit) else 2


class ItemIndex:
    """Units of the items and the automaton over their aligned blocks."""

    def __init__(self, items: list[tuple[int, str]], run: int):
        import ahocorasick

        self.run, self.folder = run, Folder()
        self.words: list[tuple[int, list[str], list[int]]] = []
        blocks: dict[str, list[tuple[int, int, int]]] = {}
        for item_id, text in items:
            words = _units(text or "", self.folder)
            upto = [0]  # half words before each unit
            for word in words:
                upto.append(upto[-1] + _weight(word))
            if upto[-1] < 2 * run:
                continue
            number = len(self.words)
            self.words.append((item_id, words, upto))
            k = 0
            for j in range(1, len(words) + 1):
                # a block is at most half a run long (a unit at least), so that a run reaches over a whole one
                if j == len(words) or upto[j + 1] - upto[k] > max(run, 2):
                    blocks.setdefault("".join(words[k:j]), []).append((number, k, j))
                    k = j
        self.automaton = ahocorasick.Automaton()
        for block, places in blocks.items():
            self.automaton.add_word(block, (len(block), places))
        self.empty = not blocks
        if not self.empty:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        """item_id -> (words, start, end) of the longest run of at least ``run`` words, in original offsets."""
        best: dict[int, tuple[int, int, int]] = {}
        if not text or self.empty:
            return best
        reduced, at = self.folder.reduce(unmark(text))
        seen: set[tuple[int, int, int]] = set()
        for last, (length, places) in self.automaton.iter(reduced):
            for number, k, j in places:
                item_id, words, upto = self.words[number]
                left, right, i = last - length + 1, last + 1, k
                if (number, k, left) in seen:
                    continue
                seen.add((number, k, left))
                while i > 0 and reduced.endswith(words[i - 1], 0, left):
                    left -= len(words[i - 1])
                    i -= 1
                while j < len(words) and reduced.startswith(words[j], right):
                    right += len(words[j])
                    j += 1
                if not _free(reduced, at, left):
                    left, i = left + len(words[i]), i + 1
                if not _free(reduced, at, right):
                    j -= 1
                    right -= len(words[j])
                held = (upto[j] - upto[i]) // 2 if j > i else 0
                if held >= self.run and (item_id not in best or best[item_id][0] < held):
                    best[item_id] = (held, int(at[left]), int(at[right - 1]) + 1)
        return best


def _free(reduced: str, at: np.ndarray, i: int) -> bool:
    """Whether a word can begin at the i-th reduced character.

    Something lies between it and the one before, or one of them is of a script without spaces.
    """
    return i <= 0 or i >= len(at) or at[i] - at[i - 1] > 1 or bool(_UNSPACED.match(reduced[i - 1]) or _UNSPACED.match(reduced[i]))


#: The index last used by this worker process, by the name of its items.
_held: dict[str, ItemIndex] = {}


def _index_of(name: str, items: list[tuple[int, str]], run: int) -> ItemIndex:
    if name not in _held:
        _held.clear()
        _held[name] = ItemIndex(items, run)
    return _held[name]


def leaked_items(documents: DataFrame, items: DataFrame, run: int = 12, part_bytes: int = 32 << 20) -> DataFrame:
    """(doc_id, item_id, words, start, end) of documents holding ``run`` consecutive words of an item.

    Letter case, accents, punctuation, spacing, mark-up, entities, invisible characters and
    compatibility forms make no difference. Words are what white space separates; a character of a script
    without spaces (Han, kana, Thai, Lao, Khmer, Burmese) counts as half a word. Items of fewer words than
    ``run`` cannot hold such a run. Items that together have more than about ``part_bytes`` of text are split into parts by a
    hash, each with an automaton and a scan of its own, so what a task holds is bounded and none is left
    out. NULL and empty texts hold nothing; a document that is given twice is scanned twice.
    """
    spark = documents.sparkSession
    known = items.where("text is not null").select("item_id", "text").distinct()
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    texts = documents.select("doc_id", "text").where("text is not null and text <> ''")
    schema = "doc_id bigint, item_id bigint, words int, start int, end int"
    out = None
    for p in range(parts):
        own = known if parts == 1 else known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p)
        shared = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own.collect()])
        found = texts.mapInPandas(_scan(shared, run), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _scan(shared, run: int):
    name = uuid.uuid4().hex

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _index_of(name, shared.value, run)
        for frame in batches:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                rows += [(doc_id, item, *hit) for item, hit in index.find(text).items()]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "words", "start", "end"])

    return scan
