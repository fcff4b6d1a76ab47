"""Language of documents and of their segments by error-correcting output codes.

Every language has a codeword; one binary character-n-gram classifier per bit tells on which side of
the bit a sentence lies, and the codeword with the least weighted loss over all bits names the language.
The losses of all codewords give a confidence, calibrated on held-out sentences and pieces of them, so
that a few words are trusted as far as they go, and flag what is ambiguous. The classifiers are fitted on
a bounded sample of labelled documents; everything else runs over all rows and whole texts.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.vectors import hashed_sample

LANGUAGES = ("en", "de", "nl", "sv", "fr", "es", "pt", "it", "ru", "ja")

#: Other names of the languages (fixed values: ISO 639 codes and English names).
NAMES = {
    "eng": "en", "english": "en",
    "deu": "de", "ger": "de", "german": "de",
    "nld": "nl", "dut": "nl", "dutch": "nl",
    "swe": "sv", "swedish": "sv",
    "fra": "fr", "fre": "fr", "french": "fr",
    "spa": "es", "spanish": "es",
    "por": "pt", "portuguese": "pt",
    "ita": "it", "italian": "it",
    "rus": "ru", "russian": "ru",
    "jpn": "ja", "japanese": "ja",
}

#: Latin spellings of letters, as in transliterated texts (fixed values).
_LATIN = str.maketrans({
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "zh", "з": "z", "и": "i", "й": "y",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": " ", "э": "e", "ю": "yu", "я": "ya",
    "ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "å": "aa",
})

_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")

#: Confidence from which a sentence says its language by itself.
LEAST_SURE = 0.9

_ORDERS = (1, 2, 3, 4)
_BLANK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
_NOT_PROSE = re.compile(r"^\s*(?:[\[(]?\d{1,2}:\d{2}(?::\d{2})?\b|\d{4}-\d{2}-\d{2}[T ]|\{.*\}\s*$|[#=]{1,6}(?:\s|\d)|@\w+:?\s*$|</?\w+[^>]*>\s*$)")
_MARKS = re.compile(r"\([^()\s]*[\d_.][^()\s]*\)|\[[^\]\s]*\d[^\]\s]*\]|#\d+|https?://\S+|(?<![^\s(\[\"'])[^\s(\[\"'.]+\.(?:jpe?g|png|gif|webp|bmp|txt|json)\b|</?[A-Za-z!][^<>]*+>|&#?\w++;")
_SENTENCE = re.compile(r"[^.!?。！？…]+(?:[.!?。！？…]+[\"'”»“«）)\]]*|$)")
_LETTERS = re.compile(r"[^\W\d_]+")
_CUT_OFF = re.compile(r"(?:\.\.|…)[\"'”»“«）)\]\s]*$")


def label_languages(label: str | None, languages: tuple[str, ...] = LANGUAGES) -> frozenset[str]:
    """Those of ``languages`` that a label names; region, three-letter code, English name and joins are understood."""
    named = set()
    for part in re.split(r"[+,;/|&\s]+", (label or "").strip().lower()):
        part = re.split(r"[-_]", part)[0]
        part = NAMES.get(part, part)
        if part in languages:
            named.add(part)
    return frozenset(named)


def code_words(n: int) -> np.ndarray:
    """n codewords of +1 and -1 from a Hadamard matrix without its constant column; any two differ in half the bits."""
    h = np.array([[1]])
    while len(h) < n + 1:
        h = np.block([[h, h], [h, -h]])
    words = h[1 : n + 1, 1:]
    return words[:, np.abs(words.sum(0)) < n]


@dataclass
class Segment:
    paragraph: int
    start: int
    end: int
    text: str
    whole: bool  # False for a sentence cut off by an ellipsis


def _readable(text: str) -> str:
    """Words put together again at line breaks, without invisible characters, in compatible letters."""
    text = text.replace("-\n", "")
    if text.isascii():
        return text
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return _INVISIBLE.sub("", text)


def sentences(text: str | None) -> list[Segment]:
    """Sentences with the number of their paragraph and their place in the original text.

    Log lines, headings and speaker tags are skipped; file names, tags, numbers and mark-up are taken
    out of the text that is classified. Sentences without a letter are left out.
    """
    out: list[Segment] = []
    start, number = 0, 0
    text = text or ""
    bounds = [m.span() for m in _BLANK.finditer(text)] + [(len(text), len(text))]
    for stop, following in bounds:
        kept = [" " * len(line) if _NOT_PROSE.match(line) else line for line in text[start:stop].split("\n")]
        body = "\n".join(kept)
        body = _MARKS.sub(lambda m: " " * len(m.group()), body)
        for m in _SENTENCE.finditer(body):
            held = m.group()
            words = _LETTERS.findall(_readable(held))
            if words:
                lead = len(held) - len(held.lstrip())
                whole = held[-1] not in ".…\"'”»“«）)] \n" or not _CUT_OFF.search(held)
                out.append(Segment(number, start + m.start() + lead, start + m.end(), " ".join(words).lower(), whole))
        start, number = following, number + 1
    return out


def _grams(words: list[str], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order: hashed character n-grams of all words, blanks around them, and the rising index of the word each belongs to."""
    joined = "\n".join(f" {w} " for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    owner = np.cumsum(codes == 10)
    gaps = np.concatenate([[0], owner])
    found = []
    value = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(_ORDERS) + 1):
            if len(codes) < n:
                break
            m = len(codes) - n + 1
            value = value[:m] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
            if n in _ORDERS:
                inside = gaps[n:] == gaps[:m]
                mixed = value[inside]
                mixed = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
                found.append(((mixed & np.uint64(buckets - 1)).astype(np.int64), owner[:m][inside]))
    return found


def _distinct_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, number of the word at each place, first place of each text); a text has one word at least."""
    parts = [t.split(" ") for t in texts]
    codes, words = pd.factorize(np.array([w for p in parts for w in p], dtype=object))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return list(words), codes, np.cumsum(lengths) - lengths


def _plain(text: str) -> str:
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _spelled(text: str) -> str:
    return " ".join(text.translate(_LATIN).split())


@dataclass
class CodeModel:
    """Bit classifiers (log ratios per n-gram bucket), their weights, the code, and the calibration of confidences."""

    languages: tuple[str, ...]
    words: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    sharpness: tuple[float, float] = (4.0, 0.5)

    def margins(self, texts: list[str]) -> np.ndarray:
        """Mean log ratio per n-gram and bit; positive means bit +1. Each distinct word is looked up once."""
        if not texts:
            return np.zeros((0, self.ratios.shape[1]), np.float32)
        words, codes, first = _distinct_words(texts)
        sums, counts = np.zeros((len(words), self.ratios.shape[1]), np.float32), np.zeros(len(words), np.float32)
        step = 20_000
        for i in range(0, len(words), step):
            part = words[i : i + step]
            for h, owner in _grams(part, len(self.ratios)):  # owners rise within an order
                begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, int)
                if len(begin):
                    sums[i + owner[begin]] += np.add.reduceat(self.ratios[h], begin, axis=0)
                    counts[i + owner[begin]] += np.diff(np.r_[begin, len(owner)])
        total = np.add.reduceat(sums[codes], first, axis=0)
        return total / np.maximum(np.add.reduceat(counts[codes], first), 1)[:, None]

    def _odds(self, margins: np.ndarray, lengths: np.ndarray, sharpness: tuple[float, float]) -> np.ndarray:
        bits = margins * (sharpness[0] * lengths.astype(np.float32) ** sharpness[1])[:, None]
        loss = np.logaddexp(0, -bits[:, None, :] * self.words[None]) @ self.weights
        odds = np.exp(-(loss - loss.min(1, keepdims=True)))
        return odds / odds.sum(1, keepdims=True)

    def shares(self, texts: list[str]) -> np.ndarray:
        """The confidence in every language for each text; a row sums to 1, the nearest codeword has the most."""
        return self._odds(self.margins(texts), np.array([len(t) for t in texts]), self.sharpness)

    def classify(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest codeword of each text and its confidence in (0, 1]."""
        if not texts:
            return np.zeros(0, int), np.zeros(0)
        shares = self.shares(texts)
        return shares.argmax(1), shares.max(1)

    def calibrate(self, texts: list[str], target: np.ndarray) -> None:
        """Sets the sharpness under which texts that were not counted, and pieces of one to eight words, are likeliest."""
        parts, want = [], []
        for text, t in zip(texts, target):
            words = text.split(" ")
            for n in (1, 2, 4, 8, len(words)):
                if n <= len(words):
                    parts.append(" ".join(words[-n:]))
                    want.append(t)
        if parts:
            margins, lengths, want = self.margins(parts), np.array([len(t) for t in parts]), np.array(want)
            grid = [(a, b) for a in (0.25, 0.5, 1.0, 2.0, 4.0, 8.0) for b in (0.25, 0.5, 0.75, 1.0)]
            miss = [-np.log(np.maximum(self._odds(margins, lengths, g)[np.arange(len(want)), want], 1e-12)).mean() for g in grid]
            self.sharpness = grid[int(np.argmin(miss))]


def fit_codes(
    texts: list[str], labels: list[str], languages: tuple[str, ...] = LANGUAGES, buckets: int = 1 << 17, rounds: int = 3, calibration: int = 1000
) -> CodeModel:
    """Bit classifiers from labelled sentences; wrong labels are weeded out.

    Every round counts the n-grams per language, turns them into log ratios per bit, and for the next
    round keeps the sentences whose language it confirms. Every sentence also counts without its accents and in
    Latin spelling. At most ``calibration`` sentences, spread evenly, are not counted but calibrate the confidences.
    """
    words = code_words(len(languages))
    target = np.array([languages.index(x) for x in labels], int)
    apart = np.zeros(len(texts), bool)
    apart[:: max(5, len(texts) // max(calibration, 1))] = len(texts) > 50
    told, codes, first = _distinct_words([*texts, *map(_plain, texts), *map(_spelled, texts)]) if texts else ([], np.zeros(0, int), np.zeros(0, int))
    owner = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(codes)])) % max(len(texts), 1)
    grams = _grams(told, buckets) if told else []
    keep = np.ones(len(texts), bool)
    model = None
    for _ in range(rounds):
        used = (keep & ~apart)[owner] if texts else np.zeros(0, bool)
        said = np.bincount(codes[used] * len(languages) + target[owner[used]], minlength=len(told) * len(languages)).reshape(-1, len(languages))
        counts = np.zeros((len(languages), buckets))
        for h, word in grams:
            for k in range(len(languages)):
                counts[k] += np.bincount(h, weights=said[word, k], minlength=buckets)
        share = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        floor = 1.0 / max(counts.sum(), 1) * len(languages)
        ratios = np.empty((buckets, words.shape[1]), np.float32)
        for b in range(words.shape[1]):
            plus, minus = share[words[:, b] > 0].mean(0), share[words[:, b] < 0].mean(0)
            ratios[:, b] = np.log((plus + floor) / (minus + floor))
        weights = np.ones(words.shape[1], np.float32)
        model = CodeModel(tuple(languages), words.astype(np.float32), ratios, weights)
        if texts:
            margins = model.margins(texts)
            right = (np.sign(margins) == words[target])[keep]
            accuracy = np.clip(right.mean(0), 0.5, 0.999)
            model.weights = np.log(accuracy / (1 - accuracy)).astype(np.float32)
            model.weights /= max(model.weights.mean(), 1e-6)
            best, sure = model.classify(texts)
            keep = (best == target) & (sure > 0.5)
            if not keep.any():
                break
    held = np.flatnonzero(keep & apart)
    model.calibrate([texts[i] for i in held], target[held])
    return model


def fit_on_documents(
    documents: DataFrame, max_documents: int = 3000, max_sentences: int = 30_000, languages: tuple[str, ...] = LANGUAGES
) -> CodeModel:
    """Fit on at most ``max_documents`` documents whose label names one language, chosen by a hash of doc_id.

    The bounds keep the sample small on the driver whatever the size of the corpus; at most
    ``max_sentences`` sentences are taken, evenly over the documents and within each by a hash of the sentence.
    ``languages`` are those told apart, as two-letter codes.
    """
    single = documents.where("lang is not null and text <> ''").where(~F.col("lang").rlike(r"[+,;/]"))
    sample = hashed_sample(single.select("doc_id", "text", "lang"), "doc_id", max_documents, documents.count())
    per_document = max(1, max_sentences // max(max_documents, 1))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for text, lang in zip(frame["text"], frame["lang"]):
                named = label_languages(lang, languages)
                if len(named) == 1:
                    found = sorted({s.text for s in sentences(text)}, key=lambda t: (zlib.crc32(t.encode()), t))
                    rows += [(t, *named) for t in found[:per_document]]
            yield pd.DataFrame(rows, columns=["text", "lang"])

    drawn = sample.mapInPandas(draw, "text string, lang string").toPandas().sort_values(["lang", "text"])
    return fit_codes(drawn["text"].tolist(), drawn["lang"].tolist(), languages)


@dataclass(frozen=True)
class Run:
    """Sentences of one language that follow each other in a paragraph."""

    paragraph: int
    start: int
    end: int
    language: int
    sentences: int
    sure: int  # whole sentences that say the language by themselves, or 1 for a paragraph that does only as a whole
    letters: int
    confidence: float  # in the language of the run, over the letters of all its sentences


def segment_runs(found: list[Segment], shares: np.ndarray, joint: dict[int, np.ndarray], least_sure: float) -> list[Run]:
    """Runs of one language within a paragraph.

    A sentence whose confidence is below ``least_sure`` takes the language of the nearest sure one before it
    in its paragraph, or else after it. Where none is sure, ``joint`` has the confidences of the paragraph as
    a whole.
    """
    best, sure = shares.argmax(1).tolist(), (shares.max(1) >= least_sure).tolist()
    runs: list[Run] = []
    i = 0
    while i < len(found):
        p = found[i].paragraph
        j = i
        while j < len(found) and found[j].paragraph == p:
            j += 1
        told = next((best[k] for k in range(i, j) if sure[k]), None)
        if told is None:
            told, together = int(joint[p].argmax()), float(joint[p].max()) >= least_sure
        else:
            together = False
        lang = []
        for k in range(i, j):
            told = best[k] if sure[k] else told
            lang.append(told)
        k = i
        while k < j:
            e = k + 1
            while e < j and lang[e - i] == lang[k - i]:
                e += 1
            letters = np.array([len(s.text) for s in found[k:e]])
            share = float((shares[k:e, lang[k - i]] * letters).sum() / letters.sum())
            counted = sum(1 for x in range(k, e) if sure[x] and found[x].whole)
            if together and found[e - 1].whole:
                counted, share = 1, float(joint[p].max())
            runs.append(Run(p, found[k].start, found[e - 1].end, lang[k - i], e - k, counted, int(letters.sum()), share))
            k = e
        i = j
    return runs


def counted_runs(runs: list[Run]) -> list[Run]:
    """The runs that put a language into the text: two or more sure sentences, or a whole paragraph that is sure.

    Sentences cut off by an ellipsis are no whole ones. Where nothing is sure, the longest run counts.
    """
    per: dict[int, int] = {}
    for run in runs:
        per[run.paragraph] = per.get(run.paragraph, 0) + 1
    counted = [run for run in runs if run.sure >= 2 or (run.sure == 1 and per[run.paragraph] == 1)]
    return counted or sorted(runs, key=lambda r: (-r.letters, r.start))[:1]


def _classified(batches: Iterator[pd.DataFrame], model: CodeModel, least_sure: float) -> Iterator[tuple[pd.DataFrame, list[list[Run]]]]:
    for frame in batches:
        found = [sentences(t) for t in frame["text"]]
        shares = model.shares([s.text for doc in found for s in doc])
        unsure = shares.max(1, initial=0) < least_sure
        at, open_, texts = 0, [], []
        for d, doc in enumerate(found):
            if unsure[at : at + len(doc)].any():
                said: dict[int, list[str]] = {}
                known = {s.paragraph for s, u in zip(doc, unsure[at : at + len(doc)].tolist()) if not u}
                for s in doc:
                    if s.paragraph not in known:
                        said.setdefault(s.paragraph, []).append(s.text)
                open_ += [(d, p) for p in said]
                texts += [" ".join(t) for t in said.values()]
            at += len(doc)
        joint: dict[int, dict[int, np.ndarray]] = {}
        for (d, p), share in zip(open_, model.shares(texts)):
            joint.setdefault(d, {})[p] = share
        at, runs = 0, []
        for d, doc in enumerate(found):
            runs.append(segment_runs(doc, shares[at : at + len(doc)], joint.get(d, {}), least_sure))
            at += len(doc)
        yield frame, runs


def language_segments(documents: DataFrame, model: CodeModel, least_sure: float = LEAST_SURE) -> DataFrame:
    """(doc_id, segment_no, start, end, lang, sentences, counted, confidence, ambiguous) for every segment of every text.

    start and end are character offsets into the whole text. ``counted`` tells whether the segment puts
    its language into the text, ``confidence`` is that in the language given, ``ambiguous`` marks one below
    ``least_sure``. NULL and empty texts, and texts without prose, give no row.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    columns = ["doc_id", "segment_no", "start", "end", "lang", "sentences", "counted", "confidence", "ambiguous"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        for frame, runs in _classified(batches, held, least_sure):
            rows = []
            for doc_id, own in zip(frame["doc_id"], runs):
                counted = set(counted_runs(own))
                rows += [
                    (doc_id, k, r.start, r.end, held.languages[r.language], r.sentences, r in counted, round(r.confidence, 4), r.confidence < least_sure)
                    for k, r in enumerate(own)
                ]
            yield pd.DataFrame(rows, columns=columns)

    schema = "doc_id bigint, segment_no int, start int, end int, lang string, sentences int, counted boolean, confidence double, ambiguous boolean"
    return documents.select("doc_id", "text").where("text is not null").mapInPandas(run, schema)


def document_languages(documents: DataFrame, model: CodeModel, least_sure: float = LEAST_SURE) -> DataFrame:
    """(doc_id, label, langs, confidence, ambiguous): the sorted languages in each text next to those its label names.

    ``confidence`` is the least of those of the counted segments, 0 for a text without prose; ``ambiguous``
    tells that one of them is below ``least_sure``.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        for frame, runs in _classified(batches, held, least_sure):
            rows = []
            for doc_id, label, own in zip(frame["doc_id"], frame["lang"], runs):
                counted = counted_runs(own)
                langs = sorted({held.languages[r.language] for r in counted})
                sure = min((r.confidence for r in counted), default=0.0)
                told = sorted(label_languages(label if isinstance(label, str) else None, held.languages))
                rows.append((doc_id, told, langs, round(sure, 4), bool(counted) and sure < least_sure))
            yield pd.DataFrame(rows, columns=["doc_id", "label", "langs", "confidence", "ambiguous"])

    schema = "doc_id bigint, label array<string>, langs array<string>, confidence double, ambiguous boolean"
    return documents.select("doc_id", "text", "lang").mapInPandas(run, schema)


def mislabelled(languages: DataFrame) -> DataFrame:
    """(doc_id, lang): the languages of each document whose label does not name exactly them."""
    return languages.where("label <> langs").select("doc_id", F.explode("langs").alias("lang"))
