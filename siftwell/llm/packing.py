"""Filling containers of fixed capacity with texts measured in tokens.

The plan is made on the histogram of lengths, which has at most as many entries as the capacity whatever
the number of texts: a container is opened with the longest length left, gaps are closed by one, two or
three lengths that fill them exactly as far as the availability counts allow, else by the best fit, and
the pattern found is used as often as the counts permit. The texts are then ranked within their length
by a range-partitioned sort and mapped to the slots of the patterns.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.runtime import Workspace

TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Split of a text before the byte-pair merges of a rank file (fixed value).
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ROW_BITS = 33  # of monotonically_increasing_id


def load_counter(path: str):
    """A function from texts to token counts for a tokenizer file of one of three public formats."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        encoding = tiktoken.Encoding(os.path.basename(path), pat_str=RANK_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(list(texts), num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def token_counts(documents: DataFrame, tokenizer_path: str = TOKENIZER_PATH) -> DataFrame:
    """(doc_id, tokens) of every whole text; NULL and empty texts have 0."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = load_counter(tokenizer_path)
        for frame in batches:
            texts = ["" if t is None else t for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "tokens": counter(texts)})

    return documents.select("doc_id", "text").mapInPandas(count, "doc_id bigint, tokens bigint")


@dataclass
class Pattern:
    """``times`` containers, each with ``lengths`` (length -> how many of it)."""

    times: int
    lengths: dict[int, int] = field(default_factory=dict)


class ExactComplement:
    """Tables of the sums of one, two and three lengths, each sum with the combination that has the longest length.

    Availability only falls, so a sum that no combination has left stays without one; an entry whose lengths
    are used up is replaced when it is asked for.
    """

    def __init__(self, counts: np.ndarray):
        self.counts, top = counts, len(counts)
        self.sizes = np.flatnonzero(counts > 0)
        self.pair = np.zeros(top, np.int32)  # the longer length of a pair with this sum, 0 for none
        for a in self.sizes.tolist():
            b = self.sizes[: np.searchsorted(self.sizes, min(a, top - 1 - a), side="right")]
            if len(b) and b[-1] == a and counts[a] < 2:
                b = b[:-1]
            self.pair[a + b] = a
        self.triple = np.zeros(top, np.int32)  # the length that a pair adds to
        reachable = self.pair > 0
        for a in self.sizes[::-1].tolist():
            rest, held = reachable[: top - a], self.triple[a:]
            open_ = rest & (held == 0)
            held[open_] = a
            if not open_.any() and (self.triple > 0).all():
                break

    def find(self, gap: int) -> list[int] | None:
        """One, two or three available lengths with this sum, as few as can be."""
        if gap < len(self.counts) and self.counts[gap] > 0:
            return [gap]
        return self._pair(gap) or self._triple(gap)

    def _left(self, lengths: list[int]) -> bool:
        return all(self.counts[x] >= lengths.count(x) for x in lengths)

    def _pairs(self, total: int) -> np.ndarray:
        """Longer lengths of all pairs with this sum that are available, rising."""
        a = self.sizes[(self.sizes * 2 >= total) & (self.sizes < total)]
        b = total - a
        return a[(self.counts[a] > 0) & (self.counts[b] > np.where(a == b, 1, 0))]

    def _pair(self, total: int) -> list[int] | None:
        a = int(self.pair[total]) if total < len(self.pair) else 0
        if a and not self._left([a, total - a]):
            found = self._pairs(total)
            a = self.pair[total] = int(found[-1]) if len(found) else 0
        return [a, total - a] if a else None

    def _with(self, a: int, rest: int) -> list[int] | None:
        """[a, ...] with an available pair of sum ``rest`` besides one a."""
        pair = self._pair(rest)
        if pair is None or self._left([a, *pair]):
            return pair and [a, *pair]
        for b in self._pairs(rest)[::-1].tolist():  # the pair shares the only a
            if self._left([a, b, rest - b]):
                return [a, b, rest - b]
        return None

    def _triple(self, total: int) -> list[int] | None:
        a = int(self.triple[total]) if total < len(self.triple) else 0
        if not a:
            return None
        found = self._with(a, total - a) if self.counts[a] > 0 else None
        if found is None:
            self.sizes = self.sizes[self.counts[self.sizes] > 0]
            able = self.sizes[self.sizes < total]
            able = able[self.pair[total - able] > 0]
            found = next(filter(None, (self._with(a, total - a) for a in able[::-1].tolist())), None)
            self.triple[total] = found[0] if found else 0
        return found


def plan_patterns(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use every length of the histogram (0 < length <= capacity) exactly as often as it occurs."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit a container of {capacity}")
        counts[length] += n
    index, plan = ExactComplement(counts), []
    top = capacity
    while True:
        while top > 0 and counts[top] == 0:
            top -= 1
        if top == 0:
            return plan
        used: dict[int, int] = {}
        gap, take = capacity, [top]
        while take:
            for length in take:
                counts[length] -= 1
                used[length] = used.get(length, 0) + 1
                gap -= length
            if gap == 0:
                break
            take = index.find(gap)
            if take is None:
                fitting = np.flatnonzero(counts[: gap + 1] > 0)
                take = [int(fitting[-1])] if len(fitting) else []
        more = min(int(counts[length]) // k for length, k in used.items())
        for length, k in used.items():
            counts[length] -= more * k
        plan.append(Pattern(1 + more, used))


def _slots(plan: list[Pattern], first_container: int) -> tuple[pd.DataFrame, int]:
    """Intervals of ranks within a length and the containers they go to, ordered by length and rank."""
    rows, taken = [], {}
    container = first_container
    for p in plan:
        for length, k in p.lengths.items():
            start = taken.get(length, 0)
            rows.append((length, start, p.times, container))
            taken[length] = start + k * p.times
        container += p.times
    return pd.DataFrame(rows, columns=["size", "start", "times", "container"]).sort_values(["size", "start"], ignore_index=True), container


def pieces_of(lengths: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece_no, size): texts as a whole; only one longer than the capacity is cut, into full pieces and a rest."""
    whole = F.floor(F.col("tokens") / capacity).cast("bigint")
    last = F.when(F.col("tokens") % capacity == 0, F.greatest(whole - 1, F.lit(0))).otherwise(whole)
    cut = lengths.where("tokens > 0").select("doc_id", "tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece_no"))
    return cut.select("doc_id", "piece_no", F.least(F.col("tokens") - F.col("piece_no") * capacity, F.lit(capacity)).cast("bigint").alias("size"))


def pack(lengths: DataFrame, capacity: int, work: Workspace | None = None) -> DataFrame:
    """(container_no, doc_id, piece_no, size) with every container at most ``capacity`` full.

    Pieces as long as the capacity have a container each. Texts of no tokens take no space and are spread
    over the containers by a hash of their id (container 0 if there is no other). ``lengths`` has doc_id
    and tokens; a doc_id that occurs twice is two texts. Empty input gives an empty result.
    """
    spark = lengths.sparkSession
    work = work or Workspace(spark, "packing")
    pieces = pieces_of(lengths, capacity)
    # numbered in the job that sorts: files read back come in another order
    ordered = work.save(pieces.orderBy("size", "doc_id", "piece_no").withColumn("row", F.monotonically_increasing_id()))
    blocks = ordered.groupBy("size", F.shiftright("row", _ROW_BITS).alias("part")).agg(
        F.count("*").alias("n"), F.min("row").alias("first")
    )
    held = blocks.toPandas().sort_values(["size", "first"], ignore_index=True)  # lengths times partitions, not rows
    held["rank"] = held.groupby("size")["n"].cumsum() - held["n"]
    histogram = {int(s): int(n) for s, n in held.groupby("size")["n"].sum().items()}
    slots, containers = _slots(plan_patterns(histogram, capacity), 0)
    starts = {int(s): (g["start"].to_numpy(), g["times"].to_numpy(), g["container"].to_numpy()) for s, g in slots.groupby("size")}
    ranks = {(int(s), int(p)): (int(f), int(r)) for s, p, f, r in zip(held["size"], held["part"], held["first"], held["rank"])}
    shared = spark.sparkContext.broadcast((starts, ranks))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, ranks = shared.value
        for frame in batches:
            part = frame["row"].to_numpy() >> _ROW_BITS
            out = np.empty(len(frame), np.int64)
            for (size, p), at in frame.groupby(["size", part]).indices.items():
                first, rank = ranks[(int(size), int(p))]
                within = frame["row"].to_numpy()[at] - first + rank
                begin, times, container = starts[int(size)]
                slot = np.searchsorted(begin, within, side="right") - 1
                out[at] = container[slot] + (within - begin[slot]) % times[slot]
            yield pd.DataFrame({"container_no": out, "doc_id": frame["doc_id"], "piece_no": frame["piece_no"], "size": frame["size"]})

    placed = ordered.mapInPandas(place, "container_no bigint, doc_id bigint, piece_no bigint, size bigint")
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(max(containers, 1))).cast("bigint")
    weightless = lengths.where("tokens = 0").select(
        spread.alias("container_no"), "doc_id", F.lit(0).cast("bigint").alias("piece_no"), F.lit(0).cast("bigint").alias("size")
    )
    return placed.unionByName(weightless)


def pack_documents(documents: DataFrame, specs: DataFrame, tokenizer_path: str = TOKENIZER_PATH) -> DataFrame:
    """(spec_id, capacity, container_no, doc_id, piece_no, size) for every capacity of ``specs``, one plan each."""
    wanted = specs.where("capacity > 0").select("spec_id", "capacity").distinct().orderBy("spec_id", "capacity").collect()
    spark = documents.sparkSession
    work = Workspace(spark, "packing")
    lengths = work.save(token_counts(documents, tokenizer_path))
    out = None
    for row in wanted:
        packed = pack(lengths, int(row["capacity"]), work).select(
            F.lit(row["spec_id"]).cast("int").alias("spec_id"), F.lit(row["capacity"]).cast("bigint").alias("capacity"), "container_no", "doc_id", "piece_no", "size"
        )
        out = packed if out is None else out.unionByName(packed)
    if out is None:
        return spark.createDataFrame([], "spec_id int, capacity bigint, container_no bigint, doc_id bigint, piece_no bigint, size bigint")
    return out


def fill_report(packed: DataFrame) -> DataFrame:
    """Per capacity: containers, tokens, the least number of containers possible, and the unused share."""
    fill = packed.groupBy("spec_id", "capacity", "container_no").agg(F.sum("size").alias("used"))
    total = fill.groupBy("spec_id", "capacity").agg(
        F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest")
    )
    bound = F.ceil(F.col("tokens") / F.col("capacity"))
    unused = F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity")), 6)
    return total.select("*", bound.alias("least_containers"), unused.alias("unused_share"))
