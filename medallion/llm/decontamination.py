"""Benchmark passages in documents, by SimHash of item-sized windows and multi-index Hamming search.

For each length that benchmark items have, every window of so many words of every document is a
candidate, unless too little of its weight lies in shingles of items of that length to reach the
threshold (tested by bitmaps of fixed size, which may only let too much through). Candidates get a
64-bit SimHash. It is cut into blocks: two prints within the radius agree up to a few bits in at least
one block, so looking up each block among all values that near finds all of them. Pairs within the
radius are then measured exactly: by the weight of the shingles both share over the weight of either.

A shingle weighs the bytes of its words, and votes by the root of that in the print, so that prints
follow the weight in common. Case and ASCII punctuation do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import map_arrow, stored
from medallion.llm.text import LETTER_TABLE, hash_spans, mix, shingle_hashes, slices, word_spans

#: Bits of the bitmap that holds the shingles of all items, and with their item's length.
BITMAP_BITS = 22
#: Windows whose prints are computed together.
RUN = 4096


@dataclass(frozen=True)
class Rule:
    """Windows count from ``percent`` of the weight on; prints may differ in ``radius`` of 64 bits.

    The bits are independent. Whatever the weights, each differs by a chance of at most 0.152 at 80
    percent: 9.7 bits in the mean, and one in 1,100 of such pairs differ in more than 19.
    """

    words: int = 5
    percent: int = 80
    radius: int = 19
    blocks: tuple[int, ...] = (13, 13, 13, 13, 12)

    @property
    def masks(self) -> dict[int, list[int]]:
        """For each block width the differences to look up."""
        most = self.radius // len(self.blocks)
        return {w: [sum(1 << k for k in c) for n in range(most + 1) for c in combinations(range(w), n)] for w in set(self.blocks)}


def _with_length(shingles: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    return mix(shingles ^ np.asarray(length, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F | 1))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _shingled(data: np.ndarray, offsets: np.ndarray, words: int):
    """Shingles of all texts of a slice, their weights, each text's first one, and its number of words."""
    start, end, first = word_spans(data, offsets, LETTER_TABLE)
    shingles, begin = shingle_hashes(hash_spans(data, start, end, LETTER_TABLE), first, words)
    count = np.diff(first)
    bytes_before = np.append(0, np.cumsum(end - start))
    at = np.arange(len(shingles)) + np.repeat(first[:-1] - begin[:-1], np.diff(begin))
    size = np.repeat(np.minimum(count, words), np.diff(begin))
    return shingles, bytes_before[at + size] - bytes_before[at], begin, count


@cache
def _normal() -> np.ndarray:
    """Normal deviates in the middle of 2**16 equally likely steps."""
    half = np.array([NormalDist().inv_cdf((k + 0.5) / 65536) for k in range(32768)])
    return np.append(half, -half[::-1])


def _votes(shingles: np.ndarray) -> np.ndarray:
    """A normally distributed vote of each shingle on each of the 64 bits."""
    seeds = np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _normal()[mix(mix(shingles)[:, None] + seeds).astype("<u8").view("<u2")]


def _print(weights: np.ndarray, votes: np.ndarray) -> np.uint64:
    """SimHash of a set of shingles: the signs of the votes' sums, each by the root of the shingle's weight.

    The cosine of two such sums is the weight in common over the mean weight, whatever the weights are.
    """
    return np.packbits(np.sqrt(weights) @ votes > 0, bitorder="little").view("<u8")[0]


def _weighted(shingles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(shingles, return_inverse=True)
    return distinct, np.bincount(inverse, weights, len(distinct)).astype(np.int64)


_SHINGLES = T.ArrayType(T.LongType())


def items(benchmark: DataFrame, rule: Rule) -> DataFrame:
    """One row per distinct wording of benchmark (item_id, text): the least item_id, its print and shingles."""
    schema = T.StructType([
        benchmark.schema["item_id"],
        *(T.StructField(n, T.LongType()) for n in ("length", "print")),
        *(T.StructField(n, _SHINGLES) for n in ("shingles", "weights")),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in slices(batch.column(1)):
                shingles, weights, begin, count = _shingled(data, offsets, rule.words)
                rows, prints, sets = [], [], []
                for k in np.flatnonzero(count).tolist():
                    part = slice(begin[k], begin[k + 1])
                    rows.append(k)
                    sets.append(_weighted(shingles[part], weights[part]))
                    prints.append(_print(sets[-1][1], _votes(sets[-1][0])))
                columns = [batch.column(0).take(pa.array([first + k for k in rows], pa.int64())), pa.array(count[rows], pa.int64())]
                columns.append(pa.array(np.array(prints, np.uint64).view(np.int64)))
                columns += [pa.array([s[0].view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array([s[1] for s in sets], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    rows = map_arrow(benchmark.select("item_id", "text"), build, schema)
    return rows.groupBy("length", "print", "shingles", "weights").agg(F.min("item_id").alias("item_id"))


def _bitmaps(found: DataFrame) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Which shingles items hold, which with their item's length, and the lengths.

    The first two are tables of fixed size, filled by an aggregate of at most 2**16 rows each.
    """
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("slot", T.LongType())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            shingles = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = np.diff(lists.offsets.to_numpy())
            lengths = np.repeat(batch.column(0).to_numpy(), sizes)
            slots = [_slots(shingles), _slots(_with_length(shingles, lengths))]
            kinds = np.repeat(np.arange(2, dtype=np.int32), len(shingles))
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.concatenate(slots))], schema.names)

    slots = map_arrow(found.select("length", "shingles"), build, schema)
    words = slots.groupBy("kind", F.shiftright("slot", 6).alias("at"))
    rows = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")).collect()
    maps = np.zeros((2, 1 << (BITMAP_BITS - 6)), np.uint64)
    for r in rows:
        maps[r["kind"], r["at"]] = np.int64(r["bits"]).view(np.uint64)
    flags = np.unpackbits(maps.astype("<u8").view(np.uint8).reshape(2, -1), axis=1, bitorder="little").astype(bool)
    return flags[0], flags[1], sorted(r["length"] for r in found.select("length").distinct().collect())


def windows(docs: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """The windows of docs (doc_id, text) that may reach the threshold with an item of ``found``."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmaps(found))
    schema = T.StructType([
        docs.schema["doc_id"],
        *(T.StructField(n, T.LongType()) for n in ("start", "length", "window", "print")),
        *(T.StructField(n, _SHINGLES) for n in ("shingles", "weights")),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_with, lengths = shared.value
        for batch in batches:
            for first, _, data, offsets in slices(batch.column(1)):
                shingles, weights, begin, count = _shingled(data, offsets, rule.words)
                for out, texts in of_short_items(data, offsets, lengths, held_with):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + texts)), *out], schema.names)
                hits = np.flatnonzero(held[_slots(shingles)])
                text = np.searchsorted(begin, hits, side="right") - 1
                for k in np.unique(text).tolist():
                    part = slice(begin[k], begin[k + 1])
                    seeds = hits[text == k] - begin[k]
                    for out in of_text(shingles[part], weights[part], seeds, int(count[k]), lengths, held_with):
                        size = len(out[0])
                        key = batch.column(0).take(pa.array(np.full(size, first + k)))
                        yield pa.RecordBatch.from_arrays([key, *out], schema.names)

    def of_short_items(data, offsets, lengths, held_with):
        """Windows of items too short for a shingle: their whole sequence, wherever it stands."""
        for length in lengths:
            if length >= rule.words:
                break
            shingles, weights, begin, count = _shingled(data, offsets, length)
            at = np.flatnonzero(held_with[_slots(_with_length(shingles, length))])
            text = np.searchsorted(begin, at, side="right") - 1
            at, text = at[count[text] >= length], text[count[text] >= length]
            for low in range(0, len(at), RUN):
                mine, texts = at[low : low + RUN], text[low : low + RUN]
                sets = [(shingles[k : k + 1], weights[k : k + 1].astype(np.int64)) for k in mine.tolist()]
                yield described(mine - begin[texts], length, sets, shingles[mine]), texts

    def described(start, length, sets, every):
        every = np.unique(every)
        votes = _votes(every)
        prints = np.array([_print(w, votes[np.searchsorted(every, h)]) for h, w in sets], np.uint64)
        window = np.array([mix(mix(h) + w.astype(np.uint64)).sum() for h, w in sets], np.uint64)
        return [
            pa.array(start), pa.array(np.full(len(start), length)),
            pa.array(window.view(np.int64)), pa.array(prints.view(np.int64)),
            pa.array([h.view(np.int64) for h, _ in sets], pa.list_(pa.int64())),
            pa.array([w for _, w in sets], pa.list_(pa.int64())),
        ]

    def of_text(shingles, weights, seeds, count, lengths, held_with):
        before = np.append(0, np.cumsum(weights))
        for length in lengths:
            if length < rule.words or count < rule.words:
                continue
            size = min(max(1, length - rule.words + 1), len(shingles))
            mine = seeds[held_with[_slots(_with_length(shingles[seeds], length))]]
            if not len(mine):
                continue
            known = np.append(0, np.cumsum(np.bincount(mine, weights[mine], len(shingles))))
            start = np.arange(len(shingles) - size + 1)
            share = known[start + size] - known[start]
            start = start[share * 100 >= (before[start + size] - before[start]) * rule.percent]
            while len(start):
                run = start[: max(1, int(np.searchsorted(start, start[0] + RUN)))]
                start = start[len(run) :]
                low, high = run[0], run[-1] + size
                sets = [_weighted(shingles[s : s + size], weights[s : s + size]) for s in run.tolist()]
                yield described(run, length, sets, shingles[low:high])

    return map_arrow(docs.select("doc_id", "text"), build, schema)


def _near(block: int, value: Column, masks: list[int]) -> Column:
    """The keys of all values that differ from ``value`` by one of the masks."""
    keyed = lambda m: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(m).alias("value"))
    return F.transform(F.array(*map(F.lit, masks)), keyed)


def within_radius(some: DataFrame, others: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of rows of ``some`` (window, length, print) and ``others`` (item_id, length, print) of one
    length whose prints differ in at most ``radius`` bits, each once."""
    sides, at = {"some": [], "others": []}, 0
    for k, width in enumerate(rule.blocks):
        value = F.shiftrightunsigned("print", at).bitwiseAND((1 << width) - 1).cast("int")
        block = F.struct(F.lit(k).alias("block"), value.alias("value"))
        sides["some"].append(F.array(block))
        sides["others"].append(_near(k, value, rule.masks[width]))
        at += width
    left = some.select("window", "length", "print", F.explode(F.concat(*sides["some"])).alias("key"))
    right = others.select("item_id", "length", F.col("print").alias("item_print"), F.explode(F.concat(*sides["others"])).alias("key"))
    met = left.join(right, ["length", "key"])
    met = met.withColumn("hamming", F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))))
    return met.where(F.col("hamming") <= rule.radius).select("window", "length", "item_id", "hamming").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Documents (doc_id, text) that hold a benchmark item (item_id, text), one row per pair.

    Returns doc_id, item_id (the least of equal wordings), the most similar window (start, as a word
    count; length in words), its Hamming distance and similarity, and the number of windows found. Null and empty
    texts hold nothing. Items of fewer words than a shingle match by their whole sequence, wherever
    it stands. Rows that repeat a doc_id count as one document. Other columns are not read.
    """
    found = stored(items(benchmark, rule), "items")
    seen = stored(windows(docs, found, rule), "windows")
    first = F.first(F.struct("print", "shingles", "weights")).alias("of")
    distinct = seen.groupBy("length", "window").agg(first).select("length", "window", "of.*")
    pairs = within_radius(distinct, found, rule)
    both = pairs.join(distinct.drop("print"), ["length", "window"])
    both = both.join(found.select("item_id", "length", F.map_from_arrays("shingles", "weights").alias("item")), ["item_id", "length"])
    common = F.aggregate(
        F.arrays_zip("shingles", "weights"), F.lit(0).cast("long"),
        lambda s, x: s + F.least(x["weights"], F.coalesce(F.element_at("item", x["shingles"]), F.lit(0))),
    )
    total = F.aggregate(F.concat("weights", F.map_values("item")), F.lit(0).cast("long"), lambda s, x: s + x)
    measured = both.select("length", "window", "item_id", "hamming", common.alias("common"), total.alias("total"))
    linked = measured.where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * rule.percent)
    linked = linked.withColumn("similarity", F.col("common") / (F.col("total") - F.col("common")))
    hits = seen.select("doc_id", "start", "length", "window").join(linked, ["length", "window"])
    best = F.min_by(F.struct("start", "length", "hamming", "similarity"), F.struct(-F.col("similarity"), "start"))
    return hits.groupBy("doc_id", "item_id").agg(best.alias("best"), F.count("*").alias("n_windows")).select(
        "doc_id", "item_id", "best.*", "n_windows"
    )
