"""Near-duplicate groups by MinHash bands, odd sketches and exact confirmation.

Each text's shingle set gives MinHash samples. Rows of samples make band keys, which bring similar
sets together. All samples fold into a bitmap of parities; the population count of two bitmaps' XOR
estimates how many samples differ. The set itself folds into a second bitmap, twice as wide as the set
is large, whose XOR tells the symmetric difference within a few elements. Pairs that pass both are
confirmed on their full sets.

Equal sets become one class first. A bucket of few classes is compared in pairs; in a larger one every
class meets a few centres only. Linked classes are then joined into components. Where a larger bucket
still holds several components, bitmaps of the classes outside its main one are compared with all its
members, tile by tile, and the most similar pairs between components are confirmed; the last such round
takes all pairs that pass. So no group is expanded into all pairs, and no link that the bands show is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.components import components
from medallion.llm.frames import map_arrow, stored
from medallion.llm.text import WORD_TABLE, hash_spans, mix, shingle_hashes, slices, word_spans


@dataclass(frozen=True)
class Similarity:
    """What counts as a link: ``percent`` of the union of two sets of ``words``-word shingles in both."""

    words: int = 5
    percent: int = 80
    rows: int = 5
    #: Bands are added until a link at the threshold goes unseen with at most this chance.
    miss: float = 1e-6
    sketch_bits: int = 512
    #: Buckets of more classes are compared through centres.
    pairwise: int = 8
    centres: int = 2
    #: Classes of a tile, and partners confirmed for a class and tile in each round; the last takes all.
    tile: int = 128
    #: Tiles of a large bucket that one task compares a tile with.
    tiles_met: int = 8
    closest: tuple[int, ...] = (4, 1 << 30)

    @cached_property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @cached_property
    def most_flips(self) -> int:
        """Largest count of differing sketch bits of a likely pair: five deviations below the threshold."""
        level = self.percent / 100
        level -= 5 * math.sqrt(level * (1 - level) / self.samples)
        differing = 2 * self.samples * (1 - level)
        return math.ceil(self.sketch_bits / 2 * (1 - math.exp(-2 * differing / self.sketch_bits)))

    def most_odd(self, elements: np.ndarray, width: int) -> np.ndarray:
        """Like ``most_flips`` for the sets' own bitmaps, by the number of elements of both sets."""
        apart = elements * ((100 - self.percent) / (100 + self.percent))
        decay = np.exp(-4 * apart / width)
        deviation = np.sqrt(np.maximum(width / 4 * (1 - decay) - apart * decay, 0))
        return np.ceil(width / 2 * (1 - np.sqrt(decay)) + 5 * deviation + 1)


def _shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text of a slice."""
    start, end, first = word_spans(data, offsets, WORD_TABLE)
    found, begin = shingle_hashes(hash_spans(data, start, end, WORD_TABLE), first, words)
    return [np.unique(found[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def _set_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each set and 128 bits that tell sets apart."""
    size = np.array([len(x) for x in sets], np.int64)
    full = size > 0
    keys = np.zeros((2, len(sets)), np.uint64)
    if full.any():
        flat = np.concatenate(sets)
        begin = (np.cumsum(size) - size)[full]
        keys[0, full] = np.add.reduceat(flat, begin)
        keys[1, full] = np.add.reduceat(mix(flat ^ np.uint64(0xD6E8FEB86659FD93)), begin)
    return size, keys[0].view(np.int64), keys[1].view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).view(np.int64).ravel()))


def _parities(shingles: np.ndarray) -> bytes:
    """Bitmap of the parity of elements at each place; half as wide, it is the XOR of its halves."""
    width = max(512, 1 << int(2 * len(shingles) - 1).bit_length()) if len(shingles) else 512
    place = (mix(shingles ^ np.uint64(0x94D049BB133111EB)) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=width) & 1, bitorder="little").tobytes()


def _folded(bitmaps: list[bytes], width: int) -> np.ndarray:
    """Rows of 64-bit words of bitmaps that are ``width`` or twice as wide."""
    out = np.empty((len(bitmaps), width // 64), np.uint64)
    for k, b in enumerate(bitmaps):
        words = np.frombuffer(b, "<u8")
        out[k] = words if len(words) == out.shape[1] else words[: out.shape[1]] ^ words[out.shape[1] :]
    return out


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def sketches(docs: DataFrame, rule: Similarity) -> DataFrame:
    """uid, doc_id, n_shingles, key1, key2, sketch, bands and parities of each row of docs (uid, doc_id, text)."""
    bits = rule.sketch_bits
    salt = mix(np.arange(1, rule.samples + 1, dtype=np.uint64))
    odd = mix(salt) | np.uint64(1)
    schema = T.StructType([
        *docs.select("uid", "doc_id").schema.fields,
        *(T.StructField(n, T.LongType()) for n in ("n_shingles", "key1", "key2")),
        *(T.StructField(n, T.ArrayType(T.LongType())) for n in ("sketch", "bands")),
        T.StructField("parities", T.BinaryType()),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(2)):
                sets = _shingles(data, offsets, rule.words)
                size, key1, key2 = _set_keys(sets)
                samples = np.zeros((rule.samples, len(sets)), np.uint64)
                full = np.flatnonzero(size)
                if len(full):
                    flat, begin = np.concatenate(sets), (np.cumsum(size) - size)[full]
                    for k in range(rule.samples):
                        samples[k, full] = np.minimum.reduceat((flat ^ salt[k]) * odd[k], begin)
                sketch = np.zeros((len(sets), bits // 64), np.uint64)
                bands = np.zeros((len(sets), rule.bands), np.uint64)
                rows = np.arange(len(sets))
                for k in range(rule.samples):
                    bit = mix(samples[k] + salt[k]) % np.uint64(bits)
                    sketch[rows, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
                    bands[:, k // rule.rows] = mix(bands[:, k // rule.rows] + samples[k] + odd[k])
                columns = [batch.column(n).slice(first, end - first) for n in (0, 1)]
                columns += [pa.array(size), pa.array(key1), pa.array(key2), _lists(sketch), _lists(bands)]
                columns.append(pa.array([_parities(x) for x in sets], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_arrow(docs.select("uid", "doc_id", "text"), build, schema)


def _flips(a: str, b: str) -> Column:
    """Population count of the XOR of two sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _likely(pairs: DataFrame, nodes: DataFrame, rule: Similarity) -> DataFrame:
    """Those of the pairs (a, b) whose sizes and bitmaps allow a link."""
    kept = ("n_shingles", "sketch", "parities")
    side = {x: nodes.select(F.col("node").alias(x), *(F.col(n).alias(n + x) for n in kept)) for x in "ab"}
    sized = pairs.join(side["a"], "a").join(side["b"], "b")
    sized = sized.where(F.least("n_shinglesa", "n_shinglesb") * 100 >= F.greatest("n_shinglesa", "n_shinglesb") * rule.percent)
    sized = sized.where(_flips("sketcha", "sketchb") <= rule.most_flips)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            elements = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            keep = np.zeros(len(elements), bool)
            for k, (a, b) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                width = 8 * min(len(a), len(b))
                keep[k] = _differing(*_folded([a, b], width)) <= rule.most_odd(elements[k], width)
            yield batch.select([0, 1]).filter(pa.array(keep))

    columns = ("a", "b", "n_shinglesa", "n_shinglesb", "paritiesa", "paritiesb")
    return map_arrow(sized.select(*columns), test, pairs.schema)


def _sets(nodes: DataFrame, docs: DataFrame, rule: Similarity) -> DataFrame:
    """(node, shingles) of ``nodes`` (node), from the texts of ``docs`` (uid, text) again: a node is its class's least uid."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(1)):
                sets = _shingles(data, offsets, rule.words)
                bounds = np.append(0, np.cumsum([len(x) for x in sets])).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), lists], schema.names)

    texts = docs.select(F.col("uid").alias("node"), "text").join(nodes, "node", "left_semi")
    return map_arrow(texts, build, schema)


def _confirmed(pairs: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """Those of the stored pairs that are linked by their full sets."""
    named = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = sets.join(named, "node", "left_semi")
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    both = both.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    common = both.select("a", "b", (F.size("sa") + F.size("sb")).alias("n"), F.size(F.array_intersect("sa", "sb")).alias("i"))
    return common.where(F.col("i") * 100 >= (F.col("n") - F.col("i")) * rule.percent).select("a", "b")


@dataclass
class _Tile:
    """Some classes of a bucket, as columns."""

    node: np.ndarray
    root: np.ndarray
    size: np.ndarray
    sketch: np.ndarray
    bands: np.ndarray
    main: np.ndarray
    parities: list[bytes]

    @classmethod
    def of(cls, rows: pa.StructArray) -> _Tile:
        node, root, size = (rows.field(n).to_numpy(zero_copy_only=False) for n in ("node", "root", "n_shingles"))
        sketch, bands = (rows.field(n).flatten().to_numpy().reshape(len(node), -1) for n in ("sketch", "bands"))
        main = rows.field("in_main").to_numpy(zero_copy_only=False)
        return cls(node, root, size, sketch.view(np.uint64), bands, main, rows.field("parities").to_pylist())

    @cached_property
    def widths(self) -> np.ndarray:
        return 8 * np.array([len(p) for p in self.parities], np.int64)

    def bitmaps(self, width: int, rows: np.ndarray) -> np.ndarray:
        """Bitmaps of the given rows, a row each, folded to ``width``."""
        return _folded([self.parities[k] for k in rows.tolist()], width)

    def close(self, other: _Tile, key: int, rule: Similarity, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """Likely links between components: for each class here the ``most`` closest ones of the other tile; and whether there were more.

        Two classes are compared in the bucket ``key`` of their first common band only, and two outside
        the main component from the one side only.
        """
        low, high = np.minimum.outer(self.size, other.size), np.maximum.outer(self.size, other.size)
        may = (low * 100 >= high * rule.percent) & (self.root[:, None] != other.root)
        may &= other.main | (self.node[:, None] < other.node)
        if may.any():
            flips = np.zeros(may.shape, np.uint16)
            for word, word_of in zip(self.sketch.T, other.sketch.T, strict=True):
                flips += np.bitwise_count(word[:, None] ^ word_of)
            may &= flips <= rule.most_flips
        a, b = np.nonzero(may)
        common = (self.bands[a] == other.bands[b]).argmax(1)
        first = self.bands[a, common] == key
        a, b = a[first], b[first]
        width = np.minimum(self.widths[a], other.widths[b])
        share = np.full(len(a), np.inf)
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            (mine, to_mine), (theirs, to_theirs) = (np.unique(x[at], return_inverse=True) for x in (a, b))
            apart = _differing(self.bitmaps(w, mine)[to_mine], other.bitmaps(w, theirs)[to_theirs])
            elements = self.size[a[at]] + other.size[b[at]]
            share[at] = np.where(apart <= rule.most_odd(elements, w), apart / elements, np.inf)
        order = np.lexsort((share, a))
        order = order[share[order] < np.inf]
        starts = np.searchsorted(a[order], a[order], side="left")
        near = np.arange(len(order)) - starts < most
        return a[order[near]], b[order[near]], not near.all()


def _left_over(buckets: DataFrame, roots: DataFrame, nodes: DataFrame, rule: Similarity, most: int) -> DataFrame | None:
    """Likely pairs (a, b) between components of larger buckets; ``cut`` is the bucket where there were more. None without such buckets."""
    placed = buckets.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots"), F.sum("n").alias("all"))
    kept = ("n_shingles", "sketch", "bands", "parities")
    placed = placed.join(main.where("roots > 1"), "key").join(nodes.select("node", *kept), "node")
    chunks = F.ceil(F.col("all") / rule.tile)
    chunk = F.pmod(F.xxhash64("node"), chunks).alias("chunk")
    parts = F.ceil(chunks / rule.tiles_met).alias("parts")
    placed = placed.select("key", chunk, parts, "node", "root", (F.col("root") == F.col("main")).alias("in_main"), *kept)
    placed = stored(placed, "active")
    if placed.isEmpty():
        return None
    listed = F.collect_list(F.struct("node", "root", "in_main", *kept))
    # A large bucket is split: each part of its tiles meets a copy of every tile outside its main component.
    members = placed.groupBy("key", "chunk", "parts").agg(listed.alias("members"))
    members = members.select("key", F.pmod("chunk", "parts").alias("part"), "members")
    outside = placed.where("not in_main").groupBy("key", "chunk", "parts").agg(listed.alias("outside"))
    outside = outside.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "outside")

    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b", "cut")])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                mine, theirs = (_Tile.of(batch.column(c)[k].values) for c in range(2))
                key = batch.column(2)[k].as_py()
                a, b, cut = mine.close(theirs, key, rule, most)
                a, b = mine.node[a], theirs.node[b]
                columns = [np.minimum(a, b), np.maximum(a, b), np.full(len(a), key)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns[:2]), pa.array(columns[2], mask=np.full(len(a), not cut))], schema.names)

    # Parts are even by now; dealt out by hand, they are not split once more into tasks of a tile each.
    outside, members = (x.repartition("key", "part") for x in (outside, members))
    met = outside.join(members, ["key", "part"]).select("outside", "members", "key")
    return stored(map_arrow(met, compare, schema), "compared")


def near_duplicates(docs: DataFrame, rule: Similarity) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its set's size, its component and whether it stays.

    Returns uid, doc_id, n_shingles, component_id (the least doc_id of the component), kept (doc_id is
    component_id) and first_row, true for one row of each component. Null and empty texts have
    no shingles and are linked with nothing; a null doc_id is no component's id unless all are null.
    A column uid, unique and stable, is used where given; other columns are not read.
    """
    if "uid" not in docs.columns:
        docs = stored(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"), "numbered")
    rows = stored(sketches(docs, rule), "sketches")
    keys = ["key1", "key2", "n_shingles"]
    first = F.first(F.struct("sketch", "bands", "parities"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))
    classes = rows.where("n_shingles > 0").groupBy(*keys).agg(F.min("uid").alias("node"), least.alias("least"), first.alias("of"))
    nodes = stored(classes.select(*keys, "node", "least", F.col("least.doc_id").alias("doc_id"), "of.*"), "classes")

    members = nodes.select(F.explode("bands").alias("key"), "node")
    centre = [F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("rank"), "node"))["node"].alias(f"c{k}") for k in range(rule.centres)]
    shared = members.groupBy("key").agg(F.count("*").alias("n"), *centre).where("n > 1")
    shared = shared.select("key", "n", F.array_distinct(F.array(*(f"c{k}" for k in range(rule.centres)))).alias("centres"))
    met = stored(members.join(shared, "key"), "buckets")
    few = met.where(F.col("n") <= rule.pairwise).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("all"))
    few = few.select(F.explode("all").alias("a"), "all").select("a", F.explode(F.filter("all", lambda x: x > F.col("a"))).alias("b"))
    many = met.where(F.col("n") > rule.pairwise).select("node", F.explode("centres").alias("centre")).where("node <> centre")
    pairs = few.union(many.select(F.least("node", "centre"), F.greatest("node", "centre"))).distinct()
    pairs = stored(_likely(pairs, nodes, rule), "pairs")
    # The texts of all classes that share a bucket are read and shuffled once.
    sets = stored(_sets(met.select("node").distinct(), docs, rule), "sets")
    edges = stored(_confirmed(pairs, sets, rule), "links")
    roots = components(edges)

    large = met.where(F.col("n") > rule.pairwise).select("key", "node")
    tested = pairs
    for most in rule.closest:
        found = _left_over(large, roots, nodes, rule, most)
        if found is None:
            break
        pairs = stored(found.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            tested = tested.union(pairs)
            edges = stored(edges.union(_confirmed(pairs, sets, rule)), "links")
            roots = components(edges)
        # Where no class had more likely partners than were taken, nothing is left to compare.
        cut = found.where("cut is not null").select(F.col("cut").alias("key")).distinct()
        if cut.isEmpty():
            break
        large = large.join(cut, "key", "left_semi")

    placed = nodes.select(*keys, "node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = placed.groupBy("root").agg(F.min("least").alias("head"))
    named = stored(placed.join(heads, "root").select(*keys, "head"), "groups")
    out = rows.select("uid", "doc_id", *keys).join(named, keys, "left")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    out = out.withColumn("head", F.coalesce("head", own)).withColumn("component_id", F.col("head.doc_id"))
    return out.select(
        "uid", "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("uid") == F.col("head.uid")).alias("first_row"),
    )
