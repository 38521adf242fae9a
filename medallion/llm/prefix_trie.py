"""The trie of conversation prefixes, found by truncation peeling.

A conversation is a path of turns. Peeling goes from the ends of the deepest paths up: equal paths are
one node whose sums are final once nothing deeper shares it; its last turn is stripped, which makes it a
contribution to its parent, and contributions are regrouped together with the conversations that end
there. Turns that no other open path shares are stripped at once, as a run of single children, so a step
peels a whole run and every step halves the leaves at least: a few steps, however long conversations are.
Nodes are found and summed in the same descent, and conversations that share a path are one row from
the depth at which they meet. Every step is written to the shared folder.

Texts are read once, to be hashed and counted where they lie; only digests travel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import map_arrow, stored
from medallion.locations import scratch_folder

WORD = r"[^\x20\x09-\x0D]+"
#: Every id borrows the first turns, fewer than MOST_BORROWED, of the greatest multiple of FAMILY below it.
FAMILY, MOST_BORROWED = 20, 4
#: Ids of one node are first gathered in runs of this range of ids.
RUN = 256
#: Bytes of a prefix's key.
KEY_BYTES = 16


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as (digest of role and text, words of the text).

    Rows of no conv_id are left out; null roles and texts are empty. Turns without a number come first;
    equal numbers are ordered by the digest, so that no text is shuffled. Repeated rows are repeated turns.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    # The length of the role keeps (ab, c) and (a, bc) apart.
    digest = F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role), F.concat(role, text)).cast("binary"), 256))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    turns = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", digest.alias("digest"), words.alias("words")).alias("t"))
    # Nulls sort first in an array.
    ordered = F.sort_array(F.collect_list("t"))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"], t["words"])).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and turns after the first ones have been taken over from the head of the id's family."""
    own = stored(paths(conversations), "paths")
    head = F.col("conv_id") - F.col("conv_id") % FAMILY
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_BORROWED
    some = own.select("conv_id", "turns", head.alias("head"), borrowed.cast("int").alias("h"))
    # A head has at most 2 * FAMILY ids in its family, so no key is hot.
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("head"), F.slice("turns", 1, MOST_BORROWED - 1).alias("first"))
    both = some.join(heads, "head", "left")
    taken = F.coalesce(F.slice("first", 1, F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(taken, rest).alias("turns"))


def chains(conversations: DataFrame) -> DataFrame:
    """conv_id, the keys of all its prefixes from the empty one on, and the words up to each of them.

    A prefix's key is a digest of its last turn and the key before, so equal keys are equal prefixes.
    """
    whole = rebuilt(conversations)
    texts = whole.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words"))
    schema = T.StructType([
        whole.schema["conv_id"],
        T.StructField("keys", T.ArrayType(T.BinaryType())),
        T.StructField("sums", T.ArrayType(T.LongType())),
    ])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sums = [], []
            for digests, words in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                key = list(accumulate(digests, lambda k, d: hashlib.sha256(k + d).digest()[:KEY_BYTES], initial=bytes(KEY_BYTES)))
                keys.append(key)
                sums.append(list(accumulate(words, initial=0)))
            arrays = [batch.column(0), pa.array(keys, pa.list_(pa.binary())), pa.array(sums, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return map_arrow(texts, chain, schema)


def _merged(parts: DataFrame) -> DataFrame:
    """The open nodes that contributions (keys, sums, conv_id, ...) add up to."""
    totals = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    first = [F.first(c).alias(c) for c in ("keys", "sums")]
    return parts.groupBy(F.element_at("keys", -1).alias("key")).agg(*first, F.min("conv_id").alias("conv_id"), *totals)


def _cut(nodes: DataFrame) -> DataFrame:
    """Open nodes with ``first``: the least depth from which no other open node shares their path."""
    places = nodes.select("key", F.posexplode("keys").alias("depth", "prefix"))
    alone = places.groupBy("prefix").agg(F.count("*").alias("n"), F.min("key").alias("key"), F.min("depth").alias("depth")).where("n = 1")
    least = alone.groupBy("key").agg(F.min("depth").alias("first"))
    return nodes.join(least, "key", "left").withColumn("first", F.coalesce("first", F.size("keys")))


def _saved(depth: Column) -> Column:
    """Saved tokens of a cut node's subtree from ``depth`` on."""
    before = F.coalesce(F.get("sums", depth - 1), F.lit(0))
    return F.col("saved") + (F.col("n_convs") - 1) * (F.element_at("sums", -1) - before)


def _stripped(nodes: DataFrame) -> DataFrame:
    """Cut nodes without the turns they do not share, as contributions; the finished root is none."""
    done = F.col("first") < F.size("keys")
    one = F.lit(1).cast("long")
    values = {
        "n_children": F.when(done, one).otherwise(F.col("n_children")),
        "n_leaves": F.when(done, F.greatest("n_leaves", one)).otherwise(F.col("n_leaves")),
        "saved": F.when(done, _saved(F.col("first"))).otherwise(F.col("saved")),
        "keys": F.slice("keys", 1, F.col("first")),
        "sums": F.slice("sums", 1, F.col("first")),
    }
    return nodes.where("first > 0").select("conv_id", "n_convs", *(c.alias(n) for n, c in values.items()))


def peeled(paths_: DataFrame) -> DataFrame:
    """Nodes of the trie over stored chains (conv_id, keys, sums), with key, above (the parent's key) and top.

    ``top`` marks nodes whose parent has other members; every other parent has the same conv_id.
    """
    spark = paths_.sparkSession
    folder = scratch_folder(spark, "trie")
    zero = F.lit(0).cast("long")
    counts = {"n_convs": F.lit(1).cast("long"), "n_children": zero, "n_leaves": zero, "saved": zero}
    parts, step = paths_.select("*", *(c.alias(n) for n, c in counts.items())), 0
    while True:
        cut = _cut(stored(_merged(parts), "open"))
        cut.write.mode("overwrite").parquet(f"{folder}/{step:06d}")
        cut = spark.read.schema(cut.schema).parquet(f"{folder}/{step:06d}")
        parts, step = _stripped(cut), step + 1
        if cut.where("first > 0").isEmpty():
            break
    every = spark.read.schema(cut.schema).option("recursiveFileLookup", True).parquet(folder)
    done = every.where(F.col("first") < F.size("keys"))
    depths = F.explode(F.sequence("first", F.size("keys") - 1)).alias("depth")
    rows = done.select("*", depths).withColumn("last", F.col("depth") == F.size("keys") - 1)
    return rows.select(
        F.element_at("keys", F.col("depth") + 1).alias("key"),
        F.get("keys", F.col("depth") - 1).alias("above"),
        (F.col("depth") == F.col("first")).alias("top"),
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "n_convs",
        F.when(F.col("last"), F.col("n_children")).otherwise(1).alias("n_children"),
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        _saved(F.col("depth")).alias("saved"),
    )


def ends(paths_: DataFrame) -> DataFrame:
    """key and ends_sha256: the digest of the ids that end at a node, ascending and joined by commas.

    Ids are gathered in runs of neighbouring ids, then a node's runs pass in order through one running
    digest. Such a digest is sequential by its nature; a node's ids are streamed, never held.
    """
    run = F.floor(F.col("conv_id") / RUN).alias("run")
    text = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    runs = paths_.groupBy(F.element_at("keys", -1).alias("key"), run).agg(text.alias("ids"))
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, running = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key == open_key:
                    running.update(b",")
                else:
                    if open_key is not None:
                        done.append((open_key, running.hexdigest()))
                    open_key, running = key, hashlib.sha256()
                running.update(ids.encode())
            yield _rows(done)
        yield _rows([] if open_key is None else [(open_key, running.hexdigest())])

    def _rows(done: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], schema.names)

    dealt = runs.repartition("key").sortWithinPartitions("key", "run")
    return map_arrow(dealt.select("key", "ids"), digest, schema)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (conv_id, turn, role, text), all counts long.

    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. No rows give no node. Very long conversations are taken whole. Other
    columns are not read. See ``paths`` for nulls, ties and repeats.
    """
    paths_ = stored(chains(conversations), "chains")
    nodes = peeled(paths_)
    # Only below a node of several members does the parent's conv_id have to be looked up. The root
    # would draw all nodes of depth 1 to one task; its conv_id is the least of all.
    least = paths_.agg(F.min("conv_id")).scalar()
    near = nodes.where("depth <= 1 or not top")
    parent = F.when(F.col("depth") == 1, least).when(F.col("depth") > 1, F.col("conv_id"))
    near = near.withColumn("parent_conv_id", parent)
    parents = nodes.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    far = nodes.where("depth > 1 and top").join(parents, "above", "left").select(near.columns)
    named = near.unionByName(far).join(ends(paths_), "key", "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return named.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
