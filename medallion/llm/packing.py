"""Best-fit packing of documents into token sequences by large-item matching.

A piece above a third of the capacity is large: a sequence holds at most two of those, so the largest
ones are matched greedily with the largest partner that fits. Smaller pieces then go, longest first,
into the smallest gap that takes them. Both steps look at lengths only. One aggregate counts the
pieces of each length, at most ``capacity`` rows whatever the corpus; a plan over these counts says
which ranks of a length go to which run of sequences, and Spark gives each piece its rank and place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import map_arrow, stored
from medallion.llm.tokens import encode

CAPACITY = 4096
END_ID = 1
#: Rows of one length that a task ranks at most, in the mean.
ROWS_PER_TASK = 200_000
_RANK_BITS = 44


def token_pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document's ids and end id.

    Returns doc_id, piece, start, length and ids_crc32, and the ids themselves on request. Every row
    of ``docs`` is a document of its own, also where doc_id repeats or is null; a null or empty text
    has the end id alone. Other columns are not read.
    """
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    fields += [T.StructField("ids", T.ArrayType(T.LongType()))] * ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in encode(batch.column(1), tokenizer):
                rows, piece, start, length, crc, kept = [], [], [], [], [], []
                for k, found in enumerate(texts):
                    whole = np.append(found, np.uint32(end_id)).astype("<u4")
                    for n, low in enumerate(range(0, len(whole), capacity)):
                        part = whole[low : low + capacity]
                        rows.append(first + k)
                        piece.append(n)
                        start.append(low)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if ids:
                            kept.append(part.astype(np.int64))
                columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
                columns += [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                columns += [pa.array(kept, pa.list_(pa.int64()))] * ids
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return map_arrow(docs.select("doc_id", "text"), cut, T.StructType(fields))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces of each length.

    Each row is (length, first rank, end rank, first sequence, pieces in each sequence, offset).
    """
    places: list[tuple[int, int, int, int, int, int]] = []
    left = {k: n for k, n in counts.items() if n}
    ranked: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    sizes: list[int] = []
    opened = 0

    def put(length: int, number: int, sequence: int, each: int, offset: int) -> None:
        places.append((length, ranked[length], ranked[length] + number, sequence, each, offset))
        ranked[length] += number
        left[length] -= number

    def leave(gap: int, sequence: int, number: int) -> None:
        if gap and number:
            if not gaps[gap]:
                insort(sizes, gap)
            gaps[gap].append((sequence, number))

    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        length = large[-1]
        at = bisect_right(large, capacity - length) - 1
        if at >= 0 and large[at] == length and left[length] == 1:
            at -= 1
        if at < 0:
            number, partner = left[length], 0
        elif large[at] == length:
            number, partner = left[length] // 2, length
        else:
            partner = large[at]
            number = min(left[length], left[partner])
        put(length, number, opened, 1, 0)
        if partner:
            put(partner, number, opened, 1, length)
        leave(capacity - length - partner, opened, number)
        opened += number
        large = [k for k in large if left[k]]
    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                number = -(-left[length] // (capacity // length))
                leave(capacity, opened, number)
                opened += number
                continue
            gap = sizes[at]
            sequence, number = gaps[gap].pop()
            if not gaps[gap]:
                sizes.pop(at)
            each = min(gap // length, left[length])
            full = min(number, left[length] // each)
            put(length, full * each, sequence, each, capacity - gap)
            leave(gap - each * length, sequence, full)
            leave(gap, sequence + full, number - full)
    return places


def ranked(pieces: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Adds ``rank``, gapless from 0 within each length, without ever sorting one length in one task."""
    rows = pieces.count()
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(-(-max(rows, 1) // rows_per_task)))
    salted = pieces.withColumn("bucket_", bucket)
    before = Window.partitionBy("length").orderBy("bucket_")
    base = salted.groupBy("length", "bucket_").agg(F.count("*").alias("n_")).select(
        "length", "bucket_", (F.sum("n_").over(before) - F.col("n_")).alias("base_")
    )
    within = Window.partitionBy("length", "bucket_").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (
        salted.withColumn("row_", F.row_number().over(within))
        .join(base, ["length", "bucket_"])
        .withColumn("rank", F.col("base_") + F.col("row_") - 1)
        .drop("bucket_", "row_", "base_")
    )


def place(pieces: DataFrame, *, capacity: int = CAPACITY, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Adds sequence_id and offset to pieces with doc_id, piece, start, length and ids_crc32.

    ``pieces`` is read several times, so give a stored table. Equal rows are interchangeable. No rows
    give no rows; lengths must lie between 1 and ``capacity``. Other columns stay as they are.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not k or not 1 <= k <= capacity for k in counts):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    rows = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 6)
    keys = (rows[:, 0] << _RANK_BITS) + rows[:, 1]
    shared = pieces.sparkSession.sparkContext.broadcast((keys, rows))

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows = shared.value
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            found = rows[np.searchsorted(keys, (length << _RANK_BITS) + rank, side="right") - 1]
            nth = rank - found[:, 1]
            sequence, offset = found[:, 3] + nth // found[:, 4], found[:, 5] + nth % found[:, 4] * length
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    given = pieces.drop("sequence_id", "offset", "rank")
    schema = T.StructType([*given.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return map_arrow(ranked(given, rows_per_task).select(*given.columns, "rank"), give, schema)


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Packs documents (doc_id, text) into sequences: one row per piece, with its sequence and offset."""
    return place(stored(token_pieces(docs, tokenizer, capacity=capacity, end_id=end_id, ids=ids), "pieces"), capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences of ``pack(..., ids=True)``: sequence_id, ids, and the documents in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset"))).alias("pieces"),
    )
