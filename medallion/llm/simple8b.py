"""Token ids as Simple-8b pages: 64-bit words that hold as many ids as their widths allow.

The top four bits of a word are its selector, the other sixty its ids, lowest bits first. An id of
more than sixty bits is an escape: its word holds an index into the page's list of wide ids. A page
covers whole documents. Every ``BLOCK_IDS`` ids a word starts anew and the page keeps its position, so
blocks can be decoded on their own, and all words of a page are decoded at once.

Page layout, little endian: magic ``S8B1``; documents, blocks, words, wide ids (unsigned 32 bit each);
ids of each document (64 bit), first word of each block (32 bit), words (64 bit), wide ids (64 bit);
crc32 of all that (32 bit).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import map_arrow
from medallion.llm.tokens import encode

#: (ids in a word, bits of each) by selector; selector 0 is the escape.
SELECTORS = [(1, 60), (1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1), (240, 0)]
BLOCK_IDS = 1024
#: Ids after which a page ends; a longer document has a page of its own.
PAGE_IDS = 1 << 17
_COUNT = np.array([n for n, _ in SELECTORS])
_BITS = np.array([b for _, b in SELECTORS])
_HEAD = struct.Struct("<4sIIII")


def _selectors(ids: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each position the selector that packs most ids from there on."""
    best = np.ones(len(ids), np.uint8)
    best[ids >> np.uint64(60) != 0] = 0
    at = np.flatnonzero(best)
    padded = np.concatenate([ids, np.full(240, 1 << 63, np.uint64)])
    for selector in range(2, len(SELECTORS)):
        count, bits = SELECTORS[selector]
        at = at[room[at] >= count]
        limit = np.uint64(1 << bits)
        # What fits here fitted every smaller count too: its widths are larger.
        for k in range(count):
            if not len(at):
                return best
            at = at[padded[at + k] < limit]
        best[at] = selector
    return best


def pack_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, wide ids) of unsigned 64-bit ids."""
    ids = np.asarray(ids, np.uint64)
    size = len(ids)
    starts = np.arange(0, size, BLOCK_IDS)
    selectors = _selectors(ids, np.minimum(BLOCK_IDS - np.arange(size) % BLOCK_IDS, size - np.arange(size)))
    step = _COUNT[selectors]
    chosen = np.zeros(size, bool)
    at, ends = starts, np.minimum(starts + BLOCK_IDS, size)
    while len(at):
        chosen[at] = True
        at = at + step[at]
        more = at < ends
        at, ends = at[more], ends[more]
    first = np.flatnonzero(chosen)
    words = selectors[first].astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors[first]).tolist():
        mine = np.flatnonzero(selectors[first] == selector)
        count, bits = SELECTORS[selector]
        if selector == 0:
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
        else:
            for k in range(count if bits else 0):
                words[mine] |= ids[first[mine] + k] << np.uint64(k * bits)
    return words, np.searchsorted(first, starts).astype(np.uint32), ids[first[selectors[first] == 0]]


def unpack_words(words: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """The ids of whole words, all words at once."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT[selectors]
    begin = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for selector in np.unique(selectors).tolist():
        mine = np.flatnonzero(selectors == selector)
        number, bits = SELECTORS[selector]
        if selector == 0:
            out[begin[mine]] = wide[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        else:
            for k in range(number if bits else 0):
                out[begin[mine] + k] = words[mine] >> np.uint64(k * bits) & np.uint64((1 << bits) - 1)
    return out


def write_page(texts: list[np.ndarray]) -> bytes:
    """The page of some documents' ids."""
    words, blocks, wide = pack_words(np.concatenate([np.asarray(x, np.uint64) for x in texts]) if texts else np.empty(0, np.uint64))
    lengths = np.array([len(x) for x in texts], "<u8")
    body = _HEAD.pack(b"S8B1", len(texts), len(blocks), len(words), len(wide)) + b"".join(
        x.tobytes() for x in (lengths, blocks.astype("<u4"), words.astype("<u8"), wide.astype("<u8"))
    )
    return body + struct.pack("<I", zlib.crc32(body))


def _parts(page: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    magic, texts, blocks, words, wide = _HEAD.unpack_from(page)
    if magic != b"S8B1" or struct.unpack("<I", page[-4:])[0] != zlib.crc32(page[:-4]):
        raise ValueError("not a whole Simple-8b page")
    out, at = [], _HEAD.size
    for kind, number in (("<u8", texts), ("<u4", blocks), ("<u8", words), ("<u8", wide)):
        out.append(np.frombuffer(page, kind, number, at))
        at += out[-1].nbytes
    return tuple(out)


def read_page(page: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all documents of a page, ids of each document)."""
    lengths, _, words, wide = _parts(page)
    return unpack_words(words, wide), lengths.astype(np.int64)


def read_block(page: bytes, block: int) -> np.ndarray:
    """The ids of one block of a page, without decoding the others."""
    _, blocks, words, wide = _parts(page)
    end = blocks[block + 1] if block + 1 < len(blocks) else len(words)
    return unpack_words(words[blocks[block] : end], wide)


def write_ids(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 2) -> None:
    """Writes the ids of all documents (doc_id, text) to ``path``, in ascending doc_id order.

    Files are Parquet tables of pages: part (number of the file), page, start (ids before it in the
    part), doc_ids, and the page itself. A null or empty text has the end id alone; null doc_ids come
    first; rows with equal doc_id stand next to each other in any order. No documents give no pages.
    """
    key = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(key)),
        T.StructField("ids", T.BinaryType()),
    ])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, page, start = TaskContext.get().partitionId(), 0, 0
        keys: list[pa.Array] = []
        texts: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal page, start
            ids = sum(map(len, texts))
            names = pa.concat_arrays(keys)
            held = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            row = [pa.array([part], pa.int32()), pa.array([page], pa.int32()), pa.array([start], pa.int64()), pa.array([ids], pa.int64()), held, pa.array([write_page(texts)], pa.binary())]
            page, start = page + 1, start + ids
            keys.clear()
            texts.clear()
            return pa.RecordBatch.from_arrays(row, schema.names)

        for batch in batches:
            for first, found in encode(batch.column(1), tokenizer):
                keep, size = first, sum(map(len, texts))
                for k, x in enumerate(found, first):
                    if size and size + len(x) >= PAGE_IDS:
                        keys.append(batch.column(0).slice(keep, k - keep))
                        yield flush()
                        keep, size = k, 0
                    texts.append(np.append(x, np.uint32(end_id)))
                    size += len(x) + 1
                keys.append(batch.column(0).slice(keep, first + len(found) - keep))
        if texts:
            yield flush()

    tie = F.monotonically_increasing_id()
    ordered = docs.select("doc_id", "text", tie.alias("tie")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    map_arrow(ordered.select("doc_id", "text"), write, schema).write.mode("overwrite").parquet(path)


def read_ids(pages: DataFrame, *, ids: bool = False) -> DataFrame:
    """One row per document of the pages of ``write_ids``: doc_id, start, n_tokens, ids_crc32 [, ids]."""
    key = pages.schema["doc_ids"].dataType.elementType
    fields = [T.StructField("doc_id", key), T.StructField("part", T.IntegerType())]
    fields += [T.StructField(n, T.LongType()) for n in ("within", "n_tokens", "ids_crc32")]
    fields += [T.StructField("ids", T.ArrayType(T.LongType()))] * ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found, lengths = read_page(batch.column(3)[k].as_py())
                ends = np.cumsum(lengths)
                raw = found.astype("<u4")
                crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                start = batch.column(1)[k].as_py() + ends - lengths
                columns = [batch.column(2)[k].values, pa.array(np.full(len(ends), batch.column(0)[k].as_py(), np.int32))]
                columns += [pa.array(x, pa.int64()) for x in (start, lengths, crc)]
                if ids:
                    offsets = pa.array(np.append(0, ends).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(found.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    rows = map_arrow(pages.select("part", "start", "doc_ids", "ids"), read, T.StructType(fields))
    totals = pages.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = totals.select("part", (F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids")).alias("before"))
    return rows.join(before, "part").select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids
    )
