"""Language of whole texts by unigram piece models, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary (and every byte, so any
text can be cut into pieces). A word's probability is the sum over all its segmentations, by a forward
pass over its bytes; expectation maximisation with the matching backward pass learns the pieces. Words
are ASCII-lower-cased runs without ASCII marks and digits, led by a space; a word of more than
``LONGEST`` bytes is scored in runs of at most that many, cut between characters. Every distinct word is
summed once per worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import is_held_out, map_arrow, sampled
from medallion.llm.text import byte_table, hash_spans, mix, slices, word_spans

LONGEST = 24
#: A piece of more bytes than a run and its space fits into none.
PIECE_BYTES = LONGEST + 1
#: Bounds of the training sample: texts of each language and of all, characters of a text.
MOST_TEXTS, MOST_IN_ALL, MOST_CHARS = 250, 64_000, 20_000
ROUNDS = 3
UNDETERMINED = "und"
#: Words whose sums a worker remembers.
CACHE_WORDS = 500_000
_TABLE = byte_table(separators=bytes(b for b in range(128) if not chr(b).isalpha()))
_MULTIPLIER = 0x9E3779B97F4A7C15
_INDEX_BITS = 22
_POWER = np.array([pow(_MULTIPLIER, k, 1 << 64) for k in range(LONGEST + 2)], np.uint64)
_INVERSE = np.array([pow(pow(_MULTIPLIER, -1, 1 << 64), k, 1 << 64) for k in range(LONGEST + 2)], np.uint64)


def vocabulary(path: str) -> list[bytes]:
    """The lower-cased pieces of a public SentencePiece file, and all bytes."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    words = set()
    for k in range(pieces.get_piece_size()):
        if not (pieces.is_control(k) or pieces.is_unknown(k) or pieces.is_byte(k)):
            words.add(pieces.id_to_piece(k).replace("▁", " ").encode().lower())
    return [bytes([b]) for b in range(256)] + sorted(w for w in words if 1 < len(w) <= PIECE_BYTES)


def words_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, start, end, each text's first word, whether it has a letter) of each slice."""
    for first, end, data, offsets in slices(column):
        start, stop, begin = word_spans(data, offsets, _TABLE)
        # A run may end up to three bytes early, at the border of a character.
        pieces = np.where(stop - start > LONGEST, -(-(stop - start) // (LONGEST - 3)), 1)
        if len(pieces) and pieces.max() > 1:
            low = np.repeat(start, pieces)
            nth = np.arange(len(low)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            last = np.repeat(np.cumsum(pieces), pieces) - 1 == np.arange(len(low))
            stop = np.where(last, np.repeat(stop, pieces), _between(data, low + (nth + 1) * (LONGEST - 3)))
            begin = np.append(0, np.cumsum(pieces))[begin]
            start = np.where(nth > 0, np.append(0, stop[:-1]), low)
        letters = np.append(0, np.cumsum((data < 128) & (_TABLE != 0)[data]))[offsets]
        has = np.diff(letters) > 0
        for k in np.flatnonzero(~has & (np.diff(begin) > 0)).tolist():
            has[k] = any(c.isalpha() for c in column[first + k].as_py())
        yield data, start, stop, begin, has


def _between(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The places, or the first byte of the character that each of them cuts."""
    for _ in range(3):
        inside = (data[np.minimum(places, len(data) - 1)] & 0xC0) == 0x80
        places = np.where(inside, places - 1, places)
    return places


@dataclass
class Model:
    languages: list[str]
    pieces: list[bytes]
    chances: np.ndarray  # (piece, language); the last row is no piece at all

    def __post_init__(self) -> None:
        self.remembered = np.empty(0, np.uint64)
        self.sums = np.empty((0, len(self.languages)), np.float32)
        hashes = np.array([_hash(p) for p in self.pieces], np.uint64)
        self.index = np.full(1 << _INDEX_BITS, len(self.pieces), np.int32)
        self.index[_slot(hashes[::-1])] = np.arange(len(self.pieces), dtype=np.int32)[::-1]
        # Pieces whose slot another piece holds have a small table of their own, wide enough for all of them.
        lost = np.flatnonzero(self.index[_slot(hashes)] != np.arange(len(self.pieces)))
        bits = 12
        while len(np.unique(hashes[lost] & np.uint64((1 << bits) - 1))) < len(lost):
            bits += 1
        self.rest = np.full(1 << bits, len(self.pieces), np.int32)
        self.rest[(hashes[lost] & np.uint64((1 << bits) - 1)).astype(np.int64)] = lost
        self.hashes = np.append(hashes, np.uint64(0))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash; the number of pieces where there is none."""
        piece = self.index[_slot(hashes)]
        other = self.rest[(hashes & np.uint64(len(self.rest) - 1)).astype(np.int64)]
        piece = np.where(self.hashes[piece] == hashes, piece, other)
        return np.where(self.hashes[piece] == hashes, piece, len(self.pieces))

    def spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words led by a space: their lengths, and the piece that ends at each byte by its size."""
        size = end - start + 1
        wide = int(size.max(initial=1))
        at = start[:, None] + np.arange(-1, wide - 1)
        letters = np.where(np.arange(wide) < size[:, None], _TABLE[data[np.clip(at, 0, len(data) - 1)]], np.uint64(0))
        letters[:, 0] = 33
        sums = np.zeros((len(start), wide + 1), np.uint64)
        np.cumsum(letters * _POWER[:wide], axis=1, out=sums[:, 1:])
        found = np.full((wide + 1, PIECE_BYTES + 1, len(start)), len(self.pieces), np.int32)
        for stop in range(1, wide + 1):
            for length in range(1, min(stop, PIECE_BYTES) + 1):
                hashes = mix((sums[:, stop] - sums[:, stop - length]) * _INVERSE[stop - length] + np.uint64(length))
                found[stop, length] = np.where(stop <= size, self.numbers(hashes), len(self.pieces))
        return size, found

    def forward(self, size: np.ndarray, found: np.ndarray) -> np.ndarray:
        """(byte, word, language): chance of all segmentations up to the byte."""
        sums = np.zeros((len(found), len(size), len(self.languages)))
        sums[0] = 1
        for stop in range(1, len(found)):
            for length in range(1, min(stop, PIECE_BYTES) + 1):
                sums[stop] += sums[stop - length] * self.chances[found[stop, length]]
        return sums

    def log_chances(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log of the summed chance of each word in each language."""
        out = np.empty((len(start), len(self.languages)), np.float32)
        order = np.argsort(end - start, kind="stable")
        for low in range(0, len(order), 4096):
            some = order[low : low + 4096]
            size, found = self.spans(data, start[some], end[some])
            out[some] = np.log(self.forward(size, found)[size, np.arange(len(some))])
        return out

    def scored(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """``log_chances`` with every distinct word summed once."""
        hashes = hash_spans(data, start, end, _TABLE)
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.remembered, distinct), max(len(self.remembered) - 1, 0))
        known = self.remembered[at] == distinct if len(self.remembered) else np.zeros(len(distinct), bool)
        sums = np.empty((len(distinct), len(self.languages)), np.float32)
        sums[known] = self.sums[at[known]]
        sums[~known] = self.log_chances(data, start[where[~known]], end[where[~known]])
        if len(self.remembered) + np.count_nonzero(~known) <= CACHE_WORDS:
            keys = np.concatenate([self.remembered, distinct[~known]])
            order = np.argsort(keys, kind="stable")
            self.remembered, self.sums = keys[order], np.concatenate([self.sums, sums[~known]])[order]
        return sums[inverse]

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: the share of the best language, tempered by the text's length."""
        names, scores = [], []
        for data, start, end, begin, has in words_of(column):
            each = np.zeros((len(start) + 1, len(self.languages)))
            if len(start):
                np.cumsum(self.scored(data, start, end), axis=0, out=each[1:])
            total = each[begin[1:]] - each[begin[:-1]]
            count = np.diff(begin)
            logits = total / np.sqrt(np.maximum(count, 1))[:, None]
            shares = np.exp(logits - logits.max(1, keepdims=True)) if len(self.languages) else np.ones((len(count), 0))
            best = shares.argmax(1) if len(self.languages) else np.zeros(len(count), int)
            told = has & (len(self.languages) > 0)
            names += [self.languages[b] if t else UNDETERMINED for b, t in zip(best.tolist(), told.tolist(), strict=True)]
            scores.append(np.where(told, 1 / np.maximum(shares.sum(1), 1), 0.0))
        return names, np.concatenate([*scores, np.empty(0)])


def _hash(piece: bytes) -> np.uint64:
    total = sum((b + 1) * int(_POWER[k]) for k, b in enumerate(piece)) % (1 << 64)
    return mix(np.array([(total + len(piece)) % (1 << 64)], np.uint64))[0]


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _INDEX_BITS)).astype(np.int64)


def train(texts: pa.Array, languages: np.ndarray, pieces: list[bytes], rounds: int = ROUNDS) -> Model:
    """Piece chances of each language by expectation maximisation over the texts' distinct words."""
    names = sorted(set(languages.tolist()))
    model = Model(names, pieces, np.append(np.full((len(pieces), len(names)), 1 / len(pieces)), np.zeros((1, len(names))), axis=0))
    label = np.searchsorted(np.array(names), languages) if names else np.empty(0, int)
    first, counted = 0, []
    for data, start, end, begin, _ in words_of(texts):
        mine = np.repeat(label[first : first + len(begin) - 1], np.diff(begin))
        first += len(begin) - 1
        _, where, inverse = np.unique(hash_spans(data, start, end, _TABLE), return_index=True, return_inverse=True)
        times = np.bincount(inverse * len(names) + mine, minlength=len(where) * len(names)).reshape(len(where), len(names))
        counted.append((data, start[where], end[where], times))
    for _ in range(rounds):
        expected = np.zeros((len(pieces) + 1, len(names)))
        for data, start, end, times in counted:
            order = np.argsort(end - start, kind="stable")
            for low in range(0, len(order), 4096):
                some = order[low : low + 4096]
                _expect(model, data, start[some], end[some], times[some], expected)
        expected[-1] = 0
        common = expected.sum(1, keepdims=True) + 1
        common[-1] = 0
        expected += 100 * common / common.sum()
        model.chances = expected / expected.sum(0, keepdims=True)
    return model


def _expect(model: Model, data, start, end, times, expected) -> None:
    """Adds how often each piece is expected in the words, weighted by their counts in each language."""
    size, found = model.spans(data, start, end)
    ahead = model.forward(size, found)
    behind = np.zeros_like(ahead)
    words = np.arange(len(size))
    behind[size, words] = times / ahead[size, words]
    for stop in range(len(found) - 1, 0, -1):
        for length in range(1, min(stop, PIECE_BYTES) + 1):
            piece = found[stop, length]
            real = piece < len(model.pieces)
            flow = behind[stop, real] * model.chances[piece[real]]
            behind[stop - length, real] += flow
            flow *= ahead[stop - length, real]
            for k in range(flow.shape[1]):
                expected[:, k] += np.bincount(piece[real], flow[:, k], len(expected))


def fit(docs: DataFrame, vocabulary_path: str) -> Model:
    """A model of docs (doc_id, text, lang), from a bounded sample of the rows to learn from.

    A hash of doc_id picks MOST_TEXTS rows of each language in the mean (all where fewer are there; fewer
    where so many languages would pass MOST_IN_ALL texts), and a window of MOST_CHARS characters of
    each longer text. Null languages, ids and texts are left out; without labelled rows no language
    is known and every text is undetermined.
    """
    beyond = F.length("text") - MOST_CHARS
    window = F.substring("text", F.pmod(F.xxhash64("doc_id"), beyond + 1).cast("int") + 1, F.lit(MOST_CHARS))
    text = F.when(beyond > 0, window).otherwise(F.col("text")).alias("text")
    known = ~is_held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    labelled = docs.select("doc_id", "text", "lang").where(known)
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    most = min(MOST_TEXTS, MOST_IN_ALL / max(len(counts), 1))
    picked = labelled.where(sampled("lang", {r["lang"]: most / r["n"] for r in counts}))
    found = picked.select("doc_id", text, "lang").toArrow().combine_chunks().sort_by("doc_id")
    texts = found.column("text").combine_chunks() if found.num_rows else pa.array([], pa.string())
    return train(texts, np.array(found.column("lang").to_pylist(), str), vocabulary(vocabulary_path))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred and score to docs; only the text is looked at. Columns of these names are replaced.

    Null texts and texts without a letter are undetermined, with score 0.
    """
    given = docs.drop("lang_pred", "score")
    schema = T.StructType([*given.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared, at = docs.sparkSession.sparkContext.broadcast(model), given.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, scores = model.predict(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return map_arrow(given, add, schema)
