"""Ids of whole texts by a public tokenizer, with every distinct word encoded once per worker.

The tokenizers never merge over the cuts made here, so encoding the pieces of a text one by one gives
the ids of the whole text. Pieces are words for ``word_bpe`` files, which drop white space, and runs
of white space with the word after them for ``byte_bpe`` files; marks after a letter are cut off. Texts holding what could reach over a
cut (white space outside ASCII, control separators, special tokens) are encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np
import pyarrow as pa

from medallion.llm.text import RAW_TABLE, WORD_TABLE, hash_spans, slices, word_spans
from medallion.llm.workers import forgets

#: Distinct pieces remembered by one worker; later ones are encoded each time they are met.
CACHE_PIECES = 500_000
_WHOLE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|<\|"
)


_ASCII = [chr(b) for b in range(128)]
_LETTER = np.array([c.isalpha() for c in _ASCII] + [False] * 128)
_MARK = np.array([c.isprintable() and not c.isalnum() and c not in " '" for c in _ASCII] + [False] * 128)


def mark_cuts(data: np.ndarray) -> np.ndarray:
    """Where an ASCII mark follows a letter of ASCII or Latin-1: both tokenizers cut there too."""
    letter = _LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cuts = np.zeros(len(data), bool)
    cuts[1:] = letter[:-1] & _MARK[data[1:]]
    return cuts


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated start, start + 1, ... of each of the runs."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - count), count)


class PieceEncoder:
    """Encoder of one tokenizer file, kept by a Python worker over its tasks."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words_only = "word_bpe" in os.path.basename(path)
        self.keys = np.empty(0, np.uint64)
        self.start = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)

    def whole(self, text: bytes) -> np.ndarray:
        ids = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, np.uint32)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [], np.empty(len(texts), np.int64)
        for low in range(0, len(texts), 5_000):
            for k, x in enumerate(self.tokenizer.encode_batch(texts[low : low + 5_000], add_special_tokens=False)):
                got = x.ids
                counts[low + k] = len(got)
                ids.extend(got)
        return np.array(ids, np.uint32), counts

    def pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and the number of each."""
        hashes = hash_spans(data, start, end, WORD_TABLE if self.words_only else RAW_TABLE)
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == distinct[known]
        new = np.flatnonzero(~known)
        raw = data.tobytes() if len(new) else b""
        spans = zip(start[where[new]].tolist(), end[where[new]].tolist(), strict=True)
        ids, counts = self._encode([raw[a:b].decode("utf-8", "replace") for a, b in spans])
        pool = np.concatenate([self.pool, ids])
        begin, count = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        begin[known], count[known] = self.start[at[known]], self.count[at[known]]
        begin[new], count[new] = len(self.pool) + np.cumsum(counts) - counts, counts
        if len(self.keys) + len(new) <= CACHE_PIECES:
            keys = np.concatenate([self.keys, distinct[new]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.pool = keys[order], pool
            self.start = np.concatenate([self.start, begin[new]])[order]
            self.count = np.concatenate([self.count, count[new]])[order]
        number = count[inverse]
        return pool[ranges(begin[inverse], number)], number

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of one slice."""
        start, end, first = word_spans(data, offsets, WORD_TABLE, mark_cuts(data))
        if not self.words_only:
            start = np.concatenate([[0], end[:-1]]) if len(end) else start
            opens = first[:-1][first[1:] > first[:-1]]
            start[opens] = offsets[:-1][first[1:] > first[:-1]]
        ids, number = self.pieces(data, start, end)
        at = np.concatenate([[0], np.cumsum(number)])[first]
        out = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        raw = data.tobytes()
        if not self.words_only:
            last = np.where(first[1:] > first[:-1], np.append(end, 0)[first[1:] - 1], offsets[:-1])
            for k in np.flatnonzero(last < offsets[1:]).tolist():
                out[k] = np.concatenate([out[k], self.whole(raw[last[k] : offsets[k + 1]])])
        if odd := [m.start() for m in _WHOLE.finditer(raw)]:
            for k in np.unique(np.searchsorted(offsets, odd, side="right") - 1).tolist():
                out[k] = self.whole(raw[offsets[k] : offsets[k + 1]])
        return out


@cache
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


forgets(encoder.cache_clear)


def encode(column: pa.Array, path: str):
    """(first row, ids of each text) of one slice after the other."""
    tool = encoder(path)
    for first, _, data, offsets in slices(column):
        yield first, tool.texts(data, offsets)
