"""Licence notices in whole texts, by conditional compression and exact wording.

Words that only licences use mark candidate blocks of bounded length: the words around them, as far
as the templates reach. In a block, the stretches that hold enough of a template's words are compressed
plainly and with the template as a raw zstandard dictionary. What that saves ranks the templates; those
that save little of their own compressed size are dropped. The others are confirmed in the order of
their rank, word by word: few words may differ, and no telling word (a licence's name, version or
condition). Confirmed places are ranked by what is saved of their own words, and words that one of
higher rank has taken are not given to another.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import map_arrow

# Notices of common licences, in public wordings. Telling words stand in capitals.
TEMPLATES = (
    ("Apache-2.0", "licensed under the APACHE license version 2.0"),
    ("Apache-2.0", "licensed under the APACHE license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("MIT", "released under the MIT license"),
    ("MIT", "licensed under the MIT license"),
    ("MIT", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute SUBLICENSE and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("ISC", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("BSD-3-Clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution NEITHER the name of the copyright holder nor the names of its contributors may be used to ENDORSE or promote products derived from this software without specific prior written permission"),
    ("BSD-2-Clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("GPL-3.0", "this work is licensed under the GNU GENERAL public license version 3"),
    ("GPL-2.0", "this work is licensed under the GNU GENERAL public license version 2"),
    ("LGPL-3.0", "this work is licensed under the GNU LESSER general public license version 3"),
    ("AGPL-3.0", "this work is licensed under the GNU AFFERO general public license version 3"),
    ("GPL-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the GNU GENERAL public license as published by the free software foundation either version 3 of the license or at your option any LATER version"),
    ("GPL-2.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the GNU GENERAL public license as published by the free software foundation either version 2 of the license or at your option any LATER version"),
    ("MPL-2.0", "this source code form is subject to the terms of the MOZILLA public license v 2.0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("CC-BY-4.0", "licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "licensed under CC BY SA 4.0"),
    ("CC-BY-NC-4.0", "licensed under CC BY NC 4.0"),
    ("CC-BY-ND-4.0", "licensed under CC BY ND 4.0"),
    ("CC-BY-NC-SA-4.0", "licensed under CC BY NC SA 4.0"),
    ("CC-BY-4.0", "this work is licensed under a CREATIVE COMMONS attribution 4.0 international license"),
    ("CC0-1.0", "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this software to the PUBLIC DOMAIN worldwide"),
    ("Unlicense", "this is free and unencumbered software released into the PUBLIC DOMAIN"),
)
#: Hints in RE2's and Python's common syntax.
MARKS = r"\b(?:licen[sc]e[ds]?|sublicen[sc]e|redistributions?|unencumbered|public domain|permission is hereby|permission to use)\b"
_MARK = re.compile(MARKS, re.I)
#: Numbers, with a point inside, and words; hyphens part words.
_WORD = re.compile(r"[0-9]+(?:\.[0-9]+)?|[^\W\d_]+(?:'[^\W\d_]+)?")
_TELLING = re.compile(r"[0-9.]+|[A-Z]+")
#: Least share of a template's size saved, least share of words alike.
LEAST_SAVED, LEAST_ALIKE = 0.25, 0.9
#: A level that leaves literals as they are: all that a template saves is common wording.
LEVEL = -1
#: Words before and after a mark that belong to its block, beyond the template with its differing words.
MARGIN = 4


@cache
def _templates():
    import zstandard

    plain = zstandard.ZstdCompressor(level=LEVEL)
    out = []
    for name, text in TEMPLATES:
        raw = text.lower().encode()
        given = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words = text.split()
        telling = [k for k, w in enumerate(words) if _TELLING.fullmatch(w)]
        out.append((name, [w.lower() for w in words], telling, zstandard.ZstdCompressor(level=LEVEL, dict_data=given), len(plain.compress(raw))))
    return plain, out


def _blocks(words: int, marks: list[int], reach: int) -> list[tuple[int, int]]:
    """Runs of word numbers within reach of the marks: one for the marks less than reach after the first of them."""
    blocks: list[tuple[int, int]] = []
    first = None
    for k in marks:
        low, high = max(0, k - reach), min(words, k + reach + 1)
        if first is not None and k - first < reach:
            blocks[-1] = (blocks[-1][0], high)
        else:
            blocks.append((low, high))
            first = k
    return blocks


def _bounds(want: list[str]) -> tuple[int, int]:
    """Words of a stretch that must be the template's, and the greatest number of its words."""
    most = (1 - LEAST_ALIKE) * len(want) + 1e-9
    return math.ceil(len(want) - most), len(want) + int(most)


def _starts(codes: np.ndarray, need: int, width: int) -> np.ndarray:
    """Where stretches of ``width`` words begin that hold ``need`` of the template's; ``codes`` end with ``width`` others."""
    known = np.append(0, np.cumsum(codes >= 0))
    start = np.arange(len(codes) - width)
    return start[(codes[start] >= 0) & (known[start + width] - known[start] >= need)]


def _coded(have: list[str], want: list[str], width: int) -> tuple[np.ndarray, dict[str, int]]:
    codes = {w: k for k, w in enumerate(dict.fromkeys(want))}
    return np.array([codes.get(w, -1) for w in have] + [-1] * width), codes


def _stretches(have: list[str], want: list[str]) -> list[tuple[int, int]]:
    """Runs of words of a block in which the template could stand; overlapping ones are one."""
    need, width = _bounds(want)
    start = _starts(_coded(have, want, width)[0], need, width)
    if not len(start):
        return []
    breaks = np.flatnonzero(np.diff(start) > width) + 1
    return [(int(s[0]), min(int(s[-1]) + width, len(have))) for s in np.split(start, breaks)]


def _aligned(have: list[str], want: list[str], telling: list[int]) -> list[tuple[int, int, int]]:
    """(first word, end word, differing words) of each place where the wording stands in the block.

    Every stretch is aligned for most telling words, then most words alike; of stretches that overlap
    the one with fewest differing words stays.
    """
    most = (1 - LEAST_ALIKE) * len(want) + 1e-9
    need, width = _bounds(want)
    have_codes, codes = _coded(have, want, width)
    start = _starts(have_codes, need, width)
    near = have_codes[start[:, None] + np.arange(width)]
    # Greatest score of the template's words so far with each number of the stretch's words.
    score = np.zeros((len(start), width + 1), np.int64)
    heavy = width + 1
    for k, word in enumerate(want):
        gain = (near == codes[word]) * (1 + heavy * (k in telling))
        score[:, 1:] = np.maximum(score[:, 1:], score[:, :-1] + gain)
        np.maximum.accumulate(score, axis=1, out=score)
    alike = score % heavy
    differ = np.maximum(np.arange(width + 1), len(want)) - alike
    rows, sizes = np.nonzero((score // heavy == len(telling)) & (differ <= most))
    places = zip(differ[rows, sizes].tolist(), (-alike[rows, sizes]).tolist(), sizes.tolist(), start[rows].tolist(), strict=True)
    taken: list[tuple[int, int]] = []
    found = []
    for wrong, _, size, first in sorted(places):
        if _add_free(taken, first, first + size):
            found.append((first, first + size, wrong))
    return found


def _add_free(taken: list[tuple[int, int]], low: int, high: int) -> bool:
    """Puts the run into the ordered runs if it overlaps none of them."""
    k = bisect_left(taken, (low, high))
    if (k and taken[k - 1][1] > low) or (k < len(taken) and taken[k][0] < high):
        return False
    taken.insert(k, (low, high))
    return True


def _saved(words: list[str], given, plain) -> int:
    """Bytes that a template's dictionary saves of the words' own compressed size."""
    raw = " ".join(words).encode()
    return len(plain.compress(raw)) - len(given.compress(raw))


def notices(text: str) -> list[tuple[str, int, int, float, int]]:
    """(licence, start, end, share of the template saved, differing words) of the notices of a text.

    Of wordings confirmed over the same words, the one whose dictionary saves most stays.
    """
    starts = [m.start() for m in _MARK.finditer(text)]
    if not starts:
        return []
    words = list(_WORD.finditer(text))
    lower = [w[0].lower() for w in words]
    number = {w.start(): k for k, w in enumerate(words)}
    marks = [number[s] for s in starts if s in number]
    plain, templates = _templates()
    found = set()
    for reach in sorted({8, *(16 * -(-len(t[1]) // 16) for t in templates)}):
        mine = [t for t in templates if (reach == 8 and len(t[1]) <= 8) or (reach > 8 and len(t[1]) > 8 and 16 * -(-len(t[1]) // 16) == reach)]
        for low, high in _blocks(len(words), marks, reach + reach // 10 + MARGIN) if mine else ():
            have = lower[low:high]
            bag = Counter(have)
            ranked = []
            for k, (_, want, _, given, whole) in enumerate(mine):
                # A place has at least so many of the template's words.
                if sum((Counter(want) & bag).values()) < LEAST_ALIKE * len(want) - 1e-9:
                    continue
                for a, b in _stretches(have, want):
                    saved = _saved(have[a:b], given, plain)
                    if saved >= LEAST_SAVED * whole:
                        ranked.append((saved, k, a, b))
            for _, k, a, b in sorted(ranked, reverse=True):
                name, want, telling, given, whole = mine[k]
                for first, end, differ in _aligned(have[a:b], want, telling):
                    saved = _saved(have[a + first : a + end], given, plain)
                    found.add((saved, -differ, end - first, name, low + a + first, low + a + end, saved / whole))
    out: list[tuple[str, int, int, float, int]] = []
    taken: list[tuple[int, int]] = []
    for _, differ, _, name, a, b, share in sorted(found, reverse=True):
        if _add_free(taken, a, b):
            out.append((name, words[a].start(), words[b - 1].end(), share, -differ))
    return sorted(out, key=lambda f: f[1])


def find_licenses(docs: DataFrame) -> DataFrame:
    """One row per licence notice in docs (doc_id, text): license, start and end (code points), saved, differing.

    Null and empty texts have none; rows that repeat give their notices again. Other columns are not read.
    """
    schema = T.StructType([
        docs.schema["doc_id"],
        T.StructField("license", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("saved", T.DoubleType()),
        T.StructField("differing", T.LongType()),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = pc.fill_null(pc.match_substring_regex(batch.column(1), MARKS, ignore_case=True), False)
            some = batch.filter(marked)
            rows = [(k, *n) for k, text in enumerate(some.column(1).to_pylist()) for n in notices(text)]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            keys = some.column(0).take(pa.array(columns[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True))], schema.names)

    return map_arrow(docs.select("doc_id", "text"), scan, schema)


def per_document(found: DataFrame) -> DataFrame:
    """doc_id and the list of its notices, from rows of ``find_licenses``."""
    notice = F.struct("start", "end", "license", "saved", "differing")
    return found.groupBy("doc_id").agg(F.sort_array(F.collect_list(notice)).alias("notices"))
