from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from corpora import ODD, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from medallion.llm import packing, simple8b
from medallion.llm.tokens import encode

PIECES = ["a", "'s", "don't", "\n", "  ", "\t", "é", "é", "́", "漢", " ", "<|endoftext|>", "1", "!!", "\x1c", "ΣΑΣ", "　", "🙂", "A.b", "ß,", "ö-ö"]


def ids_of(path, texts):
    found = []
    for _, some in encode(pa.array(texts, pa.string()), path):
        found += [x.tolist() for x in some]
    return found


def wanted(path, texts):
    tool = Tokenizer.from_file(path)
    return [tool.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["word_bpe", "byte_bpe"])
def test_ids_equal_those_of_whole_texts(name, request):
    path = request.getfixturevalue(name)
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(14))) for _ in range(1500)]
    texts += [*ODD, prose(rng, 400)]
    assert ids_of(path, texts) == wanted(path, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(), max_size=6))
def test_any_text_gives_the_ids_of_the_library(word_bpe, byte_bpe, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for path in (word_bpe, byte_bpe):
        assert ids_of(path, texts) == wanted(path, texts)


# --- packing ---


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=25), st.just(40))
def test_plan_places_every_piece_once_and_without_gaps(counts, capacity):
    sequences, given_ = defaultdict(list), Counter()
    for length, first, end, sequence, each, offset in packing.plan(counts, capacity):
        assert given_[length] == first
        given_[length] = end
        for k in range(end - first):
            sequences[sequence + k // each].append((offset + k % each * length, length))
    assert given_ == Counter(counts)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    large = sum(n for k, n in counts.items() if 3 * k > capacity)
    total = sum(k * n for k, n in counts.items())
    assert len(sequences) <= max(large, total * 1.6 / capacity + 2)


def test_large_pieces_are_matched_with_the_largest_partner():
    places = packing.plan({60: 2, 41: 1, 40: 1, 35: 1, 5: 3}, 100)
    at = {(p[0], p[1]): (p[3], p[5]) for p in places}
    assert at[60, 0][0] == at[40, 0][0] and at[60, 1][0] == at[35, 0][0]


def packed(df):
    return [r.asDict() for r in df.collect()]


def test_packing_against_the_library(spark, frame, word_bpe):
    rng = random.Random(1)
    texts = [*ODD, *(prose(rng, rng.randrange(1, 900)) for _ in range(60)), prose(rng, 3000)]
    rows = [(n, t) for n, t in enumerate(texts)] + [(5, "twice"), (5, "twice"), (None, "no id")]
    docs = frame([(n, t, "x") for n, t in rows], "doc_id long, text string, piece string")
    result = packed(packing.pack(docs, word_bpe, capacity=512))
    ids = wanted(word_bpe, [t for _, t in rows])
    expected = Counter()
    for (n, _), x in zip(rows, ids, strict=True):
        x = np.array([*x, 1], "<u4")
        for piece, low in enumerate(range(0, len(x), 512)):
            part = x[low : low + 512]
            expected[n, piece, low, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in result) == expected
    by = defaultdict(list)
    for r in result:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 512
    assert len(by) <= sum(r["length"] for r in result) / 512 * 1.02 + 1


def test_ranks_do_not_depend_on_the_buckets(frame, word_bpe):
    docs = frame([(n, "same words here") for n in range(500)])
    pieces = packing.token_pieces(docs, word_bpe)
    for rows_per_task in (7, 100, 10_000):
        ranks = [r["rank"] for r in packing.ranked(pieces, rows_per_task).collect()]
        assert sorted(ranks) == list(range(500))


def test_sequences_hold_the_ids(frame, word_bpe):
    docs = frame([(1, "one two three"), (2, "four"), (3, None)])
    (row,) = packing.sequences(packing.pack(docs, word_bpe, ids=True)).collect()
    whole = {n: [*ids, 1] for n, ids in zip((1, 2, 3), wanted(word_bpe, ["one two three", "four", ""]), strict=True)}
    assert row["ids"] == [i for p in row["pieces"] for i in whole[p["doc_id"]]]


def test_packing_nothing(frame, word_bpe):
    assert packing.pack(frame([]), word_bpe).collect() == []


# --- Simple-8b ---


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=400), max_size=4))
def test_pages_round_trip(texts):
    page = simple8b.write_page([np.array(t, np.uint64) for t in texts])
    ids, lengths = simple8b.read_page(page)
    assert ids.tolist() == [i for t in texts for i in t]
    assert lengths.tolist() == [len(t) for t in texts]


def test_blocks_decode_alone_and_damage_is_seen():
    ids = np.arange(5000, dtype=np.uint64) * 13 % 50_257
    page = simple8b.write_page([ids[:3000], ids[3000:]])
    assert np.array_equal(simple8b.read_block(page, 2), ids[2048:3072])
    assert np.array_equal(simple8b.read_block(page, 4), ids[4096:])
    assert len(page) < 5000 * 8 / 2.5
    with pytest.raises(ValueError, match="whole"):
        simple8b.read_page(page[:100] + b"\x00" + page[101:])


def test_files_against_the_library(spark, frame, byte_bpe, tmp_path, monkeypatch):
    rng = random.Random(2)
    texts = [*ODD, *(prose(rng, rng.randrange(1, 300)) for _ in range(80))]
    rows = [(7 * n % 1009, t) for n, t in enumerate(texts)]
    docs = frame([(n, t, 1) for n, t in rows], "doc_id long, text string, start int")
    simple8b.write_ids(docs, str(tmp_path / "ids"), byte_bpe)
    result = sorted(packed(simple8b.read_ids(spark.read.parquet(str(tmp_path / "ids")), ids=True)), key=lambda r: r["doc_id"])
    start = 0
    ids = dict(zip((n for n, _ in rows), wanted(byte_bpe, [t for _, t in rows]), strict=True))
    assert len(result) == len(rows)
    for r in result:
        whole = [*ids[r["doc_id"]], 2]
        assert r["ids"] == whole and r["start"] == start and r["n_tokens"] == len(whole)
        assert r["ids_crc32"] == zlib.crc32(np.array(whole, "<u4").tobytes())
        start += len(whole)


def test_files_of_nothing_and_of_repeats(spark, frame, byte_bpe, tmp_path):
    simple8b.write_ids(frame([]), str(tmp_path / "none"), byte_bpe)
    pages = spark.read.schema("part int, page int, start long, n_ids long, doc_ids array<long>, ids binary").parquet(str(tmp_path / "none"))
    assert simple8b.read_ids(pages).collect() == []
    simple8b.write_ids(frame([(4, "a b"), (4, "a b"), (None, "c"), (4, "d e f")]), str(tmp_path / "same"), byte_bpe)
    got = simple8b.read_ids(spark.read.parquet(str(tmp_path / "same"))).collect()
    assert sorted((r["doc_id"] is None, r["start"]) for r in got)[-1] == (True, 0)
    ends = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(ends[:-1], ends[1:], strict=True))
