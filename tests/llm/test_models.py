"""Quality rules, language identification, toxicity: exact statistics and held-out results."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpora import ODD, prose
from pyspark.sql import functions as F

from medallion.llm import langid, quality, toxicity
from medallion.llm.frames import is_held_out

SF = "/root/testdata/sf0.01"


def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times, covered = Counter(grams), set()
    for k, gram in enumerate(grams):
        if times[gram] > 1:
            covered.update(range(k, k + 5))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_the_definition(frame):
    rng = random.Random(6)
    texts = [*ODD, "a " * 80_000, "a b c d e f g " * 9_000] + ["a b c d e " * 7, "x\ny\nx\n \n \nx", "#*$%&|<> ok"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(150)]
    docs = frame([(n, t, 1) for n, t in enumerate(texts)], "doc_id long, text string, n_words int")
    rows = quality.statistics(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counted(texts[r["doc_id"]])
    assert quality.statistics(frame([])).collect() == []


def test_rules_tell_what_the_labels_tell(spark, frame):
    rng = random.Random(8)
    rows, labels = [], []
    for n in range(900):
        bad = n % 3 == 0
        text = prose(rng, rng.randrange(20, 60))
        if bad:
            text = text.replace(" ", "%%% ") if n % 2 else text.upper()
        rows.append((n, text))
        labels.append((n, 0 if bad else 1))
    docs, known = frame(rows), frame(labels[:600], "doc_id long, quality int")
    rules = quality.learn(quality.statistics(docs), known)
    assert 1 <= len(rules) <= quality.MOST_RULES and all(str(c) for r in rules for c in r)
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, known).collect()}
    right = sum(kept[n] == bool(q) for n, q in labels[600:])
    assert right >= 285


def test_no_labels_no_rules(frame):
    counts = quality.statistics(frame([(1, prose(random.Random(1), 30)), (2, None)]))
    for labels in ([], [(1, None)], [(1, 1)]):
        assert quality.learn(counts, frame(labels, "doc_id long, quality int")) == []
    rows = quality.judge(frame([(1, prose(random.Random(1), 30)), (2, None)]), frame([], "doc_id long, quality int")).collect()
    assert {(r["doc_id"], r["base_failed"], r["kept"]) for r in rows} == {(1, False, True), (2, True, False)}


def test_quality_uses_no_python(frame):
    plan = quality.judge(frame([(1, "a")]), frame([], "doc_id long, quality int"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct", plan)


# --- language ---


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_forward_pass_sums_all_segmentations():
    pieces = langid.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    texts = pa.array(["the cat", "der hund und", "the the"])
    model = langid.train(texts, np.array(["en", "de", "en"]), pieces, rounds=2)
    number = {p: k for k, p in enumerate(pieces)}

    def total(word, language):
        if not word:
            return 1.0
        return sum(model.chances[number[word[:n]], language] * total(word[n:], language) for n in range(1, len(word) + 1) if word[:n] in number)

    for data, start, end, _, _ in langid.words_of(texts):
        got = model.log_chances(data, start, end)
        for k, word in enumerate(b"the cat der hund und the the".split()):
            assert np.allclose(np.exp(got[k].astype(float)), [total(b" " + word, 0), total(b" " + word, 1)], rtol=1e-4)
    assert np.allclose(model.chances.sum(0), 1)


def test_languages_of_documents_held_out(documents):
    model = langid.fit(documents, public_tokenizers.path("piece_bpe_32k.model"))
    rows = langid.predict(documents, model).where(is_held_out()).select("lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.96 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts_have_a_defined_language(spark, frame):
    pieces = [bytes([b]) for b in range(256)]
    model = langid.train(pa.array(["abc", "xyz"]), np.array(["a", "x"]), pieces)
    docs = frame([(n, t, 0.5) for n, t in enumerate([*ODD, "123 !!", "ab ab", "漢"])], "doc_id long, text string, score double")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    texts = [*ODD, "123 !!", "ab ab", "漢"]
    for n, text in enumerate(texts):
        assert (found[n] == ("und", 0.0)) == (not any(c.isalpha() for c in text or ""))
    assert found[len(ODD) + 1][0] == "a"
    nothing = langid.train(pa.array([], pa.string()), np.array([], str), pieces)
    assert {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(frame([]), model).collect() == []


# --- toxicity ---


def labelled(rng, number):
    insults = ["grobian", "schuft", "lump"]
    texts, toxic = [], []
    for n in range(number):
        words = prose(rng, rng.randrange(5, 80), 300).split()
        if n % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(insults) + rng.choice(["", "e", "es", "isch"]))
        texts.append(" ".join(words))
        toxic.append(int(n % 4 == 0))
    return texts, toxic


def test_toxic_texts_held_out():
    rng = random.Random(11)
    texts, toxic = labelled(rng, 1200)
    model = toxicity.train(pa.array(texts[:800]), np.array(toxic[:800]), steps=250)
    scores = model.scores(pa.array(texts[800:]))
    right = ((scores >= toxicity.CUT) == np.array(toxic[800:], bool)).mean()
    assert right >= 0.97
    clean = " ".join(t for t, y in zip(texts, toxic, strict=True) if not y)
    assert model.scores(pa.array([f"{clean} {texts[0]}", clean])).tolist()[1] < toxicity.CUT
    assert len(model.scores(pa.array([], pa.string()))) == 0


def test_compact_windows_give_the_same_scores():
    rng = random.Random(12)
    texts, toxic = labelled(rng, 400)
    model = toxicity.train(pa.array(texts), np.array(toxic), steps=60)
    for hashes, begin, _ in toxicity.features(pa.array([*texts[:60], *[t for t in ODD if t is None or len(t) < 5000]])):
        assert np.allclose(model.logits(model.rows(hashes), begin), model.logits(*model.near_known(hashes, begin)), atol=1e-5)


def test_scores_of_a_table(spark, frame, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(documents.where(F.col("doc_id") < 700), labels)
    docs = frame([(n, t, "s") for n, t in enumerate(ODD)] + [(None, "x", "s")], "doc_id long, text string, score string")
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(ODD) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    empty = toxicity.fit(documents, labels.where("false"))
    assert {r["score"] for r in toxicity.score(docs, empty).collect()} == {0.5}
    assert toxicity.score(frame([]), model).collect() == []


def test_every_piece_of_the_vocabulary_can_be_used():
    pieces = langid.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert max(map(len, pieces)) > 8
    model = langid.train(pa.array([], pa.string()), np.array([], str), pieces)
    for piece in [p for p in pieces if p[:1] == b" " and p[1:].isalpha()][:3000]:
        data = np.frombuffer(piece[1:], np.uint8)
        size, found = model.spans(data, np.array([0]), np.array([len(data)]))
        assert pieces[found[size[0], size[0], 0]] == piece


def test_long_words_are_cut_between_characters():
    texts = ["漢字かな交じり文" * 40, "x" * 500, "é" * 13, "a" * 24, "ß" * 12, "z🙂" * 30]
    for text in texts:
        for data, start, end, *_ in langid.words_of(pa.array([text])):
            parts = [bytes(data[a:b]) for a, b in zip(start, end, strict=True)]
            assert b"".join(parts) == text.encode()
            assert all(0 < len(p) <= langid.LONGEST and p.decode() for p in parts)


def test_a_language_of_long_texts_only_is_learned(frame):
    rng = random.Random(2)
    long = lambda words: " ".join(rng.choice(words) for _ in range(9000))
    one, two = ["alba", "corda", "vento", "mare"], ["hyvä", "talo", "järvi", "kukka"]
    rows = [(k, long(one if k % 2 else two), "aa" if k % 2 else "bb") for k in range(24)]
    docs = frame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    assert model.languages == ["aa", "bb"]
    assert langid.predict(docs, model).where("lang <> lang_pred").isEmpty()
