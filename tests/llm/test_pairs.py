"""Near duplicates, components and decontamination against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from corpora import ODD, edited, prose

from medallion.llm import decontamination, near_dups
from medallion.llm.components import components


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def groups(rows, size, percent):
    """Least id of each row's component, by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (n, _) in enumerate(rows):
        if n is not None:
            least[find(k)] = min(least.get(find(k), n), n)
    return [(n, len(s), least.get(find(k))) for k, ((n, _), s) in enumerate(zip(rows, sets, strict=True))]


def found(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize(("words", "percent", "options"), [(3, 85, {}), (5, 80, {"pairwise": 2, "tile": 4, "closest": (1, 10**9)})])
def test_groups_equal_brute_force(frame, words, percent, options):
    rng = random.Random(words)
    bases = [prose(rng, rng.randrange(20, 300)) for _ in range(25)]
    texts = [*ODD, *bases, *bases[:5], *(b.upper() for b in bases[:3])]
    for base in bases:
        texts += [edited(rng, base, rng.randrange(1, 6)) for _ in range(rng.choice([0, 1, 4]))]
    texts += [edited(rng, bases[0], rng.randrange(1, 4)) for _ in range(60)]
    shared = prose(rng, 30)
    texts += [f"{shared} {prose(rng, 25)}" for _ in range(30)]
    ids = rng.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts, strict=True)) + [(ids[0], texts[30]), (None, bases[0]), (ids[3], texts[3])]
    docs = frame([(n, t, "k") for n, t in rows], "doc_id long, text string, key string")
    result = near_dups.near_duplicates(docs, near_dups.Similarity(words=words, percent=percent, **options))
    assert found(result) == Counter(groups(rows, words, percent))
    kept = result.where("first_row").groupBy("component_id").count().collect()
    repeated = {ids[0], ids[3], None}  # two groups each have this least id
    assert all(r["count"] == 1 for r in kept if r["component_id"] not in repeated)
    assert result.where("kept <> (doc_id = component_id)").isEmpty()


def test_no_documents_and_no_words(frame):
    rule = near_dups.Similarity()
    assert near_dups.near_duplicates(frame([]), rule).collect() == []
    rows = near_dups.near_duplicates(frame([(1, None), (2, ""), (3, " \n")]), rule).collect()
    assert {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in rows} == {(1, 1, 0), (2, 2, 0), (3, 3, 0)}


def test_rows_of_one_id_or_of_none(frame):
    rng = random.Random(11)
    base = [prose(rng, 60) for _ in range(40)]
    texts = base + [edited(rng, b, 1) for b in base] + base[:20]
    for ids in (lambda k: None, lambda k: 5, lambda k: k):
        rows = [(ids(k), t) for k, t in enumerate(texts)]
        result = near_dups.near_duplicates(frame(rows), near_dups.Similarity(words=3, percent=85))
        assert found(result) == Counter(groups(rows, 3, 85))
        assert result.where("first_row").count() == 40


def test_few_edges_are_finished_in_one_task_with_the_same_result(frame, monkeypatch):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1050)]
    table = frame(edges, "a long, b long")
    once = sorted(map(tuple, components(table).collect()))
    monkeypatch.setattr("medallion.llm.components.LOCAL_EDGES", 10)
    assert sorted(map(tuple, components(table).collect())) == once


def test_bands_miss_one_link_in_a_million():
    for rule in (near_dups.Similarity(), near_dups.Similarity(words=3, percent=85)):
        assert (1 - (rule.percent / 100) ** rule.rows) ** rule.bands <= 1e-6


def test_components(frame):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (20, 21), (1, 2)]
    edges += [(100 + k, 101 + k) for k in range(40)] + [(500, 501 + k) for k in range(200)]
    got = {r["node"]: r["root"] for r in components(frame(edges, "a long, b long")).collect()}
    assert {n: got[n] for n in (1, 2, 3, 7, 8, 9, 20, 21)} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20}
    assert all(got[100 + k] == 100 for k in range(41)) and all(got[500 + k] == 500 for k in range(201))
    assert components(frame([], "a long, b long")).collect() == []


# --- decontamination ---


def plain(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def weighted(words, size=5):
    size = min(size, len(words))
    out = Counter()
    for k in range(len(words) - size + 1):
        part = words[k : k + size]
        out[tuple(part)] += sum(len(w.encode()) for w in part)
    return out


def brute(docs, items, percent=80):
    hits = {}
    for d, text in docs:
        words = plain(text)
        for i, wording in items:
            want = plain(wording)
            if not want:
                continue
            goal = weighted(want)
            starts = range(max(1, len(words) - len(want) + 1))
            for s in starts:
                have = weighted(words[s : s + len(want)])
                common = sum((goal & have).values())
                if common * 100 >= percent * (sum(goal.values()) + sum(have.values()) - common):
                    hits[d, i] = max(hits.get((d, i), 0), common / (sum(goal.values()) + sum(have.values()) - common))
    return hits


def test_contaminated_equals_brute_force(frame):
    rng = random.Random(4)
    items = [(k, prose(rng, rng.randrange(12, 60))) for k in range(12)] + [(50, "tiny item"), (51, None), (52, ""), (53, "Of"), (54, "quantum zebra harvest protocol")]
    items += [(60, items[0][1]), (61, items[0][1].upper() + " !")]
    docs = [(900 + k, t) for k, t in enumerate(ODD)] + [(1000, "Tiny, item"), (1001, "a tiny item here, this tiny-item"), (1002, "of")]
    docs += [(1003, "so a Quantum Zebra harvest protocol indeed and more words here"), (1004, "quantum zebra harvest")]
    for k in range(60):
        text = prose(rng, rng.randrange(0, 80))
        if k % 2:
            wording = items[rng.randrange(12)][1]
            wording = edited(rng, wording, k % 3) if k % 4 == 3 else wording.title()
            text = f"{text} {wording}\n{prose(rng, 40)}"
        docs.append((k, text))
    docs += [(200 + k, f"{items[1][1]} {k}") for k in range(40)] + [(300, items[2][1][: len(items[2][1]) * 19 // 20])]
    table = frame([(d, t, 0) for d, t in docs], "doc_id long, text string, length int")
    rows = decontamination.contaminated(table, frame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    wanted = {(d, i): s for (d, i), s in brute(docs, items).items() if i not in (60, 61)}
    assert got.keys() == wanted.keys()
    assert all(abs(got[k] - wanted[k]) < 1e-9 for k in got)
    assert len(got) >= 45


def test_uneven_weights_are_found_as_brute_force_finds_them(frame):
    rng = random.Random(12)
    hashed = lambda size: "".join(rng.choice("0123456789abcdef") for _ in range(size))
    items, docs = [], []
    for k in range(60):
        text, size = prose(rng, rng.randrange(45, 60)), rng.randrange(40, 140)
        if k % 3 == 2:  # one shingle over and over
            text = f"{text} {'tick ' * rng.randrange(20, 40)}"
        items.append((k, f"{text} {hashed(size)}"))
        docs.append((k, f"{text} {hashed(size)} {prose(rng, 10)}"))
    table = frame([(d, t, 0) for d, t in docs], "doc_id long, text string, length int")
    rows = decontamination.contaminated(table, frame(items, "item_id long, text string")).collect()
    wanted = {}
    for d, i in zip(docs, items, strict=True):
        wanted |= brute([d], [i])
    assert {(r["doc_id"], r["item_id"]) for r in rows} == wanted.keys()
    assert len(wanted) >= 40


def test_no_documents_and_no_benchmark(frame):
    docs, items = frame([(1, "some text of five words")]), frame([(1, "one two three four five")], "item_id long, text string")
    none = frame([], "item_id long, text string")
    assert decontamination.contaminated(frame([]), items).collect() == []
    assert decontamination.contaminated(docs, none).collect() == []


def test_every_print_within_the_radius_is_found(spark, frame):
    rng = random.Random(9)
    rule = decontamination.Rule()
    base = [rng.getrandbits(64) for _ in range(30)]
    near = []
    for b in base:
        for flips in (0, 5, 15, 19, 20, 30):
            value = b
            for bit in rng.sample(range(64), flips):
                value ^= 1 << bit
            near.append(value)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    some = frame([(k, 30, signed(v)) for k, v in enumerate(near)], "window long, length long, print long")
    others = frame([(k, 30, signed(v)) for k, v in enumerate(base)], "item_id long, length long, print long")
    got = {(r["window"], r["item_id"]): r["hamming"] for r in decontamination.within_radius(some, others, rule).collect()}
    wanted = {(k, j): (v ^ b).bit_count() for k, v in enumerate(near) for j, b in enumerate(base) if (v ^ b).bit_count() <= rule.radius}
    assert got == wanted
