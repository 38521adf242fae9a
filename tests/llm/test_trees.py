"""URL templates, conversation tries and centroid trees against brute force and their SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from corpora import ODD

from medallion.llm import centroids, oracle, prefix_trie, queries, url_filter

SF_DIR = "/root/testdata/sf0.001"


def text_rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("conversations", "documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    df = queries.queries()[name](spark, SF_DIR)
    wanted = con.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in wanted.description]
    assert text_rows(df.select(*columns)) == sorted(map(repr, wanted.fetchall()))


# --- conversations ---


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def brute_trie(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv_id].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, x) for *_, r, x in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + path[h:]
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children, leaves, saved, out = defaultdict(int), {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        own_saved = (len(members[node]) - 1) * (words(node[-1][1]) if node else 0)
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + own_saved
        up = node[:-1] if node else None
        if node:
            children[up] += 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
        ends = ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
        out.append((min(members[node]), len(node), None if up is None else min(members[up]), len(members[node]), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


def some_conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 2000), 400):
        first = rng.choice(["hello there", "hello", "", None])
        for t in range(rng.randrange(0, 6)):
            rows.append((c, t, rng.choice(["user", "bot"]) if t > 1 else "user", first if t < 2 else rng.choice(["a b", "c", "d e f"])))
    rows += [(c, t, "user", f"the same turn {t}") for c in range(5000, 5900) for t in range(3)]
    rows += [(7, None, None, None), (7, None, "ab", "c"), (7, None, "a", "bc"), (None, 1, "user", "x"), (7, 0, "user", "hello")] * 2
    rows += [(9000 + k, 0, "user", x) for k, x in enumerate(ODD)] + [(9100, t, "user", "one of many") for t in range(40)]
    return rows


def test_trie_equals_brute_force(frame):
    rows = some_conversations(3)
    table = frame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, depth int")
    assert text_rows(prefix_trie.prefix_trie(table)) == brute_trie(rows)


def test_turnless_conversations_and_no_conversations(frame):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(frame([], schema)).collect() == []
    assert prefix_trie.prefix_trie(frame([(None, 1, "a", "b")], schema)).collect() == []
    rows = [(c, 0, "user", "borrowed away") for c in range(21, 29)]  # heads are absent
    assert text_rows(prefix_trie.prefix_trie(frame(rows, schema))) == brute_trie(rows)


# --- centroids ---


def brute_clusters(rows, rule):
    usable = lambda e: e is not None and len(e) == rule.width and all(x is not None and math.isfinite(x) for x in e)
    kept = [(i, [math.floor(rule.scale * x) for x in e]) for i, e in rows if usable(e)]
    v = np.array([x for _, x in kept], np.int64).reshape(len(kept), rule.width)
    hashed = lambda i: hashlib.sha256(f"{rule.prefix}{'' if i is None else i}".encode()).hexdigest()
    first = sorted(range(len(kept)), key=lambda k: (hashed(kept[k][0]), kept[k][1]))[: rule.clusters]
    c = v[first].copy()
    for n in range(rule.rounds + 1):
        d = ((v[:, None] - c[None]) ** 2).sum(2)
        near = d.argmin(1)
        if n < rule.rounds:
            for k in range(len(c)):
                if (mine := v[near == k]).size:
                    c[k] = [int(t) // len(mine) for t in mine.sum(0)]
    d = d.min(1)
    shown = [hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest() for x in c]
    return sorted(repr((kept[k][0], int(near[k]), int(d[k]), int(d[near == near[k]].sum()), int(d.sum()), shown[near[k]])) for k in range(len(kept)))


@pytest.mark.parametrize(("width", "clusters", "values"), [(3, 12, 4), (3, 40, 2), (64, 25, 1000)])
def test_clusters_equal_brute_force(frame, width, clusters, values):
    rng = random.Random(width + values)
    rule = centroids.Rule(width=width, clusters=clusters, scale=1 if values < 9 else 256)
    point = lambda: [float(rng.randrange(-values, values + 1)) / (1 if values < 9 else values) for _ in range(width)]
    hot = point()
    rows = [(k, point() if k % 3 else hot) for k in range(900)] + [(5, point()), (None, point()), (None, point())]
    broken = [None, [], hot[1:], [*hot, 0.0], [None, *hot[1:]], [float("nan"), *hot[1:]], [float("inf"), *hot[1:]]]
    rows += [(2000 + k, e) for k, e in enumerate(broken)]
    table = frame([(i, e, 0, "x") for i, e in rows], "vec_id long, embedding array<float>, cluster int, v string")
    assert text_rows(centroids.clusters(table, rule)) == brute_clusters(rows, rule)


def test_few_vectors_and_none(frame):
    schema = "vec_id long, embedding array<float>"
    assert centroids.clusters(frame([], schema)).collect() == []
    rows = [(k, [float(k)] * 64) for k in range(5)]
    assert text_rows(centroids.clusters(frame(rows, schema))) == brute_clusters(rows, centroids.Rule())


def test_components_beyond_the_bound_count_as_the_bound(frame):
    rows = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)]
    got = centroids.clusters(frame(rows, "vec_id long, embedding array<float>"), centroids.Rule(clusters=1, rounds=0)).collect()
    assert max(r["distance"] for r in got) in (64 << 54, 64 << 56)


def test_tree_finds_the_smaller_number_of_equals():
    rng = np.random.default_rng(5)
    for width in (1, 2, 8):
        c = rng.integers(-2, 3, (33, width))
        v = rng.integers(-3, 4, (500, width))
        d = ((v[:, None] - c[None]) ** 2).sum(2)
        cluster, distance = centroids.VantageTree(c).nearest(v)
        assert (cluster == d.argmin(1)).all() and (distance == d.min(1)).all()


# --- urls ---


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(str(r)), default=None)


def kind(segment):
    stem = re.sub(r"\.[A-Za-z]{1,5}\Z", "", segment)
    marks = [re.search("[0-9]", stem) and "9", re.search(r"[^0-9\-_.~%+]", stem) and "a", re.search(r"[\-_.~%+]", stem) and "-"]
    return "{" + "".join(m or "" for m in marks) + ("+" if len(stem) > 32 else "") + ("." if len(stem) < len(segment) else "") + "}"


def differ(a, b):
    (n, p), (m, q) = a, b
    if not n or not m:
        return False
    both = (p + q) / (n + m)
    error = math.sqrt(both * (1 - both) * (1 / n + 1 / m))
    return bool(error) and abs(p / n - q / m) / error >= 2.0


def brute_urls(pages, rules, tree):
    rows = [(*split_url(url), bad) for _, url, bad in pages]
    cut = []
    for host, path, _ in rows:
        s = path.split("/")
        cut.append(s[: tree.depth] + (["{**}"] if len(s) > tree.depth else []))
    count, total = Counter(), Counter()
    for (host, *_), s in zip(rows, cut, strict=True):
        for k, x in enumerate(s):
            count[host, k, x] += 1
            total[host, k] += 1
    literal = lambda h, k, x: x in ("", "{**}") or (count[h, k, x] >= tree.least and count[h, k, x] >= tree.share * total[h, k])
    tokens = [tuple(x if literal(r[0], k, x) else kind(x) for k, x in enumerate(s)) for r, s in zip(rows, cut, strict=True)]
    node = dict.fromkeys(((r[0], t) for r, t in zip(rows, tokens, strict=True)), "")
    label = lambda keep: (sum(r[2] is not None for r in keep), sum(r[2] or 0 for r in keep))
    behind = defaultdict(list)
    for r, t in zip(rows, tokens, strict=True):
        behind[r[0], t].append(r)
    for k in range(max(map(len, tokens), default=0)):
        siblings = defaultdict(lambda: defaultdict(list))
        for (h, t), at in node.items():
            if len(t) > k:
                siblings[h, at][t[k]] += behind[h, t]
        names = {}
        for (h, at), found in siblings.items():
            order = sorted(found, key=lambda x: ((label(found[x])[1] + 1) / (label(found[x])[0] + 2), x.encode()))
            groups = [[order[0]]]
            for a, b in zip(order, order[1:], strict=False):
                groups.append([b]) if differ(label(found[a]), label(found[b])) else groups[-1].append(b)
            for group in groups:
                name = "|".join(sorted(group, key=str.encode))
                name = f"({name})" if len(group) > 1 else name
                names |= {(h, at, x): f"{at}/{name}" if k else name for x in group}
        for (h, t), at in list(node.items()):
            if len(t) > k:
                node[h, t] = names[h, at, t[k]]
    of = defaultdict(list)
    for r, t in zip(rows, tokens, strict=True):
        of[r[0], node[r[0], t]].append(r)
    n, bad = label(rows)
    every = bad / n if n else 0
    out = []
    for (page_id, _, _), r, t in zip(pages, rows, tokens, strict=True):
        labelled, bad = label([x for x in rows if x[0] == r[0]])
        host_share = (bad + tree.strength * every) / (labelled + tree.strength)
        labelled, bad = label(of[r[0], node[r[0], t]])
        purity = (bad + tree.strength * host_share) / (labelled + tree.strength)
        rule = rule_of(r[0], r[1], rules)
        verdict = ("block" if purity >= tree.cut else "allow") if rule is None else "allow" if rule.allow else "block"
        out.append((page_id, r[0], r[1], None if rule is None else str(rule), verdict, node[r[0], t]))
    return sorted(map(repr, out))


def some_urls(seed):
    rng = random.Random(seed)
    urls = []
    for k in range(600):
        host = rng.choice(["shop.test", "shop.test", "Blog.Example.net", "example.com", "news.org", "net", "notnet"])
        branch = rng.choice(["item", "spam", "en", "de", "fr", "user"])
        tail = rng.choice([str(k), f"{k}.html", f"a-title-{k}", "", "index", f"{k}/edit", "x" * 40])
        bad = None if k % 3 == 0 else int(rng.random() < (0.95 if branch == "spam" else 0.1))
        urls.append((k, f"{rng.choice(['http', 'https'])}://{host}/{branch}/{tail}{rng.choice(['', '?q=/a', '#x'])}", bad))
    odd = [None, "", "no mark", "://", "a://b", "a://B?x/y", "a://b#/c", "a:// /\n/é", "a://c://d/e", "http://net", "http://x.net/", "h://t/" + "s/" * 30, "h://t/{9}/(a|b)/"]
    return urls + [(900 + k, u, k % 2) for k, u in enumerate(odd)] + [(None, "http://net/", None), (3, urls[3][1], 1)] * 2


def test_url_verdicts_equal_brute_force(frame):
    pages = some_urls(8)
    table = frame([(*p, "x", "y") for p in pages], "page_id long, url string, bad int, host string, n string")
    tree = url_filter.Tree(depth=9)
    got = url_filter.judge(table, url_filter.RULES, tree)
    assert text_rows(got.drop("purity")) == brute_urls(pages, url_filter.RULES, tree)
    blocked = got.where("rule is null and verdict = 'block'")
    assert blocked.where("path like '/spam/%'").count() > 20
    assert blocked.where("path like '/item/%'").isEmpty()


def test_urls_without_labels_and_no_pages(frame):
    schema = "page_id long, url string, bad int"
    assert url_filter.judge(frame([], schema)).collect() == []
    got = url_filter.judge(frame([(k, u, None) for k, u, _ in some_urls(2)], schema)).where("rule is null")
    assert got.where("verdict <> 'allow'").isEmpty()
    all_null = [(None, None, None)] * 9
    assert {tuple(r) for r in url_filter.judge(frame(all_null, schema)).drop("purity").collect()} == {(None, "", "", None, "allow", "")}


def test_url_query_covers_every_page(spark):
    got = queries.queries()["op11_url_filter"](spark, SF_DIR)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()
    wanted = sorted((r["page_id"], *split_url(r["url"])) for r in pages)
    assert sorted(tuple(r)[:3] for r in got.collect()) == wanted
