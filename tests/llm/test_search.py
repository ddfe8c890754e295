"""URL rules, top-k search, components, vector and text near copies against plain versions."""

import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from riskframe.llm import components, ngram_join, shingles, top_k, url_rules, vector_dedup
from riskframe.llm.url_rules import GlobAutomaton, GlobRule, HostRule


def glob_pattern(glob):
    parts = re.split(r"(\*\*|\*|\?)", glob)
    return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts), re.S)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab/.*?", max_size=12), min_size=1, max_size=30), st.lists(st.text(alphabet="ab/.", max_size=14), max_size=10))
def test_automaton(globs, texts):
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    found = GlobAutomaton(globs).fits(b"".join(data), offsets)
    assert found.tolist() == [[bool(glob_pattern(g).fullmatch(t)) for g in globs] for t in texts]


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://a.com", "http://A.COM/", "x://example.com/en/1?q#f", "x://www.example.com/en/",
            "x://b.net/es/", "x://net/fr/x", "x://evil.org/a.net/es/", "x://b.net?/es/", "x://b.org/a.exe", "x://casino-x.org",
            "x://y://b.net/es/", "x://é.net/fr/é", "x://b.org/" + "a" * 5_000 + ".exe"]
    rows = [(i, u, "c", "c") for i, u in enumerate(urls)] + [(4, "http://a.com", "c", "c"), (None, "x://b.net/es/", "c", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    rules = [HostRule("allow", "com", "/"), HostRule("block", "example.com", "/en/"), HostRule("allow", "www.example.com", "/en/"),
             HostRule("block", "net", "/es/"), HostRule("block", "net", "/fr/")]
    got = url_rules.judge_urls(pages, rules, [GlobRule("block", "**.exe"), GlobRule("block", "*casino-**")]).collect()

    def plain(url):
        if url is None or "://" not in url:
            host = path = ""
        else:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        other = (host + path).endswith(".exe") or "casino-" in host
        return host, path, rule and rule.name, rule.verdict if rule else "block" if other else "allow"
    want = [(r[0], *plain(r[1])) for r in rows]
    key = repr
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got), key=key) == sorted(want, key=key)
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_rules.judge_urls(pages, [], default="block").collect()} == {"block"}


VECTORS = [[0.5, -0.25, 0.0], [0.5, -0.25, 0.0], [0.0, 0.0, 0.0], None, [], [float("nan"), 1.0, 1.0], [1.0, None, 1.0],
           [float("inf"), 0.0, 0.0], [0.25, 0.5], [3e30, 1.0, -1.0], [-3e30, 1.0, 2.0], [1.0, 1.0, 1.0], [0.999, 1.0, 1.0]]


def test_top_k(spark):
    rows = [(i, v, i % 3, 9, 9) for i, v in enumerate(VECTORS)] + [(0, VECTORS[11], 0, 9, 9), (None, VECTORS[0], 0, 9, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score int, query_id int")
    from pyspark.sql import functions as F
    got = top_k.top_k(df, F.col("vec_id") % 4 == 0, 3, query_block=2, candidate_block=4).collect()
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, *_ in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in dict.fromkeys((i, tuple(v)) for i, v in ok if i % 4 == 0):
        scored = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, v)))), i) for i, v in ok if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:3])]
    assert sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in got) == sorted(want)
    assert top_k.top_k(df.limit(0), F.col("vec_id") % 4 == 0, 3).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 300, (170, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, None), (5000, 5000)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert components.connected_components(df.limit(0)).count() == 0


def closure(ids, linked):
    """Smallest id each id reaches, and links per id."""
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def test_vector_dedup(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((12, 16))
    near = np.repeat(base, 6, axis=0) + rng.standard_normal((72, 16)) * 0.12
    rows = [(i, list(map(float, v)), i % 2, 5) for i, v in enumerate(np.concatenate([near, near[:5]]))]
    rows += [(100, None, 1, 5), (101, [], 1, 5), (102, [0.0] * 16, 1, 5), (103, [float("nan")] * 16, 1, 5), (104, [None] * 16, 1, 5),
             (105, rows[0][1], None, 5), (106, rows[0][1][:8], 0, 5), (107, rows[0][1][:8], 0, 5), (None, rows[0][1], 0, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int").repartition(4)
    ok = [(i, np.array(v), l) for i, v, l, _ in rows if i is not None and l is not None and v and None not in v
          and np.isfinite(v).all() and np.any(v)]
    linked = [(a, b) for n, (a, v, l) in enumerate(ok) for b, w, m in ok[n + 1:] if l == m and len(v) == len(w)
              and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98]
    least = closure([r[0] for r in rows if r[0] is not None], linked)
    want = sorted(((i, sum(i in e for e in linked), least.get(i), least.get(i) == i and i is not None) for i, *_ in rows), key=repr)
    for block, small in ((3, 48), (2_048, 48), (2_048, 2)):
        vector_dedup._SMALL = small
        got = vector_dedup.dedup_vectors(df, block_rows=block).select("vec_id", "n_links", "component_id", "kept").collect()
        assert sorted(map(tuple, got), key=repr) == want
    vector_dedup._SMALL = 48
    assert len(linked) > 40 and vector_dedup.dedup_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [10, 17])
def test_vectors_at_the_limit_are_found(spark, bits):
    rng = np.random.default_rng(bits)
    base = rng.standard_normal((400, 24))
    base /= np.linalg.norm(base, axis=1)[:, None]
    other = rng.standard_normal((400, 24))
    other -= (other * base).sum(axis=1)[:, None] * base
    other /= np.linalg.norm(other, axis=1)[:, None]
    angle = np.arccos(rng.uniform(0.98001, 0.985, 400))[:, None]
    both = np.concatenate([base, np.cos(angle) * base + np.sin(angle) * other])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(both)], "vec_id long, embedding array<double>, label int")
    near = both @ both.T >= 0.98
    wanted = (near.sum() - len(both)) // 2
    got = vector_dedup.dedup_vectors(df, bits=bits).agg({"n_links": "sum"}).first()[0] // 2
    assert wanted >= 400 and got >= 0.999 * wanted
    assert vector_dedup.tables_for(12, 0.98, 1e-6) == 23 and vector_dedup.tables_for(20, 0.98, 1e-6) == 45


def shingle_set(text, n):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abAB é\t\n\x0b\x1c,", max_size=30), min_size=1, max_size=6))
def test_shingles(texts):
    import pyarrow as pa
    for n in (1, 3):
        got, want = shingles.shingle_sets(pa.array(texts), n), [shingle_set(t, n) for t in texts]
        assert [len(g) for g in got] == [len(w) for w in want]
        for a, x in zip(got, want):
            for b, y in zip(got, want):
                assert len(np.intersect1d(a, b)) == len(x & y)


def near_texts(rng, families, members, size, edits):
    out = []
    for _ in range(families):
        words = rng.integers(0, 500, size)
        for _ in range(members):
            own = words.copy()
            own[rng.integers(0, size, rng.integers(0, edits + 1))] = rng.integers(0, 500)
            out.append(" ".join(f"W{w}" for w in own))
    return out


@pytest.mark.parametrize("words, num, den, most_pairs, bits", [(3, 90, 100, 128, 20), (5, 8, 10, 128, 6), (2, 8, 10, 0, 4), (1, 6, 10, 10 ** 6, 3),
                                                               (2, 8, 10, 200, 2)])
def test_ngram_join(spark, words, num, den, most_pairs, bits):
    """Small sketches put most shingles into the frequent class, so that pairs, single keys and the border are all met."""
    rng = np.random.default_rng(words)
    texts = near_texts(rng, 12, 5, 60, 4) + near_texts(rng, 3, 12, 14, 2) + near_texts(rng, 2, 40, 9, 2)
    line = " ".join(f"c{i}" for i in range(12))
    texts += [f"{line} x{i} y{i % 3}" for i in range(25)]
    texts += [None, "", " \n ", "A b", "a  B", "a b", "one", "ONE", "a b c", texts[0], texts[0]]
    rows = [(i, t, "q", "q") for i, t in enumerate(texts)] + [(None, texts[0], "q", "q"), (3, "one two three four five six", "q", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, rep string").repartition(5)
    sets = [(i, shingle_set(t, words)) for i, t, *_ in rows if i is not None]
    linked = [(i, j) for n, (i, a) in enumerate(sets) for j, b in sets[n + 1:] if a and b
              and (den * len(a & b) >= num * len(a | b) or i == j)]
    least = closure({i for i, _ in sets}, linked)
    got = ngram_join.ngram_jaccard(df, words, num, den, sketch_bits=bits, most_pairs=most_pairs).collect()
    want = [(i, len(shingle_set(t, words)), least[i] if i is not None else None) for i, t, *_ in rows]
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == sorted(want, key=repr)


def test_ngram_join_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.ngram_jaccard(df).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in ngram_join.ngram_jaccard(one).collect()] == [(1, 0, 1)]


def test_ngram_join_ties_every_text_of_an_id(spark):
    texts = {3: "one two three four", 5: "five six seven eight", 7: "nine ten eleven twelve"}
    rows = [*texts.items(), *((9, t) for t in texts.values()), (11, "thirteen fourteen fifteen")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in ngram_join.ngram_jaccard(df, words=3).collect()}
    assert got == {(3, 3), (5, 3), (7, 3), (9, 3), (11, 11)}


def test_frequent_class_is_met():
    """The prefix of a small set of frequent shingles is indexed in pairs, of a long one by single shingles."""
    counts = np.full(60, 1_000)
    tokens = np.arange(60, dtype=np.uint64) + np.uint64(5)
    keys, often = ngram_join.prefix_keys(tokens[:20], counts[:20], 100, 8, 10, 128)
    assert often.all() and len(keys) == 6 * 5 // 2
    keys, often = ngram_join.prefix_keys(tokens, counts, 100, 8, 10, 10)
    assert often.all() and len(keys) == 13
    keys, often = ngram_join.prefix_keys(tokens, counts // 100, 100, 8, 10, 10)
    assert not often.any() and len(keys) == 13


def test_ngram_join_in_rounds_leaves_little_behind(spark, monkeypatch):
    """Sets are compared by rounds of heads with the same result; only the tables that the result reads stay on the disks."""
    from pathlib import Path

    rng = np.random.default_rng(8)
    texts = near_texts(rng, 12, 5, 60, 4) + near_texts(rng, 2, 40, 9, 2)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    stored, labels = ngram_join.store, []

    def store(rows, label="table", *a, **k):
        labels.append((label, stored(rows, label, *a, **k)))
        return labels[-1][1]

    monkeypatch.setattr(ngram_join, "store", store)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, found = spark.conf.get(name, "false"), []
    for most in (ngram_join._ROUND, 8):
        monkeypatch.setattr(ngram_join, "_ROUND", most)
        labels.clear()
        made = ngram_join.ngram_jaccard(df, words=3, num=7)
        left = {label for label, t in labels if Path(t.stored_at.removeprefix("file:")).exists()}
        assert left == {"survey", "members", "components"} and spark.conf.get(name, "false") == before
        found.append((sum(label == "links" for label, _ in labels), sorted(map(tuple, made.collect()))))
    assert found[1][0] > found[0][0] and found[0][1] == found[1][1]
