"""The n-gram join, substring dedup and components against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewright.llm import batches, components as stars, ngram_join, substring
from tidewright.llm.components import connected_components
from tidewright.llm.ngram_join import boundary, needed, ngram_jaccard_join, subset_keys, subset_shapes
from tidewright.llm.substring import substring_dedup
from tidewright.llm.words import LOWER
from tidewright.store import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = [x.encode().translate(LOWER) for x in WORD.findall(text or "")]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    """Least id reachable over pairs of sets that overlap by 3/4."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def corpus(rng):
    """Texts with copies, near copies, hot passages, short sets, white space and upper case."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    passage, license_ = " ".join(word() for _ in range(30)), " ".join(word() for _ in range(12))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 6, 8, 12, 20, 60, 120]))]
        for _ in range(rng.randint(1, 5)):
            near = base.copy()
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                near[rng.randrange(len(near))] = word()
            sep = rng.choice([" ", "  ", "\n", "\t "])
            text = sep.join(near)
            texts.append(text.upper() if rng.random() < 0.2 else text)
    hot = [word() for _ in range(50)]
    for _ in range(30):
        near = hot.copy()
        near[rng.randrange(50)] = word()
        texts.append(" ".join(near))
    texts += [license_ + " " + " ".join(word() for _ in range(rng.randint(0, 6))) for _ in range(30)]
    texts += [passage + " " + " ".join(word() for _ in range(20)) for _ in range(10)] + ["a b c d e f"] * 12 + ["a b c d e f g"] * 3 + ["x", "x", "X y", "", " \n", None, "w" * 6000, "w" * 6000]
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus(random.Random(11)) + [(None, "a b c d e f"), (0, "only a repeated id of its own words"), (6, None)]


def test_join(spark, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 4)
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    own = [(i, t) for i, t in rows[:-2]]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in own], "doc_id long, text string, component_id int, n string")
    got = ngram_jaccard_join(df).collect()
    want = components(own)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == sorted(((i, len(shingles(t)), want.get(i)) for i, t in own), key=repr)


def test_join_with_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (5, text), (7, text), (9, text + " x"), (9, "other words"), (11, "other words")]
    got = ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (7, 5), (9, 5), (9, 5), (11, 5)]


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_jaccard_join(empty).collect() == [] and substring_dedup(empty).collect() == []


def test_light_sets_need_no_verification():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        n, m = rng.integers(1, 10, 2)
        a = rng.choice(12, min(n, 12), replace=False).astype(np.uint64)
        b = rng.choice(12, min(m, 12), replace=False).astype(np.uint64)
        a, b = np.sort(a), np.sort(b)
        link = 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
        (small_a, large_a), (small_b, large_b) = (map(set, subset_keys(x)) for x in (a, b))
        assert bool(small_a & (small_b | large_b) or small_b & large_a) == link


def test_needed_and_boundary():
    assert all((7 * i >= 3 * (s + t)) == (i >= needed(s, t)) for s in range(1, 30) for t in range(1, 30) for i in range(30))
    assert all(k <= s <= n <= t or k <= s <= t == n for n in range(1, 30) for s, t, k in subset_shapes(n))
    assert 1 <= boundary([0] * 60) <= boundary([10] * 60) <= 24


def test_substrings(spark, rows):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, keys int")
    got = substring_dedup(df).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("h"), "spans").collect()
    seen = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for j in range(len(w) - 12):
            if i is not None:
                key = tuple(w[j : j + 13])
                seen[key] = min(seen.get(key, i), i)
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if i is not None and seen[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        want.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.h) for r in got), key=repr) == sorted(want, key=repr)
    # factors are those of a naive greedy parse against first occurrences, and decode
    first, text = {}, {i: WORD.findall(t or "") for i, t in rows[:-2] if i is not None}
    for i in sorted(text):
        for j in range(len(text[i]) - 12):
            first.setdefault(tuple(text[i][j : j + 13]), (i, j))
    some = 0
    for r in got:
        if r.doc_id is None or [i for i, _ in rows].count(r.doc_id) > 1:
            continue
        w, j, factors = text[r.doc_id], 0, []
        while j <= len(w) - 13:
            source, place = first[tuple(w[j : j + 13])]
            n = 13
            if source >= r.doc_id:
                j += 1
                continue
            while j + n < len(w) and first[tuple(w[j + n - 12 : j + n + 1])] == (source, place + n - 12):
                n += 1
            factors.append((j, n, source, place))
            j += n - 12
        assert [tuple(s) for s in r.spans] == factors
        assert all(w[a : a + n] == text[i][p : p + n] for a, n, i, p in factors)
        assert len({a + x for a, n, *_ in factors for x in range(n)}) == r.n_removed
        some += len(factors)
    assert some > 20


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, x) for x in range(501, 560)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert {n: got.get(n, n) for n in root} == {n: find(n) for n in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("module, run", [(substring, substring_dedup), (ngram_join, ngram_jaccard_join)])
def test_buckets_grow_by_bits(spark, monkeypatch, module, run):
    """A corpus a little too large for 256 buckets asks at most 512, and gets the same rows."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(40_000)}" for _ in range(250)) for _ in range(8)]
    df = spark.createDataFrame(list(enumerate([*texts, *texts[:2]])), "doc_id long, text string").coalesce(1)
    want, asked = sorted(run(df).collect()), {}

    def count(table, name):
        out = written(table, name)
        asked[name] = out.count()
        return out

    monkeypatch.setattr(module, "written", count)
    # 2,500 words: 313 buckets are needed
    monkeypatch.setattr(batches, "BUCKET_KEYS", 8)
    assert sorted(run(df).collect()) == want
    assert 256 < next(n for name, n in asked.items() if name.endswith("-replies")) <= 512


def count_written(monkeypatch, *modules):
    """Names of the tables that the modules write."""
    names = []

    def count(table, name):
        names.append(name)
        return written(table, name)

    for module in modules:
        monkeypatch.setattr(module, "written", count)
    return names


def test_few_edges_take_no_rounds(spark, monkeypatch):
    """A long chain is put together at once, with the components that rounds of stars find."""
    rng = random.Random(5)
    names = rng.sample(range(-500, 500), 300)
    edges = [*zip(names[:200], names[1:201], strict=True), *((names[200], x) for x in names[201:260]), *((rng.choice(names[260:]), rng.choice(names[260:])) for _ in range(30)), (None, 1), (7, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    tables = count_written(monkeypatch, stars)
    got = sorted(connected_components(df).collect())
    assert len(tables) == 2
    monkeypatch.setattr(stars, "FEW_EDGES", 0)
    assert sorted(connected_components(df).collect()) == got and len(tables) > 6
    assert connected_components(df.limit(0)).collect() == []


def test_join_of_few_and_of_many(spark, rows, monkeypatch):
    """Few links and few pairs take a bounded number of tables; the ways for many give the same rows."""
    df = spark.createDataFrame([(i, t) for i, t in rows[:-2]], "doc_id long, text string")
    tables = count_written(monkeypatch, stars, ngram_join, batches)
    got = sorted(ngram_jaccard_join(df).collect(), key=repr)
    # 9 before the rounds; keys, pairs, lists and components of each round; what is left at the end
    assert len(tables) <= 11 + 5 * ngram_join.PIVOT_ROUNDS + 4
    monkeypatch.setattr(stars, "FEW_EDGES", 0)
    monkeypatch.setattr(ngram_join, "FEW_SHINGLES", 0)
    assert sorted(ngram_jaccard_join(df).collect(), key=repr) == got
