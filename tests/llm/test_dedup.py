"""Operators 1, 9 and 10 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from pitlake.llm import minhash
from pitlake.llm.components import components
from pitlake.llm.exact_dedup import exact_dedup_stage, exact_groups
from pitlake.llm.minhash import near_dedup_stage, near_groups
from pitlake.llm.substring import remove_repeats
from pitlake.llm.words import words_of


def order(rows):
    return sorted(rows, key=str)


# ------------------------------------------------------------------ exact dedup
def brute_exact(pairs):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in pairs]
    ids = {}
    for (i, _), t in zip(pairs, texts):
        ids.setdefault(t, []).append(i)
    out = []
    for (i, _), t in zip(pairs, texts):
        keep = min((x for x in ids[t] if x is not None), default=None)
        out.append((i, keep, len(ids[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return out


def test_exact_edges(edge_docs, edge_pairs, no_docs):
    assert order(map(tuple, exact_groups(edge_docs).collect())) == order(brute_exact(edge_pairs))
    assert exact_groups(no_docs).count() == 0


def test_exact_hot_group(spark):
    pairs = [(k, "copy" if k % 3 else f"text {k}") for k in range(3000)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    assert order(map(tuple, exact_groups(docs).collect())) == order(brute_exact(pairs))


def test_exact_collision_is_told_apart(spark, monkeypatch):
    import pitlake.llm.exact_dedup as m

    # every text gets the same hash: only the comparison of bytes can tell them apart
    class Same:
        def __getattr__(self, name):
            return (lambda c: m_f.md5(m_f.lit("x"))) if name == "md5" else getattr(m_f, name)

    m_f = m.F
    monkeypatch.setattr(m, "F", Same())
    pairs = [(1, "a"), (2, "b"), (3, "a")]
    got = m.exact_groups(spark.createDataFrame(pairs, "doc_id long, text string")).collect()
    assert order(map(tuple, got)) == order(brute_exact(pairs))


def test_exact_stage(spark, edge_docs, edge_pairs, no_docs):
    out = exact_dedup_stage(spark, edge_docs, "")
    assert out.columns == edge_docs.columns
    got = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in out.collect()]
    assert sorted(got) == sorted({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in edge_pairs})
    assert exact_dedup_stage(spark, no_docs, "").count() == 0


# ------------------------------------------------------------------ near dedup
def shingles(text):
    w = words_of(text, lower=True)
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_near(pairs):
    sets = [shingles(t) for _, t in pairs]
    own = list(range(len(pairs)))

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                own[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    out = []
    for k, (i, _) in enumerate(pairs):
        c = low.get(find(k))
        out.append((i, len(sets[k]), c, i == c))
    return out


def near_copies(seed=2, groups=12, size=8):
    rng = random.Random(seed)
    pairs = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(8, 200))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 30))):
                w[rng.randrange(len(w))] = f"n{rng.randint(0, 5000)}"
            pairs.append((len(pairs), " ".join(w)))
    return pairs


def test_near_against_all_pairs(spark):
    pairs = near_copies()
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    assert order(map(tuple, near_groups(docs).collect())) == order(brute_near(pairs))


def test_near_edges(edge_docs, edge_pairs, no_docs):
    # rows that repeat an id are one node: leave the repeated id of two texts out of the comparison
    got = [tuple(r) for r in near_groups(edge_docs).collect() if r.doc_id not in (113,)]
    want = [r for r in brute_near([p for p in edge_pairs if p[0] != 113])]
    assert order(got) == order(want)
    assert near_groups(no_docs).count() == 0


def test_near_chain_through_members(spark):
    """A chain whose ends are far apart is one component, though its members are not all near the smallest id."""
    rng = random.Random(3)
    w = [f"w{rng.randint(0, 9999)}" for _ in range(200)]
    pairs = []
    for k in range(10):
        pairs.append((k, " ".join(w)))
        for j in range(4):
            w[k * 20 + j * 5 + 2] = f"x{k}-{j}"
    got = {r.component_id for r in near_groups(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    assert got == {r[2] for r in brute_near(pairs)}


def test_near_stage(spark, no_docs):
    pairs = near_copies(5, 4, 5)
    docs = spark.createDataFrame([(*p, "en") for p in pairs], "doc_id long, text string, lang string")
    out = near_dedup_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(r[0] for r in brute_near(pairs) if r[3])
    assert near_dedup_stage(spark, no_docs, "").count() == 0


def test_near_repeated_id_with_two_texts(spark):
    """An id's texts have a component each: a link of either is found, and a clean text stays."""
    rng = random.Random(7)
    base = [[f"{g}{rng.randint(0, 9999)}" for _ in range(150)] for g in "abcd"]
    text, near = [" ".join(w) for w in base], [" ".join([*w[:149], "x"]) for w in base]
    # 13 has a near copy of 5 and a clean text; 20 has the first texts of two groups; 30 has two near texts
    pairs = [(5, text[0]), (13, near[0]), (13, text[1]), (20, text[2]), (20, "e f g h i j k"), (21, near[2]), (22, "e f g h i j  k"), (30, text[3]), (30, near[3])]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in near_dedup_stage(spark, docs, "").collect()}
    clean = {(5, text[0]), (13, text[1]), (20, text[2]), (20, "e f g h i j k")}
    assert clean < got and len(got) == len(clean) + 1 and max(got)[0] == 30
    rows = order((r.doc_id, r.component_id) for r in near_groups(docs).collect())
    assert rows == order([(5, 5), (13, 5), (13, 13), (20, 20), (20, 20), (21, 20), (22, 20), (30, 30), (30, 30)])


def test_signature_bound_is_below_threshold():
    assert 0.6 < minhash.AGREE / minhash.HASHES < 0.69


def test_signature_bound_loses_next_to_nothing():
    """The binomial tail below the bound for a pair at the threshold, whose bytes also agree by chance."""
    n, p = minhash.HASHES, 0.75 + 0.25 / 256
    assert sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(minhash.AGREE)) < 1e-6
    assert minhash.AGREE / n < 0.65


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(500, k) for k in range(501, 700)] + [(k, k + 1) for k in range(800, 840)]
    own = {x: x for e in edges for x in e}

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        own[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# ------------------------------------------------------------------ substring dedup
def brute_repeats(pairs, window):
    words = [words_of(t) for _, t in pairs]
    n = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(pairs, words):
        cover = [False] * len(w)
        for k in range(len(w) - window + 1):
            if n[tuple(w[k:k + window])] > 1:
                cover[k:k + window] = [True] * window
        kept = b" ".join(x for x, c in zip(w, cover) if not c)
        out.append((i, len(w), sum(cover), hashlib.sha256(kept).hexdigest()))
    return out


def test_substring_edges(edge_docs, edge_pairs, no_docs):
    assert order(map(tuple, remove_repeats(edge_docs).collect())) == order(brute_repeats(edge_pairs, 35))
    assert remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("window", [9, 12])
def test_substring_self_repeats(spark, window):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 50))) for _ in range(150)] + ["a " * 300]
    pairs = [(k // 2, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(5)
    got = remove_repeats(docs, window, texts=True).collect()
    assert order(tuple(r)[:4] for r in got) == order(brute_repeats(pairs, window))
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)
