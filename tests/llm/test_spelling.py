"""Operator 12 against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from pitlake.llm import spelling
from pitlake.llm.spelling import near_counts, spelling_groups


def one_edit(u, v):
    if abs(len(u) - len(v)) > 1 or u == v:
        return False
    if len(u) > len(v):
        u, v = v, u
    k = 0
    while k < len(u) and u[k] == v[k]:
        k += 1
    return u[k + 1:] == v[k + 1:] if len(u) == len(v) else u[k:] == v[k + 1:]


def brute_words(pairs):
    n = Counter()
    for i, t in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def brute_groups(n):
    out, form = [], {}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def vocabulary(seed, stems, shape):
    rng = random.Random(seed)
    out = {}
    for _ in range(stems):
        w = "".join(rng.choice(shape) for _ in range(rng.randint(6, 10)))
        out[w] = rng.randint(5, 5000)
        for _ in range(rng.randint(0, 5)):
            k, kind, c = rng.randrange(len(w) + 1), rng.randrange(3), rng.choice(shape)
            v = w[:k] + c + w[k:] if kind == 0 else w[:k] + w[k + 1:] if kind == 1 else w[:k] + c + w[k + 1:]
            if len(v) >= 6:
                out[v] = rng.randint(5, 200)
    return out


def found(spark, n):
    rows = near_counts(spark.createDataFrame(sorted(n.items()), "word string, n long")).collect()
    near, best = Counter(), {}
    for r in rows:
        near[r.word] += r.near
        best[r.word] = min(best.get(r.word, (r.less, r.best)), (r.less, r.best))
    return near, best


def expected(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    return Counter({w: len(v) for w, v in near.items() if v}), {w: min((-n[x], x) for x in v) for w, v in near.items() if v}


@pytest.mark.parametrize("shape", ["ab", "abcdefghij", "aàéÿz"])
def test_near_words_of_dense_lists(spark, shape):
    n = vocabulary(len(shape), 250, shape)
    assert found(spark, n) == expected(n)


def test_large_list_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 30)
    monkeypatch.setattr(spelling, "LOOKED_UP", 7)
    n = vocabulary(1, 300, "abc")
    assert found(spark, n) == expected(n)


def test_forms_and_roots(spark):
    words = {"colour": 900, "color": 9000, "colours": 100, "colurs": 6, "colouur": 20, "coloura": 20, "banane": 7, "bananes": 7}
    pairs = [(k, f"{w} ") for k, (w, c) in enumerate(words.items()) for _ in range(c)]
    docs = spark.createDataFrame([(i, t * 1) for i, t in pairs], "doc_id long, text string")
    assert sorted(map(tuple, spelling_groups(docs).collect())) == brute_groups(brute_words(pairs))


def test_damaged_runs_and_ids(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdÀé×") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    pairs = [(k if k % 7 else None, " ".join(rng.choice(words).upper() if k % 2 else rng.choice(words) for _ in range(40)) + "1" + rng.choice(words)) for k in range(400)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    got = sorted(map(tuple, spelling_groups(docs).collect()))
    assert got == brute_groups(brute_words(pairs)) and len(got) > 60


def test_spelling_edges(edge_docs, edge_pairs, no_docs):
    assert sorted(map(tuple, spelling_groups(edge_docs).collect())) == brute_groups(brute_words(edge_pairs))
    assert spelling_groups(no_docs).count() == 0


def test_very_long_words(spark):
    long = "x" * 30_000
    pairs = [(k, f"{long} {long}y {'x' * 15_000}y{'x' * 15_000}") for k in range(5)]
    got = {r.word[-1] + str(len(r.word)): r.n_near for r in spelling_groups(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    assert got == {"x30000": 2, "y30001": 1, "x30001": 1}
