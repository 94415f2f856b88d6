"""Operator 11 against all pairs of fingerprints."""

import random
import re

import numpy as np
import pytest
import xxhash

from pitlake.llm import simhash
from pitlake.llm.simhash import links, simhash_groups

WHITE = " \t\n\v\f\r"


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in WHITE:
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes):
    """The least node that each node reaches over steps of at most four bits."""
    todo, out = set(nodes), {}
    while todo:
        seen, ahead = set(), [todo.pop()]
        while ahead:
            x = ahead.pop()
            seen.add(x)
            step = {y for y in todo if (x ^ y).bit_count() <= 4}
            todo -= step
            ahead += step
        out.update({x: min(seen) for x in seen})
    return out


def brute_groups(pairs):
    prints = [brute_fingerprint(t) for _, t in pairs]
    comp = brute_components(set(prints))
    ids = {}
    for (i, _), p in zip(pairs, prints):
        if i is not None:
            ids[comp[p]] = min(i, ids.get(comp[p], i))
    return [(i, f"{p:016x}", ids.get(comp[p])) for (i, _), p in zip(pairs, prints)]


def clusters(seed, centers, size, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(centers):
        x = rng.getrandbits(64)
        for _ in range(size):
            y = x
            for _ in range(rng.randint(0, flips)):
                y ^= 1 << rng.randrange(64)
            out.add(y)
    return sorted(out)


def groups_of(pairs):
    groups = []
    for p in pairs:
        touched = [g for g in groups if g & p]
        groups = [g for g in groups if not g & p] + [set(p).union(*touched)]
    return sorted(map(sorted, groups))


def linked_components(spark, prints):
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    rows = links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    parent = {x: x for x in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    mask = (1 << 64) - 1
    for u, v in rows:
        assert ((u ^ v) & mask).bit_count() <= 4
        a, b = sorted((find(u & mask), find(v & mask)))
        parent[b] = a
    return {x: find(x) for x in prints}


@pytest.mark.parametrize("centers,size,flips", [(60, 12, 4), (2, 300, 6), (300, 2, 9)])
def test_links_join_what_all_pairs_join(spark, centers, size, flips):
    prints = clusters(centers, centers, size, flips)
    assert linked_components(spark, prints) == brute_components(prints)


def test_every_pair_within_four_bits_shares_a_cell(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(400):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(1, 4)):
            y ^= 1 << b
        pairs.append((x, y))
    prints = sorted({x for p in pairs for x in p})
    found = linked_components(spark, prints)
    assert all(found[x] == found[y] for x, y in pairs)


def test_large_cell_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    prints = clusters(8, 1, 500, 5)
    assert linked_components(spark, prints) == brute_components(prints)


def test_entries_of_a_large_cell_travel_a_bounded_number_of_times(spark, monkeypatch):
    prints = clusters(8, 1, 500, 5)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    monkeypatch.setattr(simhash, "BLOCK", 10)
    monkeypatch.setattr(simhash, "BLOCKS", 4)
    dealt = links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    assert re.search(r"least\(.{0,12}ceil", dealt._jdf.queryExecution().optimizedPlan().toString().lower())
    assert linked_components(spark, prints) == brute_components(prints)


def test_entries_of_small_cells_are_not_copied(spark):
    signed = np.array(clusters(60, 60, 12, 4), np.uint64).view(np.int64).tolist()
    plan = links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    assert "Generate" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_rows_dealt_do_not_depend_on_how_many_meet(spark):
    """Entries alone in a cell are not told apart by a join, whose rows would grow with the crowding."""
    signed = np.array(clusters(60, 60, 12, 4), np.uint64).view(np.int64).tolist()
    plan = links(spark.createDataFrame([(x,) for x in signed], "fp long"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Filter" not in plan


def test_cells_of_all_sizes_give_what_all_pairs_give():
    rng = random.Random(9)
    cells = [clusters(k, 1, size, 4)[:size] for k, size in enumerate([1, 2, 1, 1, simhash.SMALL, 60, 1, 3, simhash.SMALL + 1, 1])]
    at = np.cumsum([0] + [len(c) for c in cells])[:-1]
    fp = np.array([x for c in cells for x in c], np.uint64)
    home = np.array([rng.random() < 0.5 for _ in fp])
    a, b = simhash.cell_links(at, fp, home)
    got = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    for begin, c in zip(at.tolist(), cells):
        ok = {frozenset((x, y)) for i, x in enumerate(c) for j, y in enumerate(c[:i])
              if (x ^ y).bit_count() <= 4 and (home[begin + i] or home[begin + j])}
        mine = {p for p in got if p <= set(c)}
        assert mine <= ok and groups_of(mine) == groups_of(ok)
    assert not {p for p in got if not any(p <= set(c) for c in cells)}


def test_cells_give_forests():
    prints = np.array(clusters(3, 1, 400, 2), np.uint64)
    a, b = simhash.cell_links(np.array([0]), prints, np.ones(len(prints), bool))
    assert len(a) < len(prints) and (np.bitwise_count(a ^ b) <= 4).all()


def test_simhash_edges(edge_docs, edge_pairs, no_docs):
    got = sorted(map(tuple, simhash_groups(edge_docs).collect()), key=str)
    assert got == sorted(brute_groups(edge_pairs), key=str)
    assert simhash_groups(no_docs).count() == 0


def test_simhash_copies_of_one_text(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    pairs = []
    for k in range(600):
        text = list(base)
        if k % 3:
            text[rng.randrange(300)] = rng.choice(words)
        pairs.append((k, " ".join(text)))
    pairs += [(1000 + k, " ".join(rng.choice(words) for _ in range(50))) for k in range(100)]
    got = sorted(map(tuple, simhash_groups(spark.createDataFrame(pairs, "doc_id long, text string")).collect()))
    assert got == sorted(brute_groups(pairs))
