"""Operator 13 against a plain version."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pitlake.llm import alignment as module
from pitlake.llm.alignment import alignment, common_ends, default_files, gallop


def byte_of():
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def brute(pairs):
    import sentencepiece
    import tokenizers

    a_path, b_path = default_files()
    one, two = tokenizers.Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    one.encode_special_tokens = True
    value = byte_of()
    docs, holders = [], Counter()
    for i, t in pairs:
        if not t:
            docs.append((i, None, None))
            continue
        a, b = one.encode(" " + t, add_special_tokens=False).ids, two.encode(t)
        names = [two.id_to_piece(x) for x in b]
        spelt = ([bytes(value[c] for c in one.id_to_token(x)) for x in a],
                 [bytes([int(n[3:5], 16)]) if n.startswith("<0x") and len(n) == 6 else n.replace("▁", " ").encode() for n in names])
        if any(b"".join(s) != (" " + t).encode() for s in spelt):
            docs.append((i, None, None))
            continue
        owner = []
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelt]
        both = sorted(set(ends[0]) & set(ends[1]))
        for e, ids in zip(ends, (a, b)):
            groups = defaultdict(list)
            for end, x in zip(e, ids):
                groups[next(c for c in both if c >= end)].append(x)
            owner.append(groups)
        links = Counter((x, y) for c in both for x in owner[0][c] for y in owner[1][c])
        holders.update(links.keys())
        docs.append((i, (a, b, [(owner[0][c], owner[1][c]) for c in both]), links))
    top = Counter()
    for (x, _), n in holders.items():
        top[x] = max(top[x], n)
    out = []
    for i, parts, links in docs:
        if parts is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups = parts
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((i, len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if holders[p] == top[p[0]]),
                    sum(n * holders[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_alignment_edges(edge_docs, edge_pairs, no_docs):
    short = [(i, t) for i, t in edge_pairs if len(t or "") < 20_000]      # the plain version is quadratic
    long = {i for i, t in edge_pairs if len(t or "") >= 20_000}
    rows = alignment(edge_docs.filter("text IS NULL OR length(text) < 20000"))
    assert got(rows) == brute(short)
    whole = {r.doc_id: r for r in alignment(edge_docs).collect()}
    assert all(whole[i].n_a > 1000 and whole[i].n_links >= whole[i].n_groups for i in long)
    assert alignment(no_docs).count() == 0


ODD = ["two  spaces", " starts", "ends ", "tab\there", "line\nbreak\r\n", "ﬁne ligature", "▁ marked", "<s> and </s> and <unk>", "<|endoftext|>", "<0x41>",
       "日本語の文", "emoji \U0001f600\U0001f468‍\U0001f469", "é combining", " nbsp", "zero​width", "\x00null", "a" * 3000, "ab" * 900, "0123456789" * 50]


@pytest.mark.parametrize("common", [module.COMMON, 20])
def test_alignment_odd_texts_and_rare_pairs(spark, monkeypatch, common):
    monkeypatch.setattr(module, "COMMON", common)
    rng = random.Random(4)
    pairs = list(enumerate(ODD)) + [(100 + k, " ".join(rng.choice(ODD)[:rng.randint(1, 30)] for _ in range(20)).strip()) for k in range(60)]
    pairs += [(500, "same text"), (500, "same text"), (None, "same text")]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    assert got(alignment(df)) == brute(pairs)


def test_both_encoders_of_a_give_the_same_ids():
    files = [open(p, "rb").read() for p in default_files()]
    t = module.Tokenizers(*files)
    spec = __import__("json").loads(files[0])
    assert t._plain(spec) and not t._plain(spec | {"normalizer": {"type": "NFC"}})
    rng = random.Random(6)
    texts = [f" a{chr(c)}1 {chr(c)}'s{chr(c)}\t{chr(c)}9" for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts += ["".join(rng.choice("ab '\n\té1.") for _ in range(200)) for _ in range(300)] + ["<|endoftext|>", "x" * 5000, " " * 5000]
    assert t.encode_a(texts) == t._by_file(files[0])(texts)


def test_large_groups_by_distinct_ids(spark, monkeypatch):
    monkeypatch.setattr(module, "LISTED", 0)
    pairs = list(enumerate(ODD))
    assert got(alignment(spark.createDataFrame(pairs, "doc_id long, text string"))) == brute(pairs)


def test_gallop_is_a_lower_bound():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (5, 40), (300, 7), (200, 900)):
        ends, targets = np.unique(rng.integers(0, 1000, n)), np.unique(rng.integers(0, 1000, m))
        for at in (np.zeros(len(targets), np.int64), np.full(len(targets), len(ends) - 1), rng.integers(0, len(ends), len(targets))):
            assert (gallop(targets, ends, at) == np.searchsorted(ends, targets)).all()


def test_common_ends_of_many_documents():
    rng = np.random.default_rng(8)
    a, b, n_a, n_b = [], [], [], []
    for d in range(200):
        for ends, n in ((a, n_a), (b, n_b)):
            own = np.unique(rng.integers(0, 50, rng.integers(0, 40)))
            ends += (own + 100 * d).tolist()
            n.append(len(own))
    x, y = common_ends(np.array(a), np.array(b), np.array(n_a), np.array(n_b))
    assert np.array(a)[x].tolist() == sorted(set(a) & set(b)) == np.array(b)[y].tolist()
