"""Operators 2, 3, 4, 5 and 8 against brute force."""

import hashlib
import time
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlake.llm import bpe, ctw, pii, sharding, topk
from pitlake.llm.words import words_of


def order(rows):
    return sorted(rows, key=str)


# ------------------------------------------------------------------ sharding
def brute_capacity(sizes, shards):
    def need(c):
        n, now = 1, 0
        for s in sizes:
            if now + s > c:
                n, now = n + 1, 0
            now += s
        return n

    c = max(max(sizes), math.ceil(sum(sizes) / shards))
    while need(c) > shards:
        c += 1
    return c


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_minimax_cuts(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 60) for _ in range(rng.randint(3, 120))]
    ends = np.cumsum(sizes).tolist()
    prefix = spark.createDataFrame(list(zip(sizes, ends)), "bytes long, end long")
    capacity, cuts = sharding.minimax_cuts(prefix, 8)
    assert capacity == brute_capacity(sizes, 8)
    assert all(b - a <= capacity for a, b in zip([0, *cuts], [*cuts, ends[-1]])) and set(cuts) <= set(ends)


def check_shards(pairs, rows, shards=8):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert sorted(map(str, [r.doc_id for r in rows])) == sorted(str(i) for i, _ in pairs)
    assert order((r.doc_id, r.size, r.text_crc32) for r in rows) == order((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
    for k, own in by.items():
        assert 0 <= k < shards and sorted(r.slot for r in own) == list(range(len(own)))
    place = defaultdict(set)
    text = {(i, zlib.crc32((t or "").encode())): t or "" for i, t in pairs}
    for r in rows:
        place[text[r.doc_id, r.text_crc32]].add(r.shard)
    assert all(len(x) == 1 for x in place.values())       # equal texts lie together
    return {k: sum(r.size for r in own) for k, own in by.items()}


def test_sharding_edges(spark, edge_docs, edge_pairs, no_docs):
    check_shards(edge_pairs, sharding.sharding_query(spark, edge_docs).collect())
    assert sharding.sharding_query(spark, no_docs).count() == 0


def test_sharding_near_equal_beside_a_giant(spark):
    rng = random.Random(2)
    pairs = [(k, "giant " * 8 if k % 3 == 0 else "x" * rng.randint(1, 90)) for k in range(3000)]
    sizes = check_shards(pairs, sharding.sharding_query(spark, spark.createDataFrame(pairs, "doc_id long, text string")).collect())
    assert len(sizes) == 8
    giant = max(sizes.values())
    rest = [x for x in sizes.values() if x != giant]
    assert giant == 1000 * 49 and max(rest) - min(rest) < 2000


# ------------------------------------------------------------------ LM scoring
def brute_scores(pairs, depth):
    tokens = [[*words_of(t, lower=True), b"\n"] for _, t in pairs]
    train = [k for k, (i, _) in enumerate(pairs) if i is None or zlib.crc32(str(i).encode()) % 10]
    c = Counter(x for k in train for x in tokens[k])
    n, v = sum(c.values()), len(c)

    def walk(k):
        b = b"\n" * depth + b" ".join(tokens[k][:-1]) + b"\n"
        for p in range(depth, len(b)):
            for q in range(8):
                yield [(b[p - d:p], (1 << q) | (b[p] >> (8 - q))) for d in range(depth + 1)], (b[p] >> (7 - q)) & 1

    count = defaultdict(lambda: [0, 0])
    for k in train:
        for path, bit in walk(k):
            for x in path:
                count[x][bit] += 1
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)
    weight, below = {}, defaultdict(float)
    for x in sorted(count, key=lambda x: -len(x[0])):
        own, rest = kt(*count[x]), below[x]
        if len(x[0]) == depth:
            weight[x], ln = 1.0, own
        else:
            top = max(own, rest)
            ln = math.log(.5) + top + math.log(math.exp(own - top) + math.exp(rest - top))
            weight[x] = 1 / (1 + math.exp(max(-700, min(700, rest - own))))
        if x[0]:
            below[x[0][1:], x[1]] += ln
    out = []
    for k, (i, _) in enumerate(pairs):
        score = 0.0
        for path, bit in walk(k):
            p = .5
            for x in reversed(path):
                p = weight[x] * (count[x][bit] + .5) / (sum(count[x]) + 1) + (1 - weight[x]) * p if x in count else .5
            score += math.log10(p)
        base = sum(math.log10((c[x] + .1) / (n + .1 * (v + 1))) for x in tokens[k])
        out.append((str(i), i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(tokens[k]), sum(c[x] > 0 for x in tokens[k]), n, base, score))
    return out


def same_scores(got, want):
    got, want = sorted((str(r[0]), *r[1:]) for r in got), sorted(want)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=2e-4)


@pytest.mark.parametrize("depth, shard, hot", [(2, 8_000_000, 1_000_000), (3, 3000, 300)])
def test_ctw(spark, monkeypatch, edge_pairs, depth, shard, hot):
    """Against the recursion; small limits give several passes and words that travel."""
    monkeypatch.setattr(ctw, "SHARD", shard)
    monkeypatch.setattr(ctw, "HOT", hot)
    pairs = [(i, t) for i, t in edge_pairs if len(t or "") < 2000]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    same_scores([tuple(r) for r in ctw.score_texts(docs, depth).collect()], brute_scores(pairs, depth))


def test_ctw_edges(edge_docs, edge_pairs, no_docs):
    assert len(ctw.score_texts(edge_docs).collect()) == len(edge_pairs)
    assert ctw.score_texts(no_docs).count() == 0


def test_ctw_probabilities_sum_to_one():
    rng = random.Random(1)
    key = np.array(sorted((d << 48) + c * 256 + j for d in (0, 1) for c in range(1 if d == 0 else 3) for j in range(1, 256)))
    model = (key, np.array([rng.random() - .5 for _ in key], np.float32), np.array([rng.random() - .5 for _ in key], np.float32))
    for ctx in (1, 2, 77):
        chances = ctw.log10_chances(np.array([ctx * 256 + s for s in range(256)], np.uint64), model, 1)
        assert (10 ** chances).sum() == pytest.approx(1)


# ------------------------------------------------------------------ PII
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d)))
        return 16 <= len(d) <= 19 and total % 10 == 0
    return kind != "phone" or 8 <= len(d) <= 15


def brute_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def test_pii(spark, edge_docs, edge_pairs, no_docs):
    rng = random.Random(5)
    texts = ["".join(rng.choice("0123456789" * 3 + "....++@@@  -()_abZé\U0001f600") for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(rng.choice("a@.c_-") for _ in range(rng.randint(0, 30))) for _ in range(800)]
    texts += ["".join(rng.choice("1122..5. ") for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += ["1" * 50_000, "a" * 100_000, "a.b@c" + ".d" * 20_000, "1.2.3.4 " * 3000, "+1" + "0" * 60_000]
    pairs = list(enumerate(texts))
    for docs, own in ((spark.createDataFrame(pairs, "doc_id long, text string"), pairs), (edge_docs, edge_pairs)):
        got = order((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.pii_query(spark, docs).collect())
        want = []
        for i, t in own:
            spans = brute_spans(t)
            n = Counter(s.split(":")[0] for s in spans)
            want.append((i, hashlib.sha256(",".join(spans).encode()).hexdigest(), n["email"], n["ip"], n["card"], n["phone"]))
        assert got == order(want)
    assert pii.pii_query(spark, no_docs).count() == 0


def test_pii_added_spans_and_scores(spark):
    text = "iban GB82WEST12345698765432 but GB82WEST12345698765433; 123-45-6789, ssn 123-45-6789; DE89 3704 0044 0532 0130 00."
    spans = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    assert [(s.kind, s.value) for s in spans] == [("iban", "GB82WEST12345698765432"), ("iban", "DE89 3704 0044 0532 0130 00"), ("id", "123-45-6789")]
    assert all(text[s.start:s.end] == s.value for s in spans)
    assert spans[0].score == 1.0 and spans[1].score == 0.9


def test_pii_of_very_many_matches(spark):
    """Time in proportion to the matches: 100,000 of each base kind in one text."""
    unit, n = "a@b.cd 1.2.3.4 x +4912345678 x 4111111111111111 x ", 100_000
    began = time.time()
    row = pii.pii_query(spark, spark.createDataFrame([(1, unit * n)], "doc_id long, text string").repartition(1)).collect()[0]
    assert time.time() - began < 120
    places = {"email": (0, 6), "ip": (7, 14), "card": (31, 47), "phone": (17, 28)}
    want = ",".join(f"{k}:{a + i * len(unit)}:{z + i * len(unit)}" for k, (a, z) in places.items() for i in range(n))
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (n,) * 4 and row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_pii_context_reaches_over_earlier_matches(spark):
    rng = random.Random(6)
    texts = ["ssn 123-45-6789, 987-65-4321", "tel +1 555 123 4567; +1 555 123 4568, then some forty code points more of it: +1 555 123 4569", "ip 1.2.3.4,300.1.1.1,5.6.7.8"]
    pieces = ["ssn ", "tel ", "visa ", "ip ", "12 34, ", "1 2;", "a.b@c.de ", "123-45-6789", "4111 1111 1111 1111", "+1 555 123 4567;", "1.2.3.4", "900.1.1.1 ", ", ", "x", "\U0001f600é "]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    spans = {r.doc_id: [(s.kind, s.value, round(s.score, 2)) for s in r.spans] for r in rows}
    assert spans[0] == [("id", "123-45-6789", 0.65), ("id", "987-65-4321", 0.65)]
    assert [x[2] for x in spans[1]] == [0.95, 0.95, 0.6] and [x[2] for x in spans[2]] == [0.95, 0.95]
    for r in rows:
        for s in r.spans:
            _, _, prior, words = pii.KINDS[s.kind]
            near = re.search(f"(?<![a-z])(?:{words})", texts[r.doc_id][max(0, s.start - 40):s.start].lower())
            assert s.score == pytest.approx(min(1.0, prior + (0.35 if near else 0.0)))


# ------------------------------------------------------------------ top-k
def brute_top(vectors, k=10):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in ok if i % 100 == 0}:
        best = sorted(((-sum(x * y for x, y in zip(a, b)), c) for c, b in ok if c != q and len(b) == len(a)))[:k]
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return out


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_BYTES", 6000)       # 150 vectors of 5: several tiles of both sides, merged in two rounds
    monkeypatch.setattr(topk, "TILE", 40)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    rng = random.Random(1)
    vectors = [(k, [rng.randint(-3, 3) / 4 for _ in range(5)]) for k in range(0, 1300, 2)]        # few values: many ties
    vectors += [(1500, None), (1600, [float("nan")] * 5), (1700, [None] * 5), (1800, [float("inf")] * 5), (1900, []), (2000, [1.0, 2.0]), (2001, [0.5, 0.5]),
                (None, [1.0] * 5), (2100, [3e9] * 5), (200, [0.25] * 5), (200, [0.25] * 5), (201, vectors[0][1]), (201, vectors[0][1])]
    rows = [(i, v, 1, "x", "y", 2) for i, v in vectors]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, v string, dim int").repartition(70)
    assert order(map(tuple, topk.topk_query(spark, frame).collect())) == order(brute_top([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]))
    assert topk.topk_query(spark, frame.limit(0)).count() == 0
    # every row a query, in some 50 query tiles
    monkeypatch.setattr(topk, "TILE_BYTES", 600)
    few = frame.filter("vec_id < 500")
    got = topk.top_k(few, few.filter("vec_id % 2 = 0"), 3).collect()
    assert len(got) == 3 * few.filter("vec_id % 2 = 0").select("vec_id", "embedding").distinct().count()


def test_topk_keeps_vectors_off_the_driver(spark, monkeypatch):
    """Only counts by length are collected: 100,000 queries take some hundred bytes of the driver."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    sent, real = [], Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda self: sent.append(real(self)) or sent[-1])
    for name in ("toPandas", "toArrow", "toLocalIterator"):
        monkeypatch.setattr(Classic, name, lambda self, *a: pytest.fail("rows brought to the driver"))
    wide = spark.range(100_000).select(F.col("id").alias("vec_id"), F.array(*[F.rand(k).cast("float") for k in range(2)]).alias("embedding"))
    topk.top_k(wide.filter("vec_id < 50"), wide, 1)
    assert sum(len(x) for x in sent) == 2


# ------------------------------------------------------------------ BPE
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


def test_bpe_equals_the_library(spark, edge_docs, edge_pairs, no_docs):
    lib = library()
    rng = random.Random(1)
    pairs = edge_pairs + [(1000 + k, "".join(rng.choice("abcdeth  '.,!1é́Àσ\n") for _ in range(rng.randint(0, 60)))) for k in range(300)]
    pairs += [(2000, "aaaaaaaa" * 99 + " I'm 'S <|startoftext|>x<|endoftext|>"), (2001, "\x00\x1c\x85 \U0001f468‍\U0001f469 ½①")]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    got = {}
    for r in bpe.coded(docs, bpe.default_vocabulary(), ("ids", "decoded")).collect():
        got.setdefault(r.doc_id, []).append((r.ids, r.decoded))
    for i, t in pairs:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert (ids, lib.decode(ids, skip_special_tokens=False)) in got[i]
    row = next(r for r in bpe.bpe_query(spark, edge_docs).collect() if r.doc_id == 115)
    ids = lib.encode(dict((i, t) for i, t in edge_pairs)[115], add_special_tokens=False).ids
    assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.bpe_query(spark, edge_docs).count() == len(edge_pairs) and bpe.bpe_query(spark, no_docs).count() == 0


def test_bpe_of_long_words(spark, monkeypatch):
    """Words without an end: as the library encodes them, in time; and the long way equals the rounds on words of any length."""
    lib, rng = library(), random.Random(8)
    letters = "etaoinshrdlucmfwypvbgkqjxz"
    texts = ["".join(rng.choice(letters) for _ in range(60_000)), "a" * 5001, "ab" * 3000, "é" * 1500 + "x", "".join(rng.choice("ab") for _ in range(9000)),
             " ".join("".join(rng.choice(letters[:4]) for _ in range(rng.choice((3, 499, 500, 501, 900)))) for _ in range(40))]
    coder = bpe.Coder(bpe.read_vocabulary(bpe.default_vocabulary()))
    began = time.time()
    got = [i.tolist() for i in coder.encode(texts)]
    assert time.time() - began < 20
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    words = [bytes(rng.choice(b"aabbcdeth\xc3\xa9") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    rounds = [x.tolist() for x in bpe.merge_words(words, coder.v)]
    monkeypatch.setattr(bpe, "LONG", 0)
    assert [x.tolist() for x in bpe.merge_words(words, coder.v)] == rounds
    assert [x.tolist() for x in bpe.merge_words([], coder.v)] == [[], []]
