"""LM scoring by context-tree weighting over bytes.

A text is the sequence of its lower-cased words, a space between them and a
line feed at the end; the model gives the probability of that byte sequence.
Each byte is eight binary decisions, one for each node on its way through the
tree of bit prefixes.  Every (context, prefix) pair has a Krichevsky-Trofimov
estimate of its bit; the estimates of the contexts of 0 to DEPTH bytes are
mixed by the weights that context-tree weighting gives them over the training
texts: a context's weight is the share of its own block probability against
the product of its extensions' weighted probabilities.

Training: each task counts the (DEPTH + 1)-byte strings of its training texts;
the counts are summed by key, and the tree is built level by level with
joins and sums from the longest contexts up.  The strings that only held-out
texts hold travel with them, counted 0 times.  Scoring: each distinct string of
the table meets the nodes of its last two context bytes in executors, where the
chance of its last byte is worked out once; the chances are broadcast in shards
of SHARD strings at most, a shard holding all strings of some two-byte contexts,
and a text's score is the sum over its strings.  So what is broadcast is
bounded; more strings take more passes.

The base score counts words.  Words above a HOT-th of all training tokens, of
which there can be HOT at most, are broadcast with their counts; the others
travel, packed, to the part of their hash, where they are counted, and their
contributions travel back by document.  Words are known by 64-bit hashes.

Defined cases: a null or empty text has no words and one end; a null id is
learned from, not held out; rows that repeat an id and a text get the same
row each; with no training texts N and V are 0 and every bit has chance 1/2;
an empty table gives no rows; extra columns are never read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import union_all, written
from pitlake.llm.packed import cuts, planes, summed, unplanes
from pitlake.llm.texts import slices
from pitlake.llm.words import BASE, hashes_of, words_of

DEPTH, SHARD, HOT = 4, 8_000_000, 1_000_000
#: bytes of text behind one part, distinct strings whose chances are worked out together, characters whose rows a task packs together, characters it splits at a time
PART_BYTES, PART_STRINGS, CHUNK, PIECE = 12_000_000, 10_000, 4_000_000, 500_000
NULL_ID = -(1 << 63)
END, SPACE = b"\n", b" "
END_HASH = xxhash.xxh3_64_intdigest(END)      # no word holds a line feed


def held_out(i: int | None) -> bool:
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def strings(documents: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The (depth + 1)-byte string that ends at each byte of the texts, and the number of bytes of each text.
    Before a text stand ``depth`` line feeds."""
    texts = [SPACE.join(w) + END for w in documents]
    sizes = np.array([len(t) for t in texts])
    raw = np.frombuffer(b"".join(END * depth + t for t in texts) + END, np.uint8)[:-1]
    key = np.zeros(len(raw) - depth, np.uint64)
    for k in range(depth + 1):
        key <<= np.uint64(8)
        key |= raw[k:len(raw) - depth + k]
    ends = np.cumsum(sizes + depth) - depth      # the strings that end in the line feeds before the next text are left out
    real = np.ones(len(key), bool)
    for k in range(depth):
        real[(ends[:-1] + k)] = False
    return key[real], sizes


def _parts(docs: DataFrame, text_col: str) -> int:
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(total / PART_BYTES))


# ------------------------------------------------------------------ counting
def corpus_counts(named: DataFrame, parts: int, depth: int) -> DataFrame:
    """Rows of (kind, key, n): kind 0 the strings' counts, kind 1 frequent words' counts,
    kind 2 a part's number of distinct words (key) and of tokens (n); training texts only,
    but for the strings of held-out texts, which are rows of kind 0 that count nothing."""
    piece = PIECE

    def count(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            train = [not held_out(None if i == NULL_ID else i) for i in b.column(0).to_pylist()]
            for a, z in slices(texts, CHUNK):
                met, found = [(np.zeros(0, np.uint64), np.zeros(0, int))], []
                for x, y in slices(texts[a:z], piece):
                    words = {True: [], False: []}
                    for t, learned in zip(texts[a + x:a + y], train[a + x:a + y]):
                        words[learned].append(words_of(t, lower=True))
                    for learned, own in words.items():
                        if own:
                            keys, n = np.unique(strings(own, depth)[0], return_counts=True)
                            found.append((keys, n if learned else 0 * n))
                    met.append(np.unique(np.concatenate([*map(hashes_of, words[True]), np.full(len(words[True]), END_HASH, np.uint64)]), return_counts=True))
                (h, n), (keys, times) = (summed(*map(np.concatenate, zip(*u))) for u in (met, found))
                rows = []
                for kind, k, c, width, part in ((1, h, n, 8, h >> np.uint64(48)), (0, keys, times, depth + 1, (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40))):
                    part = part % np.uint64(parts)
                    order = np.argsort(part, kind="stable")
                    part, k, c = part[order], k[order], c[order]
                    rows += [(int(part[x]), kind, planes(k[x:y], width), planes(c[x:y], 4)) for x, y in cuts(part)]
                yield from pa.table([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                    ["part", "kind", "keys", "n"]).to_batches()

    def add(table: pa.Table) -> pa.Table:
        out = []
        for kind, width in ((0, depth + 1), (1, 8)):
            own = table.filter(pa.array(table.column("kind").to_numpy() == kind))
            keys, n = summed(unplanes(own.column("keys").to_pylist(), width), unplanes(own.column("n").to_pylist(), 4).astype(np.int64))
            if kind:
                out.append((np.array([2]), np.array([len(keys)]), np.array([n.sum()])))
                often = n * HOT > n.sum()        # a word above a HOT-th of all tokens is above that of its part's
                keys, n = keys[often], n[often]
            out.append((np.full(len(keys), kind), keys.view(np.int64), n))
        kind, keys, n = (np.concatenate(x) for x in zip(*out))
        return pa.table([pa.array(kind.astype(np.int32)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"])

    dealt = named.mapInArrow(count, "part int, kind int, keys binary, n binary")
    return written(dealt.groupBy("part").applyInArrow(add, "kind int, key long, n long"), "ctw-counts")


# ------------------------------------------------------------------ the tree
def _lgamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1/2, by Stirling's series seven places up."""
    z = x + 7.0
    shift = F.lit(0.0)
    for k in range(7):
        shift = shift + F.log(x + float(k))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) - shift


def _nodes(level: DataFrame) -> DataFrame:
    """ctx, j (bit prefix with a leading 1), the counts of both bits and the log KT probability of their block."""
    rows = level.select("ctx", "sym", "n", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k"))
    j = F.expr("shiftleft(1, k) | shiftright(sym, 8 - k)")
    bit = F.expr("shiftright(sym, 7 - k) & 1")
    got = rows.select("ctx", j.alias("j"), bit.alias("bit"), "n").groupBy("ctx", "j").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"))
    kt = _lgamma(F.col("n0") + 0.5) + _lgamma(F.col("n1") + 0.5) - math.log(math.pi) - _lgamma(F.col("n0") + F.col("n1") + 1.0)
    return got.withColumn("kt", kt)


def _signed(p: Column, rest: Column) -> Column:
    """A chance as a 32-bit number without loss near 1: itself up to 1/2, else minus the rest."""
    return F.when(p <= 0.5, p).otherwise(-F.greatest(rest, F.lit(1e-30))).cast("float")


def tree(strings_: DataFrame, depth: int) -> DataFrame:
    """key, w (weight of the context's own estimate), p1 (its chance of bit 1) and pair (last
    two context bytes) of every node; w and p1 as ``_signed`` makes them."""
    level = strings_.select(F.expr("shiftright(key, 8)").alias("ctx"), F.expr("cast(key & 255 as int)").alias("sym"), "n")
    below, out = None, []
    for d in range(depth, -1, -1):
        if d < depth:
            level = level.groupBy(F.expr(f"ctx & {(1 << 8 * d) - 1}").alias("ctx"), "sym").agg(F.sum("n").alias("n"))
        nodes = _nodes(level)
        if below is None:
            nodes = nodes.withColumn("ln", F.col("kt")).withColumn("w", F.lit(1.0)).withColumn("rest", F.lit(0.0))
        else:
            nodes = nodes.join(below, ["ctx", "j"])
            gap = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("sum") - F.col("kt")))
            nodes = (nodes.withColumn("ln", math.log(0.5) + F.greatest("kt", "sum") + F.log1p(F.exp(-F.abs(gap))))
                     .withColumn("w", 1 / (1 + F.exp(gap))).withColumn("rest", 1 / (1 + F.exp(-gap))))
        nodes = written(nodes.select("ctx", "j", "n0", "n1", "ln", "w", "rest"), f"ctw-{d}")
        if d:
            below = nodes.groupBy(F.expr(f"ctx & {(1 << 8 * (d - 1)) - 1}").alias("ctx"), "j").agg(F.sum("ln").alias("sum"))
        out.append(nodes.select((F.lit(d << 48) + F.col("ctx") * 256 + F.col("j")).alias("key"), _signed(F.col("w"), F.col("rest")).alias("w"),
                                _signed((F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1), (F.col("n0") + 0.5) / (F.col("n0") + F.col("n1") + 1)).alias("p1"),
                                (F.expr("cast(ctx & 65535 as int)") if d > 1 else F.lit(-1)).alias("pair")))
    return union_all(out)


def log10_chances(strings_: np.ndarray, model: tuple, depth: int) -> np.ndarray:
    """log10 chance of each string's last byte after its others."""
    keys, w, p1 = model
    total = np.zeros(len(strings_))
    sym, ctx = (strings_ & np.uint64(255)).astype(np.int64), (strings_ >> np.uint64(8)).astype(np.int64)
    for k in range(8):
        j, bit = (1 << k) | (sym >> (8 - k)), (sym >> (7 - k)) & 1
        chance = np.full(len(strings_), 0.5)          # below the longest context seen
        for d in range(depth, -1, -1):
            key = (d << 48) + (ctx & ((1 << 8 * d) - 1)) * 256 + j
            at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
            seen = keys[at] == key if len(keys) else np.zeros(len(key), bool)
            if not len(keys):
                continue
            p, q = p1[at].astype(np.float64), w[at].astype(np.float64)
            one, zero = np.where(p > 0, p, 1 + p), np.where(p > 0, 1 - p, -p)
            weight, rest = np.where(q >= 0, q, 1 + q), np.where(q >= 0, 1 - q, -q)
            chance = np.where(seen, weight * np.where(bit == 1, one, zero) + rest * chance, 0.5)
        total += np.log10(chance)
    return total


# ---------------------------------------------------------------- the chances
def _model(nodes: pa.Table) -> list[np.ndarray]:
    """Keys, weights and chances of nodes, sorted by key."""
    arrays = [nodes.column(c).to_numpy() for c in ("key", "w", "p1")]
    order = np.argsort(arrays[0])
    return [x[order] for x in arrays]


def chances(strings_: DataFrame, nodes: DataFrame, parts: int, depth: int) -> DataFrame:
    """key, pair (last two context bytes) and chance (log10, of the last byte after the others) of every string."""
    few = strings_.sparkSession.sparkContext.broadcast(_model(nodes.filter("pair < 0").toArrow()))      # 65535 + 255 nodes at most

    def score(own: pa.Table, longer: pa.Table) -> pa.Table:
        model = tuple(map(np.concatenate, zip(few.value, _model(longer))))      # in order: a key begins with the length of its context
        key = own.column("key")
        return pa.table([key, own.column("pair"), pa.array(log10_chances(key.to_numpy().view(np.uint64), model, depth))], ["key", "pair", "chance"])

    def dealt(rows: DataFrame):
        return rows.withColumn("part", F.pmod(F.hash("pair"), F.lit(parts))).groupBy("part")

    own = strings_.select("key", F.expr("cast(shiftright(key, 8) & 65535 as int)").alias("pair"))
    return dealt(own).cogroup(dealt(nodes.filter("pair >= 0"))).applyInArrow(score, "key long, pair int, chance double")


def shards(scored: DataFrame) -> list[np.ndarray]:
    """Two-byte contexts of each shard: whole contexts, SHARD strings at most unless one alone has more."""
    sizes = scored.groupBy("pair").count().orderBy("pair").collect()       # 65536 rows at most
    out, own, size = [], [], 0
    for pair, n in sizes:
        if own and size + n > SHARD:
            out.append(np.array(own))
            own, size = [], 0
        own.append(pair)
        size += n
    return [*out, np.array(own, int)]


def hashed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of distinct 64-bit keys in order, with their values; a last hash, not to look beyond, has value 0."""
    h = keys * np.uint64(BASE)          # one to one, as BASE is odd
    order = np.argsort(h)
    return np.append(h[order], np.uint64((1 << 64) - 1)), np.append(values[order], values.dtype.type(0))


class Lookup:
    """Places of keys among the hashes that ``hashed`` makes: each is looked for from where those with its first bits start."""

    def __init__(self, hashes: np.ndarray):
        bits = len(hashes).bit_length()
        self.hashes, self.shift = hashes, np.uint64(64 - bits)
        self.starts = np.zeros(1 << bits, np.int32)
        np.cumsum(np.bincount((hashes[:-1] >> self.shift).astype(np.int64), minlength=1 << bits)[:-1], out=self.starts[1:])

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A place for each key, and whether the key is there."""
        h = keys * np.uint64(BASE)
        at = self.starts[(h >> self.shift).astype(np.int64)].astype(np.int64)
        left = np.flatnonzero(self.hashes[at] < h)
        while len(left):
            at[left] += 1
            left = left[self.hashes[at[left]] < h[left]]
        return at, (self.hashes[at] == h) & (at < len(self.hashes) - 1)


def shard_arrays(scored: DataFrame, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A shard's strings and their chances, as ``hashed`` makes them."""
    own = scored.join(F.broadcast(scored.sparkSession.createDataFrame([(int(p),) for p in pairs], "pair int")), "pair", "left_semi")
    got = own.select("key", "chance").toArrow()
    return hashed(got.column("key").to_numpy().view(np.uint64), got.column("chance").to_numpy())


class Scorer:
    """Scores texts with the chances of one shard's strings."""

    def __init__(self, hashes: np.ndarray, chance: np.ndarray, depth: int):
        self.lookup, self.chance, self.depth = Lookup(hashes), chance, depth

    def __call__(self, documents: list[list[bytes]]) -> np.ndarray:
        keys, sizes = strings(documents, self.depth)
        at, there = self.lookup(keys)
        return np.add.reduceat(np.where(there, self.chance[at], 0.0), np.cumsum(sizes) - sizes)


# ------------------------------------------------------------------ scoring
ROW = "part int, kind int, dest int, hashes binary, times binary, ids binary, prints binary, counts binary, values binary"
ROW_TYPES = [pa.int32()] * 3 + [pa.binary()] * 6
ROW_NAMES = [c.split()[0] for c in ROW.split(", ")]
#: a document's values: rows of it, tokens, known tokens, sum of log10(c + 0.1), log10 probability
VALUES = 5


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(ROW_TYPES)], ROW_NAMES)


def _to_documents(ids: np.ndarray, prints: np.ndarray, values: np.ndarray, parts: int) -> list[tuple]:
    """Rows that carry documents' values to the parts of their ids."""
    dest = np.mod(ids, parts)
    order = np.argsort(dest, kind="stable")
    return [(int(dest[order[a]]), 1, int(dest[order[a]]), b"", b"", ids[order[a:z]].astype("<i8").tobytes(), prints[order[a:z]].astype("<u8").tobytes(), b"",
             values[order[a:z]].astype("<f8").tobytes()) for a, z in cuts(dest[order])]


def score_texts(docs: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    parts = _parts(docs, text_col)
    named = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("key"), F.col(text_col).alias("text"))
    counted = corpus_counts(named, parts, depth)
    v, n, distinct = (x or 0 for x in counted.agg(*(F.sum(F.when(F.col("kind") == kind, x)) for kind, x in ((2, F.col("key")), (2, F.col("n")), (0, F.lit(1))))).first())
    hot = counted.filter((F.col("kind") == 1) & (F.col("n") * HOT > n)).select("key", "n").toArrow()      # HOT rows at most
    h = hot.column("key").to_numpy().view(np.uint64)
    words = spark.sparkContext.broadcast(hashed(h, hot.column("n").to_numpy()))
    nodes = written(tree(counted.filter("kind = 0 and n > 0"), depth), "ctw-tree")
    scored = written(chances(counted.filter("kind = 0"), nodes, max(1, math.ceil(distinct / PART_STRINGS)), depth), "ctw-chances")
    passes = []
    for k, pairs in enumerate(shards(scored)):
        model = spark.sparkContext.broadcast(shard_arrays(scored, pairs))
        passes.append(named.mapInArrow(_pass(words if k == 0 else None, model, parts, depth), ROW))
    answered = union_all(passes).groupBy("part").applyInArrow(_count_rare(parts), ROW)

    def finish(table: pa.Table) -> pa.Table:
        ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), "<i8")
        prints = np.frombuffer(b"".join(table.column("prints").to_pylist()), "<u8")
        values = np.frombuffer(b"".join(table.column("values").to_pylist()), "<f8").reshape(-1, VALUES)
        order = np.lexsort((prints, ids))
        ids, prints, values = ids[order], prints[order], values[order]
        starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1])])
        total = np.add.reduceat(values, starts)
        times = total[:, 0].round().astype(int)
        one = np.repeat(total / times[:, None], times, axis=0)        # rows that repeat an id and a text share their sums
        own = np.repeat(ids[starts], times)
        null = own == NULL_ID
        base = one[:, 3] - one[:, 1] * math.log10(n + 0.1 * (v + 1))
        held = [held_out(None if z else int(i)) for i, z in zip(own, null)]
        return pa.table([pa.array(own, mask=null), pa.array(held), *(pa.array(one[:, c].round().astype(np.int64)) for c in (1, 2)),
                         pa.array(np.full(len(own), n)), pa.array(base), pa.array(one[:, 4])],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return answered.groupBy("dest").applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _pass(words, model, parts: int, depth: int):
    """One pass over the texts: scores with a shard; the first also takes the words."""
    piece = PIECE

    def run(batches):
        scorer = Scorer(*model.value, depth)
        if words is not None:
            known, c = words.value
            frequent, logs = Lookup(known), np.log10(c + 0.1)
        for b in batches:
            keys, texts = b.column(0).to_numpy(), [t or "" for t in b.column(1).to_pylist()]
            for a, z in slices(texts, CHUNK):
                prints = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts[a:z]], np.uint64)
                values = np.zeros((z - a, VALUES))
                rows, h = [], []
                for x, y in slices(texts[a:z], piece):
                    split = [words_of(t, lower=True) for t in texts[a + x:a + y]]
                    values[x:y, 4] = scorer(split)
                    if words is not None:
                        values[x:y, 1] = [len(w) + 1 for w in split]
                        h += [np.r_[hashes_of(w), np.uint64(END_HASH)] for w in split]
                if words is not None:
                    values[:, 0] = 1
                    h = np.concatenate(h)
                    owner = np.repeat(np.arange(z - a), values[:, 1].astype(int))
                    at, often = frequent(h)
                    values[:, 2] = np.bincount(owner[often], minlength=z - a)
                    values[:, 3] = np.bincount(owner[often], logs[at[often]], minlength=z - a)
                    train = np.array([not held_out(None if i == NULL_ID else i) for i in keys[a:z].tolist()])
                    rows = _rare(h[~often], owner[~often], keys[a:z], prints, train, parts)
                yield from _rows(rows + _to_documents(keys[a:z], prints, values, parts)).to_batches()

    return run


def _rare(h: np.ndarray, owner: np.ndarray, ids: np.ndarray, prints: np.ndarray, train: np.ndarray, parts: int) -> list[tuple]:
    """Entries of the words that are not frequent, once for a word and document, dealt by hash."""
    part = (h >> np.uint64(48)) % np.uint64(parts)
    order = np.lexsort((h, owner, part))
    h, owner, part = h[order], owner[order], part[order]
    new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]) if len(h) else np.zeros(0, int)
    times = np.diff(np.append(new, len(h)))
    h, owner, part = h[new], owner[new], part[new]
    rows = []
    for a, z in cuts(part):
        starts = np.array([x for x, _ in cuts(owner[a:z])], int)
        documents = owner[a:z][starts]
        # the sign of a document's number of entries tells whether it is learned from
        counts = np.diff(np.append(starts, z - a)) * np.where(train[documents], 1, -1)
        rows.append((int(part[a]), 0, -1, planes(h[a:z], 8), planes(times[a:z], 4), ids[documents].astype("<i8").tobytes(),
                     prints[documents].astype("<u8").tobytes(), counts.astype("<i4").tobytes(), b""))
    return rows


def _count_rare(parts: int):
    """A part's words: their training counts, as contributions to the documents that hold them."""
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        own = table.filter(pa.array(kind == 0))
        rest = table.filter(pa.array(kind == 1))
        join = lambda c, t: np.frombuffer(b"".join(own.column(c).to_pylist()), t)
        h = unplanes(own.column("hashes").to_pylist(), 8)
        if not len(h):
            return rest
        times = unplanes(own.column("times").to_pylist(), 4).astype(np.int64)
        counts = join("counts", "<i4").astype(np.int64)
        document = np.repeat(np.arange(len(counts)), np.abs(counts))
        learned = np.repeat(counts > 0, np.abs(counts))
        _, word = np.unique(h, return_inverse=True)
        c = np.bincount(word, times * learned)[word]
        values = np.zeros((len(counts), VALUES))
        values[:, 2] = np.bincount(document, times * (c > 0), minlength=len(counts))
        values[:, 3] = np.bincount(document, times * np.log10(c + 0.1), minlength=len(counts))
        return pa.concat_tables([rest, _rows(_to_documents(join("ids", "<i8"), join("prints", "<u8"), values, parts))])

    return run


def ctw_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return score_texts(docs)
