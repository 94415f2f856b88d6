"""Cross-tokenizer alignment by galloping intersection of token ends.

1. Both tokenizers encode a text.  The byte offsets at which tokens end are two
   ascending lists; of the documents of a slice they lie one after the other
   in one array each.  Per document the shorter list drives: for each of
   its ends an exponential search starts at the proportional place of the longer
   list, and a binary search ends it; all ends move on together.
2. Ends in both lists cut the tokens into groups; the differences of their ranks
   are the groups' token ranges in A and B.  All A-B pairs inside a group are links.
3. A document's distinct id pairs, with their numbers of links, are written
   packed.  Pairs are counted per task first, then over the corpus; the highest
   count of each A id is a table as long as A's vocabulary at most.
4. Counts come back to the documents.  With T pairs in all documents, fewer
   than COMMON id pairs are held by more than T / COMMON documents: these are
   broadcast (COMMON entries of 13 bytes at most).  All other pairs have few
   holders and are joined by shuffle, so no key is hot.

The vocabularies are fixed files, read by the executors' libraries from the
bytes that the driver broadcasts.  A's file is encoded by ``tiktoken`` where it
is a plain byte-level one whose ids follow the merges (the ids are then the
same, for every code point, in a fraction of the time), else by ``tokenizers``.

Defined cases: a text that is null or empty, or whose tokens do not spell it
out again, has no tokens: zeros and an empty string; ties for an id's highest
count all count as best; texts of any length are read whole (memory holds one
slice of a million characters, or one longer text, and its links: a group's
pairs are counted by distinct ids); rows that repeat an id are documents of
their own; a null id is carried through; an empty table gives no rows; extra
columns are never read.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.bpe import byte_symbols
from pitlake.llm.common import written
from pitlake.llm.packed import summed
from pitlake.llm.texts import over_texts

#: id pairs held by more than 1/COMMON of all (document, pair) rows are broadcast
COMMON = 2_000_000
#: links of a group up to which they are listed one by one
LISTED = 256
#: distinct pairs that a task counts before it passes them on
COUNTED = 2_000_000
#: the character that stands for a space in B's pieces
SPACE_PIECE = "▁"


# ------------------------------------------------------------------ tokenizers
#: fixed value: how byte-level BPE splits a text before merging
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizers:
    """A (byte-level BPE, ``tokenizers`` file) and B (``sentencepiece`` model), and the bytes of each id."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece

        spec = json.loads(a_file)
        value = {s: k for k, s in enumerate(byte_symbols())}
        names = spec["model"]["vocab"]
        added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.a_bytes = [b""] * (max([*names.values(), *added]) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(value[c] for c in name)
        for i, name in added.items():
            self.a_bytes[i] = name
        self.encode_a = self._by_ranks(spec, added) if self._plain(spec) else self._by_file(a_file)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))

    @staticmethod
    def _plain(spec: dict) -> bool:
        """Whether the file splits in the usual way and the id of each merge follows its rank."""
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        return (spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") is True
                and split.get("add_prefix_space") is False and not any(model.get(k) for k in options) and merged == list(range(256, 256 + len(merged)))
                and len(model["vocab"]) == 256 + len(merged))

    def _by_ranks(self, spec: dict, added: dict):
        import tiktoken

        ranks = {b: i for i, b in enumerate(self.a_bytes) if b and i not in added}
        one = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [one.encode_ordinary(t) for t in texts]

    @staticmethod
    def _by_file(a_file: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        one = tokenizers.Tokenizer.from_str(a_file.decode())
        one.encode_special_tokens = True
        one.no_truncation()
        one.no_padding()
        return lambda texts: [e.ids for e in one.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_PIECE, " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids by A and by B of each text; none where they do not spell it out."""
        some = [t for t in texts if t]
        a = iter(self.encode_a([" " + t for t in some]))
        b = iter(self.b.encode(some, num_threads=1) if some else [])
        out = []
        for t in texts:
            x, y = (next(a), next(b)) if t else ([], [])
            raw = b" " + t.encode()
            if t and (b"".join([self.a_bytes[i] for i in x]) != raw or b"".join([self.b_bytes[i] for i in y]) != raw):
                x, y = [], []
            out.append((np.array(x, np.int64), np.array(y, np.int64)))
        return out


# ------------------------------------------------------------------ intersection
def gallop(targets: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each target the first place of the ascending ``ends`` that is not
    below it, by exponential search from the place ``at`` and binary search in
    the bracket found."""
    n = len(ends)
    low, high = np.zeros(len(targets), np.int64), np.full(len(targets), n, np.int64)
    at = np.clip(at, 0, max(n - 1, 0))
    below = ends[at] < targets
    for sign, rows in ((1, np.flatnonzero(below)), (-1, np.flatnonzero(~below))):
        place, step = at[rows], 1
        while len(rows):
            ahead = place + sign * step
            inside = (ahead >= 0) & (ahead < n)
            low_side = ends[np.clip(ahead, 0, n - 1)] < targets[rows]
            if sign > 0:        # ends[place] is below the target
                low[rows] = place + 1
                stop = ~inside | ~low_side
                high[rows[stop & inside]] = ahead[stop & inside]
            else:               # ends[place] is not
                high[rows] = place
                stop = ~inside | low_side
                low[rows[stop & inside]] = ahead[stop & inside] + 1
            rows, place, step = rows[~stop], ahead[~stop], 2 * step
    rows = np.flatnonzero(low < high)
    while len(rows):
        middle = (low[rows] + high[rows]) // 2
        below = ends[middle] < targets[rows]
        low[rows[below]] = middle[below] + 1
        high[rows[~below]] = middle[~below]
        rows = rows[low[rows] < high[rows]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that are in both.  ``n_a``, ``n_b``: ends of each
    document, whose ranges of values do not overlap."""
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    at_a, at_b = [], []
    for short_is_a in (True, False):
        docs = np.flatnonzero((n_a <= n_b) == short_is_a)
        (n_s, f_s, short), (n_l, f_l, long) = ((n_a, first_a, a), (n_b, first_b, b))[::1 if short_is_a else -1]
        count = n_s[docs]
        rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        places = np.repeat(f_s[docs], count) + rank
        guess = np.repeat(f_l[docs], count) + rank * np.repeat(n_l[docs], count) // np.maximum(np.repeat(count, count), 1)
        if not len(places):
            continue
        hit = gallop(short[places], long, guess)
        ok = long[np.minimum(hit, len(long) - 1)] == short[places]
        s, x = places[ok], hit[ok]
        at_a.append(s if short_is_a else x)
        at_b.append(x if short_is_a else s)
    if not at_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both_a, both_b = np.concatenate(at_a), np.concatenate(at_b)
    order = np.argsort(both_a, kind="stable")
    return both_a[order], both_b[order]


# ------------------------------------------------------------------ slices of texts
class Aligner:
    def __init__(self, files: tuple[bytes, bytes]):
        t = self.tokenizers = Tokenizers(*files)
        # each id's decimal digits with the sign that can follow it
        digits = lambda n: np.array([f"{i}{end}" for i in range(n) for end in ",|;"], object)
        self.a_text, self.b_text = digits(len(t.a_bytes)), digits(len(t.b_bytes))

    def __call__(self, texts: list[str]) -> dict:
        t = self.tokenizers
        ids = t.encode(texts)
        n_a, n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in range(2))
        a, b = (np.concatenate([x[k] for x in ids]) for k in range(2))
        ia, ib = common_ends(np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b]), n_a, n_b)
        # ranks of common ends: group g holds A tokens from a_cut[g] to a_cut[g + 1]
        a_cut, b_cut = (np.concatenate([[0], x + 1]) for x in (ia, ib))
        size_a, size_b = np.diff(a_cut), np.diff(b_cut)
        doc = np.repeat(np.arange(len(texts)), n_a)[ia]
        n_groups = np.bincount(doc, minlength=len(texts))
        links = size_a * size_b
        n_links = self._by_document(links, n_groups)
        pairs, times, n_pairs = self._pairs(a, b, a_cut, b_cut, doc, len(texts))
        at = np.concatenate([[0], np.cumsum(n_pairs)])
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": self._digests(a, b, size_a, size_b, n_a + n_b),
                "pairs": [pairs[s:e].astype("<u4").tobytes() for s, e in zip(at[:-1].tolist(), at[1:].tolist())],
                "times": [times[s:e].astype("<i8").tobytes() for s, e in zip(at[:-1].tolist(), at[1:].tolist())]}

    @staticmethod
    def _by_document(values: np.ndarray, n: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        last = np.cumsum(n)
        return total[last] - total[last - n]

    def _pairs(self, a, b, a_cut, b_cut, doc, n_docs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of each document in turn, their numbers of links, and how many pairs a document has."""
        width = len(self.tokenizers.b_bytes)
        size_a, size_b = np.diff(a_cut), np.diff(b_cut)
        links = size_a * size_b
        small = np.flatnonzero(links <= LISTED)
        n = links[small]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(size_b[small], n)
        left = a[np.repeat(a_cut[small], n) + inside // np.maximum(wide, 1)]
        right = b[np.repeat(b_cut[small], n) + inside % np.maximum(wide, 1)]
        keys = [(np.repeat(doc[small], n) << 32) | (left * width + right)]
        times = [np.ones(len(left), np.int64)]
        for g in np.flatnonzero(links > LISTED).tolist():
            x, cx = np.unique(a[a_cut[g]:a_cut[g + 1]], return_counts=True)
            y, cy = np.unique(b[b_cut[g]:b_cut[g + 1]], return_counts=True)
            keys.append((int(doc[g]) << 32) | (x[:, None] * width + y[None, :]).ravel())
            times.append((cx[:, None] * cy[None, :]).ravel())
        key, total = summed(np.concatenate(keys), np.concatenate(times))
        return key & 0xFFFFFFFF, total, np.bincount(key >> 32, minlength=n_docs)

    def _digests(self, a, b, size_a, size_b, n_tokens) -> list[str]:
        before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[before_a + size_a - 1] = 1
        sign_b[before_b + size_b - 1] = 2
        # a token stands after all tokens of the groups before, B after A
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.repeat(before_b, size_a)] = self.a_text[a * 3 + sign_a]
        out[np.arange(len(b)) + np.repeat(before_a + size_a, size_b)] = self.b_text[b * 3 + sign_b]
        last = np.cumsum(n_tokens)
        return [hashlib.sha256("".join(out[z - n:z])[:-1].encode()).hexdigest() if n else "" for n, z in zip(n_tokens.tolist(), last.tolist())]


# ------------------------------------------------------------------ corpus
def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned(docs: DataFrame, files: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its
    distinct id pairs (A id * size of B + B id) and their links, packed as 32- and 64-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(open(p, "rb").read() for p in files or default_files()))
    kept = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string", "pairs": "binary", "times": "binary"}
    return over_texts(docs, id_col, text_col, lambda: Aligner(shared.value), kept)


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and links of every (document, pair) of a batch of row, pairs, times."""
    raw, times = (b"".join(batch.column(k).to_pylist()) for k in (1, 2))
    n = np.array([len(x) // 4 for x in batch.column(1).to_pylist()], np.int64)
    return np.repeat(batch.column(0).to_numpy(), n), np.frombuffer(raw, "<u4").astype(np.int64), np.frombuffer(times, "<i8")


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair and n, the number of documents that hold it, of ``rows`` (row, pairs, times)."""

    def run(batches):
        held, size = [], 0

        def merged():
            return summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))

        for batch in batches:
            _, pair, _ = unpacked(batch)
            held.append((pair, np.ones(len(pair), np.int64)))
            size += len(pair)
            if size < 2 * COUNTED:
                continue
            keys, n = merged()
            held, size = [(keys, n)], len(keys)
            if size >= COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])
                held, size = [], 0
        if size:
            keys, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])

    return rows.select("row", "pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def document_sums(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """row, n_best and count_sum; ``counts``: a written table of pair, n, best."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.filter(F.col("n") * COMMON > total).select("pair", "n", "best").toArrow()
    order = np.argsort(common.column("pair").to_numpy())
    shared = rows.sparkSession.sparkContext.broadcast(
        (common.column("pair").to_numpy()[order], common.column("n").to_numpy()[order], common.column("best").to_numpy()[order].astype(np.int64)))

    def run(batches):
        known, n, best = shared.value
        for batch in batches:
            row, pair, times = unpacked(batch)
            if not len(row):
                continue
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            here = row[begin]
            sums = [np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)]
            sums[0][hit], sums[1][hit] = times[hit] * best[at[hit]], times[hit] * n[at[hit]]
            n_best, count_sum = (np.add.reduceat(s, begin) for s in sums)
            rest = ~hit
            none = pa.nulls(len(here), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(here), none, none, pa.array(n_best), pa.array(count_sum)], ["row", "pair", "times", "n_best", "count_sum"])
            if rest.any():
                none = pa.nulls(int(rest.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(row[rest]), pa.array(pair[rest]), pa.array(times[rest]), none, none], ["row", "pair", "times", "n_best", "count_sum"])

    parts = written(rows.select("row", "pairs", "times").mapInArrow(run, "row long, pair long, times long, n_best long, count_sum long"), "align-parts")
    rare = (parts.filter("pair IS NOT NULL").select("row", "pair", "times").join(counts, "pair")
            .select("row", (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")))
    return (parts.filter("pair IS NULL").select("row", "n_best", "count_sum").unionByName(rare)
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))


def alignment(docs: DataFrame, files: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``aligned`` with n_best and count_sum, which need the whole corpus."""
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=(files or default_files())[1]).get_piece_size()
    # the row numbers hold once they are written
    rows = written(aligned(docs, files, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "align-rows")
    plain = written(pair_counts(rows), "align-counts")
    # one row for each id of A at most
    highest = F.broadcast(plain.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("n").alias("most")))
    counts = written(plain.withColumn("a", F.expr(f"pair div {width}")).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "align-best")
    sums = document_sums(rows, counts)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def alignment_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return alignment(docs)
