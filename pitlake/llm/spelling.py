"""Spelling variant grouping by dynamic programming over sorted word lists.

1. Each text's words are counted per task first, then over the whole corpus.
2. Of two words one edit apart, the longer of length M, the first or the last
   ``half(M)`` characters are the same.  So each word enters four sorted lists:
   read forward and backward, for M its own length and one more, each list
   being that of one half.  A list of one word is dropped before any sorting.
3. A task scans sorted lists, depth by depth: the rows of the edit matrix, a
   band of three cells, belong to a prefix of the list and a word that is
   looked up, so all words that share the prefix (their LCP with the word
   before reaches that far) share the row.  When all three cells exceed one edit
   the whole range of the prefix is skipped for that word.
4. Each looked-up word keeps the number of words found and the best of them;
   these are summed over the lists.  A pair whose edit lies in the middle is
   found in both directions and taken in the forward one.
5. Forms are followed to the last by doubling: each round replaces a word's
   reach by the reach of its reach.  A form is at least five times as frequent
   as its word, so there are no cycles and few rounds.

A list of more than BLOCK words is dealt in pairs of blocks (looked up, list)
to several tasks.  Rows in work at a time: LOOKED_UP words and their prefixes.

Defined cases: null and empty texts have no words; a null id counts as an
empty id in the checksum; repeated rows count as often as they occur; ties in
frequency go to the smallest word in code-point order; texts and words of any
length are taken whole (a list's matrix has as many columns as its longest
word); an empty table gives no rows; extra columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import attach, written
from pitlake.llm.runs import starts, whole_runs
from pitlake.llm.words import LOWER

#: fixed values: what a word is made of, one run in DAMAGED loses a character, shortest and rarest word, how much more frequent a form is
RUN = "[a-zA-ZÀ-ÿ]+"
DAMAGED, SHORTEST, RAREST, TIMES = 199, 6, 5, 5
#: distinct words that a task counts before it passes them on
COUNTED = 300_000
#: words of a list that one task takes as list and looks up; words looked up at a time; characters of a list in work at a time
BLOCK, LOOKED_UP, CELLS = 20_000, 4096, 4_000_000


# ------------------------------------------------------------------ words
def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n: the words long and frequent enough."""
    runs = re.compile(RUN)

    def run(batches):
        n: Counter = Counter()

        def out():
            words = list(n)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([n[w] for w in words], pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                before = zlib.crc32(f"{key}:".encode())
                for w, c in Counter(runs.findall(text.encode().translate(LOWER).decode())).items():
                    h = zlib.crc32(w.encode(), before)
                    if h % DAMAGED == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                    if len(w) >= SHORTEST:
                        n[w] += c
                if len(n) >= COUNTED:
                    yield out()
                    n.clear()
        if n:
            yield out()

    ids = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    parts = docs.select(ids, F.col(text_col)).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= RAREST)


# ------------------------------------------------------------------ lists
def half(longer):
    """Characters that two words, the longer of that length, share at one end when one edit parts them."""
    return longer // 2


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a row a word, padded by zeros; and the lengths."""
    size = np.array([len(w) for w in words], np.int64)
    wide = max(1, int(size.max(initial=0)))
    return np.array(words, f"<U{wide}").view(np.uint32).reshape(len(words), wide), size


def list_pairs(group: np.ndarray, chars: np.ndarray, size: np.ndarray, longer: np.ndarray, listed: np.ndarray, asked: np.ndarray):
    """Pairs (asked row, listed row) of one group that are one edit apart, the
    longer of them ``longer`` characters long.

    Rows are sorted by group and word; the words of a group begin with the same
    ``half(longer)`` characters.
    """
    rows = np.flatnonzero(listed)
    if not len(rows):
        return rows, rows
    # scanned: only the listed rows, in order
    l_chars, l_size, l_group = chars[rows], size[rows], group[rows]
    wide = chars.shape[1]
    same = l_chars[1:] == l_chars[:-1]
    shared = np.where(same.all(axis=1), wide, same.argmin(axis=1))
    shared[l_group[1:] != l_group[:-1]] = -1
    lcp = np.concatenate([[-1], shared])
    # words looked up, with room for a character before and two after
    questions = np.flatnonzero(asked)
    first = np.searchsorted(l_group, group[questions], "left")
    last = np.searchsorted(l_group, group[questions], "right")
    questions, first, last = questions[first < last], first[first < last], last[first < last]
    found_q, found_l = [], []
    for at in range(0, len(questions), LOOKED_UP):
        q, lo, hi = (x[at:at + LOOKED_UP] for x in (questions, first, last))
        text = np.zeros((len(q), wide + 4), np.uint32)
        text[:, :wide] = chars[q]
        depth0 = half(longer[q])
        # the words of a batch differ in length; each enters at the depth of its group's shared half
        state = [np.zeros(0, np.int64)] * 3, [np.zeros(0, np.int8)] * 3
        for depth in range(int(depth0.min(initial=0)), wide + 1):
            new = np.flatnonzero(depth0 == depth)
            (k, s, e), band = state
            k, s, e = (np.concatenate([x, y]) for x, y in zip((k, s, e), (new, lo[new], hi[new])))
            band = [np.concatenate([x, np.full(len(new), v, np.int8)]) for x, v in zip(band, (1, 0, 1))]
            if not len(k):
                if not (depth0 > depth).any():
                    break
                state = (k, s, e), band
                continue
            # the word that ends here is the first of its range
            ends = np.flatnonzero(l_size[s] == depth)
            over = size[q[k[ends]]] - depth
            fits = np.abs(over) <= 1
            ends, over = ends[fits], over[fits]
            edits = np.choose(over + 1, [band[0][ends], band[1][ends], band[2][ends]])
            hit = ends[(edits == 1) & (np.maximum(size[q[k[ends]]], depth) == longer[q[k[ends]]])]
            found_q.append(q[k[hit]])
            found_l.append(rows[s[hit]])
            if depth == wide:
                break
            # the next prefixes in each range
            branch = np.flatnonzero((lcp <= depth) & (l_size > depth))
            a, z = np.searchsorted(branch, s), np.searchsorted(branch, e)
            # a range's first word has its LCP with a word outside the range: it begins a prefix unless it ends here
            n = z - a
            owner = np.repeat(np.arange(len(k)), n)
            child = branch[np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            later = np.append(child[1:], 0)
            final = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, bool)
            until = np.where(final, e[owner], later)
            c, word = l_chars[child, depth], k[owner]
            r0, r1, r2 = (x[owner] for x in band)
            n0 = np.minimum(r1 + 1, r0 + (text[word, depth - 1] != c))
            n1 = np.minimum(np.minimum(r2 + 1, r1 + (text[word, depth] != c)), n0 + 1)
            n2 = np.minimum(r2 + (text[word, depth + 1] != c), n1 + 1)
            live = np.minimum(np.minimum(n0, n1), n2) <= 1
            state = (word[live], child[live], until[live]), [x[live].astype(np.int8) for x in (n0, n1, n2)]
    return np.concatenate([*found_q, rows[:0]]), np.concatenate([*found_l, rows[:0]])


def near_counts(words: DataFrame) -> DataFrame:
    """word, n_near, best (least n and word of the near words, n negative) for
    every list in which a word has near words; ``words``: a written table of word, n."""
    longer = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("m")
    laid = words.select("word", "n", longer).select("word", "n", "m", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    laid = laid.withColumn("way", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")))
    laid = laid.withColumn("half", F.expr("substring(way, 1, m div 2)"))
    laid = written(laid.select("m", "back", "half", "way", "n"), "spelling-lists")
    keys = ["m", "back", "half"]
    sizes = written(laid.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "spelling-sizes")
    rows = attach(laid, sizes, keys, "c")
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("way"), blocks).cast("int")
    # in block (x, y) lie the list's words of block x and the looked-up words of block y
    cell = lambda x, y, lists, asks: F.struct(x.alias("x"), y.alias("y"), lists.alias("listed"), asks.alias("asked"))
    each = F.sequence(F.lit(0), blocks - 1)
    cells = F.concat(F.transform(each, lambda k: cell(own, k, F.lit(True), k == own)),
                     F.transform(F.filter(each, lambda k: k != own), lambda k: cell(k, own, F.lit(False), F.lit(True))))
    dealt = rows.select(*keys, "way", "n", F.explode(cells).alias("e")).select(*keys, "e.x", "e.y", "way", "n", "e.listed", "e.asked")
    lists = [*keys, "x", "y"]

    def scan(t: pa.Table):
        group = np.zeros(len(t), np.int64)
        group[starts(t, lists)] = 1
        group = np.cumsum(group)
        chars, size = letters(t.column("way").to_pylist())
        m, n = (t.column(c).to_numpy().astype(np.int64) for c in ("m", "n"))
        back = t.column("back").to_numpy().astype(bool)
        q, e = list_pairs(group, chars, size, m, t.column("listed").to_numpy().astype(bool), t.column("asked").to_numpy().astype(bool))
        # found forward too: the first half is the same
        twice = back[q]
        for j in range(int(half(m).max(initial=0))):
            inside = np.flatnonzero(twice & (j < half(m[q])))
            a, b = q[inside], e[inside]
            twice[inside] = chars[a, size[a] - 1 - j] == chars[b, size[b] - 1 - j]
            # positions past the half no longer decide
            if not len(inside):
                break
        q, e = q[~twice], e[~twice]
        if not len(q):
            return None
        ways = t.column("way").to_pylist()
        word = lambda i: ways[i][::-1] if back[i] else ways[i]
        order = np.lexsort((-n[e], q))
        q, e = q[order], e[order]
        at = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        counts = np.diff(np.append(at, len(q)))
        best = []
        for s, c in zip(at.tolist(), counts.tolist()):
            top = n[e[s]]
            best.append(min(word(i) for i in e[s:s + c][n[e[s:s + c]] == top].tolist()))
        return pa.RecordBatch.from_arrays([pa.array([word(i) for i in q[at].tolist()], pa.string()), pa.array(counts), pa.array(-n[e[at]]), pa.array(best, pa.string())],
                                          ["word", "near", "less", "best"])

    def run(batches):
        for t in whole_runs(batches, lists):
            for part in bounded(t, lists):
                got = scan(part)
                if got is not None:
                    yield got

    return dealt.repartition(*lists).sortWithinPartitions(*lists, "way").mapInArrow(run, "word string, near long, less long, best string")


def bounded(t: pa.Table, keys: list[str]):
    """Parts of ``t`` of whole lists, each with a matrix of about CELLS characters (or one larger list)."""
    m = t.column("m").to_numpy()
    cuts = np.append(starts(t, keys), len(t))
    at = 0
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if a > at and (z - at) * int(m[at:z].max()) > CELLS:
            yield t.slice(at, a - at)
            at = a
    yield t.slice(at)


# ------------------------------------------------------------------ forms
def roots(forms: DataFrame) -> DataFrame:
    """word and root (its last form) for every word that has a form; ``forms``: word, form."""
    reach = written(forms.select("word", F.col("form").alias("root")), "spelling-reach")
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(reach.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-reach")
        reach = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return reach


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, n, form, root, n_near, form_n."""
    words = written(word_counts(docs, id_col, text_col), "spelling-words")
    none = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("struct<less:long,best:string>").alias("b"))
    some = near_counts(words).select("word", F.lit(None).cast("long").alias("n"), "near", F.struct("less", "best").alias("b"))
    known = none.unionByName(some).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("b").alias("b"))
    enough = -F.col("b.less") >= TIMES * F.col("n")
    known = written(known.select("word", "n", "n_near", F.when(enough, F.col("b.best")).alias("form"), F.when(enough, -F.col("b.less")).alias("form_n")), "spelling-known")
    last = roots(known.filter("form IS NOT NULL").select("word", "form"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return spelling_groups(docs)
