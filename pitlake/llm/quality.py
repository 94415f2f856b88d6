"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

Inputs of a score: the distinct words of the text, hashed into WORD_CELLS
cells; statistics of its structure (repetition, case, symbols, lengths), each
cut at quantiles of the training rows into one cell a bin; and the metadata
column n_chars, binned likewise (a null has a bin of its own).  Every two
inputs interact through the product of their RANK-dimensional factors; the sum
over all pairs is half of (square of the sum less sum of the squares), linear
in the number of inputs.  Ids, labels, language and source are never inputs.

The machine is fitted by AdaGrad on a bounded sample: the SAMPLE labelled rows
with the smallest hash of their id (all, if fewer), leaving out every row
whose id is in the held-out fold.  Only those rows' cells reach the driver.
Scoring reads all rows, map only.

Defined cases: a null or empty text has no words and is scored by its
statistics; a null id is not held out and is carried through; rows that
repeat an id get a score each; labels that repeat an id count once, as the
larger; null labels are ignored; with no labels of either class the score is
the smoothed share of label 1; an empty table gives no rows; extra columns
are never read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import load
from pitlake.llm.texts import over_texts
from pitlake.llm.words import Rolling, WordHashes, words_of

WORD_CELLS, BINS, RANK = 1 << 16, 16, 8
SAMPLE, STEPS, BATCH, RATE, DECAY, SEED = 12_000, 400, 256, 0.05, 1e-5, 11
THRESHOLD = 0.3
#: what the statistics are, in order
STATISTICS = ("log_chars", "log_words", "word_length", "distinct_words", "top_word", "adjacent_repeats", "distinct_runs", "upper",
              "digits", "symbols", "exclaims", "bars", "stops", "words_a_line", "distinct_lines", "symbol_ends", "meta_chars")

_UPPER, _DIGIT, _SYMBOL, _STOP = (np.array([c in s for c in range(256)], float) for s in (
    range(65, 91), range(48, 58), b"#$%&*@^~_=+<>{}[]\\/", b".,;:"))
_ENDS = tuple(bytes([c]) for c in b"#$%&*!|")


def statistics(text: str, words: list[bytes], h: np.ndarray, counts: np.ndarray, rolling: Rolling, n_chars) -> list[float]:
    letters = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size, n = max(1, letters.sum()), max(1, len(words))
    lines = text.split("\n")
    runs = rolling(h)
    return [np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / n, len(counts) / n, counts.max(initial=0) / n,
            (h[1:] == h[:-1]).sum() / n, len(np.unique(runs)) / max(1, len(runs)), letters @ _UPPER / size, letters @ _DIGIT / size,
            letters @ _SYMBOL / size, letters[33] / size, letters[124] / size, letters @ _STOP / size, n / len(lines),
            len(set(lines)) / len(lines), sum(w.endswith(_ENDS) for w in words) / n, -1.0 if n_chars is None else np.log1p(abs(n_chars))]


def _inputs(docs: DataFrame, id_col: str, text_col: str, chars_col: str, columns: dict, finish) -> DataFrame:
    """Words' cells and statistics of every text, handed to ``finish`` slice by slice."""
    def make():
        hashes, rolling = WordHashes(), Rolling(5)
        last = finish()

        def run(texts, chars):
            cells, stats = [], []
            for t, c in zip(texts, chars):
                words = words_of(t)
                h = hashes.of(words)
                distinct, counts = np.unique(h, return_counts=True)
                cells.append(np.unique(distinct % np.uint64(WORD_CELLS)).astype(np.int32))
                stats.append(statistics(t, words, h, counts, rolling, c))
            return last(cells, np.array(stats))

        return run

    return over_texts(docs, id_col, text_col, make, columns, also=(chars_col,))


def rows_of(cells: list[np.ndarray], stats: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat cells, their values and each row's first place: words share a weight of 1, a statistic has 1 / sqrt of their number."""
    n_stats = stats.shape[1]
    out, values = [], []
    for c, s in zip(cells, stats):
        bins = [WORD_CELLS + k * BINS + int(np.searchsorted(edges[k], x, side="right")) for k, x in enumerate(s)]
        out.append(np.concatenate([bins, c]).astype(np.int64))
        values.append(np.concatenate([np.full(n_stats, n_stats ** -0.5), np.full(len(c), max(1, len(c)) ** -0.5)]))
    starts = np.cumsum([0, *map(len, out)])[:-1]
    return np.concatenate(out), np.concatenate(values), starts


class Machine:
    """Bias, weights and factors; ``margin`` uses the sum-of-squares identity."""

    def __init__(self, bias: float, n: int, rng=None):
        self.bias, self.w = bias, np.zeros(n)
        self.v = rng.normal(0, 0.05, (n, RANK)) if rng is not None else np.zeros((n, RANK))

    def margin(self, cells, values, starts):
        vx = self.v[cells] * values[:, None]
        total = np.add.reduceat(vx, starts)
        pairs = 0.5 * (total ** 2 - np.add.reduceat(vx ** 2, starts)).sum(axis=1)
        return self.bias + np.add.reduceat(self.w[cells] * values, starts) + pairs, total

    def score(self, cells, values, starts):
        return 1 / (1 + np.exp(-np.clip(self.margin(cells, values, starts)[0], -30, 30)))


def fit(cells: list[np.ndarray], stats: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, Machine]:
    """Bin edges and the machine, by AdaGrad on the logistic loss."""
    n = WORD_CELLS + len(STATISTICS) * BINS
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        return np.zeros((len(STATISTICS), BINS - 1)), Machine(bias, n)
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    rng = np.random.default_rng(SEED)
    m = Machine(bias, n, rng)
    gw, gv, gb = np.full(n, 1e-8), np.full((n, RANK), 1e-8), 1e-8
    order = np.zeros(0, int)
    for _ in range(STEPS):
        if not len(order):
            order = rng.permutation(len(labels))
        rows, order = order[:BATCH], order[BATCH:]
        c, x, starts = rows_of([cells[i] for i in rows], stats[rows], edges)
        margin, total = m.margin(c, x, starts)
        g = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]
        lengths = np.diff(np.append(starts, len(c)))
        gx = np.repeat(g, lengths) * x
        each = gx[:, None] * (np.repeat(total, lengths, axis=0) - m.v[c] * x[:, None])
        touched, place = np.unique(c, return_inverse=True)
        dw = np.bincount(place, gx, len(touched)) / len(rows) + DECAY * m.w[touched]
        dv = np.stack([np.bincount(place, each[:, f], len(touched)) for f in range(RANK)], 1) / len(rows) + DECAY * m.v[touched]
        gw[touched] += dw ** 2
        gv[touched] += dv ** 2
        gb += g.mean() ** 2
        m.w[touched] -= RATE * dw / np.sqrt(gw[touched])
        m.v[touched] -= RATE * dv / np.sqrt(gv[touched])
        m.bias -= RATE * g.mean() / gb ** 0.5
    return edges, m


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether the id is in the fold that is never learned from; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
          label_col: str = "quality") -> tuple:
    """Bin edges, bias, weights and factors fitted on the bounded sample of labelled rows."""
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("__label")).dropna()
             .filter(~held_out("doc_id")).groupBy("doc_id").agg(F.max("__label").alias("__label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    # SAMPLE rows at most are broadcast, so the texts stay where they are
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(chars_col).cast("long").alias("n_chars"))
    sample = own.join(F.broadcast(known), "doc_id").select(F.struct("doc_id", "__label").alias("key"), "text", "n_chars")
    rows = _inputs(sample, "key", "text", "n_chars", {"cells": "array<int>", "stats": "array<double>"},
                   lambda: lambda cells, stats: {"cells": cells, "stats": list(stats)}).toArrow()
    keys, cells, stats = (rows.column(c).to_pylist() for c in ("doc_id", "cells", "stats"))
    marks = [k["__label"] for k in keys]
    order = np.argsort([k["doc_id"] for k in keys], kind="stable")      # the same rows give the same machine
    edges, m = fit([np.array(cells[i], np.int32) for i in order], np.array([stats[i] for i in order]).reshape(-1, len(STATISTICS)),
                   np.array([marks[i] for i in order], float))
    return edges, m.bias, m.w.astype(np.float32), m.v.astype(np.float32)


def scored(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """doc_id (the value of ``id_col``, of any type) and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def finish():
        edges, bias, w, v = shared.value
        machine = Machine(bias, 0)
        machine.w, machine.v = w, v
        return lambda cells, stats: {"score": machine.score(*rows_of(cells, stats, edges))}

    return _inputs(docs.withColumn(chars_col, F.col(chars_col).cast("long")), id_col, text_col, chars_col, {"score": "double"}, finish)


def quality_query(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = scored(docs, learn(docs, load(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject; whole rows pass through the scoring, without a join."""
    model = learn(docs, load(spark, sf_dir, "labels"))
    rows = docs.withColumn("__row", F.struct(*docs.columns))
    return scored(rows, model, "__row").filter(F.col("score") >= THRESHOLD).select("doc_id.*")
