"""Mixing sources to target weights by soft membership.

A document belongs to every domain with its posterior, which a multinomial
classifier over hashed words predicts; the classifier is fitted on labelled
rows, by default a bounded sample of the rows that the labelled table lists.
The rates, a nonnegative number of expected copies per document, minimise

    sum over domains of (expected tokens - target)^2 / present tokens

Projected gradient steps find them, from all rates 1: each step moves a rate
against its posterior times one number a domain, holds it at the least rate, and
goes all or part of the way there.  Step lengths are spectral (from the last
step's change of rates and totals), and a step that raises the sum above the
last ones' is shortened to its best part, which is known because totals are
linear in the rates.  A rate is its row's posterior and the list of steps, so
no state per document is kept; a step is one distributed pass whose rows are a
few numbers per task.  The fit ends when the targets are met; or when the
projected-gradient residual is nought: then active bounds, or posteriors that are all
alike, let nothing come nearer; or after STEPS steps with the best point
reached.  Which it was is in the column ``fit`` ("met", "optimal", "stopped"),
beside the target and the reached total of the domain.

Defined cases: a null or empty text has no tokens, posterior equal to the
domains' shares, and a rate like any other; a null id is carried through;
repeated rows get a rate each; domains without labelled rows keep the smoothed
posterior; with no labelled rows, posteriors are equal; an empty table gives
no rows; very long texts are counted whole, and of equal posteriors the first
domain is the likeliest; extra columns are never read.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import load, written
from pitlake.llm.texts import over_texts
from pitlake.llm.words import WordHashes, words_of

log = logging.getLogger(__name__)

CELLS, SMOOTH = 1 << 14, 0.5
#: labelled rows that the classifier is fitted on
SAMPLE = 20_000
#: stop when every total is this near its target, or when a plain step's squared length is this share of the sum, or after so many steps
NEAR, STILL, STEPS = 1e-4, 1e-6, 200
#: a full step may raise the sum above the last one's, but not above the highest of so many
LOOK_BACK, LONGEST = 8, 1e6

#: target share of tokens of each domain in the registered query and the pipeline
TARGETS = {"en": 0.5, "fr": 0.18, "de": 0.18, "es": 0.14}


def _cells(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, int]:
    words = words_of(text, lower=True)
    cells, counts = np.unique(hashes.of(words) % np.uint64(CELLS), return_counts=True)
    return cells.astype(np.int64), counts, len(words)


def learn_domains(docs: DataFrame, labelled: DataFrame, domains: list[str], domain_col: str, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Log chance of each cell in each domain, with the domains' log shares in the last column."""
    rows = (labelled.select(id_col).dropna().distinct().orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE))
    # SAMPLE ids at most are broadcast
    known = docs.join(F.broadcast(rows), id_col, "left_semi").filter(F.col(domain_col).isin(domains)).select(F.col(domain_col).alias("d"), F.col(text_col).alias("t"))

    def count(batches):
        hashes, total = WordHashes(), np.zeros((len(domains), CELLS + 1))
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                cells, n, _ = _cells(t or "", hashes)
                total[domains.index(d), cells] += n
                total[domains.index(d), CELLS] += 1
        k, c = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c), pa.array(total[k, c])], ["k", "c", "n"])

    # one row per domain and cell, whatever the size of the sample
    sums = known.mapInArrow(count, "k long, c long, n double").groupBy("k", "c").agg(F.sum("n")).collect()
    table = np.zeros((len(domains), CELLS + 1))
    for k, c, n in sums:
        table[k, c] = n
    words, rows_n = table[:, :CELLS] + SMOOTH, table[:, CELLS] + 1
    return np.hstack([np.log(words / words.sum(axis=1, keepdims=True)), np.log(rows_n / rows_n.sum())[:, None]])


def posteriors(docs: DataFrame, table: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and posterior of every document; evidence counts with the square root of its length."""
    shared = docs.sparkSession.sparkContext.broadcast(table.astype(np.float32))

    def make():
        logs, hashes = shared.value, WordHashes()

        def run(texts):
            out, sizes = [], []
            for t in texts:
                cells, n, size = _cells(t, hashes)
                x = logs[:, CELLS] + (logs[:, cells] @ n) / max(1, size) ** 0.5
                p = np.exp(x - x.max())
                out.append((p / p.sum()).astype(np.float64))
                sizes.append(size)
            return {"n_tokens": sizes, "posterior": out}

        return run

    return over_texts(docs, id_col, text_col, make, {"n_tokens": "long", "posterior": "array<double>"})


def _rates(p: np.ndarray, steps: list[tuple[np.ndarray, float, float]], least: float) -> np.ndarray:
    """The rates after ``steps`` (gradient in the domains, step length, part taken)."""
    r = np.full(len(p), max(1.0, least))
    for gradient, length, part in steps:
        r = r + part * (np.maximum(least, r - length * (p @ gradient)) - r)
    return r


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, k)


@dataclass
class Fit:
    steps: list           # (gradient in the domains, step length, part taken) of each step
    target: np.ndarray    # tokens asked of each domain
    reached: np.ndarray   # expected tokens of each domain
    state: str            # met, optimal or stopped


def _summed(soft: DataFrame, width: int, sums) -> np.ndarray:
    """``sums(posteriors, tokens)``, ``width`` numbers, added up over all rows of ``soft``."""

    def run(batches):
        s = np.zeros(width)
        for b in batches:
            n = b.column(0).to_numpy()
            s += sums(b.column(1).flatten().to_numpy().reshape(len(n), -1), n)
        yield pa.RecordBatch.from_arrays([pa.array([s.tolist()], pa.list_(pa.float64()))], ["s"])

    rows = soft.select("n_tokens", "posterior").mapInArrow(run, "s array<double>")
    return np.array([x or 0.0 for x in rows.agg(*(F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(width))).first()])


def fit_rates(soft: DataFrame, weights: np.ndarray, least: float = 0.0, budget: float | None = None) -> Fit:
    """Rates of the written table ``soft`` (n_tokens, posterior) whose expected totals are ``weights`` of ``budget``.

    ``budget`` is the number of tokens to mix; if None, the smallest one that
    asks no domain for less than it has.
    """
    k = len(weights)
    now = present = _summed(soft, k, lambda p, n: n @ p) * max(1.0, least)
    scale = np.maximum(present / max(1.0, least), 1.0)
    budget = budget if budget is not None else float((present / max(1.0, least) / weights).max(initial=0.0))
    target = weights * budget
    missed = lambda totals: float((((totals - target) ** 2) / scale).sum()) / 2
    steps, length, seen = [], 1.0, []
    best = Fit(steps, target, now, "stopped")
    while True:
        if missed(now) <= missed(best.reached):
            best = Fit(steps, target, now, "stopped")
        if np.abs((now - target) / scale).max(initial=0.0) < NEAR:
            best = Fit(steps, target, now, "met")
            return best
        if len(steps) == STEPS:
            break
        gradient = (now - target) / scale

        def sums(p, n, steps=steps, gradient=gradient, length=length):
            r = _rates(p, steps, least)
            along = p @ gradient
            move, plain = np.maximum(least, r - length * along) - r, np.maximum(least, r - along) - r
            return np.concatenate([(n * move) @ p, [n @ move ** 2, n @ plain ** 2]])

        got = _summed(soft, k + 2, sums)
        if got[k + 1] <= STILL * missed(now):
            best = Fit(steps, target, now, "optimal")
            break
        change, part = got[:k], 1.0
        slope, curve = float(gradient @ change), float((change ** 2 / scale).sum())
        seen = [*seen, missed(now)][-LOOK_BACK:]
        if missed(now + change) > max(seen) + 1e-4 * slope:
            part = min(1.0, -slope / curve)
        steps = [*steps, (gradient, length, part)]
        now = now + part * change
        length = min(max(got[k] / curve, 1.0), LONGEST) if curve > 0 else LONGEST
    log.warning("mixing: %s after %d steps; target %s, reached %s", best.state, len(best.steps), target.tolist(), best.reached.tolist())
    return best


def mixed(soft: DataFrame, steps: list, domains: list[str], least: float = 0.0) -> DataFrame:
    """``soft`` with each document's rate, likeliest domain and copies (the rate, rounded by a hash of the id)."""
    k = len(domains)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_rates(_matrix(b.column(2), k), steps, least))], [*b.schema.names, "rate"])

    kind = soft.schema["doc_id"].dataType.simpleString()
    rated = soft.select("doc_id", "n_tokens", "posterior").mapInArrow(run, f"doc_id {kind}, n_tokens long, posterior array<double>, rate double")
    best = F.array_position("posterior", F.array_max("posterior"))
    name = F.element_at(F.array(*map(F.lit, domains)), best.cast("int"))
    return rated.withColumn("domain", name)


def copies(rate, key):
    """Whole copies: the rate rounded up or down by the hash of ``key``, so that the mean is the rate."""
    part = F.pmod(F.xxhash64(key), F.lit(1 << 20)) / float(1 << 20)
    return (F.floor(rate) + (part < rate - F.floor(rate)).cast("long")).cast("int")


def mixing_query(spark: SparkSession, docs: DataFrame, sf_dir: str, targets: dict[str, float] | None = None) -> DataFrame:
    """Rates of all documents for the target shares; every domain gets at least the tokens it has."""
    names = list(targets or TARGETS)
    weights = np.array([(targets or TARGETS)[d] for d in names])
    soft = written(posteriors(docs, learn_domains(docs, load(spark, sf_dir, "labels"), names, "lang")), "mix-posteriors")
    fit = fit_rates(soft, weights)
    of = lambda x: F.element_at(F.create_map(*(F.lit(v) for d, t in zip(names, x) for v in (d, float(t)))), F.col("domain"))
    return (mixed(soft, fit.steps, names).withColumn("copies", copies(F.col("rate"), F.col("doc_id")))
            .withColumn("domain_target", of(fit.target)).withColumn("domain_reached", of(fit.reached)).withColumn("fit", F.lit(fit.state)))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as its rate says; rates are held at 1 or more, so every document stays.

    Null ids and repeated rows get a rate row by row; a null, empty or very
    long text is a row like any other; without labels or rows the stage gives
    what it got.  Reached totals are logged.
    """
    names, weights = list(TARGETS), np.array(list(TARGETS.values()))
    table = learn_domains(docs, load(spark, sf_dir, "labels"), names, "lang")
    rows = docs.withColumn("__row", F.struct(*docs.columns))       # whole rows pass through, without a join
    soft = written(posteriors(rows, table, "__row"), "mix-posteriors")
    fit = fit_rates(soft, weights, least=1.0)
    log.info("mixing: %s after %d steps; target %s, reached %s", fit.state, len(fit.steps), fit.target.tolist(), fit.reached.tolist())
    rated = mixed(soft, fit.steps, names, least=1.0)
    times = rated.withColumn("n", copies(F.col("rate"), F.col("doc_id.doc_id")))
    return times.select("doc_id", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), "n")))).select("doc_id.*")
