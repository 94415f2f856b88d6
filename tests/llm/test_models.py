"""Operators 6 and 7 and the pipeline: held-out accuracy, optimality, effects."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitlake.llm import mixing, quality
from pitlake.llm.common import load

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def test_identity_equals_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, 50, rng)
    m.w = rng.normal(size=50)
    cells, values = np.array([3, 7, 9, 20, 7]), rng.normal(size=5)
    starts = np.array([0, 3])
    got = m.margin(cells, values, starts)[0]
    for k, part in enumerate((slice(0, 3), slice(3, 5))):
        c, x = cells[part], values[part]
        want = 0.3 + m.w[c] @ x + sum(m.v[c[i]] @ m.v[c[j]] * x[i] * x[j] for i in range(len(c)) for j in range(i))
        assert got[k] == pytest.approx(want)


def test_quality_held_out(spark):
    docs = load(spark, SF, "documents")
    rows = quality.quality_query(spark, docs, SF).join(load(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == 1 for r in rows if r.quality == 1)


def test_quality_reads_no_labels_of_the_held_out_fold(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.learn(docs, labels), quality.learn(docs, turned)
    assert a[1] == b[1] and all(np.array_equal(a[k], b[k]) for k in (0, 2, 3))


def test_quality_edges(spark, edge_docs, edge_pairs, no_docs):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(20)] + [(3, None, 0), (None, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0), labels.filter("quality = 1")):
        model = quality.learn(edge_docs, marks)
        rows = quality.scored(edge_docs, model).collect()
        assert len(rows) == len(edge_pairs) and all(0 <= r.score <= 1 for r in rows)
        assert quality.scored(no_docs, model).count() == 0


def test_rates_reach_targets(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 500, 400)
    soft = spark.createDataFrame([(k, int(a), b.tolist()) for k, (a, b) in enumerate(zip(n, p))], "doc_id long, n_tokens long, posterior array<double>")
    weights = np.array([0.6, 0.3, 0.1])
    fit = mixing.fit_rates(soft, weights)
    assert fit.state == "met" and np.abs(fit.reached - fit.target).max() / fit.target.max() < 1e-3
    rates = mixing._rates(p, fit.steps, 0.0)
    assert (rates >= 0).all() and (p * (n * rates)[:, None]).sum(axis=0) == pytest.approx(fit.reached)


def dense_least_squares(p, n, target, least, rounds=2000):
    """The same least squares, one rate after the other to its own optimum: the totals and the sum."""
    total = present = (p * n[:, None]).sum(axis=0)
    r = np.ones(len(p))
    for _ in range(rounds):
        for i in range(len(p)):
            slope, curve = n[i] * p[i] @ ((total - target) / present), n[i] ** 2 * (p[i] ** 2 / present).sum()
            new = max(least, r[i] - slope / curve)
            total, r[i] = total + n[i] * p[i] * (new - r[i]), new
    return total, ((total - target) ** 2 / present).sum()


@pytest.mark.parametrize("least,share,weights", [(1.0, 0.9, (0.6, 0.3, 0.1)), (0.0, 1.0, (0.85, 0.1, 0.05)), (1.0, 1.5, (0.6, 0.3, 0.1))])
def test_rates_against_dense_least_squares(spark, monkeypatch, least, share, weights):
    """Also where bounds keep the totals from their targets, the sum and the reached totals are those of the dense solution."""
    rng = np.random.default_rng(2)
    p, n = rng.dirichlet([0.8, 0.8, 0.8], 60), rng.integers(1, 500, 60)
    soft = spark.createDataFrame([(k, int(a), b.tolist()) for k, (a, b) in enumerate(zip(n, p))], "doc_id long, n_tokens long, posterior array<double>").coalesce(1)
    budget = float(n.sum()) * share
    fit = mixing.fit_rates(soft, np.array(weights), least=least, budget=budget)
    rates = mixing._rates(p, fit.steps, least)
    present = (p * n[:, None]).sum(axis=0)
    assert (rates >= least).all() and (p * (n * rates)[:, None]).sum(axis=0) == pytest.approx(fit.reached)
    total, value = dense_least_squares(p, n, fit.target, least)
    assert fit.state in ("met", "optimal")
    assert ((fit.reached - fit.target) ** 2 / present).sum() <= value * 1.01 + 0.01 and np.abs(fit.reached - total).max() <= 1e-2 * budget


def test_mixing_of_weakly_separated_posteriors(spark, monkeypatch):
    """Small steps are not the end: the targets are met where rates can meet them, and a fit that is cut short says so."""
    rng = np.random.default_rng(5)
    p = np.clip(0.5 + rng.normal(0, 0.004, 600), 0.45, 0.55)
    soft = spark.createDataFrame([(k, 100, [float(x), float(1 - x)]) for k, x in enumerate(p)], "doc_id long, n_tokens long, posterior array<double>")
    weights = np.array([0.501, 0.499])
    fit = mixing.fit_rates(soft, weights, budget=60_000.0)
    assert fit.state == "met" and np.abs(fit.reached - fit.target).max() < 1e-3 * fit.target.max() / 5
    rates = mixing._rates(np.c_[p, 1 - p], fit.steps, 0.0)
    assert (np.c_[p, 1 - p] * rates[:, None] * 100).sum(axis=0) == pytest.approx(fit.reached)
    monkeypatch.setattr(mixing, "STEPS", 0)
    fit = mixing.fit_rates(soft, weights, budget=60_000.0)
    assert fit.state == "stopped" and fit.steps == [] and fit.reached.sum() == pytest.approx(60_000.0)


def test_mixing_of_posteriors_all_alike(spark):
    soft = spark.createDataFrame([(k, 100, [0.5, 0.5]) for k in range(50)], "doc_id long, n_tokens long, posterior array<double>")
    fit = mixing.fit_rates(soft, np.array([0.7, 0.3]), budget=5000.0)
    assert fit.state == "optimal" and fit.reached == pytest.approx([2500.0, 2500.0], rel=1e-3)


def test_mixing_query(spark):
    docs = load(spark, SF, "documents")
    rows = mixing.mixing_query(spark, docs, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    big = [r for r in rows if r.n_tokens > 50]
    assert np.mean([r.domain == r.lang for r in big]) > 0.97
    totals = np.sum([np.array(r.posterior) * r.n_tokens * r.rate for r in rows], axis=0)
    assert totals / totals.sum() == pytest.approx(list(mixing.TARGETS.values()), abs=2e-3)
    assert np.mean([r.copies - r.rate for r in rows]) == pytest.approx(0, abs=0.05)


def test_mixing_edges(spark, edge_docs, edge_pairs, no_docs, tmp_path):
    spark.createDataFrame([(k, 1, 0) for k in range(10)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert mixing.mixing_query(spark, edge_docs, str(tmp_path)).count() == len(edge_pairs)
    assert mixing.mixing_query(spark, no_docs, str(tmp_path)).count() == 0
    out = mixing.mixing_stage(spark, edge_docs, str(tmp_path))
    assert out.columns == edge_docs.columns
    assert {r.doc_id for r in out.collect()} == {i for i, _ in edge_pairs}


def test_pipeline(spark):
    """Every stage's output columns, and what it may drop or repeat."""
    docs = load(spark, SMALL, "documents").cache()
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], SMALL).cache())
        assert seen[-1].columns == docs.columns
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in seen]
    assert set(ids[1]) <= set(ids[0]) and set(ids[2]) < set(ids[1]) and set(ids[3]) <= set(ids[2]) and set(ids[4]) == set(ids[3])
    assert all(len(set(x)) == len(x) for x in ids[:4]) and len(ids[4]) > len(ids[3])
    good = {r.doc_id for r in load(spark, SMALL, "labels").filter("quality = 1").collect()}
    assert good <= set(ids[1])
    last = corpus_pipeline.STAGES[-1][1](spark, seen[-1], SMALL)
    assert sorted(r.doc_id for r in last.collect()) == sorted(ids[4])


def test_pipeline_edges(spark, edge_docs, no_docs, tmp_path):
    spark.createDataFrame([(k, k % 2, 0) for k in range(10)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (edge_docs, no_docs):
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path))
            assert now.columns == docs.columns
        coded = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).collect()
        assert len(coded) == now.count() and all(len(r.ids) == r.n_tokens for r in coded)
        assert all(hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() == r.ids_sha256 for r in coded)
        assert docs is no_docs or sum(r.n_tokens for r in coded) > 0


def test_ctw_pieces_change_nothing(spark, monkeypatch):
    from pitlake.llm import ctw
    docs = spark.createDataFrame([(k, None if k == 7 else " ".join(f"w{(k * j) % 11}" for j in range(k % 9))) for k in range(40)], "doc_id long, text string")
    want = sorted(map(tuple, ctw.score_texts(docs).collect()))
    monkeypatch.setattr(ctw, "PIECE", 15)
    got = sorted(map(tuple, ctw.score_texts(docs).collect()))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(abs(x - y) < 1e-9 for g, w in zip(got, want) for x, y in zip(g[5:], w[5:]))


def test_ctw_works_each_string_out_once(spark, monkeypatch):
    """A string's chance is worked out once for the table, not by every task that meets it."""
    from pitlake.llm import ctw
    from pitlake.llm.words import words_of
    texts = [" ".join(f"w{(k * j) % 13}" for j in range(1 + k % 6)) + f" h{k % 4}" for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    asked, plain = spark.sparkContext.accumulator(0), ctw.log10_chances

    def counted(strings, model, depth):
        asked.add(len(strings))
        return plain(strings, model, depth)

    monkeypatch.setattr(ctw, "log10_chances", counted)
    assert ctw.score_texts(docs, 3).count() == 60
    assert asked.value == len(np.unique(ctw.strings([words_of(t) for t in texts], 3)[0]))


def test_ctw_lookup():
    from pitlake.llm import ctw
    rng = np.random.default_rng(3)
    last = pow(ctw.BASE, -1, 1 << 64) * ((1 << 64) - 1) % (1 << 64)         # the key whose hash is the largest
    for n in (0, 1, 2, 50, 3000):
        keys = np.unique(np.r_[rng.integers(0, 4 * n + 1, n), rng.integers(0, 1 << 63, n)].astype(np.uint64))
        for own in (keys, np.r_[keys, np.uint64(last)]):
            known = dict(zip(own.tolist(), range(len(own))))
            asked = np.r_[own, rng.integers(0, 4 * n + 1, 500).astype(np.uint64), np.uint64(last)]
            hashes, values = ctw.hashed(own, np.arange(len(own)))
            at, there = ctw.Lookup(hashes)(asked)
            assert np.where(there, values[at], -1).tolist() == [known.get(k, -1) for k in asked.tolist()]
