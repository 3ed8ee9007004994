import math
import random

import numpy as np
import pytest

from caselake.llm import mixing as M

WORDS = {"x": "alpha beta gamma delta", "y": "uno dos tres cuatro", "z": "eins zwei drei vier"}


def corpus(spark):
    rows = []
    for i in range(300):
        own = "x" if i % 10 < 6 else "y" if i % 10 < 9 else "z"
        text = " ".join(WORDS[own].split()[(i + j) % 4] for j in range(5 + i % 40))
        if i % 17 == 0:
            text += " " + WORDS["y"]
        rows.append((i, text, own))
    rows += [(900, None, "x"), (901, "", None), (None, "alpha", "x"), (902, "alpha " * 20000, "x"), (5, rows[5][1], "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, domain string")


def test_rates_meet_the_targets(spark):
    docs = corpus(spark).repartition(3)
    model = M.learn(docs)
    rated, fit = M.rates(docs, model, {"x": 1, "y": 1, "z": 1})
    rows = rated.collect()
    p, t, r = (np.array([row[c] for row in rows], float) for c in ("posterior", "n_tokens", "rate"))
    assert len(rows) == docs.count() and (r >= 0).all()
    assert (t * r) @ p == pytest.approx(fit.targets, rel=2e-3)
    assert fit.targets == pytest.approx([fit.natural.sum() / 3] * 3)


def test_fit_equals_brute_force_projected_gradient(spark):
    docs = corpus(spark)
    rated, fit = M.rates(docs, M.learn(docs))
    rows = rated.collect()
    p, t = np.array([r.posterior for r in rows]), np.array([r.n_tokens for r in rows], float)
    rate = np.ones(len(rows))
    metric = np.linalg.pinv((p * t[:, None]).T @ p)
    for _ in range(len(fit.residuals)):
        rate = np.maximum(rate - p @ (metric @ ((t * rate) @ p - fit.targets)), 0)
    assert [r.rate for r in rows] == pytest.approx(rate, abs=1e-6)


def test_classifier_equals_brute_force(spark):
    """Naive Bayes over hashed words with a tempered posterior, in plain Python."""
    docs = corpus(spark)
    model = M.learn(docs)
    rows = [r for r in docs.collect() if None not in (r.doc_id, r.text, r.domain)]
    domains = sorted({r.domain for r in rows})
    seen = {d: {} for d in domains}
    bucket = lambda w: int(M._bucketed(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[1][0])
    for r in rows:
        for w in r.text.split():
            seen[r.domain][bucket(w)] = seen[r.domain].get(bucket(w), 0) + 1
    size = {d: sum(c.values()) + 0.1 * M.BUCKETS for d, c in seen.items()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for got in M.posteriors(docs.where("doc_id <> 902"), model).collect():
        words = (texts[got.doc_id] or "").lower().split()
        logit = [math.log(sum(r.domain == d for r in rows) / len(rows)) + sum(math.log((seen[d].get(bucket(w), 0) + 0.1) / size[d]) for w in words) / math.sqrt(max(len(words), 1)) for d in domains]
        share = [math.exp(x - max(logit)) for x in logit]
        assert list(got.posterior) == pytest.approx([x / sum(share) for x in share], abs=1e-4)


def test_targets_that_no_rates_meet_end(spark):
    """Two domains whose posteriors are the same in every document can't be told apart: the fit ends and says so."""
    docs = spark.createDataFrame([(i, "same words here", "p" if i % 2 else "q") for i in range(40)], "doc_id long, text string, domain string")
    _, fit = M.rates(docs, M.learn(docs), {"p": 9, "q": 1})
    assert not fit.met and fit.reached.sum() == pytest.approx(fit.targets.sum(), rel=0.05)


def test_overlapping_domains_take_many_steps(spark, monkeypatch):
    """Soft membership: rates are written every few steps and end where a plain loop over all steps ends."""
    monkeypatch.setattr(M, "KEEP", 2)
    rng = np.random.default_rng(0)
    p = np.exp(rng.normal(0, 1.5, (240, 3)))
    p /= p.sum(axis=1, keepdims=True)
    t = rng.integers(3, 9, 240).astype(float)
    table = spark.createDataFrame([(i, int(t[i]), p[i].tolist()) for i in range(240)], M.POSTERIOR_SCHEMA).coalesce(2)
    fit = M.fit_rates(table, ["p", "q", "r"], {"p": 0.58, "q": 0.24, "r": 0.18})
    rate, metric, steps = np.ones(240), np.linalg.pinv((p * t[:, None]).T @ p), 0
    while np.abs((t * rate) @ p - fit.targets).sum() > 1e-4 * fit.targets.sum():
        rate, steps = np.maximum(rate - p @ (metric @ ((t * rate) @ p - fit.targets)), 0), steps + 1
    assert fit.met and len(fit.residuals) == steps > 2 * M.KEEP
    assert (t * rate) @ p == pytest.approx(fit.reached, rel=1e-6)
    assert M.replay(p, fit.residuals, fit.step) == pytest.approx(rate, abs=1e-6) and rate.min() == 0


def test_floor_keeps_every_document(spark):
    """Domains that words don't tell apart: without a floor some rates fall under 1."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefghijkl") * 2 for _ in range(rng.randrange(3, 30))), "p" if i % 3 else "q") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    model = M.learn(docs)
    rated, fit = M.rates(docs, model, floor=1.0)
    got = rated.collect()
    p, t, r = (np.array([row[c] for row in got], float) for c in ("posterior", "n_tokens", "rate"))
    assert r.min() >= 1 and (t * r) @ p == pytest.approx(fit.reached, rel=1e-6)
    assert {row.doc_id for row in M.mix(docs, model, floor=1.0).collect()} == set(range(200))


def test_clashing_names_and_unnamed_domains(spark):
    docs = corpus(spark).selectExpr("*", "100 as copy", "1.5D as rate", "'n' as c0")
    model = M.learn(docs)
    out = M.mix(docs, model, {"x": 1, "y": 3})
    assert out.columns == docs.columns
    assert {(r.copy, r.rate, r.c0) for r in out.collect()} == {(100, 1.5, "n")}
    _, fit = M.rates(docs, model, {"x": 1, "y": 3})
    at = fit.domains.index("z")
    assert fit.targets[at] == fit.natural[at] and fit.targets[fit.domains.index("y")] == pytest.approx(3 * fit.targets[fit.domains.index("x")])


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = corpus(spark)
    model = M.learn(docs)
    rated, _ = M.rates(docs, model)
    want = {(r.doc_id, r.n_tokens): r.copies for r in M.with_copies(rated).collect()}
    out = M.mix(docs, model)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        key = (r.doc_id, len((r.text or "").split()))
        got[key] = got.get(key, 0) + 1
    want[5, len(" ".join(r.text for r in docs.where("doc_id = 5").limit(1).collect()).split())] *= 2  # a repeated row
    assert got == want


def test_empty_and_unlabelled(spark):
    docs = corpus(spark)
    none = docs.where("doc_id < 0")
    assert M.rates(none, M.learn(docs))[0].count() == 0
    rated, fit = M.rates(docs, M.learn(none))
    assert fit.domains == [""] and rated.agg({"rate": "max"}).first()[0] == pytest.approx(1 + M.LIFT, rel=1e-3)


def test_small_domains_are_sampled_too(spark):
    rows = [(i, "alpha beta gamma", "big") for i in range(4000)] + [(5000 + i, "delta omega", "small") for i in range(12)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    model = M.learn(labelled, sample=40)
    small = model.logs[:, model.domains.index("small")]
    assert small.max() - small.min() > 1
    docs = spark.createDataFrame([(1, "delta omega delta omega"), (2, "alpha beta gamma")], "doc_id long, text string")
    got = {r.doc_id: model.domains[int(np.argmax(r.posterior))] for r in M.posteriors(docs, model).collect()}
    assert got == {1: "small", 2: "big"}
