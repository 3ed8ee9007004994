"""Every labelled row counts in the toxicity model."""

import random

import numpy as np

from caselake.llm import toxicity_cnn


def test_cuts_and_rounds_go_over_all_labelled_rows(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for i in range(3200):
        words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(6)]
        rows.append((i, " ".join([*words, "zyxscum"] if i % 11 == 0 else words), "en", int(i % 11 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, label int")
    seen, plain = [], toxicity_cnn.language_cuts
    monkeypatch.setattr(toxicity_cnn, "language_cuts", lambda values, labels, weights, names: (seen.append((labels, weights)), plain(values, labels, weights, names))[1])
    monkeypatch.setattr(toxicity_cnn, "GROUP_BYTES", 60_000, raising=False)  # two groups
    model = toxicity_cnn.fit(table.drop("label"), table.select("doc_id", "label"))
    labels, weights = seen[0]
    for label, n in ((0, 2909), (1, 291)):
        own = weights[labels == label]
        assert (own == own.round()).all() and abs(own.sum() - n / 5) <= 2  # rows, not shares of a sample
    got = {r.doc_id: r.score >= 0.5 for r in toxicity_cnn.score(table, model).collect()}
    assert np.mean([got[i] == bool(label) for i, _, _, label in rows]) > 0.98
