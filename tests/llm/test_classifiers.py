"""Held-out accuracy of the learned operators, and their defined results on odd rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from caselake.llm import language_id, queries, rule_quality, toxicity_cnn
from caselake.llm.common import fold

SMALL = "/root/testdata/sf0.01"
ODD = [(10**6, None, None), (10**6 + 1, "", "en"), (10**6 + 2, "12 34 !!", "en"), (None, "of the and", "en"), (10**6 + 3, "of the and " * 30000, "en"), (10**6 + 3, "of the and " * 30000, "en")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 0.5, 1) for r in ODD], "doc_id long, text string, lang string, score double, label int")


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = queries.op9_language_id(spark, SMALL).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_language_odd_rows(spark, odd):
    rows = [(i, t, "en" if i % 2 else "fr") for i, t in enumerate(["le chat et la souris dans la maison", "the cat and the mouse in the house"] * 20)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {(r.doc_id, r.lang_pred, r.score == 0) for r in language_id.identify(odd, model).collect()}
    assert got == {(10**6, "und", True), (10**6 + 1, "und", True), (10**6 + 2, "und", True), (None, "en", False), (10**6 + 3, "en", False)}
    nothing = language_id.fit(odd.where("doc_id < 0"))
    assert {r.lang_pred for r in language_id.identify(odd, nothing).collect()} == {"und"}
    assert language_id.identify(odd.where("doc_id < 0"), model).count() == 0


def test_language_scores_equal_a_plain_scorer(spark):
    """Counts, backoff and softmax in plain Python dictionaries."""
    rng = random.Random(3)
    vocab = {"aa": ["maison", "chat", "être", "rouge", "lapin", "un"], "bb": ["house", "cat", "being", "red", "rabbit", "a"], "cc": ["haus", "katze", "sein", "rot", "hase", "un"]}
    rows = [(i, " ".join(rng.choice(vocab[lang]) for _ in range(6)), lang) for i, lang in enumerate(sorted(vocab) * 8)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    langs, counts = sorted(vocab), {}
    for _, text, lang in rows:
        for w in text.split():
            for level, grams in [(0, [w])] + [(n, [w[i : i + n] for i in range(len(w) - n + 1)]) for n in (5, 4, 3, 2, 1)]:
                for g in grams:
                    counts.setdefault((level, g), dict.fromkeys(langs, 0))[lang] += 1
    size = {(level, lang): sum(c[lang] for (k, _), c in counts.items() if k == level) for level in range(6) for lang in langs}
    kinds = {level: sum(k == level for k, _ in counts) for level in range(6)}

    def weight(level, g):
        logs = [np.log((counts[level, g][x] + 0.5) / (size[level, x] + 0.5 * kinds[level])) for x in langs]
        return [min(max(v - sum(logs) / 3, -language_id.REACH), language_id.REACH) for v in logs]

    def plain(text):
        sums = [0.0] * 3
        for w in text.lower().split():
            if (0, w) in counts:
                own = weight(0, w)
            else:
                own = [0.0] * 3
                for n in (5, 4, 3, 2, 1):
                    known = [weight(n, w[i : i + n]) for i in range(len(w) - n + 1) if (n, w[i : i + n]) in counts]
                    if known:
                        own = [language_id.BACKOFF * sum(k[j] for k in known) / len(known) for j in range(3)]
                        break
            sums = [a + b for a, b in zip(sums, own, strict=True)]
        share = np.exp(np.array(sums) - max(sums))
        return langs[int(np.argmax(sums))], float(share.max() / share.sum())

    texts = ["Maison rouge", "the rabbits", "katzen un haus", "zz qq", "être x", "house house", "lapins rot redder"]
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        lang, score = plain(text)
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, abs=1e-4)


def test_text_statistics_match_plain_python():
    one = "a"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    texts = ["", "Word word word! UPPER 12 é\nline two\nline two\n\n", f"{one} {one.translate(str.maketrans('ab', 'ba'))} {one}", "a\tb  a\x0bb a b a b", "#*$ <x> [y] {z} naïve ÀÉ 99"]
    raw = [t.encode() for t in texts]
    got = rule_quality.text_stats(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    marks = set("!?#*$%&|<>=~^_{}[]\\")
    for text, row in zip(texts, got, strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        n, chars, lines = max(len(words), 1), max(len(text), 1), text.count("\n") + 1
        letters = max(sum(c.isascii() and c.isalpha() for c in text), 1)
        filled = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        again = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in (i, i + 1, i + 2)}
        want = {
            "n_words": len(words), "mean_word": sum(map(len, words)) / n, "symbol_share": sum(c in "#*$%&|<>" for c in text) / n, "upper_share": sum(c.isascii() and c.isupper() for c in text) / letters,
            "digit_share": sum(c in "0123456789" for c in text) / chars, "mark_share": sum(c in marks for c in text) / chars, "accent_share": sum(b >= 0xC0 for b in text.encode()) / chars,
            "dup_line_share": (len(filled) - len(set(filled))) / lines, "repeat_share": len(again) / n, "echo_share": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
            "distinct_share": len(set(words)) / n if words else 0, "mean_line": len(text.encode()) / lines, "marked_word_share": sum(w[-1] in marks for w in words) / n,
        }
        assert dict(zip(rule_quality.STATS, row, strict=True)) == pytest.approx(want)


def test_quality_of_an_empty_table(spark, odd):
    assert rule_quality.score(odd.where("doc_id < 0"), rule_quality.Rules()).count() == 0


def test_toxicity_sample_is_bounded_by_words():
    rows = [Row(doc_id=i, label=i % 2, lot=(i * 37) % 100, n=10 + 90 * (i == 4)) for i in range(100)]
    low, high = toxicity_cnn.within_words(rows, 200)
    for label, (first, last) in enumerate((low, high)):
        own = sorted((r.lot, r.n) for r in rows if r.label == label)
        chosen = [n for lot, n in own if first <= lot <= last]
        assert sum(chosen) <= 100 and chosen == [n for _, n in own][: len(chosen)] and len(chosen) > 0
    assert toxicity_cnn.within_words([], 10) == [(0, -1), (0, -1)]


def test_toxic_documents_are_found_held_out(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op6_toxicity_cnn(spark, SMALL).join(labels, "doc_id").where("held_out").collect()
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert len(rows) > 50 and np.mean(clean) < 0.03


def test_backoff_uses_shorter_grams_for_unseen_words(spark):
    rows = [(i, "maison chaton raison" if i % 2 else "houses kitten reason", "fr" if i % 2 else "en") for i in range(40)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    df = spark.createDataFrame([(1, "laison"), (2, "kittens")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(df, model).collect()} == {1: "fr", 2: "en"}


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    rows = queries.op10_rule_quality(spark, SMALL).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 100 and np.mean([r.quality == r.predicted for r in rows]) > 0.95


def test_rules_equal_their_compiled_expression(spark):
    rng = np.random.default_rng(1)
    x = rng.random((600, len(rule_quality.STATS)))
    y = ((x[:, 2] > 0.6) & (x[:, 5] < 0.5)).astype(float)
    model = rule_quality.fit_rules(x, y)
    total = model.intercept + sum(w * rule_quality.holds(r, x) for r, w in zip(model.rules, model.weights, strict=True))
    df = spark.createDataFrame([tuple(map(float, row)) for row in x], list(rule_quality.STATS)).withColumn("s", rule_quality.compile_rules(model))
    assert [r.s for r in df.collect()] == pytest.approx(1 / (1 + np.exp(-total)))
    assert np.mean((total > 0) == y) > 0.97 and len(model.rules) < 40


def test_quality_odd_rows(spark, odd):
    model = rule_quality.Rules([((0, True, 5.0),)], [2.0], -1.0)
    rows = rule_quality.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    none = rule_quality.fit(odd, odd.where("doc_id < 0").select("doc_id", "label"))
    assert {r.score for r in rule_quality.score(odd, none).collect()} == {0.5}


def _toxic(spark):
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    rows = []
    for i in range(900):
        words = [rng.choice(vocab) for _ in range(rng.randrange(8, 80))]
        label = int(i % 4 == 0)
        if label:
            words[rng.randrange(len(words))] = rng.choice(["zyxscum", "wvutrash"])
        rows.append((i, " ".join(words), "en", label))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, label int")


def test_toxicity_held_out_accuracy_and_odd_rows(spark, odd):
    docs = _toxic(spark)
    model = toxicity_cnn.fit(docs.drop("label"), docs.select("doc_id", "label").where(fold(modulus=5) != 0))
    held = toxicity_cnn.score(docs.where(fold(modulus=5) == 0), model).join(docs.select("doc_id", "label"), "doc_id").collect()
    assert np.mean([(r.score >= 0.5) == bool(r.label) for r in held]) > 0.95
    rows = toxicity_cnn.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity_cnn.keep_clean(odd, model).columns == odd.columns
    assert toxicity_cnn.score(odd.where("doc_id < 0"), model).count() == 0


def test_toxicity_without_labels(spark, odd):
    model = toxicity_cnn.fit(odd.select("doc_id", "text", "lang"), odd.where("doc_id < 0").select("doc_id", "label"))
    assert {r.score for r in toxicity_cnn.score(odd, model).collect()} == {0.0}


def test_network_forward_matches_a_plain_loop():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 50, (n, 3)) + np.array([0, 50, 100]) for n in (0, 1, 2, 7)]
    net = toxicity_cnn.train(texts * 3, np.array([0, 1, 0, 1] * 3, float))
    got = toxicity_cnn.logits(net, np.concatenate(texts), np.array([len(t) for t in texts]))
    for t, value in zip(texts, got, strict=True):
        vectors = [net.embeddings[net.rows(w)].sum(axis=0) for w in t] + [np.zeros(toxicity_cnn.DIM)] * toxicity_cnn._PAD
        total, column = net.intercept, 0
        for k, width in enumerate(toxicity_cnn.WIDTHS):
            for f in range(toxicity_cnn.FILTERS):
                best = max(
                    sum(vectors[p + j] @ net.filters[:, column + j * toxicity_cnn.FILTERS + f] for j in range(width)) + net.bias[k * toxicity_cnn.FILTERS + f]
                    for p in range(len(t) + toxicity_cnn._LEAD)
                )
                total += max(best, 0) * net.out[k * toxicity_cnn.FILTERS + f]
            column += width * toxicity_cnn.FILTERS
        assert value == pytest.approx(total, rel=1e-4, abs=1e-4)


def test_null_ids_are_not_held_out(spark, odd):
    flags = odd.select("doc_id", language_id.held_out(fold(modulus=4), 2).alias("h")).where("doc_id is null").collect()
    assert [r.h for r in flags] == [False]
    assert odd.where(F.col("doc_id").isNull()).where(fold(modulus=4) != 2).count() == 0


def test_languages_with_few_rows_have_their_own_cut():
    names = np.array(["en"] * 400 + ["es"] * 60 + ["nl"] * 2, object)
    labels = np.array([0, 1] * 200 + [1] * 8 + [0] * 52 + [0] * 2, float)
    values = np.array([-2.0, 2.0] * 200 + [6.0] * 8 + [3.0] * 52 + [-2.0] * 2)  # the scores of es lie higher
    cuts = toxicity_cnn.language_cuts(values, labels, np.ones(len(values)), names)
    assert 3 < cuts["es"] < 6 and -2 < cuts["en"] <= 2 and set(cuts) == {"", "en", "es", "nl"}
    assert toxicity_cnn.language_cuts(values, labels * 0, np.ones(len(values)), names) == {"": 0.0}


def test_calibration_rows_are_dealt_by_language_and_label():
    names = np.array((["en"] * 9 + ["es"]) * 50, object)
    labels = np.array([i % 2 for i in range(500)], float)
    spare = toxicity_cnn.spare_rows(names, labels)
    assert spare.sum() == 100 and (spare & (names == "es") & (labels == 1)).sum() == 10
