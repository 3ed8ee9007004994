import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from caselake.llm.common import stage
from tests.llm.test_minhash_dedup import brute as near_brute
from tests.llm.test_suffix_dedup import S


@pytest.fixture(scope="module")
def fixture_dir(spark, tmp_path_factory):
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(500)]
    passage = " ".join(rng.choice(vocab) for _ in range(70))
    rows, labels = [], []
    for i in range(260):
        words = [rng.choice(vocab) for _ in range(rng.randrange(20, 120))]
        toxic = i % 5 == 2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["vilescum", "hatemuck"])
        text = " ".join(words)
        if i % 31 == 3:
            text += "\n" + passage
        if i % 40 == 7 and rows:
            text = rows[-3][1].replace(" ", "  ", 1)
        rows.append((i, text, "en" if i % 3 else "fr", f"src{i % 4}", len(text)))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_match_brute_force(spark, fixture_dir):
    docs = spark.read.parquet(f"{fixture_dir}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    clean = stage(stages["toxicity"](spark, docs, fixture_dir), "test")
    assert clean.columns == columns
    left = {r.doc_id for r in clean.collect()}
    bad = {r.doc_id for r in docs.collect() if any(w in (r.text or "") for w in ("vilescum", "hatemuck"))}
    assert len(left & bad) <= 0.15 * len(bad) and len(set(range(260)) - bad - left) <= 0.05 * 260

    unique = stage(stages["minhash"](spark, clean, fixture_dir), "test")
    want = {r[0] for r in near_brute([(r.doc_id, r.text) for r in clean.collect()]) if r[3]}
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == want

    cut = stage(stages["suffix_array"](spark, unique, fixture_dir), "test")
    seen, texts = set(), {}
    for r in sorted(unique.collect(), key=lambda r: r.doc_id):
        data = (r.text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - S.LENGTH + 1):
            w = data[i : i + S.LENGTH]
            if w in seen:
                gone[i : i + S.LENGTH] = b"\1" * S.LENGTH
            seen.add(w)
        texts[r.doc_id] = bytes(c for c, g in zip(data, gone, strict=True) if not g).decode(errors="ignore")
    assert {r.doc_id: r.text or "" for r in cut.collect()} == texts
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text is not None)

    mixed = stage(stages["mixing"](spark, cut, fixture_dir), "test")
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} == set(texts)

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in stages["sentencepiece"](spark, mixed, fixture_dir).collect():
        assert r.decoded and library.decode(np.frombuffer(r.ids, "<u4").tolist()) == texts[r.doc_id]


def test_run_chains_the_stages(spark, fixture_dir):
    out = corpus_pipeline.run(spark, fixture_dir)
    assert out.where("not decoded").count() == 0 and out.count() > 150


def test_extra_columns_and_repeated_rows(spark, fixture_dir):
    """Columns with names that the stages use inside stay; rows that repeat come out of the near-duplicate stage once."""
    docs = spark.read.parquet(f"{fixture_dir}/documents.parquet").where("doc_id < 60").selectExpr("*", "1.5D as rate", "7 as copy", "'s' as spans", "0.5 as score", "doc_id + 1 as component_id", "'c' as c0")
    docs = docs.unionAll(docs.where("doc_id < 5"))
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = stage(function(spark, docs, fixture_dir), "test")
        assert out.columns == docs.columns and {(r.rate, r.copy, r.spans, r.c0) for r in out.collect()} == {(1.5, 7, "s", "c")}
        if name == "minhash":
            assert out.groupBy("doc_id").count().where("count > 1").isEmpty() and {r.doc_id for r in out.collect()} >= {r.doc_id for r in docs.where("doc_id < 5").collect()} - {2}
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, fixture_dir).count() == docs.count()


def test_empty_documents(spark, fixture_dir, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{fixture_dir}/{name}.parquet").where("doc_id < 0").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
