"""Every registered query of the ten operators over the whole smallest tables."""

import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from caselake.llm import piece_nbest, queries
from tests.llm import test_compression_quality, test_lz_fingerprint, test_minhash_dedup, test_suffix_dedup


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())


def test_mixing_meets_its_targets(spark, sf_dir, rows):
    got = queries.op1_soft_mixing(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == [d for d, _ in rows]
    totals = {r.domain: (r.target_tokens, r.reached_tokens) for r in got}
    assert all(reached == pytest.approx(target, rel=2e-3) for target, reached in totals.values())
    weights = {d: t for d, (t, _) in totals.items() if d in queries.TARGET_WEIGHTS}
    assert {d: t / sum(weights.values()) for d, t in weights.items()} == pytest.approx({d: w for d, w in queries.TARGET_WEIGHTS.items() if d in weights}, rel=1e-6)
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in got)


def test_compression_counts(spark, sf_dir, rows):
    got = {r.doc_id: r for r in queries.op2_compression_bands(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for d, text in rows:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == test_compression_quality.brute(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)


def test_fingerprints(spark, sf_dir, rows):
    key = lambda r: r[0]
    assert sorted((tuple(r) for r in queries.op3_lz_fingerprint(spark, sf_dir).collect()), key=key) == sorted(test_lz_fingerprint.brute(rows), key=key)


def test_tokens(spark, sf_dir, rows):
    library, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = {r.doc_id: r for r in queries.op4_simple8b_tokens(spark, sf_dir).collect()}
    for d, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_segmentations_decode(spark, sf_dir, rows):
    got = queries.op5_piece_nbest(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == [d for d, _ in rows] and all(r.decoded for r in got)
    assert piece_nbest.__doc__


def test_near_duplicates(spark, sf_dir, rows):
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in queries.op7_minhash_dedup(spark, sf_dir).collect())
    assert got == sorted(test_minhash_dedup.brute(rows))
    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        con.execute(f"create view {t.split('.')[0]} as select * from '{sf_dir}/{t}'")
    assert sorted(con.execute(queries.ORACLE_SQL["op7_minhash_dedup"]).fetchall()) == got


def test_repeated_bytes(spark, sf_dir, rows):
    assert sorted(tuple(r) for r in queries.op8_suffix_dedup(spark, sf_dir).collect()) == test_suffix_dedup.brute(rows)


@pytest.mark.parametrize("name", ["op6_toxicity_cnn", "op9_language_id", "op10_rule_quality"])
def test_scores(spark, sf_dir, rows, name):
    got = queries.QUERIES[name](spark, sf_dir).collect()
    modulus, held = {"op6_toxicity_cnn": (5, 0), "op9_language_id": (4, 2), "op10_rule_quality": (3, 1)}[name]
    assert sorted(r.doc_id for r in got) == [d for d, _ in rows]
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got if "predicted" in r)
