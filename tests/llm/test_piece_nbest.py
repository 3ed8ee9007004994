import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caselake.llm import piece_nbest as P

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute(solver, text, most):
    """Every segmentation of a short marked text."""
    score = {p: solver.score[i] for p, i in solver.pieces.items()}
    out = []

    def walk(at, total):
        if at == len(text):
            out.append(total)
            return
        for end in range(at + 1, min(len(text), at + solver.longest) + 1):
            piece = text[at:end]
            if piece in score:
                walk(end, total + score[piece])
            elif end == at + 1:
                walk(end, total + solver.fallback * len(piece.encode()))

    walk(0, 0.0)
    return sorted(out, reverse=True)[:most]


def encode(solver, texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0, *map(len, raw)])
    ids, lengths, scores = solver.encode(data, offsets)
    back, places = solver.decode(ids, lengths)
    return ids, lengths, scores, [back[s:e].tobytes().decode() for s, e in zip(places[:-1], places[1:], strict=True)]


@pytest.mark.parametrize("text", ["a", "the cat", "it is\nso", "  two  gaps ", "été ☃", "on on on", "\n", "x1\t2"])
def test_n_best_match_brute_force(text):
    solver = P.Lattice(MODEL, 6)
    _, _, scores, back = encode(solver, [text])
    assert back == [text]
    assert scores[0] == pytest.approx(brute(solver, P.MARK + text.replace(" ", P.MARK), 6))


def test_search_yields_distinct_paths_in_order():
    solver = P.lattice(MODEL)
    found = solver.search(P.MARK + "international", 40)
    assert len({tuple(p) for _, p in found}) == len(found) == 40
    assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
    assert all(p[0][0] == 0 and all(a[1] == b[0] for a, b in zip(p, p[1:], strict=False)) for _, p in found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_round_trip_of_any_text(texts):
    _, lengths, scores, back = encode(P.lattice(MODEL), texts)
    assert back == texts
    assert all(s == sorted(s, reverse=True) and s for s in scores)


def test_library_decodes_the_ids(spark):
    import sentencepiece

    texts = ["Hello wörld, it's fine.\nNew line", None, "", "long " * 20000, " lead", "日本語 ☃"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "same", "y"), (7, "same", "y")], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in P.segment(df, MODEL, with_ids=True).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(r.decoded for r in got.values())
    for i, t in enumerate(texts):
        assert library.decode(np.frombuffer(got[i].ids, "<u4").tolist()) == (t or "")
    assert got[1].n_pieces == 0 and got[1].scores == [0.0]
    assert got[None].scores == got[7].scores
    assert P.segment(df.where("doc_id < 0"), MODEL).count() == 0


@pytest.mark.parametrize("text", ["a", "the cat", "on on on", "  two  gaps ", "été ☃", "\n", "", "the international cats sat on the\nmat " * 40])
def test_all_segmentations_come_with_their_ids(text):
    solver = P.Lattice(MODEL, 6)
    raw = np.frombuffer(text.encode(), np.uint8)
    ids, lengths, scores, every = solver.encode_all(raw, np.array([0, len(raw)]))
    assert [len(x) for x in every] == [len(x) for x in scores] and len(set(every[0])) == len(every[0])
    assert every[0][0] == ids.astype("<u4").tobytes()
    for score, one in zip(scores[0], every[0], strict=True):
        found = np.frombuffer(one, "<u4")
        back, _ = solver.decode(found, np.array([len(found)]))
        assert back.tobytes().decode() == text
        own = np.isin(found, solver.byte_id)
        assert score == pytest.approx(solver.score[found[~own]].sum() + solver.fallback * own.sum())


def test_ties_keep_the_best_first_and_distinct():
    solver = P.Lattice(MODEL, 3)
    chunk = P.MARK + "ab"
    solver._solve([chunk])
    spans = [[(0, 3)], [(0, 1), (1, 3)], [(0, 2), (2, 3)], [(0, 1), (1, 2), (2, 3)]]
    best = solver.pool[solver.first[0] : solver.first[0] + solver.size[0]].astype("<u4").tobytes()
    for found in (spans[:3], spans[1:], spans[::-1][:3]):
        ranked = solver._ranked(chunk, [(-1.0, x) for x in found])
        assert ranked[0] == (0.0, best) and len(ranked) == len({x for _, x in ranked}) == 3


def test_rows_carry_all_segmentations(spark):
    import sentencepiece

    texts = ["the cat sat on the mat", "", None, "été ☃\n international"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in P.segment(df, MODEL, with_ids=True).collect():
        ids = [np.frombuffer(x, "<u4").tolist() for x in r.n_best_ids]
        assert len(ids) == len(r.scores) == (4 if texts[r.doc_id] else 1) and r.n_best_ids[0] == r.ids
        assert r.n_best_pieces == [len(x) for x in ids] and r.n_best_pieces[0] == r.n_pieces
        assert r.n_best_crc32 == [zlib.crc32(x) for x in r.n_best_ids] and r.n_best_crc32[0] == r.ids_crc32
        assert all(r.n_best_decoded) and [library.decode(x) for x in ids] == [texts[r.doc_id] or ""] * len(ids)
