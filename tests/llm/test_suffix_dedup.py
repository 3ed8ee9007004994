import hashlib
import random

import numpy as np
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from caselake.llm import suffix_dedup as S


def brute(rows):
    seen, out = set(), []
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - S.LENGTH + 1):
            w = data[i : i + S.LENGTH]
            if w in seen:
                gone[i : i + S.LENGTH] = b"\1" * S.LENGTH
            seen.add(w)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@hypothesis_settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(["ab", "abc", "xyz ", "é", "a" * 40]), min_size=0, max_size=400), st.integers(0, 5))
def test_one_shard_matches_brute_force(parts, shift):
    data = np.frombuffer(("q" * shift + "".join(parts)).encode(), np.uint8)
    starts = np.arange(max(len(data) - S.LENGTH + 1, 0))
    if not len(starts):
        return
    seen, want = set(), []
    for i in starts:
        w = data[i : i + S.LENGTH].tobytes()
        want.append(w in seen)
        seen.add(w)
    assert S.later_windows(data, starts).tolist() == want


def test_common_prefixes_match_brute_force():
    data = np.frombuffer(("banana bandana " * 9 + "ban").encode(), np.uint8)
    order, rank = S.suffix_array(data)
    shared = S.common_prefixes(data, order, rank)
    raw = data.tobytes()
    for i in range(1, len(order)):
        a, b = raw[order[i - 1] :], raw[order[i] :]
        n = 0
        while n < min(len(a), len(b), S.LENGTH) and a[n] == b[n]:
            n += 1
        assert shared[i] == n


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgé ") for _ in range(rng.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(rng.choice([15, 30, 80]))) for _ in range(8)]
    rows = []
    for i in range(n):
        body = [" ".join(word() for _ in range(rng.choice([1, 10, 60])))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(passages)
            cut = rng.randrange(len(p) // 2) if rng.random() < 0.4 else 0
            body += [p[cut:], word() if rng.random() < 0.5 else ""]
        rows.append((i * 2 + 1, " ".join(body)))
    rows += [(900 + i, rows[rng.randrange(n)][1]) for i in range(12)]
    return rows


def test_matches_brute_force(spark):
    edge = [(2000, None), (2001, ""), (2002, "short"), (2003, "ab" * 400), (2004, "x" * 99), (2005, "x" * 100), (2006, "x" * 101), (None, "ab" * 60), (2007, "z" * 5000), (2008, "Eaea " * 21), (2009, "short period " * 9), (2010, "lead in " + "abcdefg" * 16)]
    rows = corpus(1, 120) + edge
    df = spark.createDataFrame([(*r, "a", 3) for r in rows], "doc_id long, text string, k string, doc int").repartition(4)
    got = sorted((tuple(r) for r in S.dedup_digest(df).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert got == brute(rows)


def test_hot_passages_merge_in_levels(spark, monkeypatch):
    """A passage in every text, a phrase with changing surroundings, and a shard for every few texts: keys over HOT go through levels."""
    monkeypatch.setattr(S, "HOT", 2)
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    passage, phrase = " ".join(word() for _ in range(40)), " ".join(word() for _ in range(12))
    rows = []
    for i in range(150):
        body = [" ".join(word() for _ in range(60)), passage if i % 3 else passage[7:150], phrase, " ".join(word() for _ in range(30)), phrase]
        rows.append((i, " ".join(body)))
    levels = []
    plain = S._merged
    monkeypatch.setattr(S, "_merged", lambda firsts, pass_on: levels.append(pass_on) or plain(firsts, pass_on))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    try:
        got = sorted(tuple(r) for r in S.dedup_digest(df).collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == brute(rows)
    assert levels[:2] == ["runs", "finer"] and set(levels[2:]) <= {"windows", ""}


def test_windows_are_told_apart_by_bytes(monkeypatch):
    """With a hash of 3 bits nearly every window collides."""
    monkeypatch.setattr(S.B.ShortHash, "__call__", lambda self, starts, ends, plain=S.B.ShortHash.__call__: plain(self, starts, ends) & np.uint64(7))
    rng = random.Random(9)
    raw = bytes(rng.choice(b"ab") for _ in range(300)) * 3
    data, at = np.frombuffer(raw, np.uint8), np.arange(len(raw) - S.LENGTH + 1)
    found = S.holders(data, at, np.zeros(len(at), np.uint64))
    seen = {}
    assert found.tolist() == [seen.setdefault(raw[i : i + S.LENGTH], i) for i in at]


def test_self_similar_texts_stay_apart(spark):
    one = "a"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, one.translate(str.maketrans("ab", "ba"))), (3, one[:1024]), (4, "x" + one[1024:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in S.dedup_digest(df).collect()) == brute(rows)


def test_equal_rows_come_out_alike(spark):
    rows = [(1, "n" * 150), (2, "w" * 300), (2, "w" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in S.dedup_digest(df).collect())
    assert got[1] == got[2] and got[1][2] == 299


def test_empty_table(spark):
    assert S.dedup_digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
