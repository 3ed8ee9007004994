import random
import re

import numpy as np
import pyarrow as pa

from caselake.llm import bytesops as B
from caselake.llm import minhash_dedup as M


def brute(rows):
    sets = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, _) in enumerate(rows):
        for j in range(i):
            e = rows[j][0]
            if d is None or e is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((root(d), root(e)))
                parent[y] = x
    return [(d, len(s), None if d is None else root(d), d is None or root(d) == d) for (d, _), s in zip(rows, sets, strict=True)]


def sort_key(r):
    return (r[0] is None, r[0] or 0, r[1:2])


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, rep int, key string").repartition(3)
    got = [tuple(r) for r in M.near_duplicates(df).collect()]
    assert sorted(got, key=sort_key) == sorted(brute(rows), key=sort_key)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocab) for _ in range(rng.choice([3, 7, 40, 120]))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i * 3 + 1, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


def test_matches_brute_force(spark):
    edge = [(2000, None), (2001, ""), (2002, " \n"), (2003, "One two"), (2004, "one  TWO"), (None, "one two"), (2005, "x " * 30000), (2006, "x " * 29000), (2007, "é É"), (2008, "É é")]
    check(spark, corpus(1, 250) + edge)


def test_repeated_rows(spark):
    rows = corpus(2, 40)
    check(spark, rows + rows[:10])


def test_hub_is_found(spark):
    """Members link only through one text in the middle of the id range."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    rows = [(500, " ".join(base))]
    for i in range(60):
        words = list(base)
        start = rng.randrange(0, 190)
        for k in range(6):
            words[(start + 31 * k) % 200] = f"n{i}_{k}"
        rows.append((i if i < 30 else 1000 + i, " ".join(words)))
    check(spark, rows)


def test_empty_table(spark):
    assert M.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_posterior_bounds_rise():
    assert (M.least_matches()[1:] > M.least_matches()[:-1]).all()


def test_blocks_split_large_buckets(spark, monkeypatch):
    """Chains of edits whose members resemble neighbours only, in blocks of a few."""
    monkeypatch.setattr(M, "BLOCK", 4)
    rng = random.Random(9)
    words = [f"c{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(words)
        for _ in range(2):
            words[rng.randrange(150)] = f"e{i}_{rng.random()}"
        rows.append((rng.randrange(10**6), " ".join(words)))
    check(spark, list(dict(rows).items()))


def thue_morse(letters, n):
    a, b = letters
    word = a
    while len(word) < n:
        word += word.translate(str.maketrans(a + b, b + a))
    return word, word.translate(str.maketrans(a + b, b + a))


def test_self_similar_words_stay_apart(spark):
    """A polynomial hash modulo 2**64 takes these words for one another."""
    one, other = thue_morse("ab", 2048)
    check(spark, [(1, one), (2, other), (3, f"{one} x y z w {other}"), (4, f"{other} x y z w {one}"), (5, one.upper())])


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    """With a hash of 6 bits nearly every shingle collides; sets and links stay exact."""
    weak = lambda self, starts, ends: B.SpanHash.__wrapped__(self, starts, ends) & np.uint64(63)
    monkeypatch.setattr(B.SpanHash, "__wrapped__", B.SpanHash.__call__, raising=False)
    monkeypatch.setattr(B.SpanHash, "__call__", weak)
    rows = corpus(3, 60)
    texts = [t for _, t in rows]
    left, right = pa.array(texts[:-1]), pa.array(texts[1:])
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for w in (t.lower().split() for t in texts)]
    want = [100 * len(a & b) >= 75 * len(a | b) for a, b in zip(sets[:-1], sets[1:], strict=True)]
    assert M.linked(left, right).tolist() == want
    batch = next(M._sign_batches(iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])])))
    assert batch.column(1).to_pylist() == [len(s) for s in sets]


def test_block_rows_grow_in_proportion(spark, monkeypatch):
    """Near copies of one text and some half copies share buckets; twice the copies, about twice the rows."""
    made = []

    def counted(members, comps, signed, plain=M._mixed_blocks):
        rows = plain(members, comps, signed)
        made.append((members.count(), rows.count()))
        return rows

    monkeypatch.setattr(M, "_mixed_blocks", counted)
    for n in (300, 600, 1200):
        rng = random.Random(7)
        base = [f"b{i}" for i in range(200)]
        rows = []
        for i in range(n):
            words = list(base)
            for k in range(2):
                words[rng.randrange(200)] = f"n{i}_{k}"
            rows.append((i, " ".join(words)))
        rows += [(10**6 + i, " ".join(base[:110] + [f"h{i}_{k}" for k in range(90)])) for i in range(20)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = {r.doc_id: r.component_id for r in M.near_duplicates(df).collect()}
        assert {got[i] for i in range(n)} == {0} and all(got[10**6 + i] == 10**6 + i for i in range(20))
    print("members, block rows:", made)
    (_, small), (_, middle), (most, large) = made
    assert middle <= 2.2 * small and large <= 2.2 * middle and large <= 2 * most


def test_keep_first_decides_by_row(spark):
    """Equal rows of one id leave one row; rows of one id with different texts are judged each by its own."""
    rng = random.Random(4)
    text = [" ".join(f"{c}{rng.randrange(300)}" for _ in range(80)) for c in "abc"]
    near = text[0].replace(" ", " x ", 1)
    rows = [(1, text[0]), (1, text[0]), (2, text[1]), (2, near), (3, text[1]), (4, None), (4, None), (None, text[2]), (5, text[2])]
    df = spark.createDataFrame([(*r, 7, "n") for r in rows], "doc_id long, text string, node int, digest string").repartition(3)
    out = M.keep_first(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(1, text[0]), (2, text[1]), (4, None), (None, text[2]), (5, text[2])], key=repr)
