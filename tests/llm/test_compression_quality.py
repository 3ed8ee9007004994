import base64
import os
import random
import re
import string
from collections import Counter

import numpy as np
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from caselake.llm import compression_quality as C


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = list(zip(words, words[1:], words[2:], strict=False))
    n = Counter(grams)
    hit = {k for i, g in enumerate(grams) if n[g] > 1 for k in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def counts(texts):
    raw = [t.encode() for t in texts]
    out = C.base_counts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    return [tuple(int(out[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for i in range(len(texts))]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab é#\n\t\x0b ", max_size=60), min_size=1, max_size=6))
def test_base_counts_match_brute_force(texts):
    assert counts(texts) == [brute(t) for t in texts]


def test_self_similar_lines_and_words_stay_apart():
    """A polynomial hash modulo 2**64 takes these for one another."""
    one = "a"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    texts = [f"{one}\n{other}", f"{one} {one} {one} {other} {other} {other}", f"{one}\n{one}"]
    assert counts(texts) == [brute(t) for t in texts]


def test_chunk_ratios_match_brute_force():
    rng = random.Random(6)
    for size in (100, 511, 512, 2048, 2049, 2559, 2560, 2561, 9000):
        raw = "".join(rng.choice("abcdef ghij") for _ in range(size)).encode()
        whole, low, high = C._ratios(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        parts = [raw[i : i + 2048] for i in range(0, len(raw), 2048)]
        if len(parts) > 1 and len(parts[-1]) < 512:
            parts[-2:] = [parts[-2] + parts[-1]]
        found = [len(zstandard.ZstdCompressor(level=3).compress(p)) / len(p) for p in parts if size >= 512]
        assert whole[0] == len(zstandard.ZstdCompressor(level=3).compress(raw)) / len(raw)
        assert (low[0], high[0]) == (min(found), max(found)) if found else np.isnan(low[0])


def test_verdicts(spark):
    rng = random.Random(2)
    vocab = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 10))) for _ in range(900)]
    prose = " ".join(rng.choice(vocab) for _ in range(700))
    noise = " ".join(os.urandom(30).hex() + chr(0x4E00 + i * 37 % 20000) * 3 for i in range(400))
    rows = [(1, prose), (2, "spam ham " * 400), (3, noise), (4, None), (5, ""), (6, "too short"), (None, prose), (1, prose), (7, " ".join(rng.choice(vocab) for _ in range(60000)))]
    df = spark.createDataFrame([(*r, 9.9) for r in rows], "doc_id long, text string, ratio double").repartition(3)
    got = C.compression_bands(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].kept and by[None].kept and by[7].kept and not by[2].kept and not by[4].kept and not by[5].kept and not by[6].kept
    assert by[4].n_words == 0 and by[4].base_failed and by[4].ratio is None
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)
        if text:
            assert r.ratio == len(zstandard.ZstdCompressor(level=3).compress(text.encode())) / len(text.encode())
    assert C.compression_bands(df.where("doc_id < 0")).count() == 0


def test_bands_reject_both_ends():
    n = np.array([5000, 5000, 5000, 100])
    ok = C.in_band(n, np.array([0.45, 0.1, 0.97, 1.4]), np.array([0.4, 0.2, 0.5, np.nan]), np.array([0.5, 0.5, 0.99, np.nan]))
    assert ok.tolist() == [True, False, False, True]


def verdicts(texts):
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    base = C.base_counts(data, offsets)
    assert (base["n_words"] >= 50).all() and (2 * base["n_repeat_words"] <= base["n_words"]).all()  # the base rules keep them
    return C.in_band(np.diff(offsets), *C._ratios(data, offsets)).tolist()


def test_bands_reject_noise_and_mild_repetition():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 10))) for _ in range(4000)]
    lines = [" ".join(rng.choice(vocab) for _ in range(12)) for _ in range(200)]
    cut = lambda s, k: " ".join(s[i : i + k] for i in range(0, len(s), k))
    printable = string.ascii_letters + string.digits + string.punctuation + " " * 8
    sizes = (400, 800, 1700, 5000, 40000)
    assert verdicts([cut(base64.b64encode(rng.randbytes(n)).decode(), 7) for n in sizes]) == [False] * len(sizes)
    assert verdicts(["".join(rng.choice(printable) for _ in range(n)) for n in (1000, *sizes[2:])]) == [False] * 4
    plain = ["\n".join(lines[:n]) for n in (20, 60, 200)]
    mild = ["\n".join(lines[: n - n // 5] + lines[: n // 5]) for n in (20, 60, 200)]  # a fifth of the lines twice
    assert verdicts(plain) == [True] * 3 and verdicts(mild) == [False] * 3
