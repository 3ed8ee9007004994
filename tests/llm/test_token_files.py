import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from caselake.llm import simple8b
from caselake.llm import token_files as T

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 70000), st.integers(0, 2**64 - 1)), max_size=2500))
def test_simple8b_round_trip(values):
    words, offsets = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(words, offsets, len(values)).tolist() == values
    assert len(offsets) == -(-len(values) // simple8b.BLOCK) + 1


def test_blocks_decode_alone():
    values = np.arange(5000, dtype=np.uint64) * 13 % 49408
    words, offsets = simple8b.encode(values)
    part = simple8b.decode(words[offsets[2] : offsets[3]], np.array([0, offsets[3] - offsets[2]]), simple8b.BLOCK)
    assert part.tolist() == values[2 * simple8b.BLOCK : 3 * simple8b.BLOCK].tolist()


TEXTS = [
    "", "  \n ", "Hello, World!! it's we'll DON'T", "café, naïve; Ünïcode… straße 3.14 x1y2", "<|endoftext|> and <|STARTOFTEXT|> lie",
    "été, İstanbul ΣΑΣ. κόσμος!", "a b c d\x0be", "日本語、テスト。 emoji 😀👍🏽, done.", "!!! ''' 's 't", "word," * 50, "x" * 3000,
]


def test_word_lookup_equals_the_library():
    library = Tokenizer.from_file(VOCABULARY)
    raw = [t.encode() for t in TEXTS]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, lengths = T.WordEncoder(VOCABULARY).encode(data, np.cumsum([0, *map(len, raw)]))
    got = [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in TEXTS]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_word_lookup_equals_the_library_on_any_text(texts):
    library = Tokenizer.from_file(VOCABULARY)
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, lengths = T.encoder(VOCABULARY).encode(data, np.cumsum([0, *map(len, raw)]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_round_trip(spark):
    library = Tokenizer.from_file(VOCABULARY)
    rows = [(i * 7 % 101, TEXTS[i % len(TEXTS)] + " " + "tok %d " % i * (i % 9)) for i in range(101)] + [(200, None), (201, "long words " * 30000), (None, "no id")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, bucket int").repartition(5)
    got = sorted((tuple(r) for r in T.read_tokens(T.write_tokens(docs, VOCABULARY)).collect()), key=lambda r: r[1])
    before, want = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [T.END_ID], "<u4")
        want.append((doc_id, before, len(ids), zlib.crc32(ids.tobytes())))
        before += len(ids)
    assert got == want


def test_empty_table(spark):
    assert T.read_tokens(T.write_tokens(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY)).count() == 0


def test_bad_segment():
    with pytest.raises(ValueError):
        simple8b.unpack_segment(b"nope" + bytes(40))
