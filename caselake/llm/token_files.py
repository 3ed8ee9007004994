"""Operator 4, token-ID output: every document's ids, simple-8b packed, in ascending doc_id order.

Texts are encoded with the tokenizers library.  Its model treats words apart from one another, so
each distinct word is encoded once and looked up afterwards; texts that hold a special token's
string go through the library whole.  An end id closes each document.

Files are Parquet containers of simple-8b segments (see simple8b), one file a range of doc_id, in
the shared folder: Spark's committer makes them whole even when executors are lost.  Only one
count a range reaches the driver, from which the ranges' first positions follow.

Defined results: a null text is an empty one (the end id alone); rows of one doc_id stand side
by side, ordered by text; a null id comes last and is returned as null; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simple8b
from .bytesops import gather
from .common import bucket_placer, buffer_of, by_size, partitions, stage, text_column

END_ID = 2
SLICE = 4 << 20
#: Known words are forgotten beyond this many, to bound memory.
CACHE = 500_000
KEEP_HITS = 3
SEGMENT_IDS = 1 << 20
NO_ID = np.iinfo(np.int64).min  # stands for a null doc_id inside files: a doc_id of this value comes back as null
SEGMENT_SCHEMA = "bucket int, first long, n_ids long, segment binary"
RESULT_SCHEMA = "doc_id long, bucket int, first long, n_tokens long, ids_crc32 long"
_TAIL = b".,!?;:*$&%#|-"


#: Texts that a vocabulary must encode alike by words and as wholes.
_PROBES = (
    "", " a  b\tc\x0bd\ne\u00a0f ", "Hello, World!! it's we'll DON'T 'tis", "caf\u00e9 na\u00efve; \u00dcn\u00efcode\u2026 stra\u00dfe 3.14 x1y2 \u0130stanbul",
    "a.b,c;d:e!f?g", "word. word, word", "$5 50% #tag &c *x* a-b |", "\u65e5\u672c\u8a9e\u3001\u30c6\u30b9\u30c8 \U0001f600x", "x" * 300, "1 22 333 4444 v2",
)


class WordEncoder:
    """Ids of whole texts, each distinct word encoded once by the library.

    This needs a vocabulary that splits at ASCII spaces and between letters and signs, and ignores case; others are refused."""

    def __init__(self, vocabulary: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.special = [t.content.lower().encode() for t in self.library.get_added_tokens_decoder().values()]
        with open(vocabulary, encoding="utf-8") as f:
            suffix = json.load(f)["model"].get("end_of_word_suffix") or "\0"
        self.closes = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab().items():
            self.closes[i] = token.endswith(suffix)
        self._forget()
        raw = [t.encode() for t in _PROBES]
        ids, lengths = self.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        if [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] != self._whole(list(_PROBES)):
            raise ValueError(f"{vocabulary}: words can't be encoded one by one under this vocabulary")

    def _forget(self) -> None:
        """Keep the words met several times since the last time, and forget the others."""
        keep = np.flatnonzero(self.hits >= KEEP_HITS) if hasattr(self, "hits") else np.zeros(0, np.int64)
        names = list(self.known) if len(keep) else []
        size = self.size[keep] if len(keep) else np.zeros(0, np.int64)
        self.pool = gather(self.pool, self.first[keep], size) if len(keep) else np.zeros(0, np.uint32)
        self.known = {names[k]: i for i, k in enumerate(keep)}
        self.first, self.size, self.hits = np.cumsum(size) - size, size, np.zeros(len(keep), np.int64)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _distinct(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(words, their ids end to end, ids of each): those of letters only share a call, split at word ends."""
        plain = [w for w in words if w.isalpha()]  # of ASCII letters
        mixed = [w for w in words if not w.isalpha()] if len(plain) < len(words) else []
        letters = [not w.isascii() and w.decode().isalpha() for w in mixed]
        plain += compress(mixed, letters)
        other = [w for w, only in zip(mixed, letters, strict=True) if not only]
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        names, flat, sizes = [], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for group, ids in zip(groups, self._whole([b" ".join(g).decode() for g in groups]), strict=True):
            found = np.array(ids, np.uint32)
            cuts = np.flatnonzero(self.closes[found]) + 1
            if len(cuts) != len(group) or cuts[-1] != len(found):
                other += group
                continue
            names += group
            flat.append(found)
            sizes.append(np.diff(cuts, prepend=0))
        found = self._whole([w.decode() for w in other])
        sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        flat.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
        return names + other, np.concatenate(flat), np.concatenate(sizes)

    def _learn(self, words: list[bytes]) -> None:
        cores, tails, tailed = [w.rstrip(_TAIL) for w in words], [], []
        for at, w in enumerate(words):
            core = cores[at]
            if core is not w:
                # a letter and the signs behind it are never one token
                if core and (core[-1:].isalpha() if core[-1] < 128 else core.decode()[-1].isalpha()):
                    tails.append(w[len(core) :])
                    tailed.append(at)
                else:
                    cores[at] = w
        names, flat, size = self._distinct(list({*cores, *tails}))
        index = dict(zip(names, range(len(names)), strict=True))
        parts = np.ones(len(words), np.int64)
        parts[tailed] = 2
        start = np.cumsum(parts) - parts
        sequence = np.empty(int(parts.sum()), np.int64)
        sequence[start] = np.fromiter(map(index.__getitem__, cores), np.int64, len(cores))
        sequence[start[tailed] + 1] = np.fromiter(map(index.__getitem__, tails), np.int64, len(tails))
        found = gather(flat, (np.cumsum(size) - size)[sequence], size[sequence])
        sizes = np.add.reduceat(size[sequence], start)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.hits = np.concatenate([self.hits, np.zeros(len(words), np.int64)])
        self.pool = np.concatenate([self.pool, found])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, ids of each text) of texts laid end to end."""
        if len(self.known) > CACHE:
            self._forget()
        words: list[bytes] = []
        counts = np.zeros(len(offsets) - 1, np.int64)
        whole: dict[int, list[int]] = {}
        for i, (s, e) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            raw = data[s:e].tobytes()
            low = raw.lower()
            if any(t in low for t in self.special):
                whole[i] = self._whole([raw.decode()])[0]
                continue
            found = low.split()
            counts[i] = len(found)
            words += found
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            unseen = list(map(words.__getitem__, new.tolist()))
            self._learn(list(dict.fromkeys(unseen)))
            at[new] = np.fromiter(map(self.known.__getitem__, unseen), np.int64, len(new))
        self.hits += np.bincount(at, minlength=len(self.hits))
        size = self.size[at]
        ids = gather(self.pool, self.first[at], size)
        ends = np.cumsum(size)
        before = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        lengths = np.diff(before)
        if whole:
            parts = [np.array(whole[i], np.uint32) if i in whole else ids[before[i] : before[i + 1]] for i in range(len(counts))]
            return np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, lengths


_encoders: dict[str, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    """One encoder a process and vocabulary."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = WordEncoder(vocabulary)
    return _encoders[vocabulary]


def _encode_batches(vocabulary: str, end_id: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in by_size(batches, SLICE):
            ids, lengths = encoder(vocabulary).encode(*buffer_of(text_column(batch)))
            ends = np.cumsum(lengths)
            kind = np.uint16 if not len(ids) or max(int(ids.max()), end_id) < 1 << 16 else np.uint32
            wide = kind is np.uint32
            packed = [press.compress(np.append(ids[e - n : e], end_id).astype(kind).tobytes()) for e, n in zip(ends, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(packed, pa.binary()), pa.array([wide] * len(packed))], names=["doc_id", "ids", "wide"])

    return rows


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (doc_id, ids, wide, bucket) of one range to segments."""
    unpress = zstandard.ZstdDecompressor()
    docs: list[int] = []
    held: list[np.ndarray] = []
    n_held = first = 0
    bucket = None

    def flush() -> pa.RecordBatch:
        blob = simple8b.pack_segment(np.array(docs, np.int64), np.array([len(h) for h in held], np.int64), np.concatenate(held))
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([first], pa.int64()), pa.array([n_held], pa.int64()), pa.array([blob], pa.binary())],
            names=["bucket", "first", "n_ids", "segment"],
        )

    for batch in batches:
        for doc_id, ids, wide, here in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bucket = here
            docs.append(NO_ID if doc_id is None else doc_id)
            held.append(np.frombuffer(unpress.decompress(ids), np.uint32 if wide else np.uint16))
            n_held += len(held[-1])
            if n_held >= SEGMENT_IDS:
                yield flush()
                first += n_held
                docs, held, n_held = [], [], 0
    if docs:
        yield flush()


def _result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, first, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            docs, lengths, ids = simple8b.unpack_segment(blob)
            ids = ids.astype("<u4")
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs.astype(np.int64), mask=docs == NO_ID), pa.array(np.full(len(docs), bucket, np.int32)), pa.array(first + ends - lengths), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "bucket", "first", "n_tokens", "ids_crc32"],
            )


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the segment files; returns the files as read back."""
    n = partitions(docs.sparkSession)
    encoded = docs.select("doc_id", "text").mapInArrow(_encode_batches(vocabulary, end_id), "doc_id long, ids binary, wide boolean")
    place = bucket_placer(docs.select(F.col("doc_id").cast("long").alias("doc_id")), n)  # from the ids alone: texts are encoded once
    dealt = place(encoded).repartitionById(n, F.col("bucket")).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "ids")
    return stage(dealt.select("doc_id", "ids", "wide", "bucket").mapInArrow(_segment_batches, SEGMENT_SCHEMA), "tokens")


def read_tokens(files: DataFrame) -> DataFrame:
    """Per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = files.sparkSession
    totals = {r.bucket: r.n for r in files.groupBy("bucket").agg(F.sum("n_ids").alias("n")).collect()}
    base, before = [], 0
    for bucket in sorted(totals):
        base.append((bucket, before))
        before += totals[bucket]
    bases = spark.createDataFrame(base or [], "bucket int, base long")
    rows = files.select("bucket", "first", "segment").mapInArrow(_result_batches, RESULT_SCHEMA)
    return rows.join(F.broadcast(bases), "bucket").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
