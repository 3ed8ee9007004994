"""Operator 3, document fingerprints: Lempel-Ziv phrase sets.

A text is parsed into dictionary phrases (each phrase is the longest known phrase and
one more character, LZ78).  Every phrase is hashed to 32 bits; the SIZE smallest hashes
of the phrase set are the fingerprint, written as hex.  The likeness of two fingerprints
is the share of the smallest hashes of their union that both have: an estimate of the
Jaccard likeness of the phrase sets, which follows how well one text compresses the other.

Defined results: a null text is an empty one; the empty text has the fingerprint ``""``;
two empty texts are alike (1.0), an empty and a filled one are not (0.0).  Rows are
ordered by (doc_id, text), a null id last, so repeated rows and ties follow one another.
Extra columns are ignored; an empty table gives an empty result.

At scale: one exchange moves the texts into ranges of doc_id.  Only one row per range
(the first of the next range) is sent twice, found from one minimum per range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .common import bucket_placer, partitions, text_column

SIZE = 64
EDIT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
PRINT_SCHEMA = "doc_id long, n_phrases long, fingerprint string"


def parse(text: str, seen: set, phrase: str) -> tuple[list[int], str]:
    """LZ78: the ends of the phrases that ``text`` adds to ``seen``, and the phrase left open."""
    ends: list[int] = []
    add, mark = seen.add, ends.append
    for at, char in enumerate(text, 1):
        phrase += char
        if phrase not in seen:
            add(phrase)
            mark(at)
            phrase = ""
    return ends, phrase


def _hashes(text: str, first: int, ends: list[int]) -> np.ndarray:
    """32-bit hashes of the phrases of ``text`` that begin at ``first`` and end at ``ends``."""
    if not ends:
        return np.zeros(0, np.uint32)
    stops = np.array(ends, np.int64)
    starts = np.empty_like(stops)
    starts[0], starts[1:] = first, stops[:-1]
    spans = B.SpanHash(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    return (spans(starts, stops) >> np.uint64(32)).astype(np.uint32)


def _smallest(hashes: np.ndarray) -> np.ndarray:
    if len(hashes) > 2 * SIZE:
        hashes = np.partition(hashes, 2 * SIZE)[: 2 * SIZE]
    return np.unique(hashes)[:SIZE]


def signature(text: str) -> np.ndarray:
    ends, _ = parse(text, set(), "")
    return _smallest(_hashes(text, 0, ends))


def as_hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    distinct = both[np.append(True, both[1:] != both[:-1])][:SIZE]
    shared = both[:-1][both[1:] == both[:-1]]
    return float(np.count_nonzero(shared <= distinct[-1]) / len(distinct))


class _Parsed:
    """A text, its signature, and the parser's state where its edited text departs from it."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.keep = len(text) - len(text) // 2
        seen: set = set()
        head, open_phrase = parse(text[: self.keep], seen, "")
        self.seen, self.open = set(seen), open_phrase
        tail, _ = parse(text[self.keep :], seen, open_phrase)
        hashes = _hashes(text, 0, head + [self.keep + t for t in tail])
        self.head = hashes[: len(head)]
        self.sig = _smallest(hashes)

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        added = following[: len(self.text) // 2]
        tail, _ = parse(added, self.seen, self.open)
        shift = len(self.open)
        more = _hashes(self.open + added, 0, [shift + t for t in tail])
        return self.text[: self.keep] + added, _smallest(np.concatenate([self.head, more]))


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    waiting: _Parsed | None = None
    for batch in batches:
        ids, edge = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for i, (doc_id, text) in enumerate(zip(ids, text_column(batch), strict=True)):
            now = _Parsed(doc_id, text.as_py())
            if waiting is not None:
                body, sig = waiting.edited(now.text)
                out.append(
                    (waiting.doc_id, len(waiting.text), hashlib.sha256(body.encode()).hexdigest(), as_hex(waiting.sig), as_hex(sig), likeness(waiting.sig, sig), likeness(waiting.sig, now.sig))
                )
            waiting = None if edge[i] else now
            if edge[i]:  # further rows are ties of the first one
                break
        if out:
            yield _as_batch(out)
            out = []
        if waiting is None and batch.num_rows:
            break


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = [part.split()[0] for part in EDIT_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _print_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, prints = [], []
        for text in text_column(batch):
            ends, _ = parse(text.as_py(), set(), "")
            counts.append(len(ends))
            prints.append(as_hex(_smallest(_hashes(text.as_py(), 0, ends))))
        columns = [batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(prints, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_phrases", "fingerprint"])


def lz_fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each row of ``docs`` (doc_id, text); no exchange."""
    return docs.select("doc_id", "text").mapInArrow(_print_rows, PRINT_SCHEMA)


def lz_edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text (its last half replaced by the head of the
    next document), and the likeness of each text to its edited text and to the next document."""
    n = partitions(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = bucket_placer(docs.select("doc_id"), n)(docs)
    firsts = [(r.bucket, r.doc_id) for r in rows.groupBy("bucket").agg(F.min("doc_id").alias("doc_id")).orderBy("bucket").collect()]
    if not firsts:
        return docs.sparkSession.createDataFrame([], EDIT_SCHEMA)
    # the first row of each filled range also ends the filled range before it (the first range ends the last)
    targets = [(doc_id, firsts[i - 1][0]) for i, (_, doc_id) in enumerate(firsts)]
    ends = docs.sparkSession.createDataFrame(targets, "edge_id long, target int")
    edges = (
        rows.join(F.broadcast(ends), rows["doc_id"].eqNullSafe(ends["edge_id"]))
        .select("doc_id", "text", F.lit(True).alias("edge"), F.col("target").alias("bucket"))
    )
    dealt = rows.select("doc_id", "text", F.lit(False).alias("edge"), "bucket").unionByName(edges)
    placed = dealt.repartitionById(n, F.col("bucket")).sortWithinPartitions("edge", F.col("doc_id").asc_nulls_last(), F.coalesce("text", F.lit("")))
    return placed.select("doc_id", "text", "edge").mapInArrow(_edit_rows, EDIT_SCHEMA)
