"""Operator 2, quality rules: compression bands.

Every whole text is compressed with zstandard, once as a whole and once in fixed
chunks.  A text whose ratio (compressed / raw bytes) leaves the band that its length
allows is rejected: below the band it repeats itself, above it it is incompressible.
Word, symbol, line and repetition counts give the plain base rules.

Defined results: a null or empty text has no words, so it fails the base rules and is
not kept; a null id stays null; repeated rows are scored alike, row by row; extra
columns of the input are ignored.  Nothing is shuffled: each row is scored where it is
read, so a lost executor only costs its own splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import bytesops as B
from .common import buffer_of, by_size, text_column

#: (length below, lowest, highest whole-text ratio).  The ratio falls as texts grow, so the limits do, by half
#: octaves.  From 256 bytes on, floors lie 0.007 to 0.02 under the smallest ratio, over sf0.01, sf0.1, check_s and
#: check_l, of documents that ``labels`` marks good and the base rules keep.  Over 64 KiB, where few are
#: labelled, floors are lower.  Tops lie between the largest such ratio, or English prose if that is larger, and base64.
#: Both are for text in Latin letters; legal boilerplate (GPL-3: 0.35 at 30 kB) lies under the floors.
WHOLE_BANDS = (
    (128, 0.00, 2.20),
    (256, 0.45, 0.95),
    (362, 0.505, 0.84),
    (512, 0.50, 0.82),
    (724, 0.505, 0.78),
    (1024, 0.48, 0.76),
    (1448, 0.47, 0.72),
    (2048, 0.455, 0.72),
    (2896, 0.445, 0.70),
    (4096, 0.435, 0.70),
    (5792, 0.425, 0.65),
    (8192, 0.415, 0.65),
    (11585, 0.407, 0.65),
    (16384, 0.402, 0.65),
    (23170, 0.395, 0.60),
    (32768, 0.39, 0.60),
    (65536, 0.38, 0.60),
    (131072, 0.36, 0.60),
    (float("inf"), 0.32, 0.60),
)
CHUNK = 2048
#: A last chunk under this length is judged together with the chunk before it; a whole text under it has no chunks.
LEAST_CHUNK = 512
#: Chunks of good documents have 0.43 to 0.70, of base64 0.77 and more.
CHUNK_BAND = (0.40, 0.73)
LEVEL = 3
SLICE = 1 << 20

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_bytes long, ratio double, chunk_min double, chunk_max double, kept boolean"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts of texts laid end to end."""
    n = len(offsets) - 1
    words = B.Words(data, offsets)
    spans = B.SpanHash(data)
    out = {
        "n_words": words.counts,
        "word_chars": B.per_text(words.solid & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": B.per_text(_SYMBOL[data], offsets),
    }
    # lines: the newline of a line belongs to the line before it
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))[: len(starts)]
    ends = np.where((ends > starts) & (data[np.maximum(ends - 1, 0)] == 10), ends - 1, ends) if len(starts) else ends
    line_text = np.searchsorted(offsets, starts, side="right") - 1
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(words.solid, out=filled[1:])
    worded = filled[ends] > filled[starts]
    starts, ends, line_text = starts[worded], ends[worded], line_text[worded]
    salt = B.mix(line_text.astype(np.uint64) + np.uint64(1))
    _, later = B.repeated(B.exact(B.mix(spans(starts, ends) ^ salt), lambda i, j: (line_text[i] == line_text[j]) & spans.same(starts, ends, i, j)))
    out["n_dup_lines"] = np.bincount(line_text[later], minlength=n).astype(np.int64)
    # three-word windows
    h = B.exact(spans(words.starts, words.ends), lambda i, j: spans.same(words.starts, words.ends, i, j))
    inside = np.flatnonzero(words.text[2:] == words.text[:-2]) if len(h) > 2 else np.zeros(0, np.int64)
    salt = B.mix(words.text[inside].astype(np.uint64) + np.uint64(1))
    key = B.mix(B.mix(B.mix(h[inside] + salt) * np.uint64(3) + h[inside + 1]) * np.uint64(5) + h[inside + 2])

    def alike(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        i, j = inside[i], inside[j]
        return (words.text[i] == words.text[j]) & (h[i] == h[j]) & (h[i + 1] == h[j + 1]) & (h[i + 2] == h[j + 2])

    many, _ = B.repeated(B.exact(key, alike))
    hit = B.covered(inside[many], 3, len(h))
    out["n_repeat_words"] = np.bincount(words.text[hit], minlength=n).astype(np.int64)
    return out


def _ratios(data: np.ndarray, offsets: np.ndarray):
    press = zstandard.ZstdCompressor(level=LEVEL)
    whole, low, high = (np.full(len(offsets) - 1, np.nan) for _ in range(3))
    for i, (s, e) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        if e == s:
            continue
        raw = data[s:e].tobytes()
        whole[i] = len(press.compress(raw)) / len(raw)
        if len(raw) <= CHUNK:
            if len(raw) >= LEAST_CHUNK:
                low[i] = high[i] = whole[i]
            continue
        cuts = list(range(0, len(raw), CHUNK))
        if len(raw) - cuts[-1] < LEAST_CHUNK:
            cuts.pop()
        found = [len(press.compress(raw[k:m])) / (m - k) for k, m in zip(cuts, [*cuts[1:], len(raw)], strict=True)]
        low[i], high[i] = min(found), max(found)
    return whole, low, high


def in_band(n_bytes: np.ndarray, whole: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The method's verdict: every ratio lies in the band of its length."""
    row = np.searchsorted([b[0] for b in WHOLE_BANDS], n_bytes, side="right")
    floor, top = (np.array([b[k] for b in WHOLE_BANDS])[row] for k in (1, 2))
    fine = (whole >= floor) & (whole <= top)
    return fine & ~(low < CHUNK_BAND[0]) & ~(high > CHUNK_BAND[1])


def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, SLICE):
        data, offsets = buffer_of(text_column(batch))
        out = base_counts(data, offsets)
        out["base_failed"] = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
        out["n_bytes"] = np.diff(offsets)
        whole, low, high = _ratios(data, offsets)
        kept = ~out["base_failed"] & in_band(out["n_bytes"], whole, low, high)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_bytes")
        columns = [batch.column(0).cast(pa.int64()), *(pa.array(out[k]) for k in names)]
        columns += [pa.array(x, from_pandas=True) for x in (whole, low, high)] + [pa.array(kept)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names, "ratio", "chunk_min", "chunk_max", "kept"])


def compression_bands(docs: DataFrame) -> DataFrame:
    """Counts, ratios and verdict for each row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(score_batches, SCHEMA)
