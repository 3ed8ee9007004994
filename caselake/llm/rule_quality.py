"""Operator 10, quality classifier: a sparse rule ensemble.

Statistics of each whole text (counts and shares, computed where the row is read) feed
boosted shallow trees.  Every path of the trees, from the root to any node, becomes a
conjunctive rule; an L1-penalised logistic regression keeps few of them; the kept rules
are compiled into one Spark column expression over the statistics.

Labels come from a bounded sample of labelled rows (SAMPLE in expectation, chosen by a hash of
doc_id).  What reaches the driver is that sample's statistics, never texts.

Defined results: a null or empty text has all statistics 0 and is scored by the same rules; a
null id is never learned from and counts as not held out; without labels of both kinds the
score is the share of label 1 (0.5 without labels); repeated rows score alike; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .common import buffer_of, by_size, meet, text_column
from .compression_quality import base_counts

SAMPLE = 20_000
TREES, DEPTH, BINS, LEAST = 16, 3, 32, 20
SHRINK = 0.3
PENALTY = 2e-3
STEPS = 400
SLICE = 1 << 20

STATS = (
    "n_words", "mean_word", "symbol_share", "upper_share", "digit_share", "mark_share", "accent_share",
    "dup_line_share", "repeat_share", "echo_share", "distinct_share", "mean_line", "marked_word_share",
)
SCHEMA = "doc_id long, " + ", ".join(f"{s} double" for s in STATS)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = _UPPER.copy()
_ALPHA[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?#*$%&|<>=~^_{}[]\\")] = True


def text_stats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATS for each of the texts laid end to end."""
    n = len(offsets) - 1
    base = base_counts(data, offsets)
    words = B.Words(data, offsets)
    hashes = B.SpanHash(data)(words.starts, words.ends)
    salted = B.mix(hashes ^ B.mix(words.text.astype(np.uint64) + np.uint64(7)))
    _, later = B.repeated(salted)
    echo = np.append(False, (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1]))[: len(hashes)]
    ends_marked = _MARK[data[words.ends - 1]] if len(hashes) else np.zeros(0, bool)
    by_text = lambda flags: np.bincount(words.text[flags], minlength=n)
    count = np.maximum(base["n_words"], 1)
    chars = np.maximum(B.per_text((data & 0xC0) != 0x80, offsets), 1)
    letters = np.maximum(B.per_text(_ALPHA[data], offsets), 1)
    columns = {
        "n_words": base["n_words"],
        "mean_word": base["word_chars"] / count,
        "symbol_share": base["n_symbols"] / count,
        "upper_share": B.per_text(_UPPER[data], offsets) / letters,
        "digit_share": B.per_text(_DIGIT[data], offsets) / chars,
        "mark_share": B.per_text(_MARK[data], offsets) / chars,
        "accent_share": B.per_text(data >= 0xC0, offsets) / chars,
        "dup_line_share": base["n_dup_lines"] / (B.per_text(data == 10, offsets) + 1),
        "repeat_share": base["n_repeat_words"] / count,
        "echo_share": by_text(echo) / count,
        "distinct_share": (base["n_words"] - by_text(later)) / count,
        "mean_line": np.diff(offsets) / (B.per_text(data == 10, offsets) + 1),
        "marked_word_share": by_text(ends_marked) / count,
    }
    return np.stack([columns[s] for s in STATS], axis=1).astype(np.float64)


def _stat_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, SLICE):
        found = text_stats(*buffer_of(text_column(batch)))
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c) for c in found.T.copy())], names=["doc_id", *STATS])


def statistics(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_stat_batches, SCHEMA)


# --- the ensemble -------------------------------------------------------------------

Condition = tuple[int, bool, float]  # statistic, is it above, threshold


@dataclass
class Rules:
    rules: list[tuple[Condition, ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    intercept: float = 0.0


def _grow(x, binned, cuts, grad, hess, rows, depth, path, paths):
    """Split by the best gain of second-order loss; collect every path; return the leaf values by row."""
    value = np.zeros(len(grad))
    value[rows] = -grad[rows].sum() / (hess[rows].sum() + 1.0)
    if depth == 0 or len(rows) < 2 * LEAST:
        return value
    g_all, h_all = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, None)
    for j in range(x.shape[1]):
        g = np.cumsum(np.bincount(binned[rows, j], weights=grad[rows], minlength=BINS))[:-1]
        h = np.cumsum(np.bincount(binned[rows, j], weights=hess[rows], minlength=BINS))[:-1]
        n = np.cumsum(np.bincount(binned[rows, j], minlength=BINS))[:-1]
        gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
        gain[(n < LEAST) | (len(rows) - n < LEAST)] = -1
        gain = gain[: len(cuts[j])]
        if len(gain) and gain.max() > best[0]:
            best = (gain.max(), (j, int(gain.argmax())))
    if best[1] is None:
        return value
    j, k = best[1]
    for above in (False, True):
        side = rows[(binned[rows, j] > k) == above]
        longer = (*path, (j, above, float(cuts[j][k])))
        paths.append(longer)
        value[side] = _grow(x, binned, cuts, grad, hess, side, depth - 1, longer, paths)[side]
    return value


def _tidy(path: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The same conjunction with one bound a side for each statistic."""
    bound: dict[tuple[int, bool], float] = {}
    for j, above, at in path:
        bound[j, above] = (max if above else min)(at, bound.get((j, above), at))
    return tuple(sorted((j, above, at) for (j, above), at in bound.items()))


def holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, at in rule:
        out &= (x[:, j] > at) == above
    return out


def fit_rules(x: np.ndarray, y: np.ndarray) -> Rules:
    """Boosted trees, their paths as rules, and lasso logistic weights by accelerated proximal steps."""
    if not len(y):
        return Rules()
    share = float(np.clip(y.mean(), 0.01, 0.99))
    start = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return Rules(intercept=start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))[: BINS - 1] for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    margin, paths = np.full(len(y), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        margin += SHRINK * _grow(x, binned, cuts, p - y, p * (1 - p), np.arange(len(y)), DEPTH, (), paths)
    rules = sorted({_tidy(p) for p in paths}, key=lambda r: (len(r), r))
    hits = np.stack([holds(r, x) for r in rules], axis=1).astype(np.float64)
    spread = hits.std(axis=0)
    rules = [r for r, s in zip(rules, spread, strict=True) if s > 0]
    hits, spread = hits[:, spread > 0], spread[spread > 0]
    z = np.hstack([(hits - hits.mean(axis=0)) / spread, np.ones((len(y), 1))])
    step = 4.0 / np.linalg.eigvalsh(z.T @ z / len(y))[-1]
    w = ahead = np.zeros(z.shape[1])
    w[-1] = start
    t = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-(z @ ahead)))
        new = ahead - step * (z.T @ (p - y)) / len(y)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * PENALTY, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    raw = w[:-1] / spread
    kept = np.flatnonzero(raw)
    return Rules([rules[i] for i in kept], [float(raw[i]) for i in kept], float(w[-1] - (raw * hits.mean(axis=0)).sum()))


def compile_rules(model: Rules) -> Column:
    """The score, a Spark expression over the statistics."""
    total = F.lit(model.intercept)
    for rule, weight in zip(model.rules, model.weights, strict=True):
        tests = [F.col(STATS[j]) > at if above else F.col(STATS[j]) <= at for j, above, at in rule]
        total = total + F.when(reduce(Column.__and__, tests), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Rules:
    """Learn from the rows of ``labels`` (doc_id, label 0 or 1) and their texts in ``docs``."""
    known = labels.select("doc_id", "label").dropna().dropDuplicates(["doc_id"])
    rate = min(1.0, sample / max(known.count(), 1))
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rows = meet(docs.select("doc_id", "text").where(lot < rate), known.where(lot < rate), 4 * sample)
    table = rows.select("doc_id", "text", "label").mapInArrow(_labelled_batches, SCHEMA + ", label int").toArrow().sort_by("doc_id")
    x = np.stack([table[s].to_numpy() for s in STATS], axis=1) if table.num_rows else np.zeros((0, len(STATS)))
    return fit_rules(x, table["label"].to_numpy().astype(float) if table.num_rows else np.zeros(0))


def _labelled_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column(2).cast(pa.int32())
        for part in _stat_batches(iter([batch])):
            yield pa.RecordBatch.from_arrays([*part.columns, label.slice(0, part.num_rows)], names=[*part.schema.names, "label"])
            label = label.slice(part.num_rows)


def score(docs: DataFrame, model: Rules) -> DataFrame:
    """doc_id, the statistics and the score of each row of ``docs``."""
    return statistics(docs).withColumn("score", compile_rules(model))
