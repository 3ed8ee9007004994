"""Operator 9, language identification: word-first backoff.

A model holds per-language log frequencies of known words and of character n-grams of 5
to 1 letters.  A known word adds its log frequency in every language; an unseen word adds
the mean of its known 5-grams, or, if none is known, of its 4-grams, and so on.  The
language with the largest sum wins; the score is its share after a softmax.

The counts behind the model come from a bounded sample of labelled rows: SAMPLE rows in
expectation, dealt evenly over the languages and chosen by a hash of doc_id.  The model
keeps every word and n-gram of that sample, so what is sent to every executor is bounded by the
sample.  Prediction reads every whole text once, without an exchange.

Defined results: a null text or one without a letter is ``und`` with score 0.0; a null id
is never learned from and counts as not held out; rows without a language are not learned
from; ties go to the language that sorts first; with nothing to learn from, every row is
``und``; repeated rows are predicted alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .common import buffer_of, by_size, text_column

SAMPLE = 8_000
LEVELS = (5, 4, 3, 2, 1)
#: What an unseen word's n-grams count against a known word.
BACKOFF = 0.5
#: Largest difference in log frequency that one word can make.
REACH = 6.0
SLICE = 1 << 20
SCHEMA = "doc_id long, lang_pred string, score double"


@dataclass
class Model:
    langs: list[str]
    keys: np.ndarray  # sorted hashes of words and n-grams
    weights: np.ndarray  # a row of centred log frequencies for each key


def _level_key(hashes: np.ndarray, level: int) -> np.ndarray:
    """Words (level 0) and n-grams of each length live in one key space."""
    return B.mix(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))


def _spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) of ``counts[i]`` consecutive positions from ``starts[i]``."""
    owner = np.repeat(np.arange(len(starts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, starts[owner] + within


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, level, key, n): words and n-grams of the sampled texts, counted by slice."""
    for batch in by_size(batches, SLICE):
        data, offsets = buffer_of(text_column(batch))
        points, words = B.letter_words(data, offsets)
        spans = B.SpanHash(points)
        langs, code = np.unique(np.array(batch.column(batch.schema.get_field_index("lang")).to_pylist(), dtype=object), return_inverse=True)
        found = [(0, words.text, spans(words.starts, words.ends))]
        for level in LEVELS:
            counts = np.maximum(words.ends - words.starts - level + 1, 0)
            owner, at = _spread(words.starts, counts)
            found.append((level, words.text[owner], spans(at, at + level)))
        for level, text, hashes in found:
            if not len(hashes):
                continue
            key = _level_key(hashes, level)
            owner = code[text]
            order = np.lexsort((key, owner))
            key, owner = key[order], owner[order]
            new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])))
            n = np.diff(np.append(new, len(key)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs[owner[new]], pa.string()), pa.array(np.full(len(new), level, np.int32)), pa.array(key[new].view(np.int64)), pa.array(n)],
                names=["lang", "level", "key", "n"],
            )


def _sampled(labelled: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` rows of ``labelled``, dealt evenly over the languages, by a hash of doc_id."""
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return labelled
    each = sample / len(sizes)
    rates = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, each / n)))])
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(lot < F.element_at(rates, F.col("lang")))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``labelled`` (doc_id, text, lang); rows with a null in any of them are left out."""
    rows = labelled.select("doc_id", "text", "lang").dropna()
    counts = (
        _sampled(rows, sample)
        .mapInArrow(_count_batches, "lang string, level int, key long, n long")
        .groupBy("level", "key", "lang")
        .agg(F.sum("n").alias("n"))
    )
    table = counts.toArrow()
    table = table.set_column(table.schema.get_field_index("lang"), "lang", table["lang"].combine_chunks().dictionary_encode())
    by_level = table.group_by(["lang", "level"]).aggregate([("n", "sum")])
    totals = {(lang, level): n for lang, level, n in zip(*(by_level[c].to_pylist() for c in ("lang", "level", "n_sum")), strict=True)}
    langs = sorted({lang for lang, _ in totals})
    at = {lang: i for i, lang in enumerate(langs)}
    keys, where = np.unique(table["key"].to_numpy().view(np.uint64), return_inverse=True)
    seen = np.zeros((len(keys), max(len(langs), 1)))
    codes = table["lang"].combine_chunks()
    codes = codes if isinstance(codes, pa.DictionaryArray) else codes.chunk(0)
    lang = np.array([at[x] for x in codes.dictionary.to_pylist()], np.int64)[codes.indices.to_numpy()] if len(codes) else np.zeros(0, np.int64)
    seen[where, lang] = table["n"].to_numpy()
    level = np.zeros(len(keys), np.int64)
    level[where] = table["level"].to_numpy()
    size = np.array([[totals.get((x, k), 0) for x in langs] or [0] for k in range(max(LEVELS) + 1)], float)
    logs = np.log((seen + 0.5) / (size[level] + 0.5 * np.maximum(np.bincount(level, minlength=max(LEVELS) + 1)[level], 1)[:, None])) if len(keys) else seen
    logs -= logs.mean(axis=1, keepdims=True) if len(keys) else 0
    return Model(langs, keys, np.clip(logs, -REACH, REACH).astype(np.float32))


def _find(model: Model, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(model.keys, keys), max(len(model.keys) - 1, 0))
    return at, model.keys[at] == keys if len(model.keys) else np.zeros(len(keys), bool)


def evidence(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of weights by text and language, words by text)."""
    points, words = B.letter_words(data, offsets)
    spans = B.SpanHash(points)
    at, known = _find(model, _level_key(spans(words.starts, words.ends), 0))
    score = np.zeros((len(words.starts), len(model.langs)), np.float32)
    score[known] = model.weights[at[known]]
    left = np.flatnonzero(~known)
    for level in LEVELS:
        if not len(left):
            break
        owner, place = _spread(words.starts[left], np.maximum(words.ends[left] - words.starts[left] - level + 1, 0))
        at, hit = _find(model, _level_key(spans(place, place + level), level))
        owner, at = owner[hit], at[hit]
        n = np.bincount(owner, minlength=len(left))
        some = n > 0
        for k in range(len(model.langs)):
            total = np.bincount(owner, weights=model.weights[at, k], minlength=len(left))
            score[left[some], k] = BACKOFF * total[some] / n[some]
        left = left[~some]
    sums = np.stack([np.bincount(words.text, weights=score[:, k], minlength=len(offsets) - 1) for k in range(len(model.langs))], axis=1)
    return sums, words.counts


def predictor(model: Model) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, SLICE):
            data, offsets = buffer_of(text_column(batch))
            n = batch.num_rows
            langs, score = np.full(n, "und", object), np.zeros(n)
            if model.langs:
                sums, words = evidence(model, data, offsets)
                best = sums.argmax(axis=1)
                share = 1 / np.exp(sums - sums[np.arange(n), best][:, None]).sum(axis=1)
                some = words > 0
                langs[some], score[some] = np.array(model.langs, object)[best[some]], share[some]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(langs, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return rows


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of each row of ``docs``."""
    return docs.select("doc_id", "text").mapInArrow(predictor(model), SCHEMA)


def held_out(fold: Column, value: int) -> Column:
    return F.coalesce(fold == value, F.lit(False))
