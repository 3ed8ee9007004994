"""Operator 1, mixing sources to target weights: soft membership.

A classifier learned from a labelled table gives every document a posterior over domains.  Domain k
then holds sum(rate * tokens * posterior_k) expected tokens.  Nonnegative document rates are fitted
by projected-gradient least squares, so that these totals meet the targets.  The gradient of a
document's rate is its posterior times a vector of residuals, one number a domain; that vector is all
that a step moves.  A step's rates follow from the residual vectors so far: each pass replays those since the
rates were last written (every KEEP steps) and returns one row of partial totals a partition.  The steps end when the totals
meet the targets, or when a step closes under a hundredth of the gap (targets that rates can't meet); ``Fit`` holds both.

The classifier is naive Bayes over hashed words with a tempered posterior; its counts come from a
bounded sample (SAMPLE rows in expectation, dealt evenly over domains by a hash of doc_id) and fill BUCKETS x domains numbers.

Defined results: a null or empty text has 0 tokens, the prior as posterior, and whatever rate
its posterior earns; a null id is never learned from and is returned as null; equal rows get equal
rates; a domain without tokens can't be raised and keeps its shortfall; without labelled rows there is one
domain, "", and every rate is the quotient of target and total; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import bytesops as B
from .common import buffer_of, by_size, drop_staged, meet, scope, stage, text_column

SAMPLE = 6_000
BUCKETS = 1 << 14
#: Sampled rows of each domain in expectation, however many domains share the sample.
LEAST_PER_DOMAIN = 20
TOLERANCE = 1e-4
#: A step that leaves more than this share of the gap is the last one: the targets can't be met, or hardly.
STALL = 0.99
#: Steps between writings of the rates.
KEEP = 16
#: Target shares are natural shares to this power: below 1 it lifts the small domains.
TEMPER = 0.7
#: What the largest domain grows by under the default targets.
LIFT = 0.02
SLICE = 1 << 20
POSTERIOR_SCHEMA = "doc_id long, n_tokens long, posterior array<double>"


@dataclass
class Classifier:
    domains: list[str]
    prior: np.ndarray
    logs: np.ndarray  # BUCKETS x domains


@dataclass
class Fit:
    domains: list[str]
    targets: np.ndarray
    natural: np.ndarray
    reached: np.ndarray
    step: float
    residuals: np.ndarray  # a row for each gradient step
    floor: float

    @property
    def met(self) -> bool:
        """Do the reached totals meet the targets?"""
        return bool(np.abs(self.reached - self.targets).sum() <= TOLERANCE * max(self.targets.sum(), 1e-12))


def _bucketed(data: np.ndarray, offsets: np.ndarray) -> tuple[B.Words, np.ndarray]:
    words = B.Words(data, offsets)
    return words, (B.SpanHash(B.LOWER[data])(words.starts, words.ends) % np.uint64(BUCKETS)).astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, SLICE):
        words, bucket = _bucketed(*buffer_of(text_column(batch)))
        names, code = np.unique(np.array(batch.column(2).to_pylist(), dtype=object), return_inverse=True)
        found, n = np.unique(code[words.text] * BUCKETS + bucket, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(names[found // BUCKETS], pa.string()), pa.array(found % BUCKETS), pa.array(n)], names=["domain", "bucket", "n"])


def learn(labelled: DataFrame, listed: DataFrame | None = None, sample: int = SAMPLE) -> Classifier:
    """Learn from ``labelled`` (doc_id, text, domain), or those rows of it that ``listed`` (doc_id) names, sampled evenly over
    domains; rows with a null in any column are left out.  The model holds BUCKETS numbers a domain."""
    rows = labelled.select("doc_id", "text", F.col("domain").cast("string").alias("domain")).dropna()
    ids = rows.select("doc_id", "domain")
    ids = ids if listed is None else ids.join(listed.select("doc_id"), "doc_id", "left_semi")
    sizes = {r.domain: r.n for r in ids.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(sizes) or [""]
    logs, prior = np.zeros((BUCKETS, len(domains))), np.full(len(domains), 1 / len(domains))
    if sizes:
        lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
        each = max(sample / len(sizes), LEAST_PER_DOMAIN)
        shares = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, min(1.0, each / n))])
        picked = ids.where(lot < F.element_at(shares, F.col("domain"))).select("doc_id").distinct()
        chosen = meet(rows.where(lot < max(min(1.0, each / n) for n in sizes.values())), picked, int(4 * each * len(sizes)))
        counts = chosen.mapInArrow(_count_batches, "domain string, bucket long, n long").groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toArrow()
        seen = np.full((BUCKETS, len(domains)), 0.1)
        at = {d: i for i, d in enumerate(domains)}
        if counts.num_rows:
            seen[counts["bucket"].to_numpy(), [at[d] for d in counts["domain"].to_pylist()]] += counts["n"].to_numpy()
        logs = np.log(seen / seen.sum(axis=0))
        logs -= logs.mean(axis=1, keepdims=True)
        prior = np.array([sizes[d] for d in domains], float) / sum(sizes.values())
    return Classifier(domains, prior, logs.astype(np.float32))


def _posterior_batches(model: Classifier) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.domains)
        for batch in by_size(batches, SLICE):
            words, bucket = _bucketed(*buffer_of(text_column(batch)))
            n = batch.num_rows
            sums = np.stack([np.bincount(words.text, weights=model.logs[bucket, j], minlength=n) for j in range(k)], axis=1)
            logit = np.log(model.prior) + sums / np.sqrt(np.maximum(words.counts, 1))[:, None]  # tempered: words aren't independent
            logit = np.exp(logit - logit.max(axis=1, keepdims=True))
            posterior = (logit / logit.sum(axis=1, keepdims=True)).ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(words.counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(posterior))],
                names=["doc_id", "n_tokens", "posterior"],
            )

    return rows


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_posterior_batches(model), POSTERIOR_SCHEMA)


def _matrix(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(batch.schema.get_field_index("posterior"))
    return batch.column(batch.schema.get_field_index("n_tokens")).to_numpy().astype(float), column.flatten().to_numpy().reshape(-1, k)


def _rate(batch: pa.RecordBatch) -> np.ndarray | None:
    at = batch.schema.get_field_index("rate")
    return None if at < 0 else batch.column(at).to_numpy()


def _with_rates(table: DataFrame, k: int, residuals: np.ndarray, step: float, floor: float) -> DataFrame:
    """The table with the rates after these steps, written."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                tokens, p = _matrix(batch, k)
                held = batch.column(batch.schema.get_field_index("posterior"))
                yield pa.RecordBatch.from_arrays([pa.array(tokens.astype(np.int64)), held, pa.array(replay(p, residuals, step, _rate(batch), floor))], names=["n_tokens", "posterior", "rate"])

    return stage(table.drop("doc_id").mapInArrow(rows, "n_tokens long, posterior array<double>, rate double"), "rates")


def replay(posterior: np.ndarray, residuals: np.ndarray, step: float, rate: np.ndarray | None = None, floor: float = 0.0) -> np.ndarray:
    """Rates after the projected-gradient steps of these residual vectors, from 1 or from ``rate``."""
    rate = np.ones(len(posterior)) if rate is None else rate
    for residual in residuals:
        rate = np.maximum(rate - step * (posterior @ residual), floor)
    return rate


def _totals(table: DataFrame, k: int, residuals: np.ndarray, step: float, floor: float = 0.0, squares: bool = False) -> np.ndarray:
    """Expected tokens by domain at the rates so far; or the Gram matrix of the posteriors, by tokens."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k if squares else k)
        for batch in batches:
            tokens, p = _matrix(batch, k)
            total += ((p * tokens[:, None]).T @ p).ravel() if squares else (tokens * replay(p, residuals, step, _rate(batch), floor)) @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "total"])

    found = table.drop("doc_id").mapInArrow(rows, "at long, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(k * k if squares else k)
    for r in found:
        out[r["at"]] = r["total"]
    return out


def tempered(natural: np.ndarray, power: float = TEMPER) -> np.ndarray:
    """Token targets with shares of ``natural ** power``, so large that every domain grows by LIFT at least."""
    share = np.where(natural > 0, np.maximum(natural, 1e-300) ** power, 0.0)
    if not share.sum():
        return natural
    share = share / share.sum()
    return share * np.max(natural[share > 0] / share[share > 0]) * (1 + LIFT)


def fit_rates(table: DataFrame, domains: list[str], weights: dict[str, float] | None = None, total: float | None = None, floor: float = 0.0) -> Fit:
    """Fit rates on a staged table of posteriors.  ``weights`` are target shares by domain, of ``total``
    expected tokens (the natural total if not given) less those of domains that ``weights`` doesn't name, which keep
    their tokens; without ``weights`` the targets are tempered.  No rate is fitted under ``floor``: 0, or 1 to keep every document."""
    k = len(domains)
    nothing = np.zeros((0, k))
    natural = _totals(table, k, nothing, 0.0)
    if weights is None:
        targets = tempered(natural)
    else:
        share, named = np.array([weights.get(d, 0.0) for d in domains], float), np.array([d in weights for d in domains])
        rest = max((natural.sum() if total is None else total) - natural[~named].sum(), 0.0)
        targets = np.where(named, share / max(share.sum(), 1e-300) * rest, natural)
    gram = _totals(table, k, nothing, 0.0, squares=True).reshape(k, k)
    # gaps are weighed by the inverse of the Gram matrix: without a rate at its floor one step of 1 closes them all,
    # and domains that documents don't tell apart take no part in their difference
    weigh, step = np.linalg.pinv(gram, rcond=1e-9, hermitian=True), 1.0
    steps, reached, since, left = [], natural, 0, np.inf
    while TOLERANCE * max(targets.sum(), 1e-12) < (gap := np.abs(reached - targets).sum()) <= STALL * left:
        left = gap
        steps.append(weigh @ (reached - targets))
        if len(steps) - since > KEEP:
            before, table = table, _with_rates(table, k, np.array(steps[since:-1]), step, floor)
            if since:
                drop_staged(before)
            since = len(steps) - 1
        reached = _totals(table, k, np.array(steps[since:]), step, floor)
    return Fit(domains, targets, natural, reached, step, np.array(steps).reshape(-1, k), floor)


def _rate_batches(fit: Fit) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, p = _matrix(batch, len(fit.domains))
                rate = np.round(replay(p, fit.residuals, fit.step, floor=fit.floor), 9)
                best = np.array(fit.domains, object)[p.argmax(axis=1)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(rate)], names=[*batch.schema.names, "domain", "rate"])

    return rows


def rates(docs: DataFrame, model: Classifier, weights: dict[str, float] | None = None, total: float | None = None, floor: float = 0.0) -> tuple[DataFrame, Fit]:
    """(doc_id, n_tokens, posterior, domain, rate) of each row of ``docs``, and the fit."""
    table = stage(posteriors(docs, model), "posteriors")
    fit = fit_rates(table, model.domains, weights, total, floor)
    return table.mapInArrow(_rate_batches(fit), POSTERIOR_SCHEMA + ", domain string, rate double"), fit


def with_copies(rated: DataFrame) -> DataFrame:
    """``rated`` with a column ``copies``: the rate's whole part, and one more with the chance of the rest, by a hash of doc_id."""
    lot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor("rate") + (lot < F.col("rate") - F.floor("rate")).cast("long")
    return rated.withColumn("copies", copies.cast("long"))


def mix(docs: DataFrame, model: Classifier, weights: dict[str, float] | None = None, total: float | None = None, floor: float = 0.0) -> DataFrame:
    """``docs`` with each row as often as its rate says; the same columns.

    The rates are computed where the texts are read, from the fitted residual vectors: texts never move."""
    with scope():
        fit = fit_rates(stage(posteriors(docs, model), "posteriors"), model.domains, weights, total, floor)
    names = docs.columns
    kept = [f"c{i}" for i in range(len(names))]  # the rows' own names may be any

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _posterior_batches(model)
        for batch in by_size(batches, SLICE):
            ids = batch.schema.get_field_index("doc_id")
            texts = batch.schema.get_field_index("text")
            scored = _scored(score, batch.column(ids), batch.column(texts))
            _, p = _matrix(scored, len(fit.domains))
            rate = np.round(replay(p, fit.residuals, fit.step, floor=fit.floor), 9)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], names=[*kept, "rate"])

    fields = [StructField(c, f.dataType, f.nullable) for c, f in zip(kept, docs.schema.fields, strict=True)]
    key = F.col(kept[names.index("doc_id")])
    lot = F.pmod(F.xxhash64(key, F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)
    whole = F.floor("rate")
    copies = (whole + (lot < F.col("rate") - whole).cast("long")).cast("int")
    repeated = docs.mapInArrow(rows, StructType([*fields, StructField("rate", DoubleType())])).withColumn("copy", F.explode(F.array_repeat(F.lit(0), copies)))
    return repeated.select(*(F.col(c).alias(name) for c, name in zip(kept, names, strict=True)))


def _scored(score: Callable, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    parts = list(score(iter([pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"])])))
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
