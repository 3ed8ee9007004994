"""Operator 6, toxicity: a convolutional text classifier trained in numpy.

Words (lower-cased runs of letters) are hashed three ways: twice as a whole word and once by
their first letters; the sum of the three embeddings is the word's vector.  Filters of
several widths slide over the words of the whole text, each keeps its largest response,
and a logistic layer scores those.  A threshold for each language (predicted from the text by
operator 9) is subtracted from the logit, so 0.5 is the calibrated cut in each language.

Training goes over every labelled row.  Rows are dealt to groups of about GROUP_BYTES of text by a
hash of doc_id; a group's hashed words lie in one row of a staged table.  The descent starts in one group,
on rows with START_WORDS words at most, half for each label, and then takes ROUNDS rounds: in each, every
group goes through all its rows from the common network, and the networks are averaged, an embedding over the groups that moved
it.  Sums are of integers, so results don't depend on partitioning.  A fifth of each group's rows, dealt by language and label, isn't
trained on; all these rows set the thresholds, on logits in steps of 1 / LOGIT_STEPS.  Each language's threshold
has the least error on its own rows and on those of all languages, which together count as much as
PULL rows of the rarer label; a language without any spare row has the pooled threshold.  The model's size is bounded by the
numbers of buckets, whatever the input; only embeddings that training moved are kept and sent out.  The language of a text is
predicted from its words and their first letters, with frequencies counted over every labelled row that has a ``lang``; a score
never reads the column.

Defined results: null and empty texts score as a text without words (all responses at their
bias); a null id is never learned from and counts as not held out; without labels of both
kinds the score is 0.0 everywhere (0.5 or more would call rows toxic that nothing speaks
against); repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from . import bytesops as B
from .common import buffer_of, by_size, give_back, meet, scope, stage, text_column

GROUP_BYTES = 8 << 20
MEET_ROWS = 1 << 20  # labelled ids that are sent to the texts; if more, both are shuffled
START_WORDS = 1_000_000
ROUNDS = 2
LOGIT_STEPS = 1024
BUCKETS = 1 << 18
TONGUE_BUCKETS = 1 << 16
REACH = 6.0  # largest difference in log frequency that one word can make
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
STEM = 4  # letters in a word's stem
EPOCHS, BATCH, RATE = 5, 32, 0.1
LEAST_STEPS = 800  # small samples are gone through more often
PULL = 5
SLICE = 1 << 18
SCHEMA = "doc_id long, language string, score double"
_GROUP = "group int, words binary, counts array<int>, labels array<int>, langs array<string>"
_UNIT = float(1 << 36)  # parameters are summed as whole numbers of 1 / _UNIT

_HASH_SALTS = (0x51, 0xA3, 0x1F7)
_LEAD = max(WIDTHS) - 1  # windows may begin so far behind the last word
_PAD = 2 * _LEAD  # and then end before the next text


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(three bucket numbers by word, words by text)."""
    points, words = B.letter_words(data, offsets)
    spans = B.SpanHash(points)
    whole = spans(words.starts, words.ends)
    stem = spans(words.starts, np.minimum(words.ends, words.starts + STEM))
    picked = [B.mix(h + np.uint64(s)) % np.uint64(BUCKETS) + np.uint64(k * BUCKETS) for k, (h, s) in enumerate(zip((whole, whole, stem), _HASH_SALTS, strict=True))]
    return np.stack(picked, axis=1).astype(np.int64) if len(whole) else np.zeros((0, 3), np.int64), words.counts


@dataclass
class Network:
    buckets: np.ndarray  # sorted bucket numbers with an embedding; all others are 0
    embeddings: np.ndarray  # a row more than buckets: the last is 0
    filters: np.ndarray  # DIM x (sum of widths * FILTERS)
    bias: np.ndarray  # of each filter
    out: np.ndarray
    intercept: float
    moved: np.ndarray | None = None  # Adagrad's sums, by embedding
    sums: dict[str, np.ndarray] | None = None  # and of the other parameters

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        if not len(self.buckets):
            return np.zeros(buckets.shape, np.int64)
        at = np.minimum(np.searchsorted(self.buckets, buckets), len(self.buckets) - 1).astype(np.int32)
        return np.where(self.buckets[at] == buckets, at, np.int32(len(self.buckets)))


def _layout(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(place of each word, first place of each text, places): every text is followed by padding."""
    first = np.cumsum(counts + _PAD) - counts - _PAD
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(first, counts) + within, first, int((counts + _PAD).sum())


def _responses(net: Network, vectors: np.ndarray) -> list[np.ndarray]:
    """Filter responses at every place, by width; ``vectors`` ends with padding."""
    product = vectors @ net.filters
    out, column = [], 0
    for k, width in enumerate(WIDTHS):
        total = np.tile(net.bias[k * FILTERS : (k + 1) * FILTERS], (len(vectors), 1))
        for j in range(width):
            part = product[j:, column : column + FILTERS]
            total[: len(part)] += part
            column += FILTERS
        out.append(total)
    return out


def _vectors(net: Network, rows: np.ndarray, place: np.ndarray, places: int) -> np.ndarray:
    vectors = np.zeros((places, DIM), np.float32)
    e = net.embeddings
    vectors[place] = e[rows[:, 0]] + e[rows[:, 1]] + e[rows[:, 2]]
    return vectors


def logits(net: Network, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The logit of each text."""
    if not len(counts):
        return np.zeros(0)
    place, first, places = _layout(counts)
    found = _responses(net, _vectors(net, net.rows(buckets), place, places))
    spans = np.stack([first, first + counts + _LEAD], axis=1).ravel()
    pooled = np.hstack([np.maximum(np.maximum.reduceat(r, spans, axis=0)[::2], 0) for r in found])
    return (pooled @ net.out + net.intercept).astype(np.float64)


def _first_embeddings(buckets: np.ndarray) -> np.ndarray:
    """Small numbers that are the same for a bucket wherever it is met."""
    lots = B.mix(buckets.astype(np.uint64)[:, None] * np.uint64(DIM) + np.arange(DIM, dtype=np.uint64)) >> np.uint64(11)
    return ((lots.astype(np.float64) / (1 << 53) - 0.5) * 0.05 * 12**0.5).astype(np.float32)


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int | tuple[int, ...] = 7, start: Network | None = None, epochs: int | None = None) -> Network:
    """Fit by Adagrad, from ``start`` if given; gradients reach only the windows that won the pooling.

    The result has the embeddings that moved here."""
    rng = np.random.default_rng(seed)
    counts = np.array([len(t) for t in texts])
    buckets = np.unique(np.concatenate(texts)).astype(np.int64) if counts.sum() else np.zeros(0, np.int64)
    n_filters = len(WIDTHS) * FILTERS
    embeddings = np.vstack([_first_embeddings(buckets), np.zeros((1, DIM), np.float32)])
    moved = np.zeros(len(embeddings), np.float32)
    if start is None:
        net = Network(
            buckets,
            embeddings,
            rng.normal(0, 0.4, (DIM, sum(WIDTHS) * FILTERS)).astype(np.float32),
            np.full(n_filters, 0.05, np.float32),
            np.where(np.arange(n_filters) % 4 == 3, -0.5, 0.5).astype(np.float32),
            0.0,
        )
        sums = {k: np.full_like(getattr(net, k), 1e-6) for k in ("filters", "bias", "out")} | {"intercept": np.full(1, 1e-6, np.float32)}
    else:
        at = start.rows(buckets)
        known = np.flatnonzero(at < len(start.buckets))
        embeddings[known], moved[known] = start.embeddings[at[known]], start.moved[at[known]]
        net = replace(start, buckets=buckets, embeddings=embeddings)
        sums = {k: v.copy() for k, v in start.sums.items()}
    rows = [net.rows(t) for t in texts]
    shifted = np.zeros(len(embeddings), bool)

    def descend(name: str, gradient: np.ndarray) -> None:
        sums[name] += gradient**2
        setattr(net, name, (getattr(net, name) - RATE * gradient / np.sqrt(sums[name])).astype(np.float32))

    for _ in range(epochs or max(EPOCHS, LEAST_STEPS * BATCH // max(len(texts), 1) + 1)):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            pick = order[lo : lo + BATCH]
            c = counts[pick]
            flat = np.concatenate([rows[i] for i in pick])
            place, first, places = _layout(c)
            vectors = _vectors(net, flat, place, places)
            word_at = np.full(places + _PAD, -1)
            word_at[place] = np.arange(len(flat))
            found = _responses(net, vectors)
            ends = first + c + _LEAD
            top = np.stack([np.hstack([s + r[s:e].argmax(axis=0) for r in found]) for s, e in zip(first, ends, strict=True)])
            lane = np.tile(np.arange(FILTERS), len(WIDTHS))
            raw = np.hstack([r[top[:, k * FILTERS : (k + 1) * FILTERS], np.arange(FILTERS)] for k, r in enumerate(found)])
            pooled = np.maximum(raw, 0)
            error = (1 / (1 + np.exp(-(pooled @ net.out + net.intercept))) - labels[pick]) / len(pick)
            back = (error[:, None] * net.out) * (raw > 0)
            d_filters = np.zeros_like(net.filters)
            touched, pushes = [], []
            padded = np.vstack([vectors, np.zeros((_PAD, DIM), np.float32)])
            column = 0
            for k, width in enumerate(WIDTHS):
                at, g = top[:, k * FILTERS : (k + 1) * FILTERS], back[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(width):
                    w = net.filters[:, column : column + FILTERS]
                    d_filters[:, column : column + FILTERS] = np.einsum("nfd,nf->df", padded[at + j], g)
                    touched.append((at + j).ravel())
                    pushes.append((g[:, :, None] * w.T[None, :, :]).reshape(-1, DIM))
                    column += FILTERS
            descend("out", (pooled * error[:, None]).sum(axis=0))
            descend("bias", back.sum(axis=0))
            descend("filters", d_filters)
            sums["intercept"] += error.sum() ** 2
            net.intercept -= float(RATE * error.sum() / np.sqrt(sums["intercept"][0]))
            at, push = word_at[np.concatenate(touched)], np.concatenate(pushes)
            at, push = at[at >= 0], push[at >= 0]
            target = flat[at].ravel()
            hit, inverse = np.unique(target, return_inverse=True)
            gradient = np.zeros((len(hit), DIM))
            np.add.at(gradient, inverse, np.repeat(push, 3, axis=0))
            size = (gradient**2).sum(axis=1)
            live = size > 0
            moved[hit[live]] += size[live]
            shifted[hit[live]] = True
            net.embeddings[hit[live]] -= (RATE * gradient[live] / np.sqrt(moved[hit[live]] + 1e-8)[:, None]).astype(np.float32)
    keep = np.flatnonzero(shifted[:-1])
    return replace(net, buckets=net.buckets[keep], embeddings=np.vstack([net.embeddings[keep], np.zeros((1, DIM), np.float32)]), moved=moved[keep], sums=sums)


def best_cut(values: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The threshold with the least weighted error; the middle of the gap it lies in."""
    order = np.argsort(values)
    v, y, w = values[order], labels[order], weights[order]
    lost = np.concatenate([[0.0], np.cumsum(w * (y == 1))]) + np.concatenate([np.cumsum((w * (y == 0))[::-1])[::-1], [0.0]])
    edges = np.concatenate([[v[0] - 1], (v[1:] + v[:-1]) / 2, [v[-1] + 1]])
    best = np.flatnonzero(lost <= lost.min() + 1e-12)
    return float(edges[best[len(best) // 2]])


def spare_rows(names: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """A fifth of the rows of each language and label."""
    spare, met = np.zeros(len(labels), bool), {}
    for i, key in enumerate(zip(names.tolist(), labels.tolist(), strict=True)):
        met[key] = met.get(key, -1) + 1
        spare[i] = met[key] % 5 == 2
    return spare


def language_cuts(values: np.ndarray, labels: np.ndarray, weights: np.ndarray, names: np.ndarray) -> dict[str, float]:
    """The threshold of each language, drawn to the pooled one ("") as far as its rows are few."""
    rarer = min(weights[labels == k].sum() for k in (0, 1))
    if not rarer:
        return {"": 0.0}
    cuts = {"": best_cut(values, labels, weights)}
    for name in sorted(set(names.tolist())):
        cuts[name] = best_cut(values, labels, weights * ((names == name) + min(1.0, PULL / rarer)))
    return cuts


@dataclass
class Tongues:
    langs: list[str]
    weights: np.ndarray  # a row of centred log frequencies for each bucket of words, then of stems


@dataclass
class Classifier:
    network: Network | None
    languages: Tongues | None
    cuts: dict[str, float]


def _tongue_buckets(words: np.ndarray) -> np.ndarray:
    """Two rows of ``Tongues.weights`` for each word: its own and its stem's."""
    return words[:, [0, 2]].astype(np.int64) % TONGUE_BUCKETS + np.array([0, TONGUE_BUCKETS])


def _languages(model: Tongues, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not model.langs:
        return np.full(len(counts), "und", object)
    total = np.zeros((len(words) + 1, len(model.langs)))
    np.cumsum(model.weights[_tongue_buckets(words)].sum(axis=1), axis=0, out=total[1:])
    ends = np.cumsum(counts)
    return np.where(counts > 0, np.array(model.langs, object)[(total[ends] - total[ends - counts]).argmax(axis=1)], "und")


def within_words(rows: list, most: int = START_WORDS) -> list[tuple[int, int]]:
    """For labels 0 and 1, the range of lots from the least on whose rows (doc_id, label, lot, n) hold half of ``most`` words at most."""
    out = []
    for label in (0, 1):
        own = sorted((r.lot, r.n) for r in rows if r.label == label)
        held = np.searchsorted(np.cumsum([n for _, n in own]), most / 2, side="right") if own else 0
        out.append((own[0][0], own[held - 1][0]) if held else (0, -1))
    return out


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as hashed words: a word's three buckets in 64 bits."""
    for batch in by_size(batches, SLICE):
        words, counts = hashed_words(*buffer_of(text_column(batch)))
        packed = (words % BUCKETS << np.array([0, 20, 40])).sum(axis=1)
        ends = np.cumsum(counts)
        column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays(
            [column("group"), column("doc_id"), column("label"), column("lang"), pa.array([packed[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)], pa.binary())],
            names=["group", "doc_id", "label", "lang", "words"],
        )


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each group of rows that are sorted by group."""

    def bundled(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        words = table["words"].to_pylist()
        lists = [pa.array([x], kind) for x, kind in (([len(w) // 8 for w in words], pa.list_(pa.int32())), (table["label"].to_pylist(), pa.list_(pa.int32())), (table["lang"].to_pylist(), pa.list_(pa.string())))]
        return pa.RecordBatch.from_arrays([pa.array([table["group"][0].as_py()], pa.int32()), pa.array([b"".join(words)], pa.binary()), *lists], names=["group", "words", "counts", "labels", "langs"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        group = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                if held and held[0].column(0)[0].as_py() != group[lo]:
                    yield bundled(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield bundled(held)
    give_back()


@dataclass
class Group:
    number: int
    words: np.ndarray
    counts: np.ndarray
    labels: np.ndarray
    langs: list[str | None]

    def texts(self, which: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum(self.counts)
        return [self.words[ends[i] - self.counts[i] : ends[i]] for i in np.flatnonzero(which)]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Group]:
    for batch in batches:
        for i in range(batch.num_rows):
            number, words, counts, labels, langs = (column[i] for column in batch.columns)
            packed = np.frombuffer(words.as_buffer(), np.int64)
            spread = np.stack([(packed >> 20 * k & (1 << 20) - 1) + k * BUCKETS for k in range(3)], axis=1).astype(np.int32)
            yield Group(number.as_py(), spread, counts.values.to_numpy(), labels.values.to_numpy().astype(float), langs.as_py())
    give_back()


def _tongue_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches):
        owner = np.repeat(np.array([x or "" for x in group.langs], object), group.counts)
        for lang in sorted({x for x in group.langs if x}):
            at, n = np.unique(_tongue_buckets(group.words[owner == lang]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n)], names=["lang", "bucket", "n"])


def _tongues(groups: DataFrame) -> Tongues:
    """Frequencies of words and stems by language, over all rows with a language."""
    table = groups.mapInArrow(_tongue_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(table["lang"].to_pylist(), object)
    langs = sorted(set(names.tolist()))
    seen = np.zeros((2, TONGUE_BUCKETS, max(len(langs), 1)))
    for k, lang in enumerate(langs):
        own = names == lang
        seen.reshape(2 * TONGUE_BUCKETS, -1)[table["bucket"].to_numpy()[own], k] = table["n"].to_numpy()[own]
    kinds = np.maximum(seen.any(axis=2).sum(axis=1), 1)
    logs = np.log((seen + 0.5) / (seen.sum(axis=1) + 0.5 * kinds[:, None])[:, None, :])
    logs[~seen.any(axis=2)] = 0  # a bucket never met speaks for no language
    return Tongues(langs, np.clip(logs - logs.mean(axis=2, keepdims=True), -REACH, REACH).reshape(2 * TONGUE_BUCKETS, -1).astype(np.float32))


_DENSE = ("filters", "bias", "out")
_VALUES = [f"v{k}" for k in range(DIM)]
_PARAMETERS = "key int, moved long, " + ", ".join(f"{v} long" for v in _VALUES)


def _parameters(net: Network) -> pa.RecordBatch:
    """A network as rows of DIM whole numbers: embeddings by bucket, all else and its sums under keys from -1 down."""
    dense = np.concatenate([x for own in ({k: getattr(net, k) for k in _DENSE} | {"intercept": np.array([net.intercept])}, net.sums) for x in (*(own[k].ravel() for k in _DENSE), own["intercept"])])
    dense = np.pad(dense, (0, -len(dense) % DIM)).reshape(-1, DIM)
    whole = lambda x: np.rint(x.astype(np.float64) * _UNIT).astype(np.int64)
    keys = np.concatenate([-1 - np.arange(len(dense)), net.buckets]).astype(np.int32)
    values = whole(np.vstack([dense, net.embeddings[:-1]]))
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(whole(np.concatenate([np.zeros(len(dense)), net.moved]))), *(pa.array(v.copy()) for v in values.T)], names=["key", "moved", *_VALUES])


def _descend(net: Network | None, spoken: Tongues, turn: int) -> Callable:
    """Each group's network after one pass over its rows, or, without one to begin with, trained on some of them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            own = ~spare_rows(_languages(spoken, group.words, group.counts), group.labels)
            if net is None:
                chosen = within_words([Row(label=int(y), lot=i, n=int(n)) for i, (y, n) in enumerate(zip(group.labels, group.counts, strict=True)) if own[i]])
                lot = np.arange(len(own))
                own &= np.logical_or.reduce([(group.labels == k) & (lot >= lo) & (lot <= hi) for k, (lo, hi) in enumerate(chosen)])
            if own.any():
                yield _parameters(train(group.texts(own), group.labels[own], (7, turn, group.number), net, net and 1))

    return rows


def _averaged(parts: DataFrame, before: Network | None) -> Network | None:
    """The mean of the groups' networks; an embedding counts where it moved, and stays what it was where it moved nowhere."""
    mean = lambda c: (F.sum(c) / (F.count("*") * F.lit(_UNIT))).cast("float").alias(c)
    table = parts.groupBy("key").agg(*(mean(c) for c in ("moved", *_VALUES))).toArrow().sort_by([("key", "descending")])
    if not table.num_rows:
        return before
    keys, values, moved = table["key"].to_numpy(), np.stack([table[v].to_numpy() for v in _VALUES], axis=1), table["moved"].to_numpy()
    flat, n = values[keys < 0].ravel(), len(WIDTHS) * FILTERS
    sizes = [DIM * sum(WIDTHS) * FILTERS, n, n, 1] * 2
    parts_of = np.split(flat[: sum(sizes)], np.cumsum(sizes)[:-1])
    shape = lambda x: x.reshape(DIM, -1)
    buckets, embeddings, moved = keys[keys >= 0][::-1].astype(np.int64), values[keys >= 0][::-1], moved[keys >= 0][::-1]
    if before is not None:
        old = ~np.isin(before.buckets, buckets)
        buckets, embeddings, moved = np.append(buckets, before.buckets[old]), np.vstack([embeddings, before.embeddings[:-1][old]]), np.append(moved, before.moved[old])
        order = np.argsort(buckets)
        buckets, embeddings, moved = buckets[order], embeddings[order], moved[order]
    sums = dict(zip((*_DENSE, "intercept"), (shape(parts_of[4]), *parts_of[5:]), strict=True))
    return Network(buckets, np.vstack([embeddings, np.zeros((1, DIM), np.float32)]), shape(parts_of[0]), parts_of[1], parts_of[2], float(parts_of[3][0]), moved, sums)


def _spare_logits(net: Network, spoken: Tongues) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            names = _languages(spoken, group.words, group.counts)
            spare = spare_rows(names, group.labels)
            values = np.concatenate([np.zeros(0), *(logits(net, t, np.array([len(t)])) for t in group.texts(spare))])
            steps = np.floor(np.clip(values, -50, 50) * LOGIT_STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(names[spare], pa.string()), pa.array(group.labels[spare].astype(np.int32)), pa.array(steps)], names=["language", "label", "step"])

    return rows


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn from all rows of ``labels`` (doc_id, label 0 or 1) and their texts and languages in ``docs``."""
    nothing = Classifier(None, None, {})
    with scope():
        known = labels.select("doc_id", "label").dropna().dropDuplicates(["doc_id"])
        rows = meet(docs.select("doc_id", "text", "lang"), known, MEET_ROWS)
        sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n")).collect()}
        if not {0, 1} <= set(sizes):
            return nothing
        n = max(1, ceil(sum(sizes.values()) / GROUP_BYTES))
        hashed = rows.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")).mapInArrow(_hash_batches, "group int, doc_id long, label int, lang string, words binary")
        groups = stage(hashed.repartition(n, "group").sortWithinPartitions("group", "doc_id", "words").mapInArrow(_bundle, _GROUP), "groups")
        spoken = _tongues(groups)
        first = groups.agg(F.min("group")).first()[0]
        net = _averaged(groups.where(F.col("group") == first).mapInArrow(_descend(None, spoken, 0), _PARAMETERS), None)
        for turn in range(ROUNDS if net else 0):
            net = _averaged(groups.mapInArrow(_descend(net, spoken, turn + 1), _PARAMETERS), net)
        if net is None:
            return nothing
        net = replace(net, moved=None, sums=None)
        table = groups.mapInArrow(_spare_logits(net, spoken), "language string, label int, step int").groupBy("language", "label", "step").agg(F.count("*").alias("n")).toArrow()
    values, marks, names = (table["step"].to_numpy() + 0.5) / LOGIT_STEPS, table["label"].to_numpy(), np.array(table["language"].to_pylist(), object)
    return Classifier(net, spoken, language_cuts(values, marks, table["n"].to_numpy().astype(float), names))


def _score_batch(model: Classifier, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) of each row."""
    if model.network is None:
        return np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
    words, counts = hashed_words(*buffer_of(text_column(batch)))
    names = _languages(model.languages, words, counts)
    cut = np.array([model.cuts.get(x, model.cuts[""]) for x in names])
    return names, 1 / (1 + np.exp(-np.clip(logits(model.network, words, counts) - cut, -50, 50)))


def scorer(model: Classifier) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, SLICE):
            names, score = _score_batch(model, batch)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "language", "score"])

    return rows


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, language, score) of each row of ``docs``; no exchange."""
    return docs.select("doc_id", "text").mapInArrow(scorer(model), SCHEMA)


def keep_clean(docs: DataFrame, model: Classifier) -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with all their columns; no exchange."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, SLICE):
            yield batch.filter(pa.array(_score_batch(model, batch)[1] < 0.5))

    return docs.mapInArrow(rows, docs.schema)
