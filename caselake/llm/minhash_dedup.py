"""Operator 7, MinHash near-dedup with sequential Bayesian verification.

A document's set holds its distinct shingles of five lower-cased words (the whole sequence when
there are fewer).  Documents with equal word sequences (by a 128-bit digest) form a class first; the
smallest id stands for it.  Signatures of HASHES minima are banded; documents that share a band are candidates.
Candidate signatures are compared batch by batch: a pair is dropped once the posterior probability
that its likeness reaches the threshold falls under MISS.  Survivors are verified on their full
shingle sets, word by word, and verified links give components.

Candidates come in two rounds.  First every member of a bucket is compared with the bucket's
smallest and largest member, and each document's best survivor is verified; most groups, however
large, fall together here with a linear number of pairs.  Then buckets whose members still lie in
different components are dealt by component: members of the bucket's largest component need comparing
with the others only, never with each other.  They are cut into blocks, each of which meets each block of the
others, and those meet one another (BLOCK members a side).  So a component of n members and m others give
n * ceil(m / BLOCK) + m * (ceil(n / BLOCK) + ceil(m / BLOCK)) rows: in proportion to n while m is up to
BLOCK.  Members with survivors in other components come with their texts; each block verifies its pairs itself, likeliest
first, and returns only links that join components, fewer than it has members.  So no pair that shares a
band and may join two components is left out.  A pair at the threshold shares no band with probability
(1 - 0.75**4)**32, about 5 in a million.

Defined results: a null or wordless text has an empty set and links with nothing; a null id links
with nothing, has a null component and is kept; rows of one doc_id are one node, linked
through any of them, and come out row by row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .common import buffer_of, by_size, drop_staged, scope, slices, stage, text_column
from .components import connected_components

WIDTH = 5
THRESHOLD = 75  # per cent
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
BATCH = 16
MISS = 1e-6
BLOCK = 256
SLICE = 1 << 18

_rng = np.random.default_rng(20240607)
_FACTORS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_PLACES = [np.uint64(int(x) * 2 + 1) for x in _rng.integers(0, 2**62, WIDTH)]

SIGNED_SCHEMA = "doc_id long, n_shingles long, k1 long, k2 long, sig binary"


@dataclass
class Shingles:
    """The shingles of texts laid end to end, by text."""

    hashes: np.ndarray
    text: np.ndarray
    first: np.ndarray  # number of the shingle's first word
    size: np.ndarray  # words in it
    words: B.Words
    spans: B.SpanHash

    def exact(self, owner: np.ndarray) -> np.ndarray:
        """Keys that are equal where the shingles hold the same words and their ``owner`` is the same, and only there."""
        starts, ends = self.words.starts, self.words.ends
        word = B.exact(self.spans(starts, ends), lambda i, j: self.spans.same(starts, ends, i, j))

        def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = (owner[i] == owner[j]) & (self.size[i] == self.size[j])
            for k in range(WIDTH):
                at = np.minimum(k, self.size[i] - 1), np.minimum(k, self.size[j] - 1)
                out &= word[self.first[i] + at[0]] == word[self.first[j] + at[1]]
            return out

        return B.exact(B.mix(self.hashes ^ B.mix(owner.astype(np.uint64) + np.uint64(1))), same)


def shingles(data: np.ndarray, offsets: np.ndarray) -> Shingles:
    data = B.LOWER[data]
    words = B.Words(data, offsets)
    spans = B.SpanHash(data)
    h = spans(words.starts, words.ends)
    inside = np.flatnonzero(words.text[WIDTH - 1 :] == words.text[: len(words.text) - WIDTH + 1]) if len(h) >= WIDTH else np.zeros(0, np.int64)
    full = np.zeros(len(inside), np.uint64)
    for k in range(WIDTH):
        full += h[inside + k] * _PLACES[k]
    few = np.flatnonzero((words.counts > 0) & (words.counts < WIDTH))
    short = words.counts[few].astype(np.uint64) << np.uint64(58)
    for k in range(WIDTH - 1):
        has = words.counts[few] > k
        short[has] += h[words.bounds[few[has]] + k] * _PLACES[k]
    text = np.concatenate([words.text[inside], few])
    order = np.argsort(text, kind="stable")
    first = np.concatenate([inside, words.bounds[few]])[order]
    size = np.concatenate([np.full(len(inside), WIDTH), words.counts[few]])[order]
    return Shingles(B.mix(np.concatenate([full, short]))[order], text[order], first, size, words, spans)


def signatures(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """n x HASHES 32-bit minima; texts without shingles have no meaningful row."""
    out = np.full((n, HASHES), 0xFFFFFFFF, np.uint32)
    if len(hashes):
        starts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        owner = text[starts]
        for k in range(HASHES):
            out[owner, k] = (np.minimum.reduceat(hashes * _FACTORS[k] + _ADDENDS[k], starts) >> np.uint64(32)).astype(np.uint32)
    return out


def sequence_keys(data: np.ndarray, offsets: np.ndarray, words: B.Words) -> np.ndarray:
    """128 bits (two numbers) of each text's lower-cased word sequence, from its digest."""
    kept = words.solid.copy()
    kept[words.starts[np.flatnonzero(words.text[1:] == words.text[:-1]) + 1] - 1] = True  # one space between words
    plain = np.where(words.solid, B.LOWER[data], 0x20).astype(np.uint8)[kept].tobytes()
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kept, out=before[1:])
    at = before[offsets]
    view = memoryview(plain)
    return np.frombuffer(b"".join(hashlib.blake2b(view[s:e], digest_size=16).digest() for s, e in zip(at[:-1], at[1:], strict=True)), "<i8").reshape(-1, 2)


def _sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, SLICE):
        n = batch.num_rows
        data, offsets = buffer_of(text_column(batch))
        found = shingles(data, offsets)
        _, later = B.repeated(found.exact(found.text))
        size = np.bincount(found.text[~later], minlength=n).astype(np.int64)
        sig = signatures(found.hashes, found.text, n).astype(">u4")
        packed = [sig[i].tobytes() if size[i] else None for i in range(n)]
        keys = sequence_keys(data, offsets, found.words)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(size), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array(packed, pa.binary())],
            names=["doc_id", "n_shingles", "k1", "k2", "sig"],
        )


def least_matches() -> np.ndarray:
    """For each number of compared hashes, the matches below which P(likeness >= threshold) < MISS (uniform prior)."""
    t = THRESHOLD / 100
    bounds = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1  # P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m)
        while total < MISS:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        bounds.append(m)
    return np.array(bounds)


_LEAST = least_matches()


def sequential(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(surviving pairs, their matches): signatures compared batch by batch."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for step, least in enumerate(_LEAST):
        at = slice(step * BATCH, (step + 1) * BATCH)
        matches[alive] += np.count_nonzero(left[alive, at] == right[alive, at], axis=1)
        alive = alive[matches[alive] >= least]
    return alive, matches[alive]


def _sig_matrix(column: pa.Array) -> np.ndarray:
    data, _ = buffer_of(column)
    return data.view(">u4").reshape(-1, HASHES)


def _prune_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            alive, matches = sequential(_sig_matrix(batch.column(2)), _sig_matrix(batch.column(3)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(alive)), batch.column(1).take(pa.array(alive)), pa.array(matches)], names=["a", "b", "matches"])


def linked(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Which pairs of texts reach the threshold, on their full sets."""
    n = len(left)
    order = pa.array(np.arange(2 * n).reshape(2, n).T.ravel())
    found = shingles(*buffer_of(pa.concat_arrays([left, right]).take(order)))  # texts 2i and 2i + 1 are a pair
    keys = found.exact(found.text // 2)
    order = np.lexsort((found.text, keys))
    keys, text = keys[order], found.text[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]))[: len(keys)]
    keys, text = keys[new], text[new]
    size = np.bincount(text, minlength=2 * n).reshape(n, 2).sum(axis=1)
    shared = np.bincount(text[1:][keys[1:] == keys[:-1]] // 2, minlength=n)
    return (size > shared) & (100 * shared >= THRESHOLD * (size - shared))


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, SLICE, "right"):
        kept = pa.array(np.flatnonzero(linked(text_column(batch, "left"), text_column(batch, "right"))))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], names=["a", "b"])


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Links among ``pairs`` (a, b), confirmed on full sets.

    The texts move once, by a merge join at every size; the pairs then meet the few that they name."""
    named = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = stage(docs.select("doc_id", "text").join(named.hint("merge"), "doc_id", "left_semi"), "texts")
    rows = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left")), "a")
    rows = rows.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right")), "b")
    return rows.select("a", "b", "left", "right").mapInArrow(_verify_batches, "a long, b long").distinct()


def _by_block(compare):
    """A map over rows sorted by (key, lo, hi) that hands whole blocks to ``compare(table, bounds)``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            group = np.stack([table[c].to_numpy() for c in ("key", "lo", "hi")])
            cuts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            if len(cuts):
                done = int(cuts[-1])
                yield from compare(table.slice(0, done), np.concatenate([[0], cuts]))
                held = table.slice(done).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from compare(table, np.array([0, table.num_rows]))

    return rows


def _survivors(table: pa.Table, bounds: np.ndarray, sig: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, matches) of each block: row pairs across components that share this band first and aren't pruned."""
    lo, hi, block, band, comp = (table[c].to_numpy() for c in ("lo", "hi", "block", "band", "comp"))
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        if e - s < 2:
            continue
        if lo[s] == hi[s]:
            x, y = np.triu_indices(e - s, 1)
            x, y = x + s, y + s
        else:
            first, second = np.flatnonzero(block[s:e] == lo[s]) + s, np.flatnonzero(block[s:e] == hi[s]) + s
            x, y = np.repeat(first, len(second)), np.tile(second, len(first))
        other = comp[x] != comp[y]
        x, y = x[other], y[other]
        found = [], [], []
        for part in range(0, len(x), 1 << 14):
            u, v = x[part : part + (1 << 14)], y[part : part + (1 << 14)]
            agree = (sig[u] == sig[v]).reshape(len(u), BANDS, ROWS).all(axis=2)
            own = agree.argmax(axis=1) == band[u]  # a pair counts in the first band that it shares
            u, v = u[own], v[own]
            alive, matches = sequential(sig[u], sig[v])
            for out, values in zip(found, (u[alive], v[alive], matches), strict=True):
                out.append(values)
        if found[0] and sum(map(len, found[0])):
            yield tuple(np.concatenate(f) for f in found)


class _Forest:
    """Components joined so far within one block."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, c: int) -> int:
        while (p := self.parent.get(c, c)) != c:
            self.parent[c] = self.parent.get(p, p)
            c = p
        return c

    def join(self, c: int, d: int) -> None:
        self.parent[self.root(c)] = self.root(d)


def _open_members(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of each block that have a survivor in another component."""
    found = [np.union1d(x, y) for x, y, _ in _survivors(table, bounds, _sig_matrix(pa.concat_arrays(table["sig"].chunks)))]
    if found:
        rows = table.take(pa.array(np.concatenate(found))).drop_columns(["sig"]).combine_chunks()
        yield from rows.to_batches()


def _distinct_sets(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """(sorted distinct shingle hashes of each text, signatures), by slices."""
    sets: list[np.ndarray] = []
    sigs = [np.zeros((0, HASHES), np.uint32)]
    for batch in slices(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), SLICE):
        found = shingles(*buffer_of(text_column(batch)))
        cuts = np.searchsorted(found.text, np.arange(batch.num_rows + 1))
        sets += [np.unique(found.hashes[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        sigs.append(signatures(found.hashes, found.text, batch.num_rows))
    return sets, np.concatenate(sigs)


def _exact_links(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links between components in each block, verified on the members' full sets; (a, b) are components."""
    comp = table["comp"].to_numpy()
    out: list[tuple[int, int]] = []
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        part = table.slice(int(s), int(e - s)).combine_chunks()
        n = part.num_rows
        texts = pa.concat_arrays(part["text"].chunks)
        sets, sig = _distinct_sets(texts)
        for x, y, matches in _survivors(part, np.array([0, n]), sig):
            forest = _Forest()
            order = np.argsort(-matches, kind="stable")
            for u, v in zip(x[order].tolist(), y[order].tolist(), strict=True):
                c, d = comp[s + u], comp[s + v]
                if forest.root(c) == forest.root(d):
                    continue
                shared = len(sets[u]) + len(sets[v]) - len(np.union1d(sets[u], sets[v]))
                if 100 * shared >= THRESHOLD * (len(sets[u]) + len(sets[v]) - shared) and linked(texts.slice(u, 1), texts.slice(v, 1))[0]:
                    forest.join(c, d)
                    out.append((min(c, d), max(c, d)))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])


_PLACE = ("key", "lo", "hi", "block", "band", "rep", "comp")


def _mixed_blocks(members: DataFrame, comps: DataFrame, signed: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, dealt to pairs of blocks by component."""
    placed = members.join(comps, members["rep"] == comps["node"], "left").select("key", "band", "rep", F.coalesce("component", "rep").alias("comp"))
    placed = stage(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    held = stage(placed.join(stage(mixed, "mixed"), "key"), "held")
    drop_staged(placed)
    sizes = held.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    split = stage(sizes.select("key", "major", blocks(F.col("most")).alias("wide"), blocks(F.col("n") - F.col("most")).alias("narrow")), "split")
    lot, others = F.xxhash64("rep"), F.sequence(F.lit(0), F.col("narrow") - 1)
    is_major = F.col("comp") == F.col("major")
    block = F.when(is_major, -1 - F.pmod(lot, "wide")).otherwise(F.pmod(lot, "narrow")).cast("int")
    majors = F.transform(F.sequence(F.lit(0), F.col("wide") - 1), lambda i: -1 - i)
    return (
        held.join(split, "key")
        .join(signed, "rep")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.when(is_major, others).otherwise(F.concat(others, majors))))
        .select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "band", "rep", "comp", "sig")
    )


def _last_links(members: DataFrame, comps: DataFrame, signed: DataFrame, docs: DataFrame) -> DataFrame:
    """Verified links among what is still open, block by block."""
    kinds = "key long, lo int, hi int, block int, band int, rep long, comp long"
    dealt = _mixed_blocks(members, comps, signed).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    left = stage(dealt.mapInArrow(_by_block(_open_members), kinds), "open")
    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    rows = left.hint("merge").join(texts, "rep").select(*_PLACE, "text").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return rows.mapInArrow(_by_block(_exact_links), "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text)."""
    with scope() as tables:
        rows, comps, more = _components(docs)
        tables.keep(rows, comps, more)
    more = more.select(F.col("node").alias("rep1"), F.col("component").alias("last"))
    placed = rows.join(comps, rows["rep"] == comps["node"], "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("rep1"))
    out = placed.join(more, "rep1", "left").select("doc_id", "n_shingles", F.coalesce("last", "rep1").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _components(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with their class's representative, components of the first round, components of those)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = stage(docs.mapInArrow(_sign_batches, SIGNED_SCHEMA), "signed")
    filled = first.where("n_shingles > 0 and doc_id is not null")
    classes = stage(filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n"), "classes")
    keyed = first.join(classes, ["k1", "k2"], "left").withColumn("rep", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")))
    rows = stage(keyed.select("doc_id", "n_shingles", "rep", F.when(F.col("doc_id") == F.col("rep"), F.col("sig")).alias("sig")), "rows")
    drop_staged(first)

    signed = rows.where("sig is not null").select("rep", "sig")
    band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("sig", i * (4 * ROWS) + 1, F.lit(4 * ROWS)))))
    banded = signed.select("rep", band.alias("band", "key"))
    shared = stage(banded.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most"), "shared")
    members = stage(banded.join(shared, "key").select("key", "band", "rep", "least", "most"), "members")

    stars = members.where("rep > least").select(F.col("least").alias("a"), F.col("rep").alias("b"))
    stars = stars.unionAll(members.where("rep > least and rep < most").select(F.col("rep").alias("a"), F.col("most").alias("b"))).distinct()
    sides = stars.join(signed.select(F.col("rep").alias("a"), F.col("sig").alias("left")), "a").join(signed.select(F.col("rep").alias("b"), F.col("sig").alias("right")), "b")
    likely = sides.select("a", "b", "left", "right").mapInArrow(_prune_batches, "a long, b long, matches long")
    best = likely.groupBy("b").agg(F.max(F.struct("matches", (-F.col("a")).alias("minus"))).alias("top")).select((-F.col("top.minus")).alias("a"), "b")
    links = stage(_verified(stage(best, "pairs"), docs), "verified")
    comps = connected_components(links)
    return rows, comps, connected_components(_last_links(members, comps, signed, docs))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that an earlier one stands for, with all their columns.

    Of rows with one doc_id and one text one stays; rows with one doc_id and different texts are judged each by its own text, in the order of the texts."""
    with scope() as tables:
        again = stage(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select("doc_id"), "again")
        if again.isEmpty():
            gone = stage(near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct(), "gone")
            tables.keep(gone)
            return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
        names = docs.columns
        one = docs.join(again, "doc_id", "left_semi").select(*names).dropDuplicates(["doc_id", "text"])
        docs = stage(docs.join(again, "doc_id", "left_anti").select(*names).unionByName(one), "single")
        ordered = docs.where("doc_id is not null").select("doc_id", "text").orderBy("doc_id", "text")
        nodes = stage(ordered.select("doc_id", F.sha2("text", 256).alias("digest"), "text", F.monotonically_increasing_id().alias("node")), "nodes")
        verdict = near_duplicates(nodes.select(F.col("node").alias("doc_id"), "text")).where(~F.col("kept")).select(F.col("doc_id").alias("node"))
        gone = stage(nodes.select("doc_id", "digest", "node").join(verdict, "node").select("doc_id", "digest"), "gone")
        tables.keep(docs, gone)
        return docs.join(gone, (docs["doc_id"] == gone["doc_id"]) & (F.sha2(docs["text"], 256) == gone["digest"]), "left_anti").select(*names)
