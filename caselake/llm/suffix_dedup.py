"""Operator 8, suffix-array dedup: every byte covered by a 100-byte string that also starts earlier goes.

1. Candidate search.  Each 100-byte window has a minimiser: the smallest hash of its GRAM-byte
   substrings, so equal windows have equal minimisers.  Minimisers found in one text only can't
   belong to a repeat; counting them (partial sums before the shuffle) leaves the regions worth
   sorting.  Nothing is lost: a window that repeats has a minimiser that repeats.
2. Shards.  The regions of up to SHARD bytes form a shard.  Its suffix array is refined by
   Larsson-Sadakane doubling: only groups still unsorted are sorted again, by the rank of the
   suffix h bytes on.  Kasai's inequality (a suffix's common prefix is at least its left
   neighbour's less one) gives the common prefixes, walked in strides.  In each set of equal windows all
   but the first are marked, so a shard sends on each distinct window once at most, however often
   a passage repeats in it.
3. Merging.  The first windows of all shards meet by minimiser; each finds the earliest holder of
   its string by binary search in the sorted keys, the hit is confirmed on the string's bytes, and all others are
   marked.  A minimiser with more than HOT rows (a passage that very many shards hold) merges in levels: its
   rows are dealt to groups of about HOT, each group passes on only the earliest holder of each of its windows,
   until no key has more than HOT rows.  Rows that are still too many after the first level, because their
   windows differ, are keyed by the second smallest hash of each window, and after the second by a hash of the whole window.
4. Marks become byte spans by document, and the kept bytes are hashed.

Exact copies of whole texts are found by their SHA-256: all of a later copy's bytes go when it has 100
or more.

Defined results: a null text is an empty one; texts under 100 bytes lose nothing; a null id
comes after all others and is returned as null; rows of one doc_id with different texts are
ordered by a hash of the text, equal rows are one document and come out alike; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .common import buffer_of, by_size, drop_staged, scope, stage, text_column

LENGTH = 100
GRAM = 24
SPREAD = LENGTH - GRAM + 1  # grams in a window
SHARD = 1 << 20
SLICE = 1 << 20
HOT = 512  # rows of one key that merge in one group
LAST = 2**63 - 1  # stands for a null doc_id: a doc_id of this value is ordered among those

GRAMS_SCHEMA = "doc long, k long, h long, n long"
LEVELS = ("runs", "finer", "windows")  # how the first, second and later levels of merging pass windows on
SHARD_SCHEMA = "doc long, k long, start long, stop long, h long, piece binary"
SPANS_SCHEMA = "doc long, k long, start long, stop long"
CUT_SCHEMA = "doc long, k long, n_removed long, n_spans long, kept_sha256 string"


def _sliding(values: np.ndarray, pick: np.ufunc, fill: np.uint64) -> np.ndarray:
    """``pick`` of each SPREAD neighbours, from running picks of blocks in both directions."""
    size = -(-len(values) // SPREAD) * SPREAD
    padded = np.full(size, fill)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, SPREAD)
    forward = pick.accumulate(blocks, axis=1).ravel()
    backward = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - SPREAD + 1
    return pick(backward[:n], forward[SPREAD - 1 : SPREAD - 1 + n])


def _blocks(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place, as one number."""
    return np.ndarray(max(len(data) - 7, 0), "<u8", np.ascontiguousarray(data), 0, (1,)).copy()


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place; equal hashes of different grams would only cost time."""
    blocks, n = _blocks(data), len(data) - GRAM + 1
    h = blocks[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += blocks[8 : 8 + n] * np.uint64(0xD1342543DE82EF95)
    h ^= h >> np.uint64(29)
    h += blocks[16 : 16 + n] * np.uint64(0x8CB92BA72F3D8DD7)
    return B.mix(h)


def minimisers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of every window, its minimiser, hash of every gram) of texts laid end to end; windows never cross texts."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = _gram_hashes(data)
    low = _sliding(h, np.minimum, ~np.uint64(0))
    crossing = np.zeros(len(low) + 1, np.int32)
    cuts = offsets[1:-1]
    np.add.at(crossing, np.clip(cuts - LENGTH + 1, 0, len(low)), 1)
    np.add.at(crossing, np.clip(cuts, 0, len(low)), -1)
    starts = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
    return starts, low[starts], h


def _key(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct minimisers of each text, and the places where the text has that gram as a minimiser."""
    for batch in by_size(batches, SLICE):
        data, offsets = buffer_of(text_column(batch))
        starts, low, h = minimisers(data, offsets)
        if not len(starts):
            continue
        # a gram is a minimiser if it is as small as the largest minimum of the windows around it
        every = np.zeros(len(h) + SPREAD - 1, np.uint64)
        every[starts + SPREAD - 1] = low
        place = np.flatnonzero((_sliding(every, np.maximum, np.uint64(0)) == h) & (h > 0))
        owner, value = np.searchsorted(offsets, place, side="right") - 1, h[place]
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        new = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
        n = np.diff(np.append(new, len(value)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(_key(batch, "doc")[owner[new]]), pa.array(_key(batch, "k")[owner[new]]), pa.array(value[new].view(np.int64)), pa.array(n)],
            names=["doc", "k", "h", "n"],
        )


# --- one shard ----------------------------------------------------------------------


def _eights(text: np.ndarray) -> np.ndarray:
    """The next eight bytes of each position as one number, in the order of the bytes; zeros beyond the end."""
    padded = np.zeros(len(text) + 7, np.uint8)
    padded[: len(text)] = text
    return _blocks(padded).byteswap()


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes sorted by their first ``depth`` bytes at least, rank of each suffix); fewer than 2**21 bytes."""
    n = len(text)
    eights = _eights(text)
    order = np.argsort(eights)
    ranked = eights[order]
    first = np.append(True, ranked[1:] != ranked[:-1])
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    h = 8
    while h < depth:
        alone = first & np.append(first[1:], True)
        open_ = np.flatnonzero(~alone)  # places of suffixes in groups of two or more
        if not len(open_):
            break
        suffix = order[open_]
        ahead = np.where(suffix + h < n, rank[np.minimum(suffix + h, n - 1)] + 1, 0)
        key = (group[open_].astype(np.uint64) << np.uint64(42)) | (ahead.astype(np.uint64) << np.uint64(21)) | np.arange(len(open_), dtype=np.uint64)
        key.sort()
        order[open_] = suffix[(key & np.uint64((1 << 21) - 1)).astype(np.int64)]
        key >>= np.uint64(21)
        first[open_] = np.append(True, key[1:] != key[:-1])
        group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank[order[open_]] = group[open_]
        h *= 2
    return order, rank


_BYTES = np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, cap: int = LENGTH) -> np.ndarray:
    """Bytes (``cap`` at most) that each suffix shares with the one before it in ``order``."""
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(place > 0, order[np.maximum(place - 1, 0)], -1)
    eights = np.append(_eights(text), np.zeros(cap + 16, np.uint64))
    tied = (before >= 0) & (rank == rank[before])  # equal as far as they were sorted, beyond the cap
    shared = np.where(tied, cap, 0)
    stride = 16
    done = np.arange(0, n, stride)
    while True:
        live = done[(before[done] >= 0) & ~tied[done]]
        while len(live):
            a, b = eights[live + shared[live]], eights[before[live] + shared[live]]
            more = a ^ b
            equal = 8 - np.searchsorted(_BYTES, more, side="right")  # leading equal bytes
            room = n - np.maximum(live, before[live]) - shared[live]
            shared[live] += np.minimum(equal, room)
            live = live[(equal == 8) & (room > 8) & (shared[live] < cap)]
        if stride == 1:
            break
        stride //= 2
        done = np.arange(stride, n, 2 * stride)
        known = done[~tied[done] & ~tied[done - stride]]  # the order of tied suffixes says nothing of the next ones
        shared[known] = np.maximum(shared[known - stride] - stride, 0)  # Kasai
    return np.minimum(shared[order], cap)


def later_windows(text: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each of the ascending window starts: does its string start at an earlier one too?"""
    order, rank = suffix_array(text)
    same = common_prefixes(text, order, rank) >= LENGTH
    is_window = np.zeros(len(text), bool)
    is_window[windows] = True
    group = np.cumsum(~same) - 1
    chosen = is_window[order]
    position, group = order[chosen], group[chosen]
    out = np.zeros(len(text), bool)
    if len(position):
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        least = np.repeat(np.minimum.reduceat(position, begin), np.diff(np.append(begin, len(group))))
        out[position] = position != least
    return out[windows]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs begin: the last key ascends by one inside a run, the others stay."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = keys[-1][1:] != keys[-1][:-1] + 1
    for k in keys[:-1]:
        new |= k[1:] != k[:-1]
    return np.flatnonzero(np.append(True, new))


def _shard(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (doc, k, bytes, window starts, minimisers): marks and first windows of one shard."""
    rows.sort(key=lambda r: r[:2])
    text, windows, doc, k, start, low, base = [], [], [], [], [], [], 0
    pieces: list[np.ndarray] = []
    for d, t, data, starts, lows in rows:
        keep = np.zeros(len(data) + 1, np.int32)
        begin = _runs(starts)
        stop = starts[np.append(begin[1:] - 1, len(starts) - 1)] + LENGTH
        np.add.at(keep, starts[begin], 1)
        np.add.at(keep, stop, -1)
        covered = np.cumsum(keep[:-1]) > 0
        # regions end to end, a byte that UTF-8 never has behind each
        edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
        shift = np.cumsum(covered) - 1 + np.searchsorted(edge[::2], np.arange(len(data)), side="right") - 1
        out = np.full(int(covered.sum()) + len(edge) // 2, 0xFF, np.uint8)
        out[shift[covered]] = data[covered]
        text.append(out)
        windows.append(base + shift[starts])
        base += len(out)
        doc.append(np.full(len(starts), d))
        k.append(np.full(len(starts), t))
        start.append(starts)
        low.append(lows)
        pieces.append(data)
    which = np.repeat(np.arange(len(rows)), [len(s) for s in start])
    windows, doc, k, start, low = (np.concatenate(x) for x in (windows, doc, k, start, low))
    later = later_windows(np.concatenate(text), windows)
    columns: list[list] = [[], [], [], [], [], []]
    w = np.flatnonzero(later)
    begin = _runs(which[w], start[w])
    last = np.append(begin[1:] - 1, len(w) - 1)[: len(begin)]
    columns[0] += doc[w[begin]].tolist()
    columns[1] += k[w[begin]].tolist()
    columns[2] += start[w[begin]].tolist()
    columns[3] += (start[w[last]] + LENGTH).tolist() if len(begin) else []
    columns[4] += [None] * len(begin)
    columns[5] += [None] * len(begin)
    w = np.flatnonzero(~later)
    begin = _runs(which[w], low[w].view(np.int64), start[w])
    last = np.append(begin[1:] - 1, len(w) - 1)[: len(begin)]
    columns[0] += doc[w[begin]].tolist()
    columns[1] += k[w[begin]].tolist()
    columns[2] += start[w[begin]].tolist()
    columns[3] += (start[w[last]] + LENGTH).tolist() if len(begin) else []
    columns[4] += low[w[begin]].view(np.int64).tolist()
    columns[5] += [pieces[i][s:e].tobytes() for i, s, e in zip(which[w[begin]], start[w[begin]], start[w[last]] + LENGTH, strict=True)] if len(begin) else []
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc", "k", "start", "stop", "h", "piece"])


def _wanted_windows(batches: Iterator[pa.RecordBatch], unpress: zstandard.ZstdDecompressor) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc, k, bytes, starts and minimisers of the windows whose minimiser is among the row's repeated ones), row by row."""
    for batch in batches:
        doc, k, hashes = _key(batch, "doc"), _key(batch, "k"), batch.column(3)
        lo = 0
        while lo < batch.num_rows:
            texts: list[bytes] = []
            total = 0
            while lo + len(texts) < batch.num_rows and total < SLICE:
                texts.append(unpress.decompress(batch.column(2)[lo + len(texts)].as_py()))
                total += len(texts[-1])
            data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
            starts, low, _ = minimisers(data, offsets)
            cut = np.searchsorted(starts, offsets)
            for i, (s, e) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                known = np.sort(np.asarray(hashes[lo + i].values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64))
                own, at = low[cut[i] : cut[i + 1]], starts[cut[i] : cut[i + 1]] - s
                hit = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
                yield int(doc[lo + i]), int(k[lo + i]), data[s:e], at[hit], own[hit]
            lo += len(texts)


def _shard_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, k, packed text, repeated minimisers) to marks and first windows, shard by shard."""
    unpress = zstandard.ZstdDecompressor()
    held: list[tuple] = []
    size = 0
    for doc, k, data, starts, low in _wanted_windows(batches, unpress):
        # a text of any length is cut into parts that fit a shard; each window is in one part
        for lo in range(0, len(starts), SHARD // 2):
            part, lows = starts[lo : lo + SHARD // 2], low[lo : lo + SHARD // 2]
            begin = _runs(part)
            need = len(part) + len(begin) * (LENGTH + 1)
            if held and size + need > SHARD:
                yield _shard(held)
                held, size = [], 0
            if need > SHARD + SHARD // 2:  # many short regions: fewer windows a shard
                for one in range(0, len(part), SHARD // 128):
                    yield _shard([(doc, k, data, part[one : one + SHARD // 128], lows[one : one + SHARD // 128])])
                continue
            held.append((doc, k, data, part, lows))
            size += need
    if held:
        yield _shard(held)


def _merge_batches(pass_on: str):
    """A map over first windows sorted by (g, doc, k, start): spans of those that aren't their group's earliest, and
    the earliest holders passed on: under their minimiser (``runs``), under the second smallest hash of each window
    (``finer``), each window under a hash of itself (``windows``), or not at all."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            g = batch.column(4).to_numpy()
            if sum(b.nbytes for b in held) < SHARD or g[0] == g[-1]:
                continue
            cut = int(np.searchsorted(g, g[-1]))  # the last group may go on
            held[-1] = batch.slice(0, cut)
            yield from _merge(held, pass_on)
            held = [batch.slice(cut)]
        if held:
            yield from _merge(held, pass_on)

    return rows


def _same_bytes(blocks: np.ndarray, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Do the ``size`` bytes (eight at least) from ``i`` equal those from ``j``?"""
    n = -(-size // 8)
    owner = np.repeat(np.arange(len(size)), n)
    at = np.minimum(8 * (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)), size[owner] - 8)
    out = np.ones(len(size), bool)
    out[owner[blocks[i[owner] + at] != blocks[j[owner] + at]]] = False
    return out


def holders(data: np.ndarray, at: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """The first window with the string and salt of each window that begins ``at``, confirmed on the bytes."""
    blocks = _blocks(data)
    same = lambda i, j: (salt[i] == salt[j]) & _same_bytes(blocks, at[i], at[j], np.full(len(i), LENGTH))
    keys = B.mix(B.ShortHash(data)(at, at + LENGTH) + salt)
    while True:
        order = np.argsort(keys)
        ranked = keys[order]
        place = np.searchsorted(ranked, ranked)  # where the windows with this key begin
        begin = np.flatnonzero(place == np.arange(len(keys)))
        found = np.empty_like(order)
        found[order] = np.repeat(np.minimum.reduceat(order, begin), np.diff(np.append(begin, len(keys)))) if len(keys) else order
        later = np.flatnonzero(found != np.arange(len(keys)))
        # neighbours whose holders are neighbours are compared as one run
        i, j = at[later], at[found[later]]
        begin = np.flatnonzero(np.append(True, (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1))[: len(i)])
        size = np.diff(np.append(begin, len(i))) + LENGTH - 1
        if (salt[later] == salt[found[later]]).all() and _same_bytes(blocks, i[begin], j[begin], size).all():
            return found
        keys = B.exact(keys, same)


def _second(data: np.ndarray, at: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The second smallest gram hash of each window that begins ``at``, whose minimiser is ``low``: also a function of its bytes."""
    h = _gram_hashes(data)
    grams = np.lib.stride_tricks.sliding_window_view(h, SPREAD)
    out = np.empty(len(at), np.uint64)
    for s in range(0, len(at), 1 << 14):
        part = grams[at[s : s + (1 << 14)]]
        out[s : s + (1 << 14)] = np.where(part == low[s : s + (1 << 14), None], ~np.uint64(0), part).min(axis=1)
    return out


def _merge(held: list[pa.RecordBatch], pass_on: str) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held)
    for lo, hi in _groups(table):
        part = table.slice(lo, hi - lo).combine_chunks()
        doc, k, start, g = (part[c].to_numpy() for c in ("doc", "k", "start", "g"))
        data, offsets = buffer_of(pa.concat_arrays(part["piece"].chunks))
        counts = np.diff(offsets) - LENGTH + 1
        row = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = offsets[row] + within
        found = holders(data, at, B.mix(g.view(np.uint64))[row])
        is_first = found == np.arange(len(found))

        def spans(chosen: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
            """(first and last window of each run of the chosen ones with equal keys, and its span)."""
            begin = _runs(row[chosen], *keys, within[chosen])
            last = chosen[np.append(begin[1:], len(chosen))[: len(begin)] - 1]
            first = chosen[begin]
            r = row[first]
            return first, last, [doc[r], k[r], start[r] + within[first], start[r] + within[last] + LENGTH]

        _, _, columns = spans(np.flatnonzero(~is_first))
        n, own, pieces = len(columns[0]), np.zeros(0, np.int64), []
        if pass_on:
            kept = np.flatnonzero(is_first)
            key = part["h"].to_numpy()[row[kept]]
            if pass_on == "finer":
                key = B.mix(_second(data, at[kept], key.view(np.uint64)) + np.uint64(1)).view(np.int64)
            elif pass_on == "windows":
                key = B.ShortHash(data)(at[kept], at[kept] + LENGTH).view(np.int64)
            first, last, more = spans(kept, key)
            columns = [np.concatenate(p) for p in zip(columns, more, strict=True)]
            own = key[np.searchsorted(kept, first)]
            pieces = [data[s:e].tobytes() for s, e in zip(at[first].tolist(), (at[last] + LENGTH).tolist(), strict=True)]
        if len(columns[0]):
            keyed = [pa.concat_arrays([pa.nulls(n, t), pa.array(v, t)]) for v, t in ((own, pa.int64()), (pieces, pa.binary()))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *keyed], names=["doc", "k", "start", "stop", "h", "piece"])


def _groups(table: pa.Table) -> Iterator[tuple[int, int]]:
    """Row ranges of whole groups, of a shard's bytes where groups allow."""
    h = table["g"].to_numpy()
    sizes = np.cumsum(np.concatenate([np.diff(buffer_of(c)[1]) for c in table["piece"].chunks]))
    cuts = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h))
    lo = before = 0
    for cut in cuts:
        if sizes[cut - 1] - before >= SHARD or cut == len(h):
            yield lo, int(cut)
            lo, before = int(cut), sizes[cut - 1]


# --- the whole ----------------------------------------------------------------------


def _pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in by_size(batches, SLICE):
        data, offsets = buffer_of(text_column(batch))
        packed = [press.compress(data[s:e].tobytes()) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc", "k", "packed"])


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """(the bytes outside ``spans``, maximal removed runs)."""
    out, at, runs = [], 0, 0
    end = -1
    for s, e in sorted(spans):
        if s > end:
            out.append(data[at:s])
            runs += 1
        end = max(end, e)
        at = end
    out.append(data[at:])
    return b"".join(out), runs


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
            unpress = zstandard.ZstdDecompressor()
            rows = []
            for d, k, packed, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = unpress.decompress(packed)
                kept, runs = kept_bytes(data, [(s["start"], s["stop"]) for s in spans])
                rows.append((d, k, len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc", "k", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("k"), text.alias("text"))


def _copies(keyed: DataFrame) -> DataFrame:
    """(doc, k) of texts that are later copies of a whole text of 100 bytes or more."""
    ids = keyed.where(F.octet_length("text") >= LENGTH).select("doc", "k", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    first = stage(ids.groupBy("k", "digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last"), "classes")
    return stage(ids.join(first, ["k", "digest"]).where("doc > first").select("doc", "k").distinct(), "copies")


def _merged(firsts: DataFrame, pass_on: str) -> DataFrame:
    dealt = firsts.repartition("g").sortWithinPartitions("g", "doc", "k", "start")
    return dealt.select("doc", "k", "start", "stop", "g", "piece", "h").mapInArrow(_merge_batches(pass_on), SHARD_SCHEMA)


def _merge_shards(shards: DataFrame, many: DataFrame) -> DataFrame:
    """Spans of the first windows of shards that aren't the earliest of all; ``many`` holds the minimisers that may have over HOT rows."""
    spans, firsts = [], shards.where("h is not null")
    suspects = firsts.join(many, "h")
    while True:
        hot = stage(suspects.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > HOT), "hot")
        if hot.isEmpty():
            break
        group = F.pmod(F.xxhash64("doc", "k", "start"), F.ceil(F.col("n") / HOT))
        level = stage(_merged(firsts.join(hot, "h").withColumn("g", F.xxhash64("h", group)), LEVELS[min(len(spans), 2)]), "level")
        spans.append(level.where("h is null").select("doc", "k", "start", "stop"))
        suspects = level.where("h is not null")
        firsts = firsts.join(hot, "h", "left_anti").unionByName(suspects)
    out = _merged(firsts.withColumn("g", F.col("h")), "").select("doc", "k", "start", "stop")
    for marks in spans:
        out = out.unionAll(marks)
    return out


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies: (doc, k), spans: (doc, k, start, stop)) of ``docs``; spans may overlap, copies have none."""
    keyed = _keyed(docs)
    copies = _copies(keyed)
    grams = stage(keyed.where(F.octet_length("text") >= LENGTH).mapInArrow(_gram_batches, GRAMS_SCHEMA), "grams")
    known = stage(grams.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1"), "repeated")
    wanted = grams.select("doc", "k", "h").join(known.select("h"), "h").groupBy("doc", "k").agg(F.collect_set("h").alias("hs")).join(copies, ["doc", "k"], "left_anti")
    packed = keyed.where(F.octet_length("text") >= LENGTH).mapInArrow(_pack_batches, "doc long, k long, packed binary")
    rows = packed.join(stage(wanted, "wanted").hint("merge"), ["doc", "k"]).dropDuplicates(["doc", "k"]).select("doc", "k", "packed", "hs")
    shards = stage(rows.mapInArrow(_shard_batches, SHARD_SCHEMA), "shards")
    drop_staged(grams)
    merged = _merge_shards(shards, known.where(F.col("n") > HOT).select("h"))
    return copies, shards.where("h is null").select("doc", "k", "start", "stop").unionAll(merged)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """(doc, k, n_removed, n_spans, kept_sha256, kept_bytes) of the documents that lose bytes, copies of whole texts aside; and those."""
    with scope() as tables:
        copies, spans = repeated_spans(docs)
        by_doc = stage(spans.groupBy("doc", "k").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
        tables.keep(copies, by_doc)
    packed = _keyed(docs).where(F.octet_length("text") >= LENGTH).mapInArrow(_pack_batches, "doc long, k long, packed binary")
    rows = packed.join(by_doc, ["doc", "k"]).dropDuplicates(["doc", "k"]).select("doc", "k", "packed", "spans")
    cut = rows.mapInArrow(_cut_batches, CUT_SCHEMA + ", kept_bytes binary")
    nothing = hashlib.sha256(b"").hexdigest()
    gone = copies.select("doc", "k", F.lit(-1).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(nothing).alias("kept_sha256"), F.lit(b"").alias("kept_bytes"))
    return cut.unionAll(gone)


def dedup_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of ``docs`` (doc_id, text)."""
    cut = cut_repeats(docs).drop("kept_bytes")
    text = F.coalesce(F.col("text"), F.lit(""))
    every = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(text).alias("k"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("sha"),
    )
    return every.join(cut, ["doc", "k"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(F.col("n_removed") < 0, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def _strip_batches(columns: list[str]):
    """Rows of ``columns`` and spans to the same rows with their spans taken out of text."""
    at = columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, SLICE):
            spans = batch.column(len(columns))
            texts = batch.column(at).to_pylist()
            for i in np.flatnonzero(np.asarray(spans.is_valid())):
                kept, _ = kept_bytes(texts[i].encode(), [(s["start"], s["stop"]) for s in spans[int(i)].as_py()])
                texts[i] = kept.decode(errors="ignore")  # characters cut by a span go with it
            out = list(batch.columns[: len(columns)])
            out[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(out, names=columns)

    return rows


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes taken out of their texts, with all their columns; ``n_chars`` follows the text."""
    with scope() as tables:
        copies, spans = repeated_spans(docs)
        whole = copies.select("doc", "k", F.lit(0).cast("long").alias("start"), F.lit(LAST).alias("stop"))
        by_doc = stage(spans.unionAll(whole).groupBy("doc", "k").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
        tables.keep(by_doc)
    names = docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    keyed = docs.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("k"))
    dealt = keyed.join(by_doc, ["doc", "k"], "left").select("row.*", F.col("spans").alias("__spans"))
    out = dealt.mapInArrow(_strip_batches(names), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
