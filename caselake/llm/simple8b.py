"""Simple-8b: integers packed into 64-bit words, and the segment format built on it.

A word's top 4 bits select how many integers of how many bits fill the other 60.  Selector 0
is an escape: the next word is one integer of more than 60 bits.  Integers are cut into blocks
of BLOCK; each block starts at a word boundary and its word offset is in the header, so blocks
decode alone or all at once, without a loop over integers.
"""

from __future__ import annotations

import numpy as np

# The widths of simple-8b (integers a word, bits an integer) of selectors 2 to 15.
PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 0
BLOCK = 1024
MAGIC = b"S8B1"

_COUNT = np.array([1, 0, *(n for n, _ in PACKS)], np.int64)
_BITS = np.array([0, 0, *(b for _, b in PACKS)], np.int64)
_U = np.uint64


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    high = (values >> _U(32)).astype(np.float64)
    low = (values & _U(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1]).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offset of each block and the end) of unsigned integers."""
    values = np.asarray(values, _U)
    n = len(values)
    if not n:
        return np.zeros(0, _U), np.zeros(1, np.int64)
    blocks = -(-n // BLOCK)
    widest = max(p[0] for p in PACKS)
    bits = np.zeros((blocks, BLOCK + widest), np.uint8)
    padded = np.zeros((blocks, BLOCK + widest), _U)
    flat = np.zeros(blocks * BLOCK, _U)
    flat[:n] = values
    padded[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    bits[:, :BLOCK] = _bit_lengths(flat).reshape(blocks, BLOCK)
    # the selector that packs most integers from each position
    choice = np.where(bits[:, :BLOCK] > 60, ESCAPE, 15).astype(np.uint8)
    widest_here, reach = bits[:, :BLOCK].copy(), 1
    for selector in range(14, 1, -1):
        count, width = PACKS[selector - 2]
        while reach < count:
            np.maximum(widest_here, bits[:, reach : BLOCK + reach], out=widest_here)
            reach += 1
        choice[widest_here <= width] = selector
    # walk all blocks together
    length = np.full(blocks, BLOCK)
    length[-1] = n - (blocks - 1) * BLOCK
    at, row = np.zeros(blocks, np.int64), np.arange(blocks)
    rows, starts, picked = [], [], []
    while len(row):
        selector = choice[row, at]
        rows.append(row)
        starts.append(at)
        picked.append(selector)
        at = at + _COUNT[selector]
        live = at < length[row]
        row, at = row[live], at[live]
    rows, starts, picked = (np.concatenate(x) for x in (rows, starts, picked))
    order = np.argsort(rows * (BLOCK + 1) + starts)
    rows, starts, picked = rows[order], starts[order], picked[order]
    size = 1 + (picked == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), _U)
    for selector in np.unique(picked):
        mine = np.flatnonzero(picked == selector)
        if selector == ESCAPE:
            words[place[mine] + 1] = padded[rows[mine], starts[mine]]
            continue
        count, width = PACKS[selector - 2]
        word = np.full(len(mine), int(selector) << 60, _U)
        for k in range(count):
            word |= padded[rows[mine], starts[mine] + k] << _U(k * width)
        words[place[mine]] = word
    offsets = np.zeros(blocks + 1, np.int64)
    offsets[1:] = np.cumsum(np.bincount(rows, weights=size, minlength=blocks).astype(np.int64))
    return words, offsets


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` integers of whole blocks."""
    if not n:
        return np.zeros(0, _U)
    selector = (words >> _U(60)).astype(np.int64)
    payload = np.zeros(len(words), bool)  # raw words behind escapes
    maybe = np.flatnonzero(selector == ESCAPE)
    raw_after = -1
    for at in maybe:  # a raw word may itself look like an escape
        if at > raw_after:
            payload[at + 1] = True
            raw_after = at + 1
    head = np.flatnonzero(~payload)
    selector = selector[head]
    block = np.searchsorted(offsets, head, side="right") - 1
    count = _COUNT[selector]
    total = np.cumsum(count) - count
    first = np.searchsorted(block, np.arange(len(offsets) - 1))
    at = block * BLOCK + total - total[first][block]  # place of each word's first integer
    out = np.zeros((len(offsets) - 1) * BLOCK + PACKS[0][0], _U)
    # later blocks overwrite the zeros that pad the last word of the block before
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[at[mine]] = words[head[mine] + 1]
            continue
        n_here, width = int(_COUNT[s]), int(_BITS[s])
        mask = _U((1 << width) - 1)
        for k in range(n_here):
            place = at[mine] + k
            inside = place < (block[mine] + 1) * BLOCK
            out[place[inside]] = (words[head[mine[inside]]] >> _U(k * width)) & mask
    return out[:n]


def pack_segment(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment: MAGIC, sizes, document ids, lengths, block offsets, words."""
    words, offsets = encode(ids)
    sizes = np.array([len(doc_ids), len(ids), len(words), len(offsets)], "<i8")
    return b"".join((MAGIC, sizes.tobytes(), doc_ids.astype("<i8").tobytes(), lengths.astype("<i8").tobytes(), offsets.astype("<i8").tobytes(), words.astype("<u8").tobytes()))


def unpack_segment(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, lengths, ids) of a segment."""
    if blob[:4] != MAGIC:
        raise ValueError("not a simple-8b segment")
    n_docs, n_ids, n_words, n_offsets = (int(x) for x in np.frombuffer(blob, "<i8", 4, 4))
    at = 36
    doc_ids = np.frombuffer(blob, "<i8", n_docs, at)
    lengths = np.frombuffer(blob, "<i8", n_docs, at + 8 * n_docs)
    offsets = np.frombuffer(blob, "<i8", n_offsets, at + 16 * n_docs)
    words = np.frombuffer(blob, "<u8", n_words, at + 16 * n_docs + 8 * n_offsets)
    return doc_ids, lengths, decode(words, offsets, n_ids)
