"""Operator 5, SentencePiece encoding and decoding: the N best segmentations of every text.

A text becomes pieces of the model's vocabulary with the largest sum of piece scores (characters
without a piece of their own fall back to bytes).  No piece holds a space mark behind another character,
so the lattice falls apart into chunks at word starts; equal chunks are solved once.  A forward
Viterbi pass, vectorised over chunks of one length, gives the best score of every prefix and the best two
of every chunk.  Those prefix scores are exact heuristics for a backward A-star search, which yields
a chunk's next segmentations in order of score.  The N best of a whole text differ from its best
in the N - 1 chunks whose second segmentation costs least, or in a choice among those.  The paths
of those chunks are put into the best segmentation's ids, so all N come out with their ids, best first.

Decoding joins the pieces' bytes, and every text is compared with what it was, for each of its N segmentations (a text that holds the
space mark itself decodes to a space there, as it does in the library).

Defined results: a null or empty text has no pieces, one segmentation of score 0 and is its own
decoding; fewer than N segmentations give shorter lists; the N are distinct, and equal scores count as often as they occur;
a null id is returned as null; repeated rows come out alike; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import product, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytesops as B
from .bytesops import gather
from .common import buffer_of, by_size, text_column

N_BEST = 4
MARK = "▁"
#: Chunks are forgotten beyond this many; those met several times stay.
CACHE = 250_000
KEEP_HITS = 4
#: How many chunks go through the forward pass together.
TOGETHER = 4096
SLICE = 1 << 19
SCHEMA = (
    "doc_id long, n_pieces long, scores array<double>, ids_crc32 long, decoded boolean, "
    "n_best_pieces array<long>, n_best_crc32 array<long>, n_best_decoded array<boolean>"
)
IDS_SCHEMA = SCHEMA + ", ids binary, n_best_ids array<binary>"
_NEVER = -1e18


class Lattice:
    """The vocabulary of a SentencePiece model, and segmentations under it."""

    def __init__(self, model_file: str, n_best: int = N_BEST):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.n_best = n_best
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.pieces = {model.id_to_piece(i): i for i in plain}
        self.score = np.array([model.get_score(i) for i in range(size)])
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        ordinary = [s for s in self.score[plain] if s > -1e8]
        self.fallback = min(ordinary) - 10.0  # a byte costs more than any piece
        self.longest = max(map(len, self.pieces))
        raw = self._bytes(model, size, set(plain))
        self.raw_size = np.array([len(r) for r in raw])
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        names = list(self.pieces)
        points = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(x) for x in names])
        keys = B.ShortHash(points)(ends - [len(x) for x in names], ends)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([self.pieces[x] for x in names])[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self._reset()

    def _bytes(self, model, size: int, plain: set[int]) -> list[bytes]:
        out = []
        for i in range(size):
            name = model.id_to_piece(i)
            out.append(name.replace(MARK, " ").encode() if i in plain else bytes([int(name[3:5], 16)]) if model.is_byte(i) else b"")
        return out

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.first = self.size = self.hits = np.zeros(0, np.int64)
        self.best = self.loss = np.zeros(0)
        self.pool = np.zeros(0, np.int32)
        self.more: dict[str, list[tuple[float, bytes]]] = {}  # the N best of a chunk: loss and ids

    def _forget(self) -> None:
        """Keep the chunks met several times since the last time."""
        keep = np.flatnonzero(self.hits >= KEEP_HITS)
        names = list(self.known)
        self.pool = gather(self.pool, self.first[keep], self.size[keep])
        self.known = {names[k]: i for i, k in enumerate(keep)}
        self.size, self.best, self.loss = self.size[keep], self.best[keep], self.loss[keep]
        self.first, self.hits = np.cumsum(self.size) - self.size, np.zeros(len(keep), np.int64)
        if len(self.more) > CACHE:
            self.more.clear()

    # -- forward ---------------------------------------------------------------------

    def _edges(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score, id) of the piece from each start with each length, for rows of ``points``; id -1 for bytes."""
        m, n = points.shape
        reach = min(n, self.longest)
        score = np.full((reach + 1, m, n), _NEVER)
        ids = np.full((reach + 1, m, n), -2, np.int32)
        spans = B.ShortHash(points.ravel())
        flat = np.arange(m * n).reshape(m, n)
        for length in range(1, reach + 1):
            at = flat[:, : n - length + 1]
            h = spans(at, at + length)
            row, start = np.nonzero(self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            h = h[row, start]
            place = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = self.keys[place] == h
            found = self.ids[place[hit]]
            score[length, row[hit], start[hit]] = self.score[found]
            ids[length, row[hit], start[hit]] = found
        bare = ids[1] == -2
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        score[1][bare] = self.fallback * width[bare]
        ids[1][bare] = -1
        return score, ids

    def forward(self, points: np.ndarray):
        """(best score of each prefix, second best score of the whole, edges, length of the last piece of each prefix)."""
        m, n = points.shape
        score, ids = self._edges(points)
        best, second = np.full((m, n + 1), _NEVER), np.full((m, n + 1), _NEVER)
        back = np.zeros((m, n + 1), np.int16)
        best[:, 0] = 0
        for end in range(1, n + 1):
            for length in range(1, min(end, self.longest) + 1):
                edge = score[length, :, end - length]
                one, two = best[:, end - length] + edge, second[:, end - length] + edge
                lead = one > best[:, end]
                second[:, end] = np.maximum(np.where(lead, best[:, end], np.maximum(second[:, end], one)), two)
                back[lead, end] = length
                best[:, end] = np.where(lead, one, best[:, end])
        return best, second[:, n], score, ids, back

    def _solve(self, chunks: list[str]) -> None:
        """Best segmentation and the loss of the second best, for new chunks."""
        for part, points in _by_length(chunks):
            best, second, _, ids, back = self.forward(points)
            self._keep(part, points, best[:, -1], second, ids, back)

    def _keep(self, chunks, points, best, second, ids, back) -> None:
        m, n = points.shape
        at, row = np.full(m, n), np.arange(m)
        rows, starts, picked = [], [], []
        while len(row):
            length = back[row, at].astype(np.int64)
            at = at - length
            rows.append(row)
            starts.append(at)
            picked.append(ids[length, row, at])
            live = at > 0
            row, at = row[live], at[live]
        rows, starts, picked = (np.concatenate(x) for x in (rows, starts, picked))
        order = np.argsort(rows * (n + 1) + starts)
        rows, starts, picked = rows[order], starts[order], picked[order].astype(np.int64)
        bare = np.flatnonzero(picked == -1)
        if len(bare):
            parts = [self.byte_id[list(chr(points[rows[b], starts[b]]).encode())] for b in bare]
            width = np.ones(len(picked), np.int64)
            width[bare] = [len(p) for p in parts]
            first = np.cumsum(width) - width
            out = np.empty(int(width.sum()), np.int64)
            out[first] = picked
            for b, p in zip(bare, parts, strict=True):
                out[first[b] : first[b] + len(p)] = p
            rows, picked = np.repeat(rows, width), out
        size = np.bincount(rows, minlength=m)
        first = len(self.pool) + np.cumsum(size) - size
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + m), strict=True))
        self.pool = np.concatenate([self.pool, picked.astype(np.int32)])
        self.first, self.size = np.concatenate([self.first, first]), np.concatenate([self.size, size])
        self.hits = np.concatenate([self.hits, np.zeros(m, np.int64)])
        self.best = np.concatenate([self.best, best])
        self.loss = np.concatenate([self.loss, np.where(second > _NEVER / 2, best - second, np.inf)])

    # -- backward --------------------------------------------------------------------

    def search(self, chunk: str, most: int) -> list[tuple[float, list[tuple[int, int]]]]:
        """The ``most`` best segmentations of a chunk, best first: (score, [(start, end)])."""
        return self.search_all([chunk], most)[chunk]

    def search_all(self, chunks: list[str], most: int) -> dict[str, list[tuple[float, list[tuple[int, int]]]]]:
        """The same for many chunks, whose forward passes run together."""
        out: dict[str, list] = {}
        for part, points in _by_length(chunks):
            best, _, score, _, _ = self.forward(points)
            for r, chunk in enumerate(part):
                out[chunk] = _backward(best[r].tolist(), score[:, r, :].tolist(), most)
        return out

    def _ranked(self, chunk: str, found: list[tuple[float, list[tuple[int, int]]]]) -> list[tuple[float, bytes]]:
        """Loss and ids of a chunk's N best; of equally good ones, that of the forward pass comes first."""
        k = self.known[chunk]
        best = self.pool[self.first[k] : self.first[k] + self.size[k]].astype("<u4").tobytes()
        out = []
        for score, spans in found:
            ids: list[int] = []
            for start, end in spans:
                piece = self.pieces.get(chunk[start:end])
                ids += self.byte_id[list(chunk[start:end].encode())].tolist() if piece is None else [piece]
            out.append((found[0][0] - score, np.array(ids, "<u4").tobytes()))
        at = next((i for i, (_, ids) in enumerate(out) if ids == best), len(out) - 1)  # else all N are as good
        return [(0.0, best), *out[:at], *out[at + 1 :]]

    # -- whole texts -----------------------------------------------------------------

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """(ids end to end, ids of each text, scores of the N best of each text) of texts laid end to end."""
        return self.encode_all(data, offsets)[:3]

    def encode_all(self, data: np.ndarray, offsets: np.ndarray):
        """The same, and for each text the ids (32-bit little-endian) of each of its N best, best first."""
        if len(self.known) > CACHE:
            self._forget()
        chunks: list[str] = []
        counts = np.zeros(len(offsets) - 1, np.int64)
        for i, (s, e) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            if e > s:
                found = chunked(data[s:e].tobytes().decode())
                counts[i] = len(found)
                chunks += found
        at = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(at < 0)
        if len(new):
            self._solve(list(dict.fromkeys([chunks[k] for k in new.tolist()])))
            at[new] = np.fromiter((self.known[chunks[k]] for k in new.tolist()), np.int64, len(new))
        self.hits += np.bincount(at, minlength=len(self.hits))
        size = self.size[at]
        ids = gather(self.pool, self.first[at], size)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        lengths = np.diff(np.concatenate([[0], np.cumsum(size)])[bounds])
        few = self.n_best - 1
        loss = self.loss[at]
        open_: list[np.ndarray] = []  # the chunks of each text that may change in its N best
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            near = np.argpartition(loss[lo:hi], few)[:few] if hi - lo > few else np.arange(hi - lo)
            open_.append(lo + near[np.isfinite(loss[lo + near])])
        wanted = {chunks[k] for k in np.concatenate([*open_, np.zeros(0, np.int64)]).astype(np.int64).tolist()}
        for chunk, found in self.search_all([c for c in wanted if c not in self.more], self.n_best).items():
            self.more[chunk] = self._ranked(chunk, found)
        sums = np.concatenate([[0.0], np.cumsum(self.best[at])])
        starts = 4 * np.concatenate([[0], np.cumsum(size)])  # of each chunk in the best ones' bytes
        flat = ids.astype("<u4").tobytes()
        scores, every = [], []
        for i, places in enumerate(open_):
            top = float(sums[bounds[i + 1]] - sums[bounds[i]])  # scores are whole numbers: no rounding
            places = np.sort(places).tolist()
            options = [self.more[chunks[k]] for k in places]
            losses = map(sum, product(*([x for x, _ in o] for o in options)))
            picks = sorted(zip(losses, product(*(range(len(o)) for o in options)), strict=True))[: self.n_best]
            scores.append([top - x for x, _ in picks])
            cuts = [int(starts[bounds[i]]), *(int(starts[j]) for k in places for j in (k, k + 1)), int(starts[bounds[i + 1]])]
            between = [flat[s:e] for s, e in zip(cuts[::2], cuts[1::2], strict=True)]
            every.append([b"".join([between[0], *(x for o, j, rest in zip(options, pick, between[1:], strict=True) for x in (o[j][1], rest))]) for _, pick in picks])
        return ids, lengths, scores, every

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes end to end, offsets) of the texts; the space put before each text is taken off."""
        size = self.raw_size[ids]
        out = gather(self.raw, self.raw_first[ids], size)
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(lengths)])]
        filled = np.flatnonzero(np.diff(ends) > 0)
        keep = np.ones(len(out), bool)
        keep[ends[filled]] = False
        sizes = np.diff(ends)
        sizes[filled] -= 1
        return out[keep], np.concatenate([[0], np.cumsum(sizes)])


def _by_length(chunks: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Chunks of one length and their code points, as many together as fit."""
    groups: dict[int, list[str]] = {}
    for c in chunks:
        groups.setdefault(len(c), []).append(c)
    for n, same in groups.items():
        together = max(1, TOGETHER * 8 // max(n, 8))
        for lo in range(0, len(same), together):
            part = same[lo : lo + together]
            yield part, np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).reshape(len(part), n)


def _backward(best: list[float], score: list[list[float]], most: int) -> list[tuple[float, list[tuple[int, int]]]]:
    """A-star from the end: a partial path's bound is its own score and the best score of the prefix
    that is left, which is exact, so finished paths leave the queue in order."""
    n = len(best) - 1
    queue: list[tuple] = [(-best[n], 0, n, 0.0, None)]
    out, order = [], 1
    while queue and len(out) < most:
        bound, _, end, behind, path = heapq.heappop(queue)
        if end == 0:
            spans = []
            while path is not None:
                spans.append(path[0])
                path = path[1]
            out.append((-bound, spans))
            continue
        for start in range(max(0, end - len(score) + 1), end):
            edge = score[end - start][start]
            if edge > _NEVER / 2:
                heapq.heappush(queue, (-(best[start] + edge + behind), order, start, behind + edge, ((start, end), path)))
                order += 1
    return out


_CHUNK = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


def chunked(text: str) -> list[str]:
    """A text with its spaces marked, cut where a mark follows another character and around newlines."""
    return _CHUNK.findall(MARK + text.replace(" ", MARK))


_lattices: dict[tuple[str, int], Lattice] = {}


def lattice(model_file: str, n_best: int = N_BEST) -> Lattice:
    """One lattice a process, model and N."""
    if (model_file, n_best) not in _lattices:
        _lattices[model_file, n_best] = Lattice(model_file, n_best)
    return _lattices[model_file, n_best]


def _rows(model_file: str, n_best: int, with_ids: bool) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, SLICE):
            data, offsets = buffer_of(text_column(batch))
            solver = lattice(model_file, n_best)
            _, lengths, scores, every = solver.encode_all(data, offsets)
            sizes = [[len(x) // 4 for x in one] for one in every]
            ids = np.frombuffer(b"".join(x for one in every for x in one), "<u4")
            back, places = solver.decode(ids, np.array([n for one in sizes for n in one], np.int64))
            back, places = back.tobytes(), iter(zip(places[:-1].tolist(), places[1:].tolist(), strict=True))
            raw = data.tobytes()
            same = [
                [back[s2:e2] == raw[s1:e1] for _, (s2, e2) in zip(one, places)]  # noqa: B905
                for s1, e1, one in zip(offsets[:-1].tolist(), offsets[1:].tolist(), every, strict=True)
            ]
            crc = [[zlib.crc32(x) for x in one] for one in every]
            columns = [
                batch.column(0).cast(pa.int64()),
                pa.array(lengths.astype(np.int64)),
                pa.array(scores, pa.list_(pa.float64())),
                pa.array([x[0] for x in crc], pa.int64()),
                pa.array([x[0] for x in same], pa.bool_()),
                pa.array(sizes, pa.list_(pa.int64())),
                pa.array(crc, pa.list_(pa.int64())),
                pa.array(same, pa.list_(pa.bool_())),
            ]
            names = ["doc_id", "n_pieces", "scores", "ids_crc32", "decoded", "n_best_pieces", "n_best_crc32", "n_best_decoded"]
            if with_ids:
                columns += [pa.array([x[0] for x in every], pa.binary()), pa.array(every, pa.list_(pa.binary()))]
                names += ["ids", "n_best_ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def segment(docs: DataFrame, model_file: str, n_best: int = N_BEST, with_ids: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): pieces of the best segmentation, the scores of the ``n_best`` best,
    the unsigned crc32 of the best one's ids (32-bit little-endian), whether they decode to the text; number of pieces,
    crc32 and whether they decode for each of the ``n_best``, best first; and the ids of the best and of each if asked for."""
    return docs.select("doc_id", "text").mapInArrow(_rows(model_file, n_best, with_ids), IDS_SCHEMA if with_ids else SCHEMA)
