"""Sampled SentencePiece segmentation: forward filtering, backward sampling over the piece lattice.

Text gets a leading space, spaces become the piece mark, and every way to write it in pieces is a path of the
lattice. A piece of vocabulary rank r weighs (r + 2) ** -sharpness; a character without a piece is written in its
UTF-8 byte pieces (so is the piece mark itself, so that decoding is lossless). Forward filtering gives each position the
summed weight of the paths into it; backward sampling walks from the end, choosing the piece before each position
by its share. The draws are a hash of (seed, row key, unit, step): a row is segmented alike in every run
and on every executor.

No piece crosses the start of a run of spaces or a line break, so the lattice falls into independent units
("  word", "\\n"). The filtered lattice of a unit is kept (for a bounded number of units) and shared by its occurrences,
which are all sampled together, a step at a time, in numpy.

Defined cases: null text has null ids, and empty text none; a null key is a key of its own; repeated rows get equal
segmentations; long texts are sampled whole, in runs of units of about ``RUN_CHARS`` characters, and units longer than ``LONG_UNIT`` in windows
(the weights into all positions are kept, the pieces of one window at a time are laid out again for the way back); an empty table gives an empty result; all columns of the input are kept,
except that a column named like an output is replaced.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tripspark.llm.hashing import mixed
from tripspark.llm.storage import small_batches, worker_state

MARK = "▁"
SHARPNESS = 1.0
SEED = 20240607
MAX_UNITS = 250_000  # kept by a worker, over its tasks
MAX_ARCS = 6_000_000
RUN_CHARS = 1_000_000  # of text sampled together
ADD_CHARS = 100_000  # of new units filtered together: a lattice takes many times its final size while it is made
LONG_UNIT = 10_000  # characters; beyond, a unit is filtered and sampled in windows
WINDOW = 1 << 15
SMALL = 1e-100
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
UNIT = re.compile(r" *[^ \n]+| +|\n")
BORDER = re.compile(r"(?<! ) |\n")  # a unit starts here


def load_pieces(model_file: str) -> tuple[list[str], list[int]]:
    """The pieces by id, and the ids of the special ones (control, unknown)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    return pieces, [i for i in range(len(pieces)) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)]


class Vocabulary:
    """A trie of the pieces as a table of (node, character) -> node, and the ids and log weights."""

    def __init__(self, pieces: list[str], special: list[int], sharpness: float = SHARPNESS) -> None:
        self.byte_id = np.zeros(256, np.int64)
        self.bytes_of = [b""] * len(pieces)
        words, skip = {}, set(special)
        for i, piece in enumerate(pieces):
            if i in skip:
                continue
            if m := BYTE_PIECE.fullmatch(piece):
                self.byte_id[int(m[1], 16)] = i
                self.bytes_of[i] = bytes([int(m[1], 16)])
            else:
                words[piece.replace(MARK, " ")] = i
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
        if any("\n" in w or " " in w.lstrip(" ") for w in words):
            raise ValueError("a piece crosses a line break or the start of a run of spaces: units would not be independent")
        edges: dict[tuple[int, int], int] = {}
        piece_at = [-1]
        for word, i in words.items():
            node = 0
            for ch in word:
                if (node, ord(ch)) not in edges:
                    edges[node, ord(ch)] = len(piece_at)
                    piece_at.append(-1)
                node = edges[node, ord(ch)]
            piece_at[node] = i
        self.bits = 64 - (4 * len(edges) + 1).bit_length()  # the table of edges is open-addressed, a quarter full at most
        self.keys, self.nodes = np.full(1 << (64 - self.bits), -1, np.int64), np.zeros(1 << (64 - self.bits), np.int32)
        keys, nodes = np.array([(n << 21) | c for n, c in edges], np.int64), np.array(list(edges.values()), np.int32)
        slot = self._slot(keys)
        while len(keys):  # those that find a free slot settle, the others look at the next one
            free = self.keys[slot] < 0
            self.keys[slot[free]], self.nodes[slot[free]] = keys[free], nodes[free]
            left = self.keys[slot] != keys
            keys, nodes, slot = keys[left], nodes[left], (slot[left] + 1) & (len(self.keys) - 1)
        self.first = np.full(0x110000, -1, np.int64)  # the steps from the root
        for (n, c), to in edges.items():
            if n == 0:
                self.first[c] = to
        self.longest = max(map(len, words), default=1)
        self.piece_at = np.array(piece_at)
        self.weight = -sharpness * np.log(np.arange(len(pieces)) + 2.0)
        self.size = len(pieces)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The nodes behind the edges, -1 where there is none."""
        keys = (nodes.astype(np.int64) << 21) | chars
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.nodes[slot], -1)
        at = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(at):
            slot[at] = (slot[at] + 1) & (len(self.keys) - 1)
            seen = self.keys[slot[at]]
            hit = seen == keys[at]
            out[at[hit]] = self.nodes[slot[at[hit]]]
            at = at[~hit & (seen >= 0)]
        return out

    def arcs(self, points: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces inside units: ``(start, end, piece)``. ``room``: how many characters of its unit follow from each one. A piece
        id of ``size`` + code point means the character's bytes."""
        start = np.arange(len(points))
        node = self.first[points]
        single = np.where(node >= 0, self.piece_at[node], -1)
        byte = single < 0
        found = [(start, start + 1, np.where(byte, self.size + points.astype(np.int64), single))]
        live = np.flatnonzero((node >= 0) & (room > 1))
        node, length = node[live], 2
        while len(live):
            node = self.step(node, points[live + length - 1])
            hit = node >= 0
            live, node = live[hit], node[hit]
            piece = self.piece_at[node]
            some = piece >= 0
            found.append((live[some], live[some] + length, piece[some]))
            going = room[live] > length
            live, node, length = live[going], node[going], length + 1
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def row_key(key: int | None, seed: int) -> int:
    start = np.array([(0x5851F42D4C957F2D if key is None else key & (2**64 - 1)), seed], np.uint64)
    return int(mixed(mixed(start[:1] + np.uint64(0x9E3779B97F4A7C15)) ^ start[1:])[0])


class Numbers(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


class Sampler:
    """Samples segmentations of units, with the filtered lattices of those seen before."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.clear()

    def clear(self) -> None:
        self.known = Numbers()
        self.end_of = np.empty(0, np.int32)  # by unit: its last position
        self.base_of = np.empty(0, np.int32)  # by unit: the position before its first character
        self.arc_from = np.zeros(1, np.int32)  # by position: the arcs into it are [arc_from[p], arc_from[p + 1]), the likeliest first
        self.share = np.empty(0, np.float32)  # by arc: the summed shares of the arcs into its position, up to this one
        self.arc_start, self.arc_piece = np.empty(0, np.int32), np.empty(0, np.int32)

    def add(self, units: list[str]) -> None:
        """Forward filtering of new units; every unit has its positions 0..length, one after the other."""
        text = "".join(units)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        length = np.fromiter(map(len, units), np.int64, len(units))
        stop = np.cumsum(length)
        unit = np.repeat(np.arange(len(units)), length)
        start, end, piece = self.v.arcs(points, stop[unit] - np.arange(len(points)))
        origin = len(self.arc_from) - 1  # the new units' first position
        base = origin + stop - length + np.arange(len(units))
        place = lambda char, at: base[unit[char]] + at - (stop - length)[unit[char]]
        into, out_of = place(start, end), place(start, start)
        depth = end - (stop - length)[unit[start]]
        order = np.argsort((depth << 40) | into)
        into, out_of, piece, depth = into[order], out_of[order], piece[order], depth[order]
        code = np.maximum(piece - self.v.size, 0)
        n_bytes = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        weight = np.where(piece < self.v.size, self.v.weight[np.minimum(piece, self.v.size - 1)], n_bytes * self.v.weight[-1])
        total = np.zeros(len(points) + len(units))  # log of the summed weight of the paths into a position
        share = np.empty(len(into))
        bounds = np.searchsorted(depth, np.arange(1, depth[-1] + 2))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):  # positions by their distance from the start
            if lo == hi:
                continue
            to = into[lo:hi]
            path = total[out_of[lo:hi] - origin] + weight[lo:hi]
            first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            many = np.diff(np.append(first, hi - lo))
            top = np.maximum.reduceat(path, first)
            each = np.exp(path - np.repeat(top, many))
            whole = np.add.reduceat(each, first)
            total[to[first] - origin] = top + np.log(whole)
            share[lo:hi] = each / np.repeat(whole, many)
        order = np.argsort(into - 0.5 * share)  # by position, the larger shares first
        n_into = np.bincount(into - origin, minlength=len(points) + len(units))
        last = np.cumsum(n_into)
        run = np.cumsum(share[order])
        run -= np.repeat(np.concatenate(([0.0], run))[last - n_into], n_into)
        grown = lambda old, new: np.concatenate((old, new.astype(old.dtype)))
        self.end_of, self.base_of = grown(self.end_of, base + length), grown(self.base_of, base)
        self.arc_from = grown(self.arc_from, self.arc_from[-1] + last)
        self.share = grown(self.share, run)
        self.arc_start, self.arc_piece = grown(self.arc_start, out_of[order]), grown(self.arc_piece, piece[order])

    def sample(self, units: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all units one after the other, and how many each has. ``keys``: 64 random bits of each unit."""
        if len(self.known) > MAX_UNITS or len(self.share) > MAX_ARCS:
            self.clear()
        before = len(self.known)
        at = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        if len(self.known) > before:
            new = list(itertools.islice(self.known, before, None))
            part = np.cumsum([len(u) for u in new]) // ADD_CHARS  # units are independent: a few at a time give the same lattices
            for some in np.split(np.arange(len(new)), np.flatnonzero(np.diff(part)) + 1):
                self.add(new[some[0] : some[-1] + 1])
        position, base = self.end_of[at], self.base_of[at]
        live, steps, count = np.arange(len(units)), [], np.zeros(len(units), np.int64)
        draw = keys
        while len(live):
            draw = mixed(draw + np.uint64(0x9E3779B97F4A7C15))
            u = ((draw >> np.uint64(40)).astype(np.float32)) / np.float32(2**24)
            arc, last = self.arc_from[position], self.arc_from[position + 1] - 1
            more = np.flatnonzero((self.share[arc] <= u) & (arc < last))
            while len(more):
                arc[more] += 1
                more = more[(self.share[arc[more]] <= u[more]) & (arc[more] < last[more])]
            steps.append((live, self.arc_piece[arc]))
            count[live] += 1
            position = self.arc_start[arc]
            going = position != base
            live, position, base, draw = live[going], position[going], base[going], draw[going]
        last = np.cumsum(count)
        out = np.empty(int(last[-1]) if len(last) else 0, np.int32)
        for k, (which, piece) in enumerate(steps):
            out[last[which] - 1 - k] = piece
        return self._bytes(out, last, count)

    def _window(self, points: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The arcs that end in (a, b] of one long unit: start, end, piece and log weight, by end."""
        origin = max(0, a - self.v.longest)
        part = points[origin:b]
        start, end, piece = self.v.arcs(part, len(part) - np.arange(len(part)))
        start, end = start + origin, end + origin
        inside = end > a
        start, end, piece = start[inside], end[inside], piece[inside]
        order = np.argsort(end, kind="stable")
        start, end, piece = start[order], end[order], piece[order]
        code = np.maximum(piece - self.v.size, 0)
        n_bytes = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        weight = np.where(piece < self.v.size, self.v.weight[np.minimum(piece, self.v.size - 1)], n_bytes * self.v.weight[-1])
        return start, end, piece, weight

    def sample_long(self, unit: str, key: np.uint64) -> np.ndarray:
        """Piece ids of one long unit. The draw of a step is a hash of the unit's key and the step's number."""
        points = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(points)
        total = np.zeros(n + 1)  # log of the summed weight of the paths into a position
        for a in range(0, n, WINDOW):
            b = min(a + WINDOW, n)
            start, end, _, weight = self._window(points, a, b)
            origin, offset = max(0, a - self.v.longest), total[a]
            into = np.exp(total[origin : a + 1] - offset).tolist()
            arcs = zip((start - origin).tolist(), np.exp(weight).tolist(), strict=True)
            logs = []
            for many in np.bincount(end - a - 1, minlength=b - a).tolist():
                whole = sum(into[s] * w for s, w in itertools.islice(arcs, many))
                into.append(whole)
                logs.append(math.log(whole) + offset)
                if whole < SMALL:  # keep the recent ones in range
                    into[-self.v.longest :] = [x / SMALL for x in into[-self.v.longest :]]
                    offset += math.log(SMALL)
            total[a + 1 : b + 1] = logs
        out: list[int] = []
        draws, drawn = [], 0
        at = n
        for a in range((n - 1) // WINDOW * WINDOW, -1, -WINDOW):
            start, end, piece, weight = self._window(points, a, min(a + WINDOW, n))
            share = np.exp(total[start] + weight - total[end])
            order = np.lexsort((-share, end))  # the larger shares first
            first = np.concatenate(([0], np.cumsum(np.bincount(end - a - 1, minlength=min(a + WINDOW, n) - a)))).tolist()
            starts, pieces, shares = start[order].tolist(), piece[order].tolist(), share[order].tolist()
            while at > a:
                if not draws:
                    steps = np.arange(drawn, drawn + WINDOW, dtype=np.uint64)
                    draws = ((mixed(key + steps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) / 2.0**53).tolist()[::-1]
                    drawn += WINDOW
                u = draws.pop()
                arc, last = first[at - a - 1], first[at - a] - 1
                u -= shares[arc]
                while u >= 0 and arc < last:
                    arc += 1
                    u -= shares[arc]
                out.append(pieces[arc])
                at = starts[arc]
        ids = np.array(out[::-1], np.int32)
        return self._bytes(ids, np.array([len(ids)]), np.array([len(ids)]))[0]

    def _bytes(self, out: np.ndarray, last: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte pieces in place of the characters that have no piece."""
        raw = np.flatnonzero(out >= self.v.size)
        if not len(raw):
            return out, count
        code = out[raw] - self.v.size
        data = "".join(map(chr, code.tolist())).encode("utf-8")
        n = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        width = np.ones(len(out), np.int64)
        width[raw] = n
        wide = np.repeat(out, width)
        wide[np.repeat(out >= self.v.size, width)] = self.v.byte_id[np.frombuffer(data, np.uint8)]
        upto = np.concatenate(([0], np.cumsum(width)))
        return wide, upto[last] - upto[last - count]


def _salts(key: int, first: int, n: int) -> np.ndarray:
    """A number for each of a row's units from ``first`` on."""
    return np.uint64(key) + np.arange(first, first + n, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)


def _encode_long(sampler: Sampler, text: str, key: int) -> np.ndarray:
    """The ids of one text with the draws that ``encode_texts`` makes, in runs of units, long units by themselves."""
    text, number, out = " " + text, 0, []
    at = 0
    while at < len(text):
        border = BORDER.search(text, at + RUN_CHARS) if len(text) - at > RUN_CHARS else None
        stop = border.start() if border else len(text)
        units = UNIT.findall(text, at, stop)
        at = stop
        for is_long, run in itertools.groupby(units, lambda u: len(u) > LONG_UNIT):
            run = list(run)
            keys = mixed(_salts(key, number, len(run)))
            number += len(run)
            out += [sampler.sample_long(u, k) for u, k in zip(run, keys, strict=True)] if is_long else [sampler.sample(run, keys)[0]]
    return np.concatenate(out).astype(np.int32)


def encode_texts(sampler: Sampler, texts: list[str], keys: list[int]) -> list[np.ndarray]:
    """The sampled ids of each text."""
    units, owner, salt, alone = [], [], [], {}
    for i, (text, key) in enumerate(zip(texts, keys, strict=True)):
        own = UNIT.findall(" " + text) if text and len(text) <= RUN_CHARS else []
        if text and (not own or (len(text) > LONG_UNIT and max(map(len, own)) > LONG_UNIT)):
            own, alone[i] = [], _encode_long(sampler, text, key)
        units += own
        owner.append(len(own))
        salt.append(_salts(key, 0, len(own)))
    if not units:
        return [alone.get(i, np.empty(0, np.int32)) for i in range(len(texts))]
    ids, count = sampler.sample(units, mixed(np.concatenate(salt)))
    upto = np.concatenate(([0], np.cumsum(count)))[np.concatenate(([0], np.cumsum(owner)))]
    found = np.split(ids.astype(np.int32), upto[1:-1])
    return [alone.get(i, ids) for i, ids in enumerate(found)] if alone else found


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of which ``ids`` are any segmentation."""
    runs = (ids[i : i + RUN_CHARS].tolist() for i in range(0, len(ids), RUN_CHARS))
    return b"".join(b"".join(map(vocabulary.bytes_of.__getitem__, run)) for run in runs)[1:].decode("utf-8")


def _mapped(df: DataFrame, pieces: tuple[list[str], list[int]], outputs: str, run, sharpness: float) -> DataFrame:
    """``df`` with the columns ``outputs``, which ``run(vocabulary, sampler, batch slice)`` returns; the slices have about ``RUN_CHARS``."""
    small_batches(df.sparkSession)
    names = [o.split()[0] for o in outputs.split(", ")]
    fields = [f for f in df.schema.fields if f.name not in names]
    shared = df.sparkSession.sparkContext.broadcast(pieces)  # the vocabulary, a fixed table
    identity = (xxhash.xxh3_64_intdigest(repr(pieces).encode()), sharpness)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("piece_lattice")
        for batch in batches:
            if identity not in state:
                vocabulary = Vocabulary(*shared.value, sharpness)
                state[identity] = vocabulary, Sampler(vocabulary)
            vocabulary, sampler = state[identity]
            for part in run.slices(batch):
                columns = run(vocabulary, sampler, part)
                yield pa.record_batch([*[part.column(f.name) for f in fields], *columns], [*[f.name for f in fields], *names])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], outputs])
    return df.mapInArrow(task, schema)


class _Encode:
    def __init__(self, key: str, seed: int, decoded: bool = False) -> None:
        self.key, self.seed, self.decoded = key, seed, decoded

    def slices(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column = batch.column("text")
        start = held = 0
        for i in range(batch.num_rows):
            held += len(column[i].as_buffer() or b"")
            if held > RUN_CHARS:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)

    def __call__(self, vocabulary: Vocabulary, sampler: Sampler, part: pa.RecordBatch) -> list[pa.Array]:
        texts = part.column("text").to_pylist()
        keys = [row_key(k, self.seed) for k in part.column(self.key).to_pylist()]
        found = encode_texts(sampler, [t or "" for t in texts], keys)
        offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
        mask = pa.array([t is None for t in texts])
        columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)), mask=mask)]
        if self.decoded:
            columns.append(pa.array([None if t is None else decode_ids(vocabulary, f) for t, f in zip(texts, found, strict=True)], pa.string()))
        return columns


class _Decode:
    def slices(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 256):
            yield batch.slice(start, 256)

    def __call__(self, vocabulary: Vocabulary, sampler: Sampler, part: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([decode_ids(vocabulary, x.values.to_numpy()) if x.is_valid else None for x in part.column("piece_ids")], pa.string())]


def encode_pieces(docs: DataFrame, model_file: str, key: str = "doc_id", seed: int = SEED, sharpness: float = SHARPNESS, decoded: bool = False) -> DataFrame:
    """``docs`` with ``piece_ids``: a sampled segmentation of the whole ``text``, by the integer column ``key``; and with
    ``decoded``, the text that these ids write, in the same pass."""
    outputs = "piece_ids array<int>" + ", decoded string" * decoded
    return _mapped(docs, load_pieces(model_file), outputs, _Encode(key, seed, decoded), sharpness)


def decode_pieces(encoded: DataFrame, model_file: str) -> DataFrame:
    """``encoded`` with ``decoded``: the text that ``piece_ids`` write."""
    return _mapped(encoded, load_pieces(model_file), "decoded string", _Decode(), SHARPNESS)
