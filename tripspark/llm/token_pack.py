"""Token ids in files of fixed-width packed bits.

A file holds the ids of consecutive documents, each id in the fewest bits that the vocabulary needs (id i at bit
``i * bits`` of its block, least significant bit first)::

    magic, version, bits, ids per block        16 bytes
    blocks of ``BLOCK_IDS`` ids, each padded to whole bytes
    doc_id (int64) and a null flag (byte) of each document, its first id's number in the file (uint64, one more at the end)
    offset of each block in the file (uint64, one more at the end)
    documents, ids, blocks, offset of the tables above, magic      40 bytes

Block offsets give random access (``PackedFile.ids(start, stop)`` reads the blocks it needs), and a block is
unpacked by numpy at once. Documents are dealt out by ranges of doc_id and sorted inside a task, so the
files follow each other in that order; a task writes its file block by block.

White space separates tokens in the tokenizers used here, and no token reaches over it, so a text's ids are the ids of
its white-space-separated words; a worker asks the tokenizer library for a word once, keeping a bounded number of them.
``split_words=False`` encodes texts as they are, for other tokenizers.

Defined cases: null or empty text has the end id alone; a null doc_id comes first; repeated rows are documents of their own,
next to each other; an empty table gives an empty result and no file; other columns are ignored.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.files import opened, written
from tripspark.llm.storage import fresh_path, materialize, small_batches, worker_state

MAGIC = b"PACKIDS1"
HEAD, HEAD_BYTES = "<8sHHI", 16
TAIL, TAIL_BYTES = "<QQQQ8s", 40
BLOCK_IDS = 1 << 16
MAX_WORDS = 1_500_000  # words, and parts of words, that a worker keeps (about 25 bytes and their ids each)
MAX_PARTS = 800_000
END_ID = 2


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    places = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(places.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    places = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return places @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class PackedWriter:
    def __init__(self, out, vocabulary: int, block_ids: int = BLOCK_IDS) -> None:
        self.out, self.bits, self.block_ids = out, bits_for(vocabulary), block_ids
        self.held, self.n_held, self.at = [], 0, HEAD_BYTES
        self.doc_ids, self.starts, self.blocks, self.n_ids = [], [], [], 0
        out.write(struct.pack(HEAD, MAGIC, 1, self.bits, block_ids))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block_ids:
            rest = np.concatenate(self.held)
            whole = len(rest) // self.block_ids * self.block_ids
            for start in range(0, whole, self.block_ids):
                self._block(rest[start : start + self.block_ids])
            self.held, self.n_held = [rest[whole:]], len(rest) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.blocks.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        tables = self.at
        self.out.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array([d is None for d in self.doc_ids], np.uint8).tobytes())
        self.out.write(np.array([*self.starts, self.n_ids], "<u8").tobytes())
        self.out.write(np.array([*self.blocks, tables], "<u8").tobytes())
        self.out.write(struct.pack(TAIL, len(self.doc_ids), self.n_ids, len(self.blocks), tables, MAGIC))


class PackedFile:
    def __init__(self, file) -> None:
        self.file = file
        magic, _, self.bits, self.block_ids = struct.unpack(HEAD, file.read_at(HEAD_BYTES, 0))
        n_docs, self.n_ids, n_blocks, tables, end = struct.unpack(TAIL, file.read_at(TAIL_BYTES, file.size() - TAIL_BYTES))
        if magic != MAGIC or end != MAGIC:
            raise ValueError("not a file of packed ids")
        data = file.read_at(n_docs * 17 + 8 + n_blocks * 8 + 8, tables)
        self.doc_ids = np.frombuffer(data, "<i8", n_docs)
        self.null = np.frombuffer(data, np.uint8, n_docs, n_docs * 8).astype(bool)
        self.starts = np.frombuffer(data, "<u8", n_docs + 1, n_docs * 9).astype(np.int64)
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, n_docs * 17 + 8).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids number ``start`` to ``stop`` of the file; reads the blocks that hold them."""
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        parts = []
        for b in range(first, last + 1):
            data = self.file.read_at(int(self.offsets[b + 1] - self.offsets[b]), int(self.offsets[b]))
            parts.append(unpack(data, self.bits, min(self.block_ids, self.n_ids - b * self.block_ids)))
        return np.concatenate(parts)[start - first * self.block_ids : stop - first * self.block_ids]

    def documents(self, group_ids: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc_id, start, ids)`` in order, reading about ``group_ids`` at a time."""
        at = 0
        while at < len(self.doc_ids):
            to = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + group_ids, side="right")) - 1)
            to = min(to, len(self.doc_ids))
            base = int(self.starts[at])
            ids = self.ids(base, int(self.starts[to]))
            for d in range(at, to):
                yield (None if self.null[d] else int(self.doc_ids[d])), int(self.starts[d]), ids[self.starts[d] - base : self.starts[d + 1] - base]
            at = to


class Lists:
    """Lists of integers by number."""

    def __init__(self) -> None:
        self.first, self.count, self.flat = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)

    def add(self, flat: np.ndarray, count: np.ndarray) -> None:
        self.first = np.concatenate((self.first, len(self.flat) + np.cumsum(count) - count))
        self.count = np.concatenate((self.count, count.astype(np.int32)))
        self.flat = np.concatenate((self.flat, flat.astype(np.int32)))

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of some numbers one after the other, and their lengths."""
        n = self.count[rows].astype(np.int64)
        upto = np.cumsum(n)
        total = int(upto[-1]) if len(upto) else 0
        kind = np.int32 if total + len(self.flat) < 1 << 31 else np.int64
        at = np.repeat((self.first[rows] - (upto - n)).astype(kind), n)
        at += np.arange(total, dtype=kind)
        return self.flat[at], n


class WordEncoder:
    """Ids of texts. Words between white space are looked up; a word of letters (ASCII, Latin-1) and closing marks is two
    parts, the lower-cased letters and the marks, as the tokenizer's own rule cuts it, any other is one; the
    library encodes each part once while it is kept. Words and parts are kept up to a number, then both start anew."""

    LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    MARKS = ".,;:!?"

    def __init__(self, tokenizer, split_words: bool) -> None:
        self.tokenizer, self.split_words = tokenizer, split_words
        self.clear()

    def clear(self) -> None:
        self.words, self.parts_of_word = pa.array([], pa.string()), Lists()
        self.parts, self.ids_of_part = pa.array([], pa.string()), Lists()

    def _encode(self, texts: list[str], size: int = 20_000) -> Iterator[list[int]]:
        for start in range(0, len(texts), size):
            yield from (e.ids for e in self.tokenizer.encode_batch_fast(texts[start : start + size], add_special_tokens=False))

    def _number_parts(self, parts: pa.StringArray) -> np.ndarray:
        coded = parts.dictionary_encode()
        number, new = _numbered(coded.dictionary, self.parts)
        self.ids_of_part.add(*_flattened(self._encode(new.to_pylist()), len(new)))
        self.parts = pa.concat_arrays([self.parts, new])
        return number[coded.indices.to_numpy()]

    def _learn(self, new: pa.StringArray) -> None:
        plain = pc.match_substring_regex(new, f"^[{self.LETTERS}]+[{self.MARKS}]*$")
        letters = pc.utf8_lower(pc.utf8_rtrim(new, self.MARKS))
        marks = pc.if_else(plain, pc.utf8_ltrim(new, self.LETTERS), "")
        second = pc.not_equal(marks, "").to_numpy(zero_copy_only=False)
        number = self._number_parts(pa.concat_arrays([pc.if_else(plain, letters, new), marks.filter(pa.array(second))]))
        count = 1 + second.astype(np.int64)
        start = np.cumsum(count) - count
        flat = np.empty(len(number), np.int64)
        flat[start], flat[start[second] + 1] = number[: len(new)], number[len(new) :]
        self.parts_of_word.add(flat, count)
        self.words = pa.concat_arrays([self.words, new])

    def __call__(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        texts = texts.fill_null("")
        if not self.split_words:
            return _flattened(self._encode(texts.to_pylist()), len(texts))
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.values.dictionary_encode()
        if len(self.words) > MAX_WORDS or len(self.parts) > MAX_PARTS:
            self.clear()
        number, new = _numbered(coded.dictionary, self.words)
        self._learn(new)
        parts, n_parts = self.parts_of_word.gather(number[coded.indices.to_numpy()])
        ids, n_ids = self.ids_of_part.gather(parts)
        upto = np.concatenate(([0], np.cumsum(n_ids)))[np.concatenate(([0], np.cumsum(n_parts)))][split.offsets.to_numpy()]
        return ids, np.diff(upto)


def _numbered(values: pa.StringArray, known: pa.StringArray) -> tuple[np.ndarray, pa.StringArray]:
    """The places of distinct values among the known ones, the new ones' places behind them, and the new ones."""
    found = pc.index_in(values, value_set=known)
    number = found.fill_null(-1).to_numpy().copy()
    new = np.flatnonzero(number < 0)
    number[new] = len(known) + np.arange(len(new))
    return number, values.take(pa.array(new))


def _flattened(lists: Iterator[list[int]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists as one array, and their lengths."""
    count, flat = np.empty(n, np.int64), []
    for i, x in enumerate(lists):
        count[i] = len(x)
        flat += x
    return np.array(flat, np.int64), count


MANIFEST = "part int, path string, n_docs long, n_ids long"


def _runs(batch: pa.RecordBatch, size: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``size`` bytes of text."""
    length = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(length) // size
    cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def write_packed(docs: DataFrame, tokenizer_file: str, folder: str, end_id: int = END_ID, split_words: bool = True) -> DataFrame:
    """Encode ``(doc_id, text)`` and write one file for each range of doc_id; the manifest (``part, path, n_docs, n_ids``) in order."""
    small_batches(docs.sparkSession, 5000)
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())  # the tokenizer, a fixed table

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return
        key = (hash(definition.value), split_words)
        state = worker_state("token_pack")
        if key not in state:
            state[key] = WordEncoder(Tokenizer.from_str(definition.value), split_words)
        encoder = state[key]
        part = TaskContext.get().partitionId()
        path = f"{folder}/ids-{part:06d}.bin"
        end = np.array([end_id], np.uint32)
        with written(path) as out:
            writer = PackedWriter(out, max(encoder.tokenizer.get_vocab_size(), end_id + 1))
            while head is not None:
                for run in _runs(head):
                    ids, n = encoder(run.column("text"))
                    for doc_id, own in zip(run.column("doc_id").to_pylist(), np.split(ids, np.cumsum(n)[:-1]), strict=True):
                        writer.add(doc_id, np.concatenate((own, end)))
                head = next(batches, None)
            writer.close()
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([path]), pa.array([len(writer.doc_ids)]), pa.array([writer.n_ids])], ["part", "path", "n_docs", "n_ids"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(ordered.mapInArrow(write, MANIFEST), "ids-manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            with opened(path) as f:
                rows = []
                for doc_id, start, ids in PackedFile(f).documents():
                    rows.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) >= 10_000:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_packed(manifest: DataFrame) -> DataFrame:
    """Read the files of a manifest: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts the ids of all files before."""
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("base", F.coalesce(before, F.lit(0)))  # a row per file
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "base").repartition(parts, "path").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def pack_documents(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    return read_packed(write_packed(docs, tokenizer_file, fresh_path(docs.sparkSession, "ids"), end_id))
