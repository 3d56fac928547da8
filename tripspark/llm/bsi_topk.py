"""Exact top-k inner product search over a bit-sliced index.

Components x are quantised to floor(``QUANTUM`` * x). The index cuts the vectors into blocks of about
``BLOCK_ROWS`` rows; in a block every component becomes bit slices of its distance from the block's smallest
value: bitmaps with one bit a row. A query's score is a sum of slices shifted by the bits of its own
components (signed digits with no two neighbours set; a negative digit adds the complemented slices, and a constant). The bitmaps
of one weight are added by carry-save adders, three into a sum and a carry, until every weight has one: the slices of
all scores at once. Selection goes from the most significant slice downward, keeping the rows that are certainly
among the best and those still on the boundary; what is left on the boundary at the end has equal scores, and the smallest ids
are taken. Blocks give at most k rows a query, which are ranked over all blocks.

The searches are stated queries against all rows: the queries are sent to the blocks of their dimension. A block goes to one task,
or, where there are fewer blocks than tasks, to a few that share the queries, so the index is moved once whatever the number of queries.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part; sums have as many slices as they
need, whatever the components, and a score that no 64-bit integer holds, or a component of 2**54 or more in size, is an error, not a
missing row; vectors of different lengths don't meet; a row is never a result of a query with its
own id; a repeated query is asked once, a repeated row is found as often as it occurs; ties go to the smaller id; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.graph import groups_of
from tripspark.llm.storage import materialize

QUANTUM = 256
TOO_LARGE = 2.0**54
TOP = 5
BLOCK_ROWS = 32768
CHUNK_QUERIES = 48


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, vectors = [], []
        for vec_id, x in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
            if vec_id is None or not x.is_valid or not len(x.values) or x.values.null_count:
                continue
            v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(v).all():
                if np.abs(v).max() >= TOO_LARGE:
                    raise ValueError(f"vector {vec_id} has a component of 2**54 or more in size: its scores are beyond 64 bits")
                ids.append(vec_id)
                vectors.append(np.floor(QUANTUM * v).astype(np.int64))
        yield pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array([len(v) for v in vectors], pa.int32()), pa.array([v.tobytes() for v in vectors], pa.binary())], ["vec_id", "dim", "vec"]
        )


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, dimensions)`` integers -> the base and the number of slices of each dimension, and all slices (bitmaps of 64-bit words)."""
    base = values.min(axis=0)
    above = values - base
    bits = np.array([int(m).bit_length() for m in above.max(axis=0)])
    rows = len(values)
    out = np.zeros((int(bits.sum()), -(-rows // 64) * 8), np.uint8)
    at = 0
    for d, n in enumerate(bits.tolist()):
        for b in range(n):
            packed = np.packbits((above[:, d] >> b) & 1, bitorder="little")
            out[at, : len(packed)] = packed
            at += 1
    return base, bits, out.view(np.uint64)


def signed_digits(n: int) -> list[int]:
    """n = sum(digit << place), digits -1, 0 and 1, no two neighbours set."""
    out, sign, n = [], 1 if n >= 0 else -1, abs(n)
    while n:
        digit = 2 - (n & 3) if n & 1 else 0
        out.append(sign * digit)
        n = (n - digit) >> 1
    return out


def add_slices(columns: list[list[np.ndarray]]) -> list[np.ndarray | None]:
    """Bitmaps by weight -> the slices of their sum, by carry-save adders."""
    out: list[np.ndarray | None] = []
    w = 0
    while w < len(columns):
        column = columns[w]
        if len(column) > 1 and w + 1 == len(columns):
            columns.append([])
        while len(column) > 1:
            a, b = column.pop(), column.pop()
            half = a ^ b
            if column:
                c = column.pop()
                column.insert(0, half ^ c)
                columns[w + 1].append((a & b) | (half & c))
            else:
                column.append(half)
                columns[w + 1].append(a & b)
        out.append(column[0] if column else None)
        w += 1
    return out


class BlockIndex:
    def __init__(self, ids: np.ndarray, base: np.ndarray, bits: np.ndarray, slices: np.ndarray) -> None:
        self.ids, self.base, self.bits, self.slices = ids, base.tolist(), bits.tolist(), slices
        self.first = np.concatenate(([0], np.cumsum(bits))).tolist()
        full = np.zeros(slices.shape[1] * 8, np.uint8)
        packed = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
        full[: len(packed)] = packed
        self.rows = full.view(np.uint64)
        self.complements = ~slices & self.rows

    def search(self, query_id: int, query: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, ids in order within equal scores; rows must be in order of their ids."""
        columns: list[list[np.ndarray]] = []
        constant = 0
        for q, base, bits, first in zip(query, self.base, self.bits, self.first, strict=False):
            constant += q * base
            for place, digit in enumerate(signed_digits(q)):
                if digit < 0:
                    constant -= ((1 << bits) - 1) << place
                if digit:
                    columns += [[] for _ in range(place + bits - len(columns))]
                    source = self.slices if digit > 0 else self.complements
                    for b in range(bits):
                        columns[place + b].append(source[first + b])
        scores = [(w, s) for w, s in enumerate(add_slices(columns)) if s is not None]
        edge = self.rows
        own = np.flatnonzero(self.ids == query_id)
        if len(own):
            edge = edge.copy()
            np.bitwise_and.at(edge, own >> 6, ~(np.uint64(1) << (own & 63).astype(np.uint64)))
        sure = np.zeros_like(edge)
        for _, s in reversed(scores):
            upper = edge & s
            n = int(np.bitwise_count(sure).sum() + np.bitwise_count(upper).sum())
            if n > k:
                edge = upper
            else:
                sure = sure | upper
                edge = edge & ~s
        rows, rest = _bits(sure), _bits(edge)
        rows = np.sort(np.concatenate((rows, rest[: k - len(rows)])))  # the boundary's scores are equal
        total = np.full(len(rows), constant, object)  # k integers of any size
        for w, s in scores:
            total += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(object) << w
        return self.ids[rows], total.astype(np.int64)  # an error where a score is beyond 64 bits


def _bits(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _grouped_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in groups_of(batches, ["dim", "block"]):
        ids = table.column("vec_id").to_numpy()
        values = np.frombuffer(b"".join(table.column("vec").to_pylist()), np.int64).reshape(len(ids), -1)
        base, bits, slices = slices_of(values)
        yield pa.record_batch(
            [pa.array([table.column("dim")[0].as_py()], pa.int32()), pa.array([table.column("block")[0].as_py()], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in (ids, base, bits, slices)]],
            ["dim", "block", "ids", "base", "bits", "slices"],
        )


def _searcher(k: int):
    """Rows by block: the block, then the queries sent to it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("kind")[i].as_py() == 0:
                    row = {c: batch.column(c)[i] for c in ("ids", "base", "bits", "slices")}
                    ids, base, bits = (np.frombuffer(row[c].as_buffer(), np.int64) for c in ("ids", "base", "bits"))
                    words = -(-len(ids) // 64)
                    index = BlockIndex(ids, base, bits, np.frombuffer(row["slices"].as_buffer(), np.uint64).reshape(-1, words))
                    continue
                out: list[tuple] = []
                for q in batch.column("queries")[i].as_py():
                    found, scores = index.search(q["vec_id"], np.frombuffer(q["vec"], np.int64).tolist(), k)
                    out.append((np.full(len(found), q["vec_id"]), found, scores))
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    return search


INDEX = "dim int, block long, ids binary, base binary, bits binary, slices binary"


def build_index(vectors: DataFrame, n_rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Quantised ``(vec_id, dim, vec)`` -> a row per block: its ids in order, bases, numbers of slices, slices."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n_rows // block_rows))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).repartition(parts, "dim", "block")
    return materialize(dealt.sortWithinPartitions("dim", "block", "vec_id").select("dim", "block", "vec_id", "vec").mapInArrow(_grouped_index, INDEX), "bsi-index")


def quantise(embeddings: DataFrame) -> DataFrame:
    return materialize(embeddings.select("vec_id", "embedding").mapInArrow(_quantised, "vec_id long, dim int, vec binary"), "bsi-vectors")


def top_k(queries: DataFrame, index: DataFrame, n_queries: int, k: int = TOP) -> DataFrame:
    """Quantised queries against an index: ``query_id, rank, vec_id, score``."""
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, -(-n_queries // CHUNK_QUERIES))
    places = index.groupBy("dim").agg(F.collect_set("block").alias("blocks"))  # as many numbers as blocks
    sharing = max(1, min(chunks, parts // max(1, index.count())))  # tasks that share a block's queries
    asked = queries.withColumn("chunk", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(chunks))).groupBy("dim", "chunk")
    asked = asked.agg(F.collect_list(F.struct("vec_id", "vec")).alias("queries"))
    sent = asked.join(places, "dim").select("dim", F.explode("blocks").alias("block"), F.pmod("chunk", F.lit(sharing)).alias("share"), F.lit(1).alias("kind"), "queries")
    shares = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sharing - 1).cast("long"))).alias("share")
    blocks = index.select("dim", "block", shares, F.lit(0).alias("kind"), "ids", "base", "bits", "slices")
    met = blocks.unionByName(sent, allowMissingColumns=True).repartition(parts, "dim", "block", "share").sortWithinPartitions("dim", "block", "share", "kind")
    found = met.select("kind", "queries", "ids", "base", "bits", "slices").mapInArrow(_searcher(k), "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_embeddings(embeddings: DataFrame, every: int = 50, k: int = TOP) -> DataFrame:
    """Rows whose ``vec_id`` is divisible by ``every``, against all other rows."""
    vectors = quantise(embeddings)
    queries = vectors.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "vec"])
    return top_k(queries, build_index(vectors, vectors.count()), queries.count(), k)
