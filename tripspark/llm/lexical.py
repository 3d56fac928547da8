"""Ranked lexical search: an inverted index in blocks of documents, searched term-at-a-time and document-at-a-time.

A term is a maximal run of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. With N the documents with
a term, L their terms, n a document's terms, df the documents holding a term, tf its occurrences in a document, the weight is
w = floor(1000 * ln((2N + 2) / (2df + 1))), in doubles, and a document's score the sum of w * (10**9 * tf div (1000 * tf + 20 * m)) over
the query's terms, once each, with m = 50 + 50 * n * N div L; all in 64-bit integers.

The index is built where the documents are read, without a shuffle of texts: a task cuts its documents into blocks of about
``BLOCK_TERMS`` occurrences, a row per term of a block holding its list (documents by number, occurrences), and a head row with
the documents' ids and lengths, in order of the ids. Queries go to the blocks, not the index to the queries: only lists of terms that are asked
for are moved, to the task of their block.

In a block, a query's lists are taken in order of length. The short ones, together at most ``SHORT`` of the block's documents (or the
shortest alone), are merged term-at-a-time: sorted accumulators, each the sum of its document's parts. Accumulators are then one more
list, bounded by the largest sum, beside the long lists, each bounded by the largest of its parts. Documents are taken in order, in
windows: lists are essential from the point where the bounds before them, in ascending order, together exceed the k-th best score so far; only documents of essential lists are looked
at, and each of the rest is probed, from the largest bound down, for documents that can still win. When no list is essential the rest of the block is
skipped. Blocks give at most k rows a query, which are ranked over all blocks (each task passes on k of them a query).

Defined cases: a null or empty text has no terms; rows without doc_id are ignored; rows that repeat a doc_id are documents of their
own; a null item_id is ignored, rows that repeat one are one item with the terms of all; equal scores are ranked by doc_id; an item
without terms, or whose documents all score 0, has no rows; very long texts are read in pieces; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.storage import materialize, small_batches

TOP = 50
BLOCK_TERMS = 1 << 20
BLOCK_DOCS = 1 << 14
SHORT = 0.125
WINDOW = 256
PIECE = 1 << 20
CHUNK_TERMS = 1 << 14
#: every byte that is no part of a term becomes a space, A-Z become lower case
FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
GAP = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a list for each piece of about ``PIECE`` bytes, cut between terms."""
    start = 0
    while start < len(text):
        cut = GAP.search(text, start + PIECE) if len(text) - start > PIECE else None
        stop = cut.start() if cut else len(text)
        yield text[start:stop].translate(FOLD).split()
        start = stop


class _Block:
    """Documents gathered for one block."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.numbers: dict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.parts: list[np.ndarray] = []
        self.occurrences = 0

    def add(self, doc_id: int, text: bytes) -> None:
        length = 0
        for words in terms_of(text):
            found = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            self.parts.append(found << 32 | len(self.ids))
            length += len(words)
        if length:
            self.ids.append(doc_id)
            self.lengths.append(length)
            self.occurrences += length

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """The head row (no term; documents' ids, lengths), and a row per term."""
        ids = np.array(self.ids, np.int64)
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        lengths = np.array(self.lengths, np.int64)[order]
        yield _index_rows([block], [None], [len(ids)], [int(lengths.sum())], [ids[order].tobytes()], [lengths.tobytes()])
        seen = np.concatenate(self.parts)
        keys, counts = np.unique((seen >> 32 << 32) | place[seen & 0xFFFFFFFF], return_counts=True)
        starts = np.flatnonzero(np.diff(keys >> 32, prepend=-1))
        docs, counts = (keys & 0xFFFFFFFF).astype(np.int32), counts.astype(np.int32)
        names = list(self.numbers)
        bounds = [*starts.tolist(), len(keys)]
        for first in range(0, len(starts), 1 << 14):
            spans = list(zip(bounds[first:-1], bounds[first + 1 :], strict=True))[: 1 << 14]
            n = len(spans)
            lists = [[x[a:b].tobytes() for a, b in spans] for x in (docs, counts)]
            yield _index_rows([block] * n, [t.decode() for t in names[first : first + n]], [b - a for a, b in spans], [0] * n, *lists)


def _index_rows(*columns: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["block", "term", "df", "total", "docs", "counts"])


INDEX = "block long, term string, df long, total long, docs binary, counts binary"


def _indexer(block_terms: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for i in range(batch.num_rows):
                if not ids[i].is_valid or not texts[i].is_valid:
                    continue
                block.add(ids[i].as_py(), texts[i].as_buffer().to_pybytes())
                if block.occurrences >= block_terms or len(block.ids) >= BLOCK_DOCS:
                    yield from block.rows(number)
                    block, number = _Block(), number + 1
        if block.ids:
            yield from block.rows(number)

    return build


def build_index(docs: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``doc_id, text`` -> the index of all terms, written to the shared folder."""
    small_batches(docs.sparkSession, 500)
    return materialize(docs.select("doc_id", "text").mapInArrow(_indexer(block_terms), INDEX), "lexical-index")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True):
            if item is not None and text.is_valid:
                terms = {t.decode() for words in terms_of(text.as_buffer().to_pybytes()) for t in words}
                yield pa.record_batch([pa.array([item] * len(terms), pa.int64()), pa.array(list(terms), pa.string())], ["item_id", "term"])


def query_terms(items: DataFrame) -> DataFrame:
    return items.select("item_id", "text").mapInArrow(_item_terms, "item_id long, term string").distinct()


class BlockSearch:
    """Lists of one block and the parts their entries give, without the query's weight."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.ids = ids
        self.m20 = 20 * (50 + (50 * lengths * n_docs) // n_terms)
        self.lists: dict[str, tuple[np.ndarray, np.ndarray, int]] = {}

    def add(self, term: str, docs: np.ndarray, counts: np.ndarray) -> None:
        tf = counts.astype(np.int64)
        parts = (10**9 * tf) // (1000 * tf + self.m20[docs])
        self.lists[term] = docs.astype(np.int64), parts, int(parts.max())

    def search(self, terms: list[str], weights: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Document numbers and scores of the k best, highest first, equal scores in order of the number."""
        found = sorted(((self.lists[t], w) for t, w in zip(terms, weights, strict=True) if w > 0 and t in self.lists), key=lambda x: len(x[0][0]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        room, short = max(int(SHORT * len(self.ids)), len(found[0][0][0])), 0
        while short < len(found) and len(found[short][0][0]) <= room:
            room -= len(found[short][0][0])
            short += 1
        lists = [_accumulated([(docs, w * parts) for (docs, parts, _), w in found[:short]])]
        lists += [(docs, w * parts, w * largest) for (docs, parts, largest), w in found[short:]]
        return _windows(sorted(lists, key=lambda x: x[2]), len(self.ids), k)


def _accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Term-at-a-time: the sum of all parts of each document, by document, and the largest."""
    if len(lists) == 1:
        docs, sums = lists[0]
    else:
        docs, place = np.unique(np.concatenate([d for d, _ in lists]), return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, place, np.concatenate([p for _, p in lists]))
    return docs, sums, int(sums.max())


def _windows(lists: list[tuple[np.ndarray, np.ndarray, int]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Document-at-a-time over lists in ascending order of their bounds, a window of documents a step; windows grow."""
    upto = np.cumsum([bound for _, _, bound in lists]).tolist()  # what a document in none but these lists can reach
    top_docs, top_scores = np.empty(0, np.int64), np.empty(0, np.int64)
    threshold, at, size = 0, 0, WINDOW
    cursor = [0] * len(lists)
    while True:
        essential = next((i for i, bound in enumerate(upto) if bound > threshold), None)
        if essential is None:
            break
        for i in range(essential, len(lists)):
            cursor[i] += int(np.searchsorted(lists[i][0][cursor[i] :], at))
        heads = [int(lists[i][0][cursor[i]]) for i in range(essential, len(lists)) if cursor[i] < len(lists[i][0])]
        if not heads:
            break
        at, stop = min(heads), min(heads) + size  # skip to the first document of an essential list
        pieces = []
        for i in range(essential, len(lists)):
            docs, parts, _ = lists[i]
            end = cursor[i] + int(np.searchsorted(docs[cursor[i] :], stop))
            pieces.append((docs[cursor[i] : end], parts[cursor[i] : end]))
        pieces = [p for p in pieces if len(p[0])]
        docs, scores, _ = _accumulated(pieces)
        for i in range(essential - 1, -1, -1):  # probe the others while they can matter
            alive = scores + upto[i] > threshold
            docs, scores = docs[alive], scores[alive]
            if not len(docs):
                break
            have, parts, _ = lists[i]
            place = np.minimum(np.searchsorted(have, docs), len(have) - 1)
            scores = scores + np.where(have[place] == docs, parts[place], 0)
        better = scores > threshold
        if better.any():
            top_docs, top_scores = np.concatenate((top_docs, docs[better])), np.concatenate((top_scores, scores[better]))
            order = np.lexsort((top_docs, -top_scores))[:k]
            top_docs, top_scores = top_docs[order], top_scores[order]
            if len(top_docs) == k:
                threshold = int(top_scores[-1])  # later documents have larger numbers: an equal score does not win
        at, size = stop, min(2 * size, 16 * WINDOW)
        if at >= n_docs:
            break
    return top_docs, top_scores


def _searcher(k: int, n_docs: int, n_terms: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, None
        for batch in batches:
            rows = {c: batch.column(c) for c in ("block", "kind", "term", "docs", "counts", "queries")}
            out: list[tuple] = []
            for i, (number, kind) in enumerate(zip(rows["block"].to_pylist(), rows["kind"].to_pylist(), strict=True)):
                if kind == 0:
                    ids, lengths = (np.frombuffer(rows[c][i].as_buffer(), np.int64) for c in ("docs", "counts"))
                    current, block = BlockSearch(ids, lengths, n_docs, n_terms), number
                elif kind == 1:
                    current.add(rows["term"][i].as_py(), *(np.frombuffer(rows[c][i].as_buffer(), np.int32) for c in ("docs", "counts")))
                elif number == block:
                    for q in rows["queries"][i].as_py():
                        docs, scores = current.search([t["term"] for t in q["terms"]], [t["weight"] for t in q["terms"]], k)
                        out.append((np.full(len(docs), q["item_id"], np.int64), current.ids[docs], scores))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["item_id", "doc_id", "score"])

    return search


def search(items: DataFrame, index: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, text`` against an index: ``item_id, rank, doc_id, score``, the k highest scores above 0 of each item."""
    spark = index.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = index.filter("term IS NULL")
    total = heads.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("df"), F.lit(0)).alias("docs"), F.coalesce(F.sum("total"), F.lit(0)).alias("terms")).first()  # one row
    asked = materialize(query_terms(items), "lexical-queries")
    # a frequent term has a row in every block: its rows are dealt over salts, 256 blocks each
    salts = max(1, total["blocks"] // 256)
    wanted = asked.select("term").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = index.filter("term IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    lists = materialize(salted.join(wanted, ["term", "salt"], "left_semi").drop("salt", "total"), "lexical-lists")
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2 * total["docs"] + 2).cast("double") / (2 * F.sum("df") + 1).cast("double")))
    weights = lists.groupBy("term").agg(weight.cast("long").alias("weight"))
    queries = asked.join(weights, "term").groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))  # one query's terms
    chunks = max(1, -(-asked.count() // CHUNK_TERMS))
    chunked = queries.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(chunks)).alias("chunk")).agg(F.collect_list(F.struct("item_id", "terms")).alias("queries"))
    shape = chunked.schema["queries"].dataType
    none = F.lit(None)
    sent = heads.select("block").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))).join(materialize(chunked, "lexical-chunks"), "chunk")
    met = (
        heads.select("block", F.lit(0).alias("kind"), "term", "docs", "counts", none.cast(shape).alias("queries"))
        .unionByName(lists.select("block", F.lit(1).alias("kind"), "term", "docs", "counts", none.cast(shape).alias("queries")))
        .unionByName(sent.select("block", F.lit(2).alias("kind"), none.cast("string").alias("term"), none.cast("binary").alias("docs"), none.cast("binary").alias("counts"), "queries"))
    )
    met = met.repartition(parts, "block").sortWithinPartitions("block", "kind")
    found = met.mapInArrow(_searcher(k, total["docs"], max(1, total["terms"])), "item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
