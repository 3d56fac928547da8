"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams (1 to 3 letters of lower-cased words, with a mark at
both ends of a word) by falling count, ties by code. A language's profile comes from labelled
documents; a document takes the language whose profile has the smallest out-of-place distance to its own: for
each of the document's n-grams the difference of the ranks, or ``PROFILE`` where the language lacks it.

Profiles are fitted on a bounded sample: of each language about ``SAMPLE_DOCS`` labelled documents, drawn by a
hash of their ids from all of them. They have languages x ``PROFILE`` rows, which the driver hands to the
tasks. Prediction reads the whole text of every document, in one pass without a shuffle.

Defined cases: null text, or text without a letter, is ``und`` with score 0, and so is everything if nothing is
labelled; ties of distance go to the first language by code point; a document with a null id is never learnt from and not held
out; repeated rows count and are predicted as often as they occur; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.storage import small_batches, worker_state

PROFILE = 400
SAMPLE_DOCS = 2000
UNDETERMINED = "und"
SEED = 11


class Letters:
    """Codes of lower-cased text: 1 for a stretch without letters, code point + 2 for a letter."""

    def __init__(self) -> None:
        self.is_letter = np.array([chr(c).isalpha() for c in range(0x110000)])

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.is_letter[points]
        if not letter.any():
            return np.empty(0, np.uint64)
        marked = np.concatenate(([False], letter, [False]))
        codes = np.where(marked, np.concatenate(([0], points, [0])).astype(np.uint64) + np.uint64(2), np.uint64(1))
        return codes[np.concatenate(([True], marked[1:] | marked[:-1]))]


def ngram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (21 bits a letter) in order, and their counts. N-grams of three don't reach over a word's end."""
    shift = np.uint64(21)
    pairs = (codes[:-1] << shift) | codes[1:]
    triples = (pairs[:-1] << shift) | codes[2:]
    grams = np.sort(np.concatenate((codes[codes > 1], pairs, triples[codes[1:-1] > 1])))
    start = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[start], np.diff(np.append(start, len(grams)))


def _count_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = Letters()
    for batch in batches:
        langs, grams, counts = [], [], []
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            codes = letters.codes(text.as_py())
            if len(codes):
                g, n = ngram_counts(codes)
                langs.append(pa.repeat(lang, len(g))), grams.append(g.astype(np.int64)), counts.append(n)
        if grams:
            yield pa.record_batch([pa.concat_arrays(langs), pa.array(np.concatenate(grams)), pa.array(np.concatenate(counts))], ["lang", "gram", "n"])


def language_profiles(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, profile: int = PROFILE, seed: int = SEED) -> DataFrame:
    """``(doc_id, text, lang)`` -> ``(lang, gram, rank)``, ranks from 0."""
    rows = labelled.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    if not totals:
        return rows.sparkSession.range(0).selectExpr("cast(null as string) as lang", "id as gram", "cast(id as int) as rank")
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in totals.items() for x in (lang, min(1.0, sample_docs / n))]), F.col("lang"))
    sample = rows.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 32)) / float(1 << 32) < share)
    counted = sample.select("lang", "text").mapInArrow(_count_sample, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1)
    return ranked.filter(F.col("rank") < profile).select("lang", "gram", "rank")


class Ranker:
    """Distances of a document to all profiles at once."""

    def __init__(self, profiles: list[tuple[str, int, int]], profile: int = PROFILE) -> None:
        self.profile = profile
        self.langs = sorted({lang for lang, _, _ in profiles})
        self.grams = np.unique(np.array([g for _, g, _ in profiles], np.int64)).astype(np.uint64)
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)  # the last column: no profile has it
        for lang, gram, rank in profiles:
            self.ranks[self.langs.index(lang), np.searchsorted(self.grams, np.uint64(gram))] = rank

    def predict(self, codes: np.ndarray) -> tuple[str, float]:
        if not len(codes) or not self.langs:
            return UNDETERMINED, 0.0
        grams, counts = ngram_counts(codes)
        own = grams[np.argsort(-counts, kind="stable")[: self.profile]]
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.ranks[:, at]
        apart = np.where(ranks < 0, self.profile, np.abs(ranks - np.arange(len(own)))).sum(axis=1)
        best = int(apart.argmin())
        return self.langs[best], 1.0 - float(apart[best]) / (self.profile * len(own))


def predict_languages(docs: DataFrame, profiles: DataFrame, profile: int = PROFILE) -> DataFrame:
    """The columns of ``docs`` with ``lang_pred`` and ``score`` (1 minus the distance as a share of the largest possible)."""
    small_batches(docs.sparkSession)
    rows = [(r["lang"], r["gram"], r["rank"]) for r in profiles.collect()]  # languages x profile
    fields = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("langid")
        letters, ranker = Letters(), Ranker(rows, profile)
        for batch in batches:
            found = [ranker.predict(letters.codes(x.as_py() or "")) for x in batch.column("text")]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            kept = [batch.column(f.name) for f in fields]
            yield pa.record_batch([*kept, langs, scores], [*[f.name for f in fields], "lang_pred", "score"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "lang_pred string", "score double"])
    return docs.mapInArrow(predict, schema)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, lang)`` -> ``doc_id, held_out, lang_pred, score``; learnt from the documents not held out."""
    learnt = docs.select("doc_id", "text", "lang").filter(~held_out())
    found = predict_languages(docs.select("doc_id", held_out().alias("held_out"), "text"), language_profiles(learnt))
    return found.select("doc_id", "held_out", "lang_pred", "score")
