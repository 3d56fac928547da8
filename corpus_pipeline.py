"""Corpus pipeline over ``documents``: language ID, near-duplicates, source mix, SentencePiece encoding.

Each stage takes all that its predecessor kept; ``run`` writes each stage's rows as Parquet in the shared
folder (``spark.checkpoint.dir``) and reads them again for the next, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripspark.llm import jaccard_join, langid, mixing, piece_lattice
from tripspark.llm.storage import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language can be told; text without a letter is rejected. ``lang`` becomes the prediction.

    Learnt from the labelled documents of the input that are not held out. With nothing to learn from,
    everything is undetermined, and rejected.
    """
    profiles = langid.language_profiles(docs.filter(~langid.held_out()))
    found = langid.predict_languages(docs.select(*COLUMNS), profiles)
    kept = found.filter(F.col("lang_pred") != langid.UNDETERMINED)
    return kept.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def _digest() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def _further_texts(docs: DataFrame) -> DataFrame | None:
    """``doc_id, _digest, _key``: where rows of one doc_id have several texts, a key for each text but the first; None if there are none."""
    ids = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    ids = materialize(ids, "stage-repeated")
    if ids.isEmpty():
        return None
    texts = docs.join(ids, "doc_id", "left_semi").select("doc_id", _digest().alias("_digest")).distinct()
    order = Window.partitionBy("doc_id").orderBy("_digest")  # the texts of one id
    key = F.lit(-(2**62)) - F.pmod(F.xxhash64("doc_id", "_digest"), F.lit(2**61))
    return materialize(texts.withColumn("n", F.row_number().over(order)).filter("n > 1").select("doc_id", "_digest", key.alias("_key")), "stage-texts")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that links by word 5-shingles (Jaccard of 0.75 or more): the one with the smallest
    doc_id. Rows that repeat a doc_id are told apart by text: equal ones are one document, unlike ones are compared like any two
    documents (of those, the smallest text digest stays). Documents without words, or without an id, all stay."""
    named, further = docs.filter("doc_id IS NOT NULL").select(*COLUMNS), _further_texts(docs)
    if further is None:
        keyed = named.withColumn("_key", F.col("doc_id"))
        first = jaccard_join.jaccard_join(named).filter("doc_id = component_id").select(F.col("doc_id").alias("_key"))
    else:
        known = F.broadcast(further) if further.count() <= jaccard_join.BROADCAST_CLASSES else further
        keyed = named.withColumn("_digest", _digest()).join(known, ["doc_id", "_digest"], "left").withColumn("_key", F.coalesce("_key", "doc_id")).drop("_digest")
        found = jaccard_join.jaccard_join(keyed.select(F.col("_key").alias("doc_id"), "text")).select(F.col("doc_id").alias("_key"), "component_id").distinct()
        ids = found.join(known, "_key", "left").withColumn("doc_id", F.coalesce("doc_id", "_key"))
        smallest = F.min(F.struct("doc_id", F.coalesce("_digest", F.lit("")), "_key"))
        first = ids.groupBy("component_id").agg(smallest.alias("m")).select(F.col("m._key").alias("_key"))
    once = keyed.join(first.distinct(), "_key", "left_semi").dropDuplicates(["_key"])
    return once.select(*COLUMNS).unionByName(docs.filter("doc_id IS NULL").select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the target mix: none, one or several copies of each."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, and whether they decode to its text. Copies of a document get equal segmentations."""
    encoded = piece_lattice.encode_pieces(docs.select("doc_id", "text", "lang", "source"), PIECES, decoded=True)
    return encoded.select("doc_id", "lang", "source", "piece_ids", F.size("piece_ids").alias("n_pieces"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", detect_language),
    ("near_duplicates", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("encode_pieces", encode),
]

#: The profiles, the hash-drawn mix and the sampled pieces have no SQL form; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
