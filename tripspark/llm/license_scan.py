"""Licence scans: sparse TF-IDF cosine to licence templates, then inheritance from directories. DataFrame expressions only.

1. Document frequencies of the templates' terms over all files (the terms are a fixed vocabulary; at most one row for each).
2. Every file is compared with every template in units: as a whole (licence files), line by line (notices), paragraph by paragraph
   (wrapped headers, titles: neighbouring lines that hold a term), and in blocks of neighbouring lines of which at least half the
   terms are templates' terms, lines without a term left out (licence texts of several paragraphs beside code). Terms weigh tf * idf,
   a term outside the templates has the largest idf, and the cosine is a join of the unit's terms with the templates' terms. Only units that
   two exact bounds show to stay below the threshold are left out, however frequent the terms. The best template with a cosine of at least
   ``COSINE`` is the file's own licence.
3. Licence files (``LICENSE``, ``COPYING``, ``NOTICE``) give their directory a licence. A file without its own inherits from the nearest
   ancestor directory that has one, by joining its ancestor paths with the directories.

Defined cases: null or empty text has no licence of its own; a null path inherits nothing; equal scores (to six
places) go to the first licence by name; repeated rows get equal results; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripspark.llm.license_texts import TEMPLATES
from tripspark.llm.storage import materialize

TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
COSINE = 0.6
SCORE_STEP = 1e-6  # scores are rounded to six places, so bounds stay this far below the threshold
LICENSE_FILE = r"(?i)^(licen[sc]e|copying|notice)(\..*)?$"

def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def template_terms(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """``(template, license, term, tf)``; a licence may have several templates, which are numbered."""
    each = [F.struct(F.lit(i).alias("template"), F.lit(k).alias("license"), F.lit(t).alias("notice")) for i, (k, t) in enumerate(templates)]
    listed = spark.range(1).select(F.explode(F.array(*each)).alias("t"))
    listed = listed.select("t.template", "t.license", F.explode(terms(F.col("t.notice"))).alias("term"))
    return listed.groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf"))


def any_of(words: list[str]) -> str:
    """A pattern of any of the words as a whole term, by first character, so that few branches are tried at a position."""
    by_first: dict[str, list[str]] = {}
    for w in sorted(words, reverse=True):  # a longer word before its beginning
        by_first.setdefault(w[0], []).append(w[1:].replace(".", r"\."))
    return r"(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in sorted(by_first.items())) + r")(?![a-z0-9])"


def parts_of(text: Column, near: str, vocabulary: list[str]) -> Column:
    """The units of a lower-cased text that can hold a notice: the text, its lines, its paragraphs and its blocks of several lines."""
    lines = F.split(text, "\n", -1)

    def known_half(line: Column) -> Column:
        found = terms(line)
        return F.size(F.filter(found, lambda t: t.isin(vocabulary))) * 2 >= F.size(found)

    def runs(kept: Column) -> Column:  # of lines that are not empty
        several = F.split(F.array_join(kept, "\n"), "\n{2,}", -1)
        return F.filter(several, lambda x: x.rlike("[^\n]\n[^\n]") & x.rlike(near))

    paragraphs = runs(F.transform(lines, lambda x: F.when(x.rlike("[a-z0-9]"), x).otherwise("")))
    blocks = runs(F.transform(F.filter(lines, lambda x: x.rlike("[a-z0-9]")), lambda x: F.when(known_half(x), x).otherwise("")))
    return F.concat(F.array(text), F.filter(lines, lambda x: x.rlike(near)), paragraphs, blocks)


def needed_terms(tfs: dict[int, dict[str, int]], df: dict[str, int], n_files: int, least: float) -> list[str]:
    """Template terms of which a unit must hold one to reach a cosine of ``least`` with any template. By Cauchy-Schwarz a unit
    that holds only some terms of a template reaches at most their part of the template's length; the most frequent terms
    whose part is below ``least`` are therefore not needed."""
    needed: set[str] = set()
    for tf in tfs.values():
        squares = {t: (n * (math.log((1.0 + n_files) / (1.0 + df.get(t, 0))) + 1.0)) ** 2 for t, n in tf.items()}
        left = least**2 * sum(squares.values())
        for term in sorted(tf, key=lambda t: (-df.get(t, 0), t)):
            left -= squares[term]
            if left <= 0:
                needed.add(term)
    return sorted(needed)


def own_licenses(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """``(id, text)`` -> ``(id, own_license, own_score)`` of the files that have one; ``id`` must name a row."""
    spark = files.sparkSession
    tfs: dict[int, dict[str, int]] = {}
    for r in template_terms(spark, templates).collect():  # fixed by the templates
        tfs.setdefault(r["template"], {})[r["term"]] = r["tf"]
    vocabulary = sorted({t for tf in tfs.values() for t in tf})
    known = F.array(*[F.lit(t) for t in vocabulary])
    texts = files.select("id", F.coalesce("text", F.lit("")).alias("text"))
    held = texts.select(F.explode_outer(F.array_intersect(known, terms(F.col("text")))).alias("term"))
    counts = {r["term"]: r["n"] for r in held.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a template term
    n_files = files.count()
    least = cosine - SCORE_STEP
    needed = needed_terms(tfs, counts, n_files, least)
    idf_of = F.create_map(*[x for t in vocabulary for x in (F.lit(t), F.log(F.lit((1.0 + n_files) / (1.0 + counts.get(t, 0)))) + 1.0)])
    idf = F.coalesce(F.element_at(idf_of, F.col("term")), F.log(F.lit(1.0 + n_files)) + 1.0)

    weights = template_terms(spark, templates).withColumn("w", F.col("tf") * idf)
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    sides = weights.join(norms, "template").select("template", "license", "term", (F.col("w") / F.col("norm")).alias("tw"))

    mark = F.array(*[F.lit(t) for t in needed])
    near = any_of(needed)
    likely = texts.select("id", F.lower("text").alias("text")).filter(F.col("text").rlike(near))
    unit = likely.select("id", F.posexplode(parts_of(F.col("text"), near, vocabulary)).alias("unit", "content")).select("id", "unit", terms(F.col("content")).alias("terms"))
    unit = unit.filter(F.size(F.array_intersect("terms", mark)) > 0)
    # The cosine is at most the length of a unit's part in the templates' terms over its whole length, and each other term has
    # the largest idf: most units, above all whole texts, cannot reach it and are not taken apart
    part = F.aggregate(
        F.array_intersect("terms", known),
        F.lit(0.0),
        lambda total, t: total + F.pow(F.size(F.filter("terms", lambda x: x == t)) * F.element_at(idf_of, t), F.lit(2.0)),
    )
    others = F.size(F.array_except("terms", known)) * F.pow(F.log(F.lit(1.0 + n_files)) + 1.0, F.lit(2.0))
    unit = materialize(unit.filter(part >= others * (least**2 / (1 - least**2))), "license-units")
    tf = unit.select("id", "unit", F.explode("terms").alias("term")).groupBy("id", "unit", "term").agg(F.count(F.lit(1)).alias("tf"))
    tf = tf.withColumn("w", F.col("tf") * idf)
    lengths = tf.groupBy("id", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = tf.join(sides, "term").groupBy("id", "unit", "template", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    score = F.round(F.col("dot") / F.col("norm"), 6)
    best = dots.join(lengths, ["id", "unit"]).select("id", "license", score.alias("score")).filter(F.col("score") >= cosine)
    first = F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("l")))
    return best.groupBy("id").agg(first.alias("b")).select("id", F.col("b.l").alias("own_license"), (-F.col("b.s")).alias("own_score"))


def scan_licenses(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, cosine: float = COSINE) -> DataFrame:
    """``(id, path, text)`` -> ``id, path, own_license, own_score, license, license_dir`` for every file. ``license_dir`` is the
    directory from which a licence is inherited, null for an own one."""
    own = materialize(own_licenses(files, templates, cosine), "licenses")
    named = files.select("id", "path").join(own, "id", "left")
    parts = F.split("path", "/", -1)
    folder = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/")
    marked = named.filter(F.col("own_license").isNotNull() & F.element_at(parts, -1).rlike(LICENSE_FILE))
    first = F.min(F.struct((-F.col("own_score")).alias("s"), F.col("own_license").alias("l")))
    folders = marked.groupBy(folder.alias("folder")).agg(first["l"].alias("folder_license"))
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("folder")))
    bare = named.filter(F.col("own_license").isNull() & F.col("path").isNotNull())
    reached = bare.select("id", "path", F.inline(above)).join(folders, "folder")
    nearest = reached.groupBy("id", "path").agg(F.max(F.struct("depth", "folder", "folder_license")).alias("n"))
    inherited = nearest.select(F.col("id").alias("_id"), F.col("path").alias("_path"), "n.folder", "n.folder_license")
    match = named["id"].eqNullSafe(inherited["_id"]) & named["path"].eqNullSafe(inherited["_path"])
    return named.join(inherited, match, "left").select(
        "id", "path", "own_license", "own_score", F.coalesce("own_license", "folder_license").alias("license"), F.col("folder").alias("license_dir")
    )
