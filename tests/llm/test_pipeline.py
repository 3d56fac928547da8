"""The corpus pipeline: each stage on what its predecessor kept, against brute force; edges; registration."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from tripspark.llm import jaccard_join, langid, mixing

SF001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def given(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select(*P.COLUMNS).collect()]
    long = max(rows, key=lambda r: len(r[1]))
    words = long[1].split()
    words[3] = "changed"
    rows += [(9000, long[1], "en", "src1", 1), (9001, " ".join(words), "en", None, 1), (9002, None, "en", "src1", 0), (9003, "", None, "src1", 0)]
    rows += [(9004, "12 34 !!", "en", "src2", 8), (9005, "ab", "en", "src2", 2), (None, "no id here at all", "en", "src3", 4), rows[0]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def stages(spark, given):
    out, docs = {}, given
    for name, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF001).collect(), stage(spark, docs, SF001).schema)
        out[name] = docs
    return out


def test_language_stage_rejects_only_text_without_letters(given, stages):
    kept = stages["language_id"]
    assert kept.columns == P.COLUMNS
    want = Counter((r.doc_id, r.text) for r in given.collect() if any(c.isalpha() for c in r.text or ""))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == want
    assert {r.lang for r in kept.collect()} <= {"en", "fr", "de", "es"}


def test_one_document_of_each_group_stays(stages):
    before, after = stages["language_id"].collect(), stages["near_duplicates"].collect()
    sets = {}
    for r in before:
        w = r.text.encode().lower().split()
        sets[r.doc_id, r.text] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    keys = sorted(sets, key=lambda k: (k[0] is None, k[0] or 0))
    group = {k: k for k in keys}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                group[root(b)] = root(a)
    assert Counter((r.doc_id, r.text) for r in after) == Counter(k for k in keys if root(k) == k)
    assert 9000 not in {r.doc_id for r in after} and 9001 not in {r.doc_id for r in after}


def test_mix_takes_whole_documents_in_proportion(stages):
    before, after = stages["near_duplicates"], stages["source_mix"]
    assert after.columns == P.COLUMNS
    counts = {r.doc_id: r for r in mixing.mixed_counts(before).collect()}
    copies = Counter(r.doc_id for r in after.collect())
    texts = {(r.doc_id, r.text) for r in before.collect()}
    assert {(r.doc_id, r.text) for r in after.collect()} <= texts
    for d, c in counts.items():
        share = c.taken / c.size if c.size else 0
        assert copies[d] in (int(share), int(share) + 1), (d, share, copies[d])


def test_pieces_decode_to_the_mixed_texts(stages):
    last = stages["encode_pieces"].collect()
    assert len(last) == stages["source_mix"].count() and all(r.lossless and r.n_pieces == len(r.piece_ids) > 0 for r in last)


def test_run_repeats_and_survives_empty_tables(spark, tmp_path):
    a, b = (sorted(str(r) for r in P.run(spark, SF001).collect()) for _ in range(2))
    assert a == b and a
    empty = str(tmp_path / "none")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{empty}/documents.parquet")
    assert P.run(spark, empty).count() == 0


def test_registered():
    keys = E.queries()
    assert {k.split("_")[0] for k in keys if k.startswith("op")} >= {f"op{n}" for n in range(1, 11)} and "pipeline" in keys
    assert len(P.STAGES) == 4 and P.ORACLE_SQL is None
    assert langid.UNDETERMINED == "und" and jaccard_join.SHINGLE_WORDS == 5


def test_random_texts_do_not_link(spark):
    rng = random.Random(0)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(50)), "en", "s", 1) for i in range(300)]
    out = P.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), SF001)
    assert out.count() == 300 and out.filter(F.col("text").isNull()).count() == 0


def test_unlike_rows_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(50)) for _ in range(4)]
    a, b, c, d = texts
    rows = [(5, a), (5, b), (5, a), (6, b + " tail"), (7, c), (8, c), (9, d), (9, d), (9, None), (9, ""), (None, a), (None, a)]
    out = P.drop_near_duplicates(spark, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA), SF001)
    want = Counter([(5, a), (5, b), (7, c), (9, d), (None, a), (None, a)])
    got = Counter((r.doc_id, r.text) for r in out.collect() if r.text)
    assert got == want and out.filter("doc_id = 9 AND coalesce(text, '') = ''").count() == 1  # null and empty are one text without words


def test_large_components(spark):
    from tripspark.llm import bsi_topk

    def search(rows):
        found = bsi_topk.search_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())

    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 1]) * 2.0 ** rng.uniform(0, 21) for _ in range(6)]) for i in range(120)] + [(150, [2.0**17] * 6), (200, [-(2.0**20)] * 6)]
    whole = {i: [int(256 * x // 1) for x in v] for i, v in rows}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        scores = sorted((-sum(x * y for x, y in zip(whole[q], whole[i], strict=True)), i) for i in whole if i != q)
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    assert search(rows) == sorted(want)
    assert search([(50, [2.0**29] * 2), (51, [2.0**16] * 2)]) == [(50, 1, 51, 2 * 2**37 * 2**24)]
    for rows in ([(50, [2.0**60]), (51, [1.0])], [(50, [2.0**40]), (51, [2.0**40])]):
        with pytest.raises(Exception, match="64 bits|too large|OverflowError"):
            search(rows)


def test_near_duplicates_meet_few_blocks(spark, monkeypatch):
    """Near copies in pairs; the first of each also shares nine rare words with the next pair's, which must not make one group of all."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 1500)
    rng = random.Random(31)
    stock = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    pairs = 40
    bodies, phrases = [stock(400) for _ in range(pairs)], [[stock(9) for _ in range(2)] for _ in range(pairs)]
    rows = []
    for i, body in enumerate(bodies):
        rows.append((2 * i, " ".join([body, *phrases[i], *phrases[i - 1]]), "en", "s", 1))
        rows.append((2 * i + 1, body, "en", "s", 1))
    moved, link = [], jaccard_join.link_groups

    def counted(dealt, threshold):
        moved.append(dealt.count())
        return link(dealt, threshold)

    monkeypatch.setattr(jaccard_join, "link_groups", counted)
    got = P.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(r.doc_id for r in got) == [2 * i for i in range(pairs)]
    assert sum(moved) <= 2 * len(rows)
