"""Every operator on small tables: brute force where SQL has no twin, and nulls, empty texts, ties, repeated rows,
empty tables and additional columns with clashing names."""

import hashlib
import itertools
import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from tripspark.llm import bsi_topk, chat_format, e8_dedup, graph, jaccard_join, langid, license_scan, mixing, piece_lattice, token_pack, warc
from tripspark.llm.files import opened
from tripspark.llm.graph import connected_components
from tripspark.llm.queries import QUERIES
from tripspark.llm.storage import fresh_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, label string, component string"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None, 1, "x", "y") for i, t, lang, s in rows], DOCS)


def words(rng, n, stock=400):
    return " ".join(f"w{rng.randrange(stock)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    rows = []
    for i in range(60):
        rows.append((i, words(rng, rng.randrange(1, 120)), "en", f"s{i % 4}"))
    base = words(rng, 80).split()
    for i in range(60, 90):  # near copies of one text
        copy = list(base)
        for _ in range(rng.randrange(0, 3)):
            copy[rng.randrange(80)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(copy), "en", "s0"))
    rows += [(90, None, None, None), (91, "", "en", "s1"), (92, " \n\t ", "en", None), (93, "a b", "fr", "s1"), (94, "A  b", "fr", "s1")]
    rows += [rows[0], rows[0], (None, "no id", "en", "s2"), (95, "one", "en", "s3"), (96, words(rng, 20_000), "en", "s3"), (97, "x" * 50_000, "en", "s3")]
    return rows


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1100)] + [(2000 + i, 2001 + i) for i in range(30)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_of_a_hub_spread_over_tasks(spark, monkeypatch):
    """A star of 100 000 links around a node that is not its smallest, with further nodes: right, and no task of a shuffle by node gets the star."""
    n, rounds = 100_000, []
    each = graph._round
    monkeypatch.setattr(graph, "_round", lambda links, bound: rounds.append((links, bound)) or each(links, bound))
    star = spark.range(1, n + 1).selectExpr("CASE WHEN id % 2 = 0 THEN id ELSE id + 1000000 END AS a", "500000L AS b")
    tail = spark.createDataFrame([(500000, -3), (-3, -9), (7000000, 7000001)], "a long, b long")
    got = connected_components(star.unionByName(tail))
    assert got.groupBy("component").count().orderBy("component").collect() == [(-9, n + 3), (7000000, 2)]
    links, bound = rounds[0]
    assert bound is not None
    both = links.unionByName(links.selectExpr("b AS a", "a AS b"))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("_rows"))
    shuffled = both.join(F.broadcast(least.filter(F.col("_rows") > graph.hot_rows(bound)).select("a")), "a", "left_anti")
    assert shuffled.groupBy("a").count().agg(F.max("count")).first()[0] <= graph.HOT_ROWS  # rows that go by node
    plan = each(links, bound)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4 and "LeftAnti" in plan


def test_join_totals_equals_a_join(spark, monkeypatch):
    monkeypatch.setattr(graph, "HOT_ROWS", 5)
    rng = random.Random(4)
    keys = [rng.choice([1, 1, 1, 2, None, *range(3, 40)]) for _ in range(300)]
    rows = spark.createDataFrame(list(zip(keys, range(300), strict=True)), "k long, v long")
    totals = rows.filter("k <> 7").groupBy("k").agg(F.count(F.lit(1)).alias("_rows"), F.max("v").alias("top"))
    got = Counter(tuple(r) for r in graph.join_totals(rows, totals, "k", 300).select("k", "v", "top").collect())
    assert got == Counter((k, v, max(w for j, w in zip(keys, range(300), strict=True) if j == k)) for k, v in zip(keys, range(300), strict=True) if k not in (None, 7))


# --- N-gram Jaccard join


def jaccard_brute(rows):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            up[root(j)] = root(i)
    names = defaultdict(list)
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            names[root(i)].append(d)
    return Counter((rows[i][0], len(sets[i]), min(names[root(i)], default=None)) for i in range(len(rows)))


@pytest.mark.parametrize("block", [1 << 18, 400])
def test_jaccard_join_equals_brute_force(spark, texts, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)  # 400: groups of several blocks
    got = jaccard_join.jaccard_join(docs_frame(spark, texts)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == jaccard_brute(texts)


def test_jaccard_join_of_frequent_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "RUN", 2)  # entries beyond a run are dealt out
    rng = random.Random(8)
    passage = words(rng, 40)
    rows = [(i, passage + " " + words(rng, rng.randrange(0, 30)), "en", "s") for i in range(80)]
    got = jaccard_join.jaccard_join(docs_frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == jaccard_brute(rows)


def test_jaccard_join_of_a_frequent_shingle_over_many_parts(spark):
    """100 sets share a shingle in one task, and most parts get none but entries from beyond its run."""
    rows = [(i, f"a b c d e z{i}", "en", "s") for i in range(100)] + [(100, "A b c d e z7", "en", "s"), (101, None, "en", "s")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        for threshold in ((jaccard_join.NUM, jaccard_join.DEN), (1, 3)):  # at 1/3 the common shingle alone links
            got = jaccard_join.jaccard_join(docs_frame(spark, rows).coalesce(1), threshold).collect()
            want = jaccard_brute(rows)
            if threshold == (1, 3):
                want = Counter((i, n, 0 if n else i) for i, n, _ in want.elements())
            assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_jaccard_join_shingles_shared_by_chance_connect_no_groups(spark, monkeypatch):
    """Pairs of near copies, of which one also shares a few rare shingles with some of other pairs: as one group, every text would meet all blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 2000)
    rng = random.Random(12)
    pairs = 60
    phrases = {(i, j): words(rng, 9, 10**6) for i in range(pairs) for j in ((i + 1) % pairs, (7 * i + 3) % pairs)}
    rows = []
    for i in range(pairs):
        body = [words(rng, 45, 10**6) for _ in range(10)]
        shared = [p for key, p in phrases.items() if i in key]
        rows.append((2 * i, " ".join(f"{b} {p}" for b, p in itertools.zip_longest(body, shared, fillvalue="")), "en", "s"))
        rows.append((2 * i + 1, " ".join(body), "en", "s"))
    moved, link = [], jaccard_join.link_groups

    def counted(dealt, threshold):
        moved.append(dealt.count())
        return link(dealt, threshold)

    monkeypatch.setattr(jaccard_join, "link_groups", counted)
    got = jaccard_join.jaccard_join(docs_frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == jaccard_brute(rows)
    assert sum(moved) <= 2 * len(rows)


def test_jaccard_join_with_long_lists_and_rounds(spark, monkeypatch):
    """Sets on both sides of SHORT, lists with more classes than are paired, and several rounds of blocks."""
    for name, value in (("BLOCK_SHINGLES", 400), ("PAIRED", 3), ("ROUND_SHINGLES", 1)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(21)
    passage = words(rng, 12, 10**6)
    rows = []
    for n in (9, 30, 100, 130, 150, 175, 230, 400):
        for _ in range(2):
            base = words(rng, n, 10**6).split()
            for _ in range(6):
                w = list(base)
                for _ in range(rng.randrange(0, max(2, n // 25))):
                    w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
                cut = rng.choice([0, 0, n // 5])
                rows.append((len(rows), " ".join(w[cut:] + rng.choice([[], [passage]])), "en", "s"))
    got = jaccard_join.jaccard_join(docs_frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == jaccard_brute(rows)


def test_jaccard_join_empty(spark):
    assert jaccard_join.jaccard_join(docs_frame(spark, [])).count() == 0


def test_t_occurrence_links_equal_all_pairs():
    rng = np.random.default_rng(0)
    for _ in range(40):
        base = [rng.integers(0, 2**63, 60).astype(np.uint64) for _ in range(4)]
        sets = []
        for _ in range(30):
            b = base[rng.integers(4)].copy()
            k = rng.integers(0, 14)
            b[rng.choice(60, k, False)] = rng.integers(0, 2**63, k).astype(np.uint64)
            sets.append(np.unique(b[: rng.integers(40, 61)]))
        forests = jaccard_join.Forest(30), jaccard_join.Forest(30)
        for a, b in jaccard_join.t_occurrence_links(sets, list(range(30)), (75, 100)):
            forests[0].join(a, b)
        for i, j in itertools.combinations(range(30), 2):
            c = len(np.intersect1d(sets[i], sets[j]))
            if 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
                forests[1].join(i, j)
        same = [[f.root(i) == f.root(j) for i, j in itertools.combinations(range(30), 2)] for f in forests]
        assert same[0] == same[1]


# --- E8 lattice


def test_e8_decoder_finds_the_nearest_point():
    roots = e8_dedup.e8_roots()
    assert len({tuple(r) for r in roots}) == 240 and set((roots**2).sum(axis=1)) == {8}
    x = np.random.default_rng(1).normal(size=(500, 8)) * 2
    own = e8_dedup.e8_nearest(x)
    assert all((p % 2 == p[0] % 2).all() and p.sum() % 4 == 0 for p in own)
    gap = ((x - own / 2) ** 2).sum(axis=1)
    assert (gap <= 1 + 1e-9).all()  # the covering radius
    assert all((((x - (own + r) / 2) ** 2).sum(axis=1) >= gap - 1e-9).all() for r in roots)


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "c") for i, v, label in rows], "vec_id long, embedding array<float>, label int, node long, cid string")


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(e8_dedup, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    rows = []
    for c in range(60):
        centre = rng.normal(size=64)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((len(rows), (centre + rng.normal(size=64) * 0.09).astype(np.float32).tolist(), int(c % 3)))
    rows += [rows[0], (len(rows), rows[3][1], rows[3][2]), (900, rows[5][1], None), (901, None, 1), (902, [0.0] * 64, 1), (903, [float("nan")] * 64, 1)]
    rows += [(904, [None] * 64, 1), (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1), (907, [], 1), (None, rows[7][1], rows[7][2])]
    got = e8_dedup.near_duplicates(embeddings(spark, rows)).collect()
    n = len(rows)

    def unit(v, label):
        if v is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float32).astype(float)
        return x / np.sqrt(x @ x)

    units = [unit(v, label) for _, v, label in rows]
    links, up = [set() for _ in rows], list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(n), 2):
        if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98:
            links[i].add(j), links[j].add(i)
            up[max(root(i), root(j))] = min(root(i), root(j))
    ids = defaultdict(list)
    for i in range(n):
        if rows[i][0] is not None:
            ids[root(i)].append(rows[i][0])
    want = Counter((rows[i][0], len(links[i]), min(ids[root(i)], default=None)) for i in range(n))
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert e8_dedup.near_duplicates(embeddings(spark, [])).count() == 0


def test_lattice_recall_on_the_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    label = np.array([r["label"] for r in rows])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    want = {r["vec_id"]: int(n) - 1 for r, n in zip(rows, linked.sum(axis=1), strict=True)}
    got = {r["vec_id"]: r["n_links"] for r in e8_dedup.near_duplicates(table).collect()}
    assert got == want


# --- WARC


def test_warc_round_trip_and_random_access(spark):
    import zstandard

    rng = random.Random(2)
    pages = [(i, f"http://h/{i} a\r\nX: y", f"<html>{words(rng, 200)}</html>", "z") for i in range(300)]
    pages += [(300, None, pages[4][2], "z"), (301, "u", pages[4][2], "z"), (302, "u", None, "z"), (303, "u", "", "z"), (None, "u", pages[7][2], "z"), (305, "é", "é" * 90_000, "z")]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, payload string, sha1 string")
    manifest = warc.write_archives(frame, fresh_path(spark, "test-warc"))
    got = warc.read_archives(manifest, with_payload=True).collect()
    newest = {}
    for i, _, h, _ in pages:
        newest[h or ""] = max(newest.get(h or "", -1), -1 if i is None else i)
    assert len(got) == len(pages)
    by_id = {r["page_id"]: r for r in got}
    for i, _, h, _ in pages:
        r, data = by_id[i], (h or "").encode()
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == warc.base32_digest(hashlib.sha1(data).digest())
        if newest[h or ""] == i:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, data)
        else:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", newest[h or ""], None)
    path = max(manifest.collect(), key=lambda r: r["bytes"])["path"]
    with opened(path) as f:
        data = f.read()
    magic, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    assert magic == 0x184D2A5D
    decompressor, at, records = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])), 8 + size, 0
    while at < len(data):  # every record is a frame of its own
        one = decompressor.decompressobj()
        assert one.decompress(data[at:]).startswith(b"WARC/1.1\r\n")
        at, records = len(data) - len(one.unused_data), records + 1
    assert records == sum(1 for r in manifest.collect() if r["path"] == path for _ in range(r["records"]))


def test_warc_small_payloads_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archive_pages(frame, min_bytes=4).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}
    assert warc.archive_pages(frame.limit(0)).count() == 0


# --- bit-sliced index


def test_signed_digits_and_adders():
    for n in range(-300, 300):
        d = bsi_topk.signed_digits(n)
        assert sum(x << i for i, x in enumerate(d)) == n and all(not (a and b) for a, b in zip(d, d[1:]))
    rng = np.random.default_rng(0)
    maps = [[rng.integers(0, 2**63, 3).astype(np.uint64) for _ in range(rng.integers(0, 9))] for _ in range(6)]
    want = sum(np.unpackbits(m.view(np.uint8), bitorder="little").astype(int) << w for w, ms in enumerate(maps) for m in ms)
    got = sum(np.unpackbits(s.view(np.uint8), bitorder="little").astype(int) << w for w, s in enumerate(bsi_topk.add_slices([list(m) for m in maps])) if s is not None)
    assert (want == got).all()


def test_bsi_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(bsi_topk, "BLOCK_ROWS", 100)
    monkeypatch.setattr(bsi_topk, "CHUNK_QUERIES", 3)
    rng = np.random.default_rng(6)
    rows = [(i, np.round(rng.normal(size=5), 1).astype(np.float32).tolist(), 1) for i in range(600)]  # many ties
    rows += [rows[50], rows[3], (700, None, 1), (750, [1.0, None, 1.0, 1.0, 1.0], 1), (800, [float("inf")] * 5, 1), (850, [0.0] * 5, None), (900, [1.0, 2.0], 1), (902, [3.0, 2.0], 1), (950, [], 1), (None, [1.0] * 5, 1)]
    rows += [(1000, [1000.0, -1000.0, 0.0, 0.5, 0.0], 1)]
    valid = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, qv in dict(valid).items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in valid if i != q and len(v) == len(qv))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in bsi_topk.search_embeddings(embeddings(spark, rows)).collect()]
    assert sorted(got) == sorted(want)
    assert bsi_topk.search_embeddings(embeddings(spark, [])).count() == 0


# --- mixing


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 3, 10, 1000):
        out = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5), F.lit("k")).alias("p")).collect()
        assert sorted(r["p"] for r in out) == list(range(n))
    assert [r["p"] for r in spark.range(1000).select(mixing.permuted(F.col("id"), F.lit(1000).cast("long"), F.lit(5)).alias("p")).collect()] != list(range(1000))


def expected_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    full = {}
    while True:
        rest = sum(sizes.values()) - sum(full.values())
        total = sum(weight[s] for s in order if s not in full)
        share = {s: rest * weight[s] / total for s in order if s not in full} if total else {}
        over = [s for s in share if share[s] > cap * sizes[s] * (1 + 1e-12)]
        if not over:
            return full | share
        full |= {s: cap * sizes[s] for s in over}


def test_mixed_counts(spark, texts):
    rows = texts + [(200 + i, words(random.Random(i), 300), "en", "s2") for i in range(40)] + [(300, "few words here", "en", "a")]
    got = mixing.mixed_counts(docs_frame(spark, rows), block_words=8, shard_slots=256).collect()
    size = lambda t: len((t or "").encode().split())
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, size(t)) for d, t, *_ in rows)
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += size(t)
    target, source = expected_targets(dict(sizes)), {}
    for d, _, _, s in rows:
        source.setdefault(d, s)
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s], rel=1e-9) and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.05 * t + 16, (s, taken[s], t)
    again = mixing.mixed_counts(docs_frame(spark, rows).repartition(5), block_words=8, shard_slots=256).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mixed_counts(docs_frame(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mixed_counts(docs_frame(spark, [(1, None, "en", "s")])).collect()] == [0]


def test_written_mix_holds_every_word_it_counts(spark, texts, tmp_path, monkeypatch):
    """The query writes blocks of words; ``taken`` is what they hold, for repeated rows and ids, null ids and long texts too."""
    rows = texts + [(7, "other words of seven", "en", "s2"), (7, "other words of eight", "en", "s2"), (None, "no id", "en", "s2"), (None, "no id", "en", None)]
    docs_frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    written = {}
    monkeypatch.setattr(mixing, "materialize", lambda df, name, f=mixing.materialize, **o: written.setdefault(name, f(df, name, **o)))
    got = QUERIES["op4_mix_sources"](spark, str(tmp_path)).collect()
    mix = written["mix-blocks"].collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in rows)
    stream = defaultdict(Counter)  # of an id, the words the mix holds
    for b in mix:
        at = 0
        for p in b["parts"]:
            stream[p["doc_id"]].update(b["tokens"][at : at + p["words"]])
            at += p["words"]
        assert at == len(b["tokens"]) <= mixing.BLOCK_WORDS
    own, taken = defaultdict(Counter), Counter()
    for i, t, *_ in rows:
        own[i].update((t or "").split())
    for r in got:
        taken[r["doc_id"]] += r["taken"]
    assert all(taken[i] == sum(stream[i].values()) and stream[i].keys() <= own[i].keys() for i in own)
    assert all(n <= mixing.MAX_REPEATS * own[i][w] for i in stream for w, n in stream[i].items())
    monkeypatch.undo()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed_counts(docs_frame(spark, rows)).collect()))
    assert mixing.mix_documents(docs_frame(spark, [])).count() == 0


def test_mixed_blocks_hold_the_counted_words(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(f"d{i}_{k}" for k in range(rng.randrange(1, 60)))[:], "en", f"s{i % 3}") for i in range(60)]
    blocks = mixing.mixed_blocks(docs_frame(spark, rows), block_words=16, shard_slots=64).collect()
    counts = Counter(w.split("_")[0] for b in blocks for w in b["tokens"])
    got = mixing.mixed_counts(docs_frame(spark, rows), block_words=16, shard_slots=64).collect()
    assert {f"d{r['doc_id']}": r["taken"] for r in got if r["taken"]} == dict(counts)
    assert max(len(b["tokens"]) for b in blocks) == 16
    mixed = mixing.mixed_documents(docs_frame(spark, rows), block_words=16, shard_slots=64)
    assert mixed.columns == docs_frame(spark, []).columns and {r["text"] for r in mixed.collect()} <= {t for _, t, *_ in rows}


# --- packed ids


def test_pack_and_unpack_every_width():
    rng = np.random.default_rng(0)
    for vocabulary in (2, 3, 300, 49408, 70_000, 2**20):
        bits = token_pack.bits_for(vocabulary)
        ids = rng.integers(0, vocabulary, 1001).astype(np.uint32)
        data = token_pack.pack(ids, bits)
        assert len(data) == -(-1001 * bits // 8) and (token_pack.unpack(data, bits, 1001) == ids).all()


def test_packed_files(spark, texts, tmp_path):
    from tokenizers import Tokenizer

    odd = "It's <|endoftext|> a b c \x1c d́ ́e ﬁ İ ９ don't\t x\r\ny  z"
    rows = texts + [(400, odd, "en", "s"), (401, "<|startoftext|>" + odd, "en", "s")]
    frame = docs_frame(spark, rows)
    got = token_pack.pack_documents(frame, WORDS).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(WORDS)
    start, want = 0, []
    for d, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    manifest = token_pack.write_packed(frame, WORDS, fresh_path(spark, "test-ids")).collect()
    with opened(manifest[-1]["path"]) as f:
        packed = token_pack.PackedFile(f)
        whole = packed.ids(0, packed.n_ids)
        assert packed.bits == 16 and (packed.ids(5, 9) == whole[5:9]).all()
    assert token_pack.pack_documents(docs_frame(spark, []), WORDS).count() == 0


def test_packed_file_blocks():
    import io

    out, rng = io.BytesIO(), np.random.default_rng(0)
    writer, docs = token_pack.PackedWriter(out, 5000, block_ids=16), [rng.integers(0, 5000, n).astype(np.uint32) for n in (3, 0, 40, 16, 1, 100)]
    for i, d in enumerate(docs):
        writer.add(None if i == 1 else i, d)
    writer.close()

    class Memory:
        def size(self):
            return len(out.getvalue())

        def read_at(self, n, at):
            return out.getvalue()[at : at + n]

    packed = token_pack.PackedFile(Memory())
    got = list(packed.documents(group_ids=20))
    assert [g[0] for g in got] == [0, None, 2, 3, 4, 5]
    assert all((g[2] == d).all() and len(g[2]) == len(d) for g, d in zip(got, docs))
    whole = np.concatenate(docs)
    assert all((packed.ids(a, b) == whole[a:b]).all() for a, b in ((0, 1), (15, 17), (16, 32), (100, 160)))


# --- licences


def test_licences_are_found_and_inherited(spark):
    line = "Licensed under the Apache License, Version 2.0."
    rng = random.Random(4)
    filler = [(100 + i, f"z/{i}.txt", words(rng, 50)) for i in range(60)]
    rows = [
        (1, "a/LICENSE", f"some words\n{line}\nmore"), (2, "a/b/x.txt", "nothing here"), (3, "a/b/COPYING.txt", "Released under the MIT License."),
        (4, "a/b/c/y.txt", None), (5, "other/y.txt", ""), (6, None, "text"), (7, "a/z.txt", "Licensed under CC BY-NC 4.0."), (8, "top.txt", "x"),
        (9, "a/b/apache.txt", "the apache people"), (10, None, line),
    ]
    frame = spark.createDataFrame([(*r, "k", 1.0) for r in rows + filler], "id long, path string, text string, license string, score double")
    got = {r["id"]: (r["own_license"], r["license"], r["license_dir"]) for r in license_scan.scan_licenses(frame).collect()}
    assert got[1] == ("Apache-2.0", "Apache-2.0", None) and got[2] == (None, "MIT", "a/b") and got[3][:2] == ("MIT", "MIT")
    assert got[4] == (None, "MIT", "a/b") and got[5] == got[6] == got[8] == (None, None, None) and got[7][0] == "CC-BY-NC-4.0"
    assert got[9] == (None, "MIT", "a/b") and got[10][0] == "Apache-2.0" and got[100] == (None, None, None) and len(got) == len(rows) + 60
    assert license_scan.scan_licenses(frame.limit(0)).count() == 0


def license_units(text, vocabulary):
    """The text, its lines, its paragraphs and its runs of licence-like lines, as term counts."""
    lines = [re.findall(license_scan.TERM, x) for x in text.lower().split("\n")]
    units = [[t for x in lines for t in x], *lines]
    for kept in ([(x, bool(x)) for x in lines], [(x, 2 * sum(t in vocabulary for t in x) >= len(x)) for x in lines if x]):
        run = []
        for terms, stays in [*kept, ([], False)]:
            if stays:
                run = run + terms
            elif run:
                units.append(run)
                run = []
    return [Counter(u) for u in units if u]


def license_brute(rows):
    """Every unit against every template."""
    found = lambda text: Counter(re.findall(license_scan.TERM, (text or "").lower()))
    df = Counter(t for _, text in rows for t in found(text))
    notices = [(k, found(t)) for k, t in license_scan.TEMPLATES]
    vocabulary = {t for _, tf in notices for t in tf}
    idf = lambda t: math.log((1 + len(rows)) / (1 + (df[t] if t in vocabulary else 0))) + 1
    norm = lambda tf: math.sqrt(sum((n * idf(t)) ** 2 for t, n in tf.items()))
    norms = [norm(notice) for _, notice in notices]
    out = {}
    for i, text in rows:
        scores = [
            (-round(sum(n * tf[t] * idf(t) ** 2 for t, n in notice.items()) / norm(tf) / long, 6), k)
            for tf in license_units(text or "", vocabulary)
            for (k, notice), long in zip(notices, norms, strict=True)
        ]
        score, name = min(scores, default=(0, None))
        out[i] = name if -score >= license_scan.COSINE else None
    return out


def wrapped(text, prefix, width=60):
    return "\n".join(f"{prefix} {x}" for x in textwrap.wrap(text, width))


def test_texts_and_headers_of_the_common_licences(spark):
    """Each template wrapped in comments above code, in a file of its own, and cut into paragraphs: the licence named, no other."""
    rng = random.Random(8)
    code = "\n".join(f"x{i} = call_{rng.randrange(90)}(y{i}, 'z{i}')" for i in range(40))
    rows, want = [], {}
    for k, t in license_scan.TEMPLATES:
        sentences = t.replace(". ", ".\n\n")
        for text in (wrapped(t, " *") + "\n" + code, "Copyright (c) 2019 Some One\n\n" + t, code + "\n\n" + wrapped(t, "#") + "\n#\n" + code, code + "\n" + sentences):
            want[len(rows)] = (k, t)
            rows.append((len(rows), text))
    plain = [(1000 + i, words(rng, 300)) for i in range(100)] + [(2000, code), (2001, "the terms of use\nare for any purpose\nand without fee")]
    got = dict(license_scan.own_licenses(spark.createDataFrame(rows + plain, "id long, text string")).select("id", "own_license").collect())
    assert got == {i: k for i, k in license_brute(rows + plain).items() if k}
    missed = [(k, t[:40], i % 4) for i, (k, t) in want.items() if got.get(i) != k]
    assert not missed and not set(got) - set(want)


def test_scans_of_long_texts_ties_and_repeated_rows(spark):
    mit = dict(license_scan.TEMPLATES)["MIT"]
    blank = "\n" * 200_000  # many empty lines
    rng = random.Random(3)
    long = "\n".join(words(rng, 12) for _ in range(30_000)) + blank + wrapped(mit, "//")
    twice = (("B-1", "alpha beta gamma delta"), ("A-1", "alpha beta gamma delta"))  # equal templates: the first by name
    frame = spark.createDataFrame([(1, long), (2, mit), (3, None), (4, "")], "id long, text string")
    got = dict(license_scan.own_licenses(frame).select("id", "own_license").collect())
    assert got == {1: "MIT", 2: "MIT"}
    tied = spark.createDataFrame([(1, "x\nAlpha beta gamma delta"), (2, "none")], "id long, text string")
    assert dict(license_scan.own_licenses(tied, twice).select("id", "own_license").collect()) == {1: "A-1"}


def test_frequent_notices_are_found(spark):
    rng = random.Random(14)
    line = "Released under the MIT License."
    stock = [w for _, t in license_scan.TEMPLATES for w in t.split()] + [f"w{i}" for i in range(12)]
    third = [(i, f"{words(rng, 20)}\n{line}" if i % 3 == 0 else words(rng, 20)) for i in range(60)]
    near = [(i, "\n".join(" ".join(rng.choice(stock) for _ in range(rng.randrange(2, 9))) for _ in range(6))) for i in range(200)]
    near += [(200 + i, dict(license_scan.TEMPLATES)["CC0-1.0"].rsplit(" ", i % 9)[0]) for i in range(100)]
    for rows in (third, [(1, line)], [(1, line), (2, "the first"), (3, None)], near):
        got = dict(license_scan.own_licenses(spark.createDataFrame(rows, "id long, text string")).select("id", "own_license").collect())
        assert {i: got.get(i) for i, _ in rows} == license_brute(rows)
        assert got


# --- language ID


def rank_order_brute(text, profiles, k):
    letters = [c.lower() for c in text]
    letters = list("".join(letters))
    tokens = "".join(c if c.isalpha() else " " for c in letters).split()
    counts = Counter()
    for t in tokens:
        marked = [1, *[ord(c) + 2 for c in t], 1]
        for c in marked[1:-1]:
            counts[c] += 1
        for a, b, c in zip(marked, marked[1:], marked[2:]):
            counts[a << 42 | b << 21 | c] += 1
    # pairs: the marks between two words are one code
    chain = [1]
    for t in tokens:
        chain += [*[ord(c) + 2 for c in t], 1]
    for a, b in zip(chain, chain[1:]):
        counts[a << 21 | b] += 1
    own = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]]
    best = None
    for lang in sorted(profiles):
        d = sum(abs(profiles[lang][g] - i) if g in profiles[lang] else k for i, g in enumerate(own))
        if best is None or d < best[0]:
            best = (d, lang)
    return best[1], 1 - best[0] / (k * len(own))


def test_language_id_equals_brute_force_and_generalises(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in langid.identify(table).collect()}
    rows = table.collect()
    assert len(got) == len(rows) and all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r["doc_id"]]["held_out"]]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    profiles = defaultdict(dict)
    for r in langid.language_profiles(table.filter(~langid.held_out())).collect():
        profiles[r["lang"]][r["gram"]] = r["rank"]
    for r in rows[:60]:
        lang, score = rank_order_brute(r["text"], profiles, langid.PROFILE)
        assert got[r["doc_id"]]["lang_pred"] == lang and got[r["doc_id"]]["score"] == pytest.approx(score)


def test_language_id_edges(spark, texts):
    rows = texts + [(500, "123 ... 456", "en", "s"), (501, "ÀÉ", "fr", "s"), (502, "日本語 text", "ja", "s")]
    frame = docs_frame(spark, rows)
    got = langid.identify(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (90, 91, 92, 500):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] != "und"
    assert langid.identify(docs_frame(spark, [])).count() == 0
    assert {r["lang_pred"] for r in langid.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --- chat formatting


def test_chat_round_trip(spark):
    bad = ["\\### Assistant: </turn> ok", "</part>\\", "\\b\\h\\l\\c", "#### x", "### user: hi</turn>\n### ", "", None, "a\nb", "é😀" * 3000]
    rows = [(c, t, role, bad[(c + t) % len(bad)], "x", True) for c in range(9) for t, role in enumerate(["system", "user", "user", "assistant", "assistant", None, "tool: x"])]
    rows += [rows[3], (None, 1, "assistant", "no conversation", "x", True), (50, None, "assistant", "z", "x", True), (50, None, "assistant", "a", "x", True)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, loss boolean").repartition(7)
    formatted = chat_format.format_conversations(frame)
    read = {r["conv_id"]: r for r in formatted.select("conv_id", "formatted", "segments", chat_format.parse(F.col("formatted")).alias("turns")).collect()}
    digests = {r["conv_id"]: r for r in chat_format.digest_conversations(formatted).collect()}
    by_conv = defaultdict(list)
    for c, t, role, text, *_ in rows:
        by_conv[c].append((t if t is not None else -1, role or "", text or ""))
    assert set(read) == set(by_conv)
    for c, turns in by_conv.items():
        turns.sort()
        assert [(x["role"], x["text"]) for x in read[c]["turns"]] == [(r, t) for _, r, t in turns]
        assert "".join(s["text"] for s in read[c]["segments"]) == read[c]["formatted"]
        loss = "".join(t for _, r, t in turns if r == "assistant")
        d = digests[c]
        assert (d["n_turns"], d["loss_chars"], d["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert d["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        runs = sum(1 for k, _ in itertools.groupby(r for _, r, _ in turns))
        assert read[c]["formatted"].count("</turn>\n") == runs and d["formatted_chars"] == len(read[c]["formatted"])
    assert chat_format.digest_conversations(chat_format.format_conversations(frame.limit(0))).count() == 0


# --- piece lattice


def test_pieces_are_lossless_and_reproducible(spark, texts):
    odd = ["  two  spaces ", "\n\n a\n b", "▁mark ▁▁", "日本語テキスト", "\x00\x01́ \U0001f600", "tab\tend\r\n", " "]
    rows = texts + [(600 + i, t, "en", "s") for i, t in enumerate(odd)]
    frame = docs_frame(spark, rows).withColumn("piece_ids", F.lit(1))
    encoded = piece_lattice.encode_pieces(frame, PIECES)
    got = piece_lattice.decode_pieces(encoded, PIECES).collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in got) == Counter((d, t) for d, t, *_ in rows)
    again = piece_lattice.encode_pieces(frame.repartition(5), PIECES).collect()
    assert sorted((str(r["doc_id"]), str(r["piece_ids"])) for r in got) == sorted((str(r["doc_id"]), str(r["piece_ids"])) for r in again)
    both = piece_lattice.encode_pieces(frame, PIECES, decoded=True).collect()
    assert sorted((str(r["doc_id"]), str(r["piece_ids"]), str(r["decoded"])) for r in both) == sorted((str(r["doc_id"]), str(r["piece_ids"]), str(r["decoded"])) for r in got)
    prose = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    drawn = [{r["doc_id"]: r["piece_ids"] for r in piece_lattice.encode_pieces(prose, PIECES, seed=s).collect()} for s in (1, 2)]
    assert sum(drawn[0][d] != drawn[1][d] for d in drawn[0]) > 0.9 * len(drawn[0])
    assert piece_lattice.encode_pieces(docs_frame(spark, []), PIECES).count() == 0


def test_samples_follow_the_lattice():
    vocabulary = piece_lattice.Vocabulary(["<unk>", "<0x62>", "a", "aa", "▁a", "aaa", "▁", "c", "<0x63>", "▁aa"], [0])
    text = "aaaa"
    weight = {p: (i + 2.0) ** -1 for i, p in enumerate(["<unk>", "<0x62>", "a", "aa", " a", "aaa", " ", "c", "<0x63>", " aa"])}

    def paths(rest):
        if not rest:
            yield (), 1.0
        for p, w in weight.items():
            if rest.startswith(p):
                for tail, v in paths(rest[len(p) :]):
                    yield (p, *tail), w * v

    every = dict(paths(" " + text))
    sampler, seen, n = piece_lattice.Sampler(vocabulary), Counter(), 20_000
    for ids in piece_lattice.encode_texts(sampler, [text] * n, [piece_lattice.row_key(i, 9) for i in range(n)]):
        seen[tuple(vocabulary.bytes_of[i].decode() for i in ids)] += 1
    assert set(seen) <= set(every)
    for path, w in every.items():
        share = w / sum(every.values())
        assert abs(seen[path] / n - share) < 4 * math.sqrt(share / n) + 1e-3
    (ids,) = piece_lattice.encode_texts(sampler, ["b"], [1])
    assert ids.tolist() == [6, 1]


def test_very_long_texts_and_units(monkeypatch):
    """Runs of units give the draws of the whole; a unit in windows has the shares of its lattice; 16 MB, and 4 MB without a space, stay small."""
    import resource
    import time

    vocabulary = piece_lattice.Vocabulary(*piece_lattice.load_pieces(PIECES))
    sampler = piece_lattice.Sampler(vocabulary)
    rng = random.Random(4)
    text = "".join(rng.choice(["the ", "  a", "\n", " é世", "ing", " re", "x"]) for _ in range(4000))
    whole = piece_lattice.encode_texts(sampler, [text], [77])[0]
    monkeypatch.setattr(piece_lattice, "RUN_CHARS", 500)
    assert (piece_lattice.encode_texts(piece_lattice.Sampler(vocabulary), [text, text[:40]], [77, 5])[0] == whole).all()
    monkeypatch.undo()
    monkeypatch.setattr(piece_lattice, "ADD_CHARS", 50)  # new units, a few at a time
    assert (piece_lattice.encode_texts(piece_lattice.Sampler(vocabulary), [text, text[:40]], [77, 5])[0] == whole).all()
    monkeypatch.undo()
    unit = " thererethinging"
    monkeypatch.setattr(piece_lattice, "WINDOW", 5)
    n = 4000
    keys = piece_lattice.mixed(np.arange(n, dtype=np.uint64))
    windows = Counter(tuple(sampler.sample_long(unit, k).tolist()) for k in keys)
    ids, count = sampler.sample([unit] * n, keys)
    direct = Counter(tuple(x.tolist()) for x in np.split(ids, np.cumsum(count)[:-1]))
    for path, m in direct.most_common(5):
        assert abs(windows[path] - m) < 5 * math.sqrt(2 * m) + 5
    monkeypatch.undo()
    for t in (" ".join(f"w{rng.randrange(10**6)}" for _ in range(2_000_000)), "".join(rng.choice("abcdeé") for _ in range(4_000_000))):
        before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
        found = piece_lattice.encode_texts(piece_lattice.Sampler(vocabulary), [t, "short"], [3, 4])
        assert piece_lattice.decode_ids(vocabulary, found[0]) == t and piece_lattice.decode_ids(vocabulary, found[1]) == "short"
        print(len(t), round(time.time() - start, 1), "s", (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10, "MB more")
        assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20
