"""Lexical search, personal data and the Merkle manifest against brute force: nulls, empty and very long texts, ties, repeated
rows, empty tables, additional columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripspark.llm import lexical, merkle, pii

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree long, block long, position long, size long, term string, df long, score long, kind string, row long, label string, start long"


def docs_frame(spark, rows):
    """Rows (doc_id, text, lang, source), with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), 1, 1, 1, 1, "x", 1, 1, "y", 1, "z", 1) for i, t, lang, s in rows], DOCS)


# ------------------------------------------------------------------ lexical search
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def ranked(docs, items, k=50):
    docs = [(i, Counter(TERM.findall(fold(t)))) for i, t in docs if i is not None]
    docs = [(i, c) for i, c in docs if c]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for item, text in items:
        if item is not None:
            asked[item] |= set(TERM.findall(fold(text)))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c in docs:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    stock = [f"w{int(rng.paretovariate(0.4)) % 3000}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(stock) for _ in range(rng.randrange(1, 200)))) for i in range(700)]
    rows += [(1000 + i, "same words in every copy w7 w9") for i in range(120)]  # ties
    rows += [(2000, None), (2001, ""), (2002, " -- \n"), (2003, "Été ÉTÉ été naïve"), (2004, "x" * 3_000_000 + " w7"), (2005, "w7 w9 " * 300_000), (None, "w7 w9")]
    return rows + [rows[0], rows[0], rows[701]]


def test_lexical_search(spark, corpus):
    rng = random.Random(6)
    items = [(i, " ".join(rng.sample(corpus[i][1].split(), min(12, len(corpus[i][1].split()))))) for i in range(40)]
    items += [(100, "w7 W9, w7"), (101, ""), (102, None), (103, "nowhere"), (104, "ÉTÉ Naïve"), (105, "w7"), (105, "w9 copy"), (None, "w7"), (106, corpus[705][1])]
    queries = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, score int, term string")
    want = ranked(corpus, items)
    docs = docs_frame(spark, [(i, t, "en", "s") for i, t in corpus]).repartition(5)
    for block_terms in (1 << 20, 2000):
        got = sorted(map(tuple, lexical.search(queries, lexical.build_index(docs, block_terms)).collect()))
        assert got == want


def test_lexical_search_empty(spark):
    docs, items = docs_frame(spark, []), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(items, lexical.build_index(docs)).collect() == []
    docs = docs_frame(spark, [(1, "a b", "en", "s")])
    assert lexical.search(items.limit(0), lexical.build_index(docs)).collect() == []
    assert [tuple(r)[:3] for r in lexical.search(items, lexical.build_index(docs)).collect()] == [(1, 1, 1)]


def test_lexical_skips_documents():
    """Windows give the same as all sums, whatever lists are short, and look at fewer documents once bounds allow."""
    rng = np.random.default_rng(3)
    ids, lengths = np.arange(5000), rng.integers(5, 400, 5000)
    block = lexical.BlockSearch(ids, lengths, 5000, int(lengths.sum()))
    for t in range(30):
        docs = np.sort(rng.choice(5000, size=int(5000 * rng.random() ** 3) + 1, replace=False)).astype(np.int32)
        block.add(f"t{t}", docs, rng.integers(1, 6, len(docs)).astype(np.int32))
    for trial in range(60):
        terms = [f"t{t}" for t in rng.choice(30, size=rng.integers(1, 12), replace=False)]
        weights = rng.integers(0, 3000, len(terms)).tolist()
        total = np.zeros(5000, np.int64)
        for t, w in zip(terms, weights, strict=True):
            docs, parts, _ = block.lists[t]
            total[docs] += w * parts
        best = np.lexsort((ids, -total))[:10]
        best = best[total[best] > 0]
        docs, scores = block.search(terms, weights, 10)
        assert docs.tolist() == best.tolist() and scores.tolist() == total[best].tolist()


def test_terms_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 50)
    rng = random.Random(9)
    for _ in range(200):
        text = "".join(rng.choice("ab Z0é-\n世") for _ in range(rng.randrange(0, 300)))
        assert [w.decode() for ws in lexical.terms_of(text.encode()) for w in ws] == TERM.findall(fold(text))


# ------------------------------------------------------------------ personal data
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, k, b, kind in sorted(out)]


def card(rng):
    digits = [rng.randrange(10) for _ in range(15)]
    return next("".join(map(str, digits)) + str(c) for c in range(10) if luhn("".join(map(str, digits)) + str(c)))


def personal_texts(rng, n):
    def one():
        kind = rng.randrange(6)
        if kind == 0:
            return f"mail {rng.choice(['jo', 'al.b', 'x_y'])}{rng.randrange(99)}@{rng.choice(['a', 'b-c'])}.example.org"
        if kind == 1:
            return "host " + ".".join(str(rng.randrange(300)) for _ in range(4))
        if kind == 2:
            return "card " + card(rng)
        if kind == 3:
            return f"call +1 ({rng.randrange(100, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
        if kind == 4:
            return f"number {rng.randrange(10**15, 10**16)}"
        return f"in {rng.randrange(3000)} we had {rng.random():.3f} of {rng.randrange(10**6)}"

    return [", ".join(one() for _ in range(rng.randrange(0, 8))) for _ in range(n)]


EDGES = [
    None, "", "no digits é 😀", "😀 a@b.co_x@d.e", "1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1 1.1.1.00000001", "a@b a@b. @b.c a@.c a..b@c.d-", "+1 ((((5 +12 (345) 678-90)",
    "x" * 2000, "1" * 2000, "1.2.3.4 " * 500, "a@" + "b." * 500 + "c", "+1 " + "(" * 500 + "5", "1 2 " * 500, "9" * 19 + " " + "0" * 12, "4111-1111-1111-1111 4111 1111 1111 1111",
]


@pytest.fixture(scope="module")
def personal(spark):
    rng = random.Random(8)
    texts = EDGES + personal_texts(rng, 2500)
    pairs = [f"paid card {card(rng)} {card(rng)} twice" for _ in range(5)]
    bad = [f"paid card {str(int(card(rng)) - 1)} {rng.randrange(10**9, 10**10)} twice" for _ in range(5)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts + pairs + bad)]
    rows += [rows[20], rows[20], (None, "card " + card(rng), "en", None)]
    found = pii.find_personal_data(docs_frame(spark, rows).repartition(4)).collect()
    return rows, found, range(len(texts), len(texts) + 5), range(len(texts) + 5, len(texts) + 10)


def test_personal_data_base(personal):
    rows, found, _, _ = personal
    want = Counter()
    for i, t, _, _ in rows:
        spans = base_spans(t or "")
        kinds = Counter(s.split(":")[0] for s in spans)
        want[i, *(kinds[k] for k in RULES), hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in found) == want
    for r in found:
        text = next(t for i, t, _, _ in rows if i == r["doc_id"]) or ""
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(base_spans(text)) <= set(spans)
        keys = [(int(s.split(":")[1]), list(RULES).index(s.split(":")[0])) for s in spans]
        assert keys == sorted(keys)


def test_personal_data_added(personal):
    rows, found, pairs, bad = personal
    spans = {r["doc_id"]: r["spans"].split(",") if r["spans"] else [] for r in found}
    for i in pairs:  # two cards in a row: one match of 32 digits for the rule
        assert [(int(s.split(":")[1]), int(s.split(":")[2])) for s in spans[i]] == [(10, 26), (27, 43)]
    for i in bad:  # numbers that fail the check
        assert spans[i] == []


def test_personal_data_nothing_to_learn(spark):
    rows = [(1, "just words", "en", "s"), (2, "a@b.c", "en", "s")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs_frame(spark, rows)).collect()}
    assert got == {1: "", 2: "email:0:5"}
    assert pii.find_personal_data(docs_frame(spark, [])).collect() == []


def test_personal_data_very_long_texts(spark):
    """Time in proportion to the length, where a backtracking search would take its square."""
    n = 1_000_000
    texts = {"x" * n: [], "1" * n: [], "a@" + "b." * n + "c": [(0, 0, 2 * n + 3)], "+1 " + "(" * n + "5": [], "1.2.3.4 " * 20_000: [(8 * i, 1, 8 * i + 7) for i in range(20_000)]}
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    found = {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["base"]] for r in pii.find_spans(docs_frame(spark, rows)).collect()}
    assert [found[i] for i in range(len(texts))] == list(texts.values())


def test_personal_data_is_native(spark):
    plan = pii._spans(pii._matches(docs_frame(spark, [(1, "a", "en", "s")]).withColumn("_text", F.col("text")), pii.BASE, "b_", False), pii.KINDS, "b_", False)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ manifest
def H(*digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def proofs(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def leaf(r):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    def path(tree, i):
        out = []
        for nodes in tree[:-1]:
            first = i - i % 16
            out.append((nodes[first:i], nodes[i + 1 : first + 16]))
            i //= 16
        return out

    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: levels([x[2] for x in sorted(groups[k], key=lambda x: x[:3])]) for k in names}
    top = levels([trees[k][-1][0] for k in names])
    out = []
    for g, k in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(groups[k], key=lambda x: x[:3])):
            climbed = path(trees[k], i) + path(top, g)
            claim = leaf((*r[:4], fold(r[4]) if r[4] is not None else None)) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else own
            for before, after in climbed:
                claim = H(*before, claim, *after)
            root = top[-1][0]
            out.append((r[0], own, trees[k][-1][0], root, H(*[x for pair in climbed for side in pair for x in side]), claim, claim == root))
    return sorted(out, key=str)


def manifest_rows(rng):
    rows = [(i, "hot" if i % 2 else rng.choice([None, "a", "é", "z", ""]), rng.choice(["en", None]), i, rng.choice(["Abc É", "x", None, "", "Q" * 50])) for i in range(9000)]
    rows += [(20_000 + i, f"s{i}", "en", 1, "T") for i in range(4200)]  # more sources than a block holds
    rows += [rows[3], rows[3], (None, "a", None, None, "N"), (30_000, "z", "en", 5_000_000, "Z" * 5_000_000)]
    rng.shuffle(rows)
    return rows


def test_merkle_manifest(spark):
    rows = manifest_rows(random.Random(2))
    for some in (rows, rows[:1], rows[:40]):
        frame = spark.createDataFrame([(*r, 7, 7, 7, 7, "x") for r in some], "doc_id long, source string, lang string, n_chars long, text string, tree long, block long, size long, position long, root string")
        got = sorted(map(tuple, merkle.verify_documents(frame.repartition(6)).collect()), key=str)
        assert got == proofs(some)
    assert merkle.verify_documents(frame.limit(0)).collect() == []


def test_van_emde_boas_addresses():
    for levels in range(1, 5):
        most = merkle.FAN ** (levels - 1)
        for leaves in {1, most, most // 2 + 1, max(1, most - 1), min(most, 17), min(most, 257)}:
            at = np.concatenate([merkle.addresses(levels, leaves, k, np.arange(-(-leaves // merkle.FAN**k))) for k in range(levels)])
            assert sorted(at.tolist()) == list(range(merkle.nodes_of(levels, leaves)))  # no gap, none twice
            assert at[-1] == 0  # the root
    # a bottom tree of a full block is contiguous: a parent, then its leaves
    parents, leaves = merkle.addresses(4, 4096, 1, np.arange(256)), merkle.addresses(4, 4096, 0, np.arange(4096))
    assert (leaves.reshape(256, 16) == parents[:, None] + 1 + np.arange(16)).all()
