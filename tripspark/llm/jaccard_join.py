"""N-gram Jaccard join: documents whose sets of word shingles have similarity of at least ``num / den``.

1. *Sets.* Every document becomes its set of distinct word 5-shingles (64-bit hashes). Documents with equal
   sets are one class from here on.
2. *Lists.* If n shingles need an overlap of T = ceil(n * num / den), then of any p = n - T + 1 of them at least
   one is shared. In a global order of the shingles the first shared one is therefore among the first p of
   both sets. The order puts a fixed fraction ``LISTED`` of the hash space first, so a set sends only that part
   to the inverted lists (or all of it, when the part is shorter than p). Lists with one class are dropped;
   within the part, rare shingles come before frequent ones, and of each set the first p keep their lists. A
   set whose unshared shingles already exceed n - T has none left, and can link with nothing. Of any n - T + k
   shingles at least k are shared, so the first n - T + k are kept (``pair_lists``), and a pair has to meet in k lists.
   The part of a small set is too small for that: pairs with a set below ``SHORT`` have lists of their own, with
   all shingles, rare ones first; sets that can be in both kinds of pairs send to both.
3. *Groups.* Pairs that meet in k kept lists form groups, so a few shingles that unlike sets share by chance connect nothing,
   however many documents there are. Of a list with more than ``PAIRED`` classes the pairs are not counted: it connects those
   of its classes that have as many such lists as a partner could ask for, and the others' pairs need fewer lists by as
   many as they have. A pair that links is always inside a group.
4. *T-occurrence search* (DivideSkip) inside a group, in blocks of about ``BLOCK_SHINGLES`` shingles: of the
   inverted lists of a set the longest are set aside, the short ones are merged and sets that occur fewer than
   T minus the number of long lists times are dropped; the others are looked up in the long lists by binary
   search, and those that reach the required overlap link. Merging is one sort of the concatenated sorted
   lists in numpy (what a heap does element by element, without an interpreted step for each).
   Groups of several blocks are searched block by block first, then among the remaining representatives, and
   last in all pairs of blocks of similar sizes, with only those sets that still meet a set of another component in k
   lists (of all shingles of these groups' sets, rare ones first), in rounds that each shuffle about ``ROUND_COPIES`` times the shingles.
5. Links (a spanning forest of them from each block) give components.

Inside tasks a shingle of very many documents is sent as a bounded run of entries, with a count; the entries beyond
are dealt out by document, so one shingle's documents never meet in one task until the lists are
thinned. Hashes: a set's 64-bit shingle hashes decide links; 48-bit codes only route.

Defined cases: null, empty or blank text has the empty set, which links with nothing; fewer than five words
are one shingle; a null ``doc_id`` is smaller than none, so it names a component only if all its ids are null;
repeated rows link (equal sets) and each is returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.graph import Forest, connected_components, groups_of, join_totals, star_links
from tripspark.llm.hashing import mixed
from tripspark.llm.storage import lean, materialize, small_batches, worker_state

SHINGLE_WORDS = 5
NUM, DEN = 75, 100
LISTED = 5 / 16  # of the hash space comes first in the order; above 1 - num / den, so that most sets need no more
CODE_BITS = 48
CUT = int(LISTED * 2**CODE_BITS)
WHOLE = 1 << CODE_BITS  # added to the codes of the lists for pairs with a small set
SHORT = 128  # shingles of a set that is not small
PAIR_LISTS = 8  # listed shingles that a pair is to share at most
PAIRED = 16  # classes of a list up to which its pairs are counted
ROUND_COPIES = 2  # times that the shingles of the large groups are shuffled in a round
ROUND_SHINGLES = 1 << 24  # or so many of them, if that is more
RUN = 32  # entries of one shingle that one task sends to its list
FLUSH_ENTRIES = 1_000_000
BLOCK_SHINGLES = 1 << 17
BROADCAST_CLASSES = 500_000  # ids, classes, groups and blocks (32 bytes each) up to which the wanted documents are found without shuffling all texts
LONG_LIST_WEIGHT = 0.05  # DivideSkip's mu: the number of long lists is T / (mu * log2(longest) + 1)


class WordHashes(dict):
    """64-bit hashes of words, kept for a bounded number of them by a worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, hashes: WordHashes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of A-Z lower-cased words; bytes.split() cuts at exactly 0x20 and 0x09-0x0D."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(n, width)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = (out + h[i : n - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
    out = np.sort(mixed(out))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    """One text at a time: a batch of long texts is never a list of strings as well."""
    return (x.as_py() for x in batch.column("text"))


def _kept_sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    return (np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("hashes"))


def _digest(s: np.ndarray) -> tuple[int, bytes]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), d


def _word_hashes() -> WordHashes:
    return worker_state("jaccard_join").setdefault("words", WordHashes())


MEASURED = "doc_id long, n_shingles long, cls long, digest binary, codes int, listed int"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _word_hashes()
    for batch in batches:
        n, cls, digest, codes, listed = [], [], [], [], []
        for text in _texts(batch):
            s = shingle_set(text, hashes)
            short, whole = _digest(s) if len(s) else (None, None)
            code = _codes(s)
            n.append(len(s)), cls.append(short), digest.append(whole), codes.append(len(code)), listed.append(np.count_nonzero(code < np.uint64(CUT)))
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(digest, pa.binary()), pa.array(codes, pa.int32()), pa.array(listed, pa.int32())],
            ["doc_id", "n_shingles", "cls", "digest", "codes", "listed"],
        )


def _codes(s: np.ndarray) -> np.ndarray:
    code = s >> np.uint64(64 - CODE_BITS)
    return code[np.concatenate(([True], code[1:] != code[:-1]))] if len(code) else code


def _planes(values: np.ndarray) -> bytes:
    """The bytes of an array by significance, so that the zero bytes of small numbers lie together for the shuffle's compression."""
    if not len(values):  # a part with none but dealt-out entries
        return b""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplaned(data: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pair_lists(overlap, whole: bool):
    """How many lists a pair is to share, of sets that need this overlap (the smaller one's counts); never more than the overlap.
    A number, or a column of them."""
    most, part = (2**31, 6) if whole else (PAIR_LISTS, 36)
    if isinstance(overlap, int):
        return max(1, min(most, overlap // part))
    return F.greatest(F.lit(1), F.least(F.lit(most), F.floor(overlap / part)))


def _sent(n: int, codes: np.ndarray, threshold: tuple[int, int], short: int | None) -> np.ndarray:
    """The codes that a set of ``n`` sends: those of the listed part, all if these are too few, and (with ``WHOLE``) all
    where it may link with a set below ``short``; for None these alone."""
    num, den = threshold
    sent = [codes[:0]]
    if short is None or n * num < short * den:
        sent.append(codes | np.uint64(WHOLE))
    if short is not None and n >= short:
        overlap = -(-n * num // den)
        listed = codes[codes < np.uint64(CUT)]
        sent.append(listed if len(listed) >= n - overlap + (n - len(codes)) + pair_lists(overlap, False) else codes)
    return np.concatenate(sent)


def _lister(parts: int, threshold: tuple[int, int], short: int | None):
    def flush(codes: list, sizes: list, classes: list) -> Iterator[pa.RecordBatch]:
        code = np.concatenate(codes)
        doc = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        cls = np.array(classes, np.int64)
        part = code % np.uint64(parts)
        order = np.argsort((part << np.uint64(CODE_BITS + 1)) | code, kind="stable") if parts < 1 << 15 else np.lexsort((code, part))
        code, doc, part = code[order], doc[order], part[order].astype(np.int64)
        first = np.concatenate(([True], code[1:] != code[:-1]))
        start = np.flatnonzero(first)
        nth = np.arange(len(code)) - np.repeat(start, np.diff(np.append(start, len(code))))
        beyond = nth >= RUN
        salted = np.where(beyond, (cls[doc].astype(np.uint64) ^ code) % np.uint64(parts), np.uint64(parts)).astype(np.int64)
        columns: dict[str, list] = {k: [] for k in ("part", "code", "doc", "cls", "more", "n_more", "over", "over_cls")}
        for p in range(parts):
            lo, hi = np.searchsorted(part, [p, p + 1])
            own = slice(lo, hi)
            inside = ~beyond[own]
            far = np.flatnonzero(salted == p) if beyond.any() else np.empty(0, np.int64)
            if lo == hi and not len(far):
                continue
            c, d = code[own][inside], doc[own][inside]
            ids, local = np.unique(d, return_inverse=True)
            more, n_more = np.unique(code[own][~inside], return_counts=True)
            for k, v in (
                ("code", _planes(np.diff(c, prepend=np.uint64(0)))), ("doc", _planes(local.astype(np.uint32))), ("cls", cls[ids].tobytes()),
                ("more", more.tobytes()), ("n_more", n_more.tobytes()), ("over", code[far].tobytes()), ("over_cls", cls[doc[far]].tobytes()),
            ):
                columns[k].append(v)
            columns["part"].append(p)
        yield pa.record_batch([pa.array(v, pa.int64() if k == "part" else pa.binary()) for k, v in columns.items()], list(columns))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _word_hashes(), set()
        codes, sizes, classes, held = [], [], [], 0
        for batch in batches:
            for s in (shingle_set(x, hashes) for x in _texts(batch)) if "text" in batch.schema.names else _kept_sets(batch):
                if not len(s):
                    continue
                cls, digest = _digest(s)
                if digest in seen:  # this task has sent an equal set
                    continue
                seen.add(digest)
                sent = _sent(len(s), _codes(s), threshold, short)
                codes.append(sent), sizes.append(len(sent)), classes.append(cls)
                held += len(sent)
                if held >= FLUSH_ENTRIES:
                    yield from flush(codes, sizes, classes)
                    codes, sizes, classes, held = [], [], [], 0
        if held:
            yield from flush(codes, sizes, classes)

    return lists


LISTS = "part long, code binary, doc binary, cls binary, more binary, n_more binary, over binary, over_cls binary"
SHARED = "kind int, cls long, code long, df long"


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All entries of some codes -> those of codes with two classes or more. Kind 0: an entry with its list's length;
    1: an entry from beyond a run, without it; 2: the length of a list some of whose entries are of kind 1."""
    worker_state("jaccard_join")
    got: dict[str, list] = {k: [] for k in ("code", "cls", "more", "n_more", "over", "over_cls")}
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names if c != "part"}
            doc = _unplaned(row["doc"], np.uint32)
            got["code"].append(np.cumsum(_unplaned(row["code"], np.uint64), dtype=np.uint64))
            got["cls"].append(np.frombuffer(row["cls"], np.int64)[doc])
            for k, dtype in (("more", np.uint64), ("n_more", np.int64), ("over", np.uint64), ("over_cls", np.int64)):
                got[k].append(np.frombuffer(row[k], dtype))
    if not got["code"]:
        return
    a = {k: np.concatenate(v) for k, v in got.items()}
    order = np.lexsort((a["cls"], a["code"]))
    code, cls = a["code"][order], a["cls"][order]
    if len(code):
        new = np.concatenate(([True], (code[1:] != code[:-1]) | (cls[1:] != cls[:-1])))
        code, cls = code[new], cls[new]
    values, length = np.unique(code, return_counts=True)
    more, at = np.unique(a["more"], return_inverse=True)
    extra = np.bincount(at, weights=a["n_more"], minlength=len(more)).astype(np.int64)
    df = length.copy()
    if len(more):
        df[np.searchsorted(values, more)] += extra  # a code with entries beyond a run has a run before them
    each = np.repeat(df, length)
    kept = each >= 2
    yield _shared(0, cls[kept], code[kept], each[kept])
    if len(a["over"]):
        yield _shared(1, a["over_cls"], a["over"], None)
    if len(more):
        yield _shared(2, None, more, df[np.searchsorted(values, more)])


def _shared(kind: int, cls, code, df) -> pa.RecordBatch:
    n = len(code)
    column = lambda v, t: pa.nulls(n, t) if v is None else pa.array(v).cast(t)
    return pa.record_batch(
        [pa.array(np.full(n, kind, np.int32)), column(cls, pa.int64()), pa.array(code.astype(np.int64)), column(df, pa.int64())],
        ["kind", "cls", "code", "df"],
    )


def kept_lists(docs: DataFrame, classes: DataFrame, threshold: tuple[int, int] = (NUM, DEN), short: int | None = SHORT) -> DataFrame:
    """``(text)`` or ``(hashes)`` and their ``(cls, n, codes, listed)`` -> ``(cls, code, k, least)``: the lists by which a class can meet a
    partner, in how many of them it has to meet one, and the smallest such number of a partner. ``short``: None for lists of all shingles."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(lean(_lister(parts, threshold, short)), LISTS).repartition(parts, "part")
    shared = materialize(sent.mapInArrow(lean(_share), SHARED), "jaccard-shared")
    near = shared.filter("kind = 0").select("cls", "code", "df")
    lengths = shared.filter("kind = 2").select("code", "df")
    far = shared.filter("kind = 1").select("cls", "code").join(lengths, "code").select("cls", "code", "df")
    entries = near.unionByName(far).repartition(parts, "cls").dropDuplicates(["cls", "code"])
    num, den = threshold
    needed = lambda n: F.expr(f"({n} * {num}L + {den - 1}L) DIV {den}L")
    whole, listed = F.col("code") >= WHOLE, F.col("code") < CUT
    known = entries.join(classes.select("cls", "n", "codes", "listed"), "cls").withColumn("overlap", needed("n")).withColumn("fewest", needed("overlap"))
    count = lambda overlap: F.when(whole, pair_lists(F.col(overlap), True)).otherwise(pair_lists(F.col(overlap), False)).cast("int")
    prefix = F.col("n") - F.col("overlap") + (F.col("n") - F.col("codes")) + F.col("k")
    known = known.withColumns({"space": F.when(whole, 2).when(listed, 0).otherwise(1), "k": count("overlap"), "least": count("fewest")})
    known = known.select("cls", "code", "df", "space", "k", "least", (prefix - F.when(listed, F.col("listed")).otherwise(F.col("codes"))).alias("need"))
    by_class = Window.partitionBy("cls", "space")  # need: what to add to the shared codes of the space to get how many are kept
    ranked = known.withColumn("rank", F.row_number().over(by_class.orderBy("df", "code"))).withColumn("quota", F.col("need") + F.count(F.lit(1)).over(by_class))
    return ranked.filter("rank <= quota").select("cls", "code", "k", "least")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists (``code, run``: structs of ``cls, label, k, wide``) -> a row for each two classes of a list with different labels, with the number of such rows that they need."""
    for batch in batches:
        run = batch.column("run")
        length = np.diff(run.offsets.to_numpy())
        cls, label, k, wide = (run.flatten().field(c).to_numpy() for c in range(4))
        of = np.repeat(np.arange(len(length)), length)
        first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for step in range(1, int(length.max(initial=0))):
            i = np.flatnonzero((of[step:] == of[:-step]) & (label[step:] != label[:-step]))
            first.append(i), second.append(i + step)
        i, j = np.concatenate(first), np.concatenate(second)
        need = np.maximum(np.minimum(k[i], k[j]) - np.minimum(wide[i], wide[j]), 1)
        yield pa.record_batch(
            [pa.array(np.minimum(cls[i], cls[j])), pa.array(np.maximum(cls[i], cls[j])), pa.array(batch.column("code").to_numpy()[of[i]] >= WHOLE), pa.array(need, pa.int64())],
            ["a", "b", "whole", "need"],
        )


def groups_by_lists(lists: DataFrame, bound: int) -> DataFrame:
    """``(cls, code, k, least, label)``, at most ``bound`` rows -> ``(cls, grp)``: groups in which any two classes with different labels are
    that share ``k`` lists (the smaller ``k`` of the two; lists for pairs with a small set count apart)."""
    firsts = lists.groupBy("code").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("_rows"))
    firsts = materialize(firsts.filter("lo < hi").select("code", "_rows", (F.col("_rows") > PAIRED).alias("is_wide")), "jaccard-firsts")
    own = Window.partitionBy("cls", F.col("code") >= WHOLE)
    entries = join_totals(lists, firsts, "code", bound).withColumn("wide", F.count(F.when(F.col("is_wide"), 1)).over(own))
    entries = materialize(entries.filter("NOT is_wide OR wide >= least").select("cls", "code", "label", "k", "wide", "is_wide"), "jaccard-entries")
    runs = entries.filter("NOT is_wide").groupBy("code").agg(F.collect_list(F.struct("cls", "label", "k", "wide")).alias("run"))
    pairs = runs.mapInArrow(lean(_pairs), "a long, b long, whole boolean, need long").groupBy("a", "b", "whole").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need"))
    wide = entries.filter("is_wide").select("cls", "code")
    hubs = materialize(wide.groupBy("code").agg(F.min("cls").alias("hub"), F.count(F.lit(1)).alias("_rows")), "jaccard-hubs")
    edges = join_totals(wide, hubs, "code", bound).select(F.col("cls").alias("a"), F.col("hub").alias("b"))
    edges = edges.unionByName(pairs.filter("n >= need").select("a", "b"))
    return connected_components(edges).select(F.col("node").alias("cls"), F.col("component").alias("grp"))


def t_occurrence_links(sets: list[np.ndarray], together: list[int], threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Links between sorted sets, as many as connect what is connected; sets with equal ``together`` count as connected.
    Sets are taken by size, each searched in the inverted lists of the smaller ones."""
    num, den = threshold
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    size = np.array([len(sets[i]) for i in order])
    owner = np.repeat(np.arange(len(order)), size)
    value = np.concatenate([sets[i] for i in order])
    by_value = np.argsort(value, kind="stable")  # lists, each in order of the sets
    sorted_value, posting = value[by_value], owner[by_value]
    start = np.flatnonzero(np.concatenate(([True], sorted_value[1:] != sorted_value[:-1])))
    list_start = np.repeat(start, np.diff(np.append(start, len(value))))
    begin, place = np.empty(len(value), np.int64), np.empty(len(value), np.int64)
    begin[by_value], place[by_value] = list_start, np.arange(len(value)) - list_start  # by entry: its list, and how many smaller sets are in it
    forest, links, first_of = Forest(len(order)), [], {}
    for k, i in enumerate(order):
        forest.join(first_of.setdefault(together[i], k), k)
    at = 0
    for k, n in enumerate(size.tolist()):
        b, before = begin[at : at + n], place[at : at + n]
        at += n
        used = before > 0
        need = -(-n * num // den)
        if np.count_nonzero(used) < need:
            continue
        b, before = b[used], before[used]
        by_length = np.argsort(before, kind="stable")
        b, before = b[by_length], before[by_length]
        n_long = min(need - 1, int(need / (LONG_LIST_WEIGHT * np.log2(before[-1] + 1) + 1)))
        short = len(b) - n_long
        runs = before[:short]
        index = np.arange(runs.sum()) + np.repeat(b[:short] - np.concatenate(([0], np.cumsum(runs)[:-1])), runs)
        found, count = np.unique(posting[index], return_counts=True)
        enough = count >= need - n_long
        found, count = found[enough], count[enough]
        root = forest.root(k)
        apart = np.array([forest.root(j) != root for j in found.tolist()], bool)
        found, count = found[apart], count[apart]
        for lo, m in zip(b[short:].tolist(), before[short:].tolist(), strict=True):
            if not len(found):
                break
            run = posting[lo : lo + m]
            spot = np.minimum(np.searchsorted(run, found), m - 1)
            count = count + (run[spot] == found)
        for j, c in zip(found.tolist(), count.tolist(), strict=True):
            if den * c >= num * (n + int(size[j]) - c) and forest.join(j, k):
                links.append((order[j], order[k]))
    return links


def _linker(threshold: tuple[int, int]):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("jaccard_join")
        for table in groups_of(batches, ["grp", "bi", "bj"]):
            if table.num_rows < 2:
                continue
            cls = table.column("cls").to_numpy()
            sets = list(_kept_sets(table))
            links = star_links(cls, t_occurrence_links(sets, table.column("label").to_pylist(), threshold))
            if links is not None:
                yield links

    return link


def blocks_by_size(members: DataFrame, crossing: bool, threshold: tuple[int, int], bound: int) -> DataFrame:
    """``members`` (``cls, grp, n`` and more, at most ``bound`` rows, no shingles) with the columns ``bi, bj``. A group of no more than ``BLOCK_SHINGLES`` is one block. In a larger one, linked
    sets differ in size by a factor of den / num at most, so sets fall into classes of (a little more than) that width, these into blocks,
    and a block meets those of its own class and of the two next to it (``crossing``), or itself alone."""
    num, den = threshold
    size = F.floor(F.log("n") / F.log(F.lit(den / num * 1.0001)))
    per_class = members.groupBy("grp", size.alias("size")).agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("rows"))
    blocks = F.ceil(F.col("w") / BLOCK_SHINGLES)
    per_group = per_class.groupBy("grp").agg(F.sum("w").alias("w"), F.sum("rows").alias("_rows"), F.map_from_entries(F.collect_list(F.struct("size", blocks.alias("n")))).alias("blocks"))
    large = F.col("w") > BLOCK_SHINGLES
    known = join_totals(members, materialize(per_group, "jaccard-blocks"), "grp", bound).withColumn("size", F.when(large, size).otherwise(F.lit(0).cast("long")))
    many = lambda s: F.when(large, F.coalesce(F.try_element_at("blocks", s), F.lit(0).cast("long"))).otherwise((s == 0).cast("long"))
    block_id = lambda s, p: s * F.lit(1 << 32) + p
    dealt = known.withColumn("own", block_id(F.col("size"), F.pmod(F.xxhash64(F.lit(7), "cls"), many(F.col("size")))))
    if not crossing:
        return dealt.withColumns({"bi": F.col("own"), "bj": F.col("own")})
    numbers = lambda s: F.when(many(s) > 0, F.transform(F.sequence(F.lit(0).cast("long"), many(s) - 1), lambda p: block_id(s, p))).otherwise(F.array().cast("array<bigint>"))
    others = F.concat(numbers(F.col("size")), numbers(F.col("size") + 1), numbers(F.col("size") - 1))
    return dealt.withColumn("other", F.explode(others)).withColumns({"bi": F.least("own", "other"), "bj": F.greatest("own", "other")})


def link_groups(dealt: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """``(grp, bi, bj, cls, label, hashes)`` -> links ``(a, b)`` found in the blocks (or pairs of blocks) of each group."""
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["grp", "bi", "bj", "cls", "label", "hashes"]
    return dealt.select(*columns).repartition(parts, "grp", "bi", "bj").sortWithinPartitions("grp", "bi", "bj", "cls").mapInArrow(lean(_linker(threshold)), "a long, b long")


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _word_hashes()
    for batch in batches:
        for k, text in enumerate(_texts(batch)):
            s = shingle_set(text, hashes)
            cls = batch.column("cls")[k].as_py()
            if len(s) and _digest(s)[0] == cls:
                place = [batch.column(c).slice(k, 1) for c in ("cls", "grp", "bi")]
                yield pa.record_batch([*place, pa.array([s.tobytes()], pa.binary())], ["cls", "grp", "bi", "hashes"])


def _labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``(cls, ...)`` with ``label``: the component of a class by the links so far."""
    found = connected_components(links).select(F.col("node").alias("cls"), F.col("component").alias("label"))
    return classes.join(found, "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def jaccard_join(docs: DataFrame, threshold: tuple[int, int] = (NUM, DEN)) -> DataFrame:
    """``(doc_id, text)`` -> a row per document: ``doc_id, n_shingles, component_id`` (the smallest doc_id reachable by links)."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    measured = materialize(docs.mapInArrow(lean(_measure), MEASURED), "jaccard-sets")
    n_docs = measured.count()
    classes = measured.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.max("codes").alias("codes"), F.max("listed").alias("listed"), F.count(F.lit(1)).alias("_rows"))
    classes = materialize(classes, "jaccard-classes")
    lists = materialize(kept_lists(docs.select("text"), classes, threshold).withColumn("label", F.col("cls")), "jaccard-lists")
    n_lists = lists.count()
    grouped = groups_by_lists(lists, n_lists).join(classes.select("cls", "rep", "n"), "cls")
    members = materialize(blocks_by_size(grouped, False, threshold, n_docs).select("cls", "rep", "n", "grp", "bi"), "jaccard-groups")
    wanted = members.select("cls", "rep", "grp", "bi")
    if members.count() <= BROADCAST_CLASSES:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"])).select("cls", "grp", "bi", "text")
    sets = materialize(texts.mapInArrow(lean(_sets_of), "cls long, grp long, bi long, hashes binary"), "jaccard-members")
    if sets.count() > members.count():  # rows that repeat a doc_id and its text
        sets = materialize(sets.dropDuplicates(["cls"]), "jaccard-members")
    links = materialize(link_groups(sets.withColumn("bj", F.col("bi")).withColumn("label", F.col("cls")), threshold), "jaccard-links")
    several = members.groupBy("grp").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("_rows")).filter(F.col("w") > BLOCK_SHINGLES).select("grp", "_rows")
    several = materialize(several, "jaccard-large")
    members = materialize(join_totals(members.select("cls", "grp", "n"), several, "grp", n_docs), "jaccard-several")
    if not members.isEmpty():
        sets = materialize(sets.join(members, "cls", "left_semi").select("cls", "hashes"), "jaccard-large-sets")

        def linked(dealt: DataFrame) -> DataFrame:
            return materialize(links.unionByName(link_groups(dealt.join(sets, "cls"), threshold)), "jaccard-links")

        leaders = _labelled(members, links).filter("label = cls")
        links = linked(blocks_by_size(leaders, False, threshold, n_docs))
        labelled = materialize(_labelled(members, links), "jaccard-labels")
        lists = kept_lists(sets.select("hashes"), classes, threshold, None).join(labelled.select("cls", "label"), "cls")
        open_lists = materialize(lists, "jaccard-open")
        rest = groups_by_lists(open_lists, open_lists.count()).join(labelled.select("cls", "label", "n"), "cls")
        rest = materialize(blocks_by_size(rest, True, threshold, n_docs).select("grp", "bi", "bj", "cls", "label", "n"), "jaccard-crossing")
        own, crossing = labelled.agg(F.sum("n")).first()[0], rest.agg(F.sum("n")).first()[0] or 0
        rounds = -(-crossing // max(ROUND_COPIES * own, ROUND_SHINGLES))
        for k in range(rounds):
            links = linked(rest.filter(F.pmod(F.xxhash64(F.lit(11), "grp", "bi", "bj"), F.lit(rounds)) == k))
    found = connected_components(links)
    joined = classes.join(found, classes["cls"] == found["node"]).select("cls", "rep", "component")
    names = joined.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("_rows"))
    names = materialize(names, "jaccard-names")
    named = join_totals(joined.select("cls", "component"), names, "component", n_docs).select("cls", "component_id")
    final = classes.join(named, "cls", "left").select("cls", F.coalesce("component_id", "rep").alias("component_id"), "_rows")
    final = materialize(final, "jaccard-final")
    known = join_totals(measured.select("doc_id", "n_shingles", "cls"), final, "cls", n_docs).select("doc_id", "n_shingles", "component_id")
    return known.unionByName(measured.filter("cls IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
