"""Mixing sources to target weights, with DataFrame expressions only.

The words of every source form one stream (documents in a pseudorandom order, in chunks), cut into blocks of
``block_words`` words; the last block of a chunk may be shorter, so that no block spans two chunks. The mix is a sequence of slots in output shards of ``shard_slots`` slots. A shard
gives each source the whole part of its expected slots and draws the remaining ones from a multinomial
over the fractional parts, so the draws are random while every source stays near its target. The slots
of a source are numbered over all shards; pass ``q div n`` and position ``q mod n`` of slot q go through a
pseudorandom permutation of the source's n blocks (swap-or-not rounds, another one for each pass), and
the resulting index is joined with the blocks. A block is used at most once in a pass and at most
``max_repeats`` times, so no document exceeds ``max_repeats`` times its size.

Positions in a stream are prefix sums in two levels (chunks of about ``CHUNK_DOCS`` documents, then the blocks
of chunks), so a hot source is never ordered in one task. Texts are shuffled once, by chunk: they are ordered, cut into blocks and
joined with the slots where they are, and the slots are sent to the chunks. Randomness comes from hashes of
``(seed, shard, draw)`` and ``(seed, source, pass, round)``: reruns and recomputed tasks agree.

Defined cases: null or blank text has size 0 and is taken 0 times; a null source is a source of its own,
last in order; repeated rows are documents of their own; a source without words has target 0; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripspark.llm.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
CHUNK_DOCS = 2048
BROADCAST_SOURCES = 100_000
ROUNDS = 12
GRID = 1024  # cells in which a uniform draw looks up its source
SEED = 20240601


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(*keys: Column) -> Column:
    """In [0, 1), from 52 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 12) / F.lit(float(2**52))


def permuted(index: Column, n: Column, *keys: Column, rounds: int = ROUNDS) -> Column:
    """The image of ``index`` under a pseudorandom permutation of 0..n-1 chosen by ``keys``. Each round pairs x
    with (k - x) mod n and swaps the pair or not, by a bit of its larger member: a bijection for every n."""

    def round_of(x: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*keys, i), n) - x, n)
        swap = F.xxhash64(*keys, i, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.array(*[F.lit(i) for i in range(rounds)]), index.cast("long"), round_of)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, size)`` -> a row per source: ``sid`` (order by code point, null last), ``source_size``, ``n_docs``,
    ``target``. Targets share the total by weight; where a share exceeds ``max_repeats`` times the source's size
    it stops there and the rest is shared again: the level L with sum(least(weight * L, cap)) = total."""
    one = Window.partitionBy()  # a row per source
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ordered = table.withColumn("sid", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = (
        ordered.withColumn("weight", F.element_at(cycle, F.pmod("sid", F.lit(len(weights))) + 1))
        .withColumn("cap", F.col("source_size") * float(max_repeats))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
    )
    by_fill = one.orderBy("full_at", "sid")
    level = (F.sum("source_size").over(one) - F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum(
        "weight"
    ).over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    leveled = weighed.withColumn("level", level).withColumn("fill_rank", F.row_number().over(by_fill))
    final = F.min(F.when(F.col("level") <= F.col("full_at") * (1 + 1e-12), F.struct("fill_rank", "level"))).over(one)["level"]
    return leveled.select("source", "sid", "source_size", "n_docs", F.least(F.col("weight") * final, F.col("cap")).alias("target"))


def _each_shard(rows: DataFrame, partitions: int) -> DataFrame:
    """A row for each shard of a row's kind; in runs of shards dealt over tasks, as a few rows become very many."""
    run = 1 << 14
    first = F.when(F.col("kind") == 0, F.lit(0).cast("long")).otherwise(F.col("n_shards") - 1)
    last = F.when(F.col("kind") == 0, F.col("n_shards") - 2).otherwise(F.col("n_shards") - 1)
    runs = rows.withColumn("_last", last).withColumn("_run", F.explode(F.sequence(first, F.col("_last"), F.lit(run).cast("long"))))
    ends = F.least(F.col("_run") + (run - 1), F.col("_last"))
    return runs.repartition(partitions, "_run", "kind").withColumn("shard", F.explode(F.sequence(F.col("_run"), ends)))


def slots(targets: DataFrame, shard_slots: int = SHARD_SLOTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``with_blocks`` -> the mix: ``(shard, sid, q, block)``, one row per slot."""
    one = Window.partitionBy()
    plan = (
        targets.filter("source_size > 0")
        .select("sid", "n_blocks", (F.col("n_blocks") * F.col("target") / F.col("source_size")).alias("draws"))
        .withColumn("n_slots", F.round(F.sum("draws").over(one)).cast("long"))
        .withColumn("share", F.col("draws") / F.sum("draws").over(one))
        .withColumn("n_shards", F.ceil(F.col("n_slots") / shard_slots))
    )
    # all shards but the last are full: kind 0 and kind 1 have their whole parts and fractions each
    full, last = F.lit(shard_slots).cast("long"), F.col("n_slots") - (F.col("n_shards") - 1) * shard_slots
    kinds = plan.withColumn("kind", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("shard_size", F.when(F.col("kind") == 0, full).otherwise(last))
    expected = F.col("shard_size") * F.col("share")
    by_kind = Window.partitionBy("kind")
    kinds = (
        kinds.withColumn("whole", F.floor(expected))
        .withColumn("part", expected - F.floor(expected))
        .withColumn("rest", F.col("shard_size") - F.sum("whole").over(by_kind))
        .withColumn("parts", F.sum("part").over(by_kind))
        .withColumn("hi", F.sum("part").over(by_kind.orderBy("sid")) / F.col("parts"))
        .withColumn("lo", F.coalesce(F.lag("hi").over(by_kind.orderBy("sid")), F.lit(0.0)))
        .withColumn("hi", F.when(F.lead("sid").over(by_kind.orderBy("sid")).isNull(), F.lit(1.0)).otherwise(F.col("hi")))
    )
    partitions = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = kinds.filter((F.col("kind") == 1) | (F.col("n_shards") > 1))
    whole = _each_shard(kinds.filter("whole > 0"), partitions).select("sid", "shard", F.col("whole").alias("n"))
    rests = kinds.filter("rest > 0").groupBy("kind", "n_shards", "rest").agg(F.count(F.lit(1)).alias("n"))
    drawn = (
        _each_shard(rests, partitions)
        .select("kind", "shard", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rest"))).alias("draw"))
        .withColumn("u", _uniform(F.lit(seed), F.col("shard"), F.col("draw")))
        .withColumn("cell", F.floor(F.col("u") * GRID))
    )
    cells = kinds.filter("part > 0").select(
        "kind", "sid", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * GRID), F.least(F.floor(F.col("hi") * GRID), F.lit(GRID - 1).cast("long")))).alias("cell")
    )
    rest = drawn.join(cells, ["kind", "cell"]).filter("u >= lo AND u < hi").select("sid", "shard", F.lit(1).cast("long").alias("n"))
    counts = whole.unionByName(rest).groupBy("sid", "shard").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    numbered = counts.withColumn("first", F.coalesce(before, F.lit(0).cast("long"))).join(plan.select("sid", "n_blocks"), "sid")
    each = (
        numbered.repartition(partitions, "sid", "shard")
        .select("shard", "sid", "n_blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("q"))
        .filter(F.col("q") < F.col("n_blocks") * max_repeats)
        .withColumn("pass", F.floor(F.col("q") / F.col("n_blocks")))
    )
    block = permuted(F.pmod("q", "n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("sid"), F.col("pass"))
    return each.select("shard", "sid", "q", block.alias("block"))


def _with_chunk(rows: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """``(doc_id, source, ...)`` with what is known of its source, and its chunk."""
    known = targets.withColumnRenamed("source", "_source")
    if known.count() <= BROADCAST_SOURCES:  # beyond, rows meet their source by a shuffle
        known = F.broadcast(known)
    chunk = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.ceil(F.col("n_docs") / CHUNK_DOCS))
    return rows.join(known, rows["source"].eqNullSafe(known["_source"])).drop("_source").withColumn("chunk", chunk).drop("n_docs")


def chunk_blocks(sizes: DataFrame, targets: DataFrame, block_words: int, seed: int) -> DataFrame:
    """A row per chunk: ``sid, chunk, first`` (its first block in the source) and ``blocks`` (their number)."""
    sums = _with_chunk(sizes, targets, seed).groupBy("sid", "chunk").agg(F.ceil(F.sum("size") / block_words).alias("blocks"))
    up_to = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(sums.select("sid", "chunk", "blocks", F.coalesce(F.sum("blocks").over(up_to), F.lit(0).cast("long")).alias("first")), "mix-chunks")


def with_blocks(targets: DataFrame, chunks: DataFrame) -> DataFrame:
    """``source_targets`` with ``n_blocks``."""
    return targets.join(chunks.groupBy("sid").agg(F.sum("blocks").alias("n_blocks")), "sid")


def positions(rows: DataFrame, targets: DataFrame, chunks: DataFrame, block_words: int, seed: int = SEED, ties: tuple[str, ...] = ()) -> DataFrame:
    """Each document's place in the stream of its source: ``sid, chunk, ord`` (its key), ``start`` and the columns of
    ``rows`` (doc_id, source, size and more), with ``source_size`` and ``target``. Documents of equal id and size are in order of ``ties``."""
    in_chunk = Window.partitionBy("sid", "chunk").orderBy("doc_id", "size", *ties)
    inner = (
        _with_chunk(rows, targets, seed)
        .withColumn("ord", F.row_number().over(in_chunk))
        .withColumn("inner", F.sum("size").over(in_chunk.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    )
    bases = chunks.select("sid", "chunk", (F.col("first") * block_words).alias("base"))
    return inner.join(bases, ["sid", "chunk"]).withColumn("start", F.col("base") + F.col("inner")).drop("base", "inner")


def _pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """A row for each block that a document reaches into: ``block``, ``from`` and ``words`` (within the document)."""
    end = F.col("start") + F.col("size")
    block = F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words)))
    return (
        placed.filter("size > 0")
        .withColumn("block", block)
        .withColumn("from", F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0).cast("long")))
        .withColumn("words", F.least((F.col("block") + 1) * block_words, end) - F.col("start") - F.col("from"))
    )


def mixed_counts(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``(doc_id, text, source)`` -> a row per document: ``doc_id, size, source_size, target, taken``."""
    sizes = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, max_repeats), "mix-targets")
    chunks = chunk_blocks(sizes, targets, block_words, seed)
    placed = positions(sizes, targets, chunks, block_words, seed)
    uses = slots(with_blocks(targets, chunks), shard_slots, max_repeats, seed).groupBy("sid", "block").agg(F.count(F.lit(1)).alias("uses"))
    key = ["sid", "chunk", "ord"]
    taken = _pieces(placed.select(*key, "start", "size"), block_words).join(uses, ["sid", "block"]).groupBy(key).agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    return placed.join(taken, key, "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def _row_keys() -> list[Column]:
    """128 bits that tell rows of unlike id, source or text apart."""
    columns = [c for name in ("doc_id", "source", "text") for c in (F.col(name), F.col(name).isNull())]
    return [F.xxhash64(F.lit(i), *columns).alias(k) for i, k in enumerate(("k1", "k2"))]


def _word_blocks(placed: DataFrame, block_words: int) -> DataFrame:
    """``positions`` with texts -> ``(sid, chunk, block)`` and ``parts``: of each document in the block its key, id, number of words and these
    words, in stream order. Texts leave as slices of a block's size, each one string, and stay in the task of their chunk."""
    start, end = F.col("start"), F.col("start") + F.col("size")
    words = F.filter(F.split("text", SPACE, -1), lambda w: w != "")

    def part(tokens: Column, block: Column) -> Column:
        at = F.greatest(block * block_words, start)
        n = F.least((block + 1) * block_words, end) - at
        return F.struct(
            block.alias("block"),
            F.struct(at.alias("at"), F.col("ord"), F.col("doc_id"), n.alias("words"), F.array_join(F.slice(tokens, (at - start + 1).cast("int"), n.cast("int")), " ").alias("text")).alias("part"),
        )

    numbers = F.sequence(F.floor(start / block_words), F.floor((end - 1) / block_words))
    # the outer array binds the words, which are split once for all slices
    pieces = F.transform(F.array(words), lambda tokens: F.transform(numbers, lambda block: part(tokens, block)))[0]
    cut = placed.filter("size > 0").select("sid", "chunk", F.inline(pieces))
    return cut.groupBy("sid", "chunk", "block").agg(F.sort_array(F.collect_list("part")).alias("parts"))


@contextmanager
def _partitioned_by_some_keys(spark: SparkSession) -> Iterator[None]:
    """Joins may keep a side where it is when it is partitioned by some of the join's keys."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _mix(docs: DataFrame, block_words: int, shard_slots: int, weights: tuple[float, ...], max_repeats: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """``positions`` of all documents, and the mix, written: ``shard, sid, q, block, parts`` (key, id and number of words of each document), ``tokens``."""
    size, ties = word_count(F.col("text")).alias("size"), ("k1", "k2")
    sizes = materialize(docs.select("doc_id", "source", size, *_row_keys()), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, max_repeats), "mix-targets")
    chunks = chunk_blocks(sizes, targets, block_words, seed)
    placed = positions(sizes, targets, chunks, block_words, seed, ties)
    texts = docs.select("doc_id", "source", size, *_row_keys(), "text").withColumn("text", F.when(F.col("size") > 0, F.col("text")))
    blocks = _word_blocks(positions(texts, targets, chunks, block_words, seed, ties), block_words)
    numbers = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)).alias("block")
    chunk_of = chunks.filter("blocks > 0").select("sid", "chunk", numbers)
    # merge: a row per block comes from a small table, whose size says nothing of them
    sent = slots(with_blocks(targets, chunks), shard_slots, max_repeats, seed).join(chunk_of.hint("merge"), ["sid", "block"]).repartition("sid", "chunk")
    mix = sent.join(blocks, ["sid", "chunk", "block"])
    parts = F.transform("parts", lambda p: F.struct(F.col("chunk").alias("chunk"), p["ord"].alias("ord"), p["doc_id"].alias("doc_id"), p["words"].alias("words")))
    tokens = F.split(F.array_join(F.transform("parts", lambda p: p["text"]), " "), " ", -1)
    with _partitioned_by_some_keys(docs.sparkSession):
        return placed, materialize(mix.select("shard", "sid", "q", "block", parts.alias("parts"), tokens.alias("tokens")), "mix-blocks", compression="zstd")


def mixed_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """The mix itself: ``shard, sid, q, block``, ``parts`` (the documents in the block) and ``tokens`` (the words of that block, in stream order)."""
    return _mix(docs, block_words, shard_slots, weights, max_repeats, seed)[1]


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """Write the mix to the shared folder and read it back -> a row per document as ``mixed_counts`` has it, ``taken`` from the mix's blocks."""
    placed, mix = _mix(docs, block_words, shard_slots, weights, max_repeats, seed)
    key = ["sid", "chunk", "ord"]
    taken = mix.select("sid", F.inline("parts")).groupBy(key).agg(F.sum("words").alias("taken"))
    return placed.join(taken, key, "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix in whole documents, columns as given: a document appears taken / size times on average, rounded to a
    whole number of copies by a hash of its id (so long and short documents keep their shares)."""
    seed = options.get("seed", SEED)
    shares = mixed_counts(docs, **options).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + _uniform(F.lit(seed + 1), F.col("doc_id")))).otherwise(F.lit(0))
    counted = shares.select(F.col("doc_id").alias("_doc"), copies.cast("int").alias("_copies")).filter("_copies > 0")
    kept = docs.join(counted, docs["doc_id"].eqNullSafe(counted["_doc"]))
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[docs[c] for c in docs.columns])
