"""Merkle manifest of a dataset: a tree of digests over the rows of each group, and one over the groups.

H is the lowercase hex SHA-256 of its inputs, concatenated; digests go in as hex text. A leaf is the digest of a row's
fields (``-`` for null, else UTF-8 byte count, ``:``, value). In a group the leaves ascend by their order columns, and every
``FAN`` consecutive nodes of a level (the last run may be shorter) become their H, until one node is left, the group's
subroot; the subroots, in order of the group, give the root in the same way.

Leaves are numbered without gathering a group: sorted by range over all tasks, counted by task, shifted by the counts before.
Runs of ``FAN ** HEIGHT`` leaves, aligned to their number, are the blocks of the store. A block is one row: its nodes in the
van Emde Boas layout (the tree of a block is cut at half its height into a top tree and the bottom trees below it, each laid out
in the same way, one after the other), so that a path from a leaf to the block's root stays in few neighbouring places at every scale.
Addresses are computed, not stored (``addresses``); the same arithmetic serves construction and the retrieval of siblings, and is exact
for blocks that are not full. The roots of the blocks are the leaves of the next store, and so on, until a group has one block;
every store has a ``FAN ** HEIGHT``-th of the rows of the one below.

Proofs are read from the last store to the first: each block hands the siblings on its path to the blocks below, by a join on
the block's number, so a row meets its siblings without any row-sized shuffle.

Defined cases: rows with equal order columns are ordered by digest, equal rows are leaves of their own; a null group comes first, and a
null order column before others; an empty table has an empty manifest; a lone leaf is its group's subroot, a lone subroot the root,
and their proofs have no siblings (the H of nothing); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.graph import groups_of
from tripspark.llm.storage import materialize, worker_state

FAN = 16
HEIGHT = 3  # of a block, in levels of hashing
DIGEST = 32
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(*fields: str | Column) -> Column:
    """Digest of a row's fields, as 32 bytes."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*framed), 256))


def nodes_of(levels: int, leaves):
    """Nodes of a tree of ``levels`` levels over so many leaves (a number, or an array of them)."""
    return sum(-(-leaves // FAN**level) for level in range(levels))


def addresses(levels: int, leaves: int, level: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes ``index`` of a level (0: leaves) in the van Emde Boas layout of a tree of ``levels`` levels over ``leaves`` leaves.

    The bottom trees have half the levels, rounded down; all but the last are full."""
    if levels == 1:
        return np.zeros_like(index)
    bottom = levels // 2
    top_leaves = -(-leaves // FAN**bottom)
    if level >= bottom:
        return addresses(levels - bottom, top_leaves, level - bottom, index)
    full = FAN ** (bottom - 1)
    tree, within = np.divmod(index, FAN ** (bottom - 1 - level))
    last = -(-leaves // full) - 1
    inside = np.where(tree < last, addresses(bottom, full, level, within), addresses(bottom, leaves - last * full, level, within))
    return nodes_of(levels - bottom, top_leaves) + tree * nodes_of(bottom, full) + inside


def places(levels: int, leaves: int) -> list[np.ndarray]:
    """The addresses of all nodes, by level; kept by the worker, since most blocks are full."""
    kept = worker_state("merkle")
    if (levels, leaves) not in kept:
        if len(kept) > 256:
            kept.clear()
        kept[levels, leaves] = [addresses(levels, leaves, level, np.arange(-(-leaves // FAN**level))) for level in range(levels)]
    return kept[levels, leaves]


def h(*digests: bytes) -> bytes:
    """H of hex digests, as hex."""
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def build_block(leaves: list[bytes], levels: int) -> bytes:
    """Leaf digests (hex) -> all nodes in their places."""
    out = np.zeros((nodes_of(levels, len(leaves)), DIGEST), np.uint8)
    nodes = leaves
    for level, at in enumerate(places(levels, len(leaves))):
        if level:
            nodes = [h(*nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        out[at] = np.frombuffer(bytes.fromhex(b"".join(nodes).decode()), np.uint8).reshape(-1, DIGEST)
    return out.tobytes()


def levels_of(block_leaves: int, group_leaves: int) -> int:
    """Levels of a block's tree: all in a group of several blocks, else as many as its leaves need."""
    if group_leaves > FAN**HEIGHT:
        return HEIGHT + 1
    levels = 1
    while FAN ** (levels - 1) < block_leaves:
        levels += 1
    return levels


BLOCKS = "tree long, block long, size long, n int, nodes binary, root binary, ids array<long>, claims array<binary>"


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in groups_of(batches, ["tree", "block"]):
        tree, block, size = (table.column(c)[0].as_py() for c in ("tree", "block", "size"))
        leaves = [d.hex().encode() for d in table.column("digest").to_pylist()]
        nodes = build_block(leaves, levels_of(len(leaves), size))
        root = nodes[:DIGEST]  # the top of every top tree comes first
        ids, claims = table.column("id").to_pylist(), table.column("claim").to_pylist()
        values = [[tree], [block], [size], [len(leaves)], [nodes], [root], [ids], [claims]]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
        names = ["tree", "block", "size", "n", "nodes", "root", "ids", "claims"]
        yield pa.record_batch([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)


def _siblings(nodes: np.ndarray, levels: int, leaves: int) -> tuple[list[bytes], list[list[bytes]]]:
    """Leaves (hex), and for each level below the root, the runs of nodes that are hashed together (hex, joined)."""
    runs: list[list[bytes]] = []
    text: list[bytes] = []
    for level, at in enumerate(places(levels, leaves)[:-1]):
        flat = nodes[at].tobytes().hex().encode()
        if not level:
            text = [flat[i : i + 64] for i in range(0, len(flat), 64)]
        runs.append([flat[i : i + 64 * FAN] for i in range(0, len(flat), 64 * FAN)])
    return (text or [nodes[0].tobytes().hex().encode()]), runs


def _block_paths(batch: pa.RecordBatch, row: int) -> tuple[list[bytes], list[list[tuple[bytes, bytes]]]]:
    """A block's leaves (hex), and for each run of ``FAN`` leaves the siblings before and after its path on the levels from the run's
    parent upward, those of the stores above included."""
    n, size = batch.column("n")[row].as_py(), batch.column("size")[row].as_py()
    nodes = np.frombuffer(batch.column("nodes")[row].as_buffer(), np.uint8).reshape(-1, DIGEST)
    levels = levels_of(n, size)
    above = [(p["before"].hex().encode(), p["after"].hex().encode()) for p in batch.column("path")[row].as_py()]
    leaves, runs = _siblings(nodes, levels, n)
    paths = []
    for first in range(0, n, FAN):
        path = []
        for level in range(1, levels - 1):
            run, place = divmod(first // FAN**level, FAN)
            flat = runs[level][run]
            path.append((flat[: 64 * place], flat[64 * place + 64 :]))
        paths.append(path + above)
    return leaves, paths


def _own_run(leaves: list[bytes], i: int, size: int) -> list[tuple[bytes, bytes]]:
    """The siblings of a leaf before and after it; no level at all in a tree of one node."""
    if size == 1:
        return []
    first = i - i % FAN
    return [(b"".join(leaves[first:i]), b"".join(leaves[i + 1 : first + FAN]))]


PATH = "array<struct<before: binary, after: binary>>"


def _hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their path -> their leaves with theirs."""
    for batch in batches:
        for row in range(batch.num_rows):
            leaves, paths = _block_paths(batch, row)
            path = []
            for i in range(len(leaves)):
                whole = _own_run(leaves, i, batch.column("size")[row].as_py()) + paths[i // FAN]
                path.append([{"before": bytes.fromhex(a.decode()), "after": bytes.fromhex(b.decode())} for a, b in whole])
            n, block = len(leaves), batch.column("block")[row].as_py()
            kind = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))
            yield pa.record_batch(
                [
                    pa.array([batch.column("tree")[row].as_py()] * n, pa.int64()),
                    pa.array(np.arange(n, dtype=np.int64) + block * FAN**HEIGHT),
                    pa.array([bytes.fromhex(d.decode()) for d in leaves], pa.binary()),
                    pa.array([batch.column("subroot")[row].as_py()] * n, pa.binary()),
                    pa.array(path, kind),
                ],
                ["tree", "position", "digest", "subroot", "path"],
            )


HANDED = f"tree long, position long, digest binary, subroot binary, path {PATH}"
WITH_PATH = ["tree", "block", "size", "n", "nodes", "subroot", "path"]


def folded(claim: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for before, after in path:
        claim = h(before, claim, after)
    return claim


PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their path -> each leaf's proof, folded from the digest claimed for it."""
    for batch in batches:
        for row in range(batch.num_rows):
            leaves, paths = _block_paths(batch, row)
            subroot, root = (batch.column(c)[row].as_py().hex() for c in ("subroot", "root"))
            claims = batch.column("claims")[row].as_py()
            size = batch.column("size")[row].as_py()
            upper = [b"".join(a + b for a, b in path) for path in paths]
            proofs, roots = [], []
            for i, leaf in enumerate(leaves):
                own = _own_run(leaves, i, size)
                proofs.append(hashlib.sha256(b"".join(a + b for a, b in own) + upper[i // FAN]).hexdigest())
                claim = leaf if claims[i] is None else claims[i].hex().encode()
                roots.append(folded(claim, own + paths[i // FAN]).decode())
            n = len(leaves)
            yield pa.record_batch(
                [
                    batch.column("ids").slice(row, 1).flatten(),
                    pa.array([x.decode() for x in leaves]),
                    pa.array([subroot] * n),
                    pa.array([root] * n),
                    pa.array(proofs),
                    pa.array(roots),
                    pa.array([x == root for x in roots]),
                ],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``position`` (from 0, by ``order`` within the group), ``size`` (of the group) and ``tree`` (the
    group's number, from 0, nulls first).

    Sorted by range into tasks and written, so that a repeated task cannot renumber; a group's counts by task are shifted by those of the
    tasks before. A window sees a row per group and task, or per task, never the rows."""
    sorted_rows = rows.repartitionByRange(_parts(rows), group, *order).sortWithinPartitions(group, *order)
    kept = materialize(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")  # task << 33 | row of the task
    kept = kept.withColumns({"_task": F.shiftrightunsigned("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = materialize(kept.groupBy(group, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")), "merkle-counts")
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.select(F.col(group).alias("_g"), F.col("_task").alias("_t"), (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    # a group is numbered in the task of its first row, after the groups that start in tasks before
    groups = counts.groupBy(group).agg(F.sum("_n").alias("size"), F.min("_task").alias("_task"))
    starts = groups.groupBy("_task").agg(F.count(F.lit(1)).alias("_starts"))
    earlier = F.sum("_starts").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))  # a row a task
    in_task = F.row_number().over(Window.partitionBy("_task").orderBy(F.asc_nulls_first(group))) - 1
    trees = groups.withColumn("_in", in_task).join(starts.withColumn("_earlier", F.coalesce(earlier, F.lit(0))), "_task")
    trees = trees.select(F.col(group).alias("_s"), "size", (F.col("_earlier") + F.col("_in")).cast("long").alias("tree"))
    shift = shift.join(trees, F.col("_g").eqNullSafe(F.col("_s"))).drop("_s")
    joined = kept.join(shift, (F.col("_task") == F.col("_t")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.withColumn("position", F.col("_row") + F.col("_shift")).drop("_at", "_row", "_task", "_t", "_g", "_shift")


@dataclass
class Forest:
    """The stores of some trees, first to last, and the root of each: ``tree, root``."""

    stores: list[DataFrame]
    roots: DataFrame


def build_forest(leaves: DataFrame, name: str) -> Forest:
    """``tree, position, size, digest, id, claim`` -> the stores. Each is written to the shared folder."""
    run = FAN**HEIGHT
    stores: list[DataFrame] = []
    roots: DataFrame | None = None
    while True:
        dealt = leaves.withColumn("block", F.expr(f"position div {run}")).repartition(_parts(leaves), "tree", "block")
        dealt = dealt.sortWithinPartitions("tree", "block", "position").select("tree", "block", "size", "digest", "id", "claim")
        store = materialize(dealt.mapInArrow(_build, BLOCKS), f"merkle-{name}-{len(stores)}")
        stores.append(store)
        done = store.filter(F.col("size") <= run).select("tree", "root")
        roots = done if roots is None else roots.unionByName(done)
        rest = store.filter(F.col("size") > run)
        if rest.isEmpty():
            return Forest(stores, roots)
        size = F.expr(f"(size + {run - 1}) div {run}")
        nothing = F.lit(None)
        leaves = rest.select("tree", F.col("block").alias("position"), size.alias("size"), F.col("root").alias("digest"), nothing.cast("long").alias("id"), nothing.cast("binary").alias("claim"))


@dataclass
class Manifest:
    groups: Forest  # a tree per group
    top: Forest  # one tree over the subroots


def build_manifest(leaves: DataFrame, group: str, order: list[str]) -> Manifest:
    """``id, digest, claim`` (a digest presented for the row, or null) and the group and order columns -> the manifest."""
    placed = numbered(leaves, group, [*order, "digest"]).select("tree", "position", "size", "digest", "id", "claim")
    groups = build_forest(placed, "groups")
    subroots = materialize(groups.roots, "merkle-subroots")
    columns = {"tree": F.lit(0).cast("long"), "position": F.col("tree"), "size": F.lit(subroots.count()).cast("long"), "digest": F.col("root")}
    top = subroots.select(*[c.alias(name) for name, c in columns.items()], F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("claim"))
    return Manifest(groups, build_forest(top, "top"))


def _with_paths(forest: Forest, start: DataFrame) -> DataFrame:
    """The blocks of the first store with ``path`` and ``subroot``: from the last store to the first, a tree's last block takes
    its ``start`` (tree, path, subroot), the other blocks what the store above hands to them."""
    handed: DataFrame | None = None
    for store in reversed(forest.stores):
        blocks = store.drop("root").filter(F.col("size") <= FAN**HEIGHT).join(start, "tree")
        if handed is not None:
            above = handed.select("tree", F.col("position").alias("block"), "path", "subroot")
            blocks = blocks.unionByName(store.drop("root").filter(F.col("size") > FAN**HEIGHT).join(above, ["tree", "block"]))
        if store is not forest.stores[0]:
            handed = materialize(blocks.select(*WITH_PATH).mapInArrow(_hand_down, HANDED), "merkle-paths")
    return blocks


def prove(manifest: Manifest) -> DataFrame:
    """A row per leaf: its digest, its subroot and root, the H of its siblings, the root that its claimed digest leads to, and whether that is the root."""
    last = manifest.top.roots.first()  # one row
    root = F.lit(bytearray(last["root"]) if last else None).cast("binary")
    nothing = F.array().cast(PATH)
    blocks = _with_paths(manifest.top, manifest.top.roots.select("tree", nothing.alias("path"), root.alias("subroot")))
    subroots = materialize(blocks.select(*WITH_PATH).mapInArrow(_hand_down, HANDED), "merkle-paths")
    start = subroots.select(F.col("position").alias("tree"), "path", F.col("digest").alias("subroot"))
    found = _with_paths(manifest.groups, start)
    return found.select(*WITH_PATH, root.alias("root"), "ids", "claims").mapInArrow(_prove, PROOFS)


def tampered_text(text: str = "text") -> Column:
    return F.translate(text, UPPER, LOWER)


def verify_documents(docs: DataFrame) -> DataFrame:
    """Manifest of the documents by source, and every document's proof; where 5 divides the crc32 of the decimal doc_id, the document is
    presented with its text's A-Z in lower case."""
    presented = [tampered_text() if f == "text" else f for f in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = docs.select(F.col("doc_id").alias("id"), "source", leaf_digest(*FIELDS).alias("digest"), F.when(tampered, leaf_digest(*presented)).alias("claim"))
    return prove(build_manifest(materialize(leaves, "merkle-leaves"), "source", ["id"]))
