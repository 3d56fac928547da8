"""Embedding near-duplicates by E8 lattice hashing.

Each of ``TABLES`` tables projects a unit vector twice to eight dimensions (random orthonormal rows), scales it and
decodes it to the nearest points of the E8 lattice, the best packing of its dimension: the pair of points is the cell, the bucket.
(One point alone has so few cells that unlike vectors share them.) Besides its own cell a vector is entered into those
where one of the points is replaced by one of its ``PROBES`` nearest neighbours (of the 240 around it). Vectors of one label that share a cell are compared by cosine in double precision; links give
components. Links are then counted exactly among all vectors of a component, in pairs of blocks, so
a count does not depend on the cells in which two vectors met.

Vectors that are equal (with their label) are one class with a multiplicity throughout. Cells first exchange
ids only; vectors are sent to cells that hold two classes or more, one of them at home. Pairs are
never rows: tasks hand out a spanning forest of links, and counts.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components, and one whose label is null, links
with nothing; vectors of different lengths never link; repeated rows are vectors of their own; a null ``vec_id`` is
ignored when components are named, if any member has an id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.graph import block_pairs, connected_components, groups_of, join_totals, star_links
from tripspark.llm.hashing import mixed
from tripspark.llm.storage import materialize

COSINE = 0.98
TABLES = 10
PROBES = 2
SCALE = 6.0  # projected vectors have the length sqrt(8 / dimensions) times this
BLOCK_ROWS = 1024
SEED = 8


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors, times two: all (+-2, +-2, 0...) and all (+-1)^8 with an even number of minus signs."""
    pairs = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = [0] * 8
                    v[i], v[j] = a, b
                    pairs.append(v)
    signs = np.array([[1 - 2 * (m >> i & 1) for i in range(8)] for m in range(256)])
    return np.concatenate((np.array(pairs), signs[(signs < 0).sum(axis=1) % 2 == 0]))


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: rounded, and if the sum is odd, the worst coordinate rounded the other way."""
    r = np.rint(x)
    rest = x - r
    odd = np.flatnonzero(r.sum(axis=1) % 2)
    worst = np.abs(rest[odd]).argmax(axis=1)
    r[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
    return r


def e8_nearest(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points (D8, or D8 shifted by one half), times two, as integers."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], half, whole)).astype(np.int64)


def projections(dimensions: int, tables: int, seed: int = SEED) -> np.ndarray:
    """``(tables, dimensions, 8)``: orthonormal columns, or a map into eight dimensions for shorter vectors."""
    out = np.zeros((tables, dimensions, 8))
    for t in range(tables):
        q = np.linalg.qr(np.random.default_rng([seed, dimensions, t]).standard_normal((max(dimensions, 8), 8)))[0]
        out[t] = q[:dimensions]
    return out


def cells(unit: np.ndarray, projection: np.ndarray, scale: float, probes: int, roots: np.ndarray) -> np.ndarray:
    """``(rows, 1 + probes, 8)``: each row's own point and the neighbouring ones by distance, times two."""
    x = unit @ projection * (scale * np.sqrt(unit.shape[1] / 64.0))
    own = e8_nearest(x)
    toward = (x - own / 2.0) @ roots.T  # the larger, the nearer the neighbour
    best = np.argsort(-toward, axis=1, kind="stable")[:, :probes]
    return np.concatenate((own[:, None, :], own[:, None, :] + roots[best]), axis=1)


def cell_keys(unit: np.ndarray, pair: np.ndarray, scale: float, probes: int, roots: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """``(rows, 1 + 2 * probes)``: hashes of a row's own pair of points, and of those with a neighbour on either side."""
    points = np.concatenate([cells(unit, p, scale, probes, roots) for p in pair], axis=2).astype(np.uint64)
    multipliers = np.random.default_rng(1).integers(1, 2**63, 16).astype(np.uint64) | np.uint64(1)
    first, second = (points[:, :, h] * multipliers[h] for h in (slice(0, 8), slice(8, 16)))
    first, second = first.sum(axis=2, dtype=np.uint64), second.sum(axis=2, dtype=np.uint64)
    sums = np.concatenate((first + second[:, :1], first[:, :1] + second[:, 1:]), axis=1) + salt[:, None]
    return mixed(sums).view(np.int64)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vecs, digests = [], []
        for label, x in zip(batch.column("label").to_pylist(), batch.column("embedding"), strict=True):
            values = x.values if x.is_valid else None
            ok = label is not None and values is not None and len(values) and not values.null_count
            v = values.to_numpy(zero_copy_only=False) if ok else None
            ok = ok and np.isfinite(v).all() and v.any()
            vecs.append(np.ascontiguousarray(v).tobytes() if ok else None)
            digests.append(xxhash.xxh3_128_digest(repr(label).encode() + b"\0" + vecs[-1]) if ok else None)
        yield pa.record_batch([batch.column("vec_id"), batch.column("label").cast(pa.string()), pa.array(vecs, pa.binary()), pa.array(digests, pa.binary())], ["vec_id", "label", "vec", "digest"])


def _unit(vecs: list[bytes], dtype: type) -> np.ndarray:
    x = np.frombuffer(b"".join(vecs), dtype).reshape(len(vecs), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither the squares of huge nor those of tiny components are lost
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hasher(dtype: type, tables: int, probes: int, scale: float):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots, known = e8_roots(), {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                vecs, labels, ids = (batch.column(c).to_pylist() for c in ("vec", "label", "cid"))
                sizes = np.array([len(v) for v in vecs])
                for size in np.unique(sizes):  # vectors of one length at a time
                    rows = np.flatnonzero(sizes == size)
                    unit = _unit([vecs[i] for i in rows], dtype)
                    d = unit.shape[1]
                    if d not in known:
                        known[d] = projections(d, 2 * tables)
                    salt = np.array([xxhash.xxh3_64_intdigest(f"{d} {labels[i]}".encode()) for i in rows], np.uint64)
                    key = np.stack(
                        [cell_keys(unit, known[d][2 * t : 2 * t + 2], scale, probes, roots, mixed(salt + np.uint64(t))) for t in range(tables)]
                    )  # tables, rows, cells
                    cid = np.broadcast_to(np.array([ids[i] for i in rows])[None, :, None], key.shape)
                    home = np.broadcast_to(np.arange(key.shape[2]) == 0, key.shape)
                    yield pa.record_batch([pa.array(x.ravel()) for x in (key, cid, home)], ["key", "cid", "home"])

    return hashed


def _linker(dtype: type, cosine: float):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, ["key", "bi", "bj"]):
            if table.num_rows < 2:
                continue
            cid = table.column("cid").to_numpy()
            unit = _unit(table.column("vec").to_pylist(), dtype)
            links = star_links(cid, np.argwhere(np.triu(unit @ unit.T >= cosine, 1)).tolist())
            if links is not None:
                yield links

    return link


def _counter(dtype: type, cosine: float):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, ["component", "bi", "bj"]):
            cid, w, block = (table.column(c).to_numpy() for c in ("cid", "w", "block"))
            bi, bj = table.column("bi")[0].as_py(), table.column("bj")[0].as_py()
            unit = _unit(table.column("vec").to_pylist(), dtype)
            linked = unit @ unit.T >= cosine
            np.fill_diagonal(linked, False)
            if bi != bj:
                linked &= block[:, None] != block[None, :]
            yield pa.record_batch([pa.array(cid), pa.array((linked @ w.astype(np.float64)).astype(np.int64))], ["cid", "n"])

    return count


def lattice_links(classes: DataFrame, dtype: type, cosine: float, tables: int, probes: int, scale: float) -> DataFrame:
    """``(cid, label, vec)`` -> links ``(a, b)`` that connect all classes which met in a cell and link."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = classes.select("cid", "label", "vec").mapInArrow(_hasher(dtype, tables, probes, scale), "key long, cid long, home boolean")
    entries = materialize(entries, "e8-cells")
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("_rows"), F.max("home").alias("home")).filter("_rows > 1 AND home").select("key", "_rows")
    shared = materialize(shared, "e8-shared")
    dealt = block_pairs(entries.select("key", "cid"), shared, "key", BLOCK_ROWS, "cid", entries.count()).join(classes.select("cid", "vec"), "cid")
    dealt = dealt.select("key", "bi", "bj", "cid", "vec").repartition(parts, "key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "cid")
    return dealt.mapInArrow(_linker(dtype, cosine), "a long, b long")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """``(vec_id, embedding, label)`` -> ``vec_id, n_links, component_id, kept``, a row for each one of the input."""
    dtype = np.float32 if embeddings.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64
    source = embeddings.select("vec_id", F.col("embedding") if dtype is np.float32 else F.col("embedding").cast("array<double>"), "label")
    rows = materialize(source.mapInArrow(_prepare, "vec_id long, label string, vec binary, digest binary"), "e8-rows")
    per_class = rows.filter("digest IS NOT NULL").groupBy("digest")
    classes = per_class.agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("w"), F.min("label").alias("label"), F.min("vec").alias("vec"))
    classes = materialize(classes.withColumn("cid", F.xxhash64("digest")), "e8-classes")
    links = materialize(lattice_links(classes, dtype, cosine, tables, probes, scale), "e8-links")
    found = connected_components(links).select(F.col("node").alias("cid"), "component")
    inside = found.join(classes.select("cid", "rep"), "cid")
    names = materialize(inside.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("_rows")), "e8-names")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = block_pairs(found, names.select("component", "_rows"), "component", BLOCK_ROWS, "cid", rows.count()).join(classes.select("cid", "w", "vec"), "cid")
    dealt = dealt.select("component", "bi", "bj", "block", "cid", "w", "vec").repartition(parts, "component", "bi", "bj").sortWithinPartitions("component", "bi", "bj")
    counts = dealt.mapInArrow(_counter(dtype, cosine), "cid long, n long").groupBy("cid").agg(F.sum("n").alias("n"))
    known = (
        classes.select("digest", "cid", "rep", "w")
        .join(join_totals(found, names, "component", rows.count()).select("cid", "component_id"), "cid", "left")
        .join(counts, "cid", "left")
        .select("digest", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    )
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        rows.select("vec_id", "digest")
        .join(known, "digest", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
