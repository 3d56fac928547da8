"""Connected components of a link table, and linking within groups in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.storage import materialize


HOT_ROWS = 8192  # rows of a key (some 100 KB) up to which it is not hot
HOT_KEYS = 100_000  # keys that are broadcast at most


def hot_rows(bound: int) -> int:
    """A key of more rows than this, among ``bound`` rows, is hot; there are fewer than ``HOT_KEYS`` of them, whatever the rows."""
    return max(HOT_ROWS, -(-bound // HOT_KEYS))


def join_totals(rows: DataFrame, totals: DataFrame, key: str, bound: int) -> DataFrame:
    """``rows`` joined with ``totals``, a written table with one row per ``key`` and in ``_rows`` how many of ``rows`` hold it (or more).
    Where a key is hot, the rows of hot keys do not move (``_join_hot``). ``bound``: ``rows`` has no more rows, nor the sum of ``_rows``."""
    largest = totals.agg(F.max("_rows")).first()[0]
    return _join_hot(rows, totals, key, bound) if largest and largest > hot_rows(bound) else rows.join(totals.drop("_rows"), key)


def _join_hot(rows: DataFrame, totals: DataFrame, key: str, bound: int) -> DataFrame:
    """Rows of a hot key stay where they are and meet its total by a broadcast of fewer than ``HOT_KEYS`` totals; all others
    are shuffled by key, so none gathers more than ``hot_rows(bound)`` rows in a task."""
    many = hot_rows(bound)
    hot = totals.filter(F.col("_rows") > many).drop("_rows")
    known = totals.filter(F.col("_rows") <= many).drop("_rows")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(known, key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(a, b)`` links -> ``(node, component)`` for every linked node; the component is its smallest node.

    Alternating star steps: every node links its larger neighbours to its smallest neighbour, then every node
    links its smaller neighbours to the smallest of them; a logarithmic number of rounds ends in stars. Minima are
    combined before their shuffle and handed back to the links by node; while a node has more than ``hot_rows`` links, the minima
    of such nodes are broadcast (``_join_hot``) and their links stay where they are. Each round is written to the shared folder.
    """
    links = materialize(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "links")
    while True:
        apart, largest, n = _shape(links)
        if not apart:
            break
        links = materialize(_round(links, 2 * n if largest > hot_rows(2 * n) else None), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _round(links: DataFrame, bound: int | None) -> DataFrame:
    """The links after both star steps; with ``bound`` (a bound of the links from both ends) nodes of many links take the other way."""

    def handed(rows: DataFrame, least: DataFrame) -> DataFrame:
        return rows.join(least.drop("_rows"), "a") if bound is None else _join_hot(rows, least, "a", bound)

    minimum = [F.min("b").alias("m"), F.count(F.lit(1)).alias("_rows")]
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(*minimum).withColumn("m", F.least("a", "m"))
    large = handed(both.filter("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b"))
    near = large.groupBy("a").agg(*minimum)
    small = handed(large, near).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return small.unionByName(near.select("a", F.col("m").alias("b"))).distinct()


def _shape(links: DataFrame) -> tuple[bool, int, int]:
    """Whether a node has several smaller neighbours, or one and larger ones too (else all are stars around the components);
    the most links of a node; the number of links."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    apart = F.max(F.expr("up > 1 OR (up = 1 AND down > 0)"))
    row = nodes.agg(apart.alias("apart"), F.max(F.col("up") + F.col("down")).alias("largest"), F.sum("up").alias("n")).first()
    return bool(row["apart"]), row["largest"] or 0, row["n"] or 0


def block_pairs(members: DataFrame, totals: DataFrame, group: str, block_rows: int, member: str, bound: int) -> DataFrame:
    """Deal the members of the groups in ``totals`` (``group, _rows``: its members) into blocks of about ``block_rows`` (``block``) and
    add ``bi, bj``: a row for each pair of blocks that a member's own block is in. A smaller group is one block. ``bound``: at most so many ``members``."""
    dealt = join_totals(members, totals.withColumn("blocks", F.ceil(F.col("_rows") / block_rows)), group, bound)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(7), member), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return dealt.withColumn("_other", other).withColumns({"bi": F.least("block", "_other"), "bj": F.greatest("block", "_other")}).drop("blocks", "_other")


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys (without nulls), from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            changed |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        if held and tuple(c[0] for c in columns) != last:
            yield pa.Table.from_batches(held)
            held = []
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if start:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def star_links(names: np.ndarray, pairs: list[tuple[int, int]]) -> pa.RecordBatch | None:
    """Pairs of positions, some joined with others -> links of each position to the first of those it is joined with."""
    if not pairs:
        return None
    forest = Forest(len(names))
    for i, j in pairs:
        forest.join(i, j)
    root = np.array([forest.root(i) for i in range(len(names))])
    far = np.flatnonzero(root != np.arange(len(names)))
    return pa.record_batch([pa.array(names[far]), pa.array(names[root[far]])], ["a", "b"])


class Forest:
    """Union-find over 0..n-1; the smallest member is the root."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """Whether the two were apart."""
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True
