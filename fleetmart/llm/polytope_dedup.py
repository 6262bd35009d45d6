"""Near-duplicate vectors by cross-polytope hashing.

A vector is turned by three rounds of random signs and fast Hadamard transforms; its hash is the nearest vertex of the
cross-polytope, that is the largest component and its sign. Several hashes together name a bucket of a table. Each
vector also visits the buckets that the second largest component of one hash would give. Vectors that meet in a bucket
are compared by their exact cosine.

Equal vectors of one label are one class. Buckets with the same members are compared once. Small buckets list their
pairs; larger ones are cut into blocks and every two blocks are one task that hands on counts and no pairs. A pair that
shares a small bucket is counted there, any other in the least bucket that its vectors share, so numbers of links are
sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.graph import components
from fleetmart.llm.store import Workspace
from fleetmart.llm.vectors import by_length, cast_vectors, matrix, scaled, unit, usable
from fleetmart.llm.words import mix


@dataclass(frozen=True)
class PolytopeDedup:
    """Parameters; one more hash per bucket suits about a hundred times the vectors."""

    cosine: float = 0.98
    tables: int = 8
    hashes: int = 3
    #: Buckets up to this size list their pairs.
    listed: int = 32
    block: int = 512
    seed: int = 23


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def buckets(x: np.ndarray, p: PolytopeDedup) -> np.ndarray:
    """(row, table * probe) bucket numbers of unit vectors."""
    n, length = x.shape
    d = 1 << max(1, (length - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :length] = x
    rng = np.random.default_rng([p.seed, d])
    out = []
    for table in range(p.tables):
        first, second = [], []
        for _ in range(p.hashes):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            size = np.abs(y)
            top = size.argmax(1)
            np.put_along_axis(size, top[:, None], -1, 1)
            next_ = size.argmax(1)
            first.append(2 * top + (np.take_along_axis(y, top[:, None], 1)[:, 0] < 0))
            second.append(2 * next_ + (np.take_along_axis(y, next_[:, None], 1)[:, 0] < 0))
        for probe in range(-1, p.hashes):
            name = np.full(n, table * 64 + length * 4096, np.uint64)
            for k in range(p.hashes):
                name = mix(name * np.uint64(2 * d + 1) + (second if k == probe else first)[k].astype(np.uint64))
            out.append(name)
    return np.stack(out, 1)


def _hasher(p: PolytopeDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = p.tables * (p.hashes + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.zeros((batch.num_rows, width), np.uint64)
            for rows, x in by_length(batch.column("vector")):
                found[rows] = buckets(unit(x), p)
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            found = mix(found ^ mix(label.view(np.uint64) + np.uint64(7))[:, None])
            edges = np.arange(len(found) + 1, dtype=np.int32) * width
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(found.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), lists], ["rep", "buckets"])

    return run


def _confirmer(p: PolytopeDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                close = np.zeros(batch.num_rows, bool)
                for rows, x in by_length(batch.column("vector_a")):
                    # Vectors of a bucket have one length.
                    x, y = scaled(x), scaled(matrix(batch.column("vector_b").take(pa.array(rows))))
                    close[rows] = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) >= p.cosine
                yield batch.select(["a", "b", "members_a", "members_b"]).filter(pa.array(close))

    return run


def _lists(column: pa.Array) -> np.ndarray:
    """(row, place) of a list column of numbers; places without a number hold one that no other row has."""
    lists = column.to_pylist()
    out = np.iinfo(np.int64).min + np.arange(len(lists))[:, None] + np.zeros((1, max([1, *(len(x) for x in lists if x)])), np.int64)
    for i, x in enumerate(lists):
        if x:
            out[i, : len(x)] = x
    return out


def _block_counter(p: PolytopeDedup):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        here, one, two = (k.as_py() for k in key)
        ids, first = np.unique(rows.column("rep").to_numpy(), return_index=True)
        rows = rows.take(pa.array(first)).combine_chunks()
        weight, block = rows.column("members").to_numpy(), rows.column("block").to_numpy()
        y = unit(matrix(rows.column("vector")))
        close = y @ y.T >= p.cosine
        if one != two:
            close &= block[:, None] != block[None, :]
        i, j = np.nonzero(np.triu(close, 1))
        small, large = _lists(rows.column("small")), _lists(rows.column("large"))
        mine = np.ones(len(i), bool)
        for a in range(small.shape[1]):
            for b in range(small.shape[1]):
                mine &= small[i, a] != small[j, b]
        least = np.full(len(i), np.iinfo(np.int64).max)
        for a in range(large.shape[1]):
            for b in range(large.shape[1]):
                same = large[i, a] == large[j, b]
                least[same] = np.minimum(least[same], large[i[same], a])
        mine &= least == here
        i, j = i[mine], j[mine]
        links = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
        linked = np.zeros((len(ids), len(ids)), bool)
        linked[i, j] = linked[j, i] = True
        label = np.arange(len(ids))
        while True:
            near = np.where(linked, label[None, :], len(ids)).min(1, initial=len(ids))
            new = np.minimum(label, near)
            if (new == label).all():
                break
            label = new
        some = np.flatnonzero(links > 0)
        return pa.table({"rep": pa.array(ids[some]), "links": pa.array(links[some].astype(np.int64)), "root": pa.array(ids[label[some]])})

    return run


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", params: PolytopeDedup = PolytopeDedup()) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``table``.

    Vectors are compared if their labels are equal and not null and their lengths are equal. Null and zero vectors and
    those with null or non-finite components have no links. Rows that repeat an id count as several vectors of that id.
    A row without an id has no links, a null component, and is kept. An empty table gives an empty result; further
    columns are not read.
    """
    work = Workspace(table.sparkSession, "polytope")
    rows = cast_vectors(table, id_col, vector_col, F.col(label_col).cast("long").alias("label"))
    usable_row = usable("vector") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    classes = work.save(rows.where(usable_row).groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("members")), "classes")
    hashed = work.save(classes.mapInArrow(_hasher(params), "rep long, buckets array<long>"), "buckets")

    met = hashed.select("rep", F.explode(F.array_distinct("buckets")).alias("bucket"))
    size = met.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("same")).where("n > 1")
    once = size.groupBy("n", "same").agg(F.min("bucket").alias("bucket"))
    once = work.save(once.select("bucket", "n", F.ceil(F.col("n") / params.block).cast("int").alias("parts")), "once")
    placed = work.save(met.join(once, "bucket").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")), "placed")
    vectors = classes.select("rep", "members", "vector")

    small = placed.where(F.col("n") <= params.listed).select("bucket", "rep")
    pairs = small.select("bucket", F.col("rep").alias("a")).join(small.select("bucket", F.col("rep").alias("b")), "bucket").where("a < b").select("a", "b").distinct()
    side = lambda k: vectors.select(F.col("rep").alias(k), F.col("members").alias(f"members_{k}"), F.col("vector").alias(f"vector_{k}"))
    listed = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_confirmer(params), "a long, b long, members_a long, members_b long")
    listed = work.save(listed, "listed")
    found = listed.select(F.col("a").alias("rep"), F.col("members_b").alias("links"), F.col("b").alias("root")).unionByName(
        listed.select(F.col("b").alias("rep"), F.col("members_a").alias("links"), F.col("a").alias("root"))
    )

    large = placed.where(F.col("n") > params.listed)
    if not large.isEmpty():
        held = lambda few: F.collect_list(F.when(few, F.col("bucket")))
        kept = placed.groupBy("rep").agg(held(F.col("n") <= params.listed).alias("small"), held(F.col("n") > params.listed).alias("large"))
        # Block k of a bucket meets every block: the smaller of two blocks comes first in the name of their task.
        sent = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        sent = sent.select("rep", "bucket", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
        sent = sent.join(vectors, "rep").join(kept, "rep")
        blocks = sent.groupBy("bucket", "one", "two").applyInArrow(_block_counter(params), "rep long, links long, root long")
        found = found.unionByName(work.save(blocks, "blocks"))

    groups = work.save(components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), work), "groups")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.join(links, "rep", "left").join(groups.withColumnRenamed("id", "rep"), "rep", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    alone = rows.where(~usable_row).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    told = rows.where(usable_row).join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id").unionByName(alone)
    return told.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
