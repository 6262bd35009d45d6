"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle fingerprints gives two signature values, its minimum and its maximum, so a signature of
2k values costs k permutations; both are unbiased estimators of the Jaccard similarity, and their mean varies less than
two minima of independent permutations. Bands of the signature propose candidates; whole shingle sets confirm them.

Documents with the same shingle set are one class and are compared once, whatever their number. Inside a bucket of a
band every class is first compared with the least class of the bucket only; classes that this leaves in different
components of a bucket are then compared with each other. Two classes of one component need no further comparison, so
a group of near copies costs about one comparison per class, and no link between components is lost. In small buckets
such pairs are listed; large ones are cut into blocks of classes, and two blocks are compared in one task that counts all
shared shingles at once and hands on no more links than it has classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm.graph import components
from fleetmart.llm.store import Workspace
from fleetmart.llm.words import each_slice, mix


@dataclass(frozen=True)
class MinMaxDedup:
    """Parameters.

    A pair of similarity t meets in a band with probability p = t^rows. Candidates meet in two bands or in a large
    bucket; at 0.8 a pair escapes with probability 1.1e-6.
    """

    shingle_words: int = 5
    #: Links need 100 * shared >= percent * united.
    percent: int = 80
    bands: int = 32
    #: Signature values per band, a minimum and a maximum from every permutation.
    rows: int = 4
    lower: bool = True
    seed: int = 17
    #: Buckets up to this size list their pairs.
    listed: int = 32
    #: Classes per block of a larger bucket.
    block: int = 512

    @property
    def permutations(self) -> int:
        return self.bands * self.rows // 2


def shingle_sets(column: pa.Array, k: int, lower: bool) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first text, sorted distinct shingles of successive texts); fewer than k words make one shingle, no words none."""
    # Weights per place are odd and fixed, so equal word sequences get equal fingerprints.
    weights = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    for i, j, h, first in each_slice(column, lower):
        n = max(0, len(h) - k + 1)
        whole = np.zeros(n, np.uint64)
        for p in range(k):
            whole += h[p : p + n] * weights[p]
        whole = mix(whole + np.uint64(k))
        out = []
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= k:
                out.append(np.unique(whole[a : b - k + 1]))
            elif b > a:
                out.append(mix((h[a:b] * weights[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
        yield i, out


def _signer(p: MinMaxDedup):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(p.seed)
        scale = rng.integers(0, 1 << 63, p.permutations, np.uint64) * np.uint64(2) + np.uint64(1)
        shift = rng.integers(0, 1 << 63, p.permutations, np.uint64)
        band_of = np.repeat(np.arange(p.bands, dtype=np.uint64), p.rows)
        weight = mix(np.arange(p.permutations * 2, dtype=np.uint64) + np.uint64(977)) | np.uint64(1)
        for batch in batches:
            counts, marks, other, keys = [], [], [], []
            for _, sets in shingle_sets(batch.column("text"), p.shingle_words, p.lower):
                size = np.array([len(s) for s in sets])
                counts.append(size)
                flat = np.concatenate(sets)
                sign = np.zeros((len(sets), p.permutations * 2), np.uint64)
                one, two = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                full = np.flatnonzero(size)
                if len(flat):
                    heads = (np.cumsum(size) - size)[full]
                    one[full] = np.add.reduceat(mix(flat ^ np.uint64(0xA5A5)), heads)
                    two[full] = np.bitwise_xor.reduceat(mix(flat + np.uint64(0x5A5A5)), heads)
                    for i in range(p.permutations):
                        order = flat * scale[i] + shift[i]
                        sign[full, 2 * i] = np.minimum.reduceat(order, heads)
                        sign[full, 2 * i + 1] = np.maximum.reduceat(order, heads)
                marks.append(one)
                other.append(two)
                bands = (mix(sign) * weight).reshape(len(sets), p.bands, p.rows).sum(2, dtype=np.uint64)
                keys.append(mix(bands + mix(band_of[:: p.rows] + np.uint64(1))))
            if not counts:
                continue
            size, key = np.concatenate(counts), np.concatenate(keys)
            n = len(size)
            width = np.where(size > 0, p.bands, 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(width))).astype(np.int32)), pa.array(key[size > 0].ravel().view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(np.concatenate(marks).view(np.int64)), pa.array(np.concatenate(other).view(np.int64)), lists],
                ["doc_id", "n_shingles", "mark", "mark2", "bands"],
            )
            assert len(lists) == n

    return sign


def _sets_of(column: pa.Array, p: MinMaxDedup) -> list[np.ndarray]:
    return [s for _, part in shingle_sets(column, p.shingle_words, p.lower) for s in part]


def _confirmer(p: MinMaxDedup):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("a", "b"):
                ids, first, place = np.unique(batch.column(name).to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
                sides.append((_sets_of(batch.column(f"text_{name}").take(pa.array(first)), p), place))
            keep = []
            for i, j in zip(sides[0][1], sides[1][1]):
                x, y = sides[0][0][i], sides[1][0][j]
                both = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= p.percent * max(len(x), len(y)) else 0
                keep.append(both > 0 and 100 * both >= p.percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of all pairs of sets, by products of 0/1 matrices over the shingles that two sets hold."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = held[column] > 1
    owner, column = owner[common], column[common]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    width = 2048
    for low in range(0, int(column.max()) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [low, low + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[i:j], column[i:j] - low] = 1
        total += part @ part.T
    return total


def _block_linker(p: MinMaxDedup):
    def link(rows: pa.Table) -> pa.Table:
        ids, first = np.unique(rows.column("rep").to_numpy(), return_index=True)
        text, component = rows.column("text").take(pa.array(first)), rows.column("component").to_numpy()[first]
        sets = _sets_of(text, p)
        both, size = shared_counts(sets), np.array([len(s) for s in sets], float)
        linked = (100 * both >= p.percent * (size[:, None] + size[None, :] - both)) & (component[:, None] != component[None, :])
        # The least member reachable in the block stands for all links of it.
        label = np.arange(len(ids))
        while True:
            near = np.where(linked, label[None, :], len(ids)).min(1, initial=len(ids))
            new = np.minimum(label, near)
            if (new == label).all():
                break
            label = new
        moved = np.flatnonzero(label < np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[moved]), "b": pa.array(ids[label[moved]])})

    return link


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: MinMaxDedup = MinMaxDedup()) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``docs``.

    Null and blank texts have no shingles and are linked with nothing. A row without an id is linked with nothing either:
    its component is null and it is kept. Repeated rows share their id and so their component. Ties do not arise: a
    component is named by its least id. An empty table gives an empty result; further columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    work = Workspace(spark, "minmax")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, mark long, mark2 long, bands array<long>"
    signed = work.save(texts.mapInArrow(_signer(params), schema), "signatures")
    usable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    key = ["mark", "mark2", "n_shingles"]
    classes = work.save(signed.where(usable).groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")

    rows = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.count("*").alias("members")).where("members > 1")
    # The small side is written first: a join of two plain shuffles is one whose hot keys AQE can split.
    met = work.save(rows.join(work.save(shared.select("bucket", "pivot"), "shared"), "bucket"), "met")
    candidates = work.save(
        texts.join(met.select(F.col("rep").alias("doc_id")).distinct(), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text")), "texts"
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(candidates.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
            candidates.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"
        )
        return work.save(both.select("a", "b", "text_a", "text_b").mapInArrow(_confirmer(params), "a long, b long"), "confirmed")

    def placed(frame: DataFrame, column: str, groups: DataFrame, name: str) -> DataFrame:
        known = groups.select(F.col("id").alias(column), F.col("component").alias("_c"))
        return frame.join(known, column, "left").withColumn(name, F.coalesce("_c", column)).drop("_c")

    def apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
        return placed(placed(pairs, "a", groups, "ca"), "b", groups, "cb").where("ca <> cb").select("a", "b")

    stars = met.where("rep > pivot").groupBy(F.col("rep").alias("a"), F.col("pivot").alias("b")).agg(F.count("*").alias("n"))
    stars = work.save(stars.where("n > 1"), "stars")
    best = stars.groupBy("a").agg(F.max(F.struct("n", (-F.col("b")).alias("b"))).alias("top")).select("a", (-F.col("top.b")).alias("b"))
    best = work.save(best, "best")
    links = confirmed(best)
    groups = work.save(components(links, work), "groups")

    more = work.save(apart(stars.select("a", "b").join(best, ["a", "b"], "left_anti"), groups), "more")
    if not more.isEmpty():
        links = links.unionByName(confirmed(more))
        groups = work.save(components(links, work), "groups")

    # What is left: classes of one bucket in different components.
    told = placed(met, "rep", groups, "component")
    mixed = told.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("same")
    ).where("low < high")
    told = work.save(told.join(work.save(mixed.select("bucket", "members", "same"), "mixed"), "bucket").select("bucket", "members", "same", "rep", "component"), "mixed")

    small = told.where(F.col("members") <= params.listed).join(classes.select("rep", "n_shingles"), "rep")
    x, y = (small.select("bucket", *[F.col(c).alias(c + side) for c in ("rep", "component", "n_shingles")]) for side in ("_x", "_y"))
    alike = F.least("n_shingles_x", "n_shingles_y") * 100 >= F.greatest("n_shingles_x", "n_shingles_y") * params.percent
    across = x.join(y, "bucket").where((F.col("component_x") < F.col("component_y")) & alike)
    across = across.groupBy(F.greatest("rep_x", "rep_y").alias("a"), F.least("rep_x", "rep_y").alias("b")).agg(F.count("*").alias("n")).where("n > 1")
    across = work.save(across.select("a", "b").join(stars.select("a", "b"), ["a", "b"], "left_anti"), "across")
    late = [confirmed(across)]

    large = told.where(F.col("members") > params.listed)
    if not large.isEmpty():
        # Buckets with the same members are one. A component with more than a block in a bucket has blocks of its own.
        once = large.groupBy("members", "same").agg(F.min("bucket").alias("bucket")).select("bucket")
        large = large.join(once, "bucket").select("bucket", "rep", "component")
        count = large.groupBy("bucket", "component").agg(F.count("*").alias("c")).withColumn("own", F.col("c") > params.block)
        side = count.withColumn("side", F.when(F.col("own"), F.col("component")))
        parts = side.groupBy("bucket", "own", "side").agg(F.ceil(F.sum("c") / params.block).cast("int").alias("parts"))
        block = F.xxhash64("own", "side", "part")
        members = large.join(side.select("bucket", "component", "own", "side"), ["bucket", "component"]).join(parts.select("bucket", "own", F.col("side").alias("_side"), "parts"), ["bucket", "own"])
        members = members.where(F.col("side").eqNullSafe(F.col("_side"))).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).select("bucket", "rep", "component", block.alias("block"))
        blocks = parts.select("bucket", "own", "side", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).withColumn("block", block)
        one, two = (blocks.select("bucket", *[F.col(c).alias(c + k) for c in ("own", "side", "block")]) for k in ("_1", "_2"))
        meet = one.join(two, "bucket").where(
            ((F.col("block_1") < F.col("block_2")) & ~(F.col("own_1") & F.col("own_2") & (F.col("side_1").eqNullSafe(F.col("side_2"))))) | ((F.col("block_1") == F.col("block_2")) & ~F.col("own_1"))
        ).select("bucket", "block_1", "block_2")
        sent = meet.select("bucket", F.col("block_1").alias("block"), "block_1", "block_2").unionByName(
            meet.where("block_1 <> block_2").select("bucket", F.col("block_2").alias("block"), "block_1", "block_2")
        )
        sent = members.join(sent, ["bucket", "block"]).join(candidates.withColumnRenamed("doc_id", "rep"), "rep")
        linked = sent.select("bucket", "block_1", "block_2", "rep", "component", "text").groupBy("bucket", "block_1", "block_2")
        late.append(work.save(linked.applyInArrow(_block_linker(params), "a long, b long"), "blocks"))
    late = late[0] if len(late) == 1 else late[0].unionByName(late[1])
    if not late.isEmpty():
        groups = work.save(components(links.unionByName(late), work), "groups")

    named = placed(classes.select(*key, "rep"), "rep", groups, "component_id").select(*key, "component_id")
    one: Column = F.when(usable, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return (
        signed.select("doc_id", *key).join(named, key, "left")
        .select("doc_id", "n_shingles", one.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
