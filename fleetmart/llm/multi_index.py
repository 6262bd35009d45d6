"""Nearest vectors by an inverted multi-index.

Unit vectors are cut into two halves and each half is quantised to one of a few centroids, so a cell is a pair of
centroids. A query visits cells in the order of its summed distance to both centroids, by a heap over the two sorted
lists, until the cells hold enough vectors; these are ranked by their exact cosine.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetmart.llm.store import Workspace
from fleetmart.llm.vectors import by_length, cast_vectors, matrix, scaled, unit, usable


@dataclass(frozen=True)
class MultiIndex:
    """Parameters."""

    neighbours: int = 5
    #: Centroids per half.
    centroids: int = 64
    #: Vectors the centroids are fitted on: a bounded sample chosen by hash. Every vector is indexed.
    sample: int = 16_384
    #: A query visits cells until they hold this share of all vectors, and at least so many.
    #: The sample vectors have hardly any clusters: 0.45 finds 96 of 100 neighbours, 0.3 finds 88.
    share: float = 0.45
    least: int = 2_000
    #: Vectors ranked in one task.
    block: int = 4_096
    groups: int = 32
    rounds: int = 12
    seed: int = 5


def nearest_centroid(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)


def fit_centroids(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's iterations from k rows of the sample."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = nearest_centroid(x, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def visit(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of ``first[i] + second[j]`` until their sizes reach ``wanted``; empty cells are passed over."""
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, got, out = [(first[one[0]] + second[two[0]], 0, 0)], {(0, 0)}, 0, []
    while heap and got < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(one[i]) * len(second) + int(two[j])
        if sizes[cell]:
            out.append(cell)
            got += int(sizes[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(one) and b < len(two) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (first[one[a]] + second[two[b]], a, b))
    return out


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


def _assigner(books: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(batch.num_rows, np.int32)
            for rows, x in by_length(batch.column("vector")):
                one, two = _halves(unit(x))
                book = books[x.shape[1]]
                cells[rows] = nearest_centroid(one, book[0]) * len(book[1]) + nearest_centroid(two, book[1])
            yield pa.RecordBatch.from_arrays([batch.column("ids"), batch.column("vector"), pa.array(cells)], ["ids", "vector", "cell"])

    return run


def _visitor(books: dict, sizes: dict, p: MultiIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list = [None] * batch.num_rows
            for rows, x in by_length(batch.column("vector")):
                book, size = books[x.shape[1]], sizes[x.shape[1]]
                wanted = max(p.least, int(p.share * size.sum()))
                for row, one, two in zip(rows, *_halves(unit(x))):
                    cells[row] = visit(((book[0] - one) ** 2).sum(1), ((book[1] - two) ** 2).sum(1), size, wanted)
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vector"), pa.array(cells, pa.list_(pa.int32()))], ["query_id", "vector", "cells"])

    return run


def _ranker(p: MultiIndex):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and queries.num_rows:
            x, ids = scaled(matrix(rows.column("vector"))), rows.column("ids").to_pylist()
            norms, cells = np.sqrt((x * x).sum(1)), rows.column("cell").to_numpy()
            order = np.argsort(cells, kind="stable")
            x, norms, cells = x[order], norms[order], cells[order]
            for query, q, wanted in zip(queries.column("query_id").to_pylist(), scaled(matrix(queries.column("vector"))), queries.column("cells").to_pylist()):
                low, high = np.searchsorted(cells, wanted, "left"), np.searchsorted(cells, wanted, "right")
                at = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
                if not len(at):
                    continue
                # Row by row, so equal directions get equal values wherever they stand.
                score = (x[at] * q).sum(1) / (norms[at] * np.sqrt((q * q).sum()))
                k = min(len(at), p.neighbours + 1)
                bar = np.partition(score, len(at) - k)[len(at) - k]
                near = sorted((-s, v) for s, r in zip(score[score >= bar], at[score >= bar]) for v in ids[order[r]] if v != query)
                out += [(query, v, -s) for s, v in near[: p.neighbours]]
        return pa.table({
            "query_id": pa.array([o[0] for o in out], pa.int64()), "vec_id": pa.array([o[1] for o in out], pa.int64()), "score": pa.array([o[2] for o in out], pa.float64())
        })

    return run


def nearest_vectors(table: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", params: MultiIndex = MultiIndex()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the nearest rows of ``table`` but its own id.

    Both have an id and a vector. Nearest first by cosine, ties to the smaller id; all candidates if there are fewer.
    Vectors that are null, zero or hold null or non-finite components, and rows without an id, take no part; vectors of
    different length are not compared. Equal vectors are ranked once and stand for their smallest ids, so a vector that
    very many rows share costs no more than others. Rows that repeat an id and its vector count once; an id with
    several vectors is ranked by each of them, and asks with each. Empty tables give
    an empty result; further columns are not read.
    """
    work = Workspace(table.sparkSession, "multi-index")
    good = usable("vector") & F.col("vec_id").isNotNull()
    rows = cast_vectors(table, id_col, vector_col).where(good).distinct()
    enough = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(enough)).where(F.col("_n") <= params.neighbours + 1)
    different = work.save(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "different")

    lengths = different.groupBy(F.size("vector").alias("length")).count().collect()
    books, rng = {}, np.random.default_rng(params.seed)
    for length, n in sorted((r["length"], r["count"]) for r in lengths):
        part = F.pmod(F.xxhash64("vector"), F.lit(1_000_000)) < F.lit(1_000_000 * min(1.0, params.sample / n))
        # At most about ``sample`` vectors; sorted, so a repeated run fits the same centroids.
        drawn = different.where((F.size("vector") == length) & part).select("vector").toArrow().column("vector")
        x = matrix(drawn)
        if not len(x):
            x = matrix(different.where(F.size("vector") == length).select("vector").limit(1).toArrow().column("vector"))
        x = unit(x[np.lexsort(x.T)])
        books[length] = tuple(fit_centroids(h, params.centroids, params.rounds, rng) if h.shape[1] else np.zeros((1, 0)) for h in _halves(x))

    index = work.save(different.mapInArrow(_assigner(books), "ids array<long>, vector array<double>, cell int"), "index")
    sizes = {length: np.zeros(len(b[0]) * len(b[1]), np.int64) for length, b in books.items()}
    # One row per cell.
    for r in index.groupBy(F.size("vector").alias("length"), "cell").count().collect():
        sizes[r["length"]][r["cell"]] = r["count"]

    group = F.pmod(F.xxhash64("cell"), F.lit(params.groups)).cast("int")
    asked = cast_vectors(queries, id_col, vector_col).where(good).distinct().withColumnRenamed("vec_id", "query_id").where(F.size("vector").isin(list(books)))
    visits = asked.repartition(params.groups, "query_id").mapInArrow(_visitor(books, sizes, params), "query_id long, vector array<double>, cells array<int>")
    visits = visits.select("query_id", "vector", F.explode("cells").alias("cell")).withColumn("group", group)
    visits = visits.groupBy("query_id", "vector", "group").agg(F.collect_list("cell").alias("cells")).withColumn("length", F.size("vector"))

    placed = index.withColumn("group", group).withColumn("length", F.size("vector"))
    parts = work.save(placed.groupBy("length", "group").agg(F.ceil(F.count("*") / params.block).cast("int").alias("parts")), "parts")
    placed = placed.join(parts, ["length", "group"]).withColumn("part", F.pmod(F.xxhash64("vector"), F.col("parts")).cast("int"))
    sent = visits.join(parts, ["length", "group"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = ["length", "group", "part"]
    sent = sent.select("query_id", "vector", "cells", *[(F.col(k) + 0).alias(k) for k in key])
    placed = placed.select("ids", "vector", "cell", *key)
    near = sent.groupBy(*key).cogroup(placed.groupBy(*key)).applyInArrow(_ranker(params), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= params.neighbours).select("query_id", "rank", "vec_id", "score")
