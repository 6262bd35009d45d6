"""Best-fit packing under conflicts.

Documents are packed into bins of a fixed number of words. Bins are kept in the order of what is left in them; every
bin carries a bitmap of sources and one of duplicate clusters. A document goes to the bin with the least room that
still holds it; if the bitmaps forbid that bin, the search goes on to the next larger one, until the tightest
compatible bin is found or a new one is opened.

A bin never holds two documents of one duplicate cluster. A source owns as many bits as its fair share of the
documents of a bin, at least one, so that a source with a third of all rows does not leave bins half empty.

Documents are dealt to shards by the hash of their id, equal rows in turn; a shard is packed by one task and has a bounded number of rows
of a few numbers each. A bin belongs to one shard, so the rules hold over the whole table.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.store import Workspace

PLACES = "doc_id long, piece int, start long, length long, bin_id long, bin_offset long"


@dataclass(frozen=True)
class Packing:
    capacity: int = 2048
    #: Documents per shard; a larger number packs slightly tighter and takes longer in one task.
    shard_docs: int = 8192
    #: Bits of a source over its fair share of a bin.
    slack: float = 1.5


def pack_shard(sizes: list[int], sources: list[int], clusters: list[int], slots: dict[int, int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of every item, items in the given order; sizes are 1 to capacity. A cluster of -1 conflicts with none."""
    first_bit, bits = {}, 0
    for source in sorted(set(sources)):
        first_bit[source] = bits
        bits += slots[source]
    room: list[tuple[int, int]] = []
    used: list[int] = []
    of_source: list[int] = []
    of_cluster: list[int] = []
    bins, offsets = [], []
    before, passed = None, (0, 0)
    for size, source, cluster in zip(sizes, sources, clusters):
        mask = ((1 << slots[source]) - 1) << first_bit[source]
        mark = 1 << cluster if cluster >= 0 else 0
        # What forbade a bin to the item before forbids it to an equal one: the search goes on behind the bin found last.
        again = mark and before == (size, source, cluster)
        at, end = bisect_left(room, passed if again else (size, -1)), len(room)
        before = size, source, cluster
        while at < end:
            b = room[at][1]
            if of_source[b] & mask != mask and not of_cluster[b] & mark:
                break
            at += 1
        if at < end:
            left, b = passed = room.pop(at)
        else:
            left, b = capacity, len(used)
            passed = (capacity + 1, 0)
            used.append(0)
            of_source.append(0)
            of_cluster.append(0)
        free = mask & ~of_source[b]
        of_source[b] |= free & -free
        of_cluster[b] |= mark
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        if left > size:
            insort(room, (left - size, b))
    return bins, offsets


def _packer(params: Packing, slots: dict):
    capacity = params.capacity

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        rows = rows.sort_values(["size", "doc_id", "cluster"], ascending=[False, True, True], na_position="last", kind="stable").reset_index(drop=True)
        names = [None if pd.isna(x) else x for x in rows["source"]]
        codes = {name: i for i, name in enumerate(sorted(set(names), key=lambda x: (x is None, x or "")))}
        per_code = {i: slots.get(name, 1) for name, i in codes.items()}
        seen = rows["cluster"].value_counts()
        dense = {c: i for i, c in enumerate(sorted(seen[seen > 1].index))}
        items, out, full = [], [], 0
        for i, (doc, size, cluster) in enumerate(zip(rows["doc_id"], rows["size"], rows["cluster"])):
            doc = None if pd.isna(doc) else int(doc)
            if size == 0:
                out.append((doc, 0, 0, 0, None, None))
                continue
            whole, rest = divmod(int(size), capacity)
            for piece in range(whole):
                out.append((doc, piece, piece * capacity, capacity, (shard << 32) + (1 << 31) + full, 0))
                full += 1
            if rest:
                items.append((rest, i, doc, whole, -1 if pd.isna(cluster) else dense.get(cluster, -1)))
        items.sort(key=lambda x: (-x[0], x[1]))
        bins, offsets = pack_shard([x[0] for x in items], [codes[names[x[1]]] for x in items], [x[4] for x in items], per_code, capacity)
        out += [(doc, whole, whole * capacity, rest, (shard << 32) + b, at) for (rest, _, doc, whole, _), b, at in zip(items, bins, offsets)]
        done = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "bin_id", "bin_offset"])
        return done.astype({"doc_id": "Int64", "piece": "Int32", "start": "Int64", "length": "Int64", "bin_id": "Int64", "bin_offset": "Int64"})

    return pack


def pack_documents(sizes: DataFrame, params: Packing = Packing()) -> DataFrame:
    """Places of rows with doc_id, size, source and cluster: (doc_id, piece, start, length, bin_id, bin_offset).

    A document of more words than a bin gives whole pieces that fill a bin each, and its rest is packed; ``start`` and
    ``length`` say which words of the document a piece holds. A document without words has one row with null bin.
    A null cluster conflicts with none, a null source is a source of its own. Repeated rows are packed as often as they
    occur; ties in size go by id. An empty table gives an empty result; further columns are not read.
    """
    work = Workspace(sizes.sparkSession, "packing")
    rows = work.save(sizes.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"), F.col("source").cast("string").alias("source"), F.col("cluster").cast("long").alias("cluster")), "sizes")
    # One row per source comes to the driver.
    rest = F.col("size") % params.capacity
    stats = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum(rest).alias("words"), F.count_if(rest > 0).alias("parts")).collect()
    words, parts = sum(r["words"] or 0 for r in stats), sum(r["parts"] for r in stats)
    per_bin = params.capacity * parts / words if words else 1
    slots = {r["source"]: max(1, math.ceil(params.slack * per_bin * r["parts"] / max(parts, 1))) for r in stats}
    shards = max(1, math.ceil(sum(r["n"] for r in stats) / params.shard_docs))
    # Equal rows are dealt in turn; they conflict with each other wherever they are.
    each = rows.groupBy("doc_id", "size", "source", "cluster").agg(F.count("*").alias("n")).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    turned = F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)) + F.col("turn")
    dealt = each.withColumn("shard", F.pmod(turned, F.lit(shards)).cast("long")).drop("n", "turn")
    return dealt.groupBy("shard").applyInPandas(_packer(params, slots), PLACES)
