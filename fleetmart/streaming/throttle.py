"""Thinning of position pings: keep one only when enough time has passed since the last one kept."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

MINIMUM_GAP_SECONDS = 10
GAPS_PER_SLICE = 64
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BEFORE_ALL = -(2**62)
KEY_BUCKETS = 1024
ROWS_PER_PIECE = 10_000
UNORDERED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
LAST = pa.schema([("_k", pa.string()), ("us", pa.int64())])


def min_gap_seconds(pings_per_minute: int) -> int:
    return max(MINIMUM_GAP_SECONDS, 60 // max(1, pings_per_minute))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that no (_k, _slice) group is split; the rows come sorted by group."""
    name = lambda batch, row: (batch.column("_k")[row].as_py(), batch.column("_slice")[row].as_py())
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = name(batch, batch.num_rows - 1)
        if held and name(held[-1], 0) == last:
            held.append(batch)
            continue
        edge = int(np.flatnonzero(_new_group(batch))[-1])
        done = pa.concat_batches([*held, batch.slice(0, edge)])
        if done.num_rows:
            yield done
        held = [batch.slice(edge)]
    if held:
        yield pa.concat_batches(held)


def _new_group(batch: pa.RecordBatch) -> np.ndarray:
    """True where a (_k, _slice) group begins."""
    codes = batch.column("_k").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    slices = batch.column("_slice").to_numpy(zero_copy_only=False)
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (slices[1:] != slices[:-1])
    return new


def _hops(group: np.ndarray, offset: np.ndarray, width: int, gap_us: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, next): the times of all groups on one line, and the first row of the same group at least a gap later, or -1."""
    line = group * (width + gap_us + 1) + offset
    at = np.searchsorted(line, line + gap_us)
    inside = np.minimum(at, len(line) - 1)
    return line, np.where((at < len(line)) & (group[inside] == group), inside, -1)


def _exits(slice_us: int, gap_us: int):
    """Per slice "first ping taken -> last ping kept", for the pings that can be first; of those with one end the latest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches):
            slices, us = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_slice", "_us"))
            group = np.cumsum(_new_group(batch)) - 1
            offset = us - slices * slice_us
            _, next_ = _hops(group, offset, slice_us, gap_us)
            end = np.where(next_ < 0, np.arange(len(us)), next_)
            while (end[end] != end).any():
                end = end[end]
            early = offset < gap_us
            # Whatever was kept before the slice, the first ping after one gap can be taken at the latest.
            first = np.flatnonzero(early | _new_group(batch) | np.concatenate(([True], early[:-1])))
            told = np.ones(len(first), bool)
            told[:-1] = (group[first][1:] != group[first][:-1]) | (end[first][1:] != end[first][:-1])
            first = first[told]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k").take(pa.array(first)), pa.array(slices[first]), pa.array(us[first]), pa.array(us[end[first]])], ["_k", "_slice", "first_us", "last_us"]
            )

    return run


def _walk(gap_us: int):
    """The last ping kept before every slice of a key; a row for each slice, whose tables have a few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_, slice_, kept, taken = None, None, BEFORE_ALL, False
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for k, s, first, last in zip(*[batch.column(c).to_pylist() for c in ("_k", "_slice", "first_us", "last_us")]):
                if k != key_:
                    key_, slice_, kept = k, None, BEFORE_ALL
                if s != slice_:
                    for column, value in zip(out, (k, s, kept)):
                        column.append(value)
                    slice_, taken = s, False
                if not taken and first >= kept + gap_us:
                    kept, taken = last, True
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["_k", "_slice", "_before"])

    return run


def _thin(slice_us: int, gap_us: int, columns: list[str]):
    """The pings kept; a row without a time stands ahead of its slice and tells the last ping kept before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches):
            slices, us, before = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_slice", "_us", "_before"))
            group = np.cumsum(_new_group(batch)) - 1
            ping = np.flatnonzero(us != BEFORE_ALL)
            head = np.flatnonzero(us == BEFORE_ALL)
            line, next_ = _hops(group[ping], us[ping] - slices[ping] * slice_us, slice_us, gap_us)
            earliest = np.clip(before[head], -(2**61), None) + gap_us - slices[head] * slice_us
            start = group[head] * (slice_us + gap_us + 1) + np.clip(earliest, 0, slice_us)
            at = np.searchsorted(line, start)
            at = at[(at < len(line)) & (group[ping][np.minimum(at, len(line) - 1)] == group[head])] if len(line) else at[:0]
            keep = np.zeros(batch.num_rows, bool)
            while len(at):
                keep[ping[at]] = True
                at = next_[at]
                at = at[at >= 0]
            yield batch.filter(pa.array(keep)).select(columns)

    return run


def ping_downsample(pings: DataFrame, key: str, ts: str, gap_seconds: int, gaps_per_slice: int = GAPS_PER_SLICE) -> DataFrame:
    """Greedy thinning per key, exact for a key of any size. Pings without a time are left out.

    The rule is sequential, but its only memory is the last kept time. Time is cut into slices; each slice is reduced to a
    small table "first ping taken -> last ping kept" (only pings within one gap of the slice's start can be a first one, and
    few different ends remain, since chains that meet stay together). Walking those tables per key gives the last kept time before each slice, and then every
    slice is thinned by itself. All three passes stream over sorted partitions, so that only the pings of a slice are held at once, and a key
    with much of the data is spread over its slices. Within a batch all slices hop from kept ping to kept ping together.
    """
    slice_us, gap_us = gap_seconds * gaps_per_slice * 1_000_000, gap_seconds * 1_000_000
    columns = list(pings.columns)
    k = F.when(F.col(key).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(key).cast("string")))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    base = pings.withColumns({"_k": k, "_us": us}).where("_us is not null").withColumn("_slice", F.floor(F.col("_us") / F.lit(slice_us)).cast("long"))

    small = base.select("_k", "_slice", "_us").repartition("_k", "_slice").sortWithinPartitions("_k", "_slice", "_us")
    tables = small.mapInArrow(_exits(slice_us, gap_us), "_k string, _slice long, first_us long, last_us long")
    ordered = tables.repartition("_k").sortWithinPartitions("_k", "_slice", "first_us")
    entries = ordered.mapInArrow(_walk(gap_us), "_k string, _slice long, _before long")
    # An entry row sorts ahead of its slice and hands it the last kept time; no join is needed.
    heads = entries.withColumn("_us", F.lit(BEFORE_ALL))
    joined = base.withColumn("_before", F.lit(BEFORE_ALL)).unionByName(heads, allowMissingColumns=True)
    sliced = joined.repartition("_k", "_slice").sortWithinPartitions("_k", "_slice", "_us", *columns)
    return sliced.mapInArrow(_thin(slice_us, gap_us, columns), pings.schema)


def _clock_free(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(stored: bytes) -> pa.Table:
    return pa.ipc.open_stream(stored).read_all()


def _first_at(group: np.ndarray, t: np.ndarray, of: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The first row of group ``of`` at or after each wanted time, or -1; the rows come sorted by group and time."""
    n = len(t)
    order = np.lexsort((np.arange(n + len(of)) < n, np.concatenate([t, wanted]), np.concatenate([group, of])))
    row = order < n
    at = np.empty(len(of), np.int64)
    at[order[~row] - n] = np.cumsum(row)[~row]
    found = at < n
    found[found] = group[at[found]] == of[found]
    return np.where(found, at, -1)


class Thinner(StatefulProcessor):
    """Pings of a bucket of keys that the watermark has not passed, in Arrow pieces, and the last one kept of each key.

    A timer decides the passed ones of all keys of the bucket together, so the cost follows the rows and not the keys.
    """

    def __init__(self, schema: T.StructType, columns: list[str], gap_us: int):
        self.schema, self.columns, self.gap_us = schema, columns, gap_us

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "pings binary")
        self.last = handle.getValueState("last", "keys binary")
        self.settled: set = set()

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(us // 1000 + 1)

    def _shape(self) -> pa.Schema:
        return to_arrow_schema(self.schema)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        first = None
        for frame in rows:
            if len(frame):
                # Spark hands on names that begin with an underscore by their place.
                frame = frame.set_axis(self.columns, axis=1)
                pings = pa.Table.from_pandas(frame[self.schema.names], schema=self._shape(), preserve_index=False, nthreads=1)
                self.waiting.appendValue((_packed(pings),))
                low = int(frame["_us"].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self._wake(first)
        return iter([])

    def _sorted(self, pings: pa.Table) -> pa.Table:
        """By key and time; equal times by the other columns, as far as they have an order."""
        rest = [f.name for f in self.schema if f.name not in ("_k", "_us") and not isinstance(f.dataType, UNORDERED)]
        order = pc.sort_indices(pings, [(c, "ascending") for c in ("_k", "_us", *rest)], null_placement="at_end")
        return pings.take(order).combine_chunks()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        # All timers of a bucket that the watermark has passed come one after another; the first one decides everything.
        if key in self.settled:
            return
        self.settled.add(key)
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        stored = self.last.get()
        last = _unpacked(stored[0]) if stored else LAST.empty_table()
        last_us = last["us"].to_numpy()
        pings = [_unpacked(p) for (p,) in self.waiting.get()]
        pings = self._sorted(pa.concat_tables(pings)) if pings else self._shape().empty_table()
        t = pings["_us"].to_numpy()

        codes = pings["_k"].combine_chunks().dictionary_encode()
        group = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        known = pc.index_in(codes.dictionary, value_set=last["_k"].combine_chunks())
        earliest = np.full(len(codes.dictionary), BEFORE_ALL, np.int64)
        has = known.is_valid().to_numpy(zero_copy_only=False)
        earliest[has] = last_us[known.drop_null().to_numpy()] + self.gap_us
        at, next_ = _first_at(group, t, np.arange(len(earliest)), earliest), _first_at(group, t, group, t + self.gap_us)
        keep = np.zeros(len(t), bool)
        while len(at := at[at >= 0]) and len(at := at[t[at] <= mark]):
            keep[at] = True
            at = next_[at]

        # A key's last ping kept is held while others of it wait, and until a gap has passed.
        kept = np.full(len(earliest), BEFORE_ALL, np.int64)
        kept[group[keep]] = t[keep]
        rest, found = pings.filter(pa.array(t > mark)), pa.array(kept != BEFORE_ALL)
        fresh = pa.table([codes.dictionary.filter(found), pa.array(kept).filter(found)], schema=LAST)
        last = pa.concat_tables([last.filter(pc.invert(pc.is_in(last["_k"], value_set=fresh["_k"].combine_chunks()))), fresh])
        needed = pc.greater(last["us"], mark - self.gap_us)
        ends = last["us"].filter(needed)
        last = last.filter(pc.or_(needed, pc.is_in(last["_k"], value_set=rest["_k"].combine_chunks())))
        if rest.num_rows:
            self.waiting.put([(_packed(pa.Table.from_batches([b])),) for b in rest.to_batches(max_chunksize=ROWS_PER_PIECE)])
        else:
            self.waiting.clear()
        if last.num_rows:
            self.last.update((_packed(last.combine_chunks()),))
        else:
            self.last.clear()
        wakes = [pc.min(column).as_py() + plus for column, plus in ((rest["_us"], 0), (ends, self.gap_us)) if len(column)]
        if wakes:
            self._wake(min(wakes))
        if keep.any():
            yield pings.filter(pa.array(keep)).drop_columns(["_k"]).to_pandas(integer_object_nulls=True, use_threads=False)

    def close(self) -> None:
        pass


def stream_ping_downsample(pings: DataFrame, key: str, ts: str, gap_seconds: int, lateness: str = "1 hour", buckets: int = KEY_BUCKETS) -> DataFrame:
    """The same rule on a stream whose pings may come up to ``lateness`` late; later ones are left out.

    A ping is decided once the watermark has passed it, as none before it can come any more; until then it waits in the
    state of its key's bucket (``Thinner``), with the times of the last pings kept. Timers in event time decide, and free the state when nothing waits and the gap after the
    last kept ping has passed. The last pings of a stream are handed on when a later event moves the watermark. State
    of this kind needs the RocksDB store, which is set on the session. Calls from Spark to Python cost milliseconds each,
    so the keys are dealt to ``buckets`` that are handled as a whole; one bucket's pings are held at a time. A key must
    find its bucket again, so the number belongs to a checkpoint like the gap.
    """
    pings.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Times go through the state as numbers, which no time zone of a worker can touch.
    plain = pings.withWatermark(ts, lateness).withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp"))).where("_us is not null")
    names = {f.name: "_us" if f.name == ts else f"_as_{f.name}" for f in pings.schema if not _clock_free(f)}
    moments = {n: F.unix_micros(F.col(c).cast("timestamp")) for c, n in names.items() if n != "_us"}
    text = F.when(F.col(key).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(key).cast("string")))
    numbered = plain.withColumns({**moments, "_k": text}).withColumn("_bucket", F.pmod(F.xxhash64("_k"), F.lit(buckets)))
    other = [T.StructField(names.get(f.name, f.name), f.dataType if _clock_free(f) else T.LongType()) for f in pings.schema if names.get(f.name) != "_us"]
    out = T.StructType([T.StructField("_us", T.LongType()), *other])
    held = T.StructType([*out, T.StructField("_k", T.StringType())])
    kept = numbered.groupBy("_bucket").transformWithStateInPandas(Thinner(held, numbered.columns, gap_seconds * 1_000_000), out, "append", "EventTime")
    back = lambda f: F.timestamp_micros(names[f.name]).cast(f.dataType).alias(f.name) if f.name in names else F.col(f.name)
    return kept.select(*[back(f) for f in pings.schema])
