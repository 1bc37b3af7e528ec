"""Exact ordered folds (state machines) that split hot keys.

A sequential operator (anchor moves only when a trigger fires, an alarm
suppresses the next readings, a material passes gates) cannot be written
with window functions. The obvious plan, one pandas group per key, puts a
key with a third of all rows into one task. Here every key is cut into
ordered segments of bounded row count and processed per segment:

1. every segment is folded from the initial state and reports its exit state;
2. a segment's entry state is the exit state of the key's previous segment
   (a one-row-per-segment table); segments are re-folded from those entries
   until no entry changes (a fixpoint, reached after at most one round per
   segment of the longest key and in practice after one or two, since the
   states of real machines re-synchronise quickly);
3. the final pass folds every segment from its settled entry and emits rows.

Only the small per-segment state table ever moves between rounds; it is
checkpointed to the shared checkpoint folder so lineage stays short. The
per-row step is a small Python function run inside Arrow batches. Spark sorts
the segments; a task takes their rows batch by batch and holds one batch and
one state, however many rows a segment has.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from fabline.operators.ordered import null_safe_join, prefix_sum, row_bucket
from fabline.session import ensure_checkpoint_dir


@dataclass
class FoldSpec:
    """``step(state, row) -> (state, [out_tuple, ...])``; ``row`` is a
    namedtuple of ``in_cols``; states must be JSON-serialisable."""
    init: Callable[[], object]
    step: Callable[[object, tuple], tuple[object, list]]
    in_cols: Sequence[str]
    out_schema: str


def _same(a: tuple, b: tuple | None) -> bool:
    return b is not None and all(x == y or (x != x and y != y) for x, y in zip(a, b))


def _segments(batch: pa.RecordBatch, seg: Sequence[str]):
    """(key, first row, last row + 1) of the runs of equal ``seg`` columns in a batch; null equals null."""
    n = batch.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for c in seg:
        codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    edges = np.append(np.flatnonzero(new), n)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield tuple(batch.column(c)[lo].as_py() for c in seg), lo, hi


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_integer(kind):  # pandas turns a column of integers with a null into one of floats
        values = [None if v is None or v != v else int(v) for v in values]
    return pa.array(values, kind, from_pandas=True)


def run_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], spec: FoldSpec,
             max_rounds: int | None = None, segment_rows: int = 2_000_000) -> DataFrame:
    """Run ``spec`` per key in ``order``; returns ``keys + out_schema`` rows.

    ``order[0]`` is the time in microseconds. Keys with more than
    ``segment_rows`` rows are cut into segments of that many consecutive
    rows; every other key is one segment, which needs no settling. The
    result is the same for any ``segment_rows``. A null key is a key like
    any other; rows with a null time come first, in the order of the rest.
    """
    keys = list(keys)
    bucket = "__seg"
    seg = [*keys, bucket]
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # The size check, the numbering and every round read the input: write it
    # once to the shared folder (freed with the frame, safe from lost executors).
    df = df.select(*dict.fromkeys([*keys, *order, *spec.in_cols])).checkpoint()
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__key_rows"))
    split = not sizes.where(F.col("__key_rows") > segment_rows).isEmpty()
    if split:
        # Segments of a big key are runs of at most ``segment_rows`` rows in
        # order (row number per key from the bucketed running count), so no
        # segment outgrows a task, however the rows fall in time.
        big = null_safe_join(df, sizes, keys).withColumn("__ts", F.timestamp_micros(order[0]))
        numbered = prefix_sum(row_bucket(big, keys, "__ts", bucket), keys, order, bucket, {"__rn": F.lit(1)})
        df = numbered.withColumn(
            bucket, F.when(F.col("__key_rows") > segment_rows,
                           F.floor((F.col("__rn") - 1) / segment_rows)).otherwise(F.lit(None)).cast("bigint"))
    else:
        df = df.withColumn(bucket, F.lit(None).cast("bigint"))
    cols = list(dict.fromkeys([*seg, *order, *spec.in_cols]))
    base = df.select(*cols)
    if split:
        base = base.checkpoint()
    key_schema = base.select(*seg).schema

    exit_schema = T.StructType(list(key_schema.fields) + [T.StructField("exit_state", T.StringType())])
    out_struct = T._parse_datatype_string(spec.out_schema)
    full_schema = T.StructType(list(key_schema.fields)[:len(keys)] + list(out_struct.fields))

    def folded(rows: DataFrame, schema: T.StructType, emit: bool) -> DataFrame:
        """The segments' rows (``emit``) or exit states, each from the entry state that its rows carry."""
        kinds = [to_arrow_type(f.dataType) for f in schema.fields]
        names, wanted = schema.names, list(dict.fromkeys(spec.in_cols))

        def table(found: list) -> pa.RecordBatch:
            cols = zip(*found) if found else [()] * len(names)
            return pa.RecordBatch.from_arrays([_column(list(c), k) for c, k in zip(cols, kinds)], names=names)

        def run(batches):
            current = state = None
            for batch in batches:
                found: list = []
                pdf = pa.Table.from_batches([batch.select(wanted)]).to_pandas()[list(spec.in_cols)]
                for key, lo, hi in _segments(batch, seg):
                    if not _same(key, current):
                        if current is not None and not emit:
                            found.append((*current, json.dumps(state)))
                        entry = batch.column("entry_state")[lo].as_py()
                        current, state = key, spec.init() if entry is None else json.loads(entry)
                    for row in pdf.iloc[lo:hi].itertuples(index=False, name="Row"):
                        state, emitted = spec.step(state, row)
                        if emit and emitted:
                            found.extend((*key[:len(keys)], *o) for o in emitted)
                if found:
                    yield table(found)
            if current is not None and not emit:
                yield table([(*current, json.dumps(state))])

        return rows.repartition(*seg).sortWithinPartitions(*seg, *order).mapInArrow(run, schema)

    def entries_from(exits: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(bucket)
        return exits.select(*seg, F.lag("exit_state").over(w).alias("entry_state"))

    def with_entries(entries: DataFrame | None) -> DataFrame:
        if entries is None:
            return base.withColumn("entry_state", F.lit(None).cast("string"))
        return null_safe_join(base, entries, seg, "left")

    if not split:
        # One segment per key: nothing to settle, fold once and emit.
        return folded(with_entries(None), full_schema, emit=True)

    # Round 1 folds every segment from the initial state. Later rounds
    # re-fold only the segments whose entry state changed and keep the other
    # exits, so a round costs the frontier of unsettled segments only.
    exits = folded(with_entries(None), exit_schema, emit=False).checkpoint()
    entries = entries_from(exits).checkpoint()
    rounds = 1
    while True:
        settled_init = F.col("entry_state").isNull()
        if rounds == 1:
            changed = entries.where(~settled_init).select(*seg)
        else:
            changed = (null_safe_join(entries, prev.withColumnRenamed("entry_state", "__old"), seg)
                       .where(~F.col("entry_state").eqNullSafe(F.col("__old"))).select(*seg))
        changed = changed.checkpoint()
        if changed.limit(1).count() == 0:
            break
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError("fold did not settle within max_rounds")
        redo = null_safe_join(null_safe_join(base, changed, seg, "left_semi"), entries, seg, "left")
        fresh = folded(redo, exit_schema, emit=False)
        exits = null_safe_join(exits, changed, seg, "left_anti").unionByName(fresh).checkpoint()
        prev = entries
        entries = entries_from(exits).checkpoint()
        rounds += 1

    return folded(with_entries(entries), full_schema, emit=True)
