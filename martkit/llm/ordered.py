"""Neighbours in a global order, computed partition by partition.

Rows are range-partitioned and sorted; each task walks its rows and handles
every adjacent pair of its own. Only the first and last row of each partition
meet again afterwards, so no task ever sees more than its range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.common import stored

_BATCH = 2000


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``_BATCH`` rows."""
    held: list[tuple] = []

    def pack():
        columns = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == _BATCH:
            yield pack()
            held.clear()
    if held:
        yield pack()


def adjacent(
    df: DataFrame,
    order: Sequence[Column],
    prepare: Callable[[tuple], object],
    pair: Callable[[object, object], Iterable[tuple]],
    schema: str,
    around: bool = False,
    codec: str = "snappy",
) -> DataFrame:
    """Rows of ``schema`` that ``pair(prepare(row), prepare(next row))`` yields for all adjacent rows.

    ``order`` should tell different rows apart; rows equal in it come in any
    order. ``around`` also pairs the last row with the first. The walk is stored
    once, so both uses of a partition's borders see the same split; ``codec``
    compresses it.
    """
    out_type, walked = _walk_types(df, schema)
    n_out, n_in = len(out_type.fields), len(df.columns)
    arrow = to_arrow_schema(walked)
    arrow_out = to_arrow_schema(out_type)

    def walk(batches):
        part = TaskContext.get().partitionId()

        def rows():
            before = last = None
            for batch in batches:
                for row in zip(*[c.to_pylist() for c in batch.columns]):
                    now = prepare(row)
                    if last is None:
                        yield (*[None] * n_out, part, "first", *row)
                    else:
                        for out in pair(before, now):
                            yield (*out, None, None, *[None] * n_in)
                    before, last = now, row
            if last is not None:
                yield (*[None] * n_out, part, "last", *last)

        yield from _batches(rows(), arrow)

    def meet(batches):
        def rows():
            for batch in batches:
                for row in zip(*[c.to_pylist() for c in batch.columns]):
                    yield from pair(prepare(row[:n_in]), prepare(row[n_in:]))

        yield from _batches(rows(), arrow_out)

    return _both_ways(df, order, walk, meet, schema, around, codec)


def adjacent_runs(
    df: DataFrame, order: Sequence[Column], pairs: Callable[[pa.RecordBatch], Sequence[pa.Array]], schema: str, codec: str = "snappy"
) -> DataFrame:
    """Like ``adjacent``, for many rows at once.

    ``pairs`` gets runs of rows that follow each other and returns the columns of
    ``schema`` for all neighbours in a run; any two neighbours share exactly one.
    """
    out_type, walked = _walk_types(df, schema)
    n_out, n_in = len(out_type.fields), len(df.columns)
    arrow = to_arrow_schema(walked)
    arrow_out = to_arrow_schema(out_type)

    def walk(batches):
        part = TaskContext.get().partitionId()

        def edge(place: str, row: pa.RecordBatch) -> pa.RecordBatch:
            nothing = [pa.nulls(1, f.type) for f in arrow_out]
            return pa.RecordBatch.from_arrays([*nothing, pa.array([part], pa.int32()), pa.array([place]), *row.columns], schema=arrow)

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                yield edge("first", batch.slice(0, 1))
                run = batch
            else:
                run = _one_batch([last, batch])
            out = pairs(run)
            yield pa.RecordBatch.from_arrays([*out, *[pa.nulls(len(out[0]), f.type) for f in list(arrow)[n_out:]]], schema=arrow)
            last = batch.slice(batch.num_rows - 1)
        if last is not None:
            yield edge("last", last)

    def meet(batches):
        for batch in batches:
            before, after = batch.select(range(n_in)), batch.select(range(n_in, 2 * n_in)).rename_columns(batch.schema.names[:n_in])
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays(list(pairs(_one_batch([before.slice(i, 1), after.slice(i, 1)]))), schema=arrow_out)

    return _both_ways(df, order, walk, meet, schema, False, codec)


def _one_batch(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    columns = [pa.concat_arrays([b.column(i) for b in batches]) for i in range(batches[0].num_columns)]
    return pa.RecordBatch.from_arrays(columns, names=batches[0].schema.names)


def _walk_types(df: DataFrame, schema: str) -> tuple[T.StructType, T.StructType]:
    """Types of the rows made and of a walk, which holds these and a partition's borders."""
    out_type = T._parse_datatype_string(schema)
    edge_fields = [T.StructField(f"edge_{f.name}", f.dataType) for f in df.schema.fields]
    return out_type, T.StructType([*out_type.fields, T.StructField("part", T.IntegerType()), T.StructField("place", T.StringType()), *edge_fields])


def _both_ways(df: DataFrame, order: Sequence[Column], walk, meet, schema: str, around: bool, codec: str) -> DataFrame:
    """Rows of the walks within the partitions and of the borders that meet after them."""
    names = df.columns
    out_type, walked = _walk_types(df, schema)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    done = stored(placed.mapInArrow(walk, walked), "walk", codec)

    edges = done.where("place is not null").select("part", "place", *[F.col(f"edge_{c}").alias(c) for c in names])
    parts = edges.where("place = 'first'").select("part")
    following = F.lead("part").over(Window.orderBy("part"))  # one row per partition
    first_of_all = F.min("part").over(Window.partitionBy())
    parts = parts.select("part", F.coalesce(following, first_of_all if around else F.lit(None)).alias("then"))
    ends = edges.where("place = 'last'").join(parts.where("then is not null"), "part")
    starts = edges.where("place = 'first'").select(F.col("part").alias("then"), *[F.col(c).alias(f"next_{c}") for c in names])
    met = ends.join(starts, "then").select(*names, *[f"next_{c}" for c in names])

    return done.where("place is null").select(*[f.name for f in out_type.fields]).unionAll(met.mapInArrow(meet, out_type))
