"""Loaders: pure functions from the current table and a batch to the next table.

Key columns are unique in the current table; batches are reduced to one row
per key before they meet it, by a map-side combined aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.joins import HASH, deal, join_dealt, join_same
from martkit.operators.ordinals import assign_ids
from martkit.operators.select import keyset_page, latest_per_key
from martkit.session import settle, spread, spread_parts, unbroadcast


def _one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None) -> DataFrame:
    order = list(order_by) if order_by else [c for c in df.columns if c not in keys]
    return latest_per_key(df, keys, order) if order else df.distinct()


def conform_union(
    sources: Sequence[tuple[DataFrame, Mapping[str, Column | str]]], distinct: bool = True
) -> DataFrame:
    """Map differently shaped sources onto one schema and unite them.

    Each mapping gives target column -> source column; all must name the same
    targets and agree on their types. Equal rows of large stored sources meet in
    partitions whose number grows with them, before they are compared: a map of
    the wide rows of a whole input split would not fit a task.
    """
    names = list(sources[0][1])
    shaped = []
    for df, mapping in sources:
        if set(mapping) != set(names):
            raise ValueError(f"target columns differ: {sorted(set(mapping) ^ set(names))}")
        shaped.append(
            df.select(
                *[
                    (F.col(mapping[n]) if isinstance(mapping[n], str) else mapping[n]).alias(n)
                    for n in names
                ]
            )
        )
    expected = [f.dataType for f in shaped[0].schema.fields]
    for df in shaped[1:]:
        for name, want, got in zip(names, expected, [f.dataType for f in df.schema.fields]):
            if want != got:
                raise ValueError(
                    f"column {name}: {want.simpleString()} differs from {got.simpleString()}"
                )
    united = shaped[0]
    for df in shaped[1:]:
        united = united.unionByName(df)
    return spread(united, *names).distinct() if distinct else united


def missing_rows(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Incoming rows, one per key, whose key the current table lacks.

    The keys already known are found by a semi-join that can broadcast the
    batch, so a large table is scanned in place and only a batch that is large
    itself causes a shuffle of it.
    """
    known = join_same(current.select(*keys), incoming.select(*keys), keys, "left_semi")
    return join_same(_one_per_key(incoming, keys, order_by), known, keys, "left_anti").select(
        *current.columns
    )


def insert_missing(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Keep what is there; add rows whose key is new."""
    return current.unionByName(missing_rows(current, incoming, keys, order_by))


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Replace rows whose key arrives again and add the new ones."""
    latest = _one_per_key(incoming, keys, order_by)
    kept = join_same(current, latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest.select(*current.columns))


def replace_by_key(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop all current rows of every incoming key, then add the incoming rows."""
    arriving = incoming.select(*keys).distinct()
    return join_same(current, arriving, keys, "left_anti").unionByName(
        incoming.select(*current.columns)
    )


def replace_slice(current: DataFrame, incoming: DataFrame, slice_col: str) -> DataFrame:
    """Replace whole slices (business days): rerunning a day changes nothing."""
    return replace_by_key(current, incoming, [slice_col])


def merge_dim(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    load_ts: datetime | Column,
    sk: str | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """MERGE: update matched rows, insert new ones, stamp ``load_dttm`` on both.

    With ``sk`` new rows get surrogate keys above the current ones, in key order.
    Large stored sides meet in partitions whose number grows with them.
    """
    stamp = load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    stamp = stamp.cast(current.schema["load_dttm"].dataType)
    parts = spread_parts(current, incoming)
    arriving = incoming.select(*keys, *update_cols, *[
        c for c in (order_by or []) if c not in keys and c not in update_cols
    ])
    by = [HASH, *keys] if parts else list(keys)
    arriving = deal(arriving, keys, parts) if parts else arriving
    batch = _one_per_key(arriving, by, order_by).select(*by, *update_cols)
    marked = batch.select(*by, *[F.col(c).alias(f"_new_{c}") for c in update_cols]).withColumn(
        "_hit", F.lit(True)
    )
    touched = join_dealt(current, marked, keys, "left", parts)
    hit = F.col("_hit").isNotNull()
    kept = touched.select(
        *[
            F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in update_cols
            else F.when(hit, stamp).otherwise(F.col(c)).alias(c)
            if c == "load_dttm"
            else F.col(c)
            for c in current.columns
        ]
    )
    fresh = join_dealt(batch, current.select(*keys), keys, "left_anti", parts).withColumn(
        "load_dttm", stamp
    )
    if sk is not None:
        fresh = assign_ids(fresh, current, sk, keys)
    return kept.unionByName(fresh.select(*current.columns))


def update_from(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """UPDATE … FROM: matched rows take ``cols`` from ``updates``.

    Of several updates of one key the one with the greatest ``cols`` counts, so
    a target row never multiplies.
    """
    marked = (
        updates.groupBy(*keys)
        .agg(F.max(F.struct(*cols)).alias("_new"))
        .select(*keys, *[F.col("_new")[c].alias(f"_new_{c}") for c in cols], F.lit(True).alias("_hit"))
    )
    joined = join_same(target, marked, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in cols
            else F.col(c)
            for c in target.columns
        ]
    )


def load_next_batch(
    source: DataFrame, state: DataFrame, workflow: str, id_col: str, limit: int
) -> tuple[DataFrame, DataFrame]:
    """Next page above the workflow's high-water mark, and the advanced state.

    ``state`` is (workflow, last_id), one row per workflow. The page is stored
    first and its greatest id taken from the stored rows, so rows that reach a
    live source meanwhile are left to the next page. Publish both results
    together so that progress and data never part.
    """
    row = state.where(F.col("workflow") == workflow).agg(F.max("last_id")).first()
    last = row[0] if row[0] is not None else -1
    batch = settle(keyset_page(source, id_col, last, limit))
    reached = batch.agg(F.max(id_col).alias("last_id")).select(
        F.lit(workflow).alias("workflow"),
        F.coalesce(F.col("last_id"), F.lit(last)).cast("bigint").alias("last_id"),
    )
    others = state.where(F.col("workflow") != workflow).select("workflow", "last_id")
    return batch, others.unionByName(reached)


def changed_keys(
    fact: DataFrame,
    key: str,
    dims: Sequence[tuple[DataFrame, str]],
    since: Column,
    load_col: str = "load_dttm",
) -> DataFrame:
    """Keys with a fact row, or a row of any dimension it uses, loaded after ``since``.

    ``dims`` lists (dimension, join column present on both sides). Each
    dimension is cut to its changed rows before it meets the fact.
    """
    hits = [fact.where(F.col(load_col) > since).select(key).distinct()]
    for dim, on in dims:
        moved = dim.where(F.col(load_col) > since).select(on).distinct()
        if on == key:
            hits.append(fact.select(key).distinct().join(moved, on, "left_semi"))
        else:
            hits.append(fact.select(key, on).distinct().join(moved, on, "left_semi").select(key))
    united = hits[0]
    for more in hits[1:]:
        united = united.unionByName(more)
    return united.distinct()


def dim_increment(
    current: DataFrame, staging: DataFrame, key: str, cols: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Add dimension rows not seen before, one per key, the latest staged."""
    latest = latest_per_key(
        staging.where(F.col(key).isNotNull()).select(
            key, *cols, *[c for c in order_by if c not in (key, *cols)]
        ),
        [key],
        order_by,
    ).select(key, *cols)
    return insert_missing(current, latest, [key])


def resolve_keys(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str], str]], how: str = "left"
) -> DataFrame:
    """Attach surrogate keys: ``dims`` lists (dim, {fact column: dim column}, sk).

    A natural key that repeats in a dimension resolves to its least surrogate key.
    A large stored dimension meets the fact in partitions whose number grows with both;
    one whose rows are too many is not broadcast, however small its files.
    """
    out = fact
    for dim, natural, sk in dims:
        keys = list(natural)
        lookup = unbroadcast(dim.select(*[F.col(natural[k]).alias(k) for k in keys], sk))
        parts = spread_parts(fact, dim) if spread_parts(dim) else 0
        by = [HASH, *keys] if parts else keys
        lookup = deal(lookup, keys, parts) if parts else lookup
        lookup = lookup.groupBy(*by).agg(F.min(sk).alias(sk))
        out = join_dealt(out, lookup, keys, how, parts)
    return out


def apply_status(
    items: DataFrame, events: DataFrame, key: str, event_key: str, status: str = "sold"
) -> DataFrame:
    """Set the status of every item that has an event."""
    touched = events.select(F.col(event_key).alias(key)).distinct().withColumn(
        "status", F.lit(status)
    )
    return update_from(items, touched, [key], ["status"])


def revert_status(
    items: DataFrame,
    events: DataFrame,
    reverted: DataFrame,
    event_id: str,
    key: str,
    event_key: str,
    status: str = "available",
) -> tuple[DataFrame, DataFrame]:
    """Remove events and put their items back: (items, remaining events)."""
    ids = reverted.select(event_id).distinct()
    gone = events.join(ids, event_id, "left_semi")
    rest = events.join(ids, event_id, "left_anti")
    return apply_status(items, gone, key, event_key, status), rest


def rekey(
    tables: Sequence[tuple[DataFrame, str]], mapping: DataFrame, old: str = "old", new: str = "new"
) -> list[DataFrame]:
    """Rename a business key in every table.

    An ``old`` key that ``mapping`` names more than once gets its least ``new``
    key, so a row never multiplies; a null ``new`` key renames nothing.
    """
    out = []
    for df, col in tables:
        lookup = mapping.groupBy(F.col(old).alias("_old")).agg(F.min(new).alias("_new"))
        joined = df.join(lookup, F.col(col) == F.col("_old"), "left")
        out.append(
            joined.select(
                *[
                    F.coalesce(F.col("_new"), F.col(c)).alias(c) if c == col else F.col(c)
                    for c in df.columns
                ]
            )
        )
    return out
