"""Data Vault loading: hubs, links, satellites, and shredding of order documents.

Keys are md5 of the business key, so a replayed batch yields the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.hashing import md5_key
from martkit.operators.joins import join_same
from martkit.operators.select import best_per_group, latest_per_key
from martkit.operators.sequences import previous_value
from martkit.session import shuffles_dropped
from martkit.sources.files import write_partitioned


def _stamp(load_ts: datetime | Column) -> Column:
    """A naive time is one of the session zone, wherever the driver runs."""
    if isinstance(load_ts, Column) or load_ts.tzinfo is not None:
        return load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    return F.lit(load_ts.isoformat(sep=" ")).cast("timestamp")


def _append(
    current: DataFrame | None, rows: DataFrame, hk: str, only_new: bool
) -> DataFrame:
    """``rows``, which hold one row per hash key and no null key, where ``current`` lacks the key.

    As in ``missing_rows`` a small batch is broadcast to a large table; the rows
    need no second reduction and are shuffled once.
    """
    if current is None:
        return rows
    known = current.select(hk).join(rows.select(hk), hk, "left_semi")
    fresh = rows.join(known, hk, "left_anti").select(*current.columns)
    return fresh if only_new else current.unionByName(fresh)


def load_hub(
    current: DataFrame | None,
    stage: DataFrame,
    bk: str,
    hk: str,
    load_ts: datetime | Column,
    src: str,
    attrs: Sequence[str] = (),
    only_new: bool = False,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Business keys not yet in the hub get their hash key; known ones stay.

    Attributes are those of the first row by ``order_by`` (ties: the least).
    ``only_new`` returns the rows to append instead of the whole next hub.
    """
    order = [c for c in order_by if attrs and c not in (bk, *attrs)]
    keyed = stage.where(F.col(bk).isNotNull()).select(bk, *attrs, *order)
    first = [F.col(c) for c in dict.fromkeys([*order_by, *attrs])]
    keyed = best_per_group(keyed, [bk], first, largest=False) if attrs else keyed.distinct()
    rows = keyed.select(
        md5_key(bk).alias(hk),
        bk,
        *attrs,
        _stamp(load_ts).alias("load_dt"),
        F.lit(src).alias("load_src"),
    )
    return _append(current, rows, hk, only_new)


def load_link(
    current: DataFrame | None,
    stage: DataFrame,
    hub_keys: Mapping[str, str],
    hk: str,
    load_ts: datetime | Column,
    src: str,
    only_new: bool = False,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Distinct combinations of hub keys; rows lacking a business key make no link.

    ``hub_keys`` maps hub key column to the staged business key; ``extra`` names
    more columns, computed from the business keys.
    """
    extra = extra or {}
    bks = list(hub_keys.values())
    # distinct on the short business keys, hashes afterwards
    pairs = stage.dropna(subset=bks).select(*bks).distinct()
    keyed = pairs.select(
        *[md5_key(bk).alias(h) for h, bk in hub_keys.items()], *[c.alias(name) for name, c in extra.items()]
    )
    rows = keyed.select(
        md5_key(*hub_keys).alias(hk),
        *hub_keys,
        *extra,
        _stamp(load_ts).alias("load_dt"),
        F.lit(src).alias("load_src"),
    )
    return _append(current, rows, hk, only_new)


def hub_or_link_key(bks: Sequence[str]) -> Column:
    """Hash key of a hub (one business key) or of a link between hubs (several)."""
    return md5_key(bks[0]) if len(bks) == 1 else md5_key(*[md5_key(b) for b in bks])


def load_satellite(
    current: DataFrame | None,
    stage: DataFrame,
    hk: str,
    attrs: Sequence[str],
    load_ts: datetime | Column,
    src: str,
    mode: str = "current",
    order_by: Sequence[str] | None = None,
    bks: Sequence[str] | None = None,
) -> DataFrame:
    """Attributes of a hub or link key with their ``hashdiff``.

    The stage carries ``hk``, or the business keys ``bks`` it is made of; these
    are then hashed after the batch is reduced.

    ``current`` keeps one row per key, replaced whenever the key arrives: the
    last of the batch by ``order_by``, the greatest attributes among equals.
    ``history`` adds a row for each change: a staged row counts when its
    hashdiff differs from the row before it, stored or staged, in ``order_by``
    and then by hashdiff. Late rows are placed by their time like all others;
    stored rows always stay, and a row that is stored already adds nothing.
    """
    if not order_by:
        raise ValueError("a satellite needs order_by: what tells the later of two rows")
    if mode not in ("current", "history"):
        raise ValueError(f"unknown mode {mode!r}")
    if bks is not None:
        stage = stage.dropna(subset=list(bks))
        key = hub_or_link_key(bks)
    if mode == "current":
        order = list(dict.fromkeys([*order_by, *attrs]))
        keys = [hk] if bks is None else list(bks)
        batch = latest_per_key(
            stage.select(*keys, *attrs, *[c for c in order if c not in (*keys, *attrs)]), keys, order
        )
        if bks is not None:
            batch = batch.withColumn(hk, key)
        rows = batch.select(
            hk,
            *attrs,
            _stamp(load_ts).alias("load_dt"),
            F.lit(src).alias("load_src"),
            md5_key(hk, *attrs).alias("hashdiff"),
        )
        if current is None:
            return rows
        # one row per key: as replace_by_key, without reducing the keys again
        return join_same(current, rows.select(hk), [hk], "left_anti").unionByName(rows.select(*current.columns))
    if bks is not None:
        stage = stage.withColumn(hk, key)
    columns = [hk, *attrs, *[c for c in order_by if c not in (hk, *attrs)]]
    steps = stage.select(*columns, md5_key(hk, *attrs).alias("hashdiff"), F.lit(True).alias("_new"))
    if current is not None:
        # only the histories the batch touches take part
        touched = join_same(current, stage.select(hk).distinct(), [hk], "left_semi")
        steps = touched.select(*columns, "hashdiff", F.lit(False).alias("_new")).unionByName(steps)
    steps = previous_value(steps, [hk], [*order_by, "hashdiff", "_new"], "hashdiff", "_previous")
    changed = F.col("_previous").isNull() | (F.col("_previous") != F.col("hashdiff"))
    rows = steps.where(F.col("_new") & changed).select(
        *columns, _stamp(load_ts).alias("load_dt"), F.lit(src).alias("load_src"), "hashdiff"
    )
    return rows if current is None else current.unionByName(rows)


def log_events(
    stage: DataFrame,
    path: str,
    token: str,
    hk: str,
    attrs: Sequence[str],
    order_by: Sequence[str],
    load_ts: datetime | Column,
    src: str,
    bks: Sequence[str] | None = None,
) -> None:
    """Add every event of a batch to the log of a satellite; a batch that runs again replaces itself.

    The log is partitioned by ``load_token``. Nothing stored is read, and nothing
    is left out, so late rows lose no change. Rows without a business key are no
    event.
    """
    if not order_by:
        raise ValueError("a satellite needs order_by: what tells the later of two rows")
    if bks is not None:
        stage = stage.dropna(subset=list(bks)).withColumn(hk, hub_or_link_key(bks))
    columns = [hk, *attrs, *[c for c in order_by if c not in (hk, *attrs)]]
    events = stage.where(F.col(hk).isNotNull()).select(
        *columns,
        _stamp(load_ts).alias("load_dt"),
        F.lit(src).alias("load_src"),
        md5_key(hk, *attrs).alias("hashdiff"),
        F.lit(token).alias("load_token"),
    )
    write_partitioned(events, path, ["load_token"])


def changes_of_log(log: DataFrame, hk: str, order_by: Sequence[str]) -> DataFrame:
    """The history of a satellite: events of ``log`` whose hashdiff differs from that of the event before.

    Derived from the whole log by ``order_by``, then hashdiff, so any split of the
    events into batches, in any order, gives the same rows. An event that came in
    several batches counts once, as the batch that loaded it first (ties: the
    least token).
    """
    order = [*[c for c in order_by if c != hk], "hashdiff"]
    known = [c for c in log.columns if c not in (hk, *order, "load_dt", "load_token")]
    once = log.groupBy(hk, *order).agg(F.min(F.struct("load_dt", "load_token", *known)).alias("_first"))
    once = once.select(hk, *order, *[F.col(f"_first.{c}").alias(c) for c in ("load_dt", "load_token", *known)])
    steps = previous_value(once, [hk], order, "hashdiff", "_previous")
    changed = F.col("_previous").isNull() | (F.col("_previous") != F.col("hashdiff"))
    return steps.where(changed).select(*log.columns)


def latest_of_log(log: DataFrame, hk: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last event of the log."""
    return latest_per_key(log, [hk], [*order_by, "hashdiff", "load_token"])


# Shape of an order message and the name of its source system.
ORDER_MESSAGE = """
    id bigint, date string, cost decimal(19,5), payment decimal(19,5), status string,
    restaurant struct<id: string, name: string>,
    user struct<id: string, name: string>,
    products array<struct<id: string, name: string, category: string,
                          price: decimal(19,5), quantity: int>>
"""
ORDER_SOURCE = "orders-system-kafka"


_BAD = "_malformed"
#: Columns of a message that tell when it arrived, as far as the source has them.
ARRIVAL = ("timestamp", "partition", "offset")


def decode_orders(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """(o, arrived, rejected) per message.

    ``o`` is the order: the ``payload`` object of an enveloped message, else the
    message itself. ``arrived`` orders messages: time, partition and offset of
    the source where ``messages`` has them, then the time of the order.
    ``rejected`` holds the text of a message that is no order, has no id or a
    value that does not fit its type (empty text for null); it is null for a
    good one.
    """
    read_as = f"{ORDER_MESSAGE}, payload struct<{ORDER_MESSAGE}>, {_BAD} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = F.from_json(payload, read_as, options)
    read = messages.select(
        # never null: a text without an object is an order without an id
        F.coalesce(parsed, F.from_json(F.lit("{}"), read_as, options)).alias("_m"),
        F.col(payload).alias("_text"),
        *[F.col(c).alias(f"_{c}") for c in ARRIVAL if c in messages.columns],
    )
    fields = T._parse_datatype_string(ORDER_MESSAGE).fieldNames()
    plain = F.struct(*[F.col(f"_m.{f}").alias(f) for f in fields])
    orders = read.withColumn("o", F.coalesce("_m.payload", plain))
    placed = F.try_to_timestamp("o.date")
    bad_date = F.col("o.date").isNotNull() & placed.isNull()
    bad = F.col(f"_m.{_BAD}").isNotNull() | F.col("o.id").isNull() | bad_date
    arrival = [F.col(f"_{c}").alias(c) for c in ARRIVAL if c in messages.columns]
    return orders.select(
        "o",
        F.struct(*arrival, placed.alias("order_dt")).alias("arrived"),
        F.when(bad, F.coalesce("_text", F.lit(""))).alias("rejected"),
    )


def parse_orders(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """The good messages as (o, arrived); see ``decode_orders``."""
    return decode_orders(messages, payload).where("rejected is null").select("o", "arrived")


def rejected_orders(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Texts of the messages that ``parse_orders`` leaves out, in ``value``."""
    return decode_orders(messages, payload).where("rejected is not null").select(
        F.col("rejected").alias("value")
    )


def shred_orders(parsed: DataFrame) -> dict[str, DataFrame]:
    """Parsed orders as an ``orders`` and an ``items`` stage."""
    orders = parsed.select(
        F.col("o.id").alias("order_id"),
        F.col("arrived.order_dt").alias("order_dt"),
        F.col("o.cost").alias("cost"),
        F.col("o.payment").alias("payment"),
        F.col("o.status").alias("status"),
        F.col("o.restaurant.id").alias("restaurant_id"),
        F.col("o.restaurant.name").alias("restaurant_name"),
        F.col("o.user.id").alias("user_id"),
        F.col("o.user.name").alias("username"),
        F.col("o.user.id").alias("userlogin"),
        "arrived",
        F.lit(0).alias("position"),
    )
    items = parsed.select(
        F.col("o.id").alias("order_id"),
        F.col("o.restaurant.id").alias("restaurant_id"),
        "arrived",
        F.posexplode("o.products").alias("position", "p"),
    ).select(
        "order_id",
        "restaurant_id",
        F.col("p.id").alias("product_id"),
        F.col("p.name").alias("product_name"),
        F.col("p.category").alias("category_name"),
        F.col("p.price").alias("price"),
        F.col("p.quantity").alias("quantity"),
        "arrived",
        "position",
    )
    return {"orders": orders, "items": items}


def store_stage(messages: DataFrame, path: str, payload: str = "payload") -> dict[str, DataFrame]:
    """Parse the documents once into a columnar table at ``path`` and shred that.

    Fifteen tables read the stage; each then scans only its own nested fields.
    ``rejects`` holds the texts that are no order, in ``value``. Shuffle files
    behind ``messages`` go with the write.
    """
    decoded = decode_orders(messages, payload)
    with shuffles_dropped(decoded.sparkSession):
        decoded.write.mode("overwrite").option("compression", "zstd").parquet(path)
    kept = decoded.sparkSession.read.schema(decoded.schema).parquet(path)
    good = kept.where("rejected is null").select("o", "arrived")
    bad = kept.where("rejected is not null").select(F.col("rejected").alias("value"))
    return {**shred_orders(good), "rejects": bad}


# hub -> (stage, business key, attributes)
HUBS = {
    "h_order": ("orders", "order_id", ["order_dt"]),
    "h_user": ("orders", "user_id", []),
    "h_restaurant": ("orders", "restaurant_id", []),
    "h_product": ("items", "product_id", []),
    "h_category": ("items", "category_name", []),
}
# link -> (stage, key column, {hub key: business key})
LINKS = {
    "l_order_user": (
        "orders",
        "hk_order_user_pk",
        {"h_order_pk": "order_id", "h_user_pk": "user_id"},
    ),
    "l_order_product": (
        "items",
        "hk_order_product_pk",
        {"h_order_pk": "order_id", "h_product_pk": "product_id"},
    ),
    "l_product_restaurant": (
        "items",
        "hk_product_restaurant_pk",
        {"h_product_pk": "product_id", "h_restaurant_pk": "restaurant_id"},
    ),
    "l_product_category": (
        "items",
        "hk_product_category_pk",
        {"h_product_pk": "product_id", "h_category_pk": "category_name"},
    ),
}
# satellite -> (stage, key column, business keys of its hub or link, attributes)
SATELLITES = {
    "s_user_names": ("orders", "h_user_pk", ["user_id"], ["username", "userlogin"]),
    "s_product_names": ("items", "h_product_pk", ["product_id"], ["product_name"]),
    "s_restaurant_names": (
        "orders",
        "h_restaurant_pk",
        ["restaurant_id"],
        ["restaurant_name"],
    ),
    "s_order_cost": ("orders", "h_order_pk", ["order_id"], ["cost", "payment"]),
    "s_order_status": ("orders", "h_order_pk", ["order_id"], ["status"]),
    "s_order_product_details": (
        "items",
        "hk_order_product_pk",
        ["order_id", "product_id"],
        ["price", "quantity"],
    ),
}


def load_order_vault(
    current: Mapping[str, DataFrame] | None,
    stage: Mapping[str, DataFrame],
    load_ts: datetime | Column,
    src: str = ORDER_SOURCE,
    only_new: bool = False,
) -> dict[str, DataFrame]:
    """Load shredded orders into five hubs, four links and six satellites.

    Set-based: every table is one aggregate over the batch plus a keyed join
    with the current table; replaying a batch changes nothing but ``load_dt``
    of the satellite rows it brings again. ``only_new`` yields the rows to
    append: new hub and link keys, and the batch's satellite rows. The message
    that arrived last decides every satellite, the first one a hub's attributes.
    """
    order = ["arrived", "position"]
    have = (current or {}).get
    out = {}
    for name, (source, bk, attrs) in HUBS.items():
        out[name] = load_hub(
            have(name), stage[source], bk, f"{name}_pk", load_ts, src, attrs, only_new, order
        )
    for name, (source, hk, keys) in LINKS.items():
        out[name] = load_link(have(name), stage[source], keys, hk, load_ts, src, only_new)
    for name, (source, hk, bks, attrs) in SATELLITES.items():
        out[name] = load_satellite(
            None if only_new else have(name), stage[source], hk, attrs, load_ts, src,
            order_by=order, bks=bks,
        )
    return out
