from __future__ import annotations

import json
from datetime import datetime

import pytest

from martkit.operators.vault import (
    HUBS,
    LINKS,
    SATELLITES,
    load_hub,
    load_link,
    load_order_vault,
    load_satellite,
    parse_orders,
    rejected_orders,
    shred_orders,
)
from martkit.plans.marts.counters import user_category_counters, user_product_counters
from tests.conftest import tuples

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def order(no, user, products, restaurant="r1", user_name=None):
    return json.dumps(
        {
            "id": no, "date": "2024-01-01 10:00:00", "cost": 10.5, "payment": 10, "status": "CLOSED",
            "restaurant": {"id": restaurant, "name": "R"},
            "user": {"id": user, "name": user_name or f"name of {user}"},
            "products": [
                {"id": p, "name": f"dish {p}", "category": c, "price": 5, "quantity": 1}
                for p, c in products
            ],
        }
    )


@pytest.fixture
def docs(spark):
    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "payload string")

    return make


def load(current, messages, at=T1):
    return load_order_vault(current, shred_orders(parse_orders(messages)), at)


def test_hub_and_link_ignore_missing_business_keys_and_replays(spark):
    rows = spark.createDataFrame([(1, "g"), (1, "g"), (2, None), (None, "g")], "u int, g string")
    hub = load_hub(None, rows, "u", "hk", T1, "src")
    assert tuples(hub, "u", "load_dt") == [(1, T1), (2, T1)]
    assert tuples(load_hub(hub, rows, "u", "hk", T2, "src")) == tuples(hub)
    link = load_link(None, rows, {"hu": "u", "hg": "g"}, "hk", T1, "src")
    assert link.count() == 1
    assert tuples(load_link(link, rows, {"hu": "u", "hg": "g"}, "hk", T2, "src")) == tuples(link)


def test_satellite_modes(spark):
    schema = "hk string, v string, at int"
    one = spark.createDataFrame([("k", "a", 1), ("k", "a", 2), ("k", "b", 3), ("m", "x", 1)], schema)
    two = spark.createDataFrame([("k", "b", 4), ("k", "c", 5), ("k", "c", 6), ("k", "a", 7)], schema)
    now = load_satellite(None, one, "hk", ["v"], T1, "s", order_by=["at"])
    now = load_satellite(now, two, "hk", ["v"], T2, "s", order_by=["at"])
    assert tuples(now, "hk", "v") == [("k", "a"), ("m", "x")]
    stage = lambda df: df.withColumn("at", df.at.cast("timestamp"))
    history = load_satellite(None, stage(one), "hk", ["v"], T1, "s", "history", ["at"])
    assert history.where("hk = 'k'").count() == 2
    later = load_satellite(history, stage(two), "hk", ["v"], T2, "s", "history", ["at"])
    steps = later.where("hk = 'k'").orderBy("at")
    assert [r.v for r in steps.collect()] == ["a", "b", "c", "a"]
    again = load_satellite(later, stage(two), "hk", ["v"], T2, "s", "history", ["at"])
    assert tuples(again) == tuples(later)
    with pytest.raises(ValueError):
        load_satellite(None, one, "hk", ["v"], T1, "s", "history")


def test_order_vault(docs):
    messages = docs(
        order(1, "u1", [("p1", "soup"), ("p2", "main")]),
        order(2, "u1", [("p1", "soup")]),
        order(3, "u2", [("p1", "starter")]),
        "not json",
    )
    vault = load(None, messages)
    assert set(vault) == {*HUBS, *LINKS, *SATELLITES}
    sizes = {n: df.count() for n, df in vault.items()}
    assert sizes["h_order"] == 3 and sizes["h_product"] == 2 and sizes["h_category"] == 3
    assert sizes["l_order_product"] == 4 and sizes["l_product_category"] == 3
    assert sizes["s_order_product_details"] == 4 and sizes["s_user_names"] == 2
    links = vault["l_order_product"].select("hk_order_product_pk")
    assert tuples(links) == tuples(vault["s_order_product_details"], "hk_order_product_pk")
    replayed = load(vault, messages)
    for name, df in vault.items():
        assert tuples(replayed[name]) == tuples(df), name


def test_order_of_batches_is_irrelevant_and_counters(docs):
    a = docs(order(1, "u1", [("p1", "soup"), ("p2", "main")]))
    b = docs(order(2, "u1", [("p1", "soup")]), order(3, "u2", [("p1", "starter")]))
    ab, ba = load(load(None, a), b), load(load(None, b), a)
    for name in {*HUBS, *LINKS}:
        assert tuples(ab[name]) == tuples(ba[name]), name
    products = user_product_counters(ab)
    assert sorted(r.order_cnt for r in products.collect()) == [1, 1, 2]
    # p1 lies in two categories and counts in both
    categories = user_category_counters(ab)
    got = sorted((r.category_name, r.order_cnt) for r in categories.collect())
    assert got == [("main", 1), ("soup", 1), ("soup", 2), ("starter", 1), ("starter", 2)]


def test_last_message_decides_and_rejects_are_kept(spark, docs):
    schema = "payload string, timestamp timestamp, partition int, offset long"
    envelope = lambda text: '{"object_id": 1, "object_type": "order", "payload": ' + text + "}"
    a = order(1, "u1", [("p1", "soup")], user_name="zoe").replace("CLOSED", "OPEN")
    b = order(1, "u1", [("p1", "soup")], user_name="ann")
    bad = order(9, "u9", [("p9", "soup")]).replace("10.5", '"abc"')
    rows = [
        (envelope(b), T1, 0, 8), (envelope(a), T1, 0, 7), (envelope(bad), T2, 0, 9),
        (None, T2, 0, 10), ("", T2, 0, 11), ("{}", T2, 0, 12), (order(2, "u2", []), T2, 0, 13),
    ]
    messages = spark.createDataFrame(rows, schema)
    vault = load(None, messages)
    assert tuples(vault["s_order_status"], "status") == [("CLOSED",), ("CLOSED",)]
    assert {r.username for r in vault["s_user_names"].collect()} == {"ann", "name of u2"}
    assert vault["h_order"].count() == 2
    assert tuples(rejected_orders(messages)) == sorted([("",), ("",), ("{}",), (envelope(bad),)], key=str)
    # without columns of arrival the time of the order decides
    early, late = order(1, "u1", []), order(1, "u1", []).replace("10:00:00", "15:00:00")
    vault = load(None, docs(late.replace("CLOSED", "A"), early.replace("CLOSED", "B")))
    assert tuples(vault["s_order_status"], "status") == [("A",)]


def test_history_places_late_and_tied_rows(spark):
    schema = "hk string, v string, at timestamp, no int"
    day = lambda d: datetime(2024, 1, d)
    first = spark.createDataFrame([("k", "a", day(1), 1), ("k", "b", day(5), 1)], schema)
    more = spark.createDataFrame([("k", "c", day(5), 2), ("k", "d", day(3), 1), ("k", "a", day(2), 1)], schema)
    step = lambda now, rows: load_satellite(now, rows, "hk", ["v"], T1, "s", "history", ["at", "no"])
    once = step(step(None, first), more)
    assert [r.v for r in once.orderBy("at", "no").collect()] == ["a", "d", "b", "c"]
    assert tuples(step(once, more)) == tuples(once)
    assert tuples(step(once, first)) == tuples(once)
