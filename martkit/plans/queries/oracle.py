"""Oracle SQL fragments: the stand-in tables, written independently in SQL."""

from __future__ import annotations

_OL = "lineitem JOIN orders ON l_orderkey = o_orderkey"
_KEY = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_VENUE_TYPE = """CASE s_nationkey % 4 WHEN 0 THEN 'coffee_shop' WHEN 1 THEN 'restaurant'
    WHEN 2 THEN 'bar' ELSE 'pizzeria' END"""


def _person(prefix: str, key: str, name: str) -> str:
    return f"""{key} AS {prefix}_id, {name} AS {prefix}_name,
        'Street ' || ({key} % 97) AS {prefix}_address,
        CAST(DATE '1960-01-01' + CAST({key} % 10000 AS INTEGER) AS DATE) AS {prefix}_birthday,
        lower(replace({name}, '#', '.')) || '@example.org' AS {prefix}_email"""


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"""2 * 6371.0 * asin(sqrt(least(1.0,
        pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
        + cos(radians({lat1})) * cos(radians({lat2}))
        * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"""


HAVERSINE = _haversine

# zone offsets of the test period, January, in hours
ZONE_HOURS = "CASE {n} % 5 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 9 WHEN 3 THEN -5 ELSE 11 END"

CTE = {
    "car_sales_raw": f"""
        SELECT p_brand || ' ' || split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1) AS auto,
            p_brand AS brand, split_part(p_name, ' ', 2) AS model, split_part(p_name, ' ', 1) AS colour,
            CASE WHEN p_size % 10 = 0 THEN 'null' ELSE CAST(p_size AS VARCHAR) END AS gasoline_consumption,
            CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(o_orderdate AS DATE) AS date,
            c_name AS person_name, '+' || (c_nationkey + 1) || c_custkey AS phone,
            CAST(round(l_discount * 100) AS INTEGER) AS discount, n_name AS brand_origin
        FROM {_OL} JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
            JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "venue_names": f"""
        SELECT s_suppkey AS venue_id, s_name AS cafe_name, {_VENUE_TYPE} AS type FROM supplier""",
    "venue_menu": f"""
        SELECT l_suppkey AS venue_id, s_name AS cafe_name, {_VENUE_TYPE} AS type, p_name AS item,
            CAST(floor(max(CAST(p_retailprice AS DECIMAL(12,2)))) AS INTEGER) AS price
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        GROUP BY ALL""",
    "venue_bills": f"""
        SELECT l_suppkey AS venue_id, CAST(o_orderdate AS DATE) AS date, o_orderkey,
            sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS bill
        FROM {_OL} GROUP BY ALL""",
    "venue_sales": """
        SELECT venue_id, date, CAST(sum(bill) // count(*) AS DECIMAL(18,0)) / 100 AS avg_check,
            CAST(sum(bill) // count(*) AS BIGINT) AS cents
        FROM venue_bills GROUP BY ALL""",
    "craft_fact": f"""
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS craftsman_id,
            o_custkey AS customer_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS product_price,
            CAST(o_orderdate AS DATE) AS order_created_date,
            CAST(l_shipdate AS DATE) AS order_completion_date,
            CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'P' THEN 'in progress'
                 WHEN l_returnflag = 'A' THEN 'delivery' ELSE 'created' END AS order_status,
            o_orderdate AS load_dttm
        FROM {_OL}""",
    "craft_customers": f"SELECT {_person('customer', 'c_custkey', 'c_name')} FROM customer",
    "craft_craftsmen": f"SELECT {_person('craftsman', 's_suppkey', 's_name')} FROM supplier",
    "craft_products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
            p_brand || ' ' || p_name AS product_description, p_type AS product_type FROM part""",
    "order_log": f"""
        SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, CAST(l_shipdate AS DATE) AS day,
            l_partkey AS item_id, p_name AS item_name, o_custkey AS customer_id,
            split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
            n_nationkey AS city_id, n_name AS city_name, CAST(l_quantity AS INTEGER) AS quantity,
            CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END
                * CAST(l_extendedprice AS DECIMAL(12,2)) AS payment_amount,
            CASE WHEN l_returnflag = 'R' THEN 'refunded' ELSE 'shipped' END AS status
        FROM {_OL} JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
            JOIN nation ON c_nationkey = n_nationkey""",
    "deliveries": """
        SELECT l_orderkey AS order_id, min(l_suppkey) AS courier_id,
            CAST(l_orderkey % 5 + 1 AS INTEGER) AS rate,
            CAST(l_orderkey % 300 AS DECIMAL(14,2)) AS tip_sum
        FROM lineitem GROUP BY l_orderkey""",
    "group_events": f"SELECT *, {_KEY} AS group_id FROM events",
    "group_reg": "SELECT group_id, min(ts) AS registration_dt FROM group_events GROUP BY group_id",
    "cities": """
        SELECT n_nationkey AS city_id, n_name AS city,
            CAST(n_nationkey * 37 % 120 - 60 AS DOUBLE) AS lat,
            CAST(n_nationkey * 91 % 340 - 170 AS DOUBLE) AS lon
        FROM nation""",
    "geo_placed": """
        SELECT *, CASE WHEN event_type IN ('click', 'purchase') THEN 'message'
                WHEN event_type IN ('view', 'error') THEN 'reaction' ELSE 'subscription' END AS kind,
            (user_id + CASE WHEN user_id % 2 = 0 THEN 0 ELSE day(ts) // 10 END) % 25 AS home,
            CAST(event_id % 100 AS DOUBLE) / 1000 AS off
        FROM group_events""",
    "geo_events": """
        SELECT event_id, user_id, ts, kind, group_id AS channel_id,
            CAST(home * 37 % 120 - 60 AS DOUBLE) + off AS lat,
            CAST(home * 91 % 340 - 170 AS DOUBLE) + off AS lon
        FROM geo_placed""",
    "geo_located": f"""
        SELECT e.event_id, arg_min(struct_pack(city_id := c.city_id, city := c.city),
                ({_haversine('e.lat', 'e.lon', 'c.lat', 'c.lon')}, c.city_id)) AS place,
            min({_haversine('e.lat', 'e.lon', 'c.lat', 'c.lon')}) AS distance_km
        FROM geo_events e CROSS JOIN cities c GROUP BY e.event_id""",
    "geo_city": """
        SELECT e.*, l.place.city_id AS city_id, l.place.city AS city, l.distance_km
        FROM geo_events e JOIN geo_located l ON e.event_id = l.event_id""",
    "geo_users": """
        SELECT user_id, max(ts) AS ts, CAST(user_id % 25 AS INTEGER) AS zone_id,
            CAST(user_id % 25 * 37 % 120 - 60 AS DOUBLE)
                + CAST((user_id // 25) % 1000 AS DOUBLE) * CAST(0.004 AS DOUBLE) AS lat,
            CAST(user_id % 25 * 91 % 340 - 170 AS DOUBLE)
                + CAST((user_id // 25) // 1000 AS DOUBLE) * CAST(0.004 AS DOUBLE) AS lon
        FROM events GROUP BY user_id""",
    "geo_pairs": f"""
        SELECT a.user_id AS user_left, b.user_id AS user_right,
            {_haversine('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS distance_km
        FROM geo_users a JOIN geo_users b ON a.user_id < b.user_id
        WHERE abs(a.lat - b.lat) < 0.02
            AND {_haversine('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 1""",
    "channel_users": f"""
        SELECT DISTINCT user_id, {_KEY} AS channel_id FROM events WHERE event_type = 'signup'""",
    "near_sharing": """
        SELECT DISTINCT p.user_left, p.user_right FROM geo_pairs p
            JOIN channel_users a ON a.user_id = p.user_left
            JOIN channel_users b ON b.user_id = p.user_right AND a.channel_id = b.channel_id""",
    "campaigns": """
        SELECT json_extract_string(props, '$.k') AS restaurant_id,
            CAST(event_id AS VARCHAR) AS adv_campaign_id,
            'Campaign ' || event_id AS adv_campaign_content, 'Owner ' || user_id AS adv_campaign_owner,
            user_id || '@example.org' AS adv_campaign_owner_contact,
            CAST(floor(epoch(ts)) AS BIGINT) AS adv_campaign_datetime_start,
            CAST(floor(epoch(ts)) AS BIGINT) + (event_id % 10 + 1) * 86400 AS adv_campaign_datetime_end,
            CAST(floor(epoch(ts)) AS BIGINT) AS datetime_created
        FROM events WHERE event_type = 'purchase'""",
    "subscribers": """
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS client_id,
            json_extract_string(props, '$.k') AS restaurant_id
        FROM events WHERE event_type = 'view'""",
    "order_products": """
        SELECT DISTINCT l_orderkey, l_partkey FROM lineitem""",
    "baskets": """
        SELECT l_orderkey, min(l_suppkey) AS supplier FROM lineitem GROUP BY l_orderkey""",
    "transactions": """
        SELECT o_orderkey AS operation_id,
            CASE WHEN o_custkey % 50 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS account_number_from,
            c_nationkey AS currency_code,
            CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'queued' END AS status,
            CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderdate AS transaction_dt
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "cars": """
        SELECT 'VIN' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS vin, p_partkey,
            p_brand, split_part(p_name, ' ', 2) AS noun,
            CAST(p_retailprice AS DECIMAL(12,2)) AS price,
            CAST(DATE '2020-01-01' + CAST(p_size AS INTEGER) AS DATE) AS date_start,
            CASE p_size % 3 WHEN 0 THEN 'available' WHEN 1 THEN 'reserve' ELSE 'delivery' END AS status
        FROM part""",
    "car_sales": """
        SELECT l_partkey, CAST(l_shipdate AS DATE) AS sales_date,
            max(CAST(l_extendedprice AS DECIMAL(12,2))) AS cost,
            strftime(CAST(l_shipdate AS DATE), '%Y%m%d') || '#VIN'
                || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS sales_number
        FROM lineitem GROUP BY ALL""",
}

_NEEDS = {
    "venue_sales": ["venue_bills"],
    "group_reg": ["group_events"],
    "geo_placed": ["group_events"],
    "geo_events": ["geo_placed"],
    "geo_located": ["geo_events", "cities"],
    "geo_city": ["geo_located"],
    "geo_pairs": ["geo_users"],
    "near_sharing": ["geo_pairs", "channel_users"],
}


def with_(*names: str, **extra: str) -> str:
    """``WITH`` clause holding the named stand-ins, what they need, and ``extra`` steps."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    steps = [f"{n} AS ({CTE[n]})" for n in ordered] + [f"{n} AS ({s})" for n, s in extra.items()]
    return "WITH " + ",\n".join(steps) + "\n"
