"""Geographic operators and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.operators.pairs import co_occurring_pairs, exclude_known_pairs
from martkit.operators.points import nearest_point, pairs_within_km
from martkit.plans import standins as s
from martkit.plans.marts import geo
from martkit.plans.queries.oracle import ZONE_HOURS, with_
from martkit.plans.queries.registry import query


@query(
    "nearest_point",
    with_("geo_city")
    + "SELECT event_id, city_id, city, round(distance_km, 3) AS distance_km FROM geo_city",
)
def nearest(t):
    return nearest_point(
        s.geo_events(t), s.cities(t), "event_id", "city_id", keep=["city"]
    ).select("event_id", "city_id", "city", F.round("distance_km", 3).alias("distance_km"))


@query(
    "nearest_point_grid",
    with_("geo_city")
    + "SELECT event_id, city_id, city, round(distance_km, 3) AS distance_km FROM geo_city",
)
def nearest_grid(t):
    """The way taken beyond the packed size, forced here by a bound of zero."""
    return nearest_point(
        s.geo_events(t), s.cities(t), "event_id", "city_id", keep=["city"], max_packed=0
    ).select("event_id", "city_id", "city", F.round("distance_km", 3).alias("distance_km"))


@query(
    "pairs_within_km",
    with_("geo_pairs")
    + "SELECT user_left, user_right, round(distance_km, 3) AS distance_km FROM geo_pairs",
)
def near_pairs(t):
    return pairs_within_km(s.geo_users(t), "user_id", 1.0).select(
        F.col("id_left").alias("user_left"),
        F.col("id_right").alias("user_right"),
        F.round("distance_km", 3).alias("distance_km"),
    )


@query("co_occurring_pairs", with_("near_sharing") + "SELECT * FROM near_sharing")
def sharing_pairs(t):
    return co_occurring_pairs(
        s.channel_subscriptions(t), s.geo_users(t), "user_id", "channel_id", 1.0
    ).select(F.col("id_left").alias("user_left"), F.col("id_right").alias("user_right"))


_EDGES = """SELECT DISTINCT user_id AS message_from, user_id + 25 * (group_id % 40) AS message_to
    FROM group_events WHERE event_type IN ('click', 'purchase')"""
_STRANGERS = """NOT EXISTS (SELECT 1 FROM edges WHERE
    (message_from = user_left AND message_to = user_right)
    OR (message_from = user_right AND message_to = user_left))"""


@query(
    "exclude_known_pairs",
    with_("geo_pairs", "group_events", edges=_EDGES)
    + f"SELECT user_left, user_right FROM geo_pairs WHERE {_STRANGERS}",
)
def unknown_pairs(t):
    pairs = pairs_within_km(s.geo_users(t), "user_id", 1.0).select("id_left", "id_right")
    return exclude_known_pairs(
        pairs, s.geo_messages(t).select(F.col("user_id").alias("message_from"), "message_to"),
        "message_from", "message_to",
    ).select(F.col("id_left").alias("user_left"), F.col("id_right").alias("user_right"))


@query(
    "friend_recommendations",
    with_("near_sharing", "group_events", edges=_EDGES)
    + f"""SELECT user_left, user_right, '2024-02-01 00:00:00' AS processed_dttm, u.zone_id,
        strftime(u.ts + to_hours({ZONE_HOURS.format(n="u.zone_id")}), '%Y-%m-%d %H:%M:%S') AS local_time
    FROM near_sharing JOIN geo_users u ON u.user_id = user_left WHERE {_STRANGERS}""",
)
def friends(t):
    return geo.friend_recommendations(
        s.channel_subscriptions(t),
        s.geo_messages(t).select(F.col("user_id").alias("message_from"), "message_to"),
        s.geo_users(t),
        F.lit("2024-02-01 00:00:00").cast("timestamp"),
    )


@query(
    "travel_steps",
    with_(
        "geo_city",
        steps="""SELECT *, CASE WHEN lag(city) OVER w = city THEN 0 ELSE 1 END AS starts
            FROM geo_city WHERE kind = 'message'
            WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    )
    + """SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS step, city
    FROM steps WHERE starts = 1""",
)
def travel_steps_of_users(t):
    return geo.travel_steps(s.geo_messages(t).withColumn("ts", F.col("ts").cast("timestamp")), s.cities(t))


@query(
    "user_cities",
    with_(
        "geo_city",
        steps="""SELECT *, CASE WHEN lag(city) OVER w = city THEN 0 ELSE 1 END AS starts
            FROM geo_city WHERE kind = 'message'
            WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
        runs="""SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no
            FROM steps""",
        stays="""SELECT user_id, no, min(city) AS city, min(ts) AS started, max(ts) AS ended
            FROM runs GROUP BY user_id, no""",
        home="""SELECT user_id, city AS home_city FROM (SELECT *, row_number() OVER (
            PARTITION BY user_id ORDER BY date_diff('day', started::DATE, ended::DATE) DESC,
            started DESC) AS rn FROM stays
            WHERE date_diff('day', started::DATE, ended::DATE) >= 27) WHERE rn = 1""",
        travel="""SELECT user_id, string_agg(city, '|' ORDER BY no) AS travel_array,
            CAST(count(*) AS INTEGER) AS travel_count FROM stays GROUP BY user_id""",
        latest="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY ts DESC, event_id DESC) AS rn FROM geo_city WHERE kind = 'message') WHERE rn = 1""",
    )
    + f"""SELECT l.user_id, l.city AS act_city, coalesce(home_city, '-') AS home_city,
        travel_count, travel_array,
        strftime(l.ts + to_hours({ZONE_HOURS.format(n="l.city_id")}), '%Y-%m-%d %H:%M:%S') AS local_time,
        l.lat, l.lon
    FROM latest l LEFT JOIN home h ON h.user_id = l.user_id JOIN travel v ON v.user_id = l.user_id""",
)
def cities_of_users(t):
    return geo.user_cities(
        s.geo_messages(t).withColumn("ts", F.col("ts").cast("timestamp")), s.cities(t)
    ).withColumn("home_city", F.coalesce("home_city", F.lit("-")))


@query(
    "zone_metrics",
    with_(
        "geo_city",
        firsts="""SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY ts, event_id) AS rn FROM geo_city WHERE kind = 'message') WHERE rn = 1""",
        rows="""SELECT city_id AS zone_id, CAST(date_trunc('month', ts) AS DATE) AS month,
            CAST(date_trunc('week', ts) AS DATE) AS week, kind,
            event_id IN (SELECT event_id FROM firsts) AS is_new FROM geo_city""",
        weeks="""SELECT zone_id, month, week, count(*) FILTER (WHERE kind = 'message') AS m,
            count(*) FILTER (WHERE kind = 'reaction') AS r,
            count(*) FILTER (WHERE kind = 'subscription') AS s,
            count(*) FILTER (WHERE is_new) AS u FROM rows GROUP BY ALL""",
        months="""SELECT zone_id, month, count(*) FILTER (WHERE kind = 'message') AS m,
            count(*) FILTER (WHERE kind = 'reaction') AS r,
            count(*) FILTER (WHERE kind = 'subscription') AS s,
            count(*) FILTER (WHERE is_new) AS u FROM rows GROUP BY ALL""",
    )
    + """SELECT month, week, zone_id, w.m AS week_message, w.r AS week_reaction,
        w.s AS week_subscription, w.u AS week_user, mo.m AS month_message, mo.r AS month_reaction,
        mo.s AS month_subscription, mo.u AS month_user
    FROM weeks w FULL JOIN months mo USING (zone_id, month)""",
)
def zones(t):
    return geo.zone_metrics(s.geo_events(t), s.cities(t))
