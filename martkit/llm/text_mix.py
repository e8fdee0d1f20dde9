"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources share ``percent`` % of all words by weight, none above ``max_repeats``
times its own size. The shares are paid in blocks of about ``block_words`` words:
first sources, then the shards of each source, receive blocks one by one at the
highest quotient share / (2 k + 1). A shard lays its documents end to end in
seeded order, cuts them into equal blocks and takes its quota from the front,
going round again where the quota exceeds one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import stored


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, max_repeats: int = 2
) -> DataFrame:
    """(source, weight, source_size, target) from (source, size) rows.

    Sources in code point order, null last, take the weights in turn. Whatever a
    source would get above its cap is shared again by weight: the level at which
    the shares fit is found in one pass over the sources, sorted by the level at
    which each reaches its cap. The only data in one task is one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    ranked = per_source.withColumn("weight", turn.cast("bigint")).withColumn(
        "cap", F.col("source_size") * max_repeats
    )
    # A source is capped when its level cap / weight is not above the level at
    # which the sources after it could share what the ones up to it leave.
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    upto = by_level.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("source_size").over(everything)
    level = (
        ranked.withColumn("total", (total * percent).cast("double") / 100)
        .withColumn("caps", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("open", F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight"))
        .withColumn("full", F.col("cap") * F.col("open") <= F.col("weight") * (F.col("total") - F.col("caps")))
    )
    shared = level.withColumn("left_total", F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0)))
    shared = shared.withColumn("left_weight", F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.col("left_total") / F.col("left_weight")
    )
    return shared.select("source", "weight", "source_size", target.alias("target"))


def apportion(parties: DataFrame, group: Sequence[str], share: str, seats: str, tie: Sequence[str]) -> DataFrame:
    """Adds ``quota``: per group, ``seats`` go one by one to the highest share / (2 k + 1).

    Every party surely holds all but a few seats of its proportional part, and
    no more than a few above it: with ``p`` parties the ideal divisor moves by at
    most the factor p / 2 seats. Only quotients in that band are ranked, so the
    work grows with the parties and not with the seats. Ties go by ``tie``.
    """
    whole = Window.partitionBy(*group)
    part = F.try_divide(F.col(share), F.sum(share).over(whole))
    band = F.ceil(part * F.count("*").over(whole) / 2) + 2
    known = (
        parties.withColumn("_share", F.col(share).cast("double"))
        .withColumn("_part", F.coalesce(part, F.lit(0.0)))
        .withColumn("_band", F.coalesce(band, F.lit(2)).cast("bigint"))
        .withColumn("_sure", F.greatest(F.lit(0).cast("bigint"), F.floor(F.col("_part") * F.col(seats)) - F.col("_band")))
        .withColumn("_rest", F.col(seats) - F.sum("_sure").over(whole))
    )
    seat = known.withColumn("_k", F.explode(F.sequence(F.col("_sure"), F.col("_sure") + F.col("_band") * 2)))
    order = Window.partitionBy(*group).orderBy(
        F.desc(F.col("_share") / (F.col("_k") * 2 + 1)), *[F.col(t).asc_nulls_last() for t in tie], "_k"
    )
    won = (F.row_number().over(order) <= F.col("_rest")) & (F.col("_share") > 0)
    return (
        seat.withColumn("_won", won.cast("bigint"))
        .groupBy(*parties.columns)
        .agg((F.first("_sure") + F.sum("_won")).alias("quota"))
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    percent: int = 150,
    max_repeats: int = 2,
    block_words: int = 16,
    shard_words: int = 1_000_000,
    seed: str = "mix",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, *keep) per row of ``docs`` (doc_id, text, source).

    ``taken`` counts the words the mix takes from the document, repeats
    included, at most ``max_repeats`` times its size. Null texts have size 0. A
    null source is a source of its own. Repeated rows are rows like others;
    within a shard rows go by hash, id and size, null ids first. A table without
    words takes nothing, an empty one gives no rows. Columns named in ``keep``
    (small ones; they are shuffled) pass through, others are ignored.
    """
    words = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")
    rows = stored(
        docs.select(
            F.col("doc_id").cast("bigint"), F.col("source").cast("string"), words.alias("size"), *[F.col(c).alias(f"_{c}") for c in keep]
        ),
        "sizes",
    )
    targets = source_targets(rows, weights, percent, max_repeats)
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("bigint")
    quotas = apportion(targets.withColumn("blocks", blocks), [], "target", "blocks", ["source"])
    quotas = stored(quotas.select(F.col("source").alias("of"), "source_size", "target", F.col("quota").alias("blocks")), "quotas")

    # A source is dealt over as many shards as its words ask for; Spark splits the join's hot source.
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    pick = F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("bigint")
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("bigint")
    dealt = (
        rows.join(quotas, F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("pick", pick)
        .withColumn("shard", F.pmod("pick", shards))
    )
    per_shard = dealt.groupBy("source", "shard", "blocks").agg(F.sum("size").alias("shard_size"))
    won = apportion(per_shard, ["source"], "shard_size", "blocks", ["shard"])
    cut = F.greatest(F.lit(1), F.round(F.col("shard_size") / block_words)).cast("bigint")
    won = (
        won.withColumn("cut", cut)
        .withColumn("quota", F.least("quota", F.col("cut") * max_repeats))
        .withColumn("passes", F.floor(F.col("quota") / F.col("cut")))
        .withColumn("front", F.floor((F.col("quota") % F.col("cut")) * F.col("shard_size") / F.col("cut")))
        .select(F.col("source").alias("of"), F.col("shard").alias("in"), "passes", "front")
    )
    laid = Window.partitionBy("source", "shard").orderBy("pick", "doc_id", "size")
    placed = dealt.withColumn("end", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("front") - (F.col("end") - F.col("size"))))
    return placed.join(won, F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("in"))).select(
        "doc_id", "size", "source_size", "target", (F.col("passes") * F.col("size") + rest).cast("bigint").alias("taken"),
        *[F.col(f"_{c}").alias(c) for c in keep],
    )


SQL = """
WITH rows_ AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)] AS weight
  FROM rows_ GROUP BY source),
total AS (SELECT CAST(sum(source_size) AS DOUBLE) * 150 / 100 AS t FROM ranked),
-- brute force: the level is the highest at which the shares do not exceed the total
levels AS (SELECT DISTINCT source_size * 2.0 / weight AS lv FROM ranked),
capped AS (
  SELECT r.*, coalesce(r.source_size * 2.0 / r.weight <= (
      SELECT max(lv) FROM levels l
      WHERE (SELECT sum(least(x.source_size * 2.0, x.weight * l.lv)) FROM ranked x) <= (SELECT t FROM total)), false) AS full_
  FROM ranked r),
targets AS (
  SELECT source, source_size, CASE WHEN full_ THEN CAST(source_size * 2 AS DOUBLE)
    ELSE weight * ((SELECT t FROM total) - (SELECT coalesce(sum(source_size * 2), 0) FROM capped WHERE full_))
         / (SELECT sum(weight) FROM capped WHERE NOT full_) END AS target
  FROM capped),
quotient AS (
  SELECT source, unnest(range(0, CAST(target / 16 AS BIGINT) + 3)) AS k, target FROM targets WHERE target > 0),
won AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS place FROM quotient),
quota AS (
  SELECT source, count(*) AS blocks FROM won
  WHERE place <= (SELECT round(sum(target) / 16) FROM targets) GROUP BY source),
dealt AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, coalesce(q.blocks, 0) AS blocks,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS pick
  FROM rows_ d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
  LEFT JOIN quota q ON d.source IS NOT DISTINCT FROM q.source),
sharded AS (
  SELECT *, pick % CAST(greatest(1, ceil(source_size / 1000000.0)) AS BIGINT) AS shard FROM dealt),
shards AS (
  SELECT source, shard, blocks, CAST(sum(size) AS BIGINT) AS shard_size,
         greatest(1, CAST(round(sum(size) / 16.0) AS BIGINT)) AS cut
  FROM sharded GROUP BY source, shard, blocks),
shard_won AS (
  SELECT source, shard, blocks,
         row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k + 1) DESC, shard, k) AS place
  FROM (SELECT *, unnest(range(0, blocks)) AS k FROM shards WHERE shard_size > 0)),
shard_quota AS (
  SELECT s.source, s.shard, any_value(s.shard_size) AS shard_size, any_value(s.cut) AS cut,
         least(count(w.place), any_value(s.cut) * 2) AS quota
  FROM shards s LEFT JOIN shard_won w
    ON s.source IS NOT DISTINCT FROM w.source AND s.shard = w.shard AND w.place <= w.blocks
  GROUP BY s.source, s.shard),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY pick, doc_id, size
                            ROWS UNBOUNDED PRECEDING) - size AS start FROM sharded)
SELECT p.doc_id, p.size, p.source_size, p.target,
       CAST((q.quota // q.cut) * p.size + greatest(0, least(p.size,
            (q.quota % q.cut) * q.shard_size // q.cut - p.start)) AS BIGINT) AS taken
FROM placed p JOIN shard_quota q ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard
"""
