"""N-gram Jaccard join by multiple-global-order filtering.

Two texts link when their sets of n-word shingles reach a Jaccard similarity of
``percent`` / 100. For a set of ``s`` shingles and any total order of shingles,
a partner shares one of its first ``s - ceil(t s) + 1``: a candidate pair has to
do so under each of several orders. Nothing is capped; the filters only remove
pairs that cannot link.

1. Equal sets become one class (128-bit digest), so copies cost one row each.
2. Screen, order "lowest hash first": a class whose prefix under it is
   held by no other class has no partner. Most texts leave here.
3. Order "rarest first", with exact counts among the classes left. Shingles of
   one class only are known misses and bound the overlap of each pair.
4. Every class first meets one hub of its lists; components shrink to labels.
   Then the pairs left in lists with several labels meet in blocks, must also
   share a prefix under a third, unrelated order and differ in no more parity
   bits than linked sets can, and are verified exactly.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import release, stored, unused
from martkit.llm.components import connected_components
from martkit.llm.tokens import shingle_set
from martkit.operators.joins import split_hot_join

_CLASS_BITS = 40
_SCREEN_BITS = 48


def prefix_length(size, percent: int):
    """``s - ceil(t s) + 1`` in whole numbers."""
    return size - (size * percent + 99) // 100 + 1


def _screen_tokens(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Shingles whose hash is below 1.5 (1 - t) of the range: usually more than the prefix."""
    bound = np.uint64((1 << 64) * 3 * (100 - percent) // 200)
    return shingles[: np.searchsorted(shingles, bound)] & np.uint64((1 << _SCREEN_BITS) - 1)


def _sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, cls, sid, sample) of every row of ``docs``."""
    least = -(-percent // (100 - percent))  # smaller sets link with equal sets only

    def read(batches):
        for batch in batches:
            sizes, cls, sid, sample = [], [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), words)
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                sizes.append(len(s))
                cls.append(digest if len(s) else None)
                sid.append(int.from_bytes(digest[:8], "little") & ((1 << _CLASS_BITS) - 1))
                sample.append(_screen_tokens(s, percent).astype(np.int64) if len(s) >= least else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(cls, pa.binary()),
                    pa.array(sid, pa.int64()),
                    pa.array(sample, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "cls", "sid", "sample"],
            )

    schema = "doc_id bigint, n_shingles bigint, cls binary, sid bigint, sample array<bigint>"
    return docs.mapInArrow(read, schema)


def _parity(shingles: np.ndarray) -> np.ndarray:
    """Parity of the set's hashes modulo a power of two, four bits a shingle or more, as 64-bit words.

    Two sets differ in at least as many shingles as their parities differ in bits.
    """
    bits = max(512, 1 << (4 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _few_parity_bits(a: str, b: str, percent: int) -> Column:
    """Pair bound: the parities differ in no more bits than the sets of a link can in shingles."""
    least = F.least(F.size(f"{a}parity"), F.size(f"{b}parity"))

    def folded(side: str) -> Column:  # near sizes differ by one doubling at most
        words = F.col(f"{side}parity")
        halves = F.zip_with(F.slice(words, 1, least), F.slice(words, least + 1, least), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(words) > least, halves).otherwise(words)

    odd = F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differing = F.aggregate(odd, F.lit(0), lambda total, one: total + one)
    return (100 + percent) * differing <= (100 - percent) * (F.col(f"{a}n") + F.col(f"{b}n"))


def _shingle_rows(docs: DataFrame, words: int) -> DataFrame:
    """(cls, shingles, parity) of the given texts."""

    def read(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([_parity(s) for s in sets], pa.list_(pa.int64())),
                ],
                names=["cls", "shingles", "parity"],
            )

    return docs.mapInArrow(read, "cls binary, shingles array<bigint>, parity array<bigint>")


def _screened(sets: DataFrame, percent: int) -> DataFrame:
    """Class heads (cls, head) that may have a partner, by the screen order.

    A shingle counts as shared only between sets of near size, which chance
    hits on common words rarely are: sizes fall into bands as wide as the size
    ratio of partners, and two staggered pairings of bands put partners together.
    """
    width = math.log(100 / percent) * 1.001
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / width).cast("bigint")
    told = sets.where("sample is not null").select("sid", band.alias("band"), F.explode("sample").alias("token"))
    keys = F.array(
        F.xxhash64("token", F.floor(F.col("band") / 2), F.lit(0)), F.xxhash64("token", F.floor((F.col("band") + 1) / 2), F.lit(1))
    )
    rows = told.select("sid", "token", F.explode(keys).alias("key"))
    ends = rows.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"))
    shared = stored(ends.where("lo <> hi").select("key"), "shared")  # plain sides let Spark split hot keys
    hits = rows.join(shared, "key", "left_semi").select("sid", "token").distinct().groupBy("sid").agg(F.count("*").alias("hits"))
    heads = (
        sets.where("sample is not null")
        .groupBy("cls")
        .agg(
            F.min("doc_id").alias("head"),
            F.first("n_shingles").alias("n"),
            F.first("sid").alias("sid"),
            F.first(F.size("sample")).alias("own"),
        )
    )
    length = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    # Unshared shingles that fill the whole prefix rule every partner out.
    missed = F.col("own") - F.coalesce("hits", F.lit(0))
    return heads.join(hits, "sid", "left").where(missed < length).select("cls", "head", "n")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Pair bound: sizes are near, and the overlap without known misses suffices."""
    most = F.least(F.col(f"{a}n") - F.col(f"{a}alone"), F.col(f"{b}n") - F.col(f"{b}alone"))
    return (100 + percent) * most >= percent * (F.col(f"{a}n") + F.col(f"{b}n"))


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose exact overlap reaches the threshold."""
    left = tokens.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    right = tokens.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where((100 + percent) * both >= percent * (F.size("sa") + F.size("sb")))
        .select("a", "b")
    )


def class_links(docs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) over classes; classes without a link are absent."""
    heads = stored(_screened(sets, percent), "heads")
    text = docs.join(heads.select(F.col("head").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
    text = text.unionAll(docs.where("doc_id is null").select("text"))  # classes without an id; known ones meet again below
    tokens = stored(
        _shingle_rows(text, words).join(heads.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]), "shingles"
    )
    release(heads)
    rows = tokens.select("cls", F.size("shingles").alias("n"), F.explode("shingles").alias("token"))
    counts = stored(rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "counts")
    length = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    postings = (
        rows.join(counts, "token")
        .groupBy("cls")
        .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("known"))
        .withColumn("alone", F.col("n") - F.size("known"))
        .withColumn("open", length - F.col("alone"))
        .where("open > 0")
        .select("cls", "n", "alone", F.explode(F.slice("known", 1, F.col("open"))).alias("k"))
        .select("cls", "n", "alone", F.col("k.token").alias("token"))
    )
    postings = stored(postings, "postings")

    hub = stored(postings.groupBy("token").agg(F.min(F.struct("alone", "cls", "n")).alias("hub")), "hubs")
    first = (
        postings.join(hub, "token")
        .where("hub.cls <> cls")
        .groupBy(F.col("cls").alias("b"))
        .agg(F.min("hub").alias("hub"), F.first("n").alias("bn"), F.first("alone").alias("balone"))
        .select("b", "bn", "balone", F.col("hub.cls").alias("a"), F.col("hub.n").alias("an"), F.col("hub.alone").alias("aalone"))
        .where(_may_link("a", "b", percent))
        .select("a", "b")
    )
    links = stored(_verified(first, tokens, percent), "links")
    labels = stored(connected_components(links), "labels")

    named = postings.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "label", F.coalesce("component", "cls")
    )
    mixed = named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    named = stored(
        named.join(stored(mixed.select("token"), "mixed"), "token", "left_semi").select("cls", "n", "alone", "label", "token"), "named"
    )
    # Both prefixes go along: the pair is taken at its first common shingle only, and
    # must meet under a third order, unrelated to counts, as well.
    first_order = named.groupBy("cls").agg(F.sort_array(F.collect_list("token")).alias("prefix"))
    by_hash = F.array_sort(F.transform("shingles", lambda t: F.struct(F.xxhash64(t).alias("h"), t.alias("t"))))
    third = tokens.withColumn("n", F.size("shingles")).join(named.select("cls").distinct(), "cls", "left_semi")
    third = third.select("cls", "parity", F.transform(F.slice(by_hash, 1, length), lambda t: t["t"]).alias("third"))
    open_ = stored(named.join(first_order.join(third, "cls"), "cls"), "open_postings")
    side = lambda p: open_.select(
        "token", F.col("cls").alias(p), *[F.col(c).alias(f"{p}{c}") for c in ("n", "alone", "label", "prefix", "third", "parity")]
    )
    wanted = (
        (F.col("a") < F.col("b"))
        & (F.col("alabel") != F.col("blabel"))
        & _may_link("a", "b", percent)
        & _few_parity_bits("a", "b", percent)
        & (F.array_min(F.array_intersect("aprefix", "bprefix")) == F.col("token"))
        & F.arrays_overlap("athird", "bthird")
    )
    met = stored(split_hot_join(side("a"), side("b"), ["token"], wanted, "a", "b").select("a", "b"), "pairs")
    more = stored(_verified(met, tokens, percent), "links")
    return connected_components(links.unionAll(more))


def ngram_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text).

    ``component_id`` is the least doc_id reachable by links, itself included.
    Null, empty and wordless texts have size 0 and link with nothing; fewer than
    ``words`` words form one shingle. Rows with a null doc_id keep a null id and
    take the least known id of their component, or null. Repeated rows are
    linked like copies. Other columns are ignored. An empty table gives no rows.
    """
    if not 50 <= percent < 100:
        raise ValueError("percent must be from 50 to 99")
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    sets = stored(_sets(docs, words, percent), "sets")
    nodes = stored(class_links(docs, sets, words, percent), "nodes")
    # Least id per class, then per component; classes without a link stand alone.
    heads = sets.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("head"))
    named = heads.join(nodes.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("component", F.coalesce("component", "cls"))
    tops = named.groupBy("component").agg(F.min("head").alias("component_id"))
    classes = named.join(tops, "component").select("cls", "component_id")
    return sets.select("doc_id", "n_shingles", "cls").join(classes, "cls", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` without near copies: of each group the row with the least doc_id stays.

    Null ids come after all others, by text hash. Identical rows (id and text)
    leave one; rows that share only the id are documents of their own.
    """
    name = F.coalesce(
        F.col("doc_id").cast("bigint"), F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    )
    row, mark = unused(docs, "row_id", "text_mark")
    named = docs.withColumns({row: name, mark: F.xxhash64("text")})
    groups = ngram_join(named.select(F.col(row).alias("doc_id"), "text"), words, percent)
    heads = groups.where("doc_id = component_id").select(F.col("doc_id").alias(row)).distinct()
    return named.join(stored(heads, "kept"), row, "left_semi").dropDuplicates([row, mark]).drop(row, mark)


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
    ELSE unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words WHERE len(w) >= 3
  UNION SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 2),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 90 * ((SELECT n FROM sizes WHERE doc_id = a.doc_id) + (SELECT n FROM sizes WHERE doc_id = b.doc_id) - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, least(d.doc_id, min(r.b)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""
