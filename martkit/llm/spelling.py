"""Spelling variants by reduced-alphabet generation.

Every letter is hashed to one of a few symbols, so a word becomes a reduced word
over a small alphabet. Two words one edit apart have reduced words at most one
edit apart. The one-edit neighbourhood of every reduced word is generated over
the small alphabet and joined with the reduced vocabulary; the pairs that meet
are verified on the original strings.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import release, stored

LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0xC0, 0x100)]))
SYMBOLS = 8
_HELD = 200_000  # words a task counts before it passes the counts on
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_counts(docs: DataFrame, min_chars: int = 6, damage: int | None = None) -> DataFrame:
    """(word, n): occurrences of every word of at least ``min_chars`` letters in the whole texts.

    A word is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased.
    With ``damage`` a run whose crc32 of ``<doc_id>:<run>`` it divides loses one
    code point first; a null doc_id is written as empty there. Null and empty
    texts have no words. Repeated rows count each. Other columns are ignored.
    """
    runs = re.compile(f"[a-zÀ-ÿ]{{{min_chars},}}")

    def count(batches):
        held: Counter[str] = Counter()

        def passed_on():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = Counter(runs.findall(text.encode("utf-8").translate(_LOWER).decode("utf-8"))) if text else {}
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in found.items():
                    if damage:
                        h = zlib.crc32(run.encode("utf-8"), start)
                        if h % damage == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < min_chars:
                                continue
                    held[run] += n
                if len(held) >= _HELD:
                    yield passed_on()
        if held:
            yield passed_on()

    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def reduced(word: Column, symbols: int = SYMBOLS) -> Column:
    """``word`` over the reduced alphabet; a character that is no letter keeps its place as symbol 0."""
    to = "".join(chr(ord("0") + zlib.crc32(c.encode("utf-8")) % symbols) for c in LETTERS)
    return F.regexp_replace(F.translate(word, LETTERS, to), "[^0-9:-~]", "0")


def neighbourhood(code: Column, symbols: int = SYMBOLS) -> Column:
    """Hashes of the reduced word, first, and of its one-edit neighbours that come before it.

    Neighbours are mirror images: what one word reaches by an insertion or a
    greater symbol reaches it by a deletion or a smaller one. So the full
    neighbourhoods of both ends are covered with each pair of neighbours
    generated once, from its longer or greater end.
    """
    places = F.sequence(F.lit(1), F.length(code))
    before = lambda i: F.substring(code, F.lit(1), i - 1)
    after = lambda i: F.substring(code, i + 1, F.length(code))
    gone = F.transform(places, lambda i: F.concat(before(i), after(i)))
    smaller = lambda i: F.filter(
        F.array(*[F.lit(chr(ord("0") + s)) for s in range(symbols - 1)]), lambda s: s < F.substring(code, i, F.lit(1))
    )
    other = F.flatten(F.transform(places, lambda i: F.transform(smaller(i), lambda s: F.concat(before(i), s, after(i)))))
    return F.transform(F.array_distinct(F.concat(F.array(code), gone, other)), lambda r: F.xxhash64(r))


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(a, n_a, b, n_b): every pair of words one edit apart, once; ``vocabulary`` is (word, n), unique words.

    Candidates share a hash of a reduced neighbour and are verified inside the
    join, so only true pairs leave it; Spark splits a reduced word that many
    words share. No word is left out, however many neighbours it has.
    """
    coded = vocabulary.withColumn("code", reduced(F.col("word"), symbols))
    near = coded.select(
        F.col("word").alias("a"), F.col("n").alias("n_a"), F.posexplode(neighbourhood(F.col("code"), symbols)).alias("place", "key")
    )
    home = coded.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.xxhash64("code").alias("key"))
    # Words of one reduced word (the first neighbour) meet both ways; the pair in order stays.
    once = (F.col("place") > 0) | (F.col("a") > F.col("b"))
    return near.join(home, "key").where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")


def variant_forms(vocabulary: DataFrame, ratio: int = 5, symbols: int = SYMBOLS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``vocabulary``.

    ``form`` is the near word of largest n, ties by code point, if that n is at
    least ``ratio`` times the word's; ``root`` ends the chain of forms. Counts
    grow along a chain where ``ratio`` is above 1, so it has no cycle; it is
    followed by doubling, in joins. With a lower ratio two words may be the form
    of each other (longer circles cannot be: nearness is mutual and the least by
    n and code point wins); they have no root and are refused.
    """
    pairs = stored(near_words(vocabulary, symbols), "near")
    both = pairs.unionAll(pairs.select("b", "n_b", "a", "n_a"))
    best = (
        both.groupBy("a")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b"))).alias("best"))
        .select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("form"), (-F.col("best.less")).alias("form_n"))
    )
    accepted = F.col("form_n") >= F.col("n") * ratio
    told = stored(
        vocabulary.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(accepted, F.col("form")).alias("form"),
            F.when(accepted, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    release(pairs)
    ends = stored(told.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(ends.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release(ends)
        moved, circle = after.agg(F.bool_or("moved"), F.bool_or(F.col("root") == F.col("word"))).first()
        if circle:
            raise ValueError("forms lead in a circle: ratio must be above 1")
        ends = after.select("word", "root")
        if not moved:
            break
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, symbols: int = SYMBOLS, damage: int | None = None
) -> DataFrame:
    """``variant_forms`` of the words of at least ``min_chars`` and ``min_count`` occurrences in ``docs`` (doc_id, text).

    Null, empty and repeated rows as in ``word_counts``; an empty table, or one
    without such words, gives no rows. Extra columns of any name are ignored.
    """
    words = stored(word_counts(docs, min_chars, damage).where(F.col("n") >= min_count), "vocabulary")
    return variant_forms(words, ratio, symbols)


SQL = f"""
WITH runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
per_doc AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
-- crc32 bit by bit: every byte, then eight steps marked -1
coded AS (
  SELECT run, c, 4294967295 - CAST(list_reduce(flatten(list_transform(
      string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda x: CASE WHEN ord(x) < 128 THEN [ord(x), -1, -1, -1, -1, -1, -1, -1, -1]
                     ELSE [195, -1, -1, -1, -1, -1, -1, -1, -1, ord(x) - 64, -1, -1, -1, -1, -1, -1, -1, -1] END)),
      lambda v, b: CASE WHEN b >= 0 THEN xor(v, CAST(b AS BIGINT)) ELSE xor(v >> 1, 3988292384 * (v & 1)) END,
      CAST(4294967295 AS BIGINT)) AS BIGINT) AS h
  FROM per_doc),
cut AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM coded),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
without AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(0, length(word))) AS i FROM v)),
near AS (
  SELECT DISTINCT * FROM (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT a.word, a.n, b.word, b.n FROM without a JOIN v b ON a.rest = b.word
    UNION ALL SELECT b.word, b.n, a.word, a.n FROM without a JOIN v b ON a.rest = b.word)),
best AS (
  SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS top FROM near GROUP BY word),
told AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top.less >= 5 * v.n THEN top.other END AS form, CASE WHEN -top.less >= 5 * v.n THEN -top.less END AS form_n
  FROM v LEFT JOIN best USING (word)),
chain AS (
  WITH RECURSIVE step(word, here) AS (
    SELECT word, word FROM told
    UNION ALL SELECT s.word, t.form FROM step s JOIN told t ON t.word = s.here WHERE t.form IS NOT NULL)
  SELECT s.word, s.here AS root FROM step s JOIN told t ON t.word = s.here WHERE t.form IS NULL)
SELECT t.word, t.form, c.root, t.n, t.n_near, t.form_n FROM told t JOIN chain c USING (word)
"""
