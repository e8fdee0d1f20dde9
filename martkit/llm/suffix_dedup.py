"""Suffix-array dedup on sparse suffixes.

Suffixes are kept only at minimiser positions, which the words around them
select, so equal passages keep equal positions. A passage of ``min_words`` words
has such a position within its first ``WINDOW`` words, followed by at least
``min_words - WINDOW + 1`` shared ones: suffixes whose next words occur nowhere
else leave early. The rest are sorted with their context; neighbours are
compared and matches extended left and right. Contexts of ``WINDOW`` words on
either side of the shared ones are enough, because a longer match holds further
positions whose matches overlap and merge.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import release, stored
from martkit.llm.ordered import adjacent_runs
from martkit.llm.tokens import full_window_hashes, text_runs, window_hashes, word_hashes

GRAM = 8
WINDOW = 24
_ROWS = 10_000


def minimisers(words: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Positions of the least word-run hash of every ``WINDOW`` consecutive runs of a text.

    ``words`` holds texts one after the other, ``stops`` where the text of each word ends.
    """
    grams = full_window_hashes(words, GRAM)
    if len(grams) < WINDOW:
        return np.zeros(0, np.int64)
    # The first least of twice as many runs is that of the first or of the second half.
    least, width = np.arange(len(grams)), 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        first, then = least[:-step], least[step:]
        least = np.where(grams[then] < grams[first], then, first)
        width += step
    whole = np.arange(len(least)) + WINDOW + GRAM - 1 <= stops[: len(least)]
    kept = np.zeros(len(words), bool)
    kept[least[whole]] = True
    return np.flatnonzero(kept)


def _anchors(rows: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, row, key, pos): hash of the words that follow every kept position."""
    ahead = min_words - WINDOW + 1

    def read(batches):
        for batch in batches:
            for first, words, bounds in text_runs(batch.column("text").to_pylist()):
                sizes = np.diff(bounds)
                texts, stops = np.repeat(np.arange(len(sizes)), sizes), np.repeat(bounds[1:], sizes)
                at = minimisers(words, stops)
                at = at[(at + ahead <= stops[at]) & (sizes[texts[at]] >= min_words)]
                if not len(at):
                    continue
                of = pa.array(first + texts[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(of),
                        batch.column("row").take(of),
                        pa.array(full_window_hashes(words, ahead)[at].view(np.int64)),
                        pa.array((at - bounds[texts[at]]).astype(np.int32)),
                    ],
                    names=["doc_id", "row", "key", "pos"],
                )

    return rows.mapInArrow(read, "doc_id bigint, row bigint, key bigint, pos int")


def _word_runs(short: np.ndarray, starts: np.ndarray, sizes: np.ndarray, step: int) -> pa.Array:
    """Binary column of the ``sizes`` words from ``starts`` on, forwards or (``step`` -1) backwards."""
    along = np.arange(WINDOW)
    taken = (starts[:, None] + step * along)[along < sizes[:, None]]
    bounds = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(4 * sizes, out=bounds[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(short[taken])])


def _contexts(marked: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, row, key, pos, behind, ahead) of the given positions; words as 32-bit hashes.

    ``behind`` runs backwards, so that its common prefix is the match to the left;
    ``ahead`` starts after the words of the key, which equal keys share.
    """
    start = min_words - WINDOW + 1

    def read(batches):
        for batch in batches:
            places = batch.column("places")
            for first, words, bounds in text_runs(batch.column("text").to_pylist()):
                keys = full_window_hashes(words, start).view(np.int64)
                short = (words >> np.uint64(32)).astype(">u4")
                own = places.slice(first, len(bounds) - 1)
                texts = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy(zero_copy_only=False))
                found = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                for i in range(0, len(found), _ROWS):
                    text, pos = texts[i : i + _ROWS], found[i : i + _ROWS]
                    at, of = bounds[text] + pos, pa.array(first + text)
                    left = bounds[text + 1] - at - start
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(of),
                            batch.column("row").take(of),
                            pa.array(keys[at]),
                            pa.array(pos.astype(np.int32)),
                            _word_runs(short, at - 1, np.minimum(pos, WINDOW - 1), -1),
                            _word_runs(short, at + start, np.minimum(left, WINDOW), 1),
                        ],
                        names=["doc_id", "row", "key", "pos", "behind", "ahead"],
                    )

    return marked.mapInArrow(read, "doc_id bigint, row bigint, key bigint, pos int, behind binary, ahead binary")


def _common(runs: pa.Array) -> np.ndarray:
    """Equal words at the start of each row and the next."""
    bounds = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset : runs.offset + len(runs) + 1]
    sizes = np.diff(bounds) // 4
    within = np.arange(WINDOW) < sizes[:, None]
    words = np.zeros(within.shape, np.uint32)
    if bounds[-1] > bounds[0]:
        words[within] = np.frombuffer(runs.buffers()[2], np.uint32)[bounds[0] // 4 : bounds[-1] // 4]
    ended = np.ones((len(runs) - 1, WINDOW + 1), bool)
    ended[:, :-1] = (words[1:] != words[:-1]) | ~(within[1:] & within[:-1])
    return ended.argmax(axis=1)


def _neighbour_matches(contexts: DataFrame, by: tuple[str, str], shared: int) -> DataFrame:
    """(doc_id, row, key, pos, left, right) of each suffix with both neighbours of its key, once if equal."""

    def pairs(run):
        keys = run.column("key").to_numpy()
        at = np.flatnonzero(keys[1:] == keys[:-1])
        left = _common(run.column("behind").cast(pa.binary()))[at].astype(np.int32)
        right = (shared + _common(run.column("ahead").cast(pa.binary()))[at]).astype(np.int32)
        # The second row of a pair is the first of the next one and names an equal match there.
        last = np.ones(len(at), bool)
        last[:-1] = (at[1:] != at[:-1] + 1) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        of = pa.array(np.concatenate([at, at[last] + 1]))
        return [
            *[run.column(c).take(of) for c in ("doc_id", "row", "key", "pos")],
            *[pa.array(np.concatenate([m, m[last]])) for m in (left, right)],
        ]

    order = [F.col(c) for c in ("key", *by, "doc_id", "row", "pos")]
    return adjacent_runs(contexts, order, pairs, "doc_id bigint, row bigint, key bigint, pos int, left int, right int")


def _windows(members: DataFrame, rows: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, row, start, key, wanted): passages of ``min_words`` words around the given suffixes.

    All those within the longest matches to the left and right; ``wanted`` are
    the ones around an open suffix that no match with a neighbour covers.
    """

    def read(batches):
        for batch in batches:
            out = []
            for i, h, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text", "suffixes"))):
                keys = window_hashes(word_hashes(text.encode("utf-8")), min_words).view(np.int64)
                starts: dict[int, bool] = {}
                for x in found:
                    p = x["pos"]
                    known = [(p - m["left"], p + m["right"] - min_words) for m in x["spans"]]
                    for k in range(p - x["most_left"], p + x["most_right"] - min_words + 1):
                        wanted = x["open"] and not any(a <= k <= b for a, b in known)
                        starts[k] = starts.get(k, False) or wanted
                out += [(i, h, k, int(keys[k]), w) for k, w in starts.items()]
            if out:
                cols = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()]
                names = ["doc_id", "row", "start", "key", "wanted"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row"))
    return rows.join(members, same).select("doc_id", "row", "text", "suffixes").mapInArrow(
        read, "doc_id bigint, row bigint, start int, key bigint, wanted boolean"
    )


def repeated_spans(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(doc_id, start_word, end_word): maximal runs of words that lie in repeated passages.

    A passage of ``min_words`` words or more counts when it occurs at two places,
    in two documents or one. Words are runs without white space, A-Z as a-z;
    ``end_word`` is exclusive. Null, empty and shorter texts have no span.
    Every row is a document of its own, so repeated rows are copies. Other columns
    are ignored; an empty table gives no rows.
    """
    if min_words < WINDOW + GRAM:
        raise ValueError(f"min_words must be {WINDOW + GRAM} or more")
    rows = docs.where("text is not null").select(
        F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text").cast("string")).alias("row"), F.col("text").cast("string")
    )
    anchors = stored(_anchors(rows, min_words), "anchors")
    repeated = stored(anchors.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "keys")
    places = (
        anchors.join(repeated, "key", "left_semi")
        .groupBy(F.col("doc_id").alias("of"), F.col("row").alias("of_row"))
        .agg(F.sort_array(F.collect_set("pos")).alias("places"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row"))
    marked = rows.join(places, same).select("doc_id", "row", "text", "places")
    contexts = stored(_contexts(marked, min_words), "contexts")
    release(anchors, repeated)

    # Neighbours by what follows hold the longest match to the right, by what precedes to the left.
    shared = min_words - WINDOW + 1
    matches = _neighbour_matches(contexts, ("ahead", "behind"), shared).unionAll(
        _neighbour_matches(contexts, ("behind", "ahead"), shared)
    )
    release(contexts)
    both = F.col("left") + F.col("right")
    found = stored(
        matches.groupBy("doc_id", "row", "pos").agg(
            F.first("key").alias("key"),
            F.max("left").alias("most_left"),
            F.max("right").alias("most_right"),
            F.max(both).alias("most"),
            F.collect_set(F.when(both >= min_words, F.struct("left", "right"))).alias("spans"),
        ),
        "matches",
    )
    long = found.select("doc_id", "row", "pos", F.explode("spans").alias("s")).select(
        "doc_id", "row", (F.col("pos") - F.col("s.left")).alias("start"), (F.col("pos") + F.col("s.right")).alias("stop")
    )
    # Where no single neighbour has both, other partners may match in between: compare every
    # passage around such an open suffix with those around all suffixes of its key.
    reach = F.col("most_left") + F.col("most_right")
    found = found.withColumn("open", (reach > F.col("most")) & (reach >= min_words))
    keys = stored(found.where("open").select("key").distinct(), "open_keys")
    members = (
        found.join(keys, "key", "left_semi")
        .groupBy(F.col("doc_id").alias("of"), F.col("row").alias("of_row"))
        .agg(F.collect_list(F.struct("pos", "most_left", "most_right", "spans", "open")).alias("suffixes"))
    )
    windows = stored(_windows(members, rows, min_words), "passages")
    place = F.struct("doc_id", "row", "start")
    twice = (
        windows.groupBy("key")
        .agg(F.bool_or("wanted").alias("wanted"), F.min(place).alias("lo"), F.max(place).alias("hi"))
        .where(F.col("wanted") & ~F.col("lo").eqNullSafe(F.col("hi")))
    )
    more = windows.join(stored(twice.select("key"), "twice"), "key", "left_semi").select(
        "doc_id", "row", "start", (F.col("start") + min_words).alias("stop")
    )
    return _merged(long.unionAll(more))


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a document joined."""
    empty = F.expr("cast(array() as array<struct<start:int,stop:int>>)")

    def step(acc, s):
        last = F.element_at(acc, -1)
        grown = F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))),
        )
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["stop"] >= s["start"]), grown).otherwise(F.concat(acc, F.array(s)))

    listed = F.array_sort(F.collect_set(F.struct("start", "stop")))
    return (
        spans.groupBy("doc_id", "row")
        .agg(F.explode(F.aggregate(listed, empty, step)).alias("s"))
        .select("doc_id", F.col("s.start").alias("start_word"), F.col("s.stop").alias("end_word"))
    )
