"""Line dedup by overlapping three-line windows, in DataFrame functions only.

Every run of three lines is hashed. Of each window that occurs more than once
anywhere, the first occurrence (by doc_id, text hash, position) stays; every line that
a later occurrence covers goes, so overlapping occurrences merge. The first
place of a line's content is never covered, so no content is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import stored, unused

LINES = 3


def _later_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, starts): where later occurrences of repeated windows begin, per id and text."""
    lines = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("mark"), F.split("text", "\n").alias("lines"))
    # As a condition on the sequence, not a filter, which Spark would move below the split and run it twice.
    places = F.when(F.size("lines") >= LINES, F.sequence(F.lit(1), F.size("lines") - (LINES - 1)))
    at = lines.select("doc_id", "mark", "lines", F.explode(places).alias("pos"))
    run = [F.expr(f"element_at(lines, pos + {k})") for k in range(LINES)]
    window = F.concat_ws("\n", *run)
    windows = at.where(F.length(F.trim(F.translate(window, "\n\r\t", ""))) > 0).select(
        "doc_id", "mark", "pos", F.unhex(F.md5(window.cast("binary"))).alias("window")
    )
    windows = stored(windows, "windows")
    first = (
        windows.groupBy("window")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "pos")).alias("first"))
        .where("n > 1")
        .select("window", "first")
    )
    first = stored(first, "repeated")  # a plain side, so Spark can split the join at a hot window
    here = F.struct("doc_id", "mark", "pos")
    return (
        windows.join(first, "window")
        .where(~here.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "mark")
        .agg(F.sort_array(F.collect_set("pos")).alias("starts"))
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with ``text`` reduced, plus ``lines_in`` and ``lines_removed``.

    Lines end at ``\\n``. Windows without any visible character do not count, nor
    do texts of fewer than three lines. Null and empty texts stay as they are.
    A document is its doc_id and text: rows that share an id but not the text
    are apart, equal rows lose the same lines, and an occurrence counts once per
    (doc_id, text hash, position). A null doc_id counts as smallest. An empty table gives no rows. All other columns pass through; own
    columns named like the two new ones are replaced.
    """
    docs = docs.drop("lines_in", "lines_removed")
    id_, mark, starts, cut, gone = unused(docs, "of_id", "of_mark", "starts", "cut_lines", "gone")
    marks = _later_windows(docs.select("doc_id", "text"))
    marks = marks.select(F.col("doc_id").alias(id_), F.col("mark").alias(mark), F.col("starts").alias(starts))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(mark))
    joined = docs.join(marks, same, "left")
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda p: F.sequence(p, p + (LINES - 1)))))
    joined = joined.withColumns({cut: F.split("text", "\n"), gone: F.when(F.col(starts).isNotNull(), covered)})
    kept = F.array_except(F.sequence(F.lit(1), F.size(cut)), F.col(gone))
    text = F.array_join(F.transform(kept, lambda p: F.element_at(cut, p)), "\n")
    known = F.col("text").isNotNull()
    hit = F.col(gone).isNotNull() & known
    counts = {
        "lines_in": F.when(known, F.size(cut)).otherwise(0),
        "lines_removed": F.when(hit, F.size(cut) - F.size(kept)).otherwise(0),
    }
    out = joined.withColumns(counts).withColumn("text", F.when(hit, text).otherwise(F.col("text")))
    return out.drop(id_, mark, starts, cut, gone)


SQL = """
WITH lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, pos, l[pos] || chr(10) || l[pos + 1] || chr(10) || l[pos + 2] AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS pos FROM lines WHERE len(l) >= 3)),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS nth
  FROM windows WHERE length(trim(translate(w, chr(10) || chr(13) || chr(9), ''))) > 0),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM ranked, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1),
single AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS pos FROM lines),
kept AS (
  SELECT s.doc_id, string_agg(s.l[s.pos], chr(10) ORDER BY s.pos) FILTER (WHERE g.pos IS NULL) AS text,
         CAST(count(*) AS INTEGER) AS lines_in, CAST(count(g.pos) AS INTEGER) AS lines_removed
  FROM single s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos GROUP BY s.doc_id)
SELECT doc_id, coalesce(text, '') AS text, lines_in, lines_removed FROM kept
"""
