"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its text. The ledger
notes which (blob, rule version) pairs were scanned and what they held; only
pairs it does not know are scanned, once per blob however many paths and
versions share it, and findings are joined back to all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import stored, unused


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter than ``least`` are dropped.

    ``fast`` may name a pattern that finds just the matches that are kept, with
    the same groups. Whoever writes the rule vouches for that; it is not checked.
    """

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    fast: str | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three kinds in their listed order.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
RULES = (
    Rule("assign", 1, ASSIGN, 2, 6),
    # Runs end at a character outside the class whether long or short: asking for
    # the least length at once finds the same runs with far fewer matches.
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20, fast="AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "[0-9a-f]+", 0, 24, fast="[0-9a-f]{24,}"),
)
LEDGER = "blob binary, rules array<string>, findings array<struct<rule:string,start:int,stop:int>>"


def _matches(text: Column, rule: Rule) -> Column:
    """(rule, start, stop) of every kept match, in code points.

    The pieces between matches and the matches themselves alternate, so their
    lengths add up to positions. The group is taken from the match in its text, so
    patterns may look around themselves; a pattern must not match the empty text.
    """
    pattern = rule.fast or rule.pattern
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.expr("named_struct('at', 0, 'spans', cast(array() as array<struct<rule:string,start:int,stop:int>>))")

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        stop = start + F.length(x["hit"])
        span = F.array(F.struct(F.lit(rule.key).alias("rule"), start.alias("start"), stop.alias("stop")))
        spans = F.when(F.length(x["value"]) >= rule.least, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(stop.alias("at"), spans.alias("spans"))

    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)) if rule.group else found
    both = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("hit"), values.alias("value"))
    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(both, none, step, lambda a: a["spans"]))


def scan(blobs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Ledger rows of ``blobs`` (blob, text, pending): each blob's pending rules, applied."""
    empty = F.expr("cast(array() as array<struct<rule:string,start:int,stop:int>>)")
    parts = [
        F.coalesce(F.when(F.array_contains("pending", r.key), _matches(F.col("text"), r)), empty) for r in rules
    ]
    return blobs.select("blob", F.col("pending").alias("rules"), F.concat(*parts).alias("findings"))


def address(versions: DataFrame) -> DataFrame:
    """``versions`` with ``blob``, the SHA-256 of ``text``; null counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return versions.withColumn("text", text).withColumn("blob", F.unhex(F.sha2(text.cast("binary"), 256)))


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows to append to ``ledger``: one per blob with a rule version not yet scanned.

    ``versions`` needs ``text``; repeated texts are scanned once. Each task
    first keeps one row per blob of its own, so thousands of copies do not meet.
    """
    wanted = F.array(*[F.lit(r.key) for r in rules])
    blobs = address(versions.select("text")).dropDuplicates(["blob"]).withColumn("pending", wanted)
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn(
            "pending", F.array_except("pending", F.coalesce("seen", F.expr("cast(array() as array<string>)")))
        )
        blobs = blobs.where(F.size("pending") > 0).drop("seen")
    return scan(blobs, rules)


def findings_by_path(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``versions`` without text, with ``blob`` and ``findings``: what the ledger holds for their blob under ``rules``.

    Sorted by start, then kind as listed; versions without a finding get an
    empty array. Null and empty texts share one blob without findings. Columns
    of the caller that are called ``blob`` or ``findings`` come back as
    ``given_blob`` and ``given_findings`` (more underscores if those are taken).
    """
    current = F.array(*[F.lit(r.key) for r in rules])
    known = (
        ledger.where(F.size("findings") > 0)
        .groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("f"))
        .withColumn("f", F.filter("f", lambda x: F.array_contains(current, x["rule"])))
    )
    ranked = F.transform("f", lambda x: F.struct(x["start"], F.array_position(current, x["rule"]).alias("rank"), x["stop"], x["rule"]))
    # A kind may hold the mark too: the version follows the last one.
    kind = lambda rule: F.regexp_extract(rule, "^(.*)@", 1)
    plain = F.transform(
        F.array_sort(ranked),
        lambda x: F.struct(kind(x["rule"]).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")),
    )
    known = stored(known.select("blob", plain.alias("findings")), "findings")
    empty = F.expr("cast(array() as array<struct<kind:string,start:int,stop:int>>)")
    for name in ("blob", "findings"):
        if name in versions.columns:
            versions = versions.withColumnRenamed(name, unused(versions, f"given_{name}")[0])
    paths = address(versions).drop("text")
    return paths.join(known, "blob", "left").withColumn("findings", F.coalesce("findings", empty))


def secret_digest(docs: DataFrame, loads: Sequence[Sequence[Rule]] = (RULES[:2], RULES)) -> DataFrame:
    """Counts and spans per row of ``docs`` (doc_id, text), by way of a ledger.

    ``loads`` are the rules as they stood at each load of the documents, oldest
    first. Every load appends to the ledger what the ones before have not scanned:
    with the default, the first scans all blobs for two kinds, the second the same
    blobs for the kind that came later. The last load's rules give the findings.
    """
    versions = docs.select("doc_id", "text")
    ledger = None
    for rules in loads:
        added = stored(update_ledger(versions, ledger, rules), "ledger")
        ledger = added if ledger is None else ledger.unionByName(added)
    found = findings_by_path(versions, ledger, loads[-1])
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("bigint")
    spans = F.array_join(F.transform("findings", lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
    return found.withColumn("spans", spans).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def _sql_kind(rule: Rule, place: int) -> str:
    pattern = rule.pattern.replace("'", "''").replace("\\x20", " ")
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, hit,
         sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY nth) AS stop
  FROM (SELECT doc_id, unnest(range(1, len(h) + 1)) AS nth, unnest(h) AS hit, unnest(g[1:len(h)]) AS gap
        FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS h, string_split_regex(t, '{pattern}') AS g FROM texts))"""


SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
assign AS ({_sql_kind(RULES[0], 0)}),
access AS ({_sql_kind(RULES[1], 1)}),
hex AS ({_sql_kind(RULES[2], 2)}),
found AS (
  SELECT * FROM assign WHERE length(regexp_extract(hit, '{RULES[0].pattern.replace("'", "''").replace(chr(92) + "x20", " ")}', 2)) >= 6
  UNION ALL SELECT * FROM access WHERE length(hit) >= 20
  UNION ALL SELECT * FROM hex WHERE length(hit) >= 24),
told AS (
  SELECT doc_id, kind, string_agg(kind || ':' || CAST(stop - length(hit) AS BIGINT) || ':' || CAST(stop AS BIGINT), ','
                                  ORDER BY stop - length(hit), place) AS one,
         stop - length(hit) AS start, place FROM found GROUP BY doc_id, kind, start, place),
docs AS (
  SELECT t.doc_id, coalesce(string_agg(one, ',' ORDER BY start, place), '') AS spans,
         count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex
  FROM texts t LEFT JOIN told USING (doc_id) GROUP BY t.doc_id)
SELECT doc_id, n_assign, n_access, n_hex, sha256(spans) AS base_sha256, spans FROM docs
"""
