"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows taken, role given last); edits are its edges. One
heap runs from the start, one from the accepting ends. When they have met, all
crossings of equal cost are finished, and of the cheapest paths through them the
one with the least audit, the initials of its edits, is taken.

Conversations are cut into segments where the partitions of a sorted table end,
and every ``SEGMENT`` rows; a segment is solved between all pairs of roles, and
the solutions are put together in order. So no task holds the rows of a long
conversation; only its audit, one letter per row, is one cell, as the result is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from heapq import heappop, heappush

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.common import release, stored
from martkit.llm.ordered import _batches

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
SEGMENT = 4096
_BLANKS = " \t\n\x0b\x0c\r"
#: What was given last: nothing, a system, a user, an assistant turn.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_ENDS = (_NONE, _ASSISTANT)
_KEPT = {"u": _USER, "a": _ASSISTANT}


def _then(state: int) -> int:
    """The role that must follow, where it is not a leading system turn."""
    return _ASSISTANT if state == _USER else _USER


def _before(state: int) -> Sequence[int]:
    return {_USER: (_NONE, _SYSTEM, _ASSISTANT), _ASSISTANT: (_USER,)}.get(state, ())


#: A row as the lattice sees it: initial of its role, must it go, is it truncated.
Row = tuple[str, bool, bool]


def _edges(rows: Sequence[Row], i: int, state: int) -> Iterable[tuple[str, int, int, int]]:
    """(initial of the edit, cost, rows taken, state) of all edits at a node, initials in order."""
    nxt = _then(state)
    if i < len(rows):
        initial, gone, cut = rows[i]
        late = TRUNCATED if cut else 0
        yield "D", DELETE, i + 1, state
    yield "I", INSERT, i, nxt
    if i < len(rows) and not gone:
        if initial == "s" and state == _NONE:
            yield "K", late, i + 1, _SYSTEM
        elif _KEPT.get(initial) == nxt:
            yield "K", late, i + 1, nxt
        yield "R", REROLE + late, i + 1, nxt


def _edges_into(rows: Sequence[Row], i: int, state: int) -> Iterable[tuple[int, int, int]]:
    """(cost, rows taken, state) of the nodes from which an edit leads here."""
    for p in _before(state):
        yield INSERT, i, p
    if i:
        initial, gone, cut = rows[i - 1]
        late = TRUNCATED if cut else 0
        yield DELETE, i - 1, state
        if gone:
            return
        if state == _SYSTEM and initial == "s":
            yield late, i - 1, _NONE
        for p in _before(state):
            if _KEPT.get(initial) == state:
                yield late, i - 1, p
            yield REROLE + late, i - 1, p


def cheapest(rows: Sequence[Row], start: int = _NONE, ends: Sequence[int] = _ENDS) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest repair of ``rows`` between two states; equal costs: the least audit.

    Memory is a few numbers per node, whatever the length of the audits: the
    least one is read off along the cheapest paths, whose letters tell them apart.
    """
    n = len(rows)
    size = (n + 1) * 4  # a heap entry is cost * size + place, so rows come in order within a cost
    seen_f, seen_b = {start: 0}, {n * 4 + e: 0 for e in ends}
    done_f: dict[int, int] = {}
    done_b: dict[int, int] = {}
    heap_f, heap_b = [start], sorted(ends)
    best = None
    while heap_f or heap_b:
        low_f, low_b = (heap[0] // size if heap else float("inf") for heap in (heap_f, heap_b))
        if best is not None and low_f + low_b > best:
            break
        if low_b <= low_f:
            cost, place = divmod(heappop(heap_b), size)
            i, state = n - place // 4, place % 4
            node = i * 4 + state
            if node in done_b:
                continue
            done_b[node] = cost
            if node in done_f:
                best = min(done_f[node] + cost, best if best is not None else done_f[node] + cost)
            for w, j, p in _edges_into(rows, i, state):
                to = j * 4 + p
                if to in done_f and (best is None or done_f[to] + w + cost < best):
                    best = done_f[to] + w + cost
                if cost + w < seen_b.get(to, cost + w + 1):
                    seen_b[to] = cost + w
                    heappush(heap_b, (cost + w) * size + (n - j) * 4 + p)
        else:
            cost, node = divmod(heappop(heap_f), size)
            if node in done_f:
                continue
            done_f[node] = cost
            if node in done_b and (best is None or cost + done_b[node] < best):
                best = cost + done_b[node]
            for _, w, j, p in _edges(rows, node // 4, node % 4):
                to = j * 4 + p
                if to in done_b and (best is None or cost + w + done_b[to] < best):
                    best = cost + w + done_b[to]
                if cost + w < seen_f.get(to, cost + w + 1):
                    seen_f[to] = cost + w
                    heappush(heap_f, (cost + w) * size + to)
    return None if best is None else (best, _least_audit(rows, start, ends, best, done_f, done_b))


def _least_audit(rows, start, ends, best, done_f, done_b) -> str:
    """Least concatenation of a forward and a reverse part over all crossings of cost ``best``."""
    crossings = [
        u
        for u, cost in done_f.items()
        if any(cost + w + done_b.get(j * 4 + p, best + 1) == best for _, w, j, p in _edges(rows, u // 4, u % 4))
    ]
    ahead = set(crossings)  # nodes of the forward part of a cheapest path
    while crossings:
        u = crossings.pop()
        for w, j, p in _edges_into(rows, u // 4, u % 4):
            v = j * 4 + p
            if v not in ahead and done_f.get(v, best + 1) + w == done_f[u]:
                ahead.add(v)
                crossings.append(v)
    audit: list[str] = []
    node, crossed = start, done_b.get(start) == best
    goals = {len(rows) * 4 + e for e in ends}
    while not (crossed and node in goals and done_b[node] == 0):
        for letter, w, j, p in _edges(rows, node // 4, node % 4):
            to = j * 4 + p
            if crossed:
                if done_b.get(to, best + 1) + w == done_b[node]:
                    break
            elif done_f[node] + w + done_b.get(to, best + 1) == best:
                crossed = True
                break
            elif to in ahead and done_f[node] + w == done_f[to]:
                break
        audit.append(letter)
        node = to
    return "".join(audit)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, by crc32 of ``conv_id:turn`` modulo 20; null fields: one space.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it a user's.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = rows.where("fault <> 0").select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies)
    return rows.select("conv_id", "turn", "role", "text")


def _steps(conversations: DataFrame) -> DataFrame:
    """Distinct rows of each conversation with their faults and how often they stand there."""
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("bigint"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    rows = rows.withColumn("mark", F.unhex(F.md5(F.col("text").cast("binary"))))
    rows = rows.groupBy("conv_id", "turn", "role", "mark").agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    rows = stored(rows, "turns")
    # Null turns come first, so the least known turn is the first place only where no turn is null.
    place = F.coalesce("turn", F.lit(-(2**63)))
    first = rows.groupBy("conv_id", "role", "mark").agg(F.min(place).alias("first_place"))
    first = first.select(F.col("conv_id").alias("of"), F.col("role").alias("of_role"), F.col("mark").alias("of_mark"), "first_place")
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("of_role")) & (F.col("mark") == F.col("of_mark"))
    ended = F.rtrim(F.col("text"), F.lit(_BLANKS))
    steps = rows.join(first, same).select(
        "conv_id",
        "turn",
        "role",
        "mark",
        "copies",
        "text",
        (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("truncated"),
        (place != F.col("first_place")).alias("seen"),
    )
    return stored(steps, "steps")


_LEGAL = {"su", "ua", "au"}
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


class _Segment:
    """Rows of one conversation that a task has walked, without their texts."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.rows: list[Row] = []
        self.n = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = None  # (initial, turn)
        self.low = self.high = None

    def add(self, turn, initial, copies, blank, truncated, seen):
        here = (initial, turn)
        if self.last is not None and self.last[0] + initial not in _LEGAL:
            self.n["illegal"] += 1
        self.n["illegal"] += copies - 1
        if turn is not None:
            self.n["turns"] += self.last is None or self.last[1] != turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        fresh = 0 if seen else 1
        self.n["blank"] += copies if blank else 0
        self.n["duplicate"] += 0 if blank else copies - fresh
        self.n["truncated"] += 1 if fresh and truncated and not blank else 0
        if fresh and not blank:
            self.rows.append((initial, False, truncated))
        self.rows.extend([(initial, True, False)] * (copies if blank else copies - fresh))
        self.first = self.first or here
        self.last = here

    def out(self, part, seq, whole):
        pairs = [(_NONE, None, _ENDS)] if whole else [(a, b, (b,)) for a in range(4) for b in range(4)]
        paths = [
            {"start": a, "stop": b, "cost": found[0], "audit": found[1]}
            for a, b, ends in pairs
            if (found := cheapest(self.rows, a, ends)) is not None
        ]
        return (self.conv_id, part, seq, whole, paths, *self.first, *self.last, self.low, self.high, *self.n.values())


_PATHS = "array<struct<start:int,stop:int,cost:bigint,audit:string>>"
_SEGMENTS = (
    f"part int, seq int, whole boolean, paths {_PATHS}, first string, first_turn bigint, last string, last_turn bigint, "
    + "low bigint, high bigint, "
    + ", ".join(f"{c} bigint" for c in _COUNTS)
)


def _with_id(like: DataFrame, fields: str) -> T.StructType:
    return T.StructType([like.schema["conv_id"], *T._parse_datatype_string(fields).fields])


def _segments(steps: DataFrame, segment: int) -> DataFrame:
    out_type = _with_id(steps, _SEGMENTS)
    arrow = to_arrow_schema(out_type)

    def walk(batches):
        part = TaskContext.get().partitionId()

        def rows():
            now, seq, inner = None, 0, False  # inner: the conversation surely begins here
            for batch in batches:
                for conv_id, turn, _, _, *rest in zip(*[c.to_pylist() for c in batch.columns]):
                    if now is not None and now.conv_id != conv_id:
                        yield now.out(part, seq, inner)
                        now, seq, inner = None, seq + 1, True
                    elif now is not None and len(now.rows) >= segment:
                        yield now.out(part, seq, False)
                        now, seq, inner = None, seq + 1, False
                    now = now or _Segment(conv_id)
                    now.add(turn, *rest)
            if now is not None:
                yield now.out(part, seq, False)

        yield from _batches(rows(), arrow)

    # Longer runs of one row are cut too, so no segment grows with the copies of a row.
    runs = F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(segment).cast("bigint")))
    rows = steps.withColumn("run", runs).select(
        "conv_id",
        "turn",
        "role",
        "mark",
        F.substring("role", 1, 1).alias("initial"),
        F.least(F.col("copies") - F.col("run"), F.lit(segment)).alias("copies"),
        "blank",
        "truncated",
        (F.col("seen") | (F.col("run") > 0)).alias("seen"),
    )
    order = ["conv_id", "turn", "role", "mark", "seen"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("run").mapInArrow(walk, out_type)


def _extended(told: dict, paths, whole: bool) -> dict:
    """Cheapest way to each state after one more segment."""
    if whole:
        return {_ASSISTANT: (paths[0]["cost"], paths[0]["audit"])}
    out: dict[int, tuple[int, str]] = {}
    for p in paths:
        if p["start"] in told:
            cost, audit = told[p["start"]]
            way = (cost + p["cost"], audit + p["audit"])
            out[p["stop"]] = min(way, out.get(p["stop"], way))
    return out


def _solved(segments: DataFrame) -> DataFrame:
    """One row per conversation from its segments in order."""
    out_type = _with_id(segments, "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")
    arrow = to_arrow_schema(out_type)
    names = [f.name for f in segments.schema.fields]

    def put_together(batches):
        def rows():
            now = None

            def done():
                cost, audit = min(now["ways"][e] for e in _ENDS if e in now["ways"])
                gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
                return (now["conv_id"], gaps, *[now[c] for c in _COUNTS[:4]], cost, audit)

            for batch in batches:
                for row in zip(*[c.to_pylist() for c in batch.columns]):
                    s = dict(zip(names, row))
                    if now is not None and now["conv_id"] != s["conv_id"]:
                        yield done()
                        now = None
                    if now is None:
                        now = {**s, "ways": _extended({_NONE: (0, "")}, s["paths"], s["whole"])}
                        continue
                    for c in _COUNTS:
                        now[c] += s[c]
                    now["illegal"] += now["last"] + s["first"] not in _LEGAL
                    now["turns"] -= s["first_turn"] is not None and now["last_turn"] == s["first_turn"]
                    now["low"] = s["low"] if now["low"] is None else now["low"]
                    now["high"] = now["high"] if s["high"] is None else s["high"]
                    now["last"], now["last_turn"] = s["last"], s["last_turn"]
                    now["ways"] = _extended(now["ways"], s["paths"], False)
            if now is not None:
                yield done()

        yield from _batches(rows(), arrow)

    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(put_together, out_type)


def _turns_after(steps: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): rows stream past their conversation's audit."""
    out_type = _with_id(steps, "repaired_sha256 string")
    arrow = to_arrow_schema(out_type)

    def replay(batches):
        def rows():
            conv_id = audit = None
            at = state = 0
            first, digest = True, None

            def give(role, text):
                nonlocal first
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8"))
                first = False

            def inserted():
                nonlocal at, state
                while audit[at : at + 1] == "I":
                    state = _then(state)
                    give("user" if state == _USER else "assistant", "")
                    at += 1

            for batch in batches:
                for this, turn, role, mark, copies, text, told in zip(*[c.to_pylist() for c in batch.columns]):
                    if told is not None:  # sorts before the rows
                        if digest is not None:
                            inserted()
                            yield conv_id, digest.hexdigest()
                        conv_id, audit, at, state, first, digest = this, told, 0, _NONE, True, hashlib.sha256()
                        continue
                    for _ in range(copies):
                        inserted()
                        edit = audit[at]
                        at += 1
                        if edit == "K":
                            state = _SYSTEM if role.startswith("s") else _then(state)
                            give(role, text)
                        elif edit == "R":
                            state = _then(state)
                            give("user" if state == _USER else "assistant", text)
            if digest is not None:
                inserted()
                yield conv_id, digest.hexdigest()

        yield from _batches(rows(), arrow)

    rows = steps.select("conv_id", "turn", "role", "mark", "copies", "text", F.lit(None).cast("string").alias("audit"))
    heads = solved.select("conv_id", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "mark", "copies", "text")], "audit")
    order = ["conv_id", F.col("audit").isNull(), "turn", "role", "mark"]
    return heads.unionAll(rows).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(replay, out_type)


def repair_turns(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation.

    Rows go by turn, null turns first, rows of one turn by role and text hash.
    Null roles and texts count as one space; a role whose first character is not
    s, u or a, or an empty one, can only be changed or deleted. Null conv_ids
    form one conversation. Repeated rows are rows, the later ones duplicates. An
    empty table gives no rows; other columns, whatever their names, are ignored.
    """
    steps = _steps(conversations)
    solved = stored(_solved(stored(_segments(steps, segment), "segments")), "solved")
    digests = _turns_after(steps, solved).withColumnRenamed("conv_id", "of")
    return solved.join(digests, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair_turns`` of the damaged table, with every original conv_id, also those that lost all rows."""
    told = repair_turns(damage(conversations)).withColumnRenamed("conv_id", "of")
    every = conversations.select("conv_id").distinct()
    out = every.join(told, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return out.select("conv_id", *[F.coalesce(c, F.lit(empty.get(c, 0))).alias(c) for c in out.columns[1:]])


SQL = r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
-- crc32 bit by bit: every byte, then eight steps marked -1
marked AS (
  SELECT *, (4294967295 - CAST(list_reduce(
      flatten(list_transform(string_split(k, ''), lambda x: [ord(x), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda v, b: CASE WHEN b >= 0 THEN xor(v, CAST(b AS BIGINT)) ELSE xor(v >> 1, 3988292384 * (v & 1)) END,
      CAST(4294967295 AS BIGINT)) AS BIGINT)) % 20 AS fault FROM given),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM marked WHERE fault <> 0),
numbered AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)),
faults AS (
  SELECT *, left(role, 1) AS ini, tail = '' AS is_blank, tail <> '' AND seen AS is_dup,
         tail <> '' AND NOT seen AND tail NOT IN ('.', '!', '?') AS is_cut
  FROM numbered),
told AS (
  SELECT conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE is_blank) AS blank,
         count(*) FILTER (WHERE is_dup) AS duplicate, count(*) FILTER (WHERE is_cut) AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND left(before, 1) || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
-- states: 0 nothing, 1 system, 2 user, 3 assistant given last; up to two insertions before each row and at the end
ways(conv_id, i, st, way) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, {'cost': CAST(0 AS BIGINT), 'audit': '', 'done': ''} FROM told
  UNION ALL
  SELECT conv_id, i, st, min(way) FROM (
    SELECT w.conv_id, f.i, a.st, {'cost': w.cost + a.cost, 'audit': w.audit || a.letter,
           'done': w.done || CASE a.letter WHEN 'D' THEN '' ELSE chr(10) || CASE a.letter WHEN 'K' THEN f.role ELSE CASE a.st WHEN 2 THEN 'user' ELSE 'assistant' END END || ':' || f.text END} AS way
    FROM (
      SELECT conv_id, i, CASE k WHEN 0 THEN st WHEN 1 THEN n1 ELSE 5 - n1 END AS st, way.cost + 2 * k AS cost, way.audit || repeat('I', k) AS audit,
             way.done || CASE WHEN k > 0 THEN chr(10) || CASE n1 WHEN 2 THEN 'user:' ELSE 'assistant:' END ELSE '' END
               || CASE WHEN k > 1 THEN chr(10) || CASE n1 WHEN 3 THEN 'user:' ELSE 'assistant:' END ELSE '' END AS done
      FROM (SELECT *, CASE WHEN st = 2 THEN 3 ELSE 2 END AS n1, unnest([0, 1, 2]) AS k FROM ways)) w
    JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1,
    LATERAL (
      SELECT 'D' AS letter, 3 AS cost, w.st AS st
      UNION ALL SELECT 'K', CAST(f.is_cut AS INTEGER), CASE f.ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
        WHERE NOT f.is_blank AND NOT f.is_dup AND (f.ini = 's' AND w.st = 0 OR f.ini = 'u' AND w.st <> 2 OR f.ini = 'a' AND w.st = 2)
      UNION ALL SELECT 'R', 2 + CAST(f.is_cut AS INTEGER), CASE WHEN w.st = 2 THEN 3 ELSE 2 END WHERE NOT f.is_blank AND NOT f.is_dup) a)
  GROUP BY conv_id, i, st),
ends AS (
  SELECT w.conv_id, min({'cost': way.cost + 2 * k, 'audit': way.audit || repeat('I', k),
         'done': way.done || CASE WHEN k > 0 THEN chr(10) || CASE n1 WHEN 2 THEN 'user:' ELSE 'assistant:' END ELSE '' END
               || CASE WHEN k > 1 THEN chr(10) || CASE n1 WHEN 3 THEN 'user:' ELSE 'assistant:' END ELSE '' END}) AS way
  FROM (SELECT *, CASE WHEN st = 2 THEN 3 ELSE 2 END AS n1, unnest([0, 1, 2]) AS k FROM ways) w
  JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.i
  WHERE CASE k WHEN 0 THEN st WHEN 1 THEN n1 ELSE 5 - n1 END IN (0, 3) GROUP BY w.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.way.cost, 0) AS cost,
       coalesce(e.way.audit, '') AS audit, sha256(coalesce(substr(e.way.done, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
