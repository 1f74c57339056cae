"""Repair of turn order in conversations at least cost.

A conversation's rows and the states of the role grammar span a graph: a node is
(rows read, state), an arc is one edit. Minimum costs from the start (forward) and
to the end (backward) tell which arcs lie on some cheapest path: those with
forward + cost + backward = total, the tight arcs. They form an acyclic graph,
and walking it with the set of nodes reached so far, taking the least letter at each
step, spells the least of all cheapest edit strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pressline.llm.words import arrow_map

WHITE, STOPS = " \t\n\x0b\f\r", ".!?"
#: State after a role initial; (s?(ua)+)? accepts in "start" and in "pair".
STEP = {("start", "s"): "system", ("start", "u"): "user", ("system", "u"): "user", ("user", "a"): "pair", ("pair", "u"): "user"}
STATES, ACCEPT, LEGAL = ("start", "system", "user", "pair"), ("start", "pair"), ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5


@dataclass
class Row:
    turn: int | None
    role: str
    text: str
    fault: str = ""


@dataclass
class Repair:
    cost: int
    audit: str
    rows: list[tuple[str, str]]


def find_faults(rows: list[Row]) -> None:
    """Mark each row with its first fault: blank, duplicate, truncated."""
    seen = set()
    for row in rows:
        text, said = row.text.rstrip(WHITE), (row.role, row.text)
        row.fault = "blank" if not text else "duplicate" if said in seen else "truncated" if text[-1] not in STOPS else ""
        seen.add(said)


def row_arcs(row: Row, state: str) -> Iterator[tuple[str, int, str, str]]:
    """(letter, cost, next state, role) of the edits that read one row."""
    yield "D", DELETE, state, ""
    if row.fault in ("blank", "duplicate"):
        return
    extra = TRUNCATED if row.fault == "truncated" else 0
    if (state, row.role[:1]) in STEP:
        yield "K", KEEP + extra, STEP[state, row.role[:1]], row.role
    for initial, role in ROLES.items():
        if (state, initial) in STEP:
            yield "R", REROLE + extra, STEP[state, initial], role


def insert_arcs(state: str) -> Iterator[tuple[str, int, str, str]]:
    for initial, role in ROLES.items():
        if (state, initial) in STEP:
            yield "I", INSERT, STEP[state, initial], role


def _settle(costs: dict[str, int], backward: bool) -> dict[str, int]:
    """Costs with inserts before the next row (forward) or up to it (backward); as many rounds as states suffice."""
    for _ in STATES:
        for state in STATES:
            for _, cost, after, _ in insert_arcs(state):
                a, b = (after, state) if backward else (state, after)
                costs[b] = min(costs[b], costs[a] + cost)
    return costs


def repair(rows: list[Row]) -> Repair:
    """The cheapest edits of rows with faults marked; of equally cheap ones the least in ASCII order."""
    never = 1 << 60
    none = dict.fromkeys(STATES, never)
    forward = [_settle(none | {"start": 0}, False)]
    for row in rows:
        costs = dict(none)
        for state in STATES:
            for _, cost, after, _ in row_arcs(row, state):
                costs[after] = min(costs[after], forward[-1][state] + cost)
        forward.append(_settle(costs, False))
    backward = [_settle(none | dict.fromkeys(ACCEPT, 0), True)]
    for row in reversed(rows):
        costs = {s: min(cost + backward[-1][after] for _, cost, after, _ in row_arcs(row, s)) for s in STATES}
        backward.append(_settle(costs, True))
    backward.reverse()
    total = backward[0]["start"]

    def tight(node):
        at, state = node
        arcs = [(a, (at + 1, a[2]), at) for a in row_arcs(rows[at], state)] if at < len(rows) else []
        for (letter, cost, _, role), to, read in arcs + [(a, (at, a[2]), None) for a in insert_arcs(state)]:
            if forward[at][state] + cost + backward[to[0]][to[1]] == total:
                yield letter, to, (read, role)

    frontier, steps = {(0, "start")}, []
    while True:
        out = [(letter, to, node, edit) for node in frontier for letter, to, edit in tight(node)]
        if not out:
            break
        least = min(letter for letter, *_ in out)
        steps.append((least, {to: (node, edit) for letter, to, node, edit in out if letter == least}))
        frontier = set(steps[-1][1])
    kept, node = [], next(iter(frontier))
    for letter, came in reversed(steps):
        node, (read, role) = came[node]
        if letter != "D":
            kept.append((role, rows[read].text if read is not None else ""))
    return Repair(total, "".join(letter for letter, _ in steps), kept[::-1])


def damage(rows: DataFrame) -> DataFrame:
    """Test damage by crc32(conv_id:turn) % 20; rows that it drops stay as markers with dropped = true."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    copies = F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1))
    role = F.when(kind == 4, F.lit("user")).otherwise(blank("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), copies.alias("copies")).withColumn("copy", F.explode("copies")).drop("copies", "copy")


def _summary(rows: list[Row]) -> tuple:
    find_faults(rows)
    turns = {r.turn for r in rows} - {None}
    done = repair(rows)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a.role[:1] + b.role[:1] not in LEGAL for a, b in pairwise(rows))
    said = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in done.rows).encode()).hexdigest()
    faults = [sum(r.fault == f for r in rows) for f in ("blank", "duplicate", "truncated")]
    return gaps, *faults, illegal, done.cost, done.audit, said, len(done.rows)


def repair_conversations(rows: DataFrame, dropped: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, n_repaired.

    Rows go by turn, nulls first; equal turns by role, then text. `dropped` marks rows that only name
    their conversation; one that has no others gives zeros, an empty audit and the hash of nothing.
    Null roles and texts count as one space. Rows of a null conversation are one conversation; a
    repeated row is a duplicate; an empty table gives no rows. A role counts by its first character.
    Only the named columns are read, so others may have any name.

    Rows are shuffled and sorted by conversation and read as a stream, so a task holds one
    conversation at a time; its repaired text is hashed as one string and so passes through one task,
    whatever its length (as one output record of the chat format does).
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lean = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"), (F.lit(False) if dropped is None else dropped).alias("dropped"))
    lean = lean.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    counts = [StructField(c, LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    schema = StructType([StructField("conv_id", lean.schema["conv_id"].dataType), *counts, StructField("audit", StringType()), StructField("repaired_sha256", StringType()), StructField("n_repaired", LongType())])

    def run(batches):
        current, held = None, []
        for batch in batches:
            ids, done = batch.column("conv_id").to_pylist(), []
            rest = zip(*(batch.column(c).to_pylist() for c in ("turn", "role", "text", "dropped")))
            for conv, (turn, role, text, gone) in zip(ids, rest):
                if current is None or current[0] != conv:
                    if current is not None:
                        done.append((current[0], *_summary(held)))
                    current, held = (conv,), []
                if not gone:
                    held.append(Row(turn, role, text))
            yield from _record(done)
        if current is not None:
            yield from _record([(current[0], *_summary(held))])

    def _record(done):
        if done:
            kinds = [to_arrow_type(schema[0].dataType)] + [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=schema.names)

    return arrow_map(lean, run, schema)


# suffix costs from the last row back: of suffixes that start at one node the least string is the least first
# letter before the least rest. Then the letters are replayed. crc32 bit by bit, as the SQL has none.
REPAIR_SQL = r"""
with recursive keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
crc as (select *, xor(list_reduce(list_concat([4294967295::ubigint], list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::ubigint)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]), lambda x, z: xor(x >> 1, 3988292384::ubigint * (x & 1)))), 4294967295::ubigint) % 20 as k from keyed),
damaged as (select conv_id, turn, case when k = 4 then 'user' else role end as role, case k when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when k = 3 then 2 else 1 end)) as copy from crc where k <> 0),
numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, left(role, 1) as c from damaged),
r as (select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'b' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd' when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 't' else '' end as fault, lag(c) over (partition by conv_id order by i) || c as pair from numbered),
counted as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, count(*) as n from r group by conv_id),
back as (select conv_id, n + 1 as i, {'c': 0, 'a': ''} as z, {'c': 10, 'a': 'II'} as s, {'c': 5, 'a': 'I'} as u, {'c': 0, 'a': ''} as p from counted
 union all
 select conv_id, i, list_min([z, {'c': u1.c + 5, 'a': 'I' || u1.a}]), list_min([s, {'c': u1.c + 5, 'a': 'I' || u1.a}]), u1, list_min([p, {'c': u.c + 5, 'a': 'I' || u.a}])
 from (select *, list_min([u, {'c': p.c + 5, 'a': 'I' || p.a}]) as u1 from (
  select b.conv_id, r.i,
   list_min([{'c': z.c + 2, 'a': 'D' || z.a}, case when e >= 0 and c = 's' then {'c': s.c + e, 'a': 'K' || s.a} end, case when e >= 0 and c = 'u' then {'c': u.c + e, 'a': 'K' || u.a} end, case when e >= 0 then {'c': u.c + e + 1, 'a': 'R' || u.a} end]) as z,
   list_min([{'c': s.c + 2, 'a': 'D' || s.a}, case when e >= 0 and c = 'u' then {'c': u.c + e, 'a': 'K' || u.a} end, case when e >= 0 then {'c': u.c + e + 1, 'a': 'R' || u.a} end]) as s,
   list_min([{'c': u.c + 2, 'a': 'D' || u.a}, case when e >= 0 and c = 'a' then {'c': p.c + e, 'a': 'K' || p.a} end, case when e >= 0 then {'c': p.c + e + 1, 'a': 'R' || p.a} end]) as u,
   list_min([{'c': p.c + 2, 'a': 'D' || p.a}, case when e >= 0 and c = 'u' then {'c': u.c + e, 'a': 'K' || u.a} end, case when e >= 0 then {'c': u.c + e + 1, 'a': 'R' || u.a} end]) as p
  from back b join (select *, case fault when 't' then 5 when '' then 0 else -1 end as e from r) r on r.conv_id is not distinct from b.conv_id and r.i = b.i - 1) as one) as two),
best as (select conv_id, z.c as cost, z.a as audit from back where i = 1),
replay as (select conv_id, audit, 0 as k, 0::bigint as i, 'z' as state, []::varchar[] as said from best
 union all
 select q.conv_id, audit, k + 1, q.i + (letter <> 'I')::bigint,
  case when letter = 'D' then state when letter = 'K' then case c when 'a' then 'p' else c end when state = 'u' then 'p' else 'u' end,
  case letter when 'D' then said when 'K' then list_append(said, role || ':' || text) else list_append(said, case state when 'u' then 'assistant' else 'user' end || ':' || case letter when 'I' then '' else text end) end
 from (select *, substr(audit, k + 1, 1) as letter from replay where k < length(audit)) q left join r on r.conv_id is not distinct from q.conv_id and r.i = q.i + 1),
told as (select conv_id, sha256(array_to_string(said, chr(10))) as repaired_sha256, len(said) as n_repaired from replay where k = length(audit))
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
 coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256, coalesce(n_repaired, 0)::bigint as n_repaired
from (select distinct conv_id from conversations) o left join counted on counted.conv_id is not distinct from o.conv_id left join best on best.conv_id is not distinct from o.conv_id left join told on told.conv_id is not distinct from o.conv_id
"""
