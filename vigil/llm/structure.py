"""Conversation structure repair by a square-root checkpointed dynamic programme.

A row's faults are judged in the order of its conversation: blank, duplicate (its
role and text stood before), truncated (its last visible character ends no
sentence). Edits make the role initials fit ``(s?(ua)+)?``: Keep costs nothing,
Rerole to user or assistant 3, Delete 4 (required for blank and duplicate rows),
Insert of an empty user or assistant turn 3, and a truncated row that stays 3.

The states of the programme are what stands last: nothing, s, u or a. From the
last row back to the first, the cost vector of the four states is made but
kept only at every sqrt(n)-th row. Walking forward, the vectors of one block
at a time are made anew from its checkpoint, and at each state the ASCII-least
edit that is tight (its cost and the cost behind it give the state's cost) is
emitted. Every edit leads from a state to one state, so the letters taken one by
one give the ASCII-least of the cheapest audits. A conversation of n rows needs
n bytes and the vectors of 2 sqrt(n) rows, no texts.

Duplicates are found where rows of equal conversation, role and text meet; what
goes to a conversation's task is a code of its rows. The texts meet the audit in
a second pass, where they stream by in order and none is held.

Defined results: turns are in ascending order, null first, rows of one turn by
the MD5 of role and text. Nulls in role and text are one space; a null conv_id
is a conversation of its own. Rows that ``dropped`` marks are not there, but their
conversations are. Without rows all counts are 0 and the audit is empty. Repeated
rows are duplicates. An empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.text import written

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NOTHING, S, U, A = range(4)  # states: what stands last; initials of rows: S, U, A or NOTHING for any other
BLANK, DUPLICATE, CUT = 1, 2, 3
INSERTED = (U, U, A, U)      # the only turn that may follow a state, but for a first s
FAR = 1 << 60
ROLE = {U: "user", A: "assistant"}
AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
WORD = r"[^\x20\x09-\x0D]"


def filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(convs: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and dropped of the rows after damage by crc32 of conv_id:turn."""
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    role, text = filled("role"), filled("text")
    rows = convs.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "copy")


def _keyed(rows: DataFrame) -> DataFrame:
    role, text = filled("role"), filled("text")
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       role.alias("role"), text.alias("text"), digest.alias("digest"), dropped.alias("dropped"))


def _ordered(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *keys)


def codes(rows: DataFrame) -> DataFrame:
    """conv_id, turn, digest, again (its role and text stood before) and code (4 * fault + initial; null for a dropped row) of every row."""
    initial = F.substring("role", 1, 1)
    start = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(NOTHING)
    blank = ~F.col("text").rlike(WORD)
    cut = ~F.btrim("text", F.lit(" \t\n\x0b\x0c\r")).rlike(r"[.!?]\z")
    keyed = _keyed(rows).select("conv_id", "turn", "digest", "dropped", start.alias("start"), blank.alias("blank"), cut.alias("cut"))
    keyed = keyed.withColumn("again", F.row_number().over(Window.partitionBy("conv_id", "digest", "dropped").orderBy("turn")) > 1)
    fault = F.when(F.col("blank"), BLANK).when(F.col("again"), DUPLICATE).when(F.col("cut"), CUT).otherwise(0)
    return keyed.select("conv_id", "turn", "digest", "again", F.when(~F.col("dropped"), 4 * fault + F.col("start")).alias("code"))


def _before(after: list[int], code: int) -> list[int]:
    """Cost vector before a row from that behind it."""
    fault, initial = divmod(code, 4)
    n, s, u, a = (DELETE + c for c in after)
    if fault not in (BLANK, DUPLICATE):
        rest = TRUNCATED if fault == CUT else 0
        to_u, to_a = after[U] + rest + (0 if initial == U else REROLE), after[A] + rest + (0 if initial == A else REROLE)
        n, s, u, a = min(n, to_u), min(s, to_u), min(u, to_a), min(a, to_u)
        if initial == S:
            n = min(n, after[S] + rest)
    return _inserted(n, s, u, a)


def _inserted(n: int, s: int, u: int, a: int) -> list[int]:
    """The cost vector when turns may be inserted, too."""
    u, a = min(u, a + INSERT), min(a, u + INSERT)
    return [min(n, u + INSERT), min(s, u + INSERT), u, a]


END = _inserted(0, FAR, FAR, 0)


def edits(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a conversation."""
    n = len(codes)
    step = isqrt(n) + 1
    kept, vector = {}, END
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0:
            kept[i + 1] = vector
        vector = _before(vector, codes[i])
    cost, state, audit = vector[NOTHING], NOTHING, []
    for lo in range(0, max(n, 1), step):
        hi = min(lo + step, n)
        vectors = [kept.get(hi, END)]
        for i in range(hi - 1, lo - 1, -1):
            vectors.append(_before(vectors[-1], codes[i]))
        vectors.reverse()
        for i in range(lo, hi):
            here, after = vectors[i - lo], vectors[i - lo + 1]
            fault, initial = divmod(codes[i], 4)
            while True:
                next_ = INSERTED[state]
                if DELETE + after[state] == here[state]:
                    audit.append("D")
                    break
                if INSERT + here[next_] == here[state]:
                    audit.append("I")
                    state = next_
                    continue
                rest = TRUNCATED if fault == CUT else 0
                kept_as = initial if initial == next_ or initial == S and state == NOTHING else None
                if kept_as is not None and rest + after[kept_as] == here[state]:
                    audit.append("K")
                    state = kept_as
                else:
                    audit.append("R")
                    state = next_
                break
    while state not in (NOTHING, A):
        audit.append("I")
        state = INSERTED[state]
    return cost, "".join(audit)


def _audit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in AUDIT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()]
    out: list[tuple] = []
    now: object = None
    started = False
    row, first, last, distinct, illegal, before = bytearray(), None, None, 0, 0, None

    def finish() -> None:
        fault = [sum(row.count(4 * k + s) for s in range(4)) for k in (BLANK, DUPLICATE, CUT)]
        out.append((now, last - first + 1 - distinct if distinct else 0, *fault, illegal, *edits(bytes(row))))

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for batch in batches:
        for conv_id, turn, code in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "code"))):
            if not started or conv_id != now:
                if started:
                    finish()
                    if len(out) >= 2000:
                        yield batch_of()
                        out.clear()
                now, started = conv_id, True
                row, first, last, distinct, illegal, before = bytearray(), None, None, 0, 0, None
            if code is None:
                continue
            if turn is not None and turn != last:
                first, last, distinct = turn if first is None else first, turn, distinct + 1
            initial = code % 4
            if before is not None:
                illegal += (before, initial) not in ((S, U), (U, A), (A, U))
            before = initial
            row.append(code)
    if started:
        finish()
        yield batch_of()


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation."""
    return _ordered(codes(rows), "turn", "digest", "again").select("conv_id", "turn", "code").mapInArrow(_audit_batches, AUDIT)


REPAIRED = "conv_id long, place long, role string, text string"


def _repaired_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = [c.split()[0] for c in REPAIRED.split(", ")], [pa.int64(), pa.int64(), pa.string(), pa.string()]
    out: list[tuple] = []
    now, state, place, at, audit = None, NOTHING, 0, 0, ""

    def emit(role: str, text: str) -> None:
        nonlocal place
        out.append((now, place, role, text))
        place += 1

    def inserts() -> None:
        nonlocal at, state
        while audit[at: at + 1] == "I":
            state, at = INSERTED[state], at + 1
            emit(ROLE[state], "")

    def batch_of() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        out.clear()
        return made

    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            for conv_id, edited, role, text in zip(*(batch.slice(lo, 512)[c].to_pylist() for c in ("conv_id", "edited", "role", "text"))):
                if edited is not None:  # stands before the rows of its conversation
                    now, state, place, at, audit = conv_id, NOTHING, 0, 0, edited
                    inserts()
                    continue
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = S if state == NOTHING and role[:1] == "s" else INSERTED[state]
                    emit(role, text)
                elif edit == "R":
                    state = INSERTED[state]
                    emit(ROLE[state], text)
                inserts()
            if out:
                yield batch_of()


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, place, role and text of all turns after repair; a conversation's turns follow each other in a partition."""
    texts = _keyed(rows).where("not dropped").withColumn("edited", F.lit(None).cast("string"))
    columns = ["conv_id", "edited", "turn", "digest", "role", "text"]
    none = [F.lit(None).cast(k).alias(c) for c, k in (("turn", "long"), ("digest", "binary"), ("role", "string"), ("text", "string"))]
    both = texts.select(columns).union(audits.select("conv_id", F.col("audit").alias("edited"), *none))
    # the audit comes first: false sorts before true
    return (_ordered(both.withColumn("row", F.col("edited").isNull()), "row", "turn", "digest").select("conv_id", "edited", "role", "text")
            .mapInArrow(_repaired_batches, REPAIRED))


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    now, seen = None, None
    for batch in batches:
        for conv_id, place, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "place", "role", "text"))):
            if place == 0:
                if seen:
                    out.append((now, seen.hexdigest()))
                now, seen = conv_id, hashlib.sha256(f"{role}:{text}".encode())
            else:
                seen.update(f"\n{role}:{text}".encode())
    if seen:
        out.append((now, seen.hexdigest()))
    for lo in range(0, len(out), 10_000):
        c, h = zip(*out[lo: lo + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(h, pa.string())], ["c", "h"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = written(audits(rows), "audits")
    hashes = repaired(rows, found).mapInArrow(_hash_batches, "c long, h string")
    both = found.join(hashes, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return both.select(*found.columns, F.coalesce("h", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _sql_edit(state: int, cost: str, letter: str) -> str:
    """SQL of what an edit makes of the state's string in the list t: its cost in eight digits and its audit."""
    return f"printf('%08d', substr(t[{state + 1}], 1, 8)::bigint + {cost}) || substr(t[{state + 1}], 9) || '{letter}'"


def _sql_row() -> str:
    """SQL of the states behind a row of code x."""
    rest = "(x // 4 = 3)::int * 3"

    def stays(state: int, to: int, letters: str = "KR") -> list[str]:
        return [f"CASE WHEN x // 4 NOT IN (1, 2) AND x % 4 {'=' if k == 'K' else '<>'} {to} THEN {_sql_edit(state, rest if k == 'K' else f'3 + {rest}', k)} END" for k in letters]

    ways = {NOTHING: [], S: stays(NOTHING, S, "K"), U: [*stays(NOTHING, U), *stays(S, U), *stays(A, U)], A: stays(U, A)}
    return "[" + ", ".join(f"least({', '.join([_sql_edit(q, '4', 'D'), *ways[q]])})" for q in range(4)) + "]"


_SQL_INSERT = f"[t[1], t[2], least(t[3], {', '.join(_sql_edit(q, '3', 'I') for q in (NOTHING, S, A))}), least(t[4], {_sql_edit(U, '3', 'I')})]"


def _sql_let(value: str, of: str) -> str:
    return f"list_transform([{value}], lambda t: {of})[1]"


def _sql_inserted(value: str) -> str:
    return _sql_let(_sql_let(value, _SQL_INSERT), _SQL_INSERT)


_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(id, ''), lambda c: ascii(c)::bigint)),
  lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))), 4294967295)"""
#: the programme forward over strings of cost and audit: the least string is the cheapest and then ASCII-least one
ORACLE = rf"""
WITH z AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS id FROM conversations),
k AS (SELECT *, {_CRC} % 20 AS k FROM z),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM k, range(2) c(i) WHERE k <> 0 AND (k = 3 OR i = 0)),
m AS (SELECT *, md5(length(role) || ':' || role || text) AS digest FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, digest ORDER BY turn NULLS FIRST) > 1 AS again FROM m),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, again) AS place,
  CASE substr(role, 1, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS initial FROM n),
g AS (SELECT *, CASE WHEN NOT regexp_matches(text, '{WORD}') THEN 1 WHEN again THEN 2
  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault FROM f),
l AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM g),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank,
  count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated,
  count(*) FILTER (WHERE before IS NOT NULL AND (before, initial) NOT IN ((1, 2), (2, 3), (3, 2))) AS illegal,
  list([(4 * fault + initial)::varchar] ORDER BY place) AS codes, list(role ORDER BY place) AS roles, list(text ORDER BY place) AS texts FROM l GROUP BY conv_id),
e AS (SELECT *, list_reduce(list_prepend(['00000000', '09000000', '09000000', '09000000'], codes),
  lambda s, y: list_transform([y[1]::int], lambda x: {_sql_let(_sql_inserted("s"), _sql_row())})[1]) AS ends FROM c),
b AS (SELECT *, list_transform([{_sql_inserted("ends")}], lambda t: least(t[1], t[4]))[1] AS best FROM e),
a AS (SELECT *, substr(best, 1, 8)::bigint AS cost, substr(best, 9) AS audit,
  regexp_matches(substr(best, 9), '^D*K') AND substr(roles[length(regexp_extract(substr(best, 9), '^D*')) + 1], 1, 1) = 's' AS first_s FROM b),
o AS (SELECT *, list_transform(list_filter(range(1, length(audit) + 1), lambda j: audit[j] <> 'D'), lambda j:
  CASE WHEN audit[j] = 'K' THEN roles[length(replace(audit[1:j], 'I', ''))]
    WHEN (length(replace(audit[1:j], 'D', '')) + first_s::int) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
  CASE WHEN audit[j] = 'I' THEN '' ELSE texts[length(replace(audit[1:j], 'I', ''))] END) AS lines FROM a)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM i.conv_id
"""
