"""Repair of conversations whose turns do not follow the grammar ``(s?(ua)+)?`` of role initials.

Every conversation is aligned (Wagner-Fischer) to the grammar's string of each feasible
length. Keeping a turn is free, giving it another role, deleting it and inserting a turn cost
something, and so does keeping a truncated turn. Each alignment is confined to a band of
diagonals (Ukkonen): a path that leaves it costs more than the best alignment so far. Of the
cheapest alignments the one with the smallest audit wins.

Texts stay out of the alignment: Spark finds every turn's fault first, and only its initial, its
fault and its place are sorted by conversation. The audits then head a second pass over the
turns in the same order, in which the repaired text is hashed as it streams by. A task holds
one conversation's codes, one byte a turn, and its audit, never its texts.

A conversation of more than ``SEGMENT`` turns is aligned piece by piece from its end. A piece is
aligned to each feasible target between two states of the grammar, and what follows from either
state is known by then, so the result is the same as in one piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Prices of the edits, and the fee of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED_FEE = 3, 4, 3, 3
#: Turns that are aligned at once.
SEGMENT = 16
#: What counts as white space within a turn.
BLANKS = " \t\n\x0b\f\r"
#: First faults of a turn.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

_INFINITE = 1 << 60
#: States of the grammar by the last initial given out: none, s, u, a.
_START, _S, _U, _A = range(4)
_ENDS = {_START: 0, _A: 0}


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` as the test damages them, by a hash of conversation and turn.

    NULLs, in the hashed text too, are one space. One row in twenty each is dropped, emptied,
    stripped of its sentence ends, repeated beside itself, or given to the user.
    """
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = known("text")
    marked = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(known("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0))).alias("_copies"))
    return marked.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")


def _code(initial: Column, fault: Column) -> Column:
    """One small number for a turn's initial (s, u, a, other) and fault."""
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    return (kind * 4 + fault).cast("int")


def align(initials: list[int], fees: list[int], forced: list[bool], target: list[int],
          limit: int) -> tuple[int, str] | None:
    """Cheapest alignment of turns to the ``target`` states, with its smallest audit.

    ``None`` if it costs more than ``limit``. Only cells on diagonals that a path of that
    cost can reach are filled in.
    """
    m, n = len(initials), len(target)
    apart = n - m

    def least(k: int) -> int:
        return INSERT * k if k > 0 else -DELETE * k

    low = min(0, apart)
    while least(low - 1) + least(apart - low + 1) <= limit:
        low -= 1
    high = max(0, apart)
    while least(high + 1) + least(apart - high - 1) <= limit:
        high += 1
    width = n + 2
    cost = [[_INFINITE] * width for _ in range(m + 2)]
    cost[m][n] = 0
    for i in range(m, -1, -1):
        row, below = cost[i], cost[i + 1]
        for j in range(min(n, i + high), max(0, i + low) - 1, -1):
            best = row[j] if i == m and j == n else _INFINITE
            if i < m:
                best = min(best, DELETE + below[j])
            if j < n:
                want = target[j]
                if want != _S:
                    best = min(best, INSERT + row[j + 1])
                if i < m and not forced[i]:
                    if initials[i] == want:
                        best = min(best, fees[i] + below[j + 1])
                    elif want != _S:
                        best = min(best, REROLE + fees[i] + below[j + 1])
            row[j] = best
    if cost[0][0] > limit:
        return None
    audit, i, j = [], 0, 0
    # The smallest letter that still leads to the end at that price: D, I, K, R.
    while i < m or j < n:
        here = cost[i][j]
        if i < m and DELETE + cost[i + 1][j] == here:
            audit.append("D")
            i += 1
        elif j < n and target[j] != _S and INSERT + cost[i][j + 1] == here:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if initials[i] == target[j] else "R")
            i, j = i + 1, j + 1
    return cost[0][0], "".join(audit)


def _targets(state: int, length: int) -> list[tuple[list[int], int]]:
    """Strings of the grammar of one length that may follow ``state``, with the state they reach."""
    if length == 0:
        return [([], state)]
    found = []
    for head in ([], [_S]) if state == _START else ([],):
        tail = length - len(head)
        first = _A if state == _U else _U
        other = _U + _A - first
        body = [first if k % 2 == 0 else other for k in range(tail)]
        whole = head + body
        found.append((whole, whole[-1]))
    return found


def _best_from(state: int, initials: list[int], fees: list[int], forced: list[bool],
               after: dict[int, tuple[int, str]]) -> tuple[int, str] | None:
    """Cheapest repair of a piece and all behind it, from a state of the grammar.

    Lengths are tried outwards from the number of turns that may stay, until no longer or
    shorter one can be as cheap as the incumbent.
    """
    free = len(initials) - sum(forced)
    least_after = min(c for c, _ in after.values())
    base = DELETE * (len(initials) - free)
    best: tuple[int, str] | None = None
    step = 0
    while True:
        lengths = [(free + step, base + INSERT * step)]
        if 0 < step <= free:
            lengths.append((free - step, base + DELETE * step))
        lengths = [(n, bound) for n, bound in lengths
                   if best is None or bound + least_after <= best[0]]
        if not lengths:
            return best
        for n, bound in lengths:
            for target, end in _targets(state, n):
                if end not in after:
                    continue
                behind, rest = after[end]
                # Nothing is dearer than all turns deleted, but for a system turn, and the rest inserted.
                limit = (best[0] - behind if best is not None
                         else DELETE * len(initials) + INSERT * n + TRUNCATED_FEE)
                if bound > limit:
                    continue
                found = align(initials, fees, forced, target, limit)
                if found is not None:
                    candidate = (found[0] + behind, found[1] + rest)
                    if best is None or candidate < best:
                        best = candidate
        step += 1


def repair(codes: bytes) -> tuple[int, str]:
    """Cost and audit for the codes of a conversation's turns, in order."""
    after: dict[int, tuple[int, str]] = {s: (c, "") for s, c in _ENDS.items()}
    for start in reversed(range(0, len(codes), SEGMENT)):
        piece = codes[start:start + SEGMENT]
        initials = [c // 4 for c in piece]
        fees = [TRUNCATED_FEE if c % 4 == TRUNCATED else 0 for c in piece]
        forced = [c % 4 in (BLANK, DUPLICATE) for c in piece]
        states = (_START,) if start == 0 else (_START, _S, _U, _A)
        found = {s: _best_from(s, initials, fees, forced, after) for s in states}
        after = {s: b for s, b in found.items() if b is not None}
    return after[_START]


def _turns(damaged: DataFrame) -> DataFrame:
    """Turns in order of their conversation, text set apart: one partition holds whole ones."""
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    return damaged.select(
        F.col("conv_id").alias("conv"), "turn", "role",
        F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", "role", F.lit(1)).alias("h2"),
        F.when(body == "", BLANK).when(F.right(body, F.lit(1)).isin(".", "!", "?"), SOUND)
        .otherwise(TRUNCATED).alias("look"), "text")


_ORDER = ("turn", "role", "h1", "h2")
_AUDITED = ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _audits(turns: DataFrame) -> DataFrame:
    """One row for each conversation that has turns: its counts, cost and audit."""
    narrow = turns.drop("text").repartition("conv")
    # Sorted within the partition of the conversation: no further shuffle.
    again = F.row_number().over(
        Window.partitionBy("conv", "h1", "h2").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(F.col("look") == BLANK, BLANK).when(again > 1, DUPLICATE).otherwise(F.col("look"))
    coded = narrow.select(
        "conv", "turn", "role", "h1", "h2", _code(F.left("role", F.lit(1)), fault).alias("code"))
    laid = coded.sortWithinPartitions(
        F.col("conv").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in _ORDER])

    kind = turns.schema["conv"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    conv_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in _AUDITED]
        types = [conv_type, *[pa.int64()] * 6, pa.string()]

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)], list(_AUDITED))
            for column in out:
                column.clear()
            return batch

        def finish() -> None:
            cost, audit = repair(bytes(codes))
            kinds = [c % 4 for c in codes]
            pairs = zip(codes, codes[1:])
            # Of initials, su, ua and au may stand side by side.
            wrong = sum(1 for a, b in pairs if (a // 4, b // 4) not in ((1, 2), (2, 3), (3, 2)))
            gaps = 0 if first is None else last - first + 1 - distinct
            for column, value in zip(out, (conv, gaps, kinds.count(BLANK), kinds.count(DUPLICATE),
                                           kinds.count(TRUNCATED), wrong, cost, audit)):
                column.append(value)

        conv, codes, size = None, bytearray(), 0
        first = last = None
        distinct = 0
        for batch in batches:
            for c, turn, code in zip(*(batch.column(n).to_pylist() for n in ("conv", "turn", "code"))):
                if codes and c != conv:
                    finish()
                    size += len(codes) + 64
                    if size > 1 << 22:
                        yield flush()
                        size = 0
                    codes, first, last, distinct = bytearray(), None, None, 0
                conv = c
                codes.append(code)
                if turn is not None:
                    if first is None:
                        first = turn
                    distinct += turn != last
                    last = turn
        if codes:
            finish()
        yield flush()

    return laid.select("conv", F.col("turn").cast("long").alias("turn"), "code").mapInArrow(
        run, f"conv {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, "
             "illegal long, cost long, audit string")


def _hashes(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``audits`` with the digest of each repaired conversation, made as its turns stream by."""
    kind = turns.schema["conv"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    conv_type = to_arrow_type(kind)
    heads = audits.select("*", *[F.lit(None).cast(turns.schema[c].dataType).alias(c)
                                 for c in (*_ORDER, "text")])
    body = turns.select("conv", *[F.lit(None).cast(audits.schema[c].dataType).alias(c)
                                  for c in _AUDITED[1:]], *_ORDER, "text")
    laid = heads.unionByName(body).repartition("conv").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), F.col("audit").isNull(),
        *[F.col(c).asc_nulls_first() for c in _ORDER]).select(*_AUDITED, "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_AUDITED, "repaired_sha256"]
        types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        out: list[list] = []
        head: list | None = None
        audit, at, place, kept, digest = "", 0, 0, 0, None

        def inserted() -> None:
            nonlocal at, place
            while at < len(audit) and audit[at] == "I":
                give(role_at(), "")
                at += 1

        def role_at() -> str:
            """Role that the grammar asks for at the next place of the repaired turns."""
            return "user" if (place - kept % 2) % 2 == 0 else "assistant"

        def give(role: str, text: str) -> None:
            nonlocal place
            if place:
                digest.update(b"\n")
            digest.update(role.encode("utf-8", "surrogatepass"))
            digest.update(b":")
            digest.update(text.encode("utf-8", "surrogatepass"))
            place += 1

        def finish() -> None:
            inserted()
            out.append([*head, digest.hexdigest()])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[7] is not None:
                    if head is not None:
                        finish()
                    head, audit = list(row[:8]), row[7]
                    at = place = 0
                    # An odd number of turns begins with the system's.
                    kept = len(audit) - audit.count("D")
                    digest = hashlib.sha256()
                    continue
                inserted()
                edit = audit[at]
                at += 1
                if edit == "K":
                    give(row[8], row[9])
                elif edit == "R":
                    give(role_at(), row[9])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)
            out = []
        if head is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

    return laid.mapInArrow(
        run, f"conv {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, "
             "illegal long, cost long, audit string, repaired_sha256 string")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``conv_id, turn, role, text``: its faults and its repair.

    Columns: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. Turns come by ``turn``, NULLs first; those of one turn by role, then by a
    hash, so that repeated rows lie side by side and all but the first of them are duplicates.
    NULL roles and texts must be filled in before; a role that begins with none of ``s``, ``u`` and
    ``a``, or is empty, cannot be kept. Rows with a NULL conversation form one. Other columns are
    not read. An empty table gives an empty one. Turns are grouped in a task by their
    conversation, whose codes and audit it holds; the digest is over all its texts in order,
    so one task streams them.
    """
    turns = _turns(rows)
    return _hashes(turns, _audits(turns)).withColumnRenamed("conv", "conv_id")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The repair of :func:`damage`\\ d conversations, one row for every original one.

    Of a conversation that lost all its rows the counts are zero, the audit is empty and the
    digest is that of the empty text.
    """
    original = conversations.select("conv_id", "turn", "role", "text")
    repaired = repair_conversations(damage(original))
    # NULL conversations match each other too.
    every = original.select(F.col("conv_id").alias("_id")).distinct()
    joined = every.join(repaired, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.col("_id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
          for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
