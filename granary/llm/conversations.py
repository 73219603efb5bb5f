"""Repair of conversations: a time-major tensor program over the edits of turns.

A conversation's roles have to read system?(user assistant)+, or nothing. Each turn is kept (0), given the role user or
assistant (3) or deleted (4); empty turns of user or assistant are inserted anywhere (3); a truncated turn that stays adds
3; blank turns and those said before have to go. Conversations are bucketed by length, and the costs of all conversations
of a bucket in all states (nothing yet, behind system, user, assistant) are worked out turn by turn from the last one
back, as one array operation for all of them; then the edits are traced forward, all conversations of the bucket at a
time, and of equal costs the least letter is taken: D, I, K, R. As edits of equal cost are never one the beginning of the
other, that gives the least audit.

Spark finds faults and orders turns; only codes of a byte a turn are in memory for a whole conversation, as long as its
audit is. Texts pass by in order, behind their conversation's audit, and are hashed as they pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import common

#: Turns whose costs are in memory at a time, for one conversation, and turns that are gathered before conversations are solved.
BLOCK, GATHER = 4096, 1 << 16

OK, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
_NEVER = 1 << 40
#: The state behind an inserted or a re-roled turn: a user's, but an assistant's behind a user's.
_NEXT = np.array([USER, USER, ASSISTANT, USER])
#: A turn's code: its fault, and 4 times the state that its role leads to (0: none). 16: no turn.
_NONE = 16


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code and state: where keeping leads, and the costs of keeping, re-roling and deleting."""
    to, keep, role, delete = (np.full((17, 4), fill, dtype=np.int64) for fill in (0, _NEVER, _NEVER, 4))
    for code in range(16):
        fault, state = code & 3, code >> 2
        if fault in (BLANK, DUPLICATE):
            continue
        role[code] = 3 + 3 * (fault == TRUNCATED)
        for s in {SYSTEM: [START], USER: [START, SYSTEM, ASSISTANT], ASSISTANT: [USER]}.get(state, []):
            to[code, s], keep[code, s] = state, 3 * (fault == TRUNCATED)
    delete[_NONE] = 0
    return to, keep, role, delete


_TO, _KEEP, _ROLE, _DELETE = _tables()


def _with_inserts(costs: np.ndarray) -> np.ndarray:
    """Costs by conversation and state, if up to two turns may be inserted first. More never pay."""
    return np.minimum(np.minimum(costs, 3 + costs[:, _NEXT]), 6 + costs[:, _NEXT[_NEXT]])


def _before(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs to the end before one turn of each conversation, by state, from those behind it."""
    kept = _KEEP[codes] + np.take_along_axis(after, _TO[codes], axis=1)
    return _with_inserts(np.minimum(np.minimum(_DELETE[codes] + after, _ROLE[codes] + after[:, _NEXT]), kept))


def _end(n: int) -> np.ndarray:
    return np.tile(_with_inserts(np.array([[0, _NEVER, _NEVER, 0]])), (n, 1))


def solve(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For turns by conversations (time-major; ``_NONE`` behind the last turn): costs, and letters of edits by conversation, 0 for none.

    Costs are stored at each ``BLOCK`` turns, and worked out again inside a block when its edits are traced.
    """
    turns, n = codes.shape
    borders = [_end(n)]
    for start in reversed(range(0, turns, BLOCK)):
        at = borders[-1]
        for t in reversed(range(start, min(start + BLOCK, turns))):
            at = _before(codes[t], at)
        borders.append(at)
    borders.reverse()
    every, state = np.arange(n), np.zeros(n, dtype=np.int64)
    letters = np.zeros((n, turns + 1, 3), dtype=np.uint8)

    def insert(t: int, costs: np.ndarray, held: np.ndarray) -> None:
        nonlocal state
        for slot in range(2):
            more = ~held & (3 + costs[every, _NEXT[state]] == costs[every, state])
            letters[more, t, slot] = ord("I")
            state = np.where(more, _NEXT[state], state)
            held = held | ~more | deletes(t, costs)

    def deletes(t: int, costs: np.ndarray) -> np.ndarray:
        if t == turns:
            return np.zeros(n, dtype=bool)
        return _DELETE[codes[t], state] + after[t + 1 - start][every, state] == costs[every, state]

    for i, start in enumerate(range(0, turns, BLOCK)):
        stop = min(start + BLOCK, turns)
        after = [borders[i + 1]]
        for t in reversed(range(start, stop)):
            after.append(_before(codes[t], after[-1]))
        after.reverse()
        for t in range(start, stop):
            costs, then = after[t - start], after[t + 1 - start]
            insert(t, costs, deletes(t, costs))
            left, now = costs[every, state], codes[t]
            gone = _DELETE[now, state] + then[every, state] == left
            kept = ~gone & (_KEEP[now, state] + then[every, _TO[now, state]] == left)
            letters[:, t, 2] = np.where(now == _NONE, 0, np.where(gone, ord("D"), np.where(kept, ord("K"), ord("R"))))
            state = np.where(gone, state, np.where(kept, _TO[now, state], _NEXT[state]))
    insert(turns, borders[-1], np.zeros(n, dtype=bool))
    return borders[0][:, START], letters.reshape(n, -1)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


_FIELDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audited(ids: pa.Array, conv: np.ndarray, fault: np.ndarray, role: np.ndarray, copies: np.ndarray, turn: np.ndarray, known: np.ndarray, same: np.ndarray) -> list[pa.Array]:
    """The columns of ``_FIELDS`` for whole conversations whose turns lie one behind the other; conv counts them from 0."""
    n = len(ids)
    stay = copies > 0
    conv, fault, role, copies, turn, known, same = (x[stay] for x in (conv, fault, role, copies, turn, known, same))
    new = np.ones(len(conv), dtype=bool)
    new[1:] = conv[1:] != conv[:-1]
    again = np.zeros(len(conv), dtype=bool)
    again[1:] = ~new[1:] & (known[1:] == known[:-1]) & (turn[1:] == turn[:-1]) & (same[1:] == same[:-1])
    fault = np.where(again & (fault != BLANK), DUPLICATE, fault)
    turns = np.zeros(len(conv), dtype=bool)  # the first row of each turn that isn't null
    turns[:1] = known[:1]
    turns[1:] = known[1:] & (new[1:] | ~known[:-1] | (turn[1:] != turn[:-1]))
    at = np.flatnonzero(known)
    distinct = np.bincount(conv[turns], minlength=n)
    lows, highs = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    highs[conv[at]] = turn[at]  # the last one stays
    lows[conv[at[::-1]]] = turn[at[::-1]]
    gaps = np.where(distinct > 0, highs - lows + 1 - distinct, 0)
    rows = np.repeat(np.arange(len(conv)), copies)
    second = np.zeros(len(rows), dtype=bool)
    second[1:] = rows[1:] == rows[:-1]
    conv, role = conv[rows], role[rows]
    fault = np.where(second & (fault[rows] != BLANK), DUPLICATE, fault[rows])
    first = np.searchsorted(conv, np.arange(n + 1))
    fits = np.array([0b000, 0b100, 0b1000, 0b100])  # behind any, system, user, assistant: the bit of the role that may follow
    wrong = np.zeros(len(conv), dtype=bool)
    wrong[1:] = (conv[1:] == conv[:-1]) & ((fits[role[:-1]] >> role[1:]) & 1 == 0)
    codes = (fault + 4 * role).astype(np.uint8)
    lengths = np.diff(first)
    costs = np.zeros(n, dtype=np.int64)
    audits: list = [None] * n
    bucket = np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
    for b in np.unique(bucket[lengths > 0]):
        members = np.flatnonzero((bucket == b) & (lengths > 0))
        tensor = np.full((int(lengths[members].max()), len(members)), _NONE, dtype=np.uint8)
        column = np.repeat(np.arange(len(members)), lengths[members])
        row = np.arange(len(column)) - np.repeat(np.cumsum(lengths[members]) - lengths[members], lengths[members])
        tensor[row, column] = codes[np.repeat(first[members], lengths[members]) + row]
        costs[members], letters = solve(tensor)
        for i, x in zip(members, letters, strict=True):
            audits[i] = x[x > 0].tobytes().decode("ascii")
    found = [gaps, *(_sums(fault == f, first) for f in (BLANK, DUPLICATE, TRUNCATED)), _sums(wrong, first), costs]
    return [ids, *(pa.array(x, pa.int64()) for x in found), pa.array([a or "" for a in audits], pa.string())]


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of turns in order, a conversation's one behind the other: a row for each conversation. A conversation that goes on is left for later."""
    names = ["conv_id", *(x.split()[0] for x in _FIELDS.split(", "))]
    held: list[pa.RecordBatch] = []

    def solved(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held
        table = pa.Table.from_batches(held).combine_chunks()
        code = table.column("conv_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        stop = table.num_rows if last else int(starts[-1])
        if stop:
            starts = starts[starts < stop]
            part = table.slice(0, stop)
            conv = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, stop)))
            column = lambda c: part.column(c).to_numpy()
            known = column("known")
            arrays = _audited(part.column("conv_id").combine_chunks().take(pa.array(starts)), conv, column("fault"), column("role"), column("copies"), column("turn"), known, column("same"))
            yield pa.RecordBatch.from_arrays(arrays, names)
        held = table.slice(stop).to_batches()

    rows, enough = 0, GATHER
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= enough:
            yield from solved(False)
            rows = sum(x.num_rows for x in held)
            enough = max(GATHER, 2 * rows)  # a conversation that is longer is looked at again when it has doubled
    if held:
        yield from solved(True)


def _repair(turns: bool):
    """Of each conversation's audit, and its turns in order behind it: the repaired turns, or the digest of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = edits = digest = None
        at = written = 0
        behind_user = False
        out: list[tuple] = []
        names = ["conv_id", "position", "edit", "role", "text"] if turns else ["conv_id", "repaired_sha256"]

        def put(edit: str, role: str | None, text: str) -> None:
            nonlocal written, behind_user
            role = role or ("assistant" if behind_user else "user")
            behind_user = role[:1] == "u"
            if turns:
                out.append((now, written, edit, role, text))
            else:
                digest.update(f"{chr(10) * (written > 0)}{role}:{text}".encode())
            written += 1

        def inserts() -> None:
            nonlocal at
            while edits[at : at + 1] == "I":
                put("I", None, "")
                at += 1

        def close() -> None:
            if edits is not None:
                inserts()
                if not turns:
                    out.append((now, digest.hexdigest()))

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()] if turns else [kind, pa.string()]
            for conv, audit, role, text, copies in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "copies")), strict=True):
                if audit is not None:
                    close()
                    now, edits, at, written, behind_user, digest = conv, audit, 0, 0, False, hashlib.sha256()
                    continue
                for _ in range(copies):
                    inserts()
                    if edits[at] != "D":
                        put(edits[at], role if edits[at] == "K" else None, text)
                    at += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def plain_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of a table of conversations; null roles and texts are one space. copies: how often a row stands there."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text, F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """``plain_rows``, damaged by the unsigned crc32 of ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the row, 1 empties its text, 2 takes
    its full stops, exclamation and question marks out, 3 repeats it, 4 makes it the user's."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = plain_rows(rows).withColumn("__h", F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20)
    h = F.col("__h")
    text = F.when(h == 1, "").when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(h == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"))


def _ordered(rows: DataFrame, *before: str) -> DataFrame:
    """Each conversation in one task, its turns in order: nulls first, rows of one turn by role and digest."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *before, F.col("turn").asc_nulls_first(), "role_text", "digest")


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation of ``plain_rows`` or ``damaged``."""
    common.small_batches(rows.sparkSession, 1 << 14)
    text = F.col("text")
    marks = rows.select(
        "conv_id", "turn", F.col("role").alias("role_text"), F.md5(text.cast("binary")).alias("digest"), "copies", (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    )
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    keys = ("conv_id", "role_text", "digest")
    first = marks.where("copies > 0").groupBy(*keys).agg(F.min(when).alias("first")).select(*[F.col(c).alias(f"first_{c}") for c in keys], "first")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"first_{c}"))
    fault = F.when(F.col("blank"), BLANK).when(when > F.col("first"), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(OK)
    initial = F.substring("role_text", 1, 1)
    state = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(START)
    marked = marks.join(first, same, "left").select(
        "conv_id", F.coalesce("turn", F.lit(0).cast("long")).alias("turn_or_0"), F.col("turn").isNotNull().alias("known"), fault.cast("tinyint").alias("fault"),
        state.cast("tinyint").alias("role"), "copies", F.xxhash64("role_text", "digest").alias("same"), "turn", "role_text", "digest",
    )
    sorted_marks = _ordered(marked).select("conv_id", F.col("turn_or_0").alias("turn"), "known", "fault", "role", "copies", "same")
    return sorted_marks.mapInArrow(_audit, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {_FIELDS}")


def _behind_audits(rows: DataFrame, audited: DataFrame) -> DataFrame:
    turns = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", F.col("role").alias("role_text"), "text", "copies", F.md5(F.col("text").cast("binary")).alias("digest"), F.lit(1).alias("kind"))
    nothing = {"turn": "long", "role_text": "string", "text": "string", "copies": "int", "digest": "string"}
    heads = audited.select("conv_id", "audit", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()], F.lit(0).alias("kind"))
    return _ordered(turns.unionByName(heads), "kind").select("conv_id", "audit", F.col("role_text").alias("role"), "text", "copies")


def repaired_turns(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the repaired conversations, turn by turn, each with the edit that it comes from (I, K or R)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _behind_audits(rows, audited).mapInArrow(_repair(True), f"conv_id {kind}, position long, edit string, role string, text string")


def repairs(rows: DataFrame) -> DataFrame:
    """A row for each conversation of ``plain_rows`` or ``damaged``: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    Rows of one turn go by role, then by a digest of the text; equal rows beyond the first are duplicates. A role other
    than those that begin with s, u or a, an empty one too, can only be given another or deleted. A null conv_id is a
    conversation of its own; one that has no turns left has zeros, an empty audit and the digest of nothing.
    A conversation's texts pass through one task in order, since its digest is that of one sequence; nothing but a few bytes a turn is held.
    """
    audited = common.cut(audits(rows))
    kind = rows.schema["conv_id"].dataType.simpleString()
    digests = _behind_audits(rows, audited).mapInArrow(_repair(False), f"conv_id {kind}, repaired_sha256 string")
    digests = digests.withColumnRenamed("conv_id", "of")
    return audited.join(digests, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
