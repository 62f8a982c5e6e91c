"""Repair of conversation structure: the cheapest edits after which turns alternate.

Rows are put in order once and cut into blocks of equal size, whatever conversations they belong to. A
block decides its conversations by itself; of one that reaches over its edge it keeps the best edits
for every state it may be entered and left in. Those few texts are then put together per
conversation, and every block applies what was decided. So a conversation of any length is spread over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from nearfield.llm.survivors import BLANK, CUT, DUPLICATE, FINE, FORCED, KEEP, ROLE, STATES, Survivors
from nearfield.operators.ordinals import with_ordinal
from nearfield.session import cut_lineage

BLOCK_ROWS = 1 << 14
BATCH_ROWS = 4096


def damage(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text)`` of the rows after damage by ``crc32("key:turn") % 20``.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 sets its role to
    user. Nulls count as one space, also in the hashed string; a null turn stays null.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, turn, role, text)]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    rows = conversations.select(
        F.col(key).alias("conv"), F.col(turn).alias("turn"), shown[2].alias("role"), shown[3].alias("text"), kind.alias("kind")
    ).where("kind != 0")
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), copies
    ).drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """``(at, conv, initial, fault)`` of placed rows; what was seen before is found by the first place of each turn's digest."""
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    facts = cut_lineage(
        rows.select("at", "conv", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), cut.alias("cut"), said.alias("said")),
        "turns",
    )
    firsts = facts.groupBy("conv", "said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
    return facts.join(firsts, "at", "left").select("at", "conv", "initial", fault.alias("fault"))


def _block(at: Column, size: int) -> Column:
    return F.floor(at / size).cast("long")


class _Segment:
    """The rows one conversation has in one block; ``entries`` are the states it may start in."""

    def __init__(self, at: int, conv: object, entries: Iterator[int]):
        self.at, self.conv, self.n, self.illegal = at, conv, 0, 0
        self.first = self.last = ""
        self.runs = []
        for entry in entries:
            decided: list[str] = []
            self.runs.append((entry, decided, Survivors(entry, lambda text, _, out=decided: out.append(text))))

    def add(self, initial: str, fault: int) -> None:
        if self.n and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.first = self.first if self.n else initial
        self.last, self.n = initial, self.n + 1
        for _, _, run in self.runs:
            run.row(initial, fault)

    def rows(self, whole: bool) -> Iterator[tuple]:
        """(conv, at, entry, exit, cost, audit, illegal, first, last); exit -1: decided to the end."""
        ends = (self.illegal, self.first, self.last)
        for entry, decided, run in self.runs:
            if whole:
                cost, rest = run.finish()
                yield self.conv, self.at, entry, -1, cost, "".join(decided + [t for t, _ in rest]), *ends
            else:
                for state, (cost, _) in sorted(run.best.items()):
                    yield self.conv, self.at, entry, state, cost, "".join(decided + [t for t, _ in run.rest(state)]), *ends


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(shape)], schema=shape)


def _batched(rows: Iterator[tuple], shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH_ROWS:
            yield _batch(held, shape)
            held = []
    yield _batch(held, shape)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, BATCH_ROWS).columns))


def _segments(facts: DataFrame, block_rows: int) -> DataFrame:
    """Best edits of every segment; see ``_Segment.rows``."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, inside in groupby(rows, key=lambda r: r[0]):
            segment, edge = None, True
            for _, at, conv, initial, fault in inside:
                if segment is None or conv != segment.conv:
                    if segment is not None:
                        yield from segment.rows(whole=not edge)
                        edge = False
                    segment = _Segment(at, conv, STATES if edge else (0,))
                segment.add(initial, fault)
            yield from segment.rows(whole=False)

    kind = facts.schema["conv"].dataType
    shape = StructType([
        StructField("conv", kind), *[StructField(n, LongType()) for n in ("at", "entry", "exit", "cost")],
        StructField("audit", StringType()), StructField("illegal", LongType()),
        StructField("first", StringType()), StructField("last", StringType()),
    ])
    ordered = facts.select(_block(F.col("at"), block_rows).alias("block"), "at", "conv", "initial", "fault")
    ordered = ordered.repartition("block").sortWithinPartitions("at")
    arrow = to_arrow_schema(shape)
    return ordered.mapInArrow(lambda batches: _batched(run(_tuples(batches)), arrow), shape)


def _decide(segments: DataFrame) -> DataFrame:
    """``(conv, at, entry, audit, cost, illegal)``: the edits of every segment; the cost and the illegal pairs stand in a conversation's last row.

    Segments of a conversation come in order and are steps like rows are; each is handed out as soon as all survivors share it.
    """

    def joined(conv: object, rows: Iterator[tuple]) -> Iterator[tuple]:
        decided: list[tuple[str, object]] = []
        run = Survivors(0, lambda text, tag: decided.append((text, tag)))
        illegal, last = 0, None
        for _, options in groupby(rows, key=lambda r: r[1]):
            options = list(options)  # at most one per entry and exit
            _, at, _, exit_, cost, audit, inner, first, end = options[0]
            if exit_ < 0:
                yield conv, at, 0, audit, cost, inner
                return
            illegal += inner + (last is not None and last + first not in ("su", "ua", "au"))
            last = end
            run.advance([(entry, to, cost, audit, (at, entry)) for _, _, entry, to, cost, audit, *_ in options])
            while len(decided) > 1:
                text, (place, entry) = decided.pop(0)
                yield conv, place, entry, text, 0, 0
        total, rest = run.finish()
        steps = decided + rest
        trailing = "".join(text for text, tag in steps if tag is None)
        steps = [s for s in steps if s[1] is not None]
        for number, (text, (place, entry)) in enumerate(steps, 1):
            end = number == len(steps)
            yield conv, place, entry, text + trailing * end, total * end, illegal * end

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, own in groupby(rows, key=lambda r: r[0]):
            yield from joined(conv, own)

    shape = StructType([
        segments.schema["conv"], StructField("at", LongType()), StructField("entry", LongType()), StructField("audit", StringType()),
        StructField("cost", LongType()), StructField("illegal", LongType()),
    ])
    ordered = segments.repartition("conv").sortWithinPartitions("conv", "at", "entry", "exit")
    arrow = to_arrow_schema(shape)
    return ordered.mapInArrow(lambda batches: _batched(run(_tuples(batches)), arrow), shape)


def _apply(rows: DataFrame, decided: DataFrame, block_rows: int) -> DataFrame:
    """``(conv, at, step, edit, role, text)`` of the turns that remain; ``at`` and ``step`` order them."""

    def run(table: Iterator[tuple]) -> Iterator[tuple]:
        conv, at, step, state, audit, place = None, 0, 0, 0, "", 0

        def inserted() -> Iterator[tuple]:
            nonlocal step, state, place
            while place < len(audit) and audit[place] == "I":
                state = FORCED[state]
                yield conv, at, step, "I", ROLE[state], ""
                step, place = step + 1, place + 1

        for _, found, own, conv_, role, text, entry in table:
            if own == 0:
                yield from inserted()  # those behind the last turn of the segment before
                conv, at, step, state, audit, place = conv_, found, 0, entry, text, 0
                continue
            at, step = found, step if found == at else 0
            yield from inserted()
            edit, place = audit[place], place + 1
            if edit == "R":
                state = FORCED[state]
                role = ROLE[state]
            elif edit == "K":
                state = KEEP[state][role[:1]]
            if edit != "D":
                yield conv, at, step, edit, role, text
                step += 1
        yield from inserted()

    edits = decided.select(
        _block(F.col("at"), block_rows).alias("block"), "at", F.lit(0).alias("own"), "conv",
        F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), "entry",
    )
    turns = rows.select(
        _block(F.col("at"), block_rows).alias("block"), "at", F.lit(1).alias("own"), "conv", "role", "text", F.lit(None).cast("long").alias("entry")
    )
    ordered = edits.unionByName(turns).repartition("block").sortWithinPartitions("at", "own")
    shape = StructType([
        rows.schema["conv"], StructField("at", LongType()), StructField("step", LongType()), StructField("edit", StringType()),
        StructField("role", StringType()), StructField("text", StringType()),
    ])
    arrow = to_arrow_schema(shape)
    return ordered.mapInArrow(lambda batches: _batched(run(_tuples(batches)), arrow), shape)


class Repair:
    """The repair of ``(conv, turn, role, text)`` rows: ``turns`` remain, ``edits`` lead there, ``faults`` were found.

    Turns of a conversation come by ``turn``, nulls first; rows of one turn by role and text. A turn that is
    blank (no character but space and ``\\x09-\\x0D``) or has the role and text of an earlier one is deleted at a cost
    of 4. Others are kept, reroled to user or assistant (3) or deleted (4); a truncated one that is not
    deleted costs 3 more. Empty user and assistant turns may be inserted anywhere (3). The cheapest edits
    whose role initials read ``(s?(ua)+)?`` win; ties go to the least string of edit initials. Null roles
    and texts count as one space, an empty role as one that has to change; null keys are one conversation;
    empty tables give empty results.
    """

    def __init__(self, rows: DataFrame, block_rows: int = BLOCK_ROWS):
        filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
        rows = rows.select("conv", "turn", *filled)
        order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text")]
        self.rows = with_ordinal(rows, order, "at")
        self.faults = cut_lineage(_faults(self.rows), "faults")
        self.edits = cut_lineage(_decide(_segments(self.faults, block_rows)), "edits")
        self.turns = _apply(self.rows, self.edits, block_rows)


def _digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, read in order as one stream."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, own in groupby(rows, key=lambda r: r[0]):
            digest, between = hashlib.sha256(), b""
            for _, _, _, role, text in own:
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            yield conv, digest.hexdigest()

    shape = StructType([turns.schema["conv"], StructField("sha", StringType())])
    ordered = turns.select("conv", "at", "step", "role", "text").repartition("conv").sortWithinPartitions("conv", "at", "step")
    arrow = to_arrow_schema(shape)
    return ordered.mapInArrow(lambda batches: _batched(run(_tuples(batches)), arrow), shape)


def repair_digest(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per key of ``conversations``: ``(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``.

    The rows are damaged first (``damage``). A key whose rows are all dropped has zeros, an empty audit and
    the hash of the empty string.
    """
    rows = damage(conversations, key, turn, role, text)
    repair = Repair(rows, block_rows)
    turns = repair.rows.groupBy("conv").agg(F.max("turn").alias("b"), F.min("turn").alias("a"), F.count_distinct("turn").alias("n"))
    parts = [
        conversations.select(F.col(key).alias("conv")).distinct(),
        turns.select("conv", (F.col("b") - F.col("a") + 1 - F.col("n")).alias("gaps")),
        repair.faults.groupBy("conv").agg(
            *[F.count_if(F.col("fault") == code).alias(name) for name, code in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))]
        ),
        repair.edits.groupBy("conv").agg(
            F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "audit"))), lambda s: s["audit"]), "").alias("audit"),
        ),
        _digests(repair.turns),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return union.groupBy(F.col("conv").alias(key)).agg(
        *[F.coalesce(F.max(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
