"""Repair of conversation structure by run-length dynamic programming.

A conversation's role initials shall read ``(s?(ua)+)?``.  Edits: K keeps a row
(cost 0), R gives it the role user or assistant (3), D deletes it (4; blank rows and
rows said before must go), I inserts a row without text (3); a cut-off row that is
not deleted costs 3 more.  The cheapest edits are taken, of these the ones whose
initials sort first.

* Each row becomes a symbol: role class and fault.  Equal consecutive symbols
  collapse to (symbol, count).
* A symbol is a 4 x 4 min-plus matrix over the states nothing, s, u, a.  From the end
  to the start, the costs to go pass each run of symbols by the binary powers of its
  matrix, which are kept for all conversations of a worker.
* From the start on, the edits are read off: a run is halved by the same powers until
  its rows are few, then each row takes the first edit that keeps the least cost.
  Equal symbol sequences are solved once.

How it is dealt: faults are found on narrow rows; rows said before by the first row of
each (conversation, role, text digest); a conversation is cut into blocks of
``BLOCK_TURNS`` turns, each of which a task collapses, so that of a very long
conversation only (symbol, count) pairs meet, no more than its audit, which is one
cell of the result, has characters.  Texts are shuffled once.  A digest over a whole
conversation is sequential: its rows stream through one task, which holds one batch
at a time.

Defined cases: a null role or text is one blank; rows without a turn come first; rows
of equal turn go by role, then by the digest of their text; a null conversation id is
a conversation; any other role than s..., u..., a... by its first letter can only be
deleted or given another role; repeated rows are said before and go; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import ship_package, text_slices

WHITE = " \t\n\x0b\x0c\r"
# Turns of one block, as a power of two.
BLOCK_TURNS = 12

# Costs of the contract.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
# Role classes by initial, in the order of the codes 0, 1, 2; 3 is any other role.
INITIALS = "sua"
GONE = 8  # symbol of a row that must go; else class + 4 * cut off

NEVER = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
# Where a row of the given role leads from each state; -1: not allowed there.
STEP = {"s": (SYSTEM, -1, -1, -1), "u": (USER, USER, -1, USER), "a": (-1, -1, ASSISTANT, -1)}
# The role that an inserted row or a row with a new role gets in each state.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT = (USER, USER, ASSISTANT, USER)

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


# ------------------------------------------------------------ the dynamic program

def _times(m: Matrix, n: Matrix) -> Matrix:
    return tuple(tuple(min(m[i][k] + n[k][j] for k in range(4)) for j in range(4))
                 for i in range(4))


def _apply(m: Matrix, v: Vector) -> Vector:
    return tuple(min(m[i][k] + v[k] for k in range(4)) for i in range(4))


def _edits(symbol: int) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of one row: (initial, cost, state after it)."""
    out = []
    for state in range(4):
        own = [("D", DELETE, state)]
        if symbol != GONE:
            more = CUT_OFF * (symbol >= 4)
            if symbol % 4 < 3 and (to := STEP[INITIALS[symbol % 4]][state]) >= 0:
                own.append(("K", more, to))
            own.append(("R", REROLE + more, NEXT[state]))
        out.append(own)
    return out


EDITS = [_edits(s) for s in range(GONE + 1)]


def _inserts() -> Matrix:
    """Costs of any number of inserted rows."""
    m = [[0 if i == j else NEVER for j in range(4)] for i in range(4)]
    for _ in range(4):
        for i in range(4):
            for j in range(4):
                m[i][NEXT[j]] = min(m[i][NEXT[j]], m[i][j] + INSERT)
    return tuple(map(tuple, m))


INSERTS = _inserts()
# Cost of ending in each state: a system row alone or an open question is no end.
END: Vector = tuple(min(INSERTS[i][START], INSERTS[i][ASSISTANT]) for i in range(4))


@lru_cache(maxsize=None)
def power(symbol: int, bit: int) -> Matrix:
    """The transition of 2 ** bit rows with this symbol, inserted rows before each."""
    if bit:
        half = power(symbol, bit - 1)
        return _times(half, half)
    row = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, to in EDITS[symbol][state]:
            row[state][to] = min(row[state][to], cost)
    return _times(INSERTS, tuple(map(tuple, row)))


def before(symbol: int, count: int, after: Vector) -> Vector:
    """Costs to go before ``count`` rows of a symbol, from those after them."""
    bit = 0
    while count:
        if count & 1:
            after = _apply(power(symbol, bit), after)
        count, bit = count >> 1, bit + 1
    return after


def _unroll(symbol: int, count: int, state: int, after: Vector, out: list[str]) -> int:
    """Append the edits of a run of equal symbols; the state behind it."""
    if count > 32:
        half = count // 2
        state = _unroll(symbol, half, state, before(symbol, count - half, after), out)
        return _unroll(symbol, count - half, state, after, out)
    togo = [after]
    for _ in range(count):
        togo.append(_apply(power(symbol, 0), togo[-1]))
    for k in range(count, 0, -1):
        now, then = togo[k], togo[k - 1]
        while True:
            own = {e: to for e, cost, to in EDITS[symbol][state] if cost + then[to] == now[state]}
            if INSERT + now[NEXT[state]] == now[state]:
                own["I"] = NEXT[state]
            edit = min(own)
            out.append(edit)
            state = own[edit]
            if edit != "I":
                break
    return state


def solve(runs: Iterable[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of a conversation given as (symbol, count) pairs."""
    runs = list(runs)
    togo = [END]
    for symbol, count in reversed(runs):
        togo.append(before(symbol, count, togo[-1]))
    state, out = START, []
    for k, (symbol, count) in enumerate(runs):
        state = _unroll(symbol, count, state, togo[len(runs) - 1 - k], out)
    while END[state]:
        out.append("I")
        state = NEXT[state]
    return togo[-1][START], "".join(out)


def apply_audit(audit: str, rows: Iterator) -> Iterator[tuple[str, str | None, object]]:
    """(edit, new role or None, row) for each edit; an inserted row has no row."""
    state = START
    for edit in audit:
        row = None if edit == "I" else next(rows)
        if edit == "K":
            state = STEP[row[0][:1]][state]
            yield edit, row[0], row
        elif edit == "D":
            yield edit, None, row
        else:
            yield edit, NEXT_ROLE[state], row
            state = NEXT[state]


# ------------------------------------------------------------ rows and faults

def _rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str,
          text_col: str) -> DataFrame:
    ship_package(rows.sparkSession)
    return rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text")).withColumn(
        "digest", F.unhex(F.sha2("text", 256)))


def _order() -> list:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def _symbols(rows: DataFrame) -> DataFrame:
    """Narrow rows: conv, block, turn, role, digest, again (the how manieth row of its
    role and text), class, blank, cut_off."""
    said = F.row_number().over(Window.partitionBy("conv", "role", "digest")
                               .orderBy(F.asc_nulls_first("turn")))
    place = F.position(F.left("role", F.lit(1)), F.lit(INITIALS))  # 0: none of them
    end = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    return rows.select(
        "conv", "turn", "role", "digest",
        F.when((F.col("role") != "") & (place > 0), place - 1).otherwise(3).alias("kind"),
        (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut_off")).withColumn(
        "again", said).withColumn("block", F.shiftright("turn", BLOCK_TURNS))


BLOCKS = ("first long, last long, turns long, blank long, duplicate long, truncated long, "
          "illegal long, head int, tail int, symbols binary, counts array<long>")
RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string")


def _with_conv(rows: DataFrame, more: str) -> StructType:
    return StructType([StructField("conv", rows.schema["conv"].dataType),
                       *StructType.fromDDL(more).fields])


def _groups(rows: Iterable[tuple], keys: int) -> Iterator[tuple[tuple, Iterator]]:
    """(key, rows) for consecutive equal keys; a key is the first ``keys`` values."""
    return groupby(rows, key=lambda r: r[:keys])


def _emit(schema: StructType, made: Iterator[tuple], size: int = 2000
          ) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    part: list[tuple] = []

    def batch():
        columns = zip(*part, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    for row in made:
        part.append(row)
        if len(part) >= size:
            yield batch()
            part = []
    if part:
        yield batch()


def _legal(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _collapse_block(key: tuple, rows: Iterator) -> tuple:
    turn = None
    first = last = head = tail = None
    turns = blank = duplicate = truncated = illegal = 0
    symbols, counts = bytearray(), []
    for _, _, turn, kind, is_blank, is_cut, again in rows:
        if turn is not None and turn != last:
            first, last, turns = turn if first is None else first, turn, turns + 1
        if is_blank:
            blank, symbol = blank + 1, GONE
        elif again > 1:
            duplicate, symbol = duplicate + 1, GONE
        else:
            truncated, symbol = truncated + is_cut, kind + 4 * is_cut
        if head is None:
            head = kind
        else:
            illegal += not _legal(tail, kind)
        tail = kind
        if symbols and symbols[-1] == symbol:
            counts[-1] += 1
        else:
            symbols.append(symbol)
            counts.append(1)
    return (key[0], key[1], first, last, turns, blank, duplicate, truncated, illegal, head, tail,
            bytes(symbols), counts)


def _blocks(rows: Iterable[tuple]) -> Iterator[tuple]:
    for key, own in _groups(rows, 2):
        yield _collapse_block(key, own)


class _Solver:
    """Solved symbol sequences of a worker, up to ``most`` symbols in all."""

    def __init__(self, most: int = 1_000_000):
        self.known: dict[tuple, tuple[int, str]] = {}
        self.most, self.held = most, 0

    def solve(self, runs: list[tuple[int, int]]) -> tuple[int, str]:
        key = tuple(runs)
        if key not in self.known:
            cost, audit = solve(runs)
            size = len(key) + len(audit)
            if size > self.most:
                return cost, audit
            if self.held + size > self.most:
                self.known.clear()
                self.held = 0
            self.known[key] = cost, audit
            self.held += size
        return self.known[key]


def _conversations(rows: Iterable[tuple]) -> Iterator[tuple]:
    solver = _Solver()
    for (conv,), blocks in _groups(rows, 1):
        first = last = tail = None
        turns, sums, runs = 0, [0, 0, 0, 0], []
        for _, _, a, b, n, *counted, head, end, symbols, counts in blocks:
            first, last = a if first is None else first, last if b is None else b
            turns += n
            sums = [x + y for x, y in zip(sums, counted, strict=True)]
            if tail is not None:
                sums[3] += not _legal(tail, head)
            tail = end
            for symbol, count in zip(symbols, counts, strict=True):
                if runs and runs[-1][0] == symbol:
                    runs[-1] = symbol, runs[-1][1] + count
                else:
                    runs.append((symbol, count))
        gaps = 0 if first is None else last - first + 1 - turns
        yield conv, gaps, *sums, *solver.solve(runs)


def _sorted_map(rows: DataFrame, keys: list[str], order: list, columns: list[str],
                make: Callable, schema: StructType) -> DataFrame:
    """``make`` over the rows of each key, which meet sorted in one task; rows stream."""
    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        if "text" in columns:
            for part in text_slices(batches, columns):
                yield from zip(*part, strict=True)
        else:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    dealt = rows.repartition(*keys).sortWithinPartitions(*[F.asc_nulls_first(k) for k in keys],
                                                         *order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emit(schema, make(stream(batches)))

    return dealt.select(*columns).mapInArrow(run, schema)


def audits(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_col``, gaps, blank, duplicate, truncated,
    illegal, cost, audit.  See the module's docstring."""
    found = _audits(_rows(rows, conv_col, turn_col, role_col, text_col))
    return found.withColumnRenamed("conv", conv_col)


def _audits(rows: DataFrame) -> DataFrame:
    narrow = _symbols(rows)
    blocks = _sorted_map(narrow, ["conv", "block"], [*_order(), F.asc("again")],
                         ["conv", "block", "turn", "kind", "blank", "cut_off", "again"], _blocks,
                         _with_conv(rows, "block long, " + BLOCKS))
    names = StructType.fromDDL(BLOCKS).fieldNames()
    return _sorted_map(blocks, ["conv"], [F.asc_nulls_first("block")], ["conv", "block", *names],
                       _conversations, _with_conv(rows, RESULT))


def _edited(rows: DataFrame, found: DataFrame, make: Callable, more: str) -> DataFrame:
    """``make`` over (conv, numbers, audit, rows) of each conversation; what ``found``
    has of it travels as a row in front of the conversation's own."""
    own = rows.select("conv", F.lit(1).alias("is_row"), "turn", "role", "digest", "text")
    numbers = F.concat_ws(",", *[c for c in found.columns if c not in ("conv", "audit")])
    lead = found.select("conv", F.lit(0).alias("is_row"), F.lit(None).cast("long").alias("turn"),
                        numbers.alias("role"), F.lit(b"").alias("digest"),
                        F.col("audit").alias("text"))

    def each(stream: Iterable[tuple]) -> Iterator[tuple]:
        for (conv,), group in _groups(stream, 1):
            first = next(group)
            yield from make(conv, map(int, first[3].split(",")), first[4],
                            ((r[3], r[4], r[2]) for r in group))

    return _sorted_map(own.unionByName(lead), ["conv"], [F.asc("is_row"), *_order()],
                       ["conv", "is_row", "turn", "role", "text"], each, _with_conv(rows, more))


def _repaired(conv: object, numbers: Iterable, audit: str, rows: Iterator) -> Iterator[tuple]:
    for k, (edit, role, row) in enumerate(apply_audit(audit, rows)):
        if edit != "D":
            yield conv, k, edit, role, row[1] if row else "", row[2] if row else None


def _digested(conv: object, numbers: Iterable, audit: str, rows: Iterator) -> Iterator[tuple]:
    digest, gap = hashlib.sha256(), b""
    for edit, role, row in apply_audit(audit, rows):
        if edit != "D":
            digest.update(gap + f"{role}:{row[1] if row else ''}".encode())
            gap = b"\n"
    yield conv, *numbers, audit, digest.hexdigest()


def repair(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired rows: ``conv_col``, position (place of the row's edit in the
    audit), edit, role, text, turn (null for an inserted row)."""
    own = _rows(rows, conv_col, turn_col, role_col, text_col)
    return _edited(own, _audits(own), _repaired,
                   "position long, edit string, role string, text string, turn long"
                   ).withColumnRenamed("conv", conv_col)


def repair_report(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``audits`` and repaired_sha256, the digest of the repaired conversation's
    ``role:text`` lines."""
    own = _rows(rows, conv_col, turn_col, role_col, text_col)
    return _edited(own, _audits(own), _digested, RESULT + ", repaired_sha256 string"
                   ).withColumnRenamed("conv", conv_col)
