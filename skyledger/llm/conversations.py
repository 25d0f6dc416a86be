"""Repair of conversation structure: bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows used, what the repaired roles end in): nothing,
the system turn, a user turn, or an assistant turn after it. Each row is kept,
reroled or deleted, and turns may be inserted anywhere. A forward heap from the
start and a reverse heap from the goal hold (cost, rows); both go on until
their least costs together exceed the best crossing, so every crossing of that
cost is finished, and the least concatenated audit of them is taken. Each label
carries the least audit of its cost: two audits of one cost to the same node
are never prefixes of each other, so least parts make least wholes.

Rows are put in order by a range sort on (conversation, turn, role, text, copy),
which a long conversation's rows share over many tasks, and solved in segments
of at most SEGMENT rows for every pair of end states; segments of a
conversation are then combined pairwise. One task holds an audit (a letter or
so a row, which the result is one string of) but no texts: these are streamed
in order through the digest.

Defined results: null role or text is one space; null turns come first and don't
count in gaps; rows of equal turn go by role, then text; rows that repeat are
duplicates; a conversation of which no row is left after damage has zeros, an
empty audit and the digest of the empty string; a null conv_id is a
conversation of its own; very long texts are never cut; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SEGMENT = 256
NOTHING, SYSTEM, USER, PAIR = range(4)
#: Ends of the repaired roles before a role, and after it.
ROLES = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, PAIR: USER}, "a": {USER: PAIR}}
BLANK = r"[^\x20\x09-\x0D]"


def _edits(code: str) -> list[tuple[int, str, dict[int, int]]]:
    """(cost, letter, end before: end after) of every edit of a row. Codes:
    the role's initial (x: none of s, u, a), upper case if truncated, d: to delete."""
    out = [(DELETE, "D", {q: q for q in range(4)})]
    if code != "d":
        more = TRUNCATED * code.isupper()
        if code.lower() in ROLES:
            out.append((KEEP + more, "K", ROLES[code.lower()]))
        out += [(REROLE + more, "R", ROLES[role]) for role in "ua"]
    return out


_INSERTS = [(INSERT, "I", ROLES[role]) for role in "ua"]


def _neighbours(codes: str, node: tuple[int, int], step: int) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """Edges from ``node`` (step 1) or into it (step -1)."""
    i, q = node
    for edits, j in ((_INSERTS, i), *([(_edits(codes[min(i, i + step)]), i + step)] if 0 <= i + step <= len(codes) else [])):
        for cost, letter, moves in edits:
            for before, after in moves.items():
                if (before if step > 0 else after) == q:
                    yield cost, letter, (j, after if step > 0 else before)


def least_audit(codes: str, enter: int, leave: int) -> tuple[int, str] | None:
    """Least cost of the rows from one end state to another, and its least audit."""
    starts = (0, enter), (len(codes), leave)
    labels: list[dict] = [{s: (0, "")} for s in starts]
    settled: list[set] = [set(), set()]
    heaps: list[list] = [[(0, 0, s)] for s in starts]
    best = 0 if starts[0] == starts[1] else None
    while heaps[0] or heaps[1]:
        least = [h[0][0] if h else 0 for h in heaps]  # an empty heap leaves the other to go on alone
        if best is not None and sum(least) > best:
            break
        side = 0 if heaps[0] and (not heaps[1] or least[0] <= least[1]) else 1
        _, _, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side].add(node)
        cost, audit = labels[side][node]
        for more, letter, other in _neighbours(codes, node, 1 - 2 * side):
            label = cost + more, (letter + audit if side else audit + letter)
            known = labels[side].get(other)
            if known is None or label < known:
                labels[side][other] = label
                heapq.heappush(heaps[side], (label[0], abs(other[0] - starts[side][0]), other))
            met = labels[1 - side].get(other)
            if met and (best is None or cost + more + met[0] < best):
                best = cost + more + met[0]
    if best is None:
        return None
    found = []
    for ends, start in zip(settled, starts):
        ends.add(start)  # its label is final from the outset
    for node in settled[0]:  # every path of the best cost has an edge from one settled side to the other
        cost, audit = labels[0][node]
        if node in settled[1] and cost + labels[1][node][0] == best:
            found.append(audit + labels[1][node][1])
        for more, letter, other in _neighbours(codes, node, 1):
            if other in settled[1] and cost + more + labels[1][other][0] == best:
                found.append(audit + letter + labels[1][other][1])
    return best, min(found)


@lru_cache(maxsize=20_000)
def solve(codes: str, whole: bool) -> tuple[tuple[int, str] | None, ...]:
    """``least_audit`` by 4 * enter + leave; if ``whole``, only of a
    conversation's own ends."""
    wanted = {NOTHING, PAIR} if whole else range(16)
    return tuple(least_audit(codes, k // 4, k % 4) if k in wanted else None for k in range(16))


def combined(parts: list[tuple]) -> tuple:
    """The segments' solutions as those of one run."""
    while len(parts) > 1:
        pairs = []
        for x, y in zip(parts[::2], parts[1::2]):
            out = []
            for k in range(16):
                ways = [(a[0] + b[0], a[1] + b[1]) for m in range(4)
                        if (a := x[k // 4 * 4 + m]) and (b := y[m * 4 + k % 4])]
                out.append(min(ways, default=None))
            pairs.append(tuple(out))
        parts = pairs + parts[len(pairs) * 2:]
    return parts[0]


class Repair:
    """Applies an audit to rows in order and hashes the repaired lines."""

    def __init__(self, audit: str):
        self.audit, self.at, self.turns, self.lines = audit, 0, 0, 0
        self.hash = hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
        self.lines += 1

    def _next(self) -> str:
        self.turns += 1
        return "user" if self.turns % 2 else "assistant"

    def _inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._line(self._next(), "")

    def row(self, role: str, text: str) -> None:
        self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self._line(self._next(), text)
        elif letter == "K":
            self.turns += role[:1] != "s"
            self._line(role, text)

    def close(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy: what crc32 of ``conv_id:turn`` leaves of ``rows``."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    known = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return known.filter("kind != 0").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with mid, a number in the order of conversation and turn."""
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "copy")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                  .withColumn("mid", F.monotonically_increasing_id()), "conversation-rows")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, mid, turn, initial, fault (blank, duplicate, truncated or null)
    of rows in order: the first fault of each."""
    text_key = [F.xxhash64(F.lit(i), "conv_id", "role", "text").alias(f"h{i}") for i in (1, 2)]
    light = rows.select("conv_id", "mid", "turn", F.substring("role", 1, 1).alias("initial"), *text_key,
                        (~F.col("text").rlike(BLANK)).alias("blank"),
                        (~_last("text").isin(".", "!", "?")).alias("truncated"))
    firsts = light.groupBy("h1", "h2").agg(F.min("mid").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    fault = F.when(F.col("blank"), "blank").when(F.col("mid") > F.col("first"), "duplicate").when(F.col("truncated"), "truncated")
    return light.join(firsts, ["h1", "h2"], "left").select("conv_id", "mid", "turn", "initial", fault.alias("fault"))


def _last(column: str) -> Column:
    """The last character that is not white space."""
    return F.substring(F.rtrim(F.col(column), F.lit(" \t\n\x0b\x0c\r")), -1, 1)


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class _Run:
    """Counts of consecutive rows of one conversation, by row or by segment."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes, self.seq = conv_id, [], None
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = self.low = self.high = None

    def row(self, mid: int, turn: int | None, initial: str, fault: str | None) -> None:
        self.meet(initial, initial, turn, turn, 1 if turn is not None else 0)
        if self.seq is None:
            self.seq = mid
        if fault:
            self.counts[fault] += 1
        code = initial if initial in ROLES else "x"
        self.codes.append(code if fault is None else code.upper() if fault == "truncated" else "d")

    def meet(self, first: str, last: str, low: int | None, high: int | None, turns: int) -> None:
        if self.first is None:
            self.first = first
        elif (self.last, first) not in LEGAL:
            self.counts["illegal"] += 1
        self.last = last
        if turns:
            self.counts["turns"] += turns - (self.high == low)
            self.low, self.high = low if self.low is None else self.low, high


def segments(rows: DataFrame) -> DataFrame:
    """Solved segments of the rows of ``faults``: conv_id, seq, counts, first
    and last initial and turn, cost and audit by pair of end states."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("part", F.shiftright("mid", 33)).repartition(n, "part").sortWithinPartitions("part", "mid")
    names = ["conv_id", "seq", *_COUNTS, "first", "last", "low", "high", "cost", "audit"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.int64()] * 2 + [pa.list_(pa.int64()), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, alone, out = None, None, False, []

        def finish(ends: bool) -> None:
            found = solve("".join(now.codes), alone and ends)
            out.append((now.conv_id, now.seq, *now.counts.values(), now.first, now.last, now.low, now.high,
                        [x and x[0] for x in found], [x and x[1] for x in found]))

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)
            out.clear()
            return made

        for b in batches:
            for conv_id, mid, turn, initial, fault in zip(*(c.to_pylist() for c in b.columns[:5])):
                other = now is None or conv_id != now.conv_id or mid >> 33 != part
                if other or len(now.codes) == SEGMENT:
                    same_part = now is not None and mid >> 33 == part
                    if now is not None:
                        finish(other and same_part)
                    alone = other and same_part  # nothing of it lies in the part before
                    now, part = _Run(conv_id), mid >> 33
                now.row(mid, turn, initial, fault)
            if out:
                yield batch()
        if now is not None:
            finish(False)
            yield batch()

    return dealt.mapInArrow(run, "conv_id long, seq long, " + ", ".join(f"{c} long" for c in _COUNTS)
                            + ", first string, last string, low long, high long, cost array<long>, audit array<string>")


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(parts: DataFrame) -> DataFrame:
    """One row of counts, cost and audit for each conversation of ``segments``."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [x.split()[0] for x in _RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []

        def finish() -> None:
            found = combined(held)
            cost, audit = min(x for x in (found[NOTHING], found[PAIR]) if x)
            gaps = now.high - now.low + 1 - now.counts["turns"] if now.low is not None else 0
            out.append((now.conv_id, gaps, *[now.counts[c] for c in _COUNTS[:4]], cost, audit))

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, pa.string() if c == "audit" else pa.int64())
                                               for x, c in zip(zip(*out), names)], names)
            out.clear()
            return made

        for b in batches:
            for conv_id, _, *counts, first, last, low, high, cost, audit in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        finish()
                    now, held = _Run(conv_id), []
                now.meet(first, last, low, high, counts[4])
                for name, more in zip(_COUNTS[:4], counts):
                    now.counts[name] += more
                held.append(tuple(None if c is None else (c, a) for c, a in zip(cost, audit)))
            if out:
                yield batch()
        if now is not None:
            finish()
            yield batch()

    return parts.repartition(n, "conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(run, _RESULT)


def repair(conversations: DataFrame) -> DataFrame:
    """Counts, cost, audit and repaired_sha256 of every conv_id of
    ``conversations`` (conv_id, turn, role, text) after ``damaged``."""
    own = conversations.withColumn("conv_id", F.col("conv_id").cast("long"))
    n = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _ordered(damaged(own))
    known = stored(audits(segments(faults(rows))), "audits")
    missing = own.select("conv_id").distinct().join(known.select(F.col("conv_id").alias("found"), F.lit(True).alias("there")),
                                                    F.col("conv_id").eqNullSafe(F.col("found")), "left") \
        .filter(F.col("there").isNull()).select("conv_id")
    zeros = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    heads = known.unionByName(missing.select("conv_id", *zeros, F.lit("").alias("audit")))
    names = [x.split()[0] for x in _RESULT.split(", ")]
    every = heads.select(F.lit(-1).cast("long").alias("mid"), *names, F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")) \
        .unionByName(rows.select("mid", "conv_id", "role", "text"), allowMissingColumns=True) \
        .select("mid", "role", "text", *names).repartition(n, "conv_id").sortWithinPartitions("conv_id", "mid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state, out = None, None, []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, pa.int64() if i < 7 else pa.string()) for i, x in enumerate(zip(*out))],
                                              [*names, "repaired_sha256"])
            out.clear()
            return made

        for b in chunks(batches):
            for mid, role, text, *values in zip(*(c.to_pylist() for c in b.columns)):
                if mid >= 0:
                    state.row(role, text)
                    continue
                if head:
                    out.append((*head, state.close()))
                head, state = values, Repair(values[-1])
            if out:
                yield batch()
        if head:
            out.append((*head, state.close()))
            yield batch()

    return every.mapInArrow(run, _RESULT + ", repaired_sha256 string")
