"""Packing token sequences by minimum bin slack.

Each document's ids are cut into whole windows of ``capacity`` and one rest.
Rests of one length are interchangeable, so the packing runs on the number of
rests of each length, at most ``capacity - 1`` numbers however many documents
there are. A window takes the longest rest left; bitset subset sums over the
lengths that remain, each as often as its count allows, then find the multiset
that fills it closest to capacity, and walking back through the bitsets gives
its counts. The same multiset fills windows until a length runs short. Where
no multiset fills a window, one more rest is cut to fill it and the remainder
goes back to its length. What is left in the end is under one window and fills
windows of falling powers of two in the same way, so nothing is padded.

Documents find their window by arithmetic: a rest's place among those of its
length is a running number in its task plus the numbers of the tasks before.

Defined results: a null text counts as empty and has the closing id alone;
rows that repeat are packed one by one; very long texts are cut like others
and never held as more than their ids; null doc_ids are kept; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, lists, stored

CAPACITY, CLOSING = 2048, 1
#: Pieces kept by a task's worker in each of two generations.
MOST_WORDS = 200_000
#: Bits of a place on a length's line.
PLACE = 48


def _byte_marks() -> dict[int, str]:
    """How byte-level vocabularies write each byte: printable ones as they
    are, the others, in order, from U+0100 on. For ``str.translate`` on Latin-1."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(0x100 + i) for i, b in enumerate(others)}


class WordIds(dict):
    """Packed ids of the blank-separated pieces met lately. The vocabulary's
    pattern never joins across white space, so pieces encode on their own; so do
    a run of Latin letters and the ASCII marks after it."""

    MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.whole = Tokenizer.from_str(spec)
        self.model = self.whole.model.tokenize
        self.older: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {}
        self.marks = _byte_marks()

    def _encode(self, piece: bytes) -> bytes:
        return array("I", self.whole.encode(piece.decode(), add_special_tokens=False).ids).tobytes()

    def _word(self, piece: bytes) -> bytes | None:
        """Ids of a piece of letters up to U+024F, in lower case as the vocabulary
        has it; None for any other. Composing changes none of these letters."""
        word = piece.decode()
        if not piece.isalpha():  # not ASCII
            if not word.isalpha() or max(word) > "\u024f" or "\u0130" in word:
                return None
            word = word.lower().encode().decode("latin-1").translate(self.marks)
        return array("I", [t.id for t in self.model(word)]).tobytes()

    def _keep(self, piece: bytes, ids: bytes) -> bytes:
        if len(self) >= MOST_WORDS:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 40:
            self[piece] = ids
        return ids

    def _tail(self, tail: bytes) -> bytes:
        ids = self.tails.get(tail)
        if ids is None:
            if len(self.tails) >= MOST_WORDS:
                self.tails.clear()
            ids = self.tails[tail] = self._encode(tail)
        return ids

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            core = piece.rstrip(self.MARKS)
            if len(core) == len(piece):
                ids = self._word(piece)
            elif core:
                word = self.get(core) or self.older.get(core)
                if word is None and (word := self._word(core)):
                    self._keep(core, word)
                ids = word and word + self._tail(piece[len(core):])
            if ids is None:
                ids = self._encode(piece)
        return self._keep(piece, ids)

    def of(self, text: bytes | None) -> bytes:
        """Little-endian 32-bit ids of a text, with the closing id."""
        return b"".join(map(self.__getitem__, text.lower().split() if text else ())) + CLOSING.to_bytes(4, "little")


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> Counter:
    """The multiset of rests (length: how often) closest to ``room``, which
    holds the longest that fits. ``lengths``: those with counts, falling."""
    first = next((x for x in lengths if x <= room), None)
    if first is None:
        return Counter()
    target = room - first
    reach, mask, steps = 1, (1 << target + 1) - 1, []
    for length in lengths:
        if length > target:
            continue
        left, times = min(counts[length] - (length == first), target // length), 1
        while left > 0:
            n = min(times, left)
            steps.append((length, n, reach))
            reach |= reach << length * n & mask
            left, times = left - n, times * 2
        if reach >> target & 1:
            break
    at, use = reach.bit_length() - 1, Counter({first: 1})
    for length, n, before in reversed(steps):
        if not before >> at & 1:
            use[length] += n
            at -= length * n
    return use


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Slots (length, first place, n a window, window, offset, taken, then) and
    the number of windows. A slot gives the rests from ``first place`` on its
    length's line, ``n`` to a window, to windows from ``window`` on. Where
    less than the length is taken, the remainders follow each other from place
    ``then`` on the line of their own length."""
    counts = {x: n for x, n in counts.items() if n}
    done, ends = Counter(), Counter(counts)
    lengths = sorted(counts, reverse=True)
    left, window, slots = sum(x * n for x, n in counts.items()), 0, []
    while left:
        room = capacity if left >= capacity else 1 << left.bit_length() - 1
        use = fullest(counts, lengths, room)
        gap = room - sum(x * n for x, n in use.items())
        cut = next(x for x in lengths if counts[x] > use[x]) if gap else 0  # all that is left over is longer than the gap
        need = use + Counter({cut: 1}) if gap else use
        times = min(counts[x] // n for x, n in need.items())
        offset = 0
        for length, n in sorted(use.items(), reverse=True):
            slots.append((length, done[length], n, window, offset, length, -1))
            done[length] += n * times
            counts[length] -= n * times
            offset += n * length
        if gap:
            rest = cut - gap
            slots.append((cut, done[cut], 1, window, offset, gap, ends[rest]))
            done[cut] += times
            counts[cut] -= times
            counts[rest] = counts.get(rest, 0) + times
            ends[rest] += times
        lengths = sorted((x for x, n in counts.items() if n), reverse=True)
        left -= room * times
        window += times
    return np.array(slots, np.int64).reshape(-1, 7), window


def _rests(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """doc_id, part, at (the row's number there), doc_tokens, crcs of the whole
    windows and how many came before in this part, and the rest: its length,
    number among those of this length in this part, crc and ids."""
    with open(vocabulary) as f:  # a fixed file of under 2 MB
        shared = docs.sparkSession.sparkContext.broadcast({"spec": f.read()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held = shared.value  # one object for all tasks of a Python worker
        if "words" not in held:
            held["words"] = WordIds(held["spec"])
        words, part = held["words"], TaskContext.get().partitionId()
        at = windows = 0
        seen = Counter()
        for b in chunks(batches):
            tokens, rests, ranks, before, crcs, sizes, rest_crcs, rest_ids = ([] for _ in range(8))
            for text in b.column(1).cast(pa.binary()).to_pylist():
                ids = words.of(text)
                n = len(ids) // 4
                whole = n // capacity
                rest = n - whole * capacity
                tail = ids[4 * whole * capacity:]
                tokens.append(n)
                sizes.append(whole)
                before.append(windows)
                crcs += [zlib.crc32(ids[4 * i * capacity:4 * (i + 1) * capacity]) for i in range(whole)]
                rests.append(rest)
                ranks.append(seen[rest])
                rest_crcs.append(zlib.crc32(tail))
                rest_ids.append(tail)
                seen[rest] += 1
                windows += whole
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([part] * n, pa.int32()), pa.array(np.arange(at, at + n)), pa.array(tokens, pa.int64()),
                 pa.array(before, pa.int64()), lists(np.array(crcs, np.int64), sizes, pa.int64()), pa.array(rests, pa.int32()),
                 pa.array(ranks, pa.int64()), pa.array(rest_crcs, pa.int64()), pa.array(rest_ids, pa.binary())],
                ["doc_id", "part", "at", "doc_tokens", "before", "crcs", "rest", "rank", "rest_crc", "rest_ids"])
            at += n

    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return stored(src.mapInArrow(
        run, f"doc_id {kind}, part int, at long, doc_tokens long, before long, crcs array<long>, rest int, rank long, "
             "rest_crc long, rest_ids binary"), "token-rests")


def _place(rests: DataFrame, slots: np.ndarray) -> DataFrame:
    """Pieces of every rest (by its length and place): skip (its ids before),
    length, sequence_id, offset and cut (whether the rest has other pieces)."""
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    shared = rests.sparkSession.sparkContext.broadcast(slots)  # a few for each of under 2^16 lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        keys = (s[:, 0] << PLACE) + s[:, 1]
        for b in batches:
            if not b.num_rows:
                continue
            row = np.arange(b.num_rows)
            length = np.asarray(b.column("rest")).astype(np.int64)
            place = np.asarray(b.column("place")).astype(np.int64)
            skip = np.zeros(b.num_rows, np.int64)
            found = []
            while len(row):
                slot = s[np.searchsorted(keys, (length << PLACE) + place, "right") - 1]
                nth, inside = np.divmod(place - slot[:, 1], slot[:, 2])
                found.append(np.stack([row, skip, slot[:, 5], slot[:, 3] + nth, slot[:, 4] + inside * length]))
                more = slot[:, 6] >= 0
                row, skip, place = row[more], (skip + slot[:, 5])[more], (slot[:, 6] + nth)[more]
                length = (length - slot[:, 5])[more]
            row, skip, taken, window, offset = np.concatenate(found, 1)
            cut = np.bincount(row, minlength=b.num_rows)[row] > 1
            kept = pa.RecordBatch.from_arrays([b.column(c) for c in names], names).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(skip), pa.array(taken), pa.array(window), pa.array(offset), pa.array(cut)],
                                             [*names, "skip", "length", "sequence_id", "offset", "cut"])

    names = ["doc_id", "part", "at", "doc_tokens", "rest", "rest_crc"]
    kind = rests.schema["doc_id"].dataType.simpleString()
    return rests.mapInArrow(run, f"doc_id {kind}, part int, at long, doc_tokens long, rest int, rest_crc long, "
                                 "skip long, length long, sequence_id long, offset long, cut boolean")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every
    piece. ``vocabulary`` is a tokenizer file; ``capacity`` a power of two."""
    rows = _rests(docs, vocabulary, capacity)
    counts = {r.rest: r["n"] for r in rows.filter("rest > 0").groupBy("rest").agg(F.count("*").alias("n")).collect()}  # under ``capacity`` rows
    slots, packed = plan(counts, capacity)

    # Rests, and whole windows, of the parts before: a row for each part and length.
    lower = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.filter("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n")).unionByName(
        rows.groupBy("part").agg(F.sum(F.size("crcs")).alias("n")).withColumn("rest", F.lit(capacity)))
    sums = stored(sums.withColumn("lower", F.coalesce(F.sum("n").over(lower), F.lit(0))).select("part", "rest", "lower"), "part-sums")

    whole = rows.filter(F.size("crcs") > 0).select("doc_id", "part", "doc_tokens", "before", "crcs") \
        .join(sums.filter(F.col("rest") == capacity).drop("rest"), "part") \
        .select("doc_id", "doc_tokens", (F.col("before") + F.col("lower") + packed).alias("window"), F.posexplode("crcs").alias("i", "crc")) \
        .select("doc_id", (F.col("i").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
                F.col("crc").alias("ids_crc32"), "doc_tokens", (F.col("window") + F.col("i")).alias("sequence_id"),
                F.lit(0).cast("long").alias("offset"))

    rests = rows.filter("rest > 0").select("doc_id", "part", "at", "doc_tokens", "rest", "rank", "rest_crc") \
        .join(sums, ["part", "rest"]).withColumn("place", F.col("rank") + F.col("lower"))
    placed = stored(_place(rests, slots), "placed-rests")
    start = (F.col("doc_tokens") - F.col("rest") + F.col("skip")).alias("start")
    uncut = placed.filter(~F.col("cut")).select(
        "doc_id", start, "length", F.col("rest_crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    # Only rows of the lengths that are cut are read with their ids.
    cuts = sorted({int(x) for x in slots[slots[:, 6] >= 0, 0]})
    ids = rows.filter(F.col("rest").isin(cuts)).select("part", "at", "rest_ids")
    bytes_of = F.substring("rest_ids", (4 * F.col("skip") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    cut = placed.filter("cut").join(ids, ["part", "at"]).select(
        "doc_id", start, "length", F.crc32(bytes_of).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    return whole.unionByName(uncut).unionByName(cut)
