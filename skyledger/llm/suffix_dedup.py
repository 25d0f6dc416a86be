"""Suffix-array dedup of byte strings: removes every byte covered by a
``length``-byte string that also starts anywhere else.

1. Of the hashes of GRAM consecutive bytes, each ``length``-byte string is
   known by its least (the leftmost, if equal): its anchor. Equal strings have
   equal anchors at equal offsets. A run of starts with one anchor is one
   context: the bytes of all its strings.
2. Contexts are joined globally by anchor hash. Equal contexts (by hash, with
   their counts made by partial aggregation) are repeated as a whole.
3. Different contexts with one anchor hash, one of each kind, are sorted as
   suffixes from the anchor on: a mergesort whose comparisons find the common
   extension by binary search on prefix polynomial hashes. Walking from each
   suffix to its neighbours, while the common extension still allows a match,
   and extending to the left by the same search, gives the repeated strings;
   the bytes of each match are compared, so no hash collision counts.
   Anchors with over MOST different contexts (a common phrase) are not
   gathered: each of their strings is hashed as a row of its own and counted
   by partial aggregation.

Defined results: null and empty texts, and those shorter than ``length``, stay
whole; strings never cross documents; rows that agree in doc_id and text are
copies of each other like any others; null doc_ids are kept apart by their
text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix64, row_key, stored

LENGTH, GRAM, MOST = 400, 64, 4000
#: Bytes of one text that are looked at together; longer texts are cut into overlapping blocks.
BLOCK = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Prefixes:
    """Prefix polynomial hashes of a byte array: the hash of any substring in
    constant time, its longest common extension with another in log time."""

    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        if len(self.powers) <= len(data):
            n = max(1 << 20, 2 * len(data))
            for name, base in (("powers", _BASE), ("inverses", _INVERSE)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(type(self), name, np.cumprod(p, dtype=np.uint64))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:len(data)], dtype=np.uint64, out=self.sums[1:])

    def of(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.inverses[at]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """Length of the common extension of places a and b, at most ``most``;
        to the left of them with ``back``."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        for _ in range(int(most.max()).bit_length() if len(a) else 0):
            middle = (low + high + 1) >> 1
            x, y = (a - middle, b - middle) if back else (a, b)
            same = self.of(x, middle) == self.of(y, middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low


def contexts(data: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor, first start, last start) of every context in
    concatenated texts; ``left``: bytes from each place to its text's end."""
    none = np.empty(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64), none, none, none
    p = Prefixes(data)
    m = len(data) - GRAM + 1
    h = (p.sums[GRAM:] - p.sums[:m]) * p.inverses[:m]
    key = h ^ (h >> np.uint64(32))
    key *= np.uint64(0xD6E8FEB86659FD93)
    key &= np.uint64(0xFFFFFFFFFF000000)
    key |= np.arange(m, dtype=np.uint64)  # under 2^24 places: the leftmost of equal hashes
    width, have = length - GRAM + 1, 1
    while have < width:  # least of each ``width`` neighbours, by doubling
        step = min(have, width - have)
        key = np.minimum(key[:-step], key[step:])
        have += step
    start = np.flatnonzero(left[:n] >= length)
    anchor = (key[start] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(anchor, prepend=-1) != 0)
    last = np.append(new[1:], len(anchor)) - 1
    at = anchor[new]
    return mix64(h[at]), at, start[new] if len(new) else none, start[last] if len(new) else none


def _blocks(texts: list[bytes | None], length: int) -> Iterator[tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray, bytes]]:
    """Batches of (text number, its offset in the batch, bytes before it), the
    batch's bytes, and bytes left in the text from each place."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def batch() -> tuple:
        raw = b"".join(x for _, _, x in held)
        sizes = np.array([len(x) for _, _, x in held])
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(raw))
        where = [(i, int(e - s), before) for (i, before, _), e, s in zip(held, ends, sizes)]
        return where, np.frombuffer(raw, np.uint8), left, raw

    for i, text in enumerate(texts):
        for before in range(0, max(len(text or b"") - length + 1, 0), BLOCK):
            piece = text[before:before + BLOCK + length - 1]
            held.append((i, before, piece))
            size += len(piece)
            if size >= BLOCK:
                yield batch()
                held, size = [], 0
    if held:
        yield batch()


def _contexts(docs: DataFrame, length: int) -> DataFrame:
    """kh (anchor hash), ch (context hash), row, begin, off (of the anchor), size of every context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in chunks(batches):
            rows = np.asarray(b.column(0))
            for where, data, left, raw in _blocks(b.column(1).to_pylist(), length):
                kh, anchor, first, last = contexts(data, left, length)
                off, size = anchor - first, last - first + length
                ch = [xxhash.xxh3_64_intdigest(raw[s:s + n], seed=o) for s, n, o in
                      zip(first.tolist(), size.tolist(), off.tolist())]
                text, begin, before = (np.array([w[k] for w in where]) for k in range(3))
                at = np.searchsorted(begin, first, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kh.view(np.int64)), pa.array(np.array(ch, np.uint64).view(np.int64)), pa.array(rows[text[at]]),
                     pa.array((first - begin[at] + before[at]).astype(np.int32)), pa.array(off.astype(np.int32)),
                     pa.array(size.astype(np.int32))], ["kh", "ch", "row", "begin", "off", "size"])

    return docs.mapInArrow(run, "kh long, ch long, row long, begin int, off int, size int")


def suffix_order(p: Prefixes, data: np.ndarray, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes that start at ``at`` (``size`` bytes each) within
    their groups (which are in order): bottom-up mergesort, all merges of a
    level at once, places found by binary search."""
    n = len(at)
    order = np.arange(n)
    head = np.flatnonzero(np.diff(group, prepend=-1) != 0)
    counts = np.diff(np.append(head, n))
    begin, end = np.repeat(head, counts), np.repeat(head + counts, counts)

    def before(x: np.ndarray, y: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix x comes before y (or is equal, with ``ties``)."""
        most = np.minimum(size[x], size[y])
        same = p.common(at[x], at[y], most)
        over = same >= most
        a, b = at[x] + np.where(over, 0, same), at[y] + np.where(over, 0, same)
        by_size = size[x] <= size[y] if ties else size[x] < size[y]
        return np.where(over, by_size, data[a] < data[b])

    width, largest = 1, int(counts.max()) if n else 0
    while width < largest:
        place = np.arange(n)
        run = (place - begin) // width
        own = begin + run * width  # this run's begin
        odd = run % 2 == 1
        low = np.where(odd, own - width, np.minimum(own + width, end))  # the other run
        high = np.where(odd, own, np.minimum(own + 2 * width, end))
        start = low.copy()
        for _ in range(width.bit_length()):
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            x, y = order[middle], order[open_]
            is_odd = odd[open_]
            goes = np.empty(len(open_), bool)  # the other run's middle comes first; of equals the left run's
            for ties in (False, True):
                pick = is_odd == ties
                goes[pick] = before(x[pick], y[pick], ties)
            low[open_] = np.where(goes, middle + 1, low[open_])
            high[open_] = np.where(goes, high[open_], middle)
        to = np.where(odd, own - width, own) + (place - own) + (low - start)
        merged = np.empty(n, np.int64)
        merged[to] = order
        order = merged
        width *= 2
    return order


def repeated_starts(parts: list[bytes], off: np.ndarray, group: np.ndarray, want: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, first start, last start) runs, within their contexts, of the
    strings that also occur in another member of the group."""
    raw = b"".join(parts)
    data = np.frombuffer(raw, np.uint8)
    sizes = np.array([len(x) for x in parts], np.int64)
    begin = np.cumsum(sizes) - sizes
    at, right = begin + off, sizes - off
    p = Prefixes(data)
    order = suffix_order(p, data, at, right, group)
    n = len(order)
    g = group[order]
    step_common = np.zeros(n, np.int64)  # of each suffix and the one before it in order
    pair = np.flatnonzero(g[1:] == g[:-1]) + 1
    a, b = order[pair - 1], order[pair]
    step_common[pair] = p.common(at[a], at[b], np.minimum(right[a], right[b]))
    starts = sizes - length + 1
    marks = np.zeros((n, int(starts.max()) + 1), np.int32)  # +1 where a run of repeated starts begins, -1 after it
    rank = np.flatnonzero(want[order])
    for down in (False, True):
        live = rank.copy()
        common = np.full(len(live), 1 << 40)
        t = 0
        while len(live):
            t += 1
            other = live + t if down else live - t
            edge = other if down else other + 1
            ok = (other < n if down else other >= 0)
            live, other, edge, common = live[ok], other[ok], edge[ok], common[ok]
            common = np.minimum(common, step_common[edge])  # 0 at a group's edge
            me = order[live]
            ok = common + off[me] >= length
            live, other, common, me = live[ok], other[ok], common[ok], me[ok]
            if not len(live):
                break
            you = order[other]
            back = p.common(at[me], at[you], np.minimum(off[me], off[you]), back=True)
            for i in np.flatnonzero(back + common >= length):
                x, y, l, r = int(at[me[i]]), int(at[you[i]]), int(back[i]), int(common[i])
                if raw[x - l:x + r] == raw[y - l:y + r]:
                    marks[me[i], off[me[i]] - l] += 1
                    marks[me[i], off[me[i]] + r - length + 1] -= 1
            if t % 8 == 0:  # members that are covered need no more neighbours
                depth = np.cumsum(marks[me], 1) > 0
                open_ = depth.sum(1) < starts[me]
                live, common = live[open_], common[open_]
    inside = np.cumsum(marks, 1) > 0
    edges = np.diff(inside.astype(np.int8), axis=1, prepend=0, append=0)
    member, first = np.nonzero(edges == 1)
    _, after = np.nonzero(edges == -1)
    return member, first, after - 1


def _resolve(wanted: DataFrame, length: int) -> DataFrame:
    """row, begin, end: repeated bytes of the contexts that are one of a kind
    (``want``), against the other kinds with their anchor hash."""
    def solve(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        kh, ch, row, begin, off, want = (np.asarray(t.column(k).combine_chunks()) for k in ("kh", "ch", "row", "begin", "off", "want"))
        parts = t.column("bytes").to_pylist()
        fresh = np.ones(len(kh), bool)
        fresh[1:] = (kh[1:] != kh[:-1]) | (ch[1:] != ch[:-1])
        keep = np.flatnonzero(fresh)
        cuts = [0]
        size = 0
        for i, k in enumerate(keep):  # pieces of whole groups of about half a block
            size += len(parts[k])
            if size > BLOCK // 2 and i + 1 < len(keep) and kh[keep[i + 1]] != kh[k]:
                cuts.append(i + 1)
                size = 0
        for lo, hi in zip(cuts, [*cuts[1:], len(keep)]):
            k = keep[lo:hi]
            group = np.cumsum(np.diff(kh[k], prepend=kh[k[0]]) != 0)
            member, first, last = repeated_starts([parts[i] for i in k], off[k].astype(np.int64), group, want[k], length)
            at = k[member]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[at]), pa.array((begin[at] + first).astype(np.int32)),
                 pa.array((begin[at] + last + length).astype(np.int32))], ["row", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # at most one group and a batch
        for b in batches:
            if b.num_rows == 0:
                continue
            kh = np.asarray(b.column(0))
            cut = int(np.searchsorted(kh, kh[-1]))
            if cut == 0 and held and held[-1].column(0)[-1].as_py() == kh[0]:
                held.append(b)
                continue
            if cut:
                held.append(b.slice(0, cut))
            if held:
                yield from solve(held)
            held = [b.slice(cut)]
        if held:
            yield from solve(held)

    n = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.select("kh", "ch", "row", "begin", "off", "want", "bytes").repartition(n, "kh") \
        .sortWithinPartitions("kh", "ch").mapInArrow(run, "row long, begin int, end int")


def _strings(wanted: DataFrame, length: int) -> DataFrame:
    """row, begin, end: repeated strings of contexts with a very common
    anchor, each hashed and counted as a row of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in batches:
            for row, begin, x, want in zip(*(b.column(c).to_pylist() for c in ("row", "begin", "bytes", "want"))):
                n = len(x) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_64_intdigest(x[i:i + length]) - (1 << 63) for i in range(n)]),
                     pa.array([xxhash.xxh64_intdigest(x[i:i + length]) - (1 << 63) for i in range(n)]),
                     pa.array([row] * n), pa.array(range(begin, begin + n), pa.int32()), pa.array([want] * n)],
                    ["h1", "h2", "row", "begin", "want"])

    strings = stored(wanted.select("row", "begin", "bytes", "want")
                     .mapInArrow(run, "h1 long, h2 long, row long, begin int, want boolean"), "strings")
    twice = strings.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return strings.filter("want").join(twice, ["h1", "h2"]).select("row", "begin", (F.col("begin") + length).alias("end"))


def repeated_bytes(docs: DataFrame, length: int = LENGTH, most: int = MOST) -> DataFrame:
    """row (by ``row_key``), spans: (begin, end) of repeated bytes, for rows that have any."""
    texts = docs.select(row_key().alias("row"), F.col("text").cast("binary").alias("text"))
    found = stored(_contexts(texts, length), "contexts")
    met = found.groupBy("kh").agg(F.count("*").alias("n")).filter("n > 1").select("kh")
    found = stored(found.join(met, "kh"), "met-contexts")
    kinds = found.groupBy("kh", "ch").agg(F.count("*").alias("copies"), F.min("row").alias("rep"))
    kinds = stored(kinds, "kinds")
    many = kinds.groupBy("kh").agg(F.count("*").alias("kinds"))
    whole = found.join(kinds.filter("copies > 1").select("kh", "ch"), ["kh", "ch"]) \
        .select("row", "begin", (F.col("begin") + F.col("size")).alias("end"))
    reps = found.join(kinds, ["kh", "ch"]).filter(F.col("row") == F.col("rep")) \
        .join(many.filter("kinds > 1"), "kh") \
        .select("row", F.struct("kh", "ch", "begin", "off", "size", (F.col("copies") == 1).alias("want"),
                                (F.col("kinds") > most).alias("common")).alias("c"))
    per_row = reps.groupBy("row").agg(F.collect_set("c").alias("cs"))
    wanted = texts.join(per_row, "row").select("row", "text", F.explode("cs").alias("c")).select(
        "c.*", "row", F.expr("substring(text, c.begin + 1, c.size)").alias("bytes"))
    wanted = stored(wanted, "wanted")
    spans = whole.unionByName(_resolve(wanted.filter("not common"), length))
    if wanted.filter("common").limit(1).count():
        spans = spans.unionByName(_strings(wanted.filter("common"), length))
    return spans.groupBy("row").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def cut_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, spans (begin, end of each maximal removed run) and
    kept (binary) for every row."""
    keyed = docs.select("doc_id", row_key().alias("row"), F.col("text").cast("binary").alias("text")) \
        .join(repeated_bytes(docs, length), "row", "left").select("doc_id", "text", "spans.begin", "spans.end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            kept, runs, sizes = [], [], []
            for text, begin, end in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
                text = text or b""
                mine: list[list[int]] = []
                for x, y in sorted(zip(begin or [], end or [])):
                    if mine and x <= mine[-1][1]:
                        mine[-1][1] = max(mine[-1][1], y)
                    else:
                        mine.append([x, y])
                at, out = 0, []
                for x, y in mine:
                    out.append(text[at:x])
                    at = y
                kept.append(b"".join([*out, text[at:]]))
                runs.append([{"begin": x, "end": y} for x, y in mine])
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"doc_id {kind}, n_bytes long, spans array<struct<begin: int, end: int>>, kept binary")


def report(cut: DataFrame) -> DataFrame:
    """Counts and digests of ``cut_repeats``'s rows, and the kept bytes as text
    (a character that was cut through is U+FFFD there, not in the digest)."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x.end - x.begin)
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
