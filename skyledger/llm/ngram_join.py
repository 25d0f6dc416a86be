"""Size-aware heavy-light join of n-gram sets: links at Jaccard >= PERCENT %.

A document's set holds the hashes of its word 5-grams; equal sets are one
member. All sets are put in one order of tokens, rare first. Two linked sets
of sizes a and b share 9 o >= 4 (a + b) tokens (for 80 %), hence

* at least one of the first ``n - ceil(0.8 n) + 1`` tokens of each: large sets
  write themselves into the inverted lists of these tokens, and
* at least one pair of the first ``n - ceil(0.8 n) + 2`` of each: small sets
  enumerate these 2-subsets, which far fewer strangers share.

Small sets that a large one may match are in the lists too. The boundary is
the size at which the subsets cost more than scanning the lists, whose mean
length is estimated from a sketch of token counts (2^SKETCH counters over all
documents, which also gives the order).

Lists are never expanded into all pairs: each gives star pairs to its first
member, and every member checks the star it shares most lists with. Then a
list's members that are still in different components are held against each
other inside a task, by bounds on sizes, positions and differing bits, and only
what passes leaves it: first each member's nearest by bits, then, components
being merged, all pairs that are left. These are checked exactly unless the
lists they share rule them out; so components are exact while a group of copies
costs one check per copy. The bits are parities of a set's hashes in BITS slots:
sets whose bits differ in d places differ in d tokens at least. Before tokens
travel, pairs are held against each other by sketches, such bits in as many
slots as a set's size calls for. Of a long list
only blocks that hold two components meet.

Defined results: null text and text without words have no shingle and link
with nothing; text of 1 to 4 words has one shingle, the whole; a row with null
doc_id takes part but never names a component unless all its members are
null; rows that repeat are copies of each other; extra columns are ignored; an
empty table gives no rows. Tokens and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, chunks, grams, lean, mix64, row_key, signed, stored
from .components import components

WORDS, PERCENT, SKETCH, BITMAP = 5, 80, 17, 23
AT_ONCE = 1_000_000  # bytes of text a worker cuts together
#: Parity bits of a set, in longs of 64.
BITS = [f"bits{i}" for i in range(4)]
#: Members of a list that are held against each other in one task.
BLOCK = 2048
#: A list longer than this is dealt out by set id; each part has a star of its
#: own, and components of different parts meet as those of one list do.
LIST_PART = 1_000_000
#: Members of a list that may link beyond which their sketches go with them, so that few pairs leave the task.
DENSE = 16
#: Rows of list keys that are broadcast at most.
FEW = 500_000


def shingle_sets(column: pa.Array, table: WordHashes, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    split = [t.lower().split() if t else [] for t in column.cast(pa.binary()).to_pylist()]
    sizes = [len(w) for w in split]
    h = table.of([w for ws in split for w in ws])
    g = grams(h, words)
    out, at = [], 0
    for n in sizes:
        out.append(np.unique(g[at:at + n - words + 1]) if n >= words else grams(h[at:at + n], n) if n else g[:0])
        at += n
    return out


def set_id(tokens: np.ndarray) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def parities(tokens: np.ndarray, slots: int = 64 * len(BITS)) -> np.ndarray:
    """The set's parity bits in ``slots`` slots as longs."""
    odd = np.bincount((tokens >> np.uint64(20)).astype(np.int64) % slots, minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch(tokens: np.ndarray) -> bytes:
    """Parity bits in a power of two of slots, four a token at least: an eighth
    of the tokens' bytes at most. Halves put together by xor are the bits in
    half as many slots, so any two sketches compare."""
    return parities(tokens, 1 << max(6, (4 * len(tokens) - 1).bit_length())).tobytes()


def prefix(n: Column) -> Column:
    return n - F.ceil(n * PERCENT / 100) + 1


def prefix_size(n: int) -> int:
    return n - -(-n * PERCENT // 100) + 1


def boundary(counters: np.ndarray) -> int:
    """Least size at which a set's 2-subsets cost more than scanning its lists:
    a list costs its entry and a quarter of each other member's."""
    total = counters.sum()
    if total == 0:
        return 2
    mean = max(1.0, ((counters.astype(np.float64) ** 2).sum() - total ** 2 / len(counters)) / total)
    size = 2
    while size < 100 and (p := prefix_size(size)) * (p + 1) / 2 <= p * (1 + (mean - 1) / 4):
        size += 1
    return size


def _documents(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, row, n, sid, sketch and parity bits of every row; the token counters) in one pass over the texts."""
    parts = 64

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        table, counters = WordHashes(), np.zeros(1 << SKETCH, np.int64)
        names = ["doc_id", "row", "n", "sid", "sketch", *BITS, "part", "task", "counters"]
        for b in chunks(batches, at_once=AT_ONCE):
            sets = shingle_sets(b.column(2), table)
            counters += np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH)).astype(np.int64), minlength=1 << SKETCH)
            n, none = b.num_rows, pa.nulls(b.num_rows, pa.int32())
            bits = np.stack([parities(x) for x in sets])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary()),
                 *[pa.array(bits[:, i]) for i in range(len(BITS))], none, none, pa.nulls(n, pa.binary())], names)
        if counters.any():
            none = pa.nulls(parts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.nulls(parts, pa.int32()), none, pa.nulls(parts, pa.binary()), *[none] * len(BITS), pa.array(range(parts), pa.int32()),
                 pa.array([TaskContext.get().partitionId()] * parts, pa.int32()),
                 pa.array([x.tobytes() for x in np.split(counters, parts)], pa.binary())], names)

    done = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), "text").mapInArrow(
        run, f"doc_id long, row long, n int, sid long, sketch binary, {', '.join(f'{x} long' for x in BITS)}, part int, task int, counters binary"),
        "shingle-sets")

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in t.column("counters").to_pylist())
        return pa.table({"part": t.column("part")[:1], "task": pa.array([0], pa.int32()), "counters": pa.array([total.tobytes()], pa.binary())})

    counts = done.filter(F.col("part").isNotNull()).select("part", (F.col("task") % 64).alias("task"), "counters")
    for keys in (["part", "task"], ["part"]):  # two levels: no task gathers a slice of every task at once
        counts = counts.groupBy(*keys).applyInArrow(add, "part int, task int, counters binary")
    counters = np.zeros((parts, (1 << SKETCH) // parts), np.int64)
    for r in counts.collect():  # 2^SKETCH counters
        counters[r.part] = np.frombuffer(r.counters, np.int64)
    return done.filter(F.col("part").isNull()).select("doc_id", "row", "n", "sid", "sketch", *BITS), counters.ravel()


def _entries(docs: DataFrame, counters: np.ndarray, limit: int, list_part: int) -> DataFrame:
    """key, part, sid, n, pos: the lists that each set enters. Sets under
    ``limit`` enter by 2-subsets (pos: that of the later token, negated), those
    that may match a larger one by tokens too. part: 0 unless the list is split."""
    shared = docs.sparkSession.sparkContext.broadcast(counters)  # 2^SKETCH counters

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, count, seen = WordHashes(), shared.value, set()
        for b in chunks(batches, at_once=AT_ONCE):
            key, part, sid, size, pos = [], [], [], [], []
            for s in shingle_sets(b.column(0), table):
                n = len(s)
                if n == 0 or (me := set_id(s)) in seen:  # copies met by this task enter once
                    continue
                if len(seen) < 1_000_000:
                    seen.add(me)
                weight = count[(s >> np.uint64(64 - SKETCH)).astype(np.int64)]
                order = np.argsort(weight, kind="stable")  # by count, then hash: the same order everywhere
                p = prefix_size(n)
                if n < limit:
                    t = s[order[:p + 1]]
                    i, j = np.triu_indices(len(t), 1)
                    key.append(mix64(t[i] * np.uint64(3) + t[j]))
                    part.append(np.zeros(len(i), np.int32))
                    pos.append(-j.astype(np.int32))
                    sid.append(np.full(len(i), me, np.int64))
                    size.append(np.full(len(i), n, np.int32))
                if 100 * n >= PERCENT * limit:
                    t = s[order[:p]]
                    parts = 1 + weight[order[:p]] // list_part
                    key.append(t)
                    part.append(np.where(parts > 1, 1 + (me & 0xFFFFFFFF) % parts, 0).astype(np.int32))
                    pos.append(np.arange(len(t), dtype=np.int32))
                    sid.append(np.full(len(t), me, np.int64))
                    size.append(np.full(len(t), n, np.int32))
            if key:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(key))), pa.array(np.concatenate(part)), pa.array(np.concatenate(sid)),
                     pa.array(np.concatenate(size)), pa.array(np.concatenate(pos))], ["key", "part", "sid", "n", "pos"])

    return docs.select("text").mapInArrow(run, "key long, part int, sid long, n int, pos int")


def _lists(entries: DataFrame) -> DataFrame:
    """key, sid, n, pos and the list's first member (hub, hub_n, hub_pos), for
    every further member of a list of two or more, and for every member of a
    part of a split list. Sorted lists are read in a stream, so a long one
    needs no memory."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # key, part, hub, n, pos, last sid of the list under way
        for b in batches:
            if b.num_rows == 0:
                continue
            key, part, sid, n, pos = (np.asarray(b.column(k)) for k in range(5))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            fresh = np.ones(len(key), bool)
            fresh[1:] = new[1:] | (sid[1:] != sid[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            hub = np.stack([sid[start], n[start].astype(np.int64), pos[start].astype(np.int64)])
            if held is not None and held[:2] == (key[0], part[0]):
                first = start == 0
                hub[:, first] = np.array(held[2:5])[:, None]
                fresh[0] = sid[0] != held[5]
            keep = fresh & ((sid != hub[0]) | (part > 0))
            held = (int(key[-1]), int(part[-1]), *(int(x) for x in hub[:, -1]), int(sid[-1]))
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[keep]), pa.array(sid[keep]), pa.array(n[keep]), pa.array(pos[keep]), pa.array(hub[0, keep]),
                     pa.array(hub[1, keep].astype(np.int32)), pa.array(hub[2, keep].astype(np.int32))],
                    ["key", "sid", "n", "pos", "hub", "hub_n", "hub_pos"])

    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartition(n, "key", "part").sortWithinPartitions("key", "part", "sid").mapInArrow(
        run, "key long, sid long, n int, pos int, hub long, hub_n int, hub_pos int")


def _sizes_fit(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _need(a: str, b: str) -> Column:
    """Least intersection of linked sets of these sizes."""
    return F.ceil(PERCENT * (F.col(a) + F.col(b)) / (100 + PERCENT))


def _may_link(shared: Column, a: str, b: str, limit: int) -> Column:
    """Shared list tokens bound the intersection: what is beyond the prefix
    that ends first can add no more than its set has left. Sets in 2-subset
    lists are not bounded so."""
    left = F.greatest(F.col(a) - prefix(F.col(a)), F.col(b) - prefix(F.col(b)))
    return _sizes_fit(a, b) & ((F.least(a, b) < limit) | (shared + left >= _need(a, b)))


def _side(keys: DataFrame) -> DataFrame:
    """``keys`` of lists, to be joined with all entries: broadcast if few, so that the entries stay where they are."""
    return F.broadcast(keys) if keys.limit(FEW + 1).count() <= FEW else keys


def _dealt(entry: DataFrame, block: int) -> DataFrame:
    """``entry`` with blk, a, b: what is to be held against each other meets
    under one (key, a, b). Lists up to ``block`` members stay whole. Of a longer
    one that is still mixed, the largest component is dealt into blocks below 0
    and the rest into blocks from 0; blocks of the largest never meet each other,
    so a list of a component and few strangers costs one pass. Longer lists of a
    single component go."""
    long = entry.groupBy("key").agg(F.count("*").alias("all"), F.min("root").alias("least"), F.max("root").alias("most")) \
        .filter(F.col("all") > block).withColumn("mixed", F.col("least") != F.col("most")).select("key", "all", "mixed")
    long = stored(long, "long-lists")
    main = entry.join(_side(long.filter("mixed").select("key", "all")), "key").groupBy("key", "root", "all").agg(F.count("*").alias("mine")) \
        .groupBy("key", "all").agg(F.max(F.struct("mine", "root")).alias("m")) \
        .select("key", F.col("m.root").alias("main"), F.ceil(F.col("m.mine") / block).cast("int").alias("mains"),
                F.ceil((F.col("all") - F.col("m.mine")) / block).cast("int").alias("others"))
    plan = _side(long.join(main, "key", "left"))
    zero = F.lit(0)
    at = F.xxhash64("sid")
    blk = F.when(F.col("mixed").isNull(), zero).when(
        F.col("root") == F.col("main"), -1 - F.pmod(at, F.col("mains"))).otherwise(F.pmod(at, F.col("others"))).cast("int")
    meets = F.when(F.col("mixed").isNull(), F.array(F.struct(zero.alias("a"), zero.alias("b")))).otherwise(F.transform(
        F.when(F.col("blk") < 0, F.sequence(zero, F.col("others") - 1)).otherwise(F.sequence(-F.col("mains"), F.col("others") - 1)),
        lambda o: F.struct(F.least(o, F.col("blk")).alias("a"), F.greatest(o, F.col("blk")).alias("b"))))
    return entry.join(plan, "key", "left").filter("mixed is null or mixed").withColumn("blk", blk) \
        .withColumn("meet", F.explode(meets)).select(*entry.columns, "blk", "meet.a", "meet.b")


def _pairs_of(key: list[np.ndarray], root: np.ndarray, blk: np.ndarray, n: np.ndarray, pos: np.ndarray,
              bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, differing bits) of rows of one (key, a, b) that may link, rows
    being sorted by these; one shift of all rows at a time."""
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    room = np.where(pos < 0, n + pos + 1, n - pos)
    new = np.zeros(len(n), np.int64)
    new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
    group, inside = np.cumsum(new), key[1] == key[2]
    i, d = np.arange(len(n)), 0
    while len(i):
        d += 1
        i = i[:np.searchsorted(i, len(n) - d)]
        i = i[group[i] == group[i + d]]
        j = i + d
        ok = (root[i] != root[j]) & ((blk[i] == blk[j]) == inside[i])
        x, y = i[ok], j[ok]
        total = n[x] + n[y]
        need = -(-PERCENT * total // (100 + PERCENT))
        ok = (100 * np.minimum(n[x], n[y]) >= PERCENT * np.maximum(n[x], n[y])) & (np.minimum(room[x], room[y]) >= need)
        x, y, total = x[ok], y[ok], total[ok]
        differ = np.bitwise_count(bits[:, x] ^ bits[:, y]).sum(0, dtype=np.int64)
        ok = (100 + PERCENT) * differ <= (100 - PERCENT) * total
        if ok.any():
            yield x[ok], y[ok], differ[ok]


def folded(sketch: np.ndarray, longs: int) -> np.ndarray:
    """The sketch's bits in as many slots as ``longs`` hold."""
    while len(sketch) > longs:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def _by_sketch(sketches: list[bytes], x: np.ndarray, y: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Which pairs of rows the sketches don't keep apart."""
    size = np.array([len(s) // 8 for s in sketches])
    least, keep = np.minimum(size[x], size[y]), np.zeros(len(x), bool)
    for longs in np.unique(least).tolist():
        at = np.flatnonzero(least == longs)
        rows, where = np.unique(np.concatenate([x[at], y[at]]), return_inverse=True)
        bits = np.stack([folded(np.frombuffer(sketches[r], np.uint64), longs) for r in rows.tolist()])
        differ = np.zeros(len(at), np.int64)
        for k in range(longs):  # one long of all pairs at a time
            differ += np.bitwise_count(bits[where[:len(at)], k] ^ bits[where[len(at):], k])
        keep[at] = (100 + PERCENT) * differ <= (100 - PERCENT) * total[at]
    return keep


def _meeting(entry: DataFrame, nearest: bool, block: int) -> DataFrame:
    """key, u, v, un, vn, up, vp, differ: members of one list and of different
    components that no bound keeps apart, nor their sketches, if ``entry`` has
    them; ``nearest``: of each member and list only the one that differs least
    in its bits, so no more rows than members. Sorted lists are read in a stream
    that holds two blocks at most."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            col = {c: t.column(c).to_numpy(zero_copy_only=False) for c in t.schema.names if c != "sketch"}
            sketches = t.column("sketch").to_pylist() if "sketch" in t.schema.names else None
            sid, n, pos = col["sid"], col["n"], col["pos"]
            found = _pairs_of([col["key"], col["a"], col["b"]], col["root"], col["blk"], n, pos, np.stack([col[x] for x in BITS]).view(np.uint64))
            if nearest:
                best = np.full(len(sid), np.iinfo(np.int64).max)
                for x, y, differ in found:
                    best[x] = np.minimum(best[x], differ << 32 | y)
                    best[y] = np.minimum(best[y], differ << 32 | x)
                x = np.flatnonzero(best < np.iinfo(np.int64).max)
                found = [(x, best[x] & 0xFFFFFFFF, best[x] >> 32)]
            for x, y, differ in found:
                if sketches is not None:
                    ok = _by_sketch(sketches, x, y, n[x].astype(np.int64) + n[y])
                    x, y, differ = x[ok], y[ok], differ[ok]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (col["key"][x], sid[x], sid[y], n[x], n[y], pos[x], pos[y], differ)],
                                                 ["key", "u", "v", "un", "vn", "up", "vp", "differ"])

        held: list[pa.RecordBatch] = []  # of the group under way
        for b in batches:
            if b.num_rows == 0:
                continue
            cut = np.zeros(b.num_rows, bool)
            for c in ("key", "a", "b"):
                v = b.column(c).to_numpy()
                cut[1:] |= v[1:] != v[:-1]
                cut[0] |= bool(held) and held[-1].column(c)[-1].as_py() != v[0]
            if cut.any():
                last = int(np.flatnonzero(cut)[-1])
                yield from work(pa.concat_batches([*held, b.slice(0, last)]))
                held, b = [], b.slice(last)
            held.append(b)
        if held:
            yield from work(pa.concat_batches(held))

    n = int(entry.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(entry, block).repartition(n, "key", "a", "b").sortWithinPartitions("key", "a", "b")
    return dealt.mapInArrow(run, "key long, u long, v long, un int, vn int, up int, vp int, differ long")


def _nearest(meeting: DataFrame) -> DataFrame:
    """u, v: for each member the one that differs least over all its lists."""
    return meeting.groupBy("u").agg(F.min(F.struct("differ", "v")).alias("b")) \
        .select(F.least("u", "b.v").alias("u"), F.greatest("u", "b.v").alias("v")).distinct()


def _candidates(meeting: DataFrame) -> DataFrame:
    """u, v: pairs to check. Both orders being one, the token lists in which a
    pair meets are its first shared tokens; what follows the last of them can
    add no more than either set has left. Pairs of 2-subset lists only stay."""
    swap = F.col("u") > F.col("v")
    least = [F.when(swap, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("u", "v"), ("un", "vn"), ("up", "vp"))]
    most = [F.when(swap, F.col(a)).otherwise(F.col(b)).alias(b) for a, b in (("u", "v"), ("un", "vn"), ("up", "vp"))]
    token = F.col("up") >= 0
    return meeting.select(*least, *most).groupBy("u", "v", "un", "vn").agg(
        F.sum(token.cast("int")).alias("shared"), F.max("up").alias("up"), F.max("vp").alias("vp")) \
        .filter((F.col("shared") == 0) | (F.col("shared") + F.least(F.col("un") - 1 - F.col("up"), F.col("vn") - 1 - F.col("vp"))
                                          >= _need("un", "vn"))).select("u", "v")


def _bitmap(keys: DataFrame, name: str) -> np.ndarray:
    """Slots of the longs ``name``; others that share a slot are dropped by the join that follows."""
    slot = F.col(name).bitwiseAND((1 << BITMAP) - 1)
    marks = keys.select(F.shiftright(slot, 3).alias("byte"), F.expr(f"shiftleft(1, cast({name} & 7 as int))").alias("bit")) \
        .groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2^(BITMAP - 3) rows
    bitmap = np.zeros(1 << (BITMAP - 3), np.uint8)
    if marks.num_rows:
        bitmap[np.asarray(marks.column("byte").combine_chunks())] = np.asarray(marks.column("bits").combine_chunks())
    return bitmap


def _hits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & ((1 << BITMAP) - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _sketches(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """sid, n, sketch of the distinct ``wanted`` sids. A fixed-size bitmap of
    these spares the other members' sketches the shuffle."""
    shared = wanted.sparkSession.sparkContext.broadcast(_bitmap(wanted, "sid"))

    def may(sid: pa.Array) -> pa.Array:
        return pa.array(_hits(shared.value, np.asarray(sid.fill_null(0))))

    may.__annotations__ = {"sid": pa.Array, "return": pa.Array}  # read when the function is declared
    few = members.select("sid", "n", "sketch").filter(F.col("sid").isNotNull()).filter(F.arrow_udf(may, "boolean")("sid"))
    return few.join(wanted, "sid").groupBy("sid").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"))  # equal sets have equal sketches


def _with_sketches(entry: DataFrame, met: DataFrame, members: DataFrame) -> DataFrame:
    """``entry`` without members that met none (``met``: key, sid), with sketches."""
    entry = stored(entry.join(_side(met), ["key", "sid"], "left_semi"), "dense-lists")
    return entry.join(_sketches(members, entry.select("sid").distinct()).select("sid", "sketch"), "sid")


def _close(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Those of ``pairs`` that the sketches don't keep apart: what is left for
    the exact check, and for the tokens to travel."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = np.asarray(b.column(2)).astype(np.int64) + np.asarray(b.column(4))
            differ = np.zeros(b.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(b.column(3).to_pylist(), b.column(5).to_pylist())):
                x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
                differ[i] = np.bitwise_count(x ^ folded(y, len(x))).sum()
            yield b.select(["u", "v"]).filter(pa.array((100 + PERCENT) * differ <= (100 - PERCENT) * total))

    known = _sketches(members, _ends(pairs).distinct())
    both = pairs
    for end in ("u", "v"):
        both = both.join(known.select(F.col("sid").alias(end), F.col("n").alias(f"{end}n"), F.col("sketch").alias(f"{end}s")), end)
    both = both.select("u", "v", "un", "us", "vn", "vs")
    return stored(both.mapInArrow(run, "u long, v long"), "close-pairs")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v set ids) whose sets are similar enough, exactly."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                o = int((y[at] == x).sum())
                keep[i] = 100 * o >= PERCENT * (len(x) + len(y) - o)
            yield b.select(["u", "v"]).filter(pa.array(keep))

    both = pairs.join(sets.select(F.col("sid").alias("v"), F.col("tokens").alias("y")), "v") \
        .join(sets.select(F.col("sid").alias("u"), F.col("tokens").alias("x")), "u").select("u", "v", "x", "y")
    return both.mapInArrow(run, "u long, v long")


def _sets(docs: DataFrame, members: DataFrame, wanted: DataFrame) -> DataFrame:
    """sid, tokens of the ``wanted`` sets, computed anew from one text each. A
    fixed-size bitmap of their rows spares the other texts the work and the
    shuffle; false hits are dropped by the join."""
    reps = members.join(wanted.select("sid").distinct(), "sid").groupBy("sid").agg(F.min("row").alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(reps, "row"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = WordHashes(), shared.value
        for b in chunks(batches, at_once=AT_ONCE):
            b = b.filter(pa.array(_hits(bits, np.asarray(b.column(0)))))
            if b.num_rows:
                sets = shingle_sets(b.column(1), table)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["row", "sid", "tokens"])

    found = docs.select(row_key().alias("row"), "text").mapInArrow(run, "row long, sid long, tokens binary")
    reps = reps.withColumnRenamed("row", "rep")  # the rows compared after a join on sid alone: what follows needs no other exchange
    return stored(found.join(reps, "sid").filter(F.col("row").bitwiseXOR(F.col("rep")) == 0)
                  .select("sid", "tokens").dropDuplicates(["sid"]), "sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("sid")).unionByName(pairs.select(F.col("v").alias("sid")))


def _rooted(docs: DataFrame, list_part: int = LIST_PART, block: int = BLOCK) -> DataFrame:
    """doc_id, row (by ``row_key``), n and root of every row; the root is null
    where there are no shingles."""
    members, counters = _documents(docs)
    limit = boundary(counters)
    lists = stored(_lists(_entries(docs, counters, limit, list_part)), "lists")
    bits = members.filter(F.col("sid").isNotNull()).groupBy("sid").agg(*[F.min(x).alias(x) for x in BITS])

    def side(name: str) -> DataFrame:
        return bits.select(F.col("sid").alias(name), *[F.col(x).alias(f"{name}_{x}") for x in BITS])

    # Round 1: each member and the star it shares most lists with, of those that no bound keeps apart.
    stars = lists.filter("sid != hub").groupBy("hub", "sid").agg(F.count("*").alias("shared"), F.max("n").alias("n"), F.max("hub_n").alias("hub_n")) \
        .filter(_may_link(F.col("shared"), "n", "hub_n", limit)).join(side("sid"), "sid").join(side("hub"), "hub")
    differ = sum((F.bit_count(F.col(f"sid_{x}").bitwiseXOR(F.col(f"hub_{x}"))) for x in BITS), F.lit(0))
    best = stars.filter((100 + PERCENT) * differ <= (100 - PERCENT) * (F.col("n") + F.col("hub_n"))) \
        .groupBy("sid").agg(F.max(F.struct("shared", "hub")).alias("b")).select(F.col("b.hub").alias("u"), F.col("sid").alias("v"))
    tried = stored(best.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "stars")
    close = _close(tried, members)
    edges = stored(_linked(close, _sets(docs, members, _ends(close))), "links")
    roots = components(edges)

    # Members of one list that are still apart: first each with its nearest, then all that are left. Lists
    # without two that no bound keeps apart have none later either, so only the others are read again.
    entry = lists.filter("sid != hub").select("key", "sid", "n", "pos").unionByName(
        lists.select("key", F.col("hub").alias("sid"), F.col("hub_n").alias("n"), F.col("hub_pos").alias("pos")).distinct())
    entry = entry.join(bits, "sid")
    for nearest in (True, False):
        entry = stored(entry.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid")), "entries")
        if nearest:
            meeting = stored(_meeting(entry, nearest, block).select("key", "u", "v", "differ"), "nearest")
            live = stored(meeting.groupBy("key").agg((F.count("*") > DENSE).alias("dense")), "live-lists")
            entry = entry.drop("root").join(_side(live), "key")
            met = meeting.join(_side(live.filter("dense").select("key")), "key", "left_semi").select("key", F.col("u").alias("sid")).distinct()
            met = stored(met, "met")
        else:
            meeting = _meeting(entry.filter("not dense").drop("dense"), nearest, block)
            if met.limit(1).count():
                dense = _with_sketches(entry.filter("dense").drop("dense"), met, members)
                meeting = meeting.unionByName(_meeting(dense, nearest, block))
        pairs = stored((_nearest(meeting) if nearest else _candidates(meeting)).join(tried, ["u", "v"], "left_anti"), "cross-pairs")
        close = _close(pairs, members)
        found = stored(_linked(close, _sets(docs, members, _ends(close))), "links")
        if found.limit(1).count():
            edges = edges.unionByName(found)
            roots = components(edges)
        tried = tried.unionByName(pairs)

    return members.join(roots.withColumnRenamed("node", "sid"), "sid", "left") \
        .select("doc_id", "row", "n", F.coalesce("root", "sid").alias("root"))


def link_components(docs: DataFrame, list_part: int = LIST_PART, block: int = BLOCK) -> DataFrame:
    """doc_id, row (by ``row_key``), n_shingles and component_id of every row."""
    rooted = _rooted(docs, list_part, block)
    first = rooted.filter(F.col("root").isNotNull()).groupBy("root").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies")).filter("copies > 1").select("root", "least")
    return rooted.join(first, "root", "left").select(
        "doc_id", "row", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns: of each component one row, of the least
    doc_id (null last, then by ``row_key``). Rows that link with nothing, and
    rows without shingles, all stay."""
    keys = stored(_rooted(docs).filter(F.col("root").isNotNull()).groupBy("row").agg(
        F.min("root").alias("root"), F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), "row-keys")
    least = keys.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least")) \
        .select("root", F.col("least.row").alias("least"))
    marks = keys.join(least, "root").filter("row != least or copies > 1").select("row", (F.col("row") == F.col("least")).alias("least"))
    marks = stored(marks, "row-marks")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    keyed = docs.select(own, row_key().alias("row"))
    alone = keyed.join(marks.select("row"), "row", "left_anti").select("own.*")
    # rows that repeat: the number tells them apart once it is stored
    again = stored(keyed.join(marks.filter("least").select("row"), "row", "left_semi")
                   .withColumn("number", F.monotonically_increasing_id()), "repeated-rows")
    first = again.groupBy("row").agg(F.min("number").alias("number")).select("number")
    return alone.unionByName(again.join(first, "number", "left_semi").select("own.*"))
