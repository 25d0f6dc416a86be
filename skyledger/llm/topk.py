"""Exact top-k search by inner product over an impact-ordered index, score at
a time.

The index keeps, for blocks of BLOCK vectors, one posting list per dimension
cut into segments of one quantised value. A query meets a block's segments by
falling impact (its component times the segment's bound) and adds one number
per posting. What a vector may still gain is bounded by what remains of each
list and by the quantisation; processing stops when the vectors that this
bound leaves as possible members are few, and those are rescored exactly, so
the result is that of a full scan. Query rows are met in blocks as well;
every (index block, query block) pair is a task's row of bounded size.

Defined results: vectors that are null, hold a null or a number that is not
finite, or lack an id, take no part; a shorter vector counts as padded with
zeros; rows that repeat are candidates of their own; fewer than ``k``
candidates are all returned; ties go to the smaller id; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCK, QUERIES, LEVELS, FEW = 16384, 512, 16, 64


def _blocks(rows: DataFrame, size: int, index: bool) -> tuple[DataFrame, int]:
    """block, ids, rows, dims, x (int32 matrix), and for an index block shift
    and, by dimension, postings in order of level and the levels' ends; and the
    number of blocks."""
    n = rows.count()
    blocks = max(1, -(-n // size))

    def build(t: pa.Table) -> pa.Table:
        vectors = t.column("v").combine_chunks()
        sizes = np.diff(np.asarray(vectors.offsets))
        dims = int(sizes.max())
        x = np.zeros((len(sizes), dims), np.int32)
        flat = np.asarray(vectors.values)[vectors.offsets[0].as_py():]
        x[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes])] = flat[:sizes.sum()]
        shift, order, ends = 0, b"", b""
        if index and dims:
            spread = int(x.max()) - int(x.min())
            shift = max(0, (spread // LEVELS).bit_length())
            level = x >> shift
            low = int(level.min())
            by = np.argsort(level, axis=0, kind="stable").T.astype(np.uint16)
            end = np.stack([np.searchsorted(level[by[d], d], np.arange(low, int(level.max()) + 1), "right") for d in range(dims)])
            order, ends = by.tobytes(), np.concatenate([[low, end.shape[1]], end.ravel()]).astype(np.int32).tobytes()
        return pa.table({
            "block": pa.array([t.column("block")[0].as_py()], pa.int32()),
            "ids": [np.asarray(t.column("id").combine_chunks()).tobytes()], "rows": [np.asarray(t.column("row").combine_chunks()).tobytes()],
            "dims": pa.array([dims], pa.int32()), "x": [x.tobytes()], "shift": pa.array([shift], pa.int32()),
            "postings": [order], "ends": [ends]})

    made = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).groupBy("block").applyInArrow(
        build, "block int, ids binary, rows binary, dims int, x binary, shift int, postings binary, ends binary")
    return made, blocks


class IndexBlock:
    def __init__(self, x: bytes, dims: int, shift: int, postings: bytes, ends: bytes):
        self.x = np.frombuffer(x, np.int32).reshape(-1, dims) if dims else np.zeros((0, 0), np.int32)
        self.dims, self.step = dims, 1 << shift
        if dims:
            head = np.frombuffer(ends, np.int32)
            self.low, levels = int(head[0]), int(head[1])
            self.ends = head[2:].reshape(dims, levels)
            self.begins = np.concatenate([np.zeros((dims, 1), np.int32), self.ends[:, :-1]], 1)
            self.by = np.frombuffer(postings, np.uint16).reshape(dims, -1)
            self.bottom = (np.arange(levels) + self.low) * self.step  # least value of each level

    def possible(self, q: np.ndarray, k: int, own: int, n: int) -> np.ndarray:
        """Places, of ``n``, of all vectors that may be among the ``k`` best (``own`` is out)."""
        if not self.dims:
            return np.delete(np.arange(n), [own] if own >= 0 else [])
        q = q.astype(np.int64)
        full = self.ends > self.begins
        a, b = q[:, None] * self.bottom, q[:, None] * (self.bottom + self.step - 1)
        least, most = np.minimum(a, b), np.maximum(a, b)
        floor = np.where(full, least, 1 << 60).min(1)
        impact = np.where(full & (q[:, None] != 0), most - floor[:, None], -1)  # a posting's greatest gain over the list's worst
        segments = np.argsort(-impact, axis=None, kind="stable")[:int((impact >= 0).sum())]
        gain = (least - floor[:, None]).ravel()
        dim, begin, end = segments // impact.shape[1], self.begins.ravel()[segments], self.ends.ravel()[segments]
        slack = np.abs(q) * (self.step - 1)
        value = impact.ravel()[segments]
        score = np.zeros(n, np.int64)
        if own >= 0:
            score[own] = -(1 << 60)
        worth, starts = gain[segments].tolist(), begin.tolist()
        stops, dims = end.tolist(), dim.tolist()
        by, check = self.by, max(16, len(segments) // 8)
        for t in range(len(segments)):
            if worth[t]:
                score[by[dims[t], starts[t]:stops[t]]] += worth[t]
            if (t + 1) % check == 0 or t + 1 == len(segments):
                ahead = np.zeros(len(q), np.int64)
                np.maximum.at(ahead, dim[t + 1:], value[t + 1:])
                rest = int(np.maximum(ahead, slack).sum())
                bar = np.partition(score, n - k)[n - k] if n > k else -(1 << 59)
                may = np.flatnonzero(score + rest >= max(bar, -(1 << 59)))
                if len(may) <= FEW or t + 1 == len(segments):
                    return may
        return np.flatnonzero(score > -(1 << 59))


def top_k(vectors: DataFrame, query: Column, k: int = 5) -> DataFrame:
    """query_row, query_id, rank, vec_id, score: for every row of ``vectors``
    (vec_id, v array<int>, null where it takes no part) that meets ``query``,
    its ``k`` best others."""
    rows = stored(vectors.filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), "v",
        query.alias("asks")), "vectors")
    index, n_blocks = _blocks(rows.select("id", "row", "v"), BLOCK, True)
    asked, n_asks = _blocks(rows.filter("asks").select("id", "row", "v"), QUERIES, False)
    index = stored(index, "impact-index").withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(n_asks - 1))))
    asked = stored(asked, "queries").withColumnRenamed("block", "ask") \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def search(block: pa.Table, ask: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and ask.num_rows:
            have, want = block.to_pylist()[0], ask.to_pylist()[0]
            index = IndexBlock(*(have[c] for c in ("x", "dims", "shift", "postings", "ends")))
            ids, rows = (np.frombuffer(have[c], np.int64) for c in ("ids", "rows"))
            q_ids, q_rows = (np.frombuffer(want[c], np.int64) for c in ("ids", "rows"))
            asks = np.frombuffer(want["x"], np.int32).reshape(len(q_ids), -1)
            asks = np.pad(asks, ((0, 0), (0, max(0, index.dims - asks.shape[1]))))[:, :index.dims]
            place = {v: i for i, v in enumerate(rows.tolist())}
            for me, my_row, q in zip(q_ids.tolist(), q_rows.tolist(), asks):
                may = index.possible(q, k, place.get(my_row, -1), len(ids))
                exact = index.x[may].astype(np.int64) @ q.astype(np.int64) if index.dims else np.zeros(len(may), np.int64)
                best = np.lexsort((rows[may], ids[may], -exact))[:k]
                out += [(my_row, me, int(rows[may[i]]), int(ids[may[i]]), int(exact[i])) for i in best]
        cols = list(zip(*out)) or [()] * 5
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_row", "query_id", "row", "vec_id", "score"), cols)})

    found = index.groupBy("block", "ask").cogroup(asked.groupBy("block", "ask")).applyInArrow(
        search, "query_row long, query_id long, row long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_row", "query_id", "rank", "vec_id", "score")


def scaled(embedding: Column) -> Column:
    """floor(256 x) of every component; null if the vector takes no part."""
    x = F.transform(embedding, lambda e: F.floor(e.cast("double") * 256).cast("int"))
    bad = F.exists(embedding, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    return F.when(embedding.isNotNull() & ~bad, x)
