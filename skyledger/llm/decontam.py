"""Benchmark decontamination by winnowing.

Of the hashes of GRAM consecutive words, the smallest of every ``span - GRAM +
1`` neighbours is kept (the rightmost, if equal), so any ``span`` words that a
document shares with a benchmark item share a kept hash. Kept hashes of both
sides are joined and each meeting is extended word by word; what reaches
``span`` words is a hit. Items of fewer than ``span`` words are too short for
that guarantee: their whole run of words is looked up at every position.

A bitmap of the benchmark's hashes (2^BITMAP bits whatever its size) lets
documents send only hashes that may meet; it saves shuffle, not results.

Defined results: null text and text without words have no words and no hits;
items without words hit nothing; items with a null id hit words but are not
listed; repeated items list their id once; repeated rows are judged alike and
each gives a row; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, chunks, grams, lean, lists, signed, stored

GRAM, BITMAP = 5, 23
AT_ONCE = 1_000_000  # bytes of text a worker cuts together

#: A-Z to a-z, and every byte that is not of [0-9a-z] or a character beyond ASCII to a space.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def word_lists(column: pa.Array) -> list[list[bytes]]:
    return [t.translate(_WORDS).split() if t else [] for t in column.cast(pa.binary()).to_pylist()]


def winnowed(h: np.ndarray, left: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions in concatenated texts; ``left`` is the
    number of words from each position to the end of its text."""
    g = grams(h, GRAM)
    width = span - GRAM + 1
    n = len(g) - width + 1
    if n <= 0:
        return g[:0], np.empty(0, np.int64)
    least, at = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, width):
        lower = g[j:j + n] <= least
        least[lower] = g[j:j + n][lower]
        at[lower] = j
    inside = left[:n] >= span
    kept = np.zeros(len(g), bool)
    kept[(np.arange(n) + at)[inside]] = True
    pos = np.flatnonzero(kept)
    return g[pos], pos


_HITS = "array<struct<fp: bigint, pos: int, l: array<bigint>, r: array<bigint>>>"


def _fingerprints(rows: DataFrame, key: str, span: int, short: list[int], bitmap: np.ndarray | None) -> DataFrame:
    """key, n_words, need and hits (fp, pos, words to the left, words from pos)
    of every row. Without a bitmap (the benchmark) a text of fewer than
    ``span`` words is one run; with one, only hashes in it are given, and runs
    of each ``short`` length are looked up as well."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)  # 2^BITMAP bits

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = WordHashes(), shared.value
        for b in chunks(batches, at_once=AT_ONCE):
            words = word_lists(b.column(1))
            sizes = np.array([len(w) for w in words], np.int64)
            h = table.of([w for ws in words for w in ws])
            ends = np.repeat(np.cumsum(sizes), sizes)
            begins = ends - np.repeat(sizes, sizes)
            left = ends - np.arange(len(h))
            fp, pos = winnowed(h, left, span)
            reach = np.full(len(pos), span)
            for m in short if bits is not None else range(1, span):
                g = grams(h, m)
                ok = left[:len(g)] >= m
                if bits is None:  # the whole of a short item
                    ok &= (begins[:len(g)] == np.arange(len(g))) & (left[:len(g)] == m)
                at = np.flatnonzero(ok)
                fp, pos = np.concatenate([fp, g[at]]), np.concatenate([pos, at])
                reach = np.concatenate([reach, np.full(len(at), m)])
            if bits is not None and len(fp):
                slot = fp & np.uint64((1 << BITMAP) - 1)
                may = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
                fp, pos, reach = fp[may], pos[may], reach[may]
            order = np.argsort(pos, kind="stable")
            fp, pos, reach = fp[order], pos[order], reach[order]
            back = np.minimum(np.where(reach == span, span - GRAM, 0), pos - begins[pos] if len(pos) else 0)
            ahead = np.minimum(reach, left[pos] if len(pos) else 0)
            hs = signed(h)
            ls = [hs[p - n:p][::-1] for p, n in zip(pos, back)]
            rs = [hs[p:p + n] for p, n in zip(pos, ahead)]
            none = np.empty(0, np.int64)
            hits = pa.StructArray.from_arrays(
                [pa.array(signed(fp)), pa.array(pos - (begins[pos] if len(pos) else 0), pa.int32()),
                 lists(np.concatenate([none, *ls]), [len(x) for x in ls], pa.int64()),
                 lists(np.concatenate([none, *rs]), [len(x) for x in rs], pa.int64())], ["fp", "pos", "l", "r"])
            offsets = np.searchsorted(pos, np.concatenate([[0], np.cumsum(sizes)])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes), pa.array(np.minimum(sizes, span).astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(offsets), hits)], ["key", "n_words", "need", "hits"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "text").mapInArrow(run, f"key {kind}, n_words long, need int, hits {_HITS}")


def _agree(a: Column, b: Column) -> Column:
    """How many leading elements two arrays share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")


def covered(spans: Column) -> Column:
    """Number of places in the union of (begin, end) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(F.array_sort(spans), start, lambda s, x: F.struct(
        (s.n + F.greatest(x.end - F.greatest(x.begin, s.end), F.lit(0))).cast("long").alias("n"),
        F.greatest(x.end, s.end).alias("end")))
    return total.n


def find_leaks(docs: DataFrame, benchmark: DataFrame, span: int = 10) -> DataFrame:
    """doc_id, row (key of the row, see ``keyed``), n_words, spans (begin, end
    in words) and items (ids as sorted strings) for every row of ``docs``."""
    items = stored(_fingerprints(benchmark.select("item_id", "text"), "item_id", span, [], None), "benchmark-fp")
    fps = items.select(F.col("key").cast("string").alias("item_id"), "need", F.explode("hits").alias("h")) \
        .select("item_id", "need", "h.fp", F.col("h.l").alias("il"), F.col("h.r").alias("ir")).distinct()
    short = [r.need for r in items.filter(F.col("need").between(1, span - 1)).select("need").distinct().collect()]
    slot = F.col("fp").bitwiseAND((1 << BITMAP) - 1)
    marks = fps.select(F.shiftright(slot, 3).alias("byte"), F.expr("shiftleft(1, cast(fp & 7 as int))").alias("bit")) \
        .groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2^(BITMAP - 3) rows
    bitmap = np.zeros(1 << (BITMAP - 3), np.uint8)
    if marks.num_rows:
        bitmap[np.asarray(marks.column("byte").combine_chunks())] = np.asarray(marks.column("bits").combine_chunks())

    rows = docs.select(F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("id"), "text")
    found = stored(_fingerprints(rows, "id", span, sorted(short), bitmap), "document-fp")
    hits = found.select(F.col("key.row").alias("row"), F.explode("hits").alias("h")) \
        .select("row", "h.fp", "h.pos", F.col("h.l").alias("dl"), F.col("h.r").alias("dr"))
    met = hits.join(fps, "fp").withColumn("back", _agree(F.col("dl"), F.col("il"))) \
        .withColumn("ahead", _agree(F.col("dr"), F.col("ir"))) \
        .filter((F.col("ahead") >= F.least(F.lit(GRAM), "need")) & (F.col("back") + F.col("ahead") >= F.col("need")))
    per_row = met.select("row", "item_id", F.struct((F.col("pos") - F.col("back")).alias("begin"),
                                                    (F.col("pos") + F.col("ahead")).alias("end")).alias("span")) \
        .groupBy("row").agg(F.collect_set("span").alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
    return found.select(F.col("key.doc_id").alias("doc_id"), F.col("key.row").alias("row"), "n_words") \
        .join(per_row, "row", "left").select(
            "doc_id", "row", "n_words", F.coalesce("spans", F.array().cast("array<struct<begin: int, end: int>>")).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def report(leaks: DataFrame) -> DataFrame:
    """Counts and digests of ``find_leaks``'s rows."""
    n_hit = covered(F.col("spans"))
    return leaks.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, span: int = 10) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no benchmark span."""
    from .common import row_key
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    keyed = docs.select(own, row_key().alias("row_key"), "text")
    marked = find_leaks(keyed.select(F.col("row_key").alias("doc_id"), "text"), benchmark, span)
    bad = marked.filter(F.size("spans") > 0).select(F.col("doc_id").alias("row_key")).distinct()
    return keyed.join(bad, "row_key", "left_anti").select("own.*")
