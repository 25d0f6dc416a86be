"""Substring dedup on spans of sentences.

A text is cut into sentences (after ., !, ? and white space, after a CJK full
stop, or at a line end); sentences of over LONG words, such as unpunctuated
text, are cut further after the word of least hash in each run of WINDOW
words, so equal passages are cut alike and no two cuts are over WINDOW words
apart. In scripts without blanks each letter counts as a word. A span is the shortest run of at least MIN_SENTENCES sentences and
MIN_WORDS words that begins, or that ends, at a sentence. Spans are hashed and
joined globally: one hash of each is counted first, a bitmap of fixed size of
those that repeat then spares most others the shuffle, and what is left is
joined by two hashes of 96 bits together. Sentences covered by a span that occurred before (in a lower
doc_id, or earlier in its own text) are removed, the rest is kept as it is.

Defined results: null and empty texts have no sentences and stay; texts too
short for a span stay; letter case and white space don't count in comparing;
a null doc_id comes after all others; rows that agree in doc_id and text are
one document and keep the same; a very long text is cut and hashed whole; other
columns pass through untouched; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS_KEPT, chunks, lean, lists, mix64, row_key, stored

MIN_SENTENCES, MIN_WORDS, LONG, WINDOW = 3, 16, 24, 8
#: Slots (2^BITMAP) of the bitmap of hashes that repeat; others that share a slot go on and are dropped by the join.
BITMAP = 25
AT_ONCE = 1_000_000  # bytes of text a worker cuts together

_ENDS = re.compile(r"[.!?。！？｡]+[\"'»”’)\]]*\s+|[.!?]*[。！？｡][.!?。！？｡]*[\"'»”’)\]」』）】》〉]*\s*|\s*\n\s*")
#: Letters of scripts without blanks (Thai, Lao, Tibetan, Myanmar, Khmer, kana,
#: Han) and the marks that stay with them.
_RANGES = [(0xE00, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
           (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x323AF)]
_MARKS = "".join(chr(c) for a, z in _RANGES for c in range(a, min(z, 0x3100) + 1) if unicodedata.category(chr(c))[0] == "M")
_LETTERS = "".join(f"{chr(a)}-{chr(z)}" for a, z in _RANGES)
_CLOSE = re.compile(f"[{_LETTERS}]")
_PLAIN = re.compile(r"\S+\s*")
_WORD = re.compile(rf"(?:[{_LETTERS}][{_MARKS}]*|[^\s{_LETTERS}]+)\s*")


def least_of_windows(h: list[int]) -> set[int]:
    """Place of the least (the last such) of each WINDOW consecutive hashes."""
    out, n, at = set(), len(h), -1
    for i in range(n - WINDOW + 1):
        end = i + WINDOW - 1
        if at < i:
            least = min(h[i:end + 1])
            at = end
            while h[at] != least:
                at -= 1
            out.add(at)
        elif h[end] <= least:
            least, at = h[end], end
            out.add(at)
    return out


class _Hashes(dict):
    """Hash of a word without its white space and case, kept for words seen lately."""

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.strip().lower())
        return h


_HASHES = _Hashes()


def sentences(text: str) -> list[str]:
    """Pieces that join to ``text`` again."""
    close = not text.isascii() and _CLOSE.search(text) is not None
    find = _WORD.findall if close else _PLAIN.findall
    cuts = [0, *[m.end() for m in _ENDS.finditer(text)]]
    if cuts[-1] < len(text):
        cuts.append(len(text))
    out = []
    for a, b in zip(cuts, cuts[1:]):
        piece = text[a:b]
        if len(piece) <= (LONG if close else 2 * LONG) or not close and len(piece.split()) <= LONG or len(words := find(piece)) <= LONG:
            out.append(piece)
            continue
        held = piece[:len(piece) - sum(map(len, words))]
        ends = least_of_windows(list(map(_HASHES.__getitem__, words)))
        at = 0
        for k in sorted(ends):
            out.append(held + "".join(words[at:k + 1]))
            held, at = "", k + 1
        if at < len(words):
            out.append("".join(words[at:]))
    return out


_P = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
_P_INVERSE = [np.uint64(pow(int(p), -1, 1 << 64)) for p in _P]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, two 64-bit hashes) of every span of a text's sentences."""
    import xxhash
    n, digest = len(pieces), xxhash.xxh3_128_digest
    text = "".join(pieces)
    close = not text.isascii() and _CLOSE.search(text) is not None
    split = [p.lower().split() for p in pieces]
    counts = [len(_WORD.findall(p)) for p in pieces] if close else list(map(len, split))
    words = np.concatenate([[0], np.cumsum(counts)])
    units = np.frombuffer(b"".join([digest(" ".join(w)) for w in split]), ">u8").reshape(-1, 2)
    i = np.arange(n)
    end = np.maximum(i + MIN_SENTENCES, np.searchsorted(words, words[:-1] + MIN_WORDS))  # spans that begin at i
    first = np.minimum(i + 1 - MIN_SENTENCES, np.searchsorted(words, words[1:] - MIN_WORDS, "right") - 1)  # that end at i
    spans = np.concatenate([np.stack([i, end], 1)[end <= n], np.stack([first, i + 1], 1)[first >= 0]])
    begin, end = np.divmod(np.unique(spans[:, 0] * (n + 1) + spans[:, 1]), n + 1)
    out = []
    for p, inverse, half in zip(_P, _P_INVERSE, (1, 0)):
        unit = units[:, half].astype(np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(unit * _powers(p, n), dtype=np.uint64)])
        out.append(mix64((sums[end] - sums[begin]) * _powers(inverse, n + 1)[begin] + (end - begin).astype(np.uint64)))
    return begin, end, out[0].view(np.int64), out[1].view(np.int64)


def _spans(docs: DataFrame) -> DataFrame:
    """row, n (sentences), spans (first occurrence in the text of each hash; of
    the second hash the lower 32 bits, which halves what it takes on disk) and again (spans that occurred earlier in the same text)."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, at_once=AT_ONCE):
            sizes, cols, n_again, again = [], [], [], []
            counts = []
            for text in b.column(2).to_pylist():
                pieces = sentences(text) if text else []
                counts.append(len(pieces))
                if len(pieces) < MIN_SENTENCES:
                    sizes.append(0)
                    n_again.append(0)
                    continue
                begin, end, h1, h2 = span_hashes(pieces)
                _, at = np.unique(h1, return_index=True)
                new = np.zeros(len(h1), bool)
                new[at] = True
                cols.append(np.stack([h1[new], h2[new], begin[new], end[new]]))
                again.append(np.stack([begin[~new], end[~new]]))
                sizes.append(int(new.sum()))
                n_again.append(int((~new).sum()))
            flat = np.concatenate([np.empty((4, 0), np.int64), *cols], 1)
            rest = np.concatenate([np.empty((2, 0), np.int64), *again], 1)
            kept = pa.StructArray.from_arrays([pa.array(flat[0]), pa.array(flat[1].astype(np.int32)), pa.array(flat[2], pa.int32()),
                                               pa.array(flat[3], pa.int32())], ["h1", "h2", "begin", "end"])
            twice = pa.StructArray.from_arrays([pa.array(rest[k], pa.int32()) for k in (0, 1)], ["begin", "end"])
            ends = lambda s: pa.array(np.concatenate([[0], np.cumsum(s)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(counts, pa.int32()), pa.ListArray.from_arrays(ends(sizes), kept),
                 pa.ListArray.from_arrays(ends(n_again), twice)], ["doc_id", "row", "n", "spans", "again"])

    return docs.select("doc_id", row_key().alias("row"), "text").mapInArrow(
        run, "doc_id long, row long, n int, spans array<struct<h1: bigint, h2: int, begin: int, end: int>>, "
             "again array<struct<begin: int, end: int>>")


def _bitmap(found: DataFrame) -> np.ndarray:
    """Slots of the first hashes that occur more than once."""
    slot = F.col("h1").bitwiseAND((1 << BITMAP) - 1)
    words = found.select(F.explode("spans.h1").alias("h1")).groupBy("h1").agg(F.count("*").alias("n")).filter("n > 1") \
        .groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h1 & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << BITMAP - 6, np.int64)  # at most 2^(BITMAP - 6) rows
    out[np.asarray(words.column("word").combine_chunks())] = np.asarray(words.column("bits").combine_chunks())
    return out.view(np.uint8)


def _likely(found: DataFrame) -> DataFrame:
    """doc_id, row, h1, h2, begin, end of the spans whose slot is in the bitmap."""
    shared = found.sparkSession.sparkContext.broadcast(_bitmap(found))  # 2^(BITMAP - 3) bytes

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in batches:
            spans = b.column(2)
            flat = spans.flatten()
            h1 = np.asarray(flat.field("h1"))
            slot = h1 & ((1 << BITMAP) - 1)
            keep = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
            if not len(keep):
                continue
            of = pa.array(np.repeat(np.arange(b.num_rows), np.asarray(spans.value_lengths().fill_null(0)))[keep])
            at = pa.array(keep)
            yield pa.RecordBatch.from_arrays([b.column(0).take(of), b.column(1).take(of), *[flat.field(c).take(at) for c in ("h1", "h2", "begin", "end")]],
                                             ["doc_id", "row", "h1", "h2", "begin", "end"])

    return found.select("doc_id", "row", "spans").mapInArrow(run, "doc_id long, row long, h1 long, h2 int, begin int, end int")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """row, n (sentences), remove: the (begin, end) runs of sentences to
    remove, null if none, for each row of ``docs`` by ``row_key``."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    found = stored(_spans(docs), "spans")
    spans = _likely(found)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row")  # orders documents
    # a hash occurs once a row here
    firsts = spans.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("rows")).filter("rows > 1") \
        .select("h1", "h2", F.col("first.row").alias("first"))
    later = spans.join(firsts, ["h1", "h2"]).filter(F.col("row") != F.col("first")).select("row", F.struct("begin", "end").alias("s"))
    again = found.filter(F.size("again") > 0).select("row", F.explode("again").alias("s"))
    remove = later.unionByName(again).groupBy("row").agg(F.collect_set("s").alias("remove"))
    return found.groupBy("row").agg(F.max("n").alias("n")).join(remove, "row", "left")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``own`` (all columns of ``docs`` as they are), text without its repeated
    sentences, n_sentences and n_removed, for every row of ``docs``."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    plain = docs.select("doc_id", "text")
    keyed = docs.select(own, row_key().alias("row")).join(repeated_spans(plain), "row")  # a text travels once, in ``own``
    whole = F.col("own.text")

    def run(texts: pa.Array, begins: pa.Array, ends: pa.Array) -> pa.Array:
        kept, gone = [], []
        for text, b, e in zip(*(c.to_pylist() for c in (texts, begins, ends))):
            drop = set()
            for i, j in zip(b or [], e or []):
                drop.update(range(i, j))
            kept.append("".join(p for k, p in enumerate(sentences(text)) if k not in drop) if drop else None)
            gone.append(len(drop))
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(gone, pa.int64())], ["text", "gone"])

    run.__annotations__ = {"texts": pa.Array, "begins": pa.Array, "ends": pa.Array, "return": pa.Array}  # read when the function is declared
    some = F.col("remove").isNotNull()
    cut = F.arrow_udf(run, "struct<text: string, gone: bigint>")(F.when(some, whole), F.col("remove.begin"), F.col("remove.end"))
    return keyed.withColumn("cut", cut).select(
        "own", F.when(some, F.col("cut.text")).otherwise(whole).alias("text"),
        F.col("n").cast("long").alias("n_sentences"), F.col("cut.gone").alias("n_removed"))
