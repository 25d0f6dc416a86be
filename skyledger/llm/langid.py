"""Language identification of mixed-language text.

Letters are split into words of one script; the script's code ranges leave
only the languages seen in that script as candidates. Each word gets a score
per language (log-probabilities of its letter trigrams), and Viterbi with a
penalty for switching labels the words, so a text becomes spans of languages.
The prediction is the language with most letters.

Training counts trigrams in at most SAMPLE_PER_LANG texts of each language,
the first by a hash of their id. Scoring covers every whole text.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and no spans; letters of a script never learned favour no language (ties go to
the first language by name). If nothing can be learned, all texts are ``und``.
Repeated rows are labelled alike; empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, mix64, stored

#: Bounds of what is fitted on the driver.
SAMPLE_PER_LANG, BITS = 1000, 18
#: A sample of more ids is joined by shuffle and not broadcast.
BROADCAST_IDS = 200_000
SWITCH = 12.0  # cost, in nats, of a change of language
TEXT_AT_ONCE = 16_000_000

#: Scripts and their code ranges.
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F),
              (0x250, 0x2AF), (0x1E00, 0x1EFF), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    "Greek": [(0x370, 0x373), (0x376, 0x377), (0x37B, 0x37D), (0x386, 0x386), (0x388, 0x3FF), (0x1F00, 0x1FFC)],
    "Cyrillic": [(0x400, 0x481), (0x48A, 0x52F), (0x1C80, 0x1C88)],
    "Armenian": [(0x531, 0x556), (0x561, 0x587)],
    "Hebrew": [(0x5D0, 0x5EA)],
    "Arabic": [(0x620, 0x64A), (0x66E, 0x66F), (0x671, 0x6D3), (0x750, 0x77F)],
    "Devanagari": [(0x904, 0x939), (0x958, 0x961)],
    "Bengali": [(0x985, 0x9B9), (0x9DC, 0x9E1)],
    "Tamil": [(0xB83, 0xBB9)],
    "Thai": [(0xE01, 0xE30), (0xE40, 0xE46)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7A3)],
    "Hiragana": [(0x3041, 0x3096)],
    "Katakana": [(0x30A1, 0x30FA)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
OTHER = len(SCRIPTS) + 1  # any other letter


def script_table() -> np.ndarray:
    """Script number of each code point (0: not in a range)."""
    table = np.zeros(0x110000, np.uint8)
    for i, ranges in enumerate(SCRIPTS.values(), 1):
        for lo, hi in ranges:
            table[lo:hi + 1] = i
    table[[0x375, 0x37E, 0x387, 0x3F6]] = 0
    return table


class Words:
    """Words of a batch of texts: text number, character span, script; and of
    each letter its word and trigram."""

    def __init__(self, texts: list[str], table: np.ndarray):
        joined = "\n".join(texts) + "\n"
        low = joined.lower()
        if len(low) != len(joined):
            low = "".join(x if len(x := c.lower()) == 1 else c for c in joined)
        code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = table[code]
        unknown = np.flatnonzero((kind == 0) & (code > 127))
        if len(unknown):
            values, back = np.unique(code[unknown], return_inverse=True)
            letter = np.array([chr(c).isalpha() for c in values])
            kind[unknown[letter[back]]] = OTHER
        begins = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)) != 0)
        begins = begins[kind[begins] > 0]
        starts_letter = np.zeros(len(code), bool)
        starts_letter[begins] = True
        self.letters = np.flatnonzero(kind)
        self.first = np.searchsorted(self.letters, begins)  # place of each word's first letter among the letters
        self.count = np.diff(self.first, append=len(self.letters))
        self.script = kind[begins]
        offset = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=offset[1:])
        self.text = np.searchsorted(offset, begins, "right") - 1
        self.begin = begins - offset[self.text]
        self.end = self.begin + self.count
        word = np.repeat(np.arange(len(begins)), self.count)
        c = code[self.letters].astype(np.uint64)
        before, after = np.zeros_like(c), np.zeros_like(c)
        same = word[1:] == word[:-1]
        before[1:][same] = c[:-1][same]
        after[:-1][same] = c[1:][same]
        self.trigram = (mix64((before << np.uint64(42)) | (c << np.uint64(21)) | after) >> np.uint64(64 - BITS)).astype(np.int32)
        self.word = word


def fit(docs: DataFrame, learn: Column) -> dict:
    """The fitted model: langs, a table of trigram scores, and the languages
    of each script. ``learn`` is a condition on the columns of ``docs``."""
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).filter(learn)
    by_hash = F.xxhash64(F.col("doc_id").cast("string"))
    ids = known.select("doc_id", "lang").withColumn("part", F.pmod(by_hash, F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):  # two levels: a task meets at most 64 samples of a language
        first = Window.partitionBy(*keys).orderBy(by_hash, "doc_id")
        ids = ids.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= SAMPLE_PER_LANG)
    ids = ids.select(F.col("doc_id").alias("picked_id"), F.col("lang").alias("picked_lang")).distinct()
    ids = stored(ids, "language-sample")  # at most SAMPLE_PER_LANG rows a language, every language
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    table = script_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            langs = b.column(1).to_pylist()
            words = Words(b.column(0).to_pylist(), table)
            for lang in set(langs):
                mine = np.array([x == lang for x in langs])[words.text]
                grams = words.trigram[mine[words.word]]
                found, n = np.unique(grams, return_counts=True)
                letters = np.bincount(words.script[mine], words.count[mine], OTHER + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(found) + OTHER + 1)),
                     pa.array(np.concatenate([found.astype(np.int64), -1 - np.arange(OTHER + 1)])),
                     pa.array(np.concatenate([n.astype(np.float64), letters]))], ["lang", "gram", "n"])

    rows = known.join(ids, (F.col("doc_id") == F.col("picked_id")) & (F.col("lang") == F.col("picked_lang")))
    # at most 2^BITS + scripts sums a language
    sums = rows.select("text", "lang").mapInArrow(count, "lang string, gram long, n double") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(sums.column("lang").to_pylist()))
    counts, scripts = np.zeros((1 << BITS, len(langs))), np.zeros((OTHER + 1, len(langs)))
    if langs:
        lang = np.searchsorted(np.array(langs), np.array(sums.column("lang").to_pylist()))
        gram, n = (np.asarray(sums.column(c).combine_chunks()) for c in ("gram", "n"))
        counts[gram[gram >= 0], lang[gram >= 0]] = n[gram >= 0]
        scripts[-1 - gram[gram < 0], lang[gram < 0]] = n[gram < 0]
    scores = np.log((counts + 0.1) / (counts.sum(0) + 0.1 * (1 << BITS)))
    scores -= scores.mean(1, keepdims=True) if langs else 0
    candidates = scripts >= 0.01 * np.maximum(scripts.sum(0), 1)
    return {"langs": langs, "scores": scores.astype(np.float32), "candidates": candidates}


def word_scores(words: Words, model: dict) -> np.ndarray:
    """Score of each word for each language; languages never seen in its
    script are out, unless that leaves none."""
    out = np.add.reduceat(model["scores"][words.trigram], words.first, axis=0) if len(words.first) else \
        np.zeros((0, len(model["langs"])), np.float32)
    may = model["candidates"][words.script]
    may |= ~may.any(1, keepdims=True)
    out[~may] = -1e4
    none = ~model["candidates"].any(1)
    out[none[words.script]] = 0
    return out


def viterbi(scores: np.ndarray, sizes: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word. ``sizes``: words of each text, in order. All
    texts advance together, one word a step; finished ones drop out."""
    kind = np.min_scalar_type(scores.shape[1])  # holds every language's number
    labels = np.zeros(len(scores), kind)
    if not len(scores):
        return labels
    begin = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = begin[order], sizes[order]
    alive = len(sizes) - np.searchsorted(sizes[::-1], np.arange(1, sizes[0] + 1))
    back = np.zeros(scores.shape, kind)
    own = np.arange(scores.shape[1], dtype=kind)
    best = scores[begin[:alive[0]]].astype(np.float64)
    last = best.copy()
    for t in range(1, sizes[0]):
        n = alive[t]
        best = best[:n]
        top = best.argmax(1)
        moved = best[np.arange(n), top] - switch
        at = begin[:n] + t
        stay = best >= moved[:, None]
        back[at] = np.where(stay, own, top[:, None])
        best = np.where(stay, best, moved[:, None]) + scores[at]
        last[:n] = best
    label = last.argmax(1).astype(kind)
    for t in range(sizes[0] - 1, -1, -1):
        n = alive[t]
        at = begin[:n] + t
        labels[at] = label[:n]
        label[:n] = back[at, label[:n]] if t else label[:n]
    return labels


def label_spans(docs: DataFrame, model: dict, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score (its share of the letters) and spans
    (begin, end in characters, lang) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS numbers a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = shared.value, script_table()
        langs = model["langs"]
        for b in chunks(batches, at_once=TEXT_AT_ONCE):
            parts, scored = [], []
            base = 0
            for piece in chunks(iter([b]), at_once=1_000_000):
                words = Words([t or "" for t in piece.column(1).to_pylist()], table)
                scored.append(word_scores(words, model))
                parts.append(np.stack([words.text + base, words.begin, words.end]))
                base += piece.num_rows
            text, begin, end = np.concatenate(parts, 1)
            labels = viterbi(np.concatenate(scored), sizes := np.bincount(text, minlength=b.num_rows), switch) \
                if langs else np.zeros(len(text), np.uint8)
            if not langs:
                text, begin, end, labels, sizes = text[:0], begin[:0], end[:0], labels[:0], np.zeros(b.num_rows, np.int64)
            share = np.zeros((b.num_rows, max(1, len(langs))))
            np.add.at(share, (text, labels), end - begin)
            has = sizes > 0
            pred = share.argmax(1)
            score = np.where(has, share.max(1) / np.maximum(share.sum(1), 1), 0.0)
            cut = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(labels.astype(int), prepend=-1) != 0))
            stop = np.append(cut[1:], len(text)) - 1
            names = np.array([*langs, "und"], object)
            spans = pa.StructArray.from_arrays(
                [pa.array(begin[cut], pa.int32()), pa.array(end[stop] if len(cut) else end[:0], pa.int32()),
                 pa.array(names[labels[cut]], pa.string())], ["begin", "end", "lang"])
            offsets = np.searchsorted(text[cut], np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names[np.where(has, pred, len(langs))], pa.string()), pa.array(score),
                 pa.ListArray.from_arrays(pa.array(offsets), spans)], ["doc_id", "lang_pred", "score", "spans"])

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, "
                               "score double, spans array<struct<begin: int, end: int, lang: string>>")
