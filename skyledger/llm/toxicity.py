"""Toxicity: a factorization machine over hashed terms.

The score of a text is ``b + sum w_i + sum_{i<j} <v_i, v_j>`` over its hashed
terms, through a sigmoid; the factors learn pairs of terms that are toxic only
together. Terms are words (lower case) and their prefixes of 4 to 6 bytes, so
inflected forms share evidence; each is hashed into 2^40 values. Those in at
least 5 rows of the training sample have weights of their own (at most
MAX_TERMS, by document frequency), all others share SLOTS weights by their hash.

Training uses at most SAMPLE_PER_CLASS labelled rows of each class, the first
by a hash of their id, weighted to the class shares of all labelled rows;
scoring covers every whole text.

Defined results: null and empty texts get the score of no terms. Labels that
are null, or of ids that documents lack, teach nothing; without rows of both
classes the score is the smoothed class share for every text. Repeated rows
are scored alike, and of rows that share an id one teaches; very long texts are
scored whole; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORDS_KEPT, chunks, lean, lists, stored

#: Bounds of what is fitted on the driver.
SAMPLE_PER_CLASS, MAX_TERMS, SLOTS = 4000, 1 << 16, 1 << 14
FACTORS, STEPS = 4, 250
#: Step and ridge of terms that tell nothing alone.
WEAK_STEP, WEAK_RIDGE = 0.01, 1e-3

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str) -> set[bytes]:
    return set(text.lower().encode().translate(_KEEP).split())


def terms_of(word: bytes) -> list[int]:
    import xxhash
    forms = [b"w" + word] + [b"p" + word[:n] for n in (4, 5, 6) if len(word) > n]
    return [xxhash.xxh3_64_intdigest(x) >> 24 for x in forms]


def _known(labels: DataFrame, learn: Column) -> DataFrame:
    """labelled_id, toxic: the labels to learn from."""
    return labels.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic")).distinct() \
        .filter(F.col("toxic").isin(0, 1) & F.col("labelled_id").isNotNull()).filter(learn)


def _class_sizes(docs: DataFrame, labels: DataFrame, learn: Column) -> np.ndarray:
    """Rows of ``docs`` with a label to learn from, clean and toxic."""
    rows = docs.groupBy("doc_id").agg(F.count("*").alias("rows")).join(_known(labels, learn), F.col("doc_id") == F.col("labelled_id"))
    found = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.sum("rows").alias("n")).collect()}  # two rows
    return np.array([found.get(0, 0), found.get(1, 0)], np.float64)


def _sample(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """toxic, terms: the bounded training sample."""
    known = _known(labels, learn).join(docs.select(F.col("doc_id").alias("labelled_id")), "labelled_id", "left_semi")
    picked = [known.filter(F.col("toxic") == c)
              .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(SAMPLE_PER_CLASS) for c in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * SAMPLE_PER_CLASS rows
    rows = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("labelled_id"))
    # of rows that share an id, the one of the least hash teaches
    rows = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("toxic", "text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            found = [np.unique(np.array(list(chain.from_iterable(map(terms_of, words_of(t or "")))), np.int64))
                     for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), lists(np.concatenate(found), [len(x) for x in found], pa.int64())], ["toxic", "terms"])

    return rows.mapInArrow(run, "toxic int, terms array<long>")


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> dict:
    """The fitted machine: terms (sorted hashes), w, v and b; w and v have
    SLOTS more rows, for all other terms by their hash. ``learn`` is a
    condition on ``labelled_id``. Terms are counted and numbered in Spark; the
    driver gets the vocabulary and each sampled row's numbers."""
    sample = stored(_sample(docs, labels, learn), "toxicity-sample")
    sizes = _class_sizes(docs, labels, learn)
    model = {"terms": np.empty(0, np.int64), "w": np.empty(0), "v": np.empty((0, FACTORS)),
             "b": float(np.log((sizes[1] + 0.5) / (sizes[0] + 1)))}
    of_class = {r.toxic: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = of_class.get(0, 0), of_class.get(1, 0)
    if not n0 or not n1:
        return model
    counts = sample.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("df"), F.sum("toxic").alias("in1")).filter("df >= 5") \
        .orderBy(F.desc("df"), "term").limit(MAX_TERMS).toArrow().sort_by("term")
    terms, df, in1 = (np.asarray(counts.column(c).combine_chunks()) for c in ("term", "df", "in1"))
    share = n1 / (n0 + n1)
    excess = (in1 - df * share) ** 2 / (df * share * (1 - share) + 1e-9)  # chi-squared, one degree
    tells = np.concatenate([excess > 20, np.zeros(SLOTS, bool)])
    got = _numbered(sample, terms).toArrow()
    y = np.asarray(got.column("toxic").combine_chunks(), np.float32)
    sets = got.column("terms").combine_chunks()
    weight = np.where(y == 1, sizes[1] / n1, sizes[0] / n0) * len(y) / sizes.sum()
    row = np.repeat(np.arange(len(y), dtype=np.int32), np.asarray(pa.compute.list_value_length(sets)))
    return _descend(row, np.asarray(sets.flatten()), y, len(tells), tells, weight.astype(np.float32)) | {"terms": terms}


def _numbered(sample: DataFrame, terms: np.ndarray) -> DataFrame:
    """toxic, terms: the columns of each row's terms; a row's terms of one slot count once."""
    shared = sample.sparkSession.sparkContext.broadcast(terms)  # at most MAX_TERMS

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            found = []
            for x in b.column(1):
                x = np.asarray(x.values) if len(x) else np.empty(0, np.int64)
                at = np.searchsorted(known, x)
                own = np.zeros(len(x), bool)
                own[at < len(known)] = known[at[at < len(known)]] == x[at < len(known)]
                found.append(np.unique(np.where(own, at, len(known) + x % SLOTS)))
            if found:
                yield pa.RecordBatch.from_arrays([b.column(0), lists(np.concatenate(found), [len(x) for x in found], pa.int32())],
                                                 ["toxic", "terms"])

    return sample.mapInArrow(run, "toxic int, terms array<int>")


class _Sums:
    """Sums of ``values[index]`` for each key; ``key`` is sorted."""

    def __init__(self, index: np.ndarray, key: np.ndarray, n: int):
        self.index, self.n = index, n
        self.first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.key = key[self.first]

    def of(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n, np.float32)
        out[self.key] = np.add.reduceat(values.take(self.index), self.first)
        return out


def _descend(row: np.ndarray, col: np.ndarray, y: np.ndarray, n_terms: int, tells: np.ndarray | None = None,
             weight: np.ndarray | float = 1.0) -> dict:
    """Full-batch Adam on the logistic loss with a ridge on w and v, in single
    precision. Terms that tell nothing alone (by ``tells``) go in smaller steps
    and under a stronger ridge, so that there must be many rows behind what
    they add."""
    rng = np.random.default_rng(7)
    n, k = len(y), FACTORS
    if not len(row):
        return {"b": float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))), "w": np.zeros(n_terms), "v": np.zeros((n_terms, k))}
    tells = np.ones(n_terms, bool) if tells is None else tells
    step = np.where(tells, 0.05, WEAK_STEP).astype(np.float32)
    ridge_w, ridge_v = (np.where(tells, x, WEAK_RIDGE).astype(np.float32) for x in (1e-5, 1e-4))
    row, col = np.asarray(row, np.int32), np.asarray(col, np.int32)
    by_row = _Sums(col, row, n)
    order = np.argsort(col, kind="stable")
    by_col = _Sums(row[order], col[order], n_terms)
    del order
    p = [np.zeros(1, np.float32), np.zeros(n_terms, np.float32), np.ascontiguousarray(rng.normal(0, 0.01, (n_terms, k)).T.astype(np.float32))]
    m1, m2 = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for t in range(1, STEPS + 1):
        b, w, v = p
        s = [by_row.of(x) for x in v]
        margin = b[0] + by_row.of(w) + 0.5 * (sum(x * x for x in s) - by_row.of((v * v).sum(0)))
        g = (weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / n).astype(np.float32)
        mass = by_col.of(g)
        gv = np.stack([by_col.of(g * s[f]) - mass * v[f] for f in range(k)])
        grads = [np.array([g.sum()]), mass + ridge_w * w, gv + ridge_v * v]
        for x, gr, a, q, lr in zip(p, grads, m1, m2, (0.05, step, step)):
            a += 0.1 * (gr - a)
            q += 0.001 * (gr * gr - q)
            x -= lr * (a / (1 - 0.9 ** t)) / (np.sqrt(q / (1 - 0.999 ** t)) + 1e-8)
    return {"b": float(p[0][0]), "w": p[1].astype(np.float64), "v": p[2].T.astype(np.float64)}


class _Terms(dict):
    """Rows of the model that a word's terms hit, for words met lately."""

    def __init__(self, terms: np.ndarray, fitted: int):
        super().__init__()
        self.own = list(range(fitted))  # one int object a row, shared by all words
        self.row, self.fitted = dict(zip(terms.tolist(), self.own)), fitted

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= 2 * WORDS_KEPT:
            self.clear()
        n = len(self.row)
        hit = self[word] = tuple(self.row.get(t, self.own[n + t % SLOTS]) for t in terms_of(word)) if self.fitted else ()
        return hit


def with_score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with a column score (0 to 1, higher: toxic likelier)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most (MAX_TERMS + SLOTS) * (FACTORS + 2) numbers

    @lean
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        hits = _Terms(m["terms"], len(m["w"]))
        w, v = m["w"], m["v"]
        own = (v * v).sum(1)
        for column in texts:
            out = np.full(len(column), m["b"])
            for i, text in enumerate(column):
                text = text.as_py()
                found = list(set(chain.from_iterable(map(hits.__getitem__, words_of(text))))) if text else []
                if found:
                    s = v[found].sum(0)
                    out[i] += w[found].sum() + 0.5 * (s @ s - own[found].sum())
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}  # read when the function is declared
    return docs.withColumn("score", F.arrow_udf(run, "double")("text"))


def clean(docs: DataFrame, model: dict, bar: float = 0.5) -> DataFrame:
    """Rows of ``docs``, all columns, that the model doesn't reject: those
    under ``bar``, and those that score no higher than a text of no terms (a
    high class share alone rejects nothing)."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    scored = with_score(docs.select(F.struct(*columns).alias("own"), "text"), model)
    none = float(1 / (1 + np.exp(-np.clip(model["b"], -30, 30))))
    return scored.filter((F.col("score") < bar) | (F.col("score") <= none)).select("own.*")
