"""Work and memory of tasks: pieces encoded together, tables of a worker, sketches that needn't travel."""

import os
import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("states", [40, 100_000])
def test_short_pieces_of_a_batch_read_the_table_together(monkeypatch, states):
    import tiktoken
    from skyledger.llm import bpe
    monkeypatch.setattr(bpe, "STATES", states)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=ranks)
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("aeioustrnlé日ж\U0001F600", k=rng.randint(1, 12)))
    texts = [None, "", *(" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(80)), "x" * 5000, "a" * 32 + " " + "é" * 33]
    enc, alone = bpe.Encoder(ranks, public_tokenizers.PATTERN), []
    run = enc.fst.run
    monkeypatch.setattr(enc.fst, "run", lambda data: alone.append(len(data)) or run(data))
    assert [x.tolist() for x in enc.encode_all(texts)] == [plain.encode_ordinary(t or "") for t in texts]
    assert len(alone) <= 2 and min(alone) > bpe.SHORT  # only what is longer runs by itself
    assert len(enc.fst.states) <= states and len(enc.fst.moves) <= 4 * states


def test_moves_equal_a_dict():
    from skyledger.llm.bpe import Moves
    rng = random.Random(2)
    known = {rng.randrange(1 << 30): rng.randrange(1 << 40) for _ in range(500)} | {0: 0}
    moves = Moves(501)
    for key, value in [*known.items(), *known.items()]:
        moves[key] = value
    asked = [*known, *range(1, 300)]
    assert len(moves) == len(known)
    assert [moves.get(k) for k in asked] == moves.of(np.array(asked)).tolist() == [known.get(k, -1) for k in asked]


GROWTH = """
import os
import random
import subprocess
import sys
from skyledger.llm import common, spans, toxicity

def rss():
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith("RssAnon")) / 1024

import numpy as np
import pyarrow as pa
import xxhash
r = random.Random(3)
some = lambda: ("".join(r.choices("etaoinshrdlu", k=9)) for _ in range(390_000))
began = rss()
{}
print(rss() - began)
"""
TABLES = {
    "hashes": "t = common.WordHashes()\nfor x in some(): t[x.encode()]",
    "spans": "for x in some(): spans._HASHES[x]",
    "toxicity": "t = toxicity._Terms(np.arange(65536), 65536 + toxicity.SLOTS)\nfor x in some(): t[x.encode()]",
}


@pytest.mark.parametrize("table, most", [("hashes", 40), ("spans", 40), ("toxicity", 100)])
def test_tables_of_words_stay_small(table, most):
    done = subprocess.run([sys.executable, "-c", GROWTH.format(TABLES[table])], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < most  # MB; several idle workers of an executor may hold tables


def test_stages_get_small_batches(spark, folders):
    import corpus_pipeline
    from skyledger.llm.common import ROWS_AT_ONCE
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    try:
        for given, kept in (("10000", str(ROWS_AT_ONCE)), ("77", "77")):
            for _, stage in corpus_pipeline.STAGES[1:3]:
                spark.conf.set(name, given)
                stage(spark, spark.read.parquet(f"{folders[1]}/documents.parquet"), folders[1])
                assert spark.conf.get(name) == kept
    finally:
        spark.conf.set(name, old)


def test_only_sketches_of_pairs_travel(spark, monkeypatch):
    from skyledger.llm import ngram_join as N
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    sets = [base, base[1:], rng.integers(0, 1 << 63, 300).astype(np.uint64), *rng.integers(0, 1 << 63, (2000, 4)).astype(np.uint64)]
    ids = [N.set_id(s) for s in sets]
    rows = [(i, len(s), bytearray(N.sketch(s))) for i, s in zip(ids, sets)] + [(ids[0], len(base), bytearray(N.sketch(base))), (None, 0, None)]
    members = spark.createDataFrame(rows, "sid long, n int, sketch binary")
    met, join = [], type(members).join

    def noted(self, *args, **named):
        if self.columns == ["sid", "n", "sketch"]:
            met.append(self.count())
        return join(self, *args, **named)

    monkeypatch.setattr(type(members), "join", noted)
    pairs = spark.createDataFrame([(ids[0], ids[1]), (ids[0], ids[2])], "u long, v long")
    assert [tuple(r) for r in N._close(pairs, members).collect()] == [(ids[0], ids[1])]
    assert len(met) == 1 and 4 <= met[0] < 20
    assert N._close(pairs.limit(0), members).count() == 0
