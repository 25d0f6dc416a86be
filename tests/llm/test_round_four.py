"""Bounds of memory and shuffle: encoder tables of a worker, lists read again by the join."""

import os
import random
import subprocess
import sys
from itertools import combinations

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

GROWTH = """
import random, public_tokenizers
from skyledger.llm import bpe

def rss():
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith("RssAnon")) / 1024

enc, r = bpe.Encoder(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN), random.Random(7)
began = rss()
for _ in range(3000):
    text = " ".join("".join(r.choices("etaoinshrdlu", k=r.randint(5, 9))) for _ in range(150))
    assert b"".join(enc.fst.bytes_of[i] for i in enc.encode(text)) == text.encode()
print(rss() - began)
"""


def test_a_workers_tables_stay_small():
    done = subprocess.run([sys.executable, "-c", GROWTH], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < 150  # MB; several idle workers of an executor may hold tables


def test_the_join_reads_only_lists_again_that_may_still_link(spark, monkeypatch):
    from skyledger.llm import ngram_join as N
    phrases = [" ".join(f"s{i}w{j}" for j in range(12)) for i in range(12)]
    some = random.Random(3).sample(list(combinations(phrases, 3)), 150)
    strangers = [" ".join(x) for x in some]  # lists of the words where two phrases meet hold several
    base = [f"b{j}" for j in range(60)]
    near = [" ".join([*base[:-k], *(f"t{k}y{j}" for j in range(k))]) for k in range(1, 6)]
    texts = strangers + near
    rows, stored = {}, N.stored

    def noted(df, name):
        out = stored(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(N, "stored", noted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in N.link_components(docs).collect()}
    assert got == {i: i if i < 150 else 150 for i in range(155)}
    assert rows["entries"][0] > 150 and rows["entries"][1] < rows["entries"][0] / 3
