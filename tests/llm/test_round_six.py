"""Bytes and rows that travel: texts, hashes of spans, members of dense lists."""

import os
import random
import re
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_a_text_travels_once(spark):
    from skyledger.llm import spans
    text = " ".join(f"Sentence {i} of some words here." for i in range(12))
    docs = spark.createDataFrame([(1, text), (2, text), (3, None), (None, "")], "doc_id long, text string")
    kept = spans.drop_repeats(docs)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert " AS own#" in plan and not re.search(r" AS own#\d+, text#", plan)
    assert spans._spans(docs).schema["spans"].dataType.elementType["h2"].dataType.simpleString() == "int"
    found = {r.own.doc_id: (r.text, r.n_sentences, r.n_removed) for r in kept.collect()}
    assert found == {1: (text, 12, 0), 2: ("", 12, 12), 3: (None, 0, 0), None: ("", 0, 0)}


RELEASED = """
import pyarrow as pa
from skyledger.llm.common import lean

def held():
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith("RssAnon")) / 1024

@lean
def run(batches):
    for b in batches:
        words = [str(i).encode() * 3 for i in range(b * 600_000)]
        yield pa.array(words), pa.array(range(b * 3_000_000))

began = held()
for x in run(iter([1, 2])):
    pass
del x
assert list(run(iter([]))) == []
print(run.__name__, held() - began)
"""


def test_a_task_gives_memory_back():
    done = subprocess.run([sys.executable, "-c", RELEASED], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    name, grown = done.stdout.split()
    assert name == "run" and float(grown) < 40


def test_workers_of_the_pipeline_are_lean():
    from inspect import getsource
    from skyledger.llm import bpe, decontam, ngram_join, spans, toxicity
    for module in (bpe, decontam, ngram_join, spans, toxicity):
        lines = getsource(module).splitlines()
        at = [i for i, x in enumerate(lines) if re.match(r"\s+def run\(\w+: Iterator", x)]
        assert at and all(lines[i - 1].strip() == "@lean" for i in at)


@pytest.mark.parametrize("words, replaced", [(700, 10), (60, 2)])
def test_few_pairs_of_a_dense_list_leave_the_task(spark, monkeypatch, words, replaced):
    from skyledger.llm import ngram_join as N
    rng = random.Random(words)
    base, texts = [f"w{i}" for i in range(words)], []
    for d in range(40):
        own = list(base)
        for i in rng.sample(range(words), replaced):
            own[i] = f"own{d}x{i}"
        texts.append(" ".join(own))
    texts += [texts[3], texts[5].replace("w7 ", "other "), None, "", "w1 w2"]
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").split()) else set() for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = list(range(len(sets)))
    for _ in root:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    left, candidates = [], N._candidates
    monkeypatch.setattr(N, "_candidates", lambda m: left.append(m.count()) or candidates(m))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for dense in (1, 1_000_000) if words == 700 else (1,):
        monkeypatch.setattr(N, "DENSE", dense)
        assert {r.doc_id: r.component_id for r in N.link_components(docs).collect()} == dict(enumerate(root))
    if words == 700:  # parities tell nothing apart here
        assert 5 * left[0] < left[1]


def test_sketches_of_several_sizes_compare():
    import numpy as np
    from skyledger.llm import ngram_join as N
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 520).astype(np.uint64)
    sets = [base, base[:500], base[:140], rng.integers(0, 1 << 63, 500).astype(np.uint64)]
    sketches = [N.sketch(np.unique(s)) for s in sets]
    assert len(sketches[0]) == 2 * len(sketches[1]) > len(sketches[2])
    x, y = np.array([0, 0, 0, 1, 1]), np.array([1, 2, 3, 3, 1])
    total = np.array([len(sets[i]) + len(sets[j]) for i, j in zip(x, y)])
    assert N._by_sketch(sketches, x, y, total).tolist() == [True, False, False, False, True]
    assert N._by_sketch(sketches, x[:0], y[:0], total[:0]).tolist() == []
