"""The operators against brute force, other engines and held-out rows."""

import random
import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from skyledger.llm import langid, spans, suffix_dedup, topk, toxicity, urls
from skyledger.llm.queries import QUERIES, SQL

SMALL, MIDDLE, LARGE = (f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1"))


def texts(spark, folder=SMALL):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def vocabulary():
    from skyledger.llm.bpe import read_ranks
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.execute(SQL[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_spans_equal_brute_force(spark):
    """Every span as a tuple of words; the first occurrence stays."""
    def spans_of(pieces):
        words = [p.lower().split() for p in pieces]
        for i in range(len(pieces)):
            for step in (1, -1):
                run, k = [], i
                while 0 <= k < len(pieces) and (len(run) < spans.MIN_SENTENCES or sum(map(len, run)) < spans.MIN_WORDS):
                    run.append(words[k])
                    k += step
                if len(run) >= spans.MIN_SENTENCES and sum(map(len, run)) >= spans.MIN_WORDS:
                    a, b = (i, k) if step > 0 else (k + 1, i + 1)
                    yield a, b, tuple(map(tuple, words[a:b]))

    docs = texts(spark)
    seen, want = {}, {}
    cut = {i: spans.sentences(docs[i] or "") for i in docs}
    found = {i: sorted(set(spans_of(cut[i]))) for i in docs}
    where = defaultdict(list)
    for i in sorted(docs):
        for a, b, s in found[i]:
            where[s].append((i, a, b))
    gone = {i: set() for i in docs}
    for places in where.values():
        for i, a, b in places[1:]:
            gone[i].update(range(a, b))
    for i in docs:
        want[i] = "".join(p for k, p in enumerate(cut[i]) if k not in gone[i])
    got = {r.doc_id: r.text or "" for r in QUERIES["op1_sentence_spans"](spark, SMALL).collect()}
    assert got == want and any(gone.values())


def test_spans_without_sentence_ends():
    """A passage of 51 words (or letters) that two texts share has a span in
    both, whatever stands around it and whatever white space is used."""
    def hashes(text):
        pieces = spans.sentences(text)
        assert "".join(pieces) == text
        return set(spans.span_hashes(pieces)[2].tolist())

    rng = random.Random(4)
    for gap, letters in ((" ", False), ("\t", False), ("\u3000", False), ("", True)):
        draw = lambda n: [chr(0x4E00 + rng.randrange(3000)) if letters else f"w{rng.randrange(3000)}" for _ in range(n)]
        for _ in range(100):
            passage = draw(51)
            a, b = (gap.join(draw(rng.randint(0, 90)) + passage + draw(rng.randint(0, 90))) for _ in range(2))
            assert hashes(a) & hashes(b)
    assert spans.sentences("第一句话。第二句话！「第三句话。」第四") == ["第一句话。", "第二句话！", "「第三句话。」", "第四"]
    many = "今天天气很好。我们去公园走走。孩子们都很高兴。"
    assert hashes("开头不同。" + many) & hashes(many + "结尾也不同。")


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    got = [(r.score, labels[r.doc_id]) for r in QUERIES["op2_toxicity"](spark, LARGE).filter("held_out").collect()
           if labels.get(r.doc_id) is not None]
    good, bad = [s for s, y in got if y == 0], [s for s, y in got if y == 1]
    assert good and bad
    assert np.mean([a < b for a in good for b in bad]) > 0.9
    assert np.mean([(s >= 0.5) == (y == 1) for s, y in got]) > 0.9


def test_toxicity_learns_pairs(spark):
    """Toxic only if both words meet: no additive weights can tell these apart."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        a, b = rng.integers(0, 2, 2)
        rows.append((i, " ".join(["zorn"] * a + ["mip"] * b + [f"f{rng.integers(50)}"] * 2), int(a ^ b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    from pyspark.sql import functions as F
    sample = toxicity._sample(docs, labels, F.lit(True)).toArrow()
    y = np.asarray(sample.column("toxic").combine_chunks(), float)
    terms = [toxicity.terms_of(w)[0] for w in (b"zorn", b"mip")]
    row, col = zip(*[(i, j) for i, x in enumerate(sample.column("terms").to_pylist()) for j, t in enumerate(terms) if t in x])
    m = toxicity._descend(np.array(row), np.array(col), y, 2)
    s = lambda *k: m["b"][0] if False else m["b"] + sum(m["w"][i] for i in k) + (m["v"][0] @ m["v"][1] if len(k) == 2 else 0)
    assert s() < 0 and s(0) > 0 and s(1) > 0 and s(0, 1) < 0


def test_toxicity_fit_keeps_pairs(spark):
    """The same through fit() and with_score(): neither word tells anything alone."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        a, b = rng.integers(0, 2, 2)
        rows.append((i, " ".join(["zorn"] * a + ["mip"] * b + [f"f{rng.integers(50)}"] * 2), int(a ^ b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    m = toxicity.fit(docs, labels, F.lit(True))
    new = spark.createDataFrame([(i, f"{t} f{i % 50}") for i, t in enumerate(["", "zorn", "mip", "zorn mip"] * 50)],
                                "doc_id long, text string")
    got = [(r.score >= 0.5) == (r.doc_id % 4 in (1, 2)) for r in toxicity.with_score(new, m).collect()]
    assert np.mean(got) > 0.95


def test_toxicity_keeps_the_class_share(spark, monkeypatch):
    """One text's score doesn't move with the class sizes in the sample."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 10 == 0), f"f{rng.integers(20)} f{rng.integers(20)}") for i in range(3000)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, toxic int")
    none = spark.createDataFrame([(1, "")], "doc_id long, text string")
    got = []
    for cap in (4000, 300):
        monkeypatch.setattr(toxicity, "SAMPLE_PER_CLASS", cap)
        got.append(toxicity.with_score(none, toxicity.fit(docs, labels, F.lit(True))).first().score)
    assert all(0.03 < s < 0.25 for s in got) and abs(got[0] - got[1]) < 0.1


def test_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r.lang_pred == lang[r.doc_id] for r in QUERIES["op4_language_spans"](spark, MIDDLE).filter("held_out").collect()
           if lang[r.doc_id] and r.lang_pred != "und"]
    assert len(got) > 100 and np.mean(got) > 0.9


def test_viterbi_equals_full_search():
    rng = np.random.default_rng(1)
    scores, sizes = rng.normal(0, 3, (5 + 1 + 4, 3)), np.array([5, 0, 1, 4])
    got, at = langid.viterbi(scores, sizes, 2.0), 0
    for n in sizes:
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n) if n else np.zeros((1, 0), int)
        value = scores[np.arange(at, at + n), paths].sum(1) - 2.0 * (paths[:, 1:] != paths[:, :-1]).sum(1)
        assert got[at:at + n].tolist() == paths[value.argmax()].tolist()
        at += n


def test_viterbi_of_many_languages():
    want = np.array([299, 299, 256, 0, 257])
    scores = np.zeros((5, 300))
    scores[np.arange(5), want] = 50
    assert langid.viterbi(scores, np.array([2, 1, 2]), 2.0).tolist() == want.tolist()


def test_url_model(spark):
    pages = spark.createDataFrame([(i, u) for i, (_, u) in enumerate(urls.LABELLED)], "page_id long, url string")
    got = {r.page_id: r.score for r in urls.judge_urls(pages).collect()}
    assert np.mean([(got[i] >= 0.5) == y for i, (y, _) in enumerate(urls.LABELLED)]) > 0.95
    plan = urls.judge_urls(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_bpe_equals_tiktoken(spark):
    enc = vocabulary()
    got = {r.doc_id: r for r in QUERIES["op7_byte_bpe"](spark, SMALL).collect()}
    for i, t in texts(spark).items():
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_shards(spark):
    docs = texts(spark, MIDDLE)
    got = QUERIES["op8_best_fit_shards"](spark, MIDDLE).collect()
    size = {i: len((t or "").encode()) + 16 for i, t in docs.items()}
    assert {r.doc_id: r.size for r in got} == size
    by_shard, by_text, n = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        by_shard[r.shard].append(r)
        by_text[docs[r.doc_id]].add(r.shard)
        n[docs[r.doc_id]] += r.size
    assert sorted(by_shard) == list(range(40))
    for rows in by_shard.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    share = sum(size.values()) / 40
    assert all(len(s) == 1 for t, s in by_text.items() if n[t] <= share)
    sums = [sum(r.size for r in rows) for rows in by_shard.values()]
    assert max(sums) <= 1.02 * share


@pytest.mark.parametrize("most", [suffix_dedup.MOST, 1])
def test_suffix_dedup_equals_brute_force(spark, most):
    length = 400
    docs = {i: (t or "").encode() for i, t in texts(spark).items()}
    at = defaultdict(int)
    starts = {i: [xxhash.xxh3_64_intdigest(t[k:k + length]) for k in range(len(t) - length + 1)] for i, t in docs.items()}
    for hs in starts.values():
        for h in hs:
            at[h] += 1
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    import pyspark.sql.functions as F
    from skyledger.llm.common import row_key
    if most == suffix_dedup.MOST:
        got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op9_suffix_dedup"](spark, SMALL).collect()}
    else:
        found = frame.select("doc_id", row_key().alias("row")).join(
            suffix_dedup.repeated_bytes(frame, length, most), "row").select("doc_id", F.col("spans")).collect()
        marked = {r.doc_id: sorted({k for s in r.spans for k in range(s.begin, s.end)}) for r in found}
    for i, t in docs.items():
        gone = np.zeros(len(t) + 1, bool)
        for k, h in enumerate(starts[i]):
            if at[h] > 1:
                gone[k:k + length] = True
        if most == 1:
            assert marked.get(i, []) == np.flatnonzero(gone).tolist()
            continue
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        assert got[i] == (int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())


def test_top_k_random(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 90, (700, 24)).astype(int)
    x[300:340] = x[299]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, v array<int>")
    from pyspark.sql import functions as F
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(frame, F.col("vec_id") % 7 == 0, 9).collect())
    want = []
    for q in range(0, 700, 7):
        s = x @ x[q]
        best = [i for i in np.lexsort((np.arange(700), -s)) if i != q][:9]
        want += [(q, k + 1, int(i), int(s[i])) for k, i in enumerate(best)]
    assert got == want


def test_pipeline(spark):
    """Each stage on its predecessor's rows; the last one's ids decode to them."""
    from skyledger.llm.common import load, stored
    docs = load(spark, SMALL, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > sizes[0] / 2
    enc, left = vocabulary(), {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == {i: enc.encode_ordinary(t) for i, t in left.items()}


def _near_texts(seed: int) -> list[tuple[int, str]]:
    """Passages that many texts share, and copies with few to many changed words."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = [rng.choices(words, k=n) for n in (6, 12, 20)]
    out = []
    for _ in range(60):
        base = rng.choice(common) * rng.randint(0, 1) + rng.choices(words, k=rng.choice((3, 8, 15, 60, 150)))
        for _ in range(rng.randint(1, 6)):
            text = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                text[rng.randrange(len(text))] = rng.choice(words)
            out.append(" ".join(text[rng.randint(0, 2):]))
    return list(enumerate(out))


@pytest.mark.parametrize("list_part,block", [(1_000_000, 2048), (3, 2)])
def test_ngram_join_equals_brute_force(spark, list_part, block):
    """Also with lists split into parts and blocks of few members."""
    from skyledger.llm.ngram_join import link_components
    texts = _near_texts(5)
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, t in texts for w in [t.split()]}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = link_components(spark.createDataFrame(texts, "doc_id long, text string"), list_part, block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), find(i)) for i, s in sets.items()}
    assert len({find(i) for i in sets}) < len(sets)


def test_keep_one_leaves_one_row_of_each_group(spark):
    """Also of rows that repeat, that share a doc_id, and that have none."""
    from skyledger.llm.ngram_join import keep_one
    base = [" ".join(f"{p}{i}" for i in range(60)) for p in "abcd"]
    near = base[1] + " more"
    rows = [(1, base[0], "x"), (1, base[0], "x"), (1, base[0], "y"),  # a table loaded twice
            (2, base[1], "x"), (2, near, "x"), (3, base[1], "x"),     # one id, linked texts
            (None, base[2], "x"), (None, base[2], "x"), (None, base[2] + " end", "x"),  # a source without ids
            (None, base[3], "x"), (9, base[3], "x"),
            (4, "", "x"), (4, "", "x"), (None, None, "x"), (None, None, "x")]  # no shingles
    got = [tuple(r) for r in keep_one(spark.createDataFrame(rows, "doc_id long, text string, tag string")).collect()]
    none = [r for r in got if not r[1]]
    assert sorted(map(str, none)) == sorted(map(str, rows[-4:]))
    left = [r for r in got if r[1]]
    assert len(left) == 4 and sorted(r[1][0] for r in left) == list("abcd")
    ids = {r[1][0]: r[0] for r in left}
    assert ids == {"a": 1, "b": 2, "c": None, "d": 9}
