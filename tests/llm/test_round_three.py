"""Packing, manifest and conversation repair against plain versions."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import conversations, manifest, packing
from skyledger.llm.queries import QUERIES
from .conftest import EDGE_DOCS

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_packing(docs, pieces, capacity=packing.CAPACITY):
    """``docs``: (doc_id, text) of every row; ids of a document are unique here."""
    plain = Tokenizer.from_file(WORDS)
    ids = {i: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in docs}
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_window[p.sequence_id].append(p)
        got = ids[p.doc_id][p.start:p.start + p.length]
        assert p.length == len(got) > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(got.tobytes())
    assert set(by_doc) == set(ids)
    for i, found in by_doc.items():
        at = 0
        for p in sorted(found, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[i])
    for found in by_window.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == capacity or at < capacity and at & (at - 1) == 0  # nothing is padded
    return by_doc


def test_packing_is_whole_and_unpadded(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pieces = QUERIES["op11_bin_slack_packing"](spark, SMALL).collect()
    by_doc = check_packing([(r.doc_id, r.text) for r in docs.collect()], pieces)
    least = sum(1 + (p[0].doc_tokens - 1) // packing.CAPACITY for p in by_doc.values())
    assert len(pieces) - least <= len({p.sequence_id for p in pieces})  # at most one more cut a window


@pytest.mark.parametrize("lengths", [[1500] * 40, [7], [2048] * 3 + [1024], [1025] * 9 + [1000] * 5, [], [2047] * 20 + [2] * 3])
def test_plan_fills_every_window(lengths):
    counts = Counter(x for x in lengths if x < 2048)
    slots, windows = packing.plan(dict(counts), 2048)
    fill, line = Counter(), defaultdict(list)
    for length, first, n, window, offset, taken, then in slots.tolist():
        line[length].append((first, n, window, taken, then))
    todo = [(length, place) for length, n in counts.items() for place in range(n)]
    while todo:
        length, place = todo.pop()
        first, n, window, taken, then = max(x for x in line[length] if x[0] <= place)
        fill[window + (place - first) // n] += taken
        if then >= 0:
            todo.append((length - taken, then + (place - first) // n))
    assert sum(fill.values()) == sum(x * n for x, n in counts.items()) and len(fill) == windows
    assert all(x == 2048 or x & (x - 1) == 0 for x in fill.values())


def test_fullest_finds_the_closest_sum():
    rng = random.Random(3)
    for _ in range(200):
        lengths = [rng.randrange(1, 40) for _ in range(rng.randrange(1, 9))]
        counts, room = Counter(lengths), rng.randrange(1, 90)
        use = packing.fullest(counts, sorted(counts, reverse=True), room)
        first = max((x for x in lengths if x <= room), default=0)
        rest = list(lengths)
        if first:
            rest.remove(first)
        sums = {first + sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k)} if first else {0}
        assert sum(x * n for x, n in use.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[x] for x, n in use.items())


def test_word_ids_equal_the_library():
    with open(WORDS) as f:
        ours = packing.WordIds(f.read())
    plain = Tokenizer.from_file(WORDS)
    odd = ["Don't STOP, it's 3.5km... (really)!", "a b　c\x1cd\x85e", "é ́x café. İIΣ", "<|endoftext|> x<|startoftext|>y",
           "日本語 \U0001F600\U0001F600.", "", " \n\t ", "x'll'll ' '' 's", "\x00﻿​.", "word..'s A.B.c 1,000"]
    for text in odd * 2:
        got = np.frombuffer(ours.of(text.encode()), "<u4").tolist()
        assert got == [*plain.encode(text, add_special_tokens=False).ids, 1]


def test_packing_edges(spark, folders):
    rows = QUERIES["op11_bin_slack_packing"](spark, folders[0]).collect()
    kept = Counter(i for i, *_ in EDGE_DOCS)
    lone = [(i, t) for i, t, *_ in EDGE_DOCS if kept[i] == 1]
    ids = {i for i, _ in lone}
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(kept)
    for i in (1, 2, 3):
        assert [(r.length, r.doc_tokens, r.ids_crc32) for r in by_doc[i]] == [(1, 1, zlib.crc32(b"\x01\0\0\0"))]
    assert len(by_doc[5]) >= by_doc[5][0].doc_tokens // packing.CAPACITY > 20
    assert sum(r.length for r in by_doc[7]) == 2 * by_doc[7][0].doc_tokens and ids


def plain_manifest(rows):
    """{doc_id: [(leaf, subroot, root, proof, folded, verified)]} of (doc_id, source, lang, n_chars, text)."""
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def leaf(r, text):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)))

    def tree(nodes):
        steps = [[] for _ in nodes]
        below = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            up, up_below = [], []
            for a in range(0, len(nodes), 8):
                run = nodes[a:a + 8]
                for k in range(len(run)):
                    for i in below[a + k]:
                        steps[i].append((run[:k], run[k + 1:]))
                up.append(h("".join(run)))
                up_below.append([i for b in below[a:a + 8] for i in b])
            nodes, below = up, up_below
        return nodes[0], steps

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        made[g] = tree([leaf(r, r[4]) for r in groups[g]])
    root, upper = tree([made[g][0] for g in order])
    out = defaultdict(list)
    for g, above in zip(order, upper):
        for r, steps in zip(groups[g], made[g][1]):
            now = leaf(r, r[4])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                now = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            for before, after in steps + above:
                now = h("".join(before) + now + "".join(after))
            proof = h("".join("".join(a) + "".join(z) for a, z in steps + above))
            out[r[0]].append((leaf(r, r[4]), made[g][0], root, proof, now, now == root))
    return out


@pytest.mark.parametrize("height", [1, 2, 4])
def test_manifest_equals_a_plain_one(spark, monkeypatch, height):
    monkeypatch.setattr(manifest, "HEIGHT", height)
    monkeypatch.setattr(manifest, "BLOCK", 8 ** height)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain_manifest([tuple(r) for r in docs.select(*manifest.FIELDS).collect()])
    got = manifest.prove_documents(docs).collect()
    assert {r.doc_id: [tuple(r)[1:]] for r in got} == want and len(got) == len(want)
    assert 0 < sum(r.verified for r in got) < len(got)


def test_manifest_edges(spark, folders):
    rows = [(i, s, l, n, t) for i, t, l, s, n, *_ in EDGE_DOCS]
    want = plain_manifest(rows)
    got = defaultdict(list)
    for r in QUERIES["op12_merkle_manifest"](spark, folders[0]).collect():
        got[r.doc_id].append(tuple(r)[1:])
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}


def test_a_lone_leaf_is_the_root(spark):
    docs = spark.createDataFrame([(1, "A", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    r = manifest.prove_documents(docs).collect()[0]
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == hashlib.sha256(b"").hexdigest()


def plain_least(codes, enter, leave):
    """Least (cost, audit) by trying every edit, with at most two inserts between rows."""
    best = {enter: (0, "")}
    for code in [*codes, None]:
        wide = dict(best)
        for _ in range(2):
            for q, (cost, audit) in list(wide.items()):
                for role in "ua":
                    if q in conversations.ROLES[role]:
                        to = conversations.ROLES[role][q]
                        wide[to] = min(wide.get(to, (10**9, "")), (cost + 5, audit + "I"))
        if code is None:
            return wide.get(leave)
        best = {}
        for q, (cost, audit) in wide.items():
            ways = [(q, 2, "D")]
            if code != "d":
                late = 5 * code.isupper()
                if q in conversations.ROLES.get(code.lower(), {}):
                    ways.append((conversations.ROLES[code.lower()][q], late, "K"))
                ways += [(conversations.ROLES[r][q], 1 + late, "R") for r in "ua" if q in conversations.ROLES[r]]
            for to, more, letter in ways:
                best[to] = min(best.get(to, (10**9, "")), (cost + more, audit + letter))


def test_bidirectional_search_finds_the_least_audit():
    rng = random.Random(5)
    cases = ["".join(c) for k in range(4) for c in itertools.product("suaxSUd", repeat=k)]
    cases += ["".join(rng.choice("sssuuuuaaaaxSUAXd") for _ in range(rng.randrange(4, 30))) for _ in range(150)]
    for codes in cases:
        for k in range(16):
            assert conversations.least_audit(codes, k // 4, k % 4) == plain_least(codes, k // 4, k % 4)


def plain_repair(rows):
    """{conv_id: result} of (conv_id, turn, role, text)."""
    blank = " \t\n\x0b\x0c\r"
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        groups[conv] += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, found in groups.items():
        found.sort()
        seen, codes, counts = set(), "", Counter()
        for _, _, role, text in found:
            fault = "blank" if not text.strip(blank) else "duplicate" if (role, text) in seen else "truncated" if text.strip(blank)[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault in ("blank", "duplicate") else code.upper() if fault else code
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit = min(x for x in (plain_least(codes, 0, 0), plain_least(codes, 0, 3)) if x)
        lines, left, turns = [], list(found), 0
        for letter in audit:
            _, _, role, text = (0, 0, "", "") if letter == "I" else left.pop(0)
            if letter != "D":
                turns += letter != "K" or role[:1] != "s"
                lines.append(f"{role if letter == 'K' else ('assistant', 'user')[turns % 2]}:{text}")
        numbers = [t for known, t, *_ in found if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.mark.parametrize("segment", [3, 256])
def test_repair_equals_a_plain_one(spark, folders, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    for folder in (SMALL, folders[0]):
        table = spark.read.parquet(f"{folder}/conversations.parquet")
        want = plain_repair([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
        got = QUERIES["op13_conversation_repair"](spark, folder).collect()
        assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_a_conversation_of_which_nothing_is_left(spark):
    turn = next(i for i in range(1000) if zlib.crc32(f"7:{i}".encode()) % 20 == 0)
    table = spark.createDataFrame([(7, turn, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in conversations.repair(table).collect()] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_encoder_tables_are_bounded(monkeypatch):
    """Equal to the tiktoken library with tiny tables, on long pieces too."""
    import tiktoken
    from skyledger.llm import bpe
    for name, n in (("STATES", 60), ("PAIRS", 40), ("PIECES", 10), ("LAG", 16)):
        monkeypatch.setattr(bpe, name, n)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=ranks)
    ours = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    rng = random.Random(8)
    texts = ["".join(rng.choice("aeiourstlnd") for _ in range(3000)), "=-" * 900, "日本語" * 500, "ab" * 2000 + " " * 700 + "\n" * 300,
             " ".join("".join(rng.choice("aeiourstlnd") for _ in range(rng.randrange(1, 14))) for _ in range(2000))]
    for text in texts * 2:
        assert ours.encode(text).tolist() == plain.encode_ordinary(text)
        assert len(ours.fst.states) <= 60 and len(ours.fst.moves) <= 240 and len(ours.fst.pairs) <= 40 and len(ours) <= 10
