"""Byte-level BPE: encoding by a lazily determinised transducer, streaming
decoding by an incremental UTF-8 machine.

The merges are compiled into a nondeterministic transducer whose states are
(last token, trie node of the token under way). Reading a byte moves along the
trie; where a token may end, and the merges would keep it apart from the last
one, a new token begins. Every prefix has exactly one encoding, so among the
states after a byte exactly one begins a new token: the token that ends there
is the transition's output, and the ones before it follow from its length. The
subset construction runs on demand; a deterministic state is just the set of
such pairs, without the tokens read so far, so equal futures share a state
whatever came before. Tokens are settled once all pairs that are still open
agree on them, which bounds the output's lag on long pieces. States, checked
pairs of tokens and kept pieces are bounded (STATES, PAIRS, PIECES): once the
table is full, further states are computed and not kept, also within a piece,
and it is built anew after many of those, so a worker's memory is the same for
any text. Every piece of the split pattern is a run of its own; a piece that is
a token itself is that token, as in the tiktoken library. The new pieces of a
batch of texts read the table together, a byte of each at a time.

Defined results: null text encodes as the empty text (no ids). Texts that
look like special tokens are ordinary text. Any row is handled by itself, so
repeated rows repeat and an empty table gives no rows; a very long text is
encoded whole, and extra columns are ignored.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lean, lists

#: Bounds of a worker's tables: deterministic states, checked pairs of tokens,
#: pieces in each of two generations, and bytes of a piece between settlements.
#: An executor may keep idle workers from earlier stages; each that gets a task holds its own tables.
STATES, PAIRS, PIECES, LAG = 100_000, 80_000, 100_000, 1024
AT_ONCE = 1_000_000  # bytes of text a worker encodes together
SHORT = 32  # characters of a piece that is kept
NODE = TOKEN = 20  # bits
NODES = TOKENS = (1 << NODE) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Moves:
    """At most ``most`` transitions: whole numbers by whole numbers from 0, in two
    flat arrays, looked up one by one or many together."""

    ODD, ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1

    def __init__(self, most: int):
        self.bits = max(4, (2 * most - 1).bit_length())
        self.keys, self.values = (array("q", bytes(8 << self.bits)) for _ in range(2))  # a key is held plus one, 0: none
        self.n = 0

    def __len__(self) -> int:
        return self.n

    def _slot(self, key: int) -> int:
        slot, keys = (key * self.ODD & self.ALL) >> (64 - self.bits), self.keys
        while keys[slot] and keys[slot] != key + 1:
            slot = (slot + 1) & (1 << self.bits) - 1
        return slot

    def get(self, key: int) -> int:
        """Its value, -1 if there is none."""
        slot = self._slot(key)
        return self.values[slot] if self.keys[slot] else -1

    def __setitem__(self, key: int, value: int) -> None:
        slot = self._slot(key)
        self.n += not self.keys[slot]
        self.keys[slot], self.values[slot] = key + 1, value

    def of(self, key: np.ndarray) -> np.ndarray:
        keys, values = np.frombuffer(self.keys, np.int64), np.frombuffer(self.values, np.int64)
        slot = ((key.astype(np.uint64) * np.uint64(self.ODD)) >> np.uint64(64 - self.bits)).astype(np.int64)
        out, open_ = np.full(len(key), -1), np.arange(len(key))
        while len(open_):
            met = keys[slot]
            hit = met == key + 1
            out[open_[hit]] = values[slot[hit]]
            on = ~hit & (met != 0)
            open_, key, slot = open_[on], key[on], (slot[on] + 1) & (1 << self.bits) - 1
        return out


class Transducer:
    """Tokens of a byte string under ``ranks``; states are built when met."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        self.trie: dict[int, int] = {}  # node and byte: child
        self.ends, self.depth = [-1], [0]
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            node = 0
            for byte in token:
                child = self.trie.get(node << 8 | byte)
                if child is None:
                    child = self.trie[node << 8 | byte] = len(self.ends)
                    self.ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = child
            self.ends[node] = rank
        self.inner = bytearray(len(self.ends))  # nodes with children: a pair at any other is over
        for key in self.trie:
            self.inner[key >> 8] = 1
        if len(self.ends) >= 1 << NODE or len(self.bytes_of) >= 1 << TOKEN:
            raise ValueError("the vocabulary is too large")
        self.size = [len(x) for x in self.bytes_of]
        self.sizes = np.array(self.size, np.int64)
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self._restart()

    def _restart(self) -> None:
        self.states: list[tuple[int, ...]] = [(0,)]  # pairs: (last token + 1) << NODE | node
        self.number = {self.states[0]: 0}
        self.moves = Moves(4 * STATES)  # state and byte: next state << TOKEN | the token that ends there
        self.unkept = 0

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``; None for a byte, and for a
        token that the merges never make."""
        known = self.halves.get(token, 0)
        if known == 0:
            data = self.bytes_of[token]
            parts = [data[i:i + 1] for i in range(len(data))]
            while len(parts) > 2:
                rank, i = min((self.ranks.get(x + y, 1 << 60), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
                if rank == 1 << 60:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            known = self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return known

    def _kept_apart(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` as they are, side by
        side. Undoes both tokens' merges from the latest back; the two tokens
        then at the border must never have been the next merge."""
        key = left + 1 << NODE | right
        known = self.pairs.get(key)
        if known is not None:
            return known
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        halves, bytes_of, ranks = self.halves, self.bytes_of, self.ranks
        a, b, apart = left, right, True
        for t in (a, b):  # a token that the merges never make
            if t >= 0 and self.size[t] > 1 and not self._halves(t):
                apart = False
        next_merge = 1 << 60  # merges below it come before the one undone last
        while apart and a >= 0:
            if ranks.get(bytes_of[a] + bytes_of[b], 1 << 60) < next_merge:
                apart = False
                break
            undo_a = halves[a] if a in halves else self._halves(a)
            undo_b = halves[b] if b in halves else self._halves(b)
            if undo_a and (not undo_b or a > b):
                next_merge, a = a, undo_a[1]
            elif undo_b:
                next_merge, b = b + 1, undo_b[0]  # at equal rank the border, further left, goes first
            else:
                break
        self.pairs[key] = apart
        return apart

    def _next(self, pairs: tuple[int, ...], byte: int) -> tuple[tuple[int, ...], int]:
        """The pairs after ``byte``, and the token that ends with it."""
        after, ended = [], -1
        trie, ends, inner, checked = self.trie, self.ends, self.inner, self.pairs
        for pair in pairs:
            child = trie.get((pair & NODES) << 8 | byte)
            if child is None:
                continue
            if inner[child]:
                after.append(pair & ~NODES | child)
            if ended < 0:
                token = ends[child]
                if token >= 0:
                    apart = checked.get(pair & ~NODES | token)
                    if apart or apart is None and self._kept_apart((pair >> NODE) - 1, token):
                        ended = token
        if ended < 0:
            raise ValueError("the vocabulary lacks a byte, or its merges are incomplete")
        after.append(ended + 1 << NODE)
        return tuple(after), ended

    def _settled(self, pairs: tuple[int, ...], ended: list[int]) -> int:
        """Up to where the encodings of all pairs still open agree."""
        open_at = {len(ended) - self.depth[pair & NODES] for pair in pairs}
        while len(open_at) > 1:  # the one furthest on goes back a token
            at = max(open_at)
            open_at.remove(at)
            open_at.add(at - self.size[ended[at - 1]])
        return open_at.pop()

    def run(self, data: bytes) -> list[int]:
        if self.unkept > 13 * STATES:
            self._restart()
        out: list[int] = []
        ended: list[int] = []  # the token that ends with each byte not yet given
        state, pairs = 0, self.states[0]
        for at in range(0, len(data), LAG):
            state, pairs = self._read(data[at:at + LAG], state, pairs, ended)
            if at + LAG < len(data):
                upto = self._settled(pairs, ended)
                out += self._path(ended, upto)
                del ended[:upto]
        return out + self._path(ended, len(ended)) if out else self._path(ended, len(ended))

    def _read(self, data: bytes, state: int, pairs: tuple[int, ...], ended: list[int]) -> tuple[int, tuple[int, ...]]:
        """State (-1: not among those kept) and pairs after ``data``; adds to ``ended``."""
        states, number = self.states, self.number
        get, add = self.moves.get, ended.append
        rest = iter(data)
        for byte in rest:
            step = get(state << 8 | byte) if state >= 0 else -1
            if step >= 0:
                add(step & TOKENS)
                state = step >> TOKEN
                continue
            pairs, token = self._next(states[state] if state >= 0 else pairs, byte)
            add(token)
            target = self._kept(state, byte, pairs, token)
            if target < 0:  # what follows is mostly not kept either
                self.unkept += 1
                for byte in rest:
                    pairs, token = self._next(pairs, byte)
                    add(token)
                return number.get(pairs, -1), pairs
            state = target
        return state, states[state] if state >= 0 else pairs

    def _kept(self, state: int, byte: int, pairs: tuple[int, ...], token: int) -> int:
        """The number of the state ``pairs``, met after ``state`` and ``byte``; -1 if the table is full."""
        target = self.number.get(pairs, -1)
        if target < 0:
            if len(self.states) >= STATES:
                return -1
            target = self.number[pairs] = len(self.states)
            self.states.append(pairs)
        if state >= 0 and len(self.moves) < 4 * STATES:
            self.moves[state << 8 | byte] = target << TOKEN | token
        return target

    def run_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed tokens of short pieces, which read the table together."""
        if self.unkept > 13 * STATES:
            self._restart()
        if not pieces:
            return []
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = b"".join(pieces)
        data, begin = np.frombuffer(raw, np.uint8), np.cumsum(size) - size
        ended, state = np.zeros(len(data), np.int64), np.zeros(len(pieces), np.int64)
        live, k = np.arange(len(pieces)), 0
        while len(live := live[size[live] > k]):
            at = begin[live] + k
            key = state[live] << 8 | data[at]
            step = self.moves.of(key)
            new = np.flatnonzero(step < 0)
            if len(new):
                ways, which = np.unique(key[new], return_inverse=True)
                after = [self._next(self.states[way >> 8], way & 255) for way in ways.tolist()]
                target = [self._kept(way >> 8, way & 255, *x) for way, x in zip(ways.tolist(), after)]
                step[new] = np.array([t << TOKEN | token if t >= 0 else -1 for t, (_, token) in zip(target, after)])[which]
                for i in np.flatnonzero(step[new] < 0).tolist():  # the table is full: each such piece by itself
                    (pairs, token), lane, self.unkept = after[which[i]], int(live[new[i]]), self.unkept + 1
                    first = int(at[new[i]])
                    rest = [token]
                    for byte in raw[first + 1:int(begin[lane] + size[lane])]:
                        pairs, token = self._next(pairs, byte)
                        rest.append(token)
                    ended[first:first + len(rest)] = rest
                on = step >= 0
                live, at, step = live[on], at[on], step[on]
            ended[at] = step & TOKENS
            state[live] = step >> TOKEN
            k += 1
        # the tokens, from the last back
        left, count = size.copy(), np.zeros(len(pieces), np.int64)
        lanes, tokens = [], []
        live = np.arange(len(pieces))
        while len(live := live[left[live] > 0]):
            token = ended[begin[live] + left[live] - 1]
            left[live] -= self.sizes[token]
            count[live] += 1
            lanes.append(live)
            tokens.append(token)
        ends = np.cumsum(count)
        out = np.empty(int(ends[-1]), np.int32)
        for t, (lane, token) in enumerate(zip(lanes, tokens)):
            out[ends[lane] - 1 - t] = token
        packed, cuts = out.tobytes(), [0, *(4 * ends).tolist()]
        return [packed[x:y] for x, y in zip(cuts, cuts[1:])]

    def _path(self, ended: list[int], at: int) -> list[int]:
        """Tokens of the encoding that ends at ``at``."""
        path, size = [], self.size
        while at > 0:
            token = ended[at - 1]
            path.append(token)
            at -= size[token]
        path.reverse()
        return path


def basic_plane(pattern: str) -> str:
    """``pattern`` for the standard library, for texts without characters above
    U+FFFF: its Unicode classes are spelled out as ranges."""
    import regex

    def ranges(kind: str) -> str:
        inside = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000 and regex.match(kind, chr(c))]
        out, i = "", 0
        while i < len(inside):
            j = i
            while j + 1 < len(inside) and inside[j + 1] == inside[j] + 1:
                j += 1
            out += f"\\u{inside[i]:04x}-\\u{inside[j]:04x}"
            i = j + 1
        return out

    known: dict[str, str] = {}
    out, in_class, i = "", False, 0
    while i < len(pattern):
        found = regex.match(r"\\p\{\w+\}|\\[sS]", pattern[i:])
        if found:
            kind = found[0]
            named = "\\s" if kind == "\\S" else kind
            if named not in known:
                known[named] = ranges(named)
            body = known[named]
            if kind == "\\S" and in_class:
                raise ValueError("\\S inside a class")
            out += body if in_class else f"[{'^' * (kind == chr(92) + 'S')}{body}]"
            i += len(kind)
            continue
        if pattern[i] == "\\":
            out += pattern[i:i + 2]
            i += 2
            continue
        in_class = (in_class or pattern[i] == "[") and pattern[i] != "]"
        out += pattern[i]
        i += 1
    return out


class Encoder(dict):
    """Packed ids of the pieces met lately; a new piece runs the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, basic: str | None = None):
        import re

        import regex
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.ranks, self.fst = ranks, Transducer(ranks)
        self.any_pieces = regex.compile(pattern).findall
        self.basic_pieces = re.compile(basic or basic_plane(pattern)).findall

    def pieces(self, text: str) -> list[str]:
        return self.basic_pieces(text) if text.isascii() or max(text) < "\U00010000" else self.any_pieces(text)

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            data = piece.encode()
            whole = self.ranks.get(data)
            packed = array("i", self.fst.run(data) if whole is None else (whole,)).tobytes()
        self._keep(piece, packed)
        return packed

    def _keep(self, piece: str, packed: bytes) -> None:
        if len(piece) <= SHORT:
            if len(self) >= PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = packed

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. Short pieces not met lately run together first."""
        split = [self.pieces(t) if t else [] for t in texts]
        older = self.older
        new = [p for p in set(chain.from_iterable(split)) if len(p) <= SHORT and p not in self and p not in older]
        data = [p.encode() for p in new]
        whole = [self.ranks.get(x) for x in data]
        run = iter(self.fst.run_all([x for x, rank in zip(data, whole) if rank is None]))
        for piece, rank in zip(new, whole):
            self._keep(piece, next(run) if rank is None else array("i", (rank,)).tobytes())
        return [np.frombuffer(b"".join(map(self.__getitem__, x)), np.int32) for x in split]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]


class Utf8Stream:
    """Incremental UTF-8 state machine: takes bytes in any cuts and gives
    whole characters; its state is the unfinished character's bytes."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def _needs(lead: int) -> int:
        return 1 if lead < 0x80 else 2 if 0xC0 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if lead >= 0xF0 else 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(4, len(data)) + 1):
            needs = self._needs(data[-back])
            if needs:  # the last lead byte: is its character complete?
                cut = len(data) if needs <= back else len(data) - back
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def decode_stream(ids: list[int], bytes_of: list[bytes], at_once: int = 4096) -> Iterator[str]:
    machine = Utf8Stream()
    for lo in range(0, len(ids), at_once):
        yield machine.feed(b"".join(map(bytes_of.__getitem__, ids[lo:lo + at_once])))
    yield machine.close()


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array<int>) and decoded (string) for every row of ``docs``.

    The vocabulary file (a fixed size of under 1 MB) is read on the driver and
    broadcast; each task keeps its own bounded tables."""
    shared = docs.sparkSession.sparkContext.broadcast(
        {"ranks": read_ranks(ranks_path), "pattern": pattern, "basic": basic_plane(pattern)})

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value  # one object for all tasks of a Python worker
        if "encoder" not in held:
            held["encoder"] = Encoder(held["ranks"], held["pattern"], held["basic"])
        enc = held["encoder"]
        bytes_of = enc.fst.bytes_of
        for b in chunks(batches, at_once=AT_ONCE):
            ids = enc.encode_all(b.column(1).to_pylist())
            decoded = ["".join(decode_stream(x.tolist(), bytes_of)) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), lists(np.concatenate(ids), [len(x) for x in ids], pa.int32()),
                 pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """Counts and SHA-256 digests of ``encode_decode``'s rows, and the columns
    ``more`` as they are."""
    return encoded.select(
        "doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
