"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

The nondeterministic machine reads bytes along the trie of the vocabulary. A configuration is (trie node, token before it):
some token may still be growing since the place where the token before it ended. When a node completes token t
and (token before, t) is a pair that the merges leave apart, a new configuration starts at the root after t. A token sequence is
what the merges give exactly when all its neighbours are such pairs, so one segmentation of each prefix survives.
Sets of configurations, each with the tokens it has ahead of the others, are the states of the deterministic machine.
They and their transitions are made when first needed, in tables of `TABLE_BYTES`; when these are full, also within a match, all but
the current state is forgotten. Tokens that all configurations share are emitted at once, so lookahead is at most the longest token.

A match of the pattern that is itself a token is emitted whole, as the rank tables' users do. Texts are encoded match by
match; frequent matches are remembered in tables of `MATCH_BYTES`. Decoding feeds the bytes of some thousand tokens at a time to a
UTF-8 machine that holds back at most three bytes, and so turns a stream of tokens into text.

Nulls: a null text is empty and has no tokens; null tokens decode to an empty text, bytes that are no UTF-8 to U+FFFD. Repeated rows
each keep theirs. Other columns are carried along; those with the names of the new columns are replaced."""

from __future__ import annotations

import base64
import marshal
import struct
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from dwellspan.llm.text import add_in_arrow, worker_tables

VOCABULARY = "byte_bpe_50k.tiktoken"
TABLE_BYTES = 128 << 20  # of states, transitions and pairs of a worker
MATCH_BYTES = 80 << 20  # of remembered matches, the newer and the older ones
EMITTED_BITS = 24  # of a transition, for the place of what it emits: more places than the tables have room for
EMITTED_MASK = (1 << EMITTED_BITS) - 1
DECODED = 4096  # tokens that are decoded at a time
_bytes: dict[str, list[bytes]] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def by_rank(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The merges by definition: always the pair of lowest rank, the first of equals. For short pieces."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    known, never = ranks.get, 1 << 60
    pairs = [known(a + b, never) for a, b in zip(parts, parts[1:])]
    while pairs:
        rank = min(pairs)
        if rank == never:
            break
        at = pairs.index(rank)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = known(parts[at - 1] + parts[at], never)
        if at < len(pairs):
            pairs[at] = known(parts[at] + parts[at + 1], never)
    return parts


class Transducer:
    """Encoder of one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.matches_of = ranks, regex.compile(pattern).findall
        self.token_bytes = by_rank(ranks)
        self.child: dict[int, int] = {}  # 256 * node + byte: node below
        self.token_at: list[int] = [-1]
        self.inner: list[bool] = [False]
        for token, rank in ranks.items():
            if merge(token, ranks) != [token]:
                continue  # the merges never make it; only a whole match can be this token
            node = 0
            for byte in token:
                step = self.child.get(node << 8 | byte)
                if step is None:
                    step = self.child[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = step
            self.token_at[node] = rank
        self.remembered: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.match_bytes = 0
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.states: list[bytes] = []  # packed configurations, which take a quarter of the room of tuples
        self.steps: dict[int, int] = {}  # 256 * state + byte: the state behind, and the place of the tokens emitted in the low bits
        self.emitted: list[tuple[int, ...]] = [()]
        self.emitted_at: dict[tuple[int, ...], int] = {(): 0}
        self.apart: dict[int, bool] = {}
        self.table_bytes = 0
        self._state(((0, -1, ()),))

    def _state(self, configurations: tuple) -> int:
        return self._packed_state(marshal.dumps(configurations, 2))  # version 2: equal values give equal bytes

    def _packed_state(self, packed: bytes) -> int:
        at = self.number.get(packed)
        if at is None:
            at = self.number[packed] = len(self.states)
            self.states.append(packed)
            self.table_bytes += 170 + len(packed)  # about what these objects take, as measured
        return at

    def stays_apart(self, before: int, token: int) -> bool:
        """Whether the merges leave this pair of tokens as it is."""
        known = self.apart.get(before << 20 | token)
        if known is None:
            a, b = self.token_bytes[before], self.token_bytes[token]
            known = self.apart[before << 20 | token] = merge(a + b, self.ranks) == [a, b]
            self.table_bytes += 65
        return known

    def _place(self, emitted: tuple[int, ...]) -> int:
        place = self.emitted_at.get(emitted)
        if place is None:
            place = self.emitted_at[emitted] = len(self.emitted)
            self.emitted.append(emitted)
            self.table_bytes += 190 + 8 * len(emitted)
        return place

    def _step(self, state: int, byte: int) -> int:
        """The transition, made and kept."""
        if self.table_bytes > TABLE_BYTES:
            here = self.states[state]
            self._forget()
            state = self._packed_state(here)
        moved, ended, inner, child, token_at = [], None, self.inner, self.child.get, self.token_at
        for node, before, ahead in marshal.loads(self.states[state]):
            step = child(node << 8 | byte)
            if step is None:
                continue
            if inner[step]:
                moved.append((step, before, ahead))
            if ended is None:
                token = token_at[step]
                if token >= 0 and (before < 0 or self.stays_apart(before, token)):
                    ended = (0, token, (*ahead, token))
        if ended:
            moved.append(ended)
        emitted = moved[0][2]
        for _, _, ahead in moved:  # the tokens that all are agreed on
            if not emitted:
                break
            if ahead[: len(emitted)] != emitted:
                emitted = emitted[: next(i for i, t in enumerate(emitted) if i >= len(ahead) or ahead[i] != t)]
        if n := len(emitted):
            moved = [(node, before, ahead[n:]) for node, before, ahead in moved]
        step = self.steps[state << 8 | byte] = self._state(tuple(moved)) << EMITTED_BITS | self._place(emitted)
        self.table_bytes += 140
        return step

    def encode_match(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, out = 0, []
        for byte in piece:
            step = self.steps.get(state << 8 | byte)
            if step is None:
                step = self._step(state, byte)
            state, place = step >> EMITTED_BITS, step & EMITTED_MASK
            if place:
                out += self.emitted[place]
        out += marshal.loads(self.states[state])[-1][2]  # the configuration at the root: all bytes are in tokens
        return out

    def _learn(self, match: str) -> bytes:
        packed = self.older.get(match)
        if packed is None:
            ids = self.encode_match(match.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
            if len(match) > 64:
                return packed
        self.match_bytes += 140 + len(packed)
        if self.match_bytes > MATCH_BYTES // 2:  # matches that don't come again go with the older table
            self.remembered, self.older, self.match_bytes = {}, self.remembered, 0
        self.remembered[match] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        learn = self._learn
        return b"".join([self.remembered.get(match) or learn(match) for match in self.matches_of(text)])


class Utf8Stream:
    """Bytes to text, in pieces of any size: holds back the at most three bytes of an unfinished code point."""

    def __init__(self):
        self.held = b""

    def feed(self, piece: bytes) -> str:
        data = self.held + piece
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:  # a leading byte: how many should follow?
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                keep = back if need > back else 0
                break
            if byte < 0x80:
                break
        ready, self.held = data[: len(data) - keep], data[len(data) - keep :]
        return ready.decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def stream_decode(ids: Iterable[int], token_bytes: list[bytes], at_once: int = 1) -> Iterator[str]:
    """Text as soon as its bytes are there, from `at_once` tokens at a time."""
    stream, coming = Utf8Stream(), iter(ids)
    while some := list(islice(coming, at_once)):
        if piece := stream.feed(b"".join([token_bytes[token] for token in some])):
            yield piece
    if piece := stream.end():
        yield piece


def text_of(tokens: bytes, token_bytes: list[bytes]) -> str:
    return "".join(stream_decode(memoryview(tokens).cast("I"), token_bytes, DECODED))


def transducer(path: str, pattern: str) -> Transducer:
    """One for each vocabulary and Python worker."""
    return worker_tables(("bpe", path, pattern), lambda: Transducer(read_ranks(path), pattern))


def vocabulary(path: str) -> list[bytes]:
    """The tokens' bytes by id, which is all that decoding needs; one list for each Python worker."""
    if path not in _bytes:
        _bytes[path] = by_rank(read_ranks(path))
    return _bytes[path]


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", tokens: str = "tokens", n_tokens: str = "n_tokens",
    decoded: str | None = None,
) -> DataFrame:
    """`docs` with the ids of each text, packed as little-endian unsigned 32-bit integers, and their number; with `decoded`, also
    the text that these ids decode to, in the same pass, so each core has one worker."""
    new = {tokens: "binary", n_tokens: "bigint"} | ({decoded: "string"} if decoded else {})

    def run(texts: pa.Array) -> list[pa.Array]:
        machine = transducer(path, pattern)
        packed = [machine.encode(value.as_py() or "") for value in texts]
        made = [pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64())]
        return made + ([pa.array([text_of(p, machine.token_bytes) for p in packed], pa.string())] if decoded else [])

    return add_in_arrow(docs.drop(*new), text, run, new)


def decode(encoded: DataFrame, path: str, tokens: str = "tokens", decoded: str = "decoded") -> DataFrame:
    """`encoded` with the texts of its ids."""

    def run(packed: pa.Array) -> list[pa.Array]:
        token_bytes = vocabulary(path)
        return [pa.array([text_of(value.as_py() or b"", token_bytes) for value in packed], pa.string())]

    return add_in_arrow(encoded.drop(decoded), tokens, run, {decoded: "string"})


def ids_of(tokens: bytes) -> np.ndarray:
    return np.frombuffer(tokens, "<u4")
