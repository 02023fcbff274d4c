"""SentencePiece BPE encoding with source alignment, and decoding.

Normalisation replaces, at each place, the longest prefix that the compiled character map of the model knows (a double-array trie
and a list of replacements), adds the dummy prefix, and escapes blanks. Each normalised byte remembers the source byte where
its prefix began, so a piece is projected to the bytes of the source text: `begins` and `ends` are UTF-8 offsets. As in the
library, the pieces of a character that falls back to bytes are empty spans but for the last, which has the character.

The best-scored neighbours merge first, the left ones of equals. No merge crosses two neighbouring characters that no piece
has side by side, so texts are cut there into words. New words of a chunk of texts are merged together, array by array, and are
remembered in tables of bounded size. A long word that can't be cut is merged with a heap, in linear memory. Decoding joins pieces, turns runs of byte pieces
into characters, and takes off the dummy prefix.

Nulls: a null text is empty and has no tokens; null tokens decode to an empty text. Repeated rows each keep theirs. Other columns are
carried along; those with the names of the new columns are replaced."""

from __future__ import annotations

import codecs
import re
import struct
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dwellspan.llm.text import add_in_arrow, worker_tables

VOCABULARY = "piece_bpe_32k.model"
WORDS_BYTES = 96 << 20  # of a worker's tables of words, the newer and the older one
LONG_WORD = 48  # characters from which on a word is cut at unknown pairs first
# Piece types and the blank of the format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BLANK = "▁"
NEVER = np.int64(1 << 62)
codecs.register_error("dwellspan-bytewise", lambda e: ("�", e.start + 1))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else 4 if kind == 5 else 8
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """Longest-prefix replacements: a double-array trie over UTF-8 bytes, and strings that end with a zero byte."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size :]
        self.starts = np.zeros(256, dtype=bool)
        for byte in range(1, 256):
            self.starts[byte] = bool(self.units) and self._child(self._below(0, self.units[0]), byte) is not None

    @staticmethod
    def _below(node: int, unit: int) -> int:
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _child(self, node: int, byte: int) -> tuple[int, int] | None:
        at = node ^ byte
        unit = self.units[at] if at < len(self.units) else 0
        return (at, unit) if unit & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes replaced, replacement) of the longest prefix known at this place."""
        node, found = self._below(0, self.units[0]), None
        for place in range(at, len(data)):
            if data[place] == 0 or (step := self._child(node, data[place])) is None:
                break
            node = self._below(*step)
            if step[1] >> 8 & 1:
                found = place + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, model: bytes):
        self.texts, self.kinds, scores = [], [], []
        trainer, normaliser = {}, {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.texts.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("not a BPE model")
        self.map = CharacterMap(normaliser.get(2, b""))
        self.dummy, self.squeeze, self.escape = (bool(normaliser.get(n, 1)) for n in (3, 4, 5))
        self.suffix, self.fallback = bool(trainer.get(24, 0)), bool(trainer.get(35, 0))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.unknown = self.kinds.index(UNKNOWN)
        self.blank = BLANK if self.escape else " "
        self.id_of = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k in (NORMAL, USER_DEFINED, UNUSED)}
        self.byte_id = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == BYTE}
        order = {score: rank for rank, score in enumerate(sorted({scores[i] for i in self.id_of.values()}, reverse=True))}
        self.rank = {t: order[scores[i]] for t, i in self.id_of.items()}
        self.unused = UNUSED in self.kinds
        own = sorted((t for t, k in zip(self.texts, self.kinds) if k == USER_DEFINED), key=len, reverse=True)
        self.own_symbols = re.compile("(" + "|".join(map(re.escape, own)) + ")") if own else None
        pairs = {(x, y) for t in self.rank for x, y in zip(t, t[1:])}
        self.pairs = np.array(sorted(ord(x) << 21 | ord(y) for x, y in pairs), dtype=np.int64)
        # words begin with blanks, unless a piece has a blank behind something else
        whole = any(y == self.blank != x for x, y in pairs)
        self.words_of = (lambda s: [s]) if whole else re.compile(f"{self.blank}+[^{self.blank}]*|[^{self.blank}]+").findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_bytes = 0
        self._tabulate()

    def _tabulate(self) -> None:
        """What each id adds to a decoded text."""
        self.bytes_of = []
        for i, (text, kind) in enumerate(zip(self.texts, self.kinds)):
            if kind == BYTE:
                self.bytes_of.append(bytes([int(text[3:5], 16)]))
            elif kind == CONTROL:
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append((self.unknown_text if i == self.unknown else text.replace(BLANK, " ")).encode())
        self.size = np.array([-1 if k == BYTE else len(t.encode()) for t, k in zip(self.texts, self.kinds)])
        self.byte_of = np.array([int(t[3:5], 16) if k == BYTE else 0 for t, k in zip(self.texts, self.kinds)])
        # a number for each character: its id, after the ids if only longer pieces have it, below zero if none has
        known = {c: len(self.texts) + ord(c) for t in self.id_of for c in t} | self.id_of
        self.number = -1 - np.arange(0x110000, dtype=np.int64)
        for c, i in known.items():
            if len(c) == 1:
                self.number[ord(c)] = i
        merges = {}  # numbers of two neighbours: rank and id of what they merge to
        for text, i in self.id_of.items():
            for cut in range(1, len(text)):
                a, b = known.get(text[:cut]), known.get(text[cut:])
                if a is not None and b is not None:
                    merges[a << 24 | b] = self.rank[text] << 24 | i
        self.pair = np.array(sorted(merges), dtype=np.int64)
        self.merged = np.array([merges[k] for k in self.pair.tolist()] or [0], dtype=np.int64)
        self.control = np.array([k == CONTROL for k in self.kinds])

    # ---- normalisation -----------------------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and of each of its bytes (and its end) the source byte it came from."""
        data = text.encode()
        raw = np.frombuffer(data, np.uint8)
        source, deleted = np.arange(len(raw)), len(raw)
        if self.map.units or self.own_symbols:
            raw, source, deleted = self._replaced(text, data)
        first = 0
        if self.squeeze and len(raw):
            blank = raw == 32
            kept = ~blank
            kept[1:] |= ~blank[:-1]
            if blank[0]:
                kept[0] = False
            leading = int(np.argmin(blank)) if not blank.all() else len(raw)
            first = min(deleted, int(source[leading]) if leading < len(raw) else len(data))
            raw, source = raw[kept], source[kept]
        end = len(data)
        if not len(raw):
            return "", np.array([first if deleted < len(data) else 0])
        if self.escape:
            spread = np.where(raw == 32, 3, 1)
            source = np.repeat(source, spread)
            out = raw.tobytes().replace(b" ", BLANK.encode())
        else:
            out = raw.tobytes()
        blank = self.blank.encode()
        if self.squeeze:
            while out.endswith(blank):
                out = out[: -len(blank)]
                end, source = int(source[len(out)]), source[: len(out)]
            if not out and not self.dummy:
                return "", np.array([first if deleted < len(data) else 0])
        if self.dummy and not self.suffix:
            out, source = blank + out, np.concatenate([np.full(len(blank), first), source])
        elif self.dummy:
            out, source = out + blank, np.concatenate([source, np.full(len(blank), end)])
        return out.decode(), np.append(source, end)

    def _replaced(self, text: str, data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        """Bytes after the replacements, where the prefix of each began, and where the first one that leaves nothing begins.
        Own symbols stay as they are."""
        own, deleted = {}, len(data)
        if self.own_symbols:
            for match in self.own_symbols.finditer(text):
                begin = len(text[: match.start()].encode())
                own[begin] = begin + len(match[0].encode())
        raw = np.frombuffer(data, np.uint8)
        places = self.map.starts[raw] if self.map.units else np.zeros(len(raw), dtype=bool)
        places[list(own)] = True
        parts, sources, done = [], [], 0

        def plain(until: int):
            parts.append(data[done:until])
            sources.append(np.arange(done, until))

        for at in np.flatnonzero(places).tolist():
            if at < done or 0x80 <= data[at] < 0xC0:
                continue
            if at in own:
                plain(at)
                parts.append(data[at : own[at]])
                sources.append(np.arange(at, own[at]))
                done = own[at]
            elif self.map.units and (found := self.map.longest(data, at)):
                plain(at)
                parts.append(found[1])
                sources.append(np.full(len(found[1]), at))
                done = at + found[0]
                deleted = deleted if found[1] else min(deleted, at)
        plain(len(data))
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(sources), deleted

    # ---- encoding ----------------------------------------------------------------------------

    def _merged(self, word: str) -> list[str]:
        """The merges of a word: a heap of (rank, left end, size), stale entries are passed over."""
        size, rank = len(word), self.rank.get
        after, before = array("i", range(1, size + 1)), array("i", range(-1, size))
        heap, split = [], {}

        def offer(left: int, right: int) -> int | None:
            whole = word[left : after[right]]
            place = rank(whole)
            if place is None:
                return None
            if self.kinds[self.id_of[whole]] == UNUSED:
                split[whole] = word[left:right], word[right : after[right]]
            return (place << 32 | left) << 32 | len(whole)

        heap = [entry for left in range(size - 1) if (entry := offer(left, left + 1)) is not None]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            left, long = entry >> 32 & 0xFFFFFFFF, entry & 0xFFFFFFFF
            right = after[left]
            if before[left] == -2 or right >= size or after[right] - left != long:
                continue
            end = after[right]
            after[left] = end
            before[right] = -2  # no symbol begins here any more
            if end < size:
                before[end] = left
                if (entry := offer(left, end)) is not None:
                    heappush(heap, entry)
            if before[left] >= 0 and (entry := offer(before[left], left)) is not None:
                heappush(heap, entry)
        out, at = [], 0
        while at < size:
            out.append(word[at : after[at]])
            at = after[at]
        return out if not split else [p for piece in out for p in self._used(piece, split)]

    def _places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and id of what pairs of numbers merge to; NEVER if they don't."""
        keys = np.where((left < 0) | (right < 0), -1, left << 24 | right)
        if not len(self.pair):
            return np.full(len(keys), NEVER)
        at = np.minimum(np.searchsorted(self.pair, keys), len(self.pair) - 1)
        return np.where(self.pair[at] == keys, self.merged[at], NEVER)

    def _merged_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The merges of many words at once, one in each word per round: the best, the left one of equals. Gives the numbers
        of all words in a row, and where each word's begin."""
        numbers = self.number[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        place = np.full(len(numbers), NEVER)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        place[inside] = self._places(numbers[inside], numbers[inside + 1])
        done = []
        while len(numbers):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(place, starts)
            best = np.repeat(best, np.diff(starts, append=len(owner)))
            if (rest := best == NEVER).any():
                done.append((owner[rest], numbers[rest]))
                going = ~rest
                owner, numbers, place, best = owner[going], numbers[going], place[going], best[going]
                continue
            at = np.flatnonzero(place >> 24 == best >> 24)
            at = at[np.diff(owner[at], prepend=-1) != 0]
            numbers[at] = place[at] & 0xFFFFFF
            keep = np.ones(len(numbers), dtype=bool)
            keep[at + 1] = False
            owner, numbers, place = owner[keep], numbers[keep], place[keep]
            at -= np.arange(len(at))
            for left in (at, at - 1):
                inside = (left >= 0) & (left + 1 < len(owner))
                inside[inside] = owner[left[inside]] == owner[left[inside] + 1]
                place[left[~inside & (left == at)]] = NEVER
                left = left[inside]
                place[left] = self._places(numbers[left], numbers[left + 1])
        owner, numbers = (np.concatenate([d[i] for d in done]) for i in (0, 1))
        order = np.argsort(owner, kind="stable")
        return numbers[order], np.searchsorted(owner[order], np.arange(len(words) + 1))

    def _used(self, piece: str, split: dict[str, tuple[str, str]]) -> list[str]:
        if piece not in split or self.kinds[self.id_of[piece]] != UNUSED:
            return [piece]
        return [p for half in split[piece] for p in self._used(half, split)]

    def _cuts(self, word: str) -> list[str]:
        """A long word, cut between characters that no piece has side by side."""
        points = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.int64)
        keys = points[:-1] << 21 | points[1:]
        at = np.searchsorted(self.pairs, keys)
        cut = np.flatnonzero(self.pairs[np.minimum(at, len(self.pairs) - 1)] != keys) + 1 if len(self.pairs) else np.arange(1, len(points))
        edges = [0, *cut.tolist(), len(word)]
        return [word[a:b] for a, b in zip(edges, edges[1:])]

    def _ids_of(self, piece: str) -> list[int]:
        """The id of a piece; of a character without one its bytes' ids, or without these a negative number."""
        number = self.id_of.get(piece)
        if number is not None:
            return [number]
        return [self.byte_id[b] for b in piece.encode()] if self.fallback else [-1 - ord(piece)]

    def _packed(self, words: list[str]) -> list[bytes]:
        """The ids of words."""
        numbers, edges = self._merged_many(words)
        data, edges = numbers.astype("<i4").tobytes(), edges.tolist()
        out = [data[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]
        strange = np.flatnonzero((numbers < 0) | (numbers >= len(self.texts)))
        of = lambda n: chr(-1 - n if n < 0 else n - len(self.texts))
        for word in np.unique(np.searchsorted(edges, strange, "right") - 1).tolist():
            own = numbers[edges[word] : edges[word + 1]].tolist()
            ids = [i for n in own for i in ([n] if 0 <= n < len(self.texts) else self._ids_of(of(n)))]
            out[word] = array("i", ids).tobytes()
        return out

    def _learn(self, words: list[str]) -> None:
        """Remember new words of at most LONG_WORD characters."""
        new = [w for w in words if w not in self.older]
        packed = {w: self.older[w] for w in words if w in self.older}
        if self.unused:
            packed |= {w: array("i", [i for piece in self._merged(w) for i in self._ids_of(piece)]).tobytes() for w in new}
        elif new:
            packed |= dict(zip(new, self._packed(new)))
        self.known_bytes += sum(200 + len(p) for p in packed.values())  # about what entries take
        if self.known_bytes > WORDS_BYTES // 2:  # words that are not used again go with the older table
            self.known, self.older, self.known_bytes = {}, self.known, 0
        self.known |= packed

    def _long(self, word: str) -> bytes:
        merged = [piece for part in self._cuts(word) for piece in self._merged(part)]
        return array("i", [i for piece in merged for i in self._ids_of(piece)]).tobytes()

    def _sizes(self, ids: np.ndarray) -> np.ndarray:
        """How many normalised bytes each id takes: of a character in bytes, the last one takes all."""
        sizes = self.size[np.maximum(ids, 0)]
        if (at := np.flatnonzero(sizes < 0)).size:
            lead = self.byte_of[ids[at]]
            need = np.where(lead < 0x80, 1, np.where(lead < 0xC0, 0, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4))))
            sizes[at] = 0
            sizes[at[need > 0] + need[need > 0] - 1] = need[need > 0]
        if not self.fallback and (strange := ids < 0).any():
            sizes[strange] = 1 + np.searchsorted([0x80, 0x800, 0x10000], -1 - ids[strange], "right")
        return sizes

    def encode_all(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text its ids, and the source bytes [begin, end) of each."""
        out, normal = [], [self.normalise(text) for text in texts]
        stretches = [self.own_symbols.split(n) if self.own_symbols else [n] for n, _ in normal]
        words = [[self.words_of(s) if place % 2 == 0 else s for place, s in enumerate(parts)] for parts in stretches]
        wanted = {w for parts in words for part in parts[::2] for w in part if len(w) <= LONG_WORD and w not in self.known}
        before = self.known
        self._learn([w for w in wanted if w])
        known = self.known if self.known is before else before | self.known
        for (_, source), parts in zip(normal, words):
            packed = []
            for place, part in enumerate(parts):
                if place % 2:
                    packed.append(array("i", [self.id_of[part]]).tobytes())
                else:
                    packed += [known[w] if len(w) <= LONG_WORD else self._long(w) for w in part if w]
            out.append(self._aligned(np.frombuffer(b"".join(packed), "<i4"), source))
        return out

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.encode_all([text])[0]

    def _aligned(self, ids: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum(self._sizes(ids))
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        if not self.fallback and len(ids):  # neighbouring unknown symbols are one
            ids = np.where(ids < 0, self.unknown, ids)
            first = np.ones(len(ids), dtype=bool)
            first[1:] = (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)
            last = np.append(first[1:], True)
            ids, begins, ends = ids[first], begins[first], ends[last]
        return ids, source[begins], source[ends]

    # ---- decoding ----------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the library gives it."""
        parts = [self.bytes_of[i] for i in ids.tolist()]
        if self.dummy or self.squeeze:
            for place, i in enumerate(ids.tolist()):
                if self.kinds[i] == CONTROL:
                    continue
                plain = self.kinds[i] not in (BYTE, UNKNOWN)
                if plain and self.texts[i].startswith(BLANK):
                    parts[place] = parts[place][1:]
                    if self.squeeze and not parts[place]:
                        continue
                break
        if not self.control[ids].any():
            return b"".join(parts).decode("utf-8", "dwellspan-bytewise")
        edges = [0, *np.flatnonzero(self.control[ids]).tolist(), len(parts)]  # a control symbol ends a run of bytes
        return "".join([b"".join(parts[a:b]).decode("utf-8", "dwellspan-bytewise") for a, b in zip(edges, edges[1:])])


def pieces(path: str) -> Pieces:
    """One for each model file and Python worker."""

    def make() -> Pieces:
        with open(path, "rb") as file:
            return Pieces(file.read())

    return worker_tables(("pieces", path), make)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode(
    docs: DataFrame, path: str, text: str = "text", tokens: str = "tokens", begins: str = "begins", ends: str = "ends",
    decoded: str | None = None,
) -> DataFrame:
    """`docs` with the ids of each text and the bytes [begin, end) of the text that each stands for; with `decoded`, also the
    text that the ids decode to (in the same pass, so a worker holds one table)."""
    new = {tokens: "array<int>", begins: "array<int>", ends: "array<int>"} | ({decoded: "string"} if decoded else {})

    def run(texts: pa.Array) -> list[pa.Array]:
        machine = pieces(path)
        coded = machine.encode_all([value.as_py() or "" for value in texts])
        made = [_lists([c[i] for c in coded]) for i in range(3)]
        return made + ([pa.array([machine.decode(c[0]) for c in coded], pa.string())] if decoded else [])

    return add_in_arrow(docs.drop(*new), text, run, new)


def decode(encoded: DataFrame, path: str, tokens: str = "tokens", decoded: str = "decoded") -> DataFrame:
    """`encoded` with the texts of its ids."""

    def run(lists: pa.Array) -> list[pa.Array]:
        machine = pieces(path)
        return [pa.array([machine.decode(np.array(ids.as_py() or [], np.int64)) for ids in lists], pa.string())]

    return add_in_arrow(encoded.drop(decoded), tokens, run, {decoded: "string"})
