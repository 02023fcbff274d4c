"""Whitening, SentencePiece and the conversation trie: edge cases and brute-force comparisons."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from dwellspan.llm import convtrie, pieces, whitening
from dwellspan.llm.queries import QUERIES
from test_corpus_operators import HARD, LONG, SMALL, docs_of, empty, hard  # noqa: F401


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- whitening ---------------------------------------------------------------------------------


def whitened_by_hand(vectors, components):
    x = np.floor(np.array(vectors, dtype=float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return ((n * x - sums) ** 2).sum(axis=1), centred @ vectors / np.sqrt(values), values / np.trace(covariance)


def compare_whitened(got, vectors, components):
    """`got` as collected rows with vec_id the index of the vector."""
    deviation, want, explained = whitened_by_hand(vectors, components)
    z = np.zeros_like(want)
    for r in got:
        z[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[r["vec_id"]] and r["n"] == len(vectors)
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9) and r["identity_error"] < 1e-9
    assert len(got) == want.size
    assert np.abs(z - want * np.sign((z * want).sum(axis=0))).max() < 1e-9


VECTORS = "vec_id bigint, embedding array<float>, number int, ids string, x double, __x int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", 0.5, None) for r in rows], VECTORS)


@pytest.mark.parametrize("block_values", [1 << 18, 70])
def test_whitening_equals_numpy(spark, block_values):
    rng = np.random.default_rng(3)
    mixed = (rng.normal(size=(200, 7)) @ rng.normal(size=(7, 7))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)]
    junk = [(900, None), (901, []), (902, [None] + [1.0] * 6), (903, [float("nan")] * 7), (904, [float("inf")] + [0.0] * 6)]
    df = vectors_of(spark, rows + junk).repartition(5)
    got = whitening.whiten(df, components=5, block_values=block_values).collect()
    compare_whitened(got, [v for _, v in rows], 5)


def test_whitening_of_little(spark):
    none = vectors_of(spark, [])
    assert whitening.whiten(none).collect() == [] and whitening.whiten(none).columns[:2] == ["vec_id", "component"]
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(vectors_of(spark, [(1, None), (2, [float("nan")])])).collect() == []
    # rows without id and repeated rows count; a dimension without variance gives no component
    rows = [(None, [1.0, 5.0]), (3, [2.0, 5.0]), (3, [2.0, 5.0]), (4, [4.0, 5.0])]
    got = whitening.whiten(vectors_of(spark, rows)).collect()
    assert [r["component"] for r in got] == [1] * 4 and sorted((r["vec_id"] or 0) for r in got) == [0, 3, 3, 4]
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(vectors_of(spark, [(1, [1.0]), (2, [1.0, 2.0])]).coalesce(1)).collect()
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(vectors_of(spark, [(1, [1e30]), (2, [1.0])])).collect()


def test_whitening_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    at = {v: i for i, (v, _) in enumerate(rows)}
    got = [{**r.asDict(), "vec_id": at[r["vec_id"]]} for r in QUERIES["op11_whitening"](spark, SMALL).collect()]
    compare_whitened(got, [v for _, v in rows], 32)


# ---- SentencePiece -----------------------------------------------------------------------------

PATH = public_tokenizers.path(pieces.VOCABULARY)
PARTS = [
    "a", "b", "e", "é", "ß", "漢", "字", " ", "  ", "\n", "\t", "!", "1", "23", "'s", "́", "\U0001F600", "the", "ing", " the", "▁",
    "<s>", "</s>", "<unk>", "<0x41>", "\x00", "​", "�", "Straße", "число ", " not", "%%%", "AAAA", "\x7f", " ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_pieces_equal_the_library(library, monkeypatch):
    machine, rng = pieces.Pieces(open(PATH, "rb").read()), random.Random(4)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(50))) for _ in range(3000)]
    texts += ["a" * 5000, "=" * 3000, " " * 2000, "漢字" * 999, "\U0001F600" * 300, "", " ", "▁", LONG, "x" * 20_000]
    for remembered in (pieces.WORDS_BYTES, 4000):
        monkeypatch.setattr(pieces, "WORDS_BYTES", remembered)
        for text in texts:
            ids, begins, ends = machine.encode(text)
            want = library.encode(text)
            assert ids.tolist() == want and machine.decode(ids) == library.decode(want)
            if len(text) < 1000:
                spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
                assert list(zip(begins.tolist(), ends.tolist())) == spans


def test_any_ids_decode_as_in_the_library(library):
    machine, rng = pieces.pieces(PATH), random.Random(5)
    odd = [lambda: rng.randrange(32000), lambda: rng.randrange(3, 260), lambda: rng.randrange(3), lambda: machine.id_of["▁"]]
    for _ in range(5000):
        ids = [rng.choice(odd)() for _ in range(rng.randrange(9))]
        assert machine.decode(np.array(ids, dtype=int)) == library.decode(ids)


def test_normalisation_by_a_compiled_map():
    lib = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    fields = dict(dict(pieces._fields(lib.serialized_model_proto())).items())
    spec = dict(pieces._fields(fields[3]))
    machine = pieces.Pieces.__new__(pieces.Pieces)
    machine.map, machine.own_symbols, machine.suffix, machine.blank = pieces.CharacterMap(spec[2]), None, False, "▁"
    machine.dummy = machine.squeeze = machine.escape = True
    rng = random.Random(6)
    more = [*PARTS, "ﬁ", "①", "ｱ", "ｶﾞ", "à", "Å", "…", "½", "　", " ", "¨", "㌔", "ﷺ"]
    for _ in range(2000):
        text = "".join(rng.choices(more, k=rng.randrange(20)))
        normal, source = machine.normalise(text)
        want, offsets = lib.normalize(text, with_offsets=True)
        bytes_before = [len(text[:i].encode()) for i in range(len(text) + 1)]
        assert normal == want
        assert [int(source[len(normal[:i].encode())]) for i in range(len(normal) + 1)] == [bytes_before[o] for o in offsets]


def _varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def _message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += _varint(number << 3 | 5) + np.float32(value).tobytes()
        elif isinstance(value, int):
            out += _varint(number << 3) + _varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += _varint(number << 3 | 2) + _varint(len(value)) + value
    return out


@pytest.mark.parametrize(("fallback", "unused"), [(0, 5), (1, 5), (0, 1), (1, 1)])
def test_small_models_equal_the_library(fallback, unused):
    """Own symbols, unused pieces, tied scores, pieces with blanks inside, unknown characters in a row."""
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] if fallback else []
    rows += [("ab", -1.0, 1), ("bc", -1.0, 1), ("abc", -2.0, unused), ("abca", -3.0, 1), ("a▁b", -4.0, 1), ("▁a", -2.5, 1), ("[X]", 0.0, 4), ("bb", -1.5, unused), ("qa", -0.5, 1)]
    rows += [(c, -9.0, 1) for c in "abc▁["]
    model = b"".join(_message((1, _message((1, t), (2, s), (3, k)))) for t, s, k in rows)
    model += _message((2, _message((3, 2), (4, len(rows)), (35, fallback))), (3, _message((1, "identity"), (3, 1), (4, 0), (5, 1))))
    lib, machine, rng = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Pieces(model), random.Random(fallback)
    for _ in range(4000):
        text = "".join(rng.choices(["a", "b", "c", " ", "[X]", "[", "é", "z", "q"], k=rng.randrange(14)))
        ids, begins, ends = machine.encode(text)
        proto = lib.encode(text, return_type="proto")
        assert ids.tolist() == [p.id for p in proto.pieces], text
        assert list(zip(begins.tolist(), ends.tolist())) == [(p.begin, p.end) for p in proto.pieces]
        assert machine.decode(ids) == lib.decode(ids.tolist())


def test_pieces_on_hard_rows(spark, hard, empty, library):  # noqa: F811
    both = pieces.encode(hard, PATH, decoded="score")
    assert both.columns == [*[c for c in hard.columns if c not in ("tokens", "score")], "tokens", "begins", "ends", "score"]
    rows = both.select("text", "tokens", "ends", "score").collect()
    assert len(rows) == len(HARD)
    for r in rows:
        assert r["tokens"] == library.encode(r["text"] or "") and r["score"] == (r["text"] or "")
        assert (r["ends"] or [0])[-1] == len((r["text"] or "").encode())
    again = pieces.decode(both.select("tokens", F.lit(1).alias("decoded"), F.lit(2).alias("a.b"), "text"), PATH)
    assert all(r["decoded"] == (r["text"] or "") for r in again.collect()) and "a.b" in again.columns
    assert pieces.encode(empty, PATH).count() == 0
    nothing = spark.createDataFrame([(None,)], "tokens array<int>")
    assert pieces.decode(nothing, PATH).first()["decoded"] == ""


def test_pieces_query(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op12_pieces"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]])
        want = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), True)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["spans_reach_end"]) == want


# ---- conversation trie -------------------------------------------------------------------------


def trie_by_hand(rows, rebuild=True):
    turns = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns.setdefault(conv, []).append((role or "", text or ""))
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = tuple(turns.get(base, [])[:h] + own[h:]) if rebuild else tuple(own)
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(built[c][:d], []).append(c)
    below = {n: [m for m in nodes if len(m) == len(n) + 1 and m[:-1] == n] for n in nodes}

    def totals(node):
        own = (len(nodes[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        parts = [totals(m) for m in below[node]]
        return (sum(p[0] for p in parts) or 1), own + sum(p[1] for p in parts)

    return sorted(
        (m[0], len(n), nodes[n[:-1]][0] if n else None, len(m), len(below[n]), *totals(n), sha(",".join(str(c) for c in m if len(built[c]) == len(n))))
        for n, m in nodes.items()
    )


def trie_rows(spark, rows, limit, rebuild=True):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {n: F.lit(1) for n in ("conv", "depth", "place", "a", "part", "n", "x_leaves")}
    )
    turns = convtrie.numbered_turns(df)
    shape = convtrie.rebuilt_turns if rebuild else convtrie.plain_turns
    return sorted(tuple(r) for r in convtrie.conversation_trie(shape(turns), limit).collect())


def talk(seed, convs):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c * rng.choice([1, 1, 7]) if c % 11 else c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["hi", "ho", "é", "", None, "long one"])))
    return rows


@pytest.mark.parametrize("limit", [200_000, 40, 9])
def test_trie_equals_brute_force(spark, limit):
    rows = talk(1, 60)
    rows += [(c, None, None, None) for c in (5, 5, 71)] + [(-3, 0, "user", "hi"), (None, 0, "user", "hi")]
    rows += [(1003, 0, "user", "gone"), (1004, 0, "x", "y")]  # their family's first is not there: some are left without turns
    assert trie_rows(spark, rows, limit) == trie_by_hand(rows)


def test_trie_of_copies_chains_and_nothing(spark):
    copies = [(c, t, "user", f"t{t}") for c in range(40) for t in range(6)] + [(99, t, "user", f"t{min(t, 3)}") for t in range(70)]
    for limit in (200_000, 12):
        assert trie_rows(spark, copies, limit, rebuild=False) == trie_by_hand(copies, rebuild=False)
    assert trie_rows(spark, [], 10) == []


def test_parentheses_against_a_stack():
    for seed in range(20):
        rng = random.Random(seed)
        n = rng.choice([1, 2, 5, 300, 4000])
        parent = np.array([-1 if i == 0 or rng.random() < 0.01 else rng.choice([i - 1, rng.randrange(i)]) for i in range(n)])
        visited, depth = convtrie.preorder(parent)
        assert sorted(visited.tolist()) == list(range(n))
        tree = convtrie.Parentheses(depth)
        close, stack = {}, []
        for place, step in enumerate(np.diff(np.concatenate([[0], tree.excess])).tolist()):
            if step == 1:
                stack.append(place)
            else:
                close[stack.pop()] = place
        assert tree.find_close(tree.opens).tolist() == [close[o] for o in tree.opens.tolist()]
        leaves = {p for p in range(n) if not (parent == p).any()}
        assert tree.leaf_pair.sum() == len(leaves)


def test_pieces_of_ids_are_joined_in_order(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "JOINED", 3)
    last = [(c, 1, 1, 7, 8, 0, 0, 1) for c in range(50)] + [(100, 1, 1, 7, 9, 0, 0, 1)]
    steps = spark.createDataFrame(last, "conv bigint, depth bigint, len bigint, a bigint, b bigint, pa bigint, pb bigint, bytes bigint")
    got = {r["b"]: r for r in convtrie.end_nodes(steps.repartition(3)).collect()}
    assert got[8]["copies"] == 50 and got[8]["conv"] == 0 and got[8]["ends_sha256"] == sha(",".join(map(str, range(50))))
    assert got[9]["copies"] == 1 and got[9]["ends_sha256"] == sha("100")
