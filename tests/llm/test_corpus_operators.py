"""Edge cases and brute-force comparisons of the corpus operators."""

import hashlib
import random
import re
import weakref

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dwellspan.llm import bpe, chat, decontaminate, langid, linededup, merkle, neardup, pieces, quality, sharding, urlfilter
from dwellspan.llm.graph import components
from dwellspan.llm.queries import ORACLES, QUERIES
from dwellspan.llm.text import text_chunks

SMALL = "/root/testdata/sf0.001"
# Columns whose names the operators use for their own columns.
EXTRA = (
    "lang string, score double, n_words bigint, shard int, slot int, size int, tokens string, __th1 int, __text int, statistics int, "
    "block int, next_text string, n int, parent int, said int, __host int, __share int, rows int, c0 int, n0 int, pos int, line string, "
    "k1 int, doc int, first int, class_id int, a.b int"
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def docs_of(spark, rows):
    """(doc_id, text) rows with clashing columns, null in all of them."""
    base = spark.createDataFrame(rows, "doc_id bigint, text string")
    return base.selectExpr("*", *[f"cast(null as {c.split()[1]}) as `{c.split()[0]}`" for c in EXTRA.split(", ")])


LONG = " ".join(f"w{i % 977}" for i in range(120_000))
HARD = [
    (1, None), (2, ""), (None, "no id here at all, but words"), (3, "Same text here, twice over.\nA line of words"),
    (3, "Same text here, twice over.\nA line of words"), (4, "same TEXT here, twice over.\n  A line of words\t"), (5, "!!!"), (6, LONG),
    (7, "é ü 漢字 \U0001F600 ß" * 3), (8, "\n\n"), (None, None), (9, "a\x0bline \x00 of\tcontrol"),
]


@pytest.fixture(scope="module")
def hard(spark):
    return docs_of(spark, HARD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    from tools.check_oracles import connect, difference

    got = QUERIES[name](spark, SMALL).toPandas()
    problem = difference(got, connect(SMALL).execute(ORACLES[name]).df())
    assert problem is None


# ---- quality -----------------------------------------------------------------------------------


def test_quality_learns_and_holds_out(spark):
    got = QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id"
    ).toPandas()
    held = got[got.held_out]
    ranks, good = held.score.rank(), held.quality == 1
    auc = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / good.sum() / (~good).sum()
    assert auc > 0.97 and (held.predicted == held.quality).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_quality_statistics_do_not_depend_on_neighbours(spark, hard):
    alone = {}
    for text in {t for _, t in HARD}:
        alone[text] = quality.with_statistics(docs_of(spark, [(0, text)])).first()["statistics"] if text != LONG else None
    for row in quality.with_statistics(hard, keep=("doc_id", "text")).collect():
        if alone[row["text"]] is not None:
            assert row["statistics"] == pytest.approx(alone[row["text"]])


def test_quality_without_labels_and_on_empty_tables(spark, hard, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    scored, model = quality.train_and_score(hard, labels)
    assert {r["score"] for r in scored.collect()} == {0.5} and scored.count() == len(HARD)
    assert quality.keep_good(hard, model).count() == len(HARD)
    assert quality.train_and_score(empty, labels)[0].count() == 0
    odd = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (4, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert quality.train_and_score(hard, odd)[0].count() == len(HARD)


def test_rising_curve_pools_violators():
    import numpy as np

    assert quality._rising(np.array([1, 1, 2, 1]), np.array([0, 1, 1, 1])).tolist() == pytest.approx([0, 2 / 3, 2 / 3, 1])


def test_quality_equals_ridge_and_isotonic_by_hand(spark):
    import numpy as np

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.labelled(quality.with_statistics(docs, "text", ("doc_id",)), labels).cache()
    model = quality.fit_quality(rows)
    got = rows.collect()
    x, y, c = (np.array([r[i] for r in got]) for i in range(3))
    y = y.astype(float)
    assert np.allclose(model.mean, x[~c].mean(axis=0))
    spread = x[~c].std(axis=0)
    assert np.allclose(model.scale, np.where(spread < 1e-9, 1.0, spread), rtol=1e-6)
    z, mean = model.features(x[~c]), y[~c].mean()
    penalty = np.diag([quality.RIDGE] * (z.shape[1] - 1) + [1e-6])
    want = np.linalg.solve(z.T @ z + penalty, z.T @ (y[~c] - mean))
    want[-1] += mean
    assert np.allclose(model.weights, want, rtol=1e-5, atol=1e-7)
    at = np.clip((model.raw(x[c]) + 1) / 3 * quality.BINS, 0, quality.BINS - 1).astype(int)
    cells = sorted(set(at.tolist()))
    n, total = (np.array([f(y[c][at == i]) for i in cells], float) for f in (len, sum))
    rising = [
        max(min(total[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, len(cells))) for a in range(i + 1)) for i in range(len(cells))
    ]
    assert np.allclose(model.levels * (1 + 1e-3) - 1e-3 * (model.edges + 1) / 3, rising)


# ---- decontamination ---------------------------------------------------------------------------


def contaminated_by_hand(text, items):
    w, hit, found = words(text), set(), set()
    for item, item_text in items:
        iw = words(item_text)
        n = min(13, len(iw))
        windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if iw else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), len(found)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["the", "a", "of", "é", "x1", "to", "and"]  # few words: many accidental and shifted matches
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 12, 13, 14, 30])))) for i in range(40)] + [(41, None), (42, "the " * 40)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 80)))) for i in range(150)]
    docs += [(200 + i, f"so {items[i][1]} ends") for i in range(40)] + [(300, "the " * 300), (301, None), (301, None)]
    got = decontaminate.contamination(
        decontaminate.find_windows(docs_of(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    ).collect()
    texts = dict(docs)
    assert len(got) == len(docs)
    for row in got:
        assert (row["n_words"], row["n_hit"], row["n_items"]) == contaminated_by_hand(texts[row["doc_id"]], items), row


def test_decontamination_edges(spark, hard, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    items = spark.createDataFrame([(1, "no id HERE at all, but words"), (None, "w1 w2")], "item_id bigint, text string")
    assert decontaminate.decontaminate(hard, none).count() == len(HARD)
    kept = decontaminate.decontaminate(hard, items)
    assert kept.columns == hard.columns and {r["text"] for r in kept.collect()} == {t for _, t in HARD} - {HARD[2][1]}
    assert decontaminate.decontaminate(empty, items).count() == 0


# ---- near duplicates ---------------------------------------------------------------------------


def classes_by_hand(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        w = words(text)
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) / max(1, len(sets[i] | sets[j])) >= threshold or sets[i] == sets[j]:
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [(rows[i][0], rows[top(i)][0], links[i]) for i in range(len(rows))]


@pytest.mark.parametrize("block_rows", [256, 7])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block_rows)  # 7: groups are cut into blocks
    rng = random.Random(block_rows)
    rows, n = [], 0
    for group in range(12):
        base = [f"g{group}w{rng.randrange(500)}" for _ in range(rng.choice([4, 5, 9, 60, 120]))]
        for _ in range(rng.choice([1, 2, 5, 25])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
            rows.append((n, " ".join(text)))
            n += 1
    rows += [(n, ""), (n + 1, "?!"), (n + 2, None)]
    got = sorted(tuple(r) for r in neardup.near_duplicates(docs_of(spark, rows)).collect())
    assert got == classes_by_hand(rows)


def test_near_duplicates_edges(spark, hard, empty):
    got = neardup.near_duplicates(hard).collect()
    assert len(got) == len(HARD)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["class_id"] == by_id[4]["class_id"] == 3 and by_id[6]["class_id"] == 6
    kept = neardup.drop_near_duplicates(hard)
    assert kept.columns == hard.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 9]
    assert neardup.drop_near_duplicates(empty).count() == 0


@pytest.mark.parametrize("shared_id", [None, 7])
def test_near_duplicates_of_a_shared_id(spark, monkeypatch, shared_id):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 2)
    texts = [[f"t{t}w{i}" for i in range(60)] for t in range(4)]
    a, b, c, d = (" ".join(t) for t in texts)
    near_a, near_b, near_d = (" ".join([*t[:-1], "edited"]) for t in (texts[0], texts[1], texts[3]))
    shared = [(shared_id, t) for t in (a, b, c, d, near_d, d)]  # c resembles nothing, d and near_d each other
    rows = [(5, near_a), (9, near_b), *shared]
    low_a, low_b, own = (5, 7 if shared_id else 9, shared_id)
    got = sorted(neardup.near_duplicates(docs_of(spark, rows)).collect(), key=str)
    want = [
        (5, low_a, 1), (9, low_b, 1), (shared_id, low_a, 1), (shared_id, low_b, 1), (shared_id, own, 0), *[(shared_id, own, 2)] * 3,
    ]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = [tuple(r) for r in neardup.drop_near_duplicates(docs_of(spark, rows)).select("doc_id", "text").collect()]
    assert len(kept) == 4 and (5, near_a) in kept and (shared_id, c) in kept
    assert ((shared_id, b) if shared_id else (9, near_b)) in kept
    assert ((shared_id, d) in kept) != ((shared_id, near_d) in kept)


def test_prefixes_are_shortened_to_the_target():
    assert neardup.prefix_depth(24, 0.8, 0.99999) == 4 and neardup.prefix_depth(24, 0.8, 0.5) == 8
    with pytest.raises(ValueError):
        neardup.prefix_depth(2, 0.8, 0.99999)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 150)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 150: 150, 200: 150}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---- fingerprints ------------------------------------------------------------------------------


def test_fingerprints(spark, hard, empty):
    rows = merkle.with_next_text(hard, block_rows=3).select("doc_id", "text", "next_text").collect()
    order = sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = [(*order[i], order[(i + 1) % len(order)][1]) for i in range(len(order))]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted((tuple(r) for r in rows), key=key) == sorted(want, key=key)
    assert merkle.with_next_text(empty).count() == 0
    prints = merkle.fingerprints(hard).select("text", "fingerprint").collect()
    assert len({r["fingerprint"] for r in prints}) == len({r["text"] or "" for r in prints})
    pair = spark.createDataFrame([("One line.\nTwo lines.\nThree.", "One line.\nTwo lanes.\nThree.")], "a string, b string").select(
        merkle.fingerprint(F.col("a")).alias("a"), merkle.fingerprint(F.col("b")).alias("b")
    ).select(merkle.likeness(F.col("a"), F.col("b")).alias("near"), merkle.edited_leaves(F.col("a"), F.col("b")).alias("where")).first()
    assert pair["near"] == pytest.approx(2 / 3) and pair["where"] == [1]


def test_edits_are_located_by_branches(spark):
    """Against counting by hand: sections that differ, and in them leaves that the other side lacks."""
    from collections import Counter

    rng, rows = random.Random(12), [("A. B. A. C.", "Z. B. Z. C."), ("A. A. B.", "A. B."), ("", "A."), ("A.", ""), (None, ""), ("A. ", "A. ")]
    for _ in range(80):
        leaves = rng.choices([f"p{i}. " for i in range(12)], k=rng.randrange(25))
        other = [rng.choice([x, x, x, x, "new. ", ""]) for x in leaves]
        rows.append(("".join(leaves), "".join(other)))
    got = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", merkle.fingerprint(F.col("a")).alias("fa"), merkle.fingerprint(F.col("b")).alias("fb")
    ).select("a", "b", "fa", "fb", merkle.edited_leaves(F.col("fa"), F.col("fb")).alias("where")).collect()

    def sections(print_):
        at, out = 0, []
        for s in print_.split(":")[1].split("|"):
            digest, leaves = s.split("=")
            leaves = [x for x in leaves.split(",") if x]
            out.append((digest, [(x, at + i) for i, x in enumerate(leaves)]))
            at += len(leaves)
        return out

    def beyond(mine, other):
        left, out = Counter(k for k, _ in other), []
        for item in mine:
            left[item[0]] -= 1
            out += [item] if left[item[0]] < 0 else []
        return out

    for r in got:
        a, b = sections(r["fa"]), sections(r["fb"])
        mine, other = ([x for _, leaves in beyond(s, t) for x in leaves] for s, t in ((a, b), (b, a)))
        assert r["where"] == sorted(place for _, place in beyond(mine, other)), (r["a"], r["b"])
    assert got[0]["where"] == [0, 2] and len(got[1]["where"]) == 1 and got[5]["where"] == []


# ---- sharding ----------------------------------------------------------------------------------


def test_shards_are_a_dealt_permutation(spark, hard, empty):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    for df in (docs.coalesce(3), hard.repartition(3)):  # the second one isn't repeatable for sure
        out = sharding.shuffle_into_shards(df, 7, bucket_bytes=2000)
        rows = out.collect()
        assert len(rows) == df.count() and out.columns.count("shard") == 1
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        sizes = [len(slots.get(i, [])) for i in range(7)]
        assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in df.collect())
    order = [r["doc_id"] for r in sharding.shuffle_into_shards(docs, 1).orderBy("slot").collect()]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 20
    assert sharding.shuffle_into_shards(empty).count() == 0


def test_sharding_query_digests(spark):
    import zlib

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op5_sharding"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    slots = {}
    for r in got:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


# ---- byte-level BPE ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def machine():
    import public_tokenizers

    return bpe.transducer(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


def test_a_worker_gives_up_tables_when_it_works_for_another_operator():
    import public_tokenizers

    path = public_tokenizers.path(bpe.VOCABULARY)
    assert not list(text_chunks(pa.array([], pa.string())))
    made = weakref.ref(bpe.transducer(path, public_tokenizers.PATTERN))
    assert bpe.transducer(path, public_tokenizers.PATTERN) is made()  # kept for the next task
    assert len(list(text_chunks(pa.array(["a text", None])))) == 1
    assert made() is None
    made = weakref.ref(bpe.transducer(path, public_tokenizers.PATTERN))
    pieces.pieces(public_tokenizers.path(pieces.VOCABULARY))
    assert made() is None


def test_bpe_equals_the_merges(machine, monkeypatch):
    import public_tokenizers
    import tiktoken

    judge = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=machine.ranks, special_tokens={})
    rng = random.Random(3)
    parts = ["a", "b", "e", "é", "ß", "漢", " ", "\n", "!", "1", "'s", "\u0301", "\U0001F600", "the", "ing", "%%%", "AAAA", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["a" * 5000, "=" * 3000, " " * 2000, "é" * 999, "\U0001F600" * 300, LONG, ""]
    for table, remembered in ((bpe.TABLE_BYTES, bpe.MATCH_BYTES), (20_000, 2_000)):  # small: forgotten all the time
        monkeypatch.setattr(bpe, "TABLE_BYTES", table)
        monkeypatch.setattr(bpe, "MATCH_BYTES", remembered)
        machine.remembered.clear()
        machine.older.clear()
        for text in texts:
            assert bpe.ids_of(machine.encode(text)).tolist() == judge.encode_ordinary(text)
    ids = bpe.ids_of(machine.encode(texts[0] + "漢字 \U0001F600é"))
    for at_once in (1, 3, 1000):
        pieces = list(bpe.stream_decode(ids.tolist(), machine.token_bytes, at_once))
        assert "".join(pieces) == texts[0] + "漢字 \U0001F600é"


def test_bpe_tables_are_bounded_within_a_match(machine, monkeypatch):
    import tiktoken
    import public_tokenizers

    monkeypatch.setattr(bpe, "TABLE_BYTES", 4 << 20)
    rng = random.Random(9)
    match = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzéß", k=2_000_000))  # one match of the pattern
    machine._forget()
    largest, step = 0, machine._step

    def watched(state, byte):
        nonlocal largest
        out = step(state, byte)
        largest = max(largest, machine.table_bytes)
        return out

    monkeypatch.setattr(machine, "_step", watched)
    got = machine.encode(match)
    assert largest < (4 << 20) + 100_000 and bpe.text_of(got, machine.token_bytes) == match
    judge = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=machine.ranks, special_tokens={})
    head = match[:20_000]  # the other library is too slow on the whole
    assert bpe.ids_of(machine.encode(head)).tolist() == judge.encode_ordinary(head)


def test_bpe_tables_take_the_memory_they_count(machine):
    """Workers keep them until they end, so two of them and an executor's heap must fit its memory."""
    import tracemalloc

    rng = random.Random(1)
    matches = ["".join(rng.choices("etaoinshrdlucmfwypvbgk", k=rng.randint(6, 14))).encode() for _ in range(4000)]
    machine._forget()
    tracemalloc.start()
    try:
        for match in matches:
            machine.encode_match(match)
        taken = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert taken < 1.1 * machine.table_bytes and taken < 400 * len(machine.steps)  # 492 a transition as tuples
    assert bpe.TABLE_BYTES + bpe.MATCH_BYTES <= 208 << 20


def test_utf8_stream_holds_unfinished_code_points():
    for text in ("é漢\U0001F600a", ""):
        data = text.encode()
        stream = bpe.Utf8Stream()
        assert "".join([stream.feed(data[i : i + 1]) for i in range(len(data))] + [stream.end()]) == text
    stream = bpe.Utf8Stream()
    assert stream.feed(b"a\xff\xc3") + stream.feed(b"b") + stream.feed(b"\xe6\xbc") + stream.end() == b"a\xff\xc3b\xe6\xbc".decode("utf-8", "replace")


def test_bpe_round_trip(spark, hard, empty):
    import public_tokenizers

    vocabulary = public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN
    back = bpe.decode(bpe.encode(hard, *vocabulary), vocabulary[0])
    rows = back.select("text", "decoded", "n_tokens", F.octet_length("tokens").alias("n")).collect()
    assert len(rows) == len(HARD) and all((r["text"] or "") == r["decoded"] and r["n"] == 4 * r["n_tokens"] for r in rows)
    once = bpe.encode(hard, *vocabulary, decoded="score").select("text", "score").collect()
    assert all((r["text"] or "") == r["score"] for r in once)
    assert bpe.encode(empty, *vocabulary).count() == 0


def test_bpe_query_digests_equal_the_library(spark):
    import numpy as np
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
    judge = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op6_bpe"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = judge.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(judge.decode_bytes(ids)).hexdigest()


# ---- language ----------------------------------------------------------------------------------


def test_language_evidence(spark):
    docs = spark.createDataFrame(
        [("the cat and the dog went there", "en"), ("der Hund und die Katze gehen dort", "de"), ("x", None), (None, "en")], "text string, lang string"
    )
    model = langid.fit_text_model(docs)
    page = lambda lang, text: f'<html lang="{lang}"><style>x</style><p>{text}</p></html>'
    rows = [(i, "http://a.de/x", page("de", "und der Hund und die Katze")) for i in range(20)]
    rows += [(20, "http://a.de/y", page("de", "zzz")), (21, "http://b.org/", page("en", "the dog and there the cat")), (22, None, None), (22, "", "<p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns(
        {c: F.lit("old") for c in ("lang", "n", "parent", "said", "__host", "__share", "__logs", "nd", "ns", "all", "a.b", "c1")}
    )
    assert set(langid.identify(pages, model).select("__host", "`a.b`", "n").distinct().collect()) == {("old",) * 3}
    got = {(r["page_id"], r["url"]): r for r in langid.identify(pages, model).collect()}
    assert len(got) == len(rows)
    assert got[20, "http://a.de/y"]["lang"] == "de"  # no text, but the host and the markup say so
    assert got[21, "http://b.org/"]["lang"] == "en" and got[22, None]["lang"] in ("de", "en") and got[22, None]["declared"] is None
    assert langid.identify(pages.limit(0), model).count() == 0
    nothing = langid.fit_text_model(docs.limit(0))
    assert {r["lang"] for r in langid.identify(pages, nothing).collect()} == {None}


def test_language_of_text_in_navigation_only():
    menu = "<nav>der Hund</nav><script>x = 1</script><style>p {}</style><!-- c --><footer>die Katze</footer>"
    assert langid.visible_text(menu).split() == ["der", "Hund", "die", "Katze"]
    assert langid.visible_text(f"{menu}<p>the dog</p>").split() == ["the", "dog"]
    assert not langid.visible_text("<script>x</script><p> &nbsp; </p>").strip()


@pytest.mark.parametrize("mark", ["<nav>", "<!--", "<html ", "<", "</nav  ", "<html lang", "<nav></nav", "<script x"])
def test_hostile_markup_takes_linear_time(mark):
    import time

    page = mark * (1_000_000 // len(mark))
    started = time.process_time()
    langid.visible_text(page)
    langid.declared_language(page)
    assert time.process_time() - started < 3


def test_language_equals_bayes_by_hand(spark):
    """The same sums and products over a small table, one page at a time."""
    import numpy as np

    docs = [("the cat and the dog went there", "en"), ("der Hund und die Katze gehen dort", "de"), ("le chat et le chien", "fr")]
    model = langid.fit_text_model(spark.createDataFrame(docs, "text string, lang string"))
    rng = random.Random(8)
    rows = []
    for i in range(60):
        text = " ".join(rng.choices(docs[rng.randrange(3)][0].split(), k=rng.randrange(6)))
        said = rng.choice(["", ' lang="en"', ' lang="de"', ' lang="xx"'])
        rows.append((i, f"http://{rng.choice(['a.de', 'b.de', 'www.b.de', 'c.org', '1.c.org'])}/", f"<html{said}><p>{text}</p>"))
    rows.append((60, None, None))
    width = len(model.languages)
    pages = []
    for page_id, url, markup in rows:
        host = url.split("/")[2] if url else ""
        data = langid.visible_text(markup or "").encode()
        logs = model.log_likelihoods(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
        share = np.exp(logs - logs.max())
        pages.append((page_id, host, ".".join(host.split(".")[-2:]), host.split(".")[-1], langid.declared_language(markup or ""), logs, share / share.sum()))
    total = lambda chosen: sum((p[6] for p in chosen), np.zeros(width))
    smooth = lambda counts, above: (counts + langid.STRENGTH * above) / (counts.sum() + langid.STRENGTH)
    values = {p[4] for p in pages if p[4]}
    said_in_all = total([p for p in pages if p[4]])
    want = {}
    for page_id, host, domain, suffix, said, logs, share in pages:
        prior = smooth(total(pages), np.full(width, 1 / width))
        prior = smooth(total([p for p in pages if p[3] == suffix]), prior)
        prior = smooth(total([p for p in pages if p[2:4] == (domain, suffix)]), prior)
        prior = smooth(np.maximum(total([p for p in pages if p[1] == host]) - share, 0), prior)
        score = logs + np.log(prior)
        if said:
            score = score + np.log((total([p for p in pages if p[4] == said]) + 1) / (said_in_all + len(values)))
        mass = np.exp(score - score.max())
        want[page_id] = model.languages[int(score.argmax())], 1 / mass.sum()
    got = langid.identify(spark.createDataFrame(rows, "page_id bigint, url string, html string"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["lang"] == want[r["page_id"]][0] and r["confidence"] == pytest.approx(want[r["page_id"]][1])


def test_language_of_given_pages(spark):
    got = QUERIES["op7_langid"](spark, SMALL).toPandas()
    assert (got.lang == got.declared).mean() > 0.95 and got.confidence.between(0, 1).all()


# ---- line dedup --------------------------------------------------------------------------------


@pytest.mark.parametrize("min_docs", [2, 3])
def test_lines_equal_brute_force(spark, min_docs):
    rng = random.Random(min_docs)
    pool = ["short", "a line that is shared", "A LINE that is Shared ", "\tanother shared line\r", "Éine Zeile von vielen", "", "unique 1 line long enough"]
    rows = [(i, "\n".join(rng.choices(pool + [f"only in {i} and nowhere"], k=rng.randrange(0, 9)))) for i in range(60)]
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for doc, text in rows:
        for line in text.split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(doc)
    want = {}
    for doc, text in rows:
        kept = [x for x in text.split("\n") if len(holders.get(key(x), ())) < min_docs or doc == min(holders[key(x)])]
        want[doc] = ("\n".join(kept), len(text.split("\n")), len(text.split("\n")) - len(kept))
    got = linededup.drop_shared_lines(docs_of(spark, rows), min_docs=min_docs, n_lines="n_lines", n_dropped="n_dropped")
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()} == want


def test_line_dedup_edges(spark, hard, empty):
    got = linededup.drop_shared_lines(hard)
    assert got.columns == hard.columns and got.count() == len(HARD)
    texts = {}
    for r in got.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert texts[3] == [HARD[3][1]] * 2 and texts[4] == [""] and texts[6] == [LONG] and texts[1] == [""]
    assert linededup.drop_shared_lines(empty).count() == 0


# ---- chat --------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    tricky = ["<|im_end|>", "<\\|im_start|>x", "<\\\\|", "a\\<|b", "", None, "<", "|im_end|>", "<|im_end|>\n<|im_start|>user\n"]
    rows = [(1, i, role, text) for i, (role, text) in enumerate(zip(["system", "user", "assistant", "user", "assistant"], tricky))]
    rows += [(2, i, "assistant", t) for i, t in enumerate(tricky)] + [(None, None, None, None), (3, 1, "user", "x"), (3, 1, "user", "x"), (4, 0, "od\\d\nrole<|", "y")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("segment", F.lit(1))
    segments = chat.format_chats(df)
    for arranged in (True, False):
        got = {r["conv_id"]: r for r in chat.read_back(segments, arranged=arranged).collect()}
        for conv in {r[0] for r in rows}:
            turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))
            said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
            loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
            row = got[conv]
            assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and row["n_turns"] == len(turns)
            assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and row["loss_chars"] == len(loss)
        assert got[1]["valid"] and not got[2]["valid"] and not got[3]["valid"] and not got[None]["valid"]
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


# ---- URL rules ---------------------------------------------------------------------------------


@pytest.mark.parametrize("whole_bytes", [64 << 20, 0])
def test_url_rules_equal_brute_force(spark, whole_bytes):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "", "block"), ("net", "", "block"), ("org", None, "block")]
    urls = ["http://A.Example.COM/en/x?y", "http://www.example.com/en/#z", "http://example.com/e", "x://net", "x://foo.net?q/", "net/es/", None, "", "http:///com/", "http://notexample.com/en/", "a://b.org/c://com/"]
    def by_hand(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [r for r in rules if r[1] is not None and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        return host, path, best and best[0] + best[1], best[2] if best else "allow"

    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id bigint, url string").withColumn("host", F.lit("old"))
    got = urlfilter.filter_urls(pages, rules, whole_bytes=whole_bytes).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == by_hand(r["url"])
    assert urlfilter.filter_urls(pages.limit(0), rules, whole_bytes=whole_bytes).count() == 0


def test_digest_collisions_are_told_apart():
    import numpy as np

    array = urlfilter.DigestArray(np.array([5, 5, 9], np.uint64).tobytes(), [("a", "/", "block"), ("b", "/", "allow"), ("c", "/", "block")])
    assert array.probe(np.array([5, 5, 9, 1], np.uint64), [("b", "/"), ("x", "/"), ("c", "/"), ("c", "/")]) == [("b", "/", "allow"), None, ("c", "/", "block"), None]
