"""Benchmark decontamination by winnowing.

A window is 13 consecutive words of a benchmark item; an item of fewer words, but not none, is one window. Of every run
of `13 - K + 1` K-word hashes both sides keep the smallest (the last one of equals). An item and a document that share 13
words share such a run, so they keep the same hash at the same place: no shared window can be missed. Kept hashes are
joined and each hit is extended word by word in both directions, so hash collisions never count. Items of n < 13 words
take part with all runs of n words.

Documents are scanned once. Their kept hashes pass a Bloom filter of the items' hashes, whose size is a parameter and
doesn't depend on either table; only those that pass are joined (a sort-merge join for large benchmarks, so a passage that
a third of all documents share is split by adaptive execution).

Nulls: a null text has no words, a null item id adds hits but no item. Repeated documents each get a row, repeated items
count once per id. Empty tables give no hits. Other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspan.llm.text import free_name, grams, runs_inside, text_chunks, text_key, words_of
from dwellspan.session import materialise

WINDOW, K, BLOOM_BITS = 13, 7, 1 << 24
_KEPT = "struct<hash:bigint,k:int,pos:int,before:array<string>,gram:string,after:array<string>>"
_KEPT_ARROW = pa.list_(
    pa.struct(
        [
            ("hash", pa.int64()), ("k", pa.int32()), ("pos", pa.int32()), ("before", pa.list_(pa.string())),
            ("gram", pa.string()), ("after", pa.list_(pa.string())),
        ]
    )
)


def winnow(hashes: np.ndarray, rows: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the k-word hashes that are the smallest of some run of `window - k + 1` within a row."""
    values, inside = grams(hashes, k), runs_inside(rows, k)
    span = window - k + 1
    if span == 1:
        return np.flatnonzero(inside), values
    n = max(0, len(hashes) - window + 1)
    best, at = values[:n].copy(), np.arange(n)
    for j in range(1, span):
        lower = values[j : j + n] <= best
        best[lower] = values[j : j + n][lower]
        at[lower] = np.flatnonzero(lower) + j
    return np.unique(at[runs_inside(rows, window)]), values


def _addresses(values: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((values >> np.uint64(s)) & np.uint64(bits - 1)).astype(np.int64) for s in (0, 32)]


def _passes(values: np.ndarray, bloom: np.ndarray, bits: int) -> np.ndarray:
    ok = np.ones(len(values), dtype=bool)
    for at in _addresses(values, bits):
        ok &= (bloom[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return ok


def _fingerprints(column: pa.Array, lengths: list[int], bloom: np.ndarray | None, bits: int) -> Iterator[tuple]:
    """(first row, end row, words per row, kept hashes of each row with the words around them)."""
    for first, end, data, offsets in text_chunks(column):
        words = words_of(data, offsets)
        kept: list[list] = [[] for _ in range(end - first)]
        for k, window in [(K, WINDOW), *((n, n) for n in lengths)]:
            places, values = winnow(words.hashes, words.rows, k, window)
            if bloom is not None:
                places = places[_passes(values[places], bloom, bits)]
            for p in places.tolist():
                row = words.rows[p]
                lo, hi = max(int(words.firsts[row]), p - (window - k)), min(int(words.firsts[row + 1]), p + window)
                kept[row].append(
                    {
                        "hash": int(values[p].astype(np.int64)), "k": k, "pos": p - int(words.firsts[row]),
                        "before": [words.text(i) for i in range(p - 1, lo - 1, -1)],
                        "gram": " ".join(words.text(i) for i in range(p, p + k)),
                        "after": [words.text(i) for i in range(p + k, hi)],
                    }
                )
        yield first, end, words.counts, kept


def _item_fingerprints(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """A row for each kept hash of each item; items of fewer than 13 words keep the hash of all of them."""
    fields = pa.schema([("item", pa.string()), ("need", pa.int32()), *_KEPT_ARROW.value_type])

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            counted = [(f, c) for f, _, c, _ in _fingerprints(texts, [], None, 0)]
            n_words = np.concatenate([c for _, c in counted]) if counted else np.zeros(0, np.int64)
            for n in [WINDOW, *range(1, WINDOW)]:
                rows = np.flatnonzero(n_words >= WINDOW if n == WINDOW else n_words == n)
                if not len(rows):
                    continue
                some = texts.take(pa.array(rows))
                for first, _, _, kept in _fingerprints(some, [] if n == WINDOW else [n], None, 0):
                    out = [
                        {"item": ids[int(rows[first + i])].as_py(), "need": n, **f}
                        for i, found in enumerate(kept) for f in found if n == WINDOW or f["k"] == n
                    ]
                    yield pa.RecordBatch.from_pylist(out, schema=fields)

    schema = "item string, need int, hash bigint, k int, pos int, before array<string>, gram string, after array<string>"
    return benchmark.select(F.col(item).cast("string"), F.col(text).cast("string")).mapInArrow(run, schema)


def _bloom(prints: DataFrame, bits: int) -> np.ndarray:
    """The filter, of `bits` bits whatever the number of hashes: bytes are combined by Spark, the driver gets those set."""
    ones = F.explode(
        F.array(*[F.shiftrightunsigned("hash", s).bitwiseAND(F.lit(bits - 1).cast("bigint")) for s in (0, 32)])
    )
    cells = prints.select(ones.alias("at")).groupBy(F.shiftright("at", 3).alias("byte")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(at & 7 as int))")).alias("set")
    )
    bloom = np.zeros(bits // 8, dtype=np.uint8)
    for row in cells.toLocalIterator():
        bloom[row["byte"]] = row["set"]
    return bloom


def _common(a: Column, b: Column) -> Column:
    """How many leading entries of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def find_windows(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
    item: str = "item_id", item_text: str = "text", bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """`keep` columns of each document, n_words, spans (word ranges [start, end) that benchmark windows cover, maybe
    overlapping) and items (ids, sorted as strings)."""
    spark = docs.sparkSession
    prints = materialise(_item_fingerprints(benchmark, item, item_text).drop("pos").distinct(), "items")
    lengths = sorted(r[0] for r in prints.where(F.col("need") < WINDOW).select("need").distinct().collect())
    bits = bloom_bits
    shipped = spark.sparkContext.broadcast(_bloom(prints, bits).tobytes())
    keys = [free_name(docs, "th1"), free_name(docs, "th2")]

    def run(batches):
        bloom = np.frombuffer(shipped.value, np.uint8)
        for batch in batches:
            for first, end, counts, kept in _fingerprints(batch.column(batch.num_columns - 1), lengths, bloom, bits):
                part = batch.slice(first, end - first).columns[:-1]
                yield pa.RecordBatch.from_arrays(
                    [*part, pa.array(counts, pa.int64()), pa.array(kept, _KEPT_ARROW)], [*names, "n_words", "__kept"]
                )

    names = [*keep, *keys]
    hashes = [h.alias(k) for h, k in zip(text_key(F.col(text)), keys)]
    narrow = docs.select(*[F.col(c) for c in keep], *hashes, F.col(text).cast("string").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1]]
    schema = ", ".join([*fields, "n_words bigint", f"__kept array<{_KEPT}>"])
    base = materialise(narrow.mapInArrow(run, schema), "fingerprints")
    found = base.select(*keys, F.inline("__kept"))
    item_side = prints.select("item", "need", "hash", "k", F.col("before").alias("ib"), F.col("gram").alias("ig"), F.col("after").alias("ia"))
    left, right = _common(F.col("before"), F.col("ib")), _common(F.col("after"), F.col("ia"))
    hits = (
        found.join(item_side, ["hash", "k"]).where(F.col("gram") == F.col("ig"))
        .select(*keys, "item", "need", "k", (F.col("pos") - left).alias("start"), (F.col("pos") + F.col("k") + right).alias("end"))
        .where(F.col("end") - F.col("start") >= F.col("need"))
        .groupBy(*keys)
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    )
    return (
        base.drop("__kept").join(materialise(hits, "hits"), keys, "left").drop(*keys)
        .withColumns({
            "spans": F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")),
            "items": F.coalesce("items", F.expr("cast(array() as array<string>)")),
        })
    )


def contamination(found: DataFrame, share: int = 20) -> DataFrame:
    """n_hit (words in a span), n_items, and contaminated: at least one in `share` of the words is hit."""
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["end"] - 1)))
    return found.withColumns({
        "n_hit": F.size(F.array_distinct(places)).cast("bigint"), "n_items": F.size("items").cast("bigint")
    }).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns. Equal texts are judged alike."""
    keys = [free_name(docs, "th1"), free_name(docs, "th2")]
    hashes = [h.alias(k) for h, k in zip(text_key(F.col(text)), keys)]
    judged = contamination(find_windows(docs.select(F.col(text), *hashes), benchmark, tuple(keys), text))
    bad = judged.where("contaminated").select(*keys).distinct()
    return docs.withColumns(dict(zip(keys, text_key(F.col(text))))).join(bad, keys, "left_anti").drop(*keys)
