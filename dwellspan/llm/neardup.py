"""N-gram Jaccard join by MinHash banding with exact verification.

A document is the set of its five-word shingles (one shingle of all its words if it has fewer). Documents of
equal sets are one node, so copies never meet each other. Each of TREES bands hashes
a fixed number of its own MinHash values: the most, up to MAX_DEPTH, with which pairs at the threshold meet in some band with the
target probability. It follows from the parameters alone; there are no sorted tries, and no data shortens a prefix. Nodes that share such a prefix are candidates; candidates that hang together are verified
exactly, all with all, on their 64-bit shingle hashes.

A group of candidates is cut into blocks of bounded rows and shingles; each pair of blocks is one task's work, which
returns a row per node (its links, and its root within the blocks), never pairs. So a hot group costs its square in
comparisons, spread over tasks, but only its size times its number of blocks in rows. The text of a candidate moves once to
be found and once per block of its group. The large joins are sort-merge joins at every size.

Null texts, empty ones and all others without words have the same, empty set: they are copies of each other. Nodes are sets and never
ids: rows without id, or of one id, are linked as their texts are, and only the id of a class is the smallest one in it (a missing id is
above all others, so a class of nothing else has none). Sets of fewer than threshold / (1 - threshold) shingles can only equal each other.
Empty tables give no rows. Other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspan.llm.graph import components
from dwellspan.llm.text import Words, free_name, grams, mix, runs_inside, text_chunks, text_key, words_of
from dwellspan.session import materialise

SHINGLE, THRESHOLD, TARGET_RECALL, TREES, MAX_DEPTH = 5, 0.8, 0.99999, 24, 8
BLOCK_ROWS, BLOCK_SHINGLES = 256, 400_000
ROW = ["doc", "t1", "t2"]  # id and text key
_LAST = (1 << 63) - 1  # stands for a missing id


def prefix_depth(trees: int = TREES, threshold: float = THRESHOLD, target: float = TARGET_RECALL, depth: int = MAX_DEPTH) -> int:
    """Shorten matched prefixes until pairs at the threshold meet in some tree with probability `target`."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    if 1 - (1 - threshold**depth) ** trees < target:
        raise ValueError("more trees are needed for this recall")
    return depth


def shingle_sets(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row) of the different shingles of each row, sorted by row and hash."""
    values, inside = grams(words.hashes, k), runs_inside(words.rows, k)
    parts, owners = [values[inside]], [words.rows[: len(values)][inside]]
    for n in range(1, k):
        short = np.flatnonzero(words.counts == n)
        if len(short):
            starts = words.firsts[short]
            parts.append(grams(words.hashes, n)[starts])
            owners.append(short)
    hashes, rows = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def _signatures(hashes: np.ndarray, starts: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Of each set, the hashed prefix of `depth` MinHash values in each tree."""
    odd = mix(np.arange(1, 2 * trees * depth + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    labels = np.zeros((len(starts), trees), dtype=np.uint64)
    for t in range(trees):
        label = np.full(len(starts), t, dtype=np.uint64)
        for d in range(depth):
            f = 2 * (t * depth + d)
            low = np.minimum.reduceat(hashes * odd[f] + odd[f + 1], starts)
            label = mix(label * np.uint64(31) + low)
        labels[:, t] = label
    return labels


def _sets(docs: DataFrame, doc_id: str, text: str, trees: int, depth: int) -> DataFrame:
    """A row per document: id, 128 bits that stand for its shingle set, its size, its prefixes."""

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(3)):
                rows = end - first
                hashes, owner = shingle_sets(words_of(data, offsets))
                sizes = np.bincount(owner, minlength=rows)
                full = np.flatnonzero(sizes)
                starts = np.concatenate([[0], np.cumsum(sizes)])[:-1][full].astype(np.int64)
                digests, labels = np.zeros((2, rows), dtype=np.uint64), np.zeros((rows, trees), dtype=np.uint64)
                if len(full):
                    for i in range(2):
                        digests[i, full] = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5 + i)), starts)
                    labels[full] = _signatures(hashes, starts, trees, depth)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, rows * trees + 1, trees, dtype=np.int32)), pa.array(labels.ravel().view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(first, rows).columns[:-1], pa.array(digests[0].view(np.int64)), pa.array(digests[1].view(np.int64)),
                        pa.array(sizes.astype(np.int64)), listed,
                    ],
                    ["doc", "t1", "t2", "s1", "s2", "size", "prefixes"],
                )

    t1, t2 = text_key(F.col(text))
    narrow = docs.select(_id(doc_id).alias("doc"), t1.alias("t1"), t2.alias("t2"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(
        run, "doc bigint, t1 bigint, t2 bigint, s1 bigint, s2 bigint, size bigint, prefixes array<bigint>"
    )


def _id(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST))


def _verify(sets: list[tuple], same_block: bool, threshold: float) -> list[tuple[int, int, int]]:
    """(node, rows linked, smallest node linked directly or not) for all sets of a block, or of two blocks with each other.
    A set is (node, block, copies, sorted shingle hashes)."""
    nodes = np.array([s[0] for s in sets])
    blocks, copies = np.array([s[1] for s in sets]), np.array([s[2] for s in sets])
    sizes = np.array([len(s[3]) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    values, ids = np.unique(np.concatenate([s[3] for s in sets]), return_inverse=True)
    mark, links, root = np.zeros(len(values), dtype=np.int32), np.zeros(len(sets), dtype=np.int64), list(range(len(sets)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(sets)):
        own = ids[starts[i] : starts[i + 1]]
        mark[own] = 1
        common = np.add.reduceat(mark[ids], starts[:-1])
        mark[own] = 0
        near = (common / (sizes + sizes[i] - common) >= threshold) & (nodes != nodes[i])
        if not same_block:
            near &= blocks != blocks[i]
        links[i] = copies[near].sum()
        for j in np.flatnonzero(near).tolist():
            a, b = top(i), top(j)
            if a != b:
                low, high = (a, b) if nodes[a] < nodes[b] else (b, a)
                root[high] = low
    return [(int(nodes[i]), int(links[i]), int(nodes[top(i)])) for i in range(len(sets))]


def _verify_groups(members: DataFrame, threshold: float) -> DataFrame:
    """Members sorted by (grp, b1, b2) are streamed; each run of equal keys is one piece of work."""

    def run(batches):
        key, held = None, []

        def result():
            found = _verify(held, key[1] == key[2], threshold) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["node", "links", "root"])

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            nodes, blocks, copies = (batch.column(i).to_pylist() for i in (3, 4, 5))
            for first, end, data, offsets in text_chunks(batch.column(6)):
                hashes, owner = shingle_sets(words_of(data, offsets))
                ends = np.searchsorted(owner, np.arange(end - first + 1))
                for r in range(first, end):
                    if keys[r] != key:
                        if held:
                            yield result()
                        key, held = keys[r], []
                    own = hashes[ends[r - first] : ends[r - first + 1]]
                    held.append((nodes[r], blocks[r], copies[r], own.copy()))
        if held:
            yield result()

    ordered = members.select("grp", "b1", "b2", "node", "block", "copies", "text")
    keys = ["grp", "b1", "b2"]
    return ordered.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "node bigint, links bigint, root bigint")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, trees: int = TREES,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """A row per document: doc_id, class_id (smallest id that it is linked with, directly or not) and n_links (other
    documents whose Jaccard similarity is at least the threshold; a copy counts like any other)."""
    found = _classes(docs, doc_id, text, threshold, trees, target_recall)
    missing = F.lit(_LAST)
    return found.select(F.nullif("doc", missing).alias("doc_id"), F.nullif("head.doc", missing).alias("class_id"), "n_links")


def _classes(docs: DataFrame, doc_id: str, text: str, threshold: float, trees: int, target_recall: float) -> DataFrame:
    """(doc, t1, t2, head, n_links) of every document; t1 and t2 stand for its text, head has those three of the smallest in its class."""
    depth = prefix_depth(trees, threshold, target_recall)
    sets = materialise(_sets(docs, doc_id, text, trees, depth), "sets")
    # The nodes are numbered once and written, so their numbers hold.
    nodes = sets.groupBy("s1", "s2").agg(
        F.min(F.struct(*ROW)).alias("head"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("prefixes").alias("prefixes")
    )
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    linkable = nodes.where(F.col("size") + 1 >= threshold / (1 - threshold))
    leaves = linkable.select("node", F.posexplode("prefixes").alias("tree", "prefix"))
    shared = leaves.groupBy("tree", "prefix").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    meets = leaves.join(shared.hint("merge"), ["tree", "prefix"]).where("node <> first")
    meets = meets.select(F.col("node").alias("a"), F.col("first").alias("b"))
    groups = components(meets).select("node", F.col("root").alias("grp"))
    placed = materialise(groups.join(nodes.select("node", "head.*", "copies", "size"), "node"), "candidates")
    blocks = placed.groupBy("grp").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("n")
    )
    block = F.pmod(F.xxhash64("node"), F.col("n")).cast("int")
    pairs = placed.join(blocks, "grp").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    pairs = pairs.select(
        *ROW, "grp", "node", "copies", "block", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2")
    )
    t1, t2 = text_key(F.col(text))
    texts = docs.select(_id(doc_id).alias("doc"), t1.alias("t1"), t2.alias("t2"), F.col(text).cast("string").alias("text"))
    if not sets.groupBy(*ROW).count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(ROW)  # one text per node, however often a row is repeated
    found = materialise(_verify_groups(texts.join(pairs.hint("merge"), ROW), threshold), "links")
    classes = materialise(
        components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).join(nodes.select("node", "head"), "node"), "linked"
    )
    heads = materialise(classes.groupBy("root").agg(F.min("head").alias("lowest")), "heads")
    classes = classes.join(heads, "root").select("node", "lowest")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        nodes.select("s1", "s2", "node", "head", "copies").join(links, "node", "left").join(classes, "node", "left")
        .select(
            "s1", "s2", F.coalesce("lowest", "head").alias("head"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    out = sets.select("doc", "t1", "t2", "s1", "s2").join(materialise(known, "classes"), ["s1", "s2"], "left")
    return out.select(*ROW, "head", F.col("n_links").cast("bigint").alias("n_links"))


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, trees: int = TREES,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """`docs` with the document of the smallest id of each class (of equal ids, that of the smallest text key). Exact repeats of a
    row's id and text go, too."""
    keys = [free_name(docs, n) for n in ROW]
    classes = _classes(docs, doc_id, text, threshold, trees, target_recall).toDF(*keys, "head", "n_links")
    gone = materialise(classes.where(F.struct(*[F.col(k).alias(n) for k, n in zip(keys, ROW)]) != F.col("head")).select(*keys).distinct(), "gone")
    keyed = docs.withColumns(dict(zip(keys, [_id(doc_id), *text_key(F.col(text))])))
    kept = keyed.join(gone, keys, "left_anti")
    if not classes.groupBy(*keys).count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(keys)
    return kept.drop(*keys)
