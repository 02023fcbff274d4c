r"""Prefix trie of conversations: what a training run saves by computing shared beginnings once.

A node is a distinct sequence of first turns; the root is the empty one. Nodes are named by their depth and 128 bits: the exclusive
or of the hashes of (depth, role, text) of all turns so far, a running window over each conversation. Conversations that are equal
as a whole are counted first, and one path stands for all of them.

The trie is cut into shards by weight, the number of path rows below a node. Nodes above `limit` rows are the spine; every subtree
that hangs on it has at most `limit` rows. Subtrees are dealt to tasks, and each task encodes its forest as balanced parentheses:
`findclose` over a range min-max tree of excess blocks delimits each subtree, the rank of leaf pairs `()` counts its leaves, and
cumulative arrays in preorder give its savings. Totals of a subtree's top go to the spine node above, added up before they
move. The spine, with one path for each of its lowest nodes, is the next trie to cut, until all of it fits one shard: a
first turn that all conversations share is a row of the spine, whatever hangs on it.

Turns are ordered by turn (null first), then role, then text. A null role or text is empty. Rows without conversation id belong to no
conversation and are left out; repeated rows are repeated turns. An empty table has no nodes. Other columns are ignored. The
digest of a node's ends is sequential: ranges of ids are joined in parallel, one task streams the joined pieces."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellspan.session import materialise

LIMIT = 200_000  # path rows of a shard
BLOCK = 256  # parentheses of an excess block
JOINED = 4096  # ids of a joined piece
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = ["a", "b", "depth"]
_PATH = "conv bigint, depth bigint, len bigint, a bigint, b bigint, pa bigint, pb bigint, bytes bigint"
_OWN = "n bigint, first bigint, x_children bigint, x_leaves bigint, x_saved bigint"
FOREST_SCHEMA = (
    "a bigint, b bigint, depth bigint, pa bigint, pb bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, top boolean"
)


class Parentheses:
    """A forest as balanced parentheses: +1 opens a node, -1 closes it.

    `depth` holds the depths of the nodes in preorder, 0 for tops."""

    def __init__(self, depth: np.ndarray):
        nodes = len(depth)
        self.opens = 2 * np.arange(nodes, dtype=np.int64) - depth
        steps = np.full(2 * nodes, -1, dtype=np.int64)
        steps[self.opens] = 1
        self.excess = np.cumsum(steps)
        leaf = np.zeros(2 * nodes, dtype=bool)
        leaf[:-1] = (steps[:-1] == 1) & (steps[1:] == -1)
        self.leaf_pair = leaf
        blocks = max(1, -(-2 * nodes // BLOCK))
        width = 1 << (blocks - 1).bit_length()
        padded = np.full(width * BLOCK, 1 << 60, dtype=np.int64)
        padded[: 2 * nodes] = self.excess
        self.least = [padded.reshape(width, BLOCK).min(axis=1)]  # of blocks, of pairs of blocks, and so on
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))

    def _scan(self, start: np.ndarray, target: np.ndarray, found: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Look for the targets from `start` to the end of its block; gives the queries that go on."""
        here = start.copy()
        while len(at):
            inside = here < np.minimum((start // BLOCK + 1) * BLOCK, len(self.excess))
            hit = inside.copy()
            hit[inside] = self.excess[here[inside]] <= target[inside]
            found[at[hit]] = here[hit]
            if not (go := inside & ~hit).any():
                break
            at, here, start, target = at[go], here[go] + 1, start[go], target[go]
        return np.flatnonzero(found < 0)

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the first later place with one less excess."""
        target = self.excess[opens] - 1
        found = np.full(len(opens), -1, dtype=np.int64)
        left = self._scan(opens + 1, target, found, np.arange(len(opens)))
        if not len(left):
            return found
        goal, node, level = target[left], (opens[left] + 1) // BLOCK, np.zeros(len(left), dtype=np.int64)
        # a scan that started at the first place of a block has seen that block as well
        going = np.ones(len(left), dtype=bool)
        for height, least in enumerate(self.least):  # climb until a right neighbour reaches the goal
            sibling = node ^ 1
            reach = going & (node % 2 == 0) & (sibling < len(least))
            reach[reach] = least[sibling[reach]] <= goal[reach]
            node = np.where(reach, sibling, np.where(going, node // 2, node))
            level[reach] = height
            going &= ~reach
        for height in range(len(self.least) - 1, 0, -1):  # go down to the first block that reaches it
            down = level == height
            child = node * 2
            first = down.copy()
            first[down] = self.least[height - 1][child[down]] <= goal[down]
            node = np.where(down, np.where(first, child, child + 1), node)
            level[down] = height - 1
        self._scan(node * BLOCK, goal, found, left)
        return found


def preorder(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes in preorder and their depths; `parent` is -1 for tops."""
    nodes = len(parent)
    order = np.argsort(parent, kind="stable")
    start = np.searchsorted(parent[order], np.arange(-1, nodes + 1)).tolist()
    below, visited, depth = order.tolist(), [], []
    stack = [(node, 0) for node in reversed(below[start[0] : start[1]])]
    while stack:
        node, at = stack.pop()
        visited.append(node)
        depth.append(at)
        i, j = start[node + 1], start[node + 2]
        if j - i == 1:
            stack.append((below[i], at + 1))
        elif j > i:
            stack += [(child, at + 1) for child in reversed(below[i:j])]
    return np.array(visited, dtype=np.int64), np.array(depth, dtype=np.int64)


def _forest(add_up: bool):
    """Nodes of a shard from its path rows; members are added up, or already known of each node."""

    def run(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in table.column_names if n not in ("bucket", "up")}
        up_valid = table.column("up").is_valid().to_numpy()
        up = table.column("up").fill_null(0).to_numpy()
        by_name = np.lexsort((col["b"], col["a"], col["depth"]))
        a, b, depth = (col[n][by_name] for n in NODE)
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (depth[1:] != depth[:-1])
        starts = np.flatnonzero(new)
        node_of = np.empty(len(a), dtype=np.int64)
        node_of[by_name] = np.cumsum(new) - 1
        some = by_name[starts]  # a row of each node
        members = (np.add if add_up else np.maximum).reduceat(col["n"][by_name], starts)
        first = np.minimum.reduceat(col["first"][by_name], starts)
        along = np.lexsort((col["depth"], col["conv"]))
        conv, deep, at = col["conv"][along], col["depth"][along], node_of[along]
        below = np.flatnonzero((conv[1:] == conv[:-1]) & (deep[1:] == deep[:-1] + 1)) + 1
        parent = np.full(len(starts), -1, dtype=np.int64)
        parent[at[below]] = at[below - 1]

        visited, level = preorder(parent)
        tree = Parentheses(level)
        close = tree.find_close(tree.opens)
        size = (close - tree.opens + 1) // 2
        extra = {n: col[n][some][visited] for n in ("x_children", "x_leaves", "x_saved")}
        pairs = tree.leaf_pair.copy()
        pairs[tree.opens[extra["x_children"] > 0]] = False  # what hangs below is in other shards
        rank = np.concatenate([[0], np.cumsum(pairs)])
        end = np.arange(len(visited)) + size
        own = (members[visited] - 1) * col["bytes"][some][visited] + extra["x_saved"]
        total = lambda values: (s := np.concatenate([[0], np.cumsum(values)]))[end] - s[:-1]
        above = parent[visited]
        top = above < 0
        parent_conv = pa.array(
            np.where(top, up[some][visited], first[above]), pa.int64(), mask=top & ~up_valid[some][visited]
        )
        children = np.bincount(parent[parent >= 0], minlength=len(parent))[visited] + extra["x_children"]
        name = some[visited]
        return pa.table({
            **{n: col[n][name] for n in (*NODE, "pa", "pb")}, "conv_id": first[visited], "parent_conv_id": parent_conv,
            "n_convs": members[visited], "n_children": children,
            "n_leaves": rank[close + 1] - rank[tree.opens] + total(extra["x_leaves"]), "saved_tokens": total(own), "top": top,
        })

    return run


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, place from 1, two hashes of the turn, bytes of its text)."""
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv is not null")
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return turns.select(
        "conv", F.row_number().over(order).cast("bigint").alias("place"), F.xxhash64(F.lit(0), "role", "text").alias("k1"),
        F.xxhash64(F.lit(1), "role", "text").alias("k2"), F.octet_length("text").cast("bigint").alias("bytes"),
    )


def rebuilt_turns(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation c - c % family, h being crc32(c) % most, and goes on
    with its own turns after its first h. Rows (conv, part, place, ..); part 0 is the root, one row per conversation."""
    h = F.crc32(F.col("conv").cast("string")) % most
    ids = turns.where("place = 1").select("conv", (F.col("conv") - F.col("conv") % family).alias("base"), h.alias("h"))
    heads = turns.where((F.col("place") < most) & (F.col("conv") % family == 0)).withColumnRenamed("conv", "base")
    borrowed = heads.join(ids, "base").where("place <= h").select("conv", F.lit(1).alias("part"), "place", "k1", "k2", "bytes")
    own = turns.where(F.col("place") > h).select("conv", F.lit(2).alias("part"), "place", "k1", "k2", "bytes")
    zero = F.lit(0).cast("bigint")
    root = ids.select("conv", F.lit(0).alias("part"), *[zero.alias(n) for n in ("place", "k1", "k2", "bytes")])
    return root.unionByName(borrowed).unionByName(own)


def plain_turns(turns: DataFrame) -> DataFrame:
    """The conversations as they are, in the form of `rebuilt_turns`."""
    zero = F.lit(0).cast("bigint")
    root = turns.where("place = 1").select("conv", F.lit(0).alias("part"), *[zero.alias(n) for n in ("place", "k1", "k2", "bytes")])
    return root.unionByName(turns.select("conv", F.lit(2).alias("part"), "place", "k1", "k2", "bytes"))


def paths(turns: DataFrame) -> DataFrame:
    """A row for each prefix of each conversation: its name (a, b, depth), its parent's, and the conversation's length."""
    along = Window.partitionBy("conv").orderBy("part", "place")
    deep = turns.withColumn("depth", (F.row_number().over(along) - 1).cast("bigint"))
    for name, seed in (("a", 2), ("b", 3)):
        turn = F.when(F.col("depth") > 0, F.xxhash64(F.lit(seed), "depth", "k1", "k2")).otherwise(F.lit(0).cast("bigint"))
        deep = deep.withColumn(f"own_{name}", turn)
    running = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    deep = deep.withColumns({n: F.bit_xor(f"own_{n}").over(running) for n in ("a", "b")})
    return deep.select(
        "conv", "depth", F.max("depth").over(Window.partitionBy("conv")).alias("len"), "a", "b",
        F.col("a").bitwiseXOR(F.col("own_a")).alias("pa"), F.col("b").bitwiseXOR(F.col("own_b")).alias("pb"), "bytes",
    )


def _same(x, y) -> bool:
    return x is not None and x[:3] == y[:3]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, id) rows as comma-joined pieces of at most JOINED ids."""
    node, ids = None, []

    def piece():
        return (*node, ids[0], len(ids), ",".join(map(str, ids)))

    for batch in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if node is not None and (len(ids) >= JOINED or not _same(node, row)):
                out.append(piece())
                ids = []
            node = row[:3]
            ids.append(row[3])
        if out:
            yield _rows(out, _PIECE)
    if node is not None:
        yield _rows([piece()], _PIECE)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as one row per node: its number of ends, the smallest, and the digest of all."""
    node, count, first, digest = None, 0, 0, None
    for batch in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if _same(node, row):
                digest.update(b",")
            else:
                if node is not None:
                    out.append((*node, count, first, digest.hexdigest()))
                node, count, first, digest = row[:3], 0, row[3], hashlib.sha256()
            count += row[4]
            digest.update(row[5].encode())
        if out:
            yield _rows(out, _END)
    if node is not None:
        yield _rows([(*node, count, first, digest.hexdigest())], _END)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = _arrow(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)


_PIECE = "a bigint, b bigint, depth bigint, first bigint, n bigint, ids string"
_END = "a bigint, b bigint, depth bigint, copies bigint, conv bigint, ends_sha256 string"


def end_nodes(steps: DataFrame) -> DataFrame:
    """Of each node where conversations end: how many, the smallest, and the digest of their ids."""
    last = steps.where("depth = len").select(*NODE, "conv")
    joined = last.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(_pieces, _PIECE)
    return joined.repartition(*[F.col(n) for n in NODE]).sortWithinPartitions(*NODE, "first").mapInArrow(_digests, _END)


def _cut(rows: DataFrame, limit: int, add_up: bool) -> DataFrame:
    """The spine: nodes with more than `limit` path rows at and below them, with what is known of them."""
    count = F.sum("n") if add_up else F.max("n")
    nodes = rows.groupBy(*NODE).agg(
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"), F.min("conv").alias("conv"), F.min("first").alias("first"),
        count.alias("n"), *[F.max(c).alias(c) for c in ("pa", "pb", "bytes", "x_children", "x_leaves", "x_saved")],
    )
    return nodes.where(F.col("weight") > limit).drop("weight")


def _light(rows: DataFrame, spine: DataFrame | None, limit: int, total: int) -> DataFrame:
    """Path rows below the spine; rows of a subtree share a bucket. `up` is the first member of a top's parent."""
    if spine is None:
        return rows.withColumns({"up": F.lit(None).cast("bigint"), "bucket": F.lit(0)})
    marks = spine.select(*NODE, F.col("first").alias("spine_first"))
    along = Window.partitionBy("conv").orderBy("depth")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    light = F.col("spine_first").isNull()
    marked = rows.join(marks, NODE, "left").withColumns({
        "up": F.lag("spine_first").over(along),
        **{f"top_{n}": F.first(F.when(light, F.col(n)), ignorenulls=True).over(so_far) for n in ("a", "b")},
    })
    buckets = max(1, -(-2 * total // limit))
    kept = marked.where(light).withColumn("bucket", F.pmod(F.xxhash64("top_a", "top_b"), F.lit(buckets)).cast("int"))
    return kept.drop("spine_first", "top_a", "top_b")


def _spine_paths(rows: DataFrame, spine: DataFrame, hanging: DataFrame) -> DataFrame:
    """The spine as paths, one to each of its lowest nodes, and with the totals of what hangs on it."""
    extra = hanging.where("top").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")
    )
    known = spine.join(extra, NODE, "left").select(
        *NODE, "pa", "pb", "bytes", "n", "first",
        *[(F.col(f"x_{x}") + F.coalesce(x[0], F.lit(0))).alias(f"x_{x}") for x in ("children", "leaves", "saved")],
    )
    parents = spine.select(F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth"))
    lowest = spine.join(parents, NODE, "left_anti").select("conv", F.col("depth").alias("last"))
    path = rows.join(lowest, "conv").where("depth <= last").select("conv", *NODE, F.col("last").alias("len"))
    names = [c.split()[0] for c in f"{_PATH}, {_OWN}".split(", ")]
    return path.join(known, NODE).select(*names)


def conversation_trie(rebuilt: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All nodes of the trie of `rebuilt_turns` or `plain_turns`."""
    steps = materialise(paths(rebuilt), "trie-paths")
    ends = materialise(end_nodes(steps), "trie-ends")
    zero = F.lit(0).cast("bigint")
    rows = steps.join(ends.select("conv", F.col("copies").alias("n")), "conv").withColumns(
        {"first": F.col("conv"), **{f"x_{x}": zero for x in ("children", "leaves", "saved")}}
    )
    rows, add_up, parts = materialise(rows, "trie-rows"), True, []
    while True:
        total = rows.count()
        spine = materialise(_cut(rows, limit, add_up), "trie-spine") if total > limit else None
        light = _light(rows, spine, limit, total)
        parts.append(materialise(light.groupBy("bucket").applyInArrow(_forest(add_up), FOREST_SCHEMA), "trie-nodes"))
        if spine is None or spine.isEmpty():
            break
        rows, add_up = materialise(_spine_paths(rows, spine, parts[-1]), "trie-rows"), False
    nodes = reduce(DataFrame.unionByName, parts)
    return nodes.join(ends.select(*NODE, "ends_sha256"), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
