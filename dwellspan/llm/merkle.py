"""Document fingerprints: Merkle trees over paragraphs and sections, with DataFrame functions only.

A paragraph is a stretch up to a line or sentence end, of at most `PARAGRAPH` code points; together the paragraphs are
the text. A section ends after a paragraph whose SHA-256 starts with 0 to 3 (about every fourth), so an insertion moves
no later section border. The digest of a section is that of its paragraphs' digests, the root that of the sections'.

A fingerprint reads `root:section=leaf,leaf,..|section=..`: the root in full, branches and leaves cut to 64 bits. Equal
texts have equal roots; where roots differ, differing sections and leaves tell where. Likeness is the Dice share of
common leaves. Nulls: a null text is empty, has no paragraphs and is like an empty text only. Everything is computed
within a row, so repeated rows, ties and empty tables need no care; a text of any length is hashed in linear time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dwellspan.llm.text import free_name, plain_names

PARAGRAPH = 160
# Up to PARAGRAPH code points before an end mark with a blank, or before the end; else PARAGRAPH of them.
PARAGRAPH_PATTERN = rf"[^.!?\n]{{0,{PARAGRAPH}}}+(?:[.!?\n]++ ?+|\z)|[^.!?\n]{{{PARAGRAPH}}}"
BLOCK_ROWS, MAX_BLOCKS = 1000, 10_000
_CUT = 16


def paragraphs(text: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH_PATTERN), F.lit(0))
    return F.filter(found, lambda p: p != "")


def fingerprint(text: Column) -> Column:
    leaves = F.transform(paragraphs(text), lambda p: F.sha2(p, 256))
    marked = F.transform(leaves, lambda d: F.concat(d, F.when(F.substring(d, 1, 1) < "4", F.lit("|")).otherwise(F.lit(","))))
    sections = F.split(F.regexp_replace(F.array_join(marked, ""), r"[|,]\z", ""), r"\|", -1)
    branches = F.transform(
        sections,
        lambda s: F.struct(
            F.sha2(s, 256).alias("digest"), F.regexp_replace(s, rf"([0-9a-f]{{{_CUT}}})[0-9a-f]*", "$1").alias("leaves")
        ),
    )
    return F.transform(  # bound once by the lambda
        F.array(branches),
        lambda b: F.concat(
            F.sha2(F.array_join(F.transform(b, lambda s: s["digest"]), ","), 256), F.lit(":"),
            F.array_join(F.transform(b, lambda s: F.concat(F.substring(s["digest"], 1, _CUT), F.lit("="), s["leaves"])), "|"),
        ),
    )[0]


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def leaves_of(print_: Column) -> Column:
    """Leaf digests in order, of all sections."""
    listed = F.regexp_replace(F.substring_index(print_, ":", -1), r"(^|\|)[0-9a-f]+=", "$1")
    return F.filter(F.split(listed, r"[|,]", -1), lambda d: d != "")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the common leaves over all leaves (different ones of each side)."""
    x, y = F.array_distinct(leaves_of(a)), F.array_distinct(leaves_of(b))
    total = F.size(x) + F.size(y)
    share = F.lit(2.0) * F.size(F.array_intersect(x, y)) / F.nullif(total, F.lit(0))
    return F.when(root(a) == root(b), 1.0).otherwise(F.coalesce(share, F.lit(0.0)))


def _sections(print_: Column) -> Column:
    """The branches of a fingerprint: digest, leaf digests, and the index of its first leaf."""
    branches = F.transform(
        F.split(F.substring_index(print_, ":", -1), r"\|", -1),
        lambda s: F.struct(
            F.substring_index(s, "=", 1).alias("digest"),
            F.filter(F.split(F.substring_index(s, "=", -1), ",", -1), lambda d: d != "").alias("leaves"),
        ),
    )
    start = lambda all_, i: F.aggregate(F.slice(all_, 1, i), F.lit(0), lambda n, t: n + F.size(t["leaves"]))
    return F.transform(
        F.array(branches),
        lambda all_: F.transform(all_, lambda s, i: F.struct(s["digest"], s["leaves"], start(all_, i).alias("start"))),
    )[0]


def _beyond(mine: Column, other: Column, digest) -> Column:
    """The items of `mine` that `other` doesn't have, or not so often: of equal ones the last are left over."""
    return F.filter(
        mine,
        lambda s, i: F.size(F.filter(F.slice(mine, 1, i + 1), lambda t: digest(t) == digest(s)))
        > F.size(F.filter(other, lambda t: digest(t) == digest(s))),
    )


def edited_leaves(a: Column, b: Column) -> Column:
    """Indexes of the leaves of `a` that `b` doesn't have, or not so often. Where the roots differ, sections are compared by their
    digests, and only the leaves of those that differ are looked at; work grows with the square of these."""
    leaf = lambda t: t["leaf"]
    leaves = lambda sections: F.flatten(F.transform(
        sections, lambda s: F.transform(s["leaves"], lambda d, j: F.struct(d.alias("leaf"), (s["start"] + j).cast("int").alias("at")))
    ))
    branches = F.array(F.struct(_sections(a).alias("mine"), _sections(b).alias("other")))
    differing = F.transform(branches, lambda p: F.struct(
        leaves(_beyond(p["mine"], p["other"], lambda t: t["digest"])).alias("mine"),
        leaves(_beyond(p["other"], p["mine"], lambda t: t["digest"])).alias("other"),
    ))
    places = F.transform(differing, lambda p: F.transform(_beyond(p["mine"], p["other"], leaf), lambda t: t["at"]))[0]
    return F.when(root(a) == root(b), F.expr("cast(array() as array<int>)")).otherwise(F.array_sort(places))


def _steps(borders: list[int]) -> tuple[list[int], list[list[int]]]:
    width = max(1, int(len(borders) ** 0.5))
    groups = [borders[i : i + width] for i in range(0, len(borders), width)]
    return [g[0] for g in groups], groups


def _block(doc_id: Column, borders: list[int]) -> Column:
    """Index of the last border that is not above `doc_id` (sorted borders, in two steps); 0 if there is none."""
    if not borders:
        return F.lit(0)
    heads, groups = _steps(borders)
    literal = lambda values: F.array(*[F.lit(v).cast("bigint") for v in values])
    coarse = F.size(F.filter(literal(heads), lambda b: b <= doc_id))
    table = F.array(*[literal(g) for g in groups])
    fine = F.size(F.filter(F.get(table, F.greatest(coarse, F.lit(1)) - 1), lambda b: b <= doc_id))
    return F.when(coarse < 1, 0).otherwise((coarse - 1) * len(groups[0]) + fine - 1)


def with_next_text(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "next_text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The text of the next row by id (and text, for equal ids); the last row's next is the first.

    Spark's range partitioner, on ids alone, gives block borders (at most MAX_BLOCKS). Texts move once, to their block; the first
    row of each block also goes to the block before, as a guest. Rows without id come first. A single id must not
    hold more rows than a task can spill."""
    docs, named = plain_names(docs.drop(name))
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63)))
    block, order, guest, rows = (free_name(docs, n) for n in ("block", "order", "guest", "rows"))
    ids = docs.select(key.alias(order))
    count = ids.count()
    blocks = min(MAX_BLOCKS, max(1, -(-count // block_rows)))
    firsts = ids.repartitionByRange(blocks, order).groupBy(F.spark_partition_id().alias(block)).agg(F.min(order).alias(order))
    borders = sorted({r[0] for r in firsts.select(order).collect()})
    keyed = docs.withColumn(order, key).withColumn(block, _block(F.col(order), borders))
    n = max(1, len(borders))
    heads = F.array(*[F.lit(v).cast("bigint") for v in borders]) if borders else F.expr("array(cast(null as bigint))")
    is_head = F.col(order) == F.get(heads, F.col(block))
    home = F.struct(F.col(block), F.lit(False).alias(guest))
    visit = F.struct(((F.col(block) + n - 1) % n).alias(block), F.lit(True).alias(guest))
    homes = F.when(is_head, F.array(home, visit)).otherwise(F.array(home))
    placed = keyed.withColumn(rows, homes).withColumn(rows, F.explode(rows)).withColumns({
        block: F.col(f"{rows}.{block}"), guest: F.col(f"{rows}.{guest}")
    })
    turn = Window.partitionBy(block).orderBy(guest, order, text)
    return named(placed.withColumn(name, F.lead(text).over(turn)).where(~F.col(guest)).select(*docs.columns, name))


def edited_text(text: Column, other: Column) -> Column:
    """The last half of the code points (rounded down) replaced by the first as many of the other text, or by all of it."""
    text, other = (F.coalesce(t, F.lit("")) for t in (text, other))
    half = F.floor(F.char_length(text) / F.lit(2)).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(other, half))


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """`docs` and the fingerprint of each text."""
    return docs.withColumn(name, fingerprint(F.col(text)))
