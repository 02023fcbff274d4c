"""Line deduplication with DataFrame functions only.

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. A key of at least
`min_chars` code points that at least `min_docs` documents hold loses all its lines except in the document with the
smallest id. Lines are exploded as 128-bit hashes; documents are counted per hash with map-side combining, so a line that
every document holds is no hot spot; the positions to drop come back by a join that adaptive execution can split.

Nulls: a null or empty text is one empty line. Rows without id count as one document, above all others. Repeated rows
(same id) are one document: they keep or lose a line together. Other columns are carried along."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspan.llm.text import LOWER_CASE, UPPER, free_name, plain_names, text_key
from dwellspan.session import materialise

MIN_CHARS, MIN_DOCS = 10, 2
BLANKS = " \t\n\x0b\x0c\r"
_LAST = (1 << 63) - 1  # stands for a missing id


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, UPPER, LOWER_CASE))


def _occurrences(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """A row per line that counts: document, hash of its text, position, hash of the key."""
    lines = docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST)).alias("doc"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"),
        F.posexplode(lines_of(F.col(text))).alias("pos", "line"),
    )
    keyed = lines.select("doc", "th", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select("doc", "th", "pos", *[h.alias(n) for h, n in zip(text_key(F.col("key")), ("k1", "k2"))])


def shared_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Keys (k1, k2) that at least `min_docs` documents hold, with the smallest of them."""
    if min_docs == 2:  # two documents hold it exactly when the smallest is not the largest
        ends = lines.groupBy("k1", "k2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        return ends.where(F.col("first") < F.col("last")).drop("last")
    held = lines.select("k1", "k2", "doc").distinct()
    counted = held.groupBy("k1", "k2").agg(F.min("doc").alias("first"), F.count("*").alias("docs"))
    return counted.where(F.col("docs") >= min_docs).drop("docs")


def drop_shared_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    n_lines: str | None = None, n_dropped: str | None = None,
) -> DataFrame:
    """`docs` with the kept lines as `text`; two more columns, if named, count lines before and dropped lines."""
    docs, named = plain_names(docs)
    lines = _occurrences(docs, doc_id, text, min_chars)
    doc, th, drops = (free_name(docs, n) for n in ("doc", "th", "drops"))
    dropped = (
        lines.join(materialise(shared_lines(lines, min_docs), "shared-lines"), ["k1", "k2"]).where(F.col("doc") > F.col("first"))
        .groupBy(F.col("doc").alias(doc), F.col("th").alias(th)).agg(F.collect_set("pos").alias(drops))
    )
    rows = docs.withColumns({
        doc: F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST)),
        th: F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
    }).join(dropped, [doc, th], "left")
    all_lines = lines_of(F.col(text))
    kept = F.transform(  # bound once per row by the outer lambda
        F.array(all_lines),
        lambda lines: F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drops)), lambda i: F.get(lines, i)
        ),
    )[0]
    counts = {n_lines: F.size(all_lines).cast("bigint"), n_dropped: F.coalesce(F.size(drops), F.lit(0)).cast("bigint")}
    new = {text: F.when(F.col(drops).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(kept, "\n"))}
    return named(rows.withColumns({n: c for n, c in counts.items() if n} | new).select(
        *docs.columns, *[n for n in counts if n and n not in docs.columns]
    ))
