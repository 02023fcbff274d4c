"""Exact samples, splits and folds from a hash of the row key: the same under any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspan.functions.columns import hash_bucket, hash_uniform, key_hash

# Once this few candidates share a digest prefix, the last one kept is found by sorting them.
SORT_ROWS = 100_000
DIGITS = 3
DIGEST_LENGTH = 32
_CONTENT = "_content"


def sample_n(df: DataFrame, n: int, seed: int, key: str = "listing_id", sort_rows: int = SORT_ROWS) -> DataFrame:
    """The n rows with the smallest digest of (key, seed); an error if there are fewer.

    The digest of the last row kept is found by counting rows per digest prefix, a few digits at a
    time, over the key column alone (at most 16^3 counts reach the driver per round). The sample itself
    is then a filter: no row is sorted or moved. Rows that share one key are told apart by their
    content, every column at full precision; only exact copies are taken as equal, and of those the wanted
    number is kept. A missing key is a key like any other."""
    digest = _digest(key, seed)
    hashed = df.select(digest.alias("_h"))
    prefix, before = "", 0
    while True:
        inside = hashed.where(F.col("_h").startswith(prefix)) if prefix else hashed
        digits = F.substring("_h", len(prefix) + 1, DIGITS)
        counts = sorted(tuple(r) for r in inside.groupBy(digits.alias("d")).count().collect())
        if not prefix and sum(c for _, c in counts) < n:
            raise ValueError(f"cannot take {n} rows out of {sum(c for _, c in counts)}")
        if n == 0:
            return df.limit(0)
        for digit, count in counts:
            if before + count >= n:
                break
            before += count
        prefix += digit
        if count == n - before or count <= sort_rows or len(prefix) >= DIGEST_LENGTH:
            break
    head = F.substring(digest, 1, len(prefix))
    if count == n - before:
        return df.where(head <= prefix)
    if count <= sort_rows:
        last = (
            hashed.where(F.col("_h").startswith(prefix)).orderBy("_h").select("_h").limit(n - before)
            .agg(F.max("_h")).first()[0]
        )
        ties = hashed.where(F.col("_h") == last).count()
        below = hashed.where(F.col("_h").startswith(prefix) & (F.col("_h") < last)).count()
    else:
        last, ties, below = prefix, count, 0
    if below + ties == n - before:
        return df.where(digest <= last)
    # Several rows carry the key of the last row kept: choose among them by content. Copies of one row
    # are interchangeable, so the missing number is repeated from a single one.
    below_rows, tied, missing = df.where(digest < last), df.where(digest == last), n - before - below
    if key == _CONTENT:
        copies = F.explode(F.sequence(F.lit(1), F.lit(missing))).alias("_copy")
        return below_rows.unionByName(tied.limit(1).select("*", copies).drop("_copy"))
    told_apart = tied.withColumn(_CONTENT, content_digest(df))
    return below_rows.unionByName(sample_n(told_apart, missing, seed, _CONTENT, sort_rows).drop(_CONTENT))


def _digest(key: str, seed: int) -> Column:
    """The key's digest; rows without key share one that no key has by its text."""
    return F.coalesce(key_hash(key, seed), F.md5(F.lit(f"\0|{seed}")))


def content_digest(df: DataFrame) -> Column:
    """Digest of all columns of a row; different values give different texts, and so does a null."""
    parts = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            micros = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
            text = F.to_json(F.struct(column), micros)
        else:
            text = F.hex(column) if isinstance(field.dataType, T.BinaryType) else column.cast("string")
        parts += [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))]
    return F.md5(F.concat(*parts))


def split_column(fractions: Sequence[float], seed: int, key: str = "listing_id", names=("train", "valid", "test")):
    u, edge = hash_uniform(key, seed), 0.0
    column = None
    for fraction, name in zip(fractions[:-1], names):
        edge = round(edge + fraction, 10)
        column = F.when(u < edge, name) if column is None else column.when(u < edge, name)
    return column.otherwise(names[len(fractions) - 1])


def split3(df: DataFrame, fractions=(0.7, 0.15, 0.15), seed: int = 50, key: str = "listing_id") -> DataFrame:
    """Add `split` = train / valid / test. No shuffle; a row keeps its split for ever."""
    return df.withColumn("split", split_column(fractions, seed, key))


def split2(df: DataFrame, test_fraction: float = 0.3, seed: int = 50, key: str = "listing_id") -> DataFrame:
    return df.withColumn(
        "split", split_column((1 - test_fraction, test_fraction), seed, key, ("train", "test"))
    )


def with_fold(df: DataFrame, k: int, seed: int = 50, key: str = "listing_id") -> DataFrame:
    return df.withColumn("fold", (hash_bucket(key, seed) % k).cast("int"))


def head_by(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First n rows in an explicit order (a top-n: each task keeps n rows, the rest is dropped early)."""
    return df.orderBy(*order).limit(n)
