"""URL rules by a sorted digest array.

Each rule (host, path, action) is one string, host and path joined, under its 64-bit xxhash. The digests are sorted;
executors map them from a file of their own and probe by vectorised binary search, and every digest that is found is confirmed
against the stored string. A URL is probed with each suffix of its host that starts at a label and each prefix of its path that is as
long as some rule's path; the longest rule wins.

The array is shipped whole only up to `whole_bytes`. A longer list stays a table: probes are exploded and joined with
it on the digest, and strings are compared after the join.

Nulls: a null URL, or one without `://`, has an empty host and path and fits no rule. Empty hosts fit no rule. Rules
with a null part are ignored, repeated rules count once (block before allow). Other columns are carried along."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspan.llm.text import LOWER_CASE, UPPER

WHOLE_BYTES = 64 << 20
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER_CASE)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_table(spark, rules) -> DataFrame:
    """(host, path, action) rows as a table; digests and one row per rule."""
    df = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), "host string, path string, action string")
    named = df.where("host <> '' and path is not null and action is not null").groupBy(
        F.translate("host", UPPER, LOWER_CASE).alias("host"), "path"
    ).agg(
        F.max("action").alias("action")
    )
    rule = F.concat("host", "path")
    return named.select("host", "path", "action", rule.alias("rule"), F.length("path").alias("path_chars"))


class DigestArray:
    """Sorted 64-bit digests in a mapped file, and the strings they stand for."""

    def __init__(self, digests: bytes, strings: list[tuple[str, str, str]]):
        self._file = tempfile.TemporaryFile()  # a few bytes per rule, gone with the process
        self._file.write(digests)
        self._file.flush()
        self.keys = np.memmap(self._file, np.uint64, "r", shape=(len(digests) // 8,)) if digests else np.zeros(0, np.uint64)
        self.strings = strings

    @staticmethod
    def pack(rules: list[tuple[str, str, str]]) -> tuple[bytes, list[tuple[str, str, str]]]:
        digests = np.array([digest(host, path) for host, path, _ in rules], dtype=np.uint64)
        order = np.argsort(digests, kind="stable")
        return digests[order].tobytes(), [rules[i] for i in order]

    def probe(self, digests: np.ndarray, parts: list[tuple[str, str]]) -> list[tuple[str, str, str] | None]:
        """The rule that equals each (host, path), if there is one."""
        left, right = (np.searchsorted(self.keys, digests, side) for side in ("left", "right"))
        found: list = [None] * len(parts)
        for i in np.flatnonzero(left < right).tolist():
            same = (self.strings[j] for j in range(left[i], right[i]) if self.strings[j][:2] == parts[i])
            found[i] = next(same, None)
        return found


def digest(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}\0{path}".encode())


def _suffixes(host: str) -> list[str]:
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))] if host else []


def filter_urls(
    pages: DataFrame, rules, url: str = "url", default: str = DEFAULT, whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """`pages` with host, path, rule (null where none fits) and verdict; columns of these names are replaced."""
    spark = pages.sparkSession
    known = rule_table(spark, rules)
    size = known.agg(F.sum(F.octet_length("rule") + F.lit(64))).first()[0] or 0
    rows = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"host": host_of(F.col(url)), "path": path_of(F.col(url))}
    )
    lengths = sorted(r[0] for r in known.select("path_chars").distinct().collect())  # at most the longest path
    judged = _by_array(rows, known, lengths) if size <= whole_bytes else _by_join(rows, known, lengths)
    return judged.withColumn("verdict", F.coalesce(F.col("verdict"), F.lit(default)))


def _by_array(rows: DataFrame, known: DataFrame, lengths: list[int]) -> DataFrame:
    packed = DigestArray.pack([tuple(r) for r in known.select("host", "path", "action").toLocalIterator()])
    shipped = rows.sparkSession.sparkContext.broadcast(packed)
    columns = rows.columns

    def run(batches):
        array = DigestArray(*shipped.value)
        for batch in batches:
            hosts, paths = (batch.column(columns.index(c)).to_pylist() for c in ("host", "path"))
            owner, parts = [], []
            for i, (host, path) in enumerate(zip(hosts, paths)):
                for suffix in _suffixes(host):
                    for n in lengths:
                        if n <= len(path):
                            owner.append(i)
                            parts.append((suffix, path[:n]))
            digests = np.fromiter((digest(*p) for p in parts), np.uint64, len(parts))
            best: list = [None] * len(hosts)
            for i, hit in zip(owner, array.probe(digests, parts)):
                if hit and (best[i] is None or _rank(hit) > _rank(best[i])):
                    best[i] = hit
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array([b and b[0] + b[1] for b in best], pa.string()),
                    pa.array([b and b[2] for b in best], pa.string()),
                ],
                [*columns, "rule", "verdict"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, rule string, verdict string")


def _rank(rule: tuple[str, str, str]) -> tuple[int, int, str]:
    return len(rule[0]) + len(rule[1]), len(rule[0]), rule[2]


def _by_join(rows: DataFrame, known: DataFrame, lengths: list[int]) -> DataFrame:
    """The same for lists of any size. Different (host, path) of URLs are few beside the URLs, and are judged once."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.char_length("path"))
    distinct = rows.select("host", "path").distinct()
    probes = distinct.withColumn("suffix", F.explode(suffixes)).withColumn("n", F.explode(starts)).select(
        "host", "path", "suffix", F.expr("substring(path, 1, n)").alias("start")
    )
    stored = known.select(
        F.xxhash64("host", "path").alias("key"), F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action", "rule"
    )
    hits = probes.withColumn("key", F.xxhash64("suffix", "start")).join(stored, "key").where(
        (F.col("suffix") == F.col("rule_host")) & (F.col("start") == F.col("rule_path"))
    )
    rank = F.struct(F.length("rule"), F.length("rule_host"), F.col("action"), F.col("rule"))
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    out = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("verdict"))
    return rows.join(out, ["host", "path"], "left").select(*rows.columns, "rule", "verdict")
