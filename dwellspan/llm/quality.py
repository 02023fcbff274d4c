"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

Each text is scanned once for its statistics (STATISTICS). Standardised statistics go through cosines of random projections,
which approximate a Gaussian kernel; every partition sums its part of the normal equations, the parts are added by
blocks in two rounds, and the solved ridge weights give raw scores. On labelled rows that the fit didn't see, raw scores are counted in
BINS cells and pooled to a rising curve, which turns scores into probabilities.

The fit uses all labelled rows. What the driver gets has a fixed size: two moments per statistic, a FEATURES-square matrix, the
cells. Nulls: a null text is empty; its statistics are zeros and it is scored like any other. Null labels are ignored, and so
are documents whose labels disagree. Repeated rows are scored alike. Without labels of both kinds every score is the share of label 1
(0.5 without any). Only the text is an input of a score."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspan.llm.sums import sum_vectors
from dwellspan.llm.text import free_name, mix, plain_names, text_chunks, words_of
from dwellspan.session import materialise

STATISTICS = (
    "log_words", "word_length", "word_length_spread", "upper_share", "symbol_share", "mark_share", "digit_share",
    "foreign_share", "blank_share", "line_share", "bar_share", "distinct_words", "repeated_neighbours", "top_word",
    "distinct_pairs", "distinct_triples", "stops_per_word", "top_triple",
)
FEATURES, RIDGE, SEED, BINS, THRESHOLD = 256, 1.0, 7, 1024, 0.3
_PARTS = 16  # blocks of rows of the normal equations


def _classes() -> np.ndarray:
    """Per byte: upper, symbol, mark, digit, non-ASCII, blank, line end, bar, stop."""
    table = np.zeros((9, 256), dtype=np.float32)
    for row, members in enumerate(
        (range(65, 91), b"#$%&*+/<=>@[\\]^_`{}~!", b".,;:?\"'()-", range(48, 58), range(128, 256), b" \t\r", b"\n", b"|", b".?\n")
    ):
        table[row, list(members)] = 1
    return table


_CLASSES = _classes()


def _repeats(keys: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: number of keys, of different keys, and of its most frequent key."""
    total = np.bincount(owner, minlength=rows)
    if not len(keys):
        return total, total, total
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])]))
    runs, whose = np.diff(np.append(new, len(k))), o[new]
    top = np.zeros(rows, dtype=np.int64)
    np.maximum.at(top, whose, runs)
    return total, np.bincount(whose, minlength=rows), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text of a chunk."""
    rows, words = len(offsets) - 1, words_of(data, offsets)
    lengths = np.diff(offsets)
    size, n = np.maximum(lengths, 1), np.maximum(words.counts, 1)
    owner = words.rows
    shares = []
    for table in _CLASSES:
        sums = np.zeros(len(data) + 1)
        np.cumsum(table[data], out=sums[1:])
        shares.append((sums[offsets[1:]] - sums[offsets[:-1]]))
    upper, symbols, marks, digits, foreign, blanks, line_ends, bars, stops = shares
    width = words.ends - words.starts
    mean = np.bincount(owner, width, rows) / n
    spread = np.sqrt(np.maximum(np.bincount(owner, width.astype(float) ** 2, rows) / n - mean**2, 0))
    same = np.zeros(len(owner), dtype=bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    _, different, top = _repeats(words.hashes, owner, rows)
    runs = []
    for k in (2, 3):
        m = max(0, len(owner) - k + 1)
        key = words.hashes[:m].copy()
        for j in range(1, k):
            key = mix(key * np.uint64(31) + words.hashes[j : j + m])
        inside = owner[:m] == owner[k - 1 : k - 1 + m]
        runs.append(_repeats(key[inside], owner[:m][inside], rows))
    columns = [
        np.log1p(words.counts), mean, spread, upper / size, symbols / size, marks / size, digits / size, foreign / size,
        blanks / size, line_ends / size, bars / size, different / n, np.bincount(owner, same, rows) / n, top / n,
        runs[0][1] / np.maximum(runs[0][0], 1), runs[1][1] / np.maximum(runs[1][0], 1), stops / n,
        runs[1][2] / np.maximum(runs[1][0], 1),
    ]
    return np.stack(columns, axis=1)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # empty: every score is `base`
    edges: np.ndarray
    levels: np.ndarray
    base: float
    seed: int = SEED

    def features(self, x: np.ndarray) -> np.ndarray:
        return fourier(self.standard(x), len(self.weights) - 1, self.seed)

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.base)
        return np.clip(np.interp(self.raw(x), self.edges, self.levels), 0.0, 1.0)


def fourier(z: np.ndarray, features: int, seed: int) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel as wide as two rows usually lie apart, and a constant."""
    draw = np.random.default_rng(seed)
    d = z.shape[1]
    directions, phases = draw.normal(size=(d, features)) / np.sqrt(d), draw.uniform(0, 2 * np.pi, features)
    return np.hstack([np.sqrt(2 / features) * np.cos(z @ directions + phases), np.ones((len(z), 1))])


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), len(STATISTICS))


def with_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and the statistics of each text, as an array."""
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    names = [*keep, "statistics"]

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(len(names) - 1)):
                x = statistics(data, offsets)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel())
                )
                yield pa.RecordBatch.from_arrays([*batch.slice(first, end - first).columns[:-1], listed], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}, statistics array<double>")


def _rising(counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the closest rising curve to the means of the cells."""
    pools: list[list[float]] = []
    for n, s in zip(counts, sums):
        pools.append([n, s, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n2, s2, c2 = pools.pop()
            pools[-1] = [pools[-1][0] + n2, pools[-1][1] + s2, pools[-1][2] + c2]
    return np.concatenate([np.full(int(c), s / n) for n, s, c in pools])


def fit_quality(
    rows: DataFrame, label: str = "label", calibrate: str = "calibrate", features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED
) -> QualityModel:
    """`rows`: statistics, a label 0 or 1, and whether the row is for calibration instead of the fit."""
    rows = rows.select("statistics", F.col(label).cast("double").alias("y"), F.col(calibrate).cast("boolean").alias("c"))
    d = len(STATISTICS)

    def moments(batch):
        x, y, c = _vectors(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
        return {0: np.concatenate([[len(y), y.sum(), (~c).sum(), y[~c].sum(), c.sum()], x[~c].sum(axis=0), (x[~c] ** 2).sum(axis=0)])}

    n, positive, n_fit, fit_positive, n_calibrate, *sums = sum_vectors(rows, moments).get(0, np.zeros(5 + 2 * d))
    sums = np.array(sums)
    base = positive / n if n else 0.5
    none = np.zeros(0)
    if not 0 < fit_positive < n_fit:
        return QualityModel(np.zeros(d), np.ones(d), none, none, none, base, seed)
    mean = sums[:d] / n_fit
    scale = np.sqrt(np.maximum(sums[d:] / n_fit - mean**2, 0))
    scale[scale < 1e-9] = 1.0
    model = QualityModel(mean, scale, np.zeros(features + 1), none, none, base, seed)

    def equations(batch):
        keep = ~batch.column(2).to_numpy(zero_copy_only=False)
        z, y = model.features(_vectors(batch.column(0))[keep]), batch.column(1).to_numpy()[keep]
        whole = z.T @ np.hstack([z, (y - fit_positive / n_fit)[:, None]])
        return dict(enumerate(b.ravel() for b in np.array_split(whole, _PARTS)))

    found = sum_vectors(rows, equations)
    whole = np.concatenate([found[i].reshape(-1, features + 2) for i in range(_PARTS)])
    penalty = ridge * np.eye(features + 1)
    penalty[-1, -1] = 1e-6
    weights = np.linalg.solve(whole[:, :-1] + penalty, whole[:, -1])
    weights[-1] += fit_positive / n_fit
    model.weights = weights

    def cells(batch):
        keep = batch.column(2).to_numpy(zero_copy_only=False) if n_calibrate else np.ones(batch.num_rows, dtype=bool)
        at = np.clip((model.raw(_vectors(batch.column(0))[keep]) + 1) / 3 * BINS, 0, BINS - 1).astype(int)
        y = batch.column(1).to_numpy()[keep]
        return {0: np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)])}

    seen = sum_vectors(rows, cells)[0]
    counts, sums = seen[:BINS], seen[BINS:]
    full = counts > 0
    model.edges = (np.flatnonzero(full) + 0.5) * 3 / BINS - 1
    model.levels = _rising(counts[full], sums[full])
    # a slope far too small to move a decision keeps the order of raw scores within a pool
    model.levels = (model.levels + 1e-3 * (model.edges + 1) / 3) / (1 + 1e-3)
    return model


def labelled(statistics_: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", folds: int = 5) -> DataFrame:
    """Statistics of the documents to learn from: labelled 0 or 1 without contradiction, crc32 of the id not divisible by
    `folds`; those of remainder `folds - 1` are for calibration."""
    clear = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("__id")).agg(
        F.min(label).alias("label"), F.max(label).alias("__most")
    ).where("label = __most")
    fold = fold_of(F.col("__id"), folds)
    learn = clear.where(fold != 0).select("__id", "label", (fold == folds - 1).alias("calibrate"))
    return statistics_.select(F.col(doc_id).alias("__id"), "statistics").join(learn, "__id").select("statistics", "label", "calibrate")


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(1))


def score(statistics_: DataFrame, model: QualityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    names = [*keep, "score"]
    rows = statistics_.select(*keep, "statistics")

    def run(batches):
        for batch in batches:
            scores = model.score(_vectors(batch.column(len(names) - 1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}, score double")


def train_and_score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, QualityModel]:
    """Scores of all documents (their ids), and the model; statistics are written once, so texts are read once."""
    known = materialise(with_statistics(docs, text, (doc_id,)), "statistics")
    model = fit_quality(materialise(labelled(known, labels, doc_id=doc_id), "labelled"))
    return score(known, model, (doc_id,)), model


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least `threshold`, with all their columns."""
    docs, named = plain_names(docs)
    name = free_name(docs, "text")
    rows = docs.withColumn(name, F.col(text).cast("string"))
    schema = docs.schema

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(batch.num_columns - 1)):
                good = pa.array(model.score(statistics(data, offsets)) >= threshold)
                part = batch.slice(first, end - first).filter(good)
                yield pa.RecordBatch.from_arrays(part.columns[:-1], part.schema.names[:-1])

    return named(rows.mapInArrow(run, schema))
