"""Vectors of fixed size, summed over partitions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 64  # vectors that a task adds in the later rounds


def sum_vectors(rows: DataFrame, part_of: Callable[[pa.RecordBatch], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """Add up what `part_of` gives of each batch: {block: vector of doubles}.

    A partition sends one vector per block. Vectors of a block are added in three rounds, so that no task gets those of all
    partitions, or of more than FAN in the rounds after the first; the driver gets one per block."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, vector in part_of(batch).items():
                total[block] = total[block] + vector if block in total else np.asarray(vector, float)
        share = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(total), pa.int32()), pa.array([share] * len(total), pa.int32()),
                pa.array([v.tobytes() for v in total.values()], pa.binary()),
            ],
            ["block", "share", "vector"],
        )

    def add(table):
        total = np.stack([np.frombuffer(v.as_py()) for v in table.column("vector")]).sum(axis=0)
        return table.slice(0, 1).set_column(2, "vector", pa.array([total.tobytes()], pa.binary()))

    schema = "block int, share int, vector binary"
    some = rows.mapInArrow(run, schema)
    for shares in (FAN * FAN, FAN, 1):
        some = some.withColumn("share", F.col("share") % shares).groupBy("block", "share").applyInArrow(add, schema)
    return {r["block"]: np.frombuffer(r["vector"]) for r in some.toLocalIterator()}
