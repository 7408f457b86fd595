"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

from clickloom.sources.session import checkpointed, require_checkpoint_dir

#: Maps A-Z to a-z and leaves every other byte alone.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


#: A frame written to the shared checkpoint folder, its lineage cut.
durable = checkpointed


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name for ``name`` under the shared checkpoint folder."""
    unique = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    return f"{require_checkpoint_dir(spark)}/{name}-{unique}"


def batch(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def by_row(function, schema: pa.Schema):
    """A ``mapInArrow`` function from one over the values of a row to a tuple.

    Batches are cut to bounded text volumes, so a run of very long texts does
    not gather in one output batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for start in range(0, got.num_rows, 1000):
                part = got.slice(start, 1000)
                rows = [function(*row) for row in zip(*(c.to_pylist() for c in part.columns), strict=True)]
                yield batch(schema, *zip(*rows, strict=True))

    return run
