"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also where a lambda reads it for every element."""
    return F.transform(F.array(value), body)[0]


def per_process(key: str, build: Callable[[], Any]) -> Any:
    """A value built once in each Python worker and kept over its tasks."""
    kept = sys.modules.setdefault("_bandwise_kept", types.ModuleType("_bandwise_kept")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``rows`` rows, so that what is made from one of them stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


SCAN_BLOCK = 64


def scan(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running results of ``step`` over an array, one per element, ``start`` itself left out.

    Arrays cannot grow in place here, so results are gathered in blocks: an array of n elements
    costs n * ``SCAN_BLOCK`` / 2 copies, not n * n / 2.
    """

    def over(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / SCAN_BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * SCAN_BLOCK + 1, F.lit(SCAN_BLOCK)))

        def grown(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
            return F.aggregate(values, F.array(start), lambda done, x: F.concat(done, F.array(step(F.element_at(done, -1), x))))

        def inside(blocks: Column) -> Column:
            starts = grown(blocks, start, lambda done, block: F.aggregate(block, done, step))
            return let(
                starts,
                lambda starts: F.flatten(
                    F.transform(blocks, lambda block, k: F.slice(grown(block, starts[k], step), 2, SCAN_BLOCK))
                ),
            )

        return F.when(F.size(values) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks, inside))

    return let(values, over)
