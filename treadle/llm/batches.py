"""Row-by-row work on texts inside Arrow batches: one output row per input row, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def id_and_text(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only the two columns an operator needs, so other columns may have any names."""
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))


def map_texts(rows: DataFrame, make: Callable[[], Callable[[list], Iterable[tuple]]], schema: str) -> DataFrame:
    """Apply ``make()(records)`` to each Arrow batch of ``rows``; records are tuples of its columns.

    ``make`` runs once per task; what it loads can be kept per worker process by its own cache.
    """
    out_type = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out_type)
        work = None
        for batch in batches:
            work = work or make()
            records = list(zip(*(c.to_pylist() for c in batch.columns)))
            out = list(work(records))
            columns = list(zip(*out)) if out else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, out_type)
