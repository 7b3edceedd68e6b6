"""Row-wise work in Arrow batches: every operator of this folder that needs Python goes through here."""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from touchline.sources.tables import table

CHUNK_BYTES = 4_000_000
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(df: DataFrame) -> DataFrame:
    """Limit the session's Arrow batches to CHUNK_BYTES, if they are larger: rows with whole texts are
    large, and both ends of the exchange hold several batches of every running task."""
    conf = df.sparkSession.conf
    if int(str(conf.get(BATCH_KEY)).rstrip("b")) > CHUNK_BYTES:
        conf.set(BATCH_KEY, str(CHUNK_BYTES))
    return df


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts take about CHUNK_BYTES, one row at least: bounds the Python objects alive."""
    sizes = batch.column(column)
    sizes = [0 if not s.is_valid else s.as_buffer().size for s in sizes]
    start = taken = 0
    for i, size in enumerate(sizes):
        if taken and taken + size > CHUNK_BYTES:
            yield batch.slice(start, i - start)
            start, taken = i, 0
        taken += size
    yield batch.slice(start)


class _ByValue:
    """Unpickled as the object itself, of classes that travel with it."""

    def __init__(self, value):
        self.data = cloudpickle.dumps(value)

    def __reduce__(self):
        return cloudpickle.loads, (self.data,)


def shipped(spark: SparkSession, value) -> Broadcast:
    """A broadcast whose ``value`` in tasks is a copy of the object, kept by the worker from task to task. Plain
    broadcasts name their classes, so executors would need a copy of this package."""
    return spark.sparkContext.broadcast(_ByValue(value))


def per_text(
    df: DataFrame, text: str, keep: Sequence[str], fields: Sequence[StructField], work: Callable[[], Callable]
) -> DataFrame:
    """Columns ``keep`` as they are, and ``fields`` computed from the text column.

    ``work()`` is called once in each task and returns a function from a list of texts (missing
    ones as None) to one list for each field. Rows stay in place: no shuffle.
    """
    schema = StructType([df.schema[c] for c in keep] + list(fields))
    types = [_arrow(f.dataType) for f in fields]
    names = schema.names
    columns = list(dict.fromkeys([*keep, text]))

    def run(batches):
        compute = work()
        for batch in batches:
            if not batch.num_rows:
                continue
            for part in pieces(batch, text):
                made = compute(part.column(text).to_pylist())
                arrays = [part.column(c) for c in keep] + [pa.array(v, t) for v, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
            pa.default_memory_pool().release_unused()

    return bound_batches(df).select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not use, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def documents(spark, folder: str) -> DataFrame:
    return table(spark, folder, "documents")
