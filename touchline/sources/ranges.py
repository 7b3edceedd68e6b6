"""Delimited files with line breaks in quotes, read in byte ranges by many tasks."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators.ordered import attach
from touchline.session import scratch_dir

MARKED = "path string, start long, no long, value string, before long, quotes long"


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each byte range and count the quotes before each line; a range's lines come one after another."""
    at, number, seen = None, 0, 0
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        quotes = pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False).astype(np.int64)
        paths, starts = batch.column("path").dictionary_encode(), batch.column("start").to_numpy(zero_copy_only=False)
        codes = paths.indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        no, before = np.empty(size, np.int64), np.empty(size, np.int64)
        for low, high in zip([0, *cuts], [*cuts, size]):
            here = (paths.dictionary[int(codes[low])].as_py(), int(starts[low]))
            if here != at:
                at, number, seen = here, 0, 0
            total = np.cumsum(quotes[low:high])
            no[low:high] = number + np.arange(high - low)
            before[low:high] = seen + total - quotes[low:high]
            number, seen = number + high - low, seen + int(total[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("start"), pa.array(no), batch.column("value"), pa.array(before), pa.array(quotes)],
            names=["path", "start", "no", "value", "before", "quotes"])


def records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, record): the records of delimited files as texts, without each file's first one (its header) and blank ones.

    A line starts a record if an even number of quotes stands before it in its file. Every task marks the lines of its
    byte ranges by the quotes since the range's start, and writes them to a table, once; the quotes of all
    ranges before one, summed up in the order of the file, tell which lines of it start a record. Records of one line stay in
    place. Only the lines of longer ones are shuffled, to be put together; such a record may reach over any number of ranges.

    Defined results: a quote that is never closed makes the rest of its file one record, as for any reader; a line break is "\\n" with an
    optional "\\r" before; files without lines give nothing.
    """
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    held = scratch_dir(spark, "lines")
    lines.mapInArrow(_marked, MARKED).write.parquet(held)
    marked = spark.read.parquet(held)

    place = F.struct("start", "no")
    even = F.col("before") % 2 == 0
    blank = F.trim(F.regexp_replace("value", r"[\r\uFEFF]", "")) == ""
    ranges = marked.groupBy("path", "start").agg(
        F.sum("quotes").alias("quotes"), F.max(F.when(even, place)).alias("even"), F.max(F.when(~even, place)).alias("odd"),
        F.min(F.when(~blank, place)).alias("first"))
    ahead = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("parity", F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2)
    last = F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("odd"))
    ranges = ranges.withColumn("open", F.last(last, ignorenulls=True).over(ahead)).withColumn("header", F.min("first").over(Window.partitionBy("path")))
    ranges = ranges.select("path", "start", "parity", "open", "header")

    known = attach(marked, ranges, ["path", "start"], measure=True)
    outside = (F.col("parity") + F.col("before")) % 2 == 0
    known = known.withColumns({"begins": outside, "ends": (F.col("parity") + F.col("before") + F.col("quotes")) % 2 == 0})
    single = known.where(F.col("begins") & F.col("ends") & (place != F.col("header"))).select("path", F.col("value").alias("record"))
    parts = known.where(~(F.col("begins") & F.col("ends")))
    # of a longer record only the first line begins and leaves a quote open
    so_far = Window.partitionBy("path", "start").orderBy("no")
    parts = parts.withColumn("of", F.coalesce(F.last(F.when(F.col("begins"), place), ignorenulls=True).over(so_far), "open"))
    parts = parts.where(F.col("of") != F.col("header"))
    joined = parts.groupBy("path", "of").agg(F.array_sort(F.collect_list(F.struct("start", "no", "value"))).alias("lines"))
    longer = joined.select("path", F.array_join(F.col("lines.value"), "\n").alias("record"))
    every = single.unionByName(longer).withColumn("record", F.regexp_replace("record", "\r\\z", ""))
    return every.where(F.trim("record") != "")
