"""Delimited, gzip, zip and JSON files."""
from __future__ import annotations

import csv
import io
import re
import struct
import zipfile
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import chain, groupby
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources.ranges import records

LINES_PER_BATCH = 10_000


HEADER_SETTINGS = {
    # one file for each task, few lines in each batch
    "spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _first_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first record of the one file in this task; the rest of it is not read."""
    path = None

    def lines() -> Iterator[str]:
        nonlocal path
        for batch in batches:
            for path, line in zip(batch["path"], batch["value"]):
                yield line + "\n"

    for record in csv.reader(lines(), strict=False):
        if record:
            yield pd.DataFrame({"path": [path], "header": [[name.removeprefix("\ufeff") if i == 0 else name for i, name in enumerate(record)]]})
            return


def _headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names in their first record: one job, in which a task reads the first lines of one file."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias("path"), "value")
    by_header: dict[tuple[str, ...], list[str]] = {}
    with _settings(spark, HEADER_SETTINGS):
        found = lines.mapInPandas(_first_records, "path string, header array<string>").collect()
    for row in sorted(found, key=lambda r: r["path"]):
        # the column holds the path as an address, and readers take marks in names for patterns
        path = re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(row["path"]))
        names = [name or f"_c{i}" for i, name in enumerate(row["header"])]
        often = Counter(name.lower() for name in names)
        by_header.setdefault(tuple(n if often[n.lower()] == 1 else f"{n}{i}" for i, n in enumerate(names)), []).append(path)
    return by_header


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str,
    multi_line: bool = True,
    spread_over: int | None = None,
    missing: str = "NA",
    path_column: str | None = None,
    in_ranges: bool = False,
) -> DataFrame:
    """Headed CSV files as the columns of ``schema``, matched by name file by file.

    Files may hold the columns in any order, lack some (missing there) or have others, such
    as an unnamed row counter (dropped); a column that no file has is an error. A value equal to ``missing`` and an
    empty one are missing. Records may hold line breaks in quotes; files known to have
    none can be split over tasks with ``multi_line=False``, others with ``in_ranges``: their lines are written to a
    table once, and the quotes before each byte range tell where its records start. ``spread_over`` shuffles gzip input, which
    Spark reads as one task per file. ``path_column`` adds each row's file.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    groups = _headers(spark, paths)
    absent = [n for n in schema.names if groups and not any(n in header for header in groups)]
    if absent:
        raise ValueError(f"no file has the columns {absent}")
    parts = []
    for header, names in groups.items():
        own = T.StructType([schema[n] if n in schema.names else T.StructField(n, T.StringType()) for n in header])
        reader = spark.read.schema(own).option("header", True).option("nullValue", missing).option("escape", '"')
        columns = [F.col(f"`{f.name}`") if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        if in_ranges:
            parse = {"nullValue": missing, "escape": '"', "multiLine": "true"}
            cells = F.from_csv("record", ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in own.fields), parse)
            part, file = records(spark, names).select("path", cells.alias("__cells")).select("__cells.*", F.col("path").alias("__file")), F.col("__file")
        else:
            # every header was matched by name above
            part, file = reader.option("enforceSchema", True).option("multiLine", multi_line).csv(names), F.col("_metadata.file_path")
        parts.append(part.select(*columns, *([file.alias(path_column)] if path_column else [])))
    if not parts:
        fields = [*schema.fields, *([T.StructField(path_column, T.StringType())] if path_column else [])]
        return spark.createDataFrame([], T.StructType(fields))
    df = reduce(DataFrame.union, parts)
    return df.repartition(spread_over) if spread_over else df


def read_years(
    spark: SparkSession, path: str, schema: T.StructType | str, pattern: str = r"(\d{4})", multi_line: bool = True, missing: str = "NA"
) -> DataFrame:
    """One file or folder per year, columns matched by name in each; the year comes from the path."""
    df = read_csv(spark, path, schema, multi_line, missing=missing, path_column="__path")
    tail = F.substring_index(F.col("__path"), "/", -2)
    return df.withColumn("year", F.regexp_extract(tail, pattern, 1).cast("int")).drop("__path")


def write_csv(df: DataFrame, path: str, compression: str | None = None, one_file: bool = False, missing: str = "NA") -> None:
    """Headed CSV, missing values as ``missing`` (choose a mark that no text equals).

    ``one_file`` is for small published tables."""
    out = df.coalesce(1) if one_file else df
    writer = out.write.option("header", True).option("nullValue", missing).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def column_chunks(df: DataFrame, order: str, rows: int) -> DataFrame:
    """Column-oriented JSON: one object of arrays per ``rows`` consecutive order values.

    Chunks keep every object small; ``order`` is a unique whole number.
    """
    chunk = F.floor(F.col(order) / rows).alias("chunk")
    packed = F.sort_array(F.collect_list(F.struct(order, *[c for c in df.columns if c != order])))
    grouped = df.groupBy(chunk).agg(packed.alias("__rows"))
    columns = [F.col("__rows")[c].alias(c) for c in df.columns]
    return grouped.select("chunk", F.to_json(F.struct(*columns)).alias("json"))


def from_column_chunks(chunks: DataFrame, schema: T.StructType) -> DataFrame:
    """Column-oriented JSON back to rows."""
    arrays = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in schema.fields])
    parsed = chunks.select(F.from_json("json", arrays).alias("o"))
    zipped = F.arrays_zip(*[F.col(f"o.{name}") for name in schema.names])
    return parsed.select(F.explode(zipped).alias("r")).select(*[F.col(f"r.{n}") for n in schema.names])


def zip_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archive files as (path, content)."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


CHUNK = 8_000_000


def _member_chunks(archives: DataFrame, member: str) -> DataFrame:
    """Members whose name ends in ``member`` as chunks of their compressed bytes, those of one member in order in one
    partition. The archives' directories are read and their bytes cut, nothing is unpacked before the shuffle. An archive
    must fit into one cell (2 GB)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own, path, content in zip(batch["__archive"], batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for place, info in enumerate(archive.infolist()):
                        if not info.filename.endswith(member):
                            continue
                        if info.flag_bits & 1 or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                            raise ValueError(f"{info.filename}: only plain and deflated members without a password are read")
                        # the local header repeats name and extra field, with lengths of its own
                        lengths = struct.unpack("<HH", content[info.header_offset + 26:info.header_offset + 30])
                        start = info.header_offset + 30 + sum(lengths)
                        for no, at in enumerate(range(0, max(1, info.compress_size), CHUNK)):
                            data = bytes(content[start + at:start + min(at + CHUNK, info.compress_size)])
                            yield pd.DataFrame({
                                "archive": [own], "place": [place], "no": [no], "path": [path], "member": [info.filename],
                                "packed": [info.compress_type == zipfile.ZIP_DEFLATED], "crc": [info.CRC], "data": [data]})

    path = F.col("path") if "path" in archives.columns else F.lit(None).cast("string")
    rows = archives.select(F.monotonically_increasing_id().alias("__archive"), path.alias("path"), "content")
    chunks = rows.mapInPandas(cut, "archive long, place int, no int, path string, member string, packed boolean, crc long, data binary")
    # by number: adaptive execution would join partitions by their packed size
    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return chunks.repartition(parts, "archive", "place").sortWithinPartitions("archive", "place", "no")


class _Unpacked(io.RawIOBase):
    """A member's bytes, unpacked chunk by chunk as they are read; a wrong checksum is an error."""

    def __init__(self, chunks: Iterator):
        self.chunks, self.held, self.sum, self.first = chunks, b"", 0, None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.held:
            if self.first is not None and self.first.packed and self.unpack.unconsumed_tail:
                self.held = self.unpack.decompress(self.unpack.unconsumed_tail, CHUNK)
            else:
                chunk = next(self.chunks, None)
                if chunk is None:
                    if self.first is not None and self.first.packed and not self.unpack.eof:
                        self.held = self.unpack.decompress(b"", CHUNK)  # what the limit of the last call kept back
                    if not self.held:
                        if self.first is not None and self.sum != self.first.crc:
                            raise zipfile.BadZipFile(f"{self.first.member}: wrong checksum")
                        return 0
                    break
                if self.first is None:
                    self.first, self.unpack = chunk, zlib.decompressobj(-15)
                self.held = self.unpack.decompress(chunk.data, CHUNK) if chunk.packed else bytes(chunk.data)
        size = min(len(buffer), len(self.held))
        buffer[:size], self.held = self.held[:size], self.held[size:]
        self.sum = zlib.crc32(buffer[:size], self.sum)
        return size


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, str, io.BufferedReader]]:
    """(path, member, bytes to read) of each member in a partition of chunks; each is read to its end before the next."""
    chunks = (row for batch in batches for row in batch.itertuples(index=False))
    for _, own in groupby(chunks, key=lambda c: (c.archive, c.place)):
        first = next(own)
        yield first.path, first.member, io.BufferedReader(_Unpacked(chain([first], own)), 1 << 20)


def zip_lines(archives: DataFrame, member: str = ".csv") -> DataFrame:
    """Lines of the members whose name ends in ``member``: (path, member, line_no, line).

    Members are dealt out as they are packed: each is unpacked in a task of its own, streamed in batches.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path, name, held in _members(batches):
            rows: list[tuple] = []
            for number, line in enumerate(io.TextIOWrapper(held, encoding="utf-8", newline=None)):
                rows.append((path, name, number, line.rstrip("\n")))
                if len(rows) == LINES_PER_BATCH:
                    yield pd.DataFrame(rows, columns=["path", "member", "line_no", "line"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["path", "member", "line_no", "line"])

    return _member_chunks(archives, member).mapInPandas(unpack, "path string, member string, line_no long, line string")


def zip_csv(archives: DataFrame, schema: T.StructType | str, member: str = ".csv", missing: str = "NA") -> DataFrame:
    """Headed CSV members of zip archives as typed rows, columns matched by name in each member.

    Records may hold line breaks in quotes. Members are dealt out as they are packed: each is unpacked and parsed in a
    task of its own, streamed in batches. A value that is not of its column's type is missing.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.names

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, held in _members(batches):
            yield from parsed(csv.reader(io.TextIOWrapper(held, encoding="utf-8-sig", newline="")))

    def parsed(reader) -> Iterator[pd.DataFrame]:
        header = next(reader, [])
        places = [header.index(n) if n in header else None for n in names]
        rows: list[list] = []
        for record in reader:
            if not record:
                continue
            values = [record[p] if p is not None and p < len(record) else None for p in places]
            rows.append([None if v in ("", missing) else v for v in values])
            if len(rows) == LINES_PER_BATCH:
                yield pd.DataFrame(rows, columns=names, dtype=object)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names, dtype=object)

    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = _member_chunks(archives, member).mapInPandas(unpack, texts)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
