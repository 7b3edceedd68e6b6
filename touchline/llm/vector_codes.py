"""Vector code compression: product codes with exact whole-number arithmetic.

A component x becomes the whole number floor(scale * x). Vectors are cut into equal parts, and each part position
gets a codebook, improved in rounds: every part goes to its nearest entry, then entries become the
floor of their parts' mean. Distances need dot products of whole numbers: the numbers are broken into limbs, so narrow
that a product of two limb matrices in float64 (BLAS) stays below 2^53, and the products are put together
again in int64. Results are therefore exact: they depend neither on the order of rows nor on how they are dealt.

Vectors are packed once (2, 4 or 8 bytes a component, as wide as needed) into a checkpointed table, and every
round is one pass over it without a shuffle of vectors: a task sends one number for each codebook position
and count. Codebooks (parts x entries x width numbers, whatever the data) travel with the tasks.

Defined results: rows whose vector is missing, empty, or holds a missing or non-finite component are dropped, as are
vectors of another length than most (of equally frequent lengths the longer one stays). That length must be a multiple of
the number of parts. Rows without an id come behind all others when codebooks begin; repeated ids begin
in the order of their packed components; with fewer rows than entries codebooks have fewer entries. Extra columns
are ignored. An empty table gives no rows. Components so large that a squared distance would pass 2^63 raise an error.
"""
from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import bound_batches
from touchline.operators.ordered import attach
from touchline.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def limbs(numbers: np.ndarray, width: int) -> list[np.ndarray]:
    """Float64 matrices whose sum, each shifted by ``width`` bits more, is ``numbers``; the last one is signed."""
    out = []
    while numbers.size and max(int(numbers.max()), -int(numbers.min())) >> width:
        out.append((numbers & ((1 << width) - 1)).astype(np.float64))
        numbers = numbers >> width
    return [*out, numbers.astype(np.float64)]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T for int64 matrices, exactly (as long as the result itself fits)."""
    width = (53 - max(1, a.shape[1]).bit_length()) // 2
    total = np.zeros((len(a), len(b)), np.int64)
    others = limbs(b, width)
    for i, x in enumerate(limbs(a, width)):
        for j, y in enumerate(others):
            if width * (i + j) < 64:
                total += (x @ y.T).astype(np.int64) << (width * (i + j))
    return total


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance to it) of every row; of equally near ones the first."""
    away = (entries * entries).sum(1)[None, :] - 2 * dots(vectors, entries)
    code = away.argmin(1)
    return code, away[np.arange(len(code)), code] + (vectors * vectors).sum(1)


def packed(df: DataFrame, id_column: str, vector: str, label: str | None, scale: int) -> DataFrame:
    """(id, label, n, top, cells) of rows with finite vectors: components as little-endian whole numbers, and the largest of them."""
    columns = [F.col(f"`{id_column}`").alias("id"), (F.col(f"`{label}`") if label else F.lit(None).cast("int")).alias("label")]

    def run(batches):
        for batch in batches:
            lists = batch.column("vector")
            flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)  # missing ones become NaN
            sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
            ends = np.cumsum(sizes)
            cells, n, top = [], [], []
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(flat * scale)
            for end, size in zip(ends.tolist(), sizes.tolist()):
                own = whole[end - size:end]
                if not size or not np.isfinite(flat[end - size:end]).all():
                    cells.append(None)
                    n.append(None)
                    top.append(None)
                    continue
                most = float(np.abs(own).max())
                kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
                cells.append(own.astype(kind).tobytes() if most < 2**62 else b"")
                n.append(size)
                top.append(most)
            made = pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(n, pa.int32()), pa.array(top, pa.float64()), pa.array(cells, pa.binary())],
                names=["id", "label", "n", "top", "cells"])
            yield made.filter(made.column("cells").is_valid())

    kinds = [f"{name} {column}" for name, column in zip(("id", "label"), (df.schema[id_column].dataType.simpleString(), df.schema[label].dataType.simpleString() if label else "int"))]
    rows = df.select(*columns, F.col(f"`{vector}`").alias("vector"))
    return bound_batches(rows).mapInArrow(run, ", ".join([*kinds, "n int", "top double", "cells binary"]))


def matrix(cells: Sequence[bytes], length: int) -> np.ndarray:
    """The packed vectors as rows of int64, whatever their widths."""
    sizes = np.array([len(c) for c in cells], np.int64)
    out = np.empty((len(cells), length), np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        joined = b"".join([cells[i] for i in at.tolist()])
        out[at] = np.frombuffer(joined, f"<i{size // length}").reshape(-1, length)
    return out


def _cut(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(vectors, parts, axis=1)


def improved(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: entries become the floor of the mean of the parts nearest to them, unused ones stay."""
    parts, entries, width = len(books), len(books[0]), books[0].shape[1]

    def run(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("cells").to_pylist(), parts * width)
            for p, own in enumerate(_cut(vectors, parts)):
                code, _ = nearest(own, books[p])
                chosen = (code[None, :] == np.arange(entries)[:, None]).astype(np.int64)
                total[p, :, :width] += dots(chosen, np.ascontiguousarray(own.T))
                total[p, :, width] += chosen.sum(1)
        flat = total.reshape(-1)
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(flat[slots], pa.int64())], names=["slot", "total"])

    sums = rows.select("cells").mapInArrow(run, "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total"))
    flat = np.zeros(parts * entries * (width + 1), np.int64)
    for slot, total in sums.collect():  # at most one row for each codebook position and count
        flat[slot] = total
    table = flat.reshape(parts, entries, width + 1)
    count = table[:, :, width:]
    means = table[:, :, :width] // np.maximum(count, 1)
    return [np.where(count[p] > 0, means[p], books[p]) for p in range(parts)]


def coded(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(id, label, code, error): two hexadecimal digits for each part, and the squared distances summed up."""
    parts, width = len(books), books[0].shape[1]

    def run(batches):
        digits = np.array([f"{i:02x}" for i in range(256)])
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("cells").to_pylist(), parts * width)
            code, error = np.full(len(vectors), "", f"<U{2 * parts}"), np.zeros(len(vectors), np.int64)
            for p, own in enumerate(_cut(vectors, parts)):
                index, away = nearest(own, books[p])
                code, error = np.char.add(code, digits[index]), error + away
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(code.tolist(), pa.string()), pa.array(error, pa.int64())], names=["id", "label", "code", "error"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    return rows.select("id", "label", "cells").mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.reshape(-1).tolist()).encode()).hexdigest()


def compressed(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """((id, label, code, error) of every kept row, the codebooks: one matrix of entries for each part)."""
    if not 1 <= entries <= 256:
        raise ValueError("two digits name at most 256 entries")
    every = cut_lineage(packed(df, id_column, vector, label, scale))
    lengths = every.groupBy("n").agg(F.count("*").alias("rows"), F.max("top").alias("top")).orderBy(F.desc("rows"), F.desc("n")).first()
    if lengths is None:
        return every.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    length = lengths["n"]
    if length % parts:
        raise ValueError(f"vectors of {length} components do not have {parts} equal parts")
    if 4 * length * (int(lengths["top"]) + 1) ** 2 >= 2**63:
        raise ValueError("components are too large for whole-number distances")
    rows = every.where(F.col("n") == length)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "cells").limit(entries).select("cells").collect()
    books = [np.ascontiguousarray(b) for b in _cut(matrix([bytes(r["cells"]) for r in first], length), parts)]
    for _ in range(rounds):
        books = improved(rows, books)
    return coded(rows, books), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``: the error summed over equal labels, missing ones together. Codes are checkpointed, labels counted."""
    codes = cut_lineage(codes)
    return attach(codes, codes.groupBy("label").agg(F.sum("error").alias("label_error")), ["label"], measure=True)


def decoded(codes: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """Adds ``vector``: the entries that the code names, as components again (the middle of each floor's step)."""
    tables = [F.array(*[F.array(*[F.lit((x + 0.5) / scale) for x in entry]) for entry in book.tolist()]) for book in books]
    pick = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") + 1
    return codes.withColumn("vector", F.concat(*[F.element_at(t, pick(p)) for p, t in enumerate(tables)]))
