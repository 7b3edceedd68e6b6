"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of about ``frame_bytes`` of UTF-8, each with the units and
code points before it. A cut after so many units is found in that index; the one frame that holds it is
decompressed and split, all other frames are used as they are. The transformed text is again a row
of frames (markers are frames of their own), so it is never joined in memory: digests stream over
the frames in order, and the restored text streams prefix, middle and suffix out of them.

Units are runs of ASCII white space with the word behind them, or white space at the end, so a unit ends
where white space follows a word: a border is a white-space byte behind another byte, in any frame.

Cut points and form come from the id and the seed alone, so reruns agree, whatever the order of rows.

Defined results: a missing text is empty, and an empty text stays plain; a text that holds a marker stays
plain, so markers are unambiguous; a missing id is drawn as an empty one, repeated ids get the same
draws; prefix and middle of plain texts have no length; extra columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from touchline.llm.batches import bound_batches, per_text
from touchline.session import scratch_dir

FRAME_BYTES = 1 << 15
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"  # fixed values: the markers
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
FRAME = StructType([
    StructField("data", BinaryType()), StructField("units", LongType()), StructField("chars", LongType()), StructField("inside", BooleanType())])


def _space(letters: np.ndarray) -> np.ndarray:
    return (letters == 32) | (letters >= 9) & (letters <= 13)


def _borders(letters: np.ndarray, inside: bool) -> np.ndarray:
    """Where a unit ends before a byte; ``inside``: the byte before the first is part of a word."""
    space = _space(letters)
    after = np.empty(len(space), bool)
    after[:1] = inside
    after[1:] = ~space[:-1]
    return np.flatnonzero(space & after)


def _points(letters: np.ndarray) -> int:
    """Code points that begin in these bytes."""
    return int(np.count_nonzero((letters & 0xC0) != 0x80))


class Frames:
    """Makes, cuts and reads frames; one compressor for all texts of a task."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.size = frame_bytes
        self.pack = zstandard.ZstdCompressor(level=1).compress
        self.unpack = zstandard.ZstdDecompressor().decompress

    def stored(self, data: bytes) -> tuple[int, list[tuple[bytes, int, int, bool]]]:
        """(units, frames) of a text; a frame is (data, units before, code points before, begins inside a word)."""
        letters = np.frombuffer(data, np.uint8)
        borders = _borders(letters, False)
        starts = np.arange(0, len(data), self.size)
        units = np.searchsorted(borders, starts)
        frames, points = [], 0
        for start, before in zip(starts.tolist(), units.tolist()):
            part = data[start:start + self.size]
            frames.append((self.pack(part), before, points, bool(start) and not _space(letters[start - 1:start])[0]))
            points += _points(letters[start:start + self.size])
        return (len(borders) + 1 if len(data) else 0), frames

    def place(self, frames: Sequence[dict], units: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) where the first ``units`` units end; fewer than all. One frame is decompressed."""
        if not units:
            return 0, 0, 0
        at = int(np.searchsorted([f["units"] for f in frames], units)) - 1
        letters = np.frombuffer(self.unpack(frames[at]["data"]), np.uint8)
        byte = int(_borders(letters, frames[at]["inside"])[units - frames[at]["units"] - 1])
        return at, byte, frames[at]["chars"] + _points(letters[:byte])

    def between(self, frames: Sequence[dict], first: tuple[int, int], last: tuple[int, int]) -> list[bytes]:
        """Frames of the text between two places; only frames that are cut are compressed anew."""
        out = []
        for at in range(first[0], min(last[0] + 1, len(frames))):
            low, high = first[1] if at == first[0] else 0, last[1] if at == last[0] else None
            if low == 0 and high is None:
                out.append(frames[at]["data"])
            elif high is None or high > low:
                out.append(self.pack(self.unpack(frames[at]["data"])[low:high]))
        return out

    def arranged(self, frames: Sequence[dict], total: int, form: str, cuts: tuple[int, int]) -> tuple[list[bytes], tuple[int, int] | None]:
        """Frames of the transformed text, and the code points of prefix and middle."""
        if form == "plain":
            return [f["data"] for f in frames], None
        end = len(frames), 0
        chars = None
        places, points = [], []
        for units in cuts:
            if units >= total:
                if chars is None:
                    chars = frames[-1]["chars"] + _points(np.frombuffer(self.unpack(frames[-1]["data"]), np.uint8))
                places.append(end)
                points.append(chars)
            else:
                *place, before = self.place(frames, units)
                places.append(tuple(place))
                points.append(before)
        parts = {PREFIX: ((0, 0), places[0]), MIDDLE: (places[0], places[1]), SUFFIX: (places[1], end)}
        out = []
        for marker in ORDERS[form]:
            out += [self.pack(marker), *self.between(frames, *parts[marker])]
        return out, (points[0], points[1] - points[0])

    def read(self, frames: Sequence[bytes], first: int = 0, last: int | None = None) -> Iterator[bytes]:
        """The bytes first..last of the content, frame by frame. Frames outside that stretch are passed over by their stated size."""
        at = 0
        for frame in frames:
            if last is not None and at >= last:
                return
            size = zstandard.frame_content_size(frame)
            if at + size > first:
                content = self.unpack(frame)
                yield content[max(0, first - at):None if last is None else last - at]
            at += size

    def digest(self, parts: Sequence[Iterator[bytes]]) -> str:
        made = hashlib.sha256()
        for part in parts:
            for content in part:
                made.update(content)
        return made.hexdigest()

    def marks(self, frames: Sequence[bytes]) -> tuple[dict[bytes, int], int, str]:
        """Where each marker stands in a transformed text, its size and its digest, in one pass over the output."""
        found, at, tail, made = {}, 0, b"", hashlib.sha256()
        for content in self.read(frames):
            made.update(content)
            seen = tail + content
            for marker in (PREFIX, SUFFIX, MIDDLE):
                if marker not in found and (place := seen.find(marker)) >= 0:
                    found[marker] = at - len(tail) + place
            tail = seen[-2:]
            at += len(content)
        return found, at, made.hexdigest()

    def restored(self, frames: Sequence[bytes], form: str, marks: dict[bytes, int], size: int) -> list[Iterator[bytes]]:
        """The original text as streams out of a transformed one."""
        if form == "plain":
            return [self.read(frames)]
        order = ORDERS[form]
        ends = dict(zip(order, [*[marks[m] for m in order[1:]], size]))
        return [self.read(frames, marks[m] + len(m), ends[m]) for m in (PREFIX, MIDDLE, SUFFIX)]


def draws(id_column: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers for each id."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def stored(df: DataFrame, id_column: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(id, n, marked, frames) of every text: its units, whether it holds a marker, and its seekable frames."""
    fields = [StructField("n", LongType()), StructField("marked", BooleanType()), StructField("frames", ArrayType(FRAME))]

    def work():
        maker = Frames(frame_bytes)
        names = FRAME.names

        def compute(texts):
            sizes, marked, frames = [], [], []
            for t in texts:
                data = (t or "").encode("utf-8", "surrogatepass")
                n, made = maker.stored(data)
                sizes.append(n)
                marked.append(any(m in data for m in (PREFIX, SUFFIX, MIDDLE)))
                frames.append([dict(zip(names, f)) for f in made])
            return [sizes, marked, frames]

        return compute

    return per_text(df, text, [id_column], fields, work)


def decided(store: DataFrame, id_column: str = "doc_id", seed: int = 42, rate: int = 50, suffix_first: int = 80) -> DataFrame:
    """Adds ``form`` and the units before the two cuts (``first_cut``, ``second_cut``)."""
    h = draws(F.col(f"`{id_column}`"), seed)
    one, two = (F.pmod(x, F.col("n") + 1) for x in h[:2])
    form = F.when((F.col("n") == 0) | F.col("marked") | (h[2] % 100 >= rate), "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    return store.withColumn("form", form).withColumn("first_cut", F.least(one, two)).withColumn("second_cut", F.greatest(one, two))


def _over_frames(df: DataFrame, keep: Sequence[str], fields: Sequence[StructField], work: Callable[[], Callable]) -> DataFrame:
    """``keep`` and what ``work()`` makes of each row of ``frames``, a bounded slice of rows at a time."""
    schema = StructType([df.schema[c] for c in keep] + list(fields))
    from pyspark.sql.pandas.types import to_arrow_schema

    def run(batches):
        compute = work()
        kinds = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                made = [compute(row) for row in part.select(used).to_pylist()]
                if made:
                    columns = [part.column(c) for c in keep] + [pa.array(v, kinds.field(f.name).type) for v, f in zip(zip(*made), fields)]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            pa.default_memory_pool().release_unused()

    used = ["frames", "n", "form", "first_cut", "second_cut"]
    return bound_batches(df).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, *used])]).mapInArrow(run, schema)


def transformed(store: DataFrame, id_column: str = "doc_id", frames: bool = False, **settings) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of stored texts; with ``frames`` the
    output itself as ``output``: zstandard frames that follow each other, which any reader of that format takes as one text.
    """
    fields = [StructField("prefix_chars", LongType()), StructField("middle_chars", LongType())]
    fields += [StructField("output_sha256", StringType()), StructField("restored_sha256", StringType())]
    fields += [StructField("output", BinaryType())] if frames else []

    def work():
        maker = Frames()

        def compute(row):
            made, sizes = maker.arranged(row["frames"], row["n"], row["form"], (row["first_cut"], row["second_cut"]))
            marks, size, digest = maker.marks(made)
            again = maker.digest(maker.restored(made, row["form"], marks, size))
            return [*(sizes or (None, None)), digest, again] + ([b"".join(made)] if frames else [])

        return compute

    return _over_frames(decided(store, id_column, **settings), list(dict.fromkeys([id_column, "n", "form"])), fields, work)


def written(df: DataFrame, id_column: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """The stored texts as a table in the shared folder (its frames are compressed already)."""
    path = scratch_dir(df.sparkSession, "frames")
    stored(df, id_column, text, frame_bytes).write.option("compression", "none").parquet(path)
    return df.sparkSession.read.parquet(path)
