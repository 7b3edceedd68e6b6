"""Roles of transcript lines by a hidden Markov model, and canonical rendering of turns.

Hidden states are the roles. A line is observed by its speaker marker and by its form (blank,
question, short, middle, long), and by whether it begins a row of the transcript. Transitions and
emissions are counted over all rows whose role is known, with a smoothing constant. Viterbi finds
the most likely roles of all lines of a conversation; lines of a row that share a role make one
turn, whose marker is dropped.

Rows used for training hold one turn each, but a row to be parsed may hold a whole transcript. So a row that begins with a
speaker marker is counted twice: as the beginning of a row, and as a line inside a transcript in which the rows
before it stand too. A change of role inside a row is therefore as likely as such rows are, and announced by markers.

Conversations may be of any size: rows are laid out by range over (conversation, turn), so a long
conversation is spread over several partitions. Each partition condenses its first and last conversation
to a matrix of best scores between the state before it and the state at its end; the matrices of a
conversation that crosses partitions are chained (roles x roles numbers for each partition on the
driver), and every partition then decodes its part between the states fixed for its ends. The result
is that of one Viterbi run over the whole conversation.

Defined results: a missing conversation id is a conversation of its own; missing turns come first,
equal turns are ordered by their text; a missing text is one empty line; a row without a role is
decoded like any other but not counted; extra columns are ignored; an empty table gives no rows.
If no role is known at all, a ValueError asks for a model.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from touchline.llm.batches import shipped
from touchline.session import cut_lineage

# fixed values: speaker markers at the beginning of a line
MARKERS = {
    "user": r"user|human|customer|question|q|prompt|instruction|me",
    "assistant": r"assistant|ai|bot|agent|answer|a|response|model|gpt",
    "system": r"system|context|instructions|developer",
}
MARKED = {k: re.compile(rf"(?i)^\s*(?:[#>*\[<|]+\s*(?:im_start\|>)?)?(?:{v})\s*+(?:(?:[\])>|*]+\s*+)?[:>]|[\])>|]+)\s*") for k, v in MARKERS.items()}
NAMED = re.compile(r"^\s*[A-Z][\w .'-]{0,30}:\s")
SHORT, LONG = 40, 200
SMOOTH, MOST_ROLES = 0.5, 64
TURN = "<|im_start|>{role}\n{text}<|im_end|>\n"


def marker_of(line: str) -> str:
    for kind, pattern in MARKED.items():
        if pattern.match(line):
            return kind
    return "named" if NAMED.match(line) else "none"


def form_of(line: str) -> str:
    line = line.strip()
    if not line:
        return "blank"
    if line[-1] in "?？":
        return "question"
    return "short" if len(line) < SHORT else "long" if len(line) >= LONG else "middle"


def observed(text: str | None) -> list[tuple[bool, str, str]]:
    """(begins the row, marker, form) of every line."""
    return [(i == 0, marker_of(line), form_of(line)) for i, line in enumerate((text or "").split("\n"))]


KINDS = (*MARKERS, "named", "none")
FORMS = ("blank", "question", "short", "middle", "long")


class Model:
    """Log probabilities; ``step[new]`` leads from a state to the next line's state."""

    def __init__(self, counts: Counter, smooth: float = SMOOTH):
        self.roles = sorted({k[1] for k in counts if k[0] == "marker"})
        if len(self.roles) > MOST_ROLES:
            raise ValueError(f"more than {MOST_ROLES} roles")
        at = {r: i for i, r in enumerate(self.roles)}
        n = len(self.roles)

        def table(kind: str, shape: tuple, place) -> np.ndarray:
            out = np.full(shape, smooth)
            for key, count in counts.items():
                if key[0] == kind:
                    out[place(key)] += count
            return np.log(out / out.sum(-1, keepdims=True))

        self.first = table("first", (n,), lambda k: at[k[1]])
        self.step = table("step", (2, n, n), lambda k: (int(k[1]), at[k[2]], at[k[3]]))
        self.marker = table("marker", (n, 2, len(KINDS)), lambda k: (at[k[1]], int(k[2]), KINDS.index(k[3])))
        self.form = table("form", (n, 2, len(FORMS)), lambda k: (at[k[1]], int(k[2]), FORMS.index(k[3])))
        # every observation's scores by state, looked up by line
        self.seen = {
            (new, m, f): self.marker[:, int(new), i] + self.form[:, int(new), j]
            for new in (False, True) for i, m in enumerate(KINDS) for j, f in enumerate(FORMS)}

    def matrix(self, lines: Sequence[tuple]) -> np.ndarray:
        """Best score from each state before the lines to each state at their end."""
        best = np.where(np.eye(len(self.roles), dtype=bool), 0.0, -math.inf)
        for line in lines:
            best = (best[:, :, None] + self.step[int(line[0])]).max(1) + self.seen[line]
        return best

    def start(self, lines: Sequence[tuple]) -> np.ndarray:
        """Best score to each state at the end of lines that begin a conversation."""
        best = self.first + self.seen[lines[0]]
        for line in lines[1:]:
            best = (best[:, None] + self.step[int(line[0])]).max(0) + self.seen[line]
        return best

    def path(self, lines: Sequence[tuple], before: int | None = None, at_end: int | None = None) -> list[int]:
        """The best states, given the state before the lines and that of the last line, where these are fixed."""
        back = []
        best = self.first + self.seen[lines[0]] if before is None else self.step[int(lines[0][0])][before] + self.seen[lines[0]]
        for line in lines[1:]:
            options = best[:, None] + self.step[int(line[0])]
            came = options.argmax(0)
            back.append(came)
            best = options[came, np.arange(len(came))] + self.seen[line]
        states = [int(best.argmax()) if at_end is None else at_end]
        for came in reversed(back):
            states.append(int(came[states[-1]]))
        return states[::-1]


def laid_out(df: DataFrame, conversation: str, turn: str, role: str | None, text: str) -> DataFrame:
    """Rows in order of conversation and turn over ranges of partitions; a row's lines stay together."""
    spark = df.sparkSession
    said = F.col(role).cast("string") if role else F.lit(None).cast("string")
    rows = df.select(F.col(conversation).alias("conversation"), F.col(turn).alias("turn"), said.alias("given"), F.col(text).alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text", "given"), "row": F.monotonically_increasing_id()})
    order = ["conversation", "turn", "tie", "row"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return cut_lineage(ranged.withColumn("part", F.spark_partition_id()).drop("tie", "row"))


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conversation", "turn", "given", "text", "part")))


def opening(text: str | None) -> list[str]:
    """Marker and form of the first line."""
    line = (text or "").split("\n", 1)[0]
    return [marker_of(line), form_of(line)]


def follow(counts: Counter, before: str, given: str, first: Sequence[str]) -> None:
    """Count a row that follows another, also as a line inside a transcript if it announces its speaker."""
    counts["step", "1", before, given] += 1
    marker, form = first
    if marker in MARKERS:
        counts["step", "0", before, given] += 1
        counts["marker", given, "0", marker] += 1
        counts["form", given, "0", form] += 1


def counted(rows: DataFrame) -> Counter:
    """Counts of first roles, steps, markers and forms over all rows with a role."""

    def count(batches):
        counts: Counter = Counter()
        edges, last, part = [], None, None
        for conversation, _, given, text, part in _rows(batches):
            here = (conversation,)
            if last is None:
                edges.append((0, conversation, given, opening(text)))
            if given is not None:
                for new, marker, form in observed(text):
                    counts["marker", given, str(int(new)), marker] += 1
                    counts["form", given, str(int(new)), form] += 1
                    if not new:
                        counts["step", "0", given, given] += 1
                if last is not None and last[0] != here:
                    counts["first", given] += 1
                elif last is not None and last[1] is not None:
                    follow(counts, last[1], given, opening(text))
            last = (here, given)
        if last is not None:
            edges.append((1, last[0][0], last[1], None))
        names = ["key", "n", "part", "side", "conversation", "given", "opening"]
        out = [dict(zip(names, (list(k), n, None, None, None, None, None))) for k, n in counts.items()]
        out += [dict(zip(names, (None, None, part, *edge))) for edge in edges]
        yield pa.RecordBatch.from_pylist(out, schema)

    kind = rows.schema["conversation"].dataType
    schema = pa.schema([("key", pa.list_(pa.string())), ("n", pa.int64()), ("part", pa.int32()), ("side", pa.int32()),
                        ("conversation", to_arrow_type(kind)), ("given", pa.string()), ("opening", pa.list_(pa.string()))])
    made = cut_lineage(rows.mapInArrow(
        count, f"key array<string>, n long, part int, side int, conversation {kind.simpleString()}, given string, opening array<string>"))
    total = made.where("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n")).collect()
    counts = Counter({tuple(r["key"]): r["n"] for r in total})
    # what lies between partitions: one first and one last row of each
    before = None
    for edge in made.where("key IS NULL").orderBy("part", "side").collect():
        if edge["side"] == 0 and edge["given"] is not None:
            if before is None or before["conversation"] != edge["conversation"]:
                counts["first", edge["given"]] += 1
            elif before["given"] is not None:
                follow(counts, before["given"], edge["given"], edge["opening"])
        before = edge
    return counts


def fitted(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", smooth: float = SMOOTH) -> Model:
    return Model(counted(laid_out(df, conversation, turn, role, text)), smooth)


def _fixed(rows: DataFrame, model: Model) -> dict[tuple[int, int], tuple[int | None, int]]:
    """(state before, state at the end) of the first (0) and last (1) conversations of partitions, for
    conversations that lie in several partitions."""
    shared = shipped(rows.sparkSession, model)

    def condense(batches):
        ends, made = [], shared.value
        for conversation, group in groupby(_rows(batches), key=lambda r: (r[0],)):
            lines, part = [], None
            for _, _, _, text, part in group:
                lines += observed(text)
            ends = [*ends[:1], (part, conversation[0], lines)]  # those between begin and end here
        out = [{"part": p, "no": i, "conversation": c, "matrix": made.matrix(ls).ravel().tolist(), "start": made.start(ls).tolist()}
               for i, (p, c, ls) in enumerate(ends)]
        yield pa.RecordBatch.from_pylist(out, schema)

    kind = rows.schema["conversation"].dataType
    numbers = pa.list_(pa.float64())
    schema = pa.schema([("part", pa.int32()), ("no", pa.int32()), ("conversation", to_arrow_type(kind)), ("matrix", numbers), ("start", numbers)])
    made = cut_lineage(rows.mapInArrow(condense, f"part int, no int, conversation {kind.simpleString()}, matrix array<double>, start array<double>"))
    # only conversations that cross a border need their matrices chained
    wide = made.groupBy(F.col("conversation").alias("crossing")).agg(F.count_distinct("part").alias("parts")).where("parts > 1")
    made = made.join(wide, F.col("conversation").eqNullSafe(F.col("crossing")), "left_semi")
    size, fixed = len(model.roles), {}
    for _, group in groupby(made.orderBy("part", "no").collect(), key=lambda s: (s["conversation"],)):
        chain = list(group)
        if len(chain) < 2:
            continue
        best, back = np.array(chain[0]["start"]), []
        for segment in chain[1:]:
            options = best[:, None] + np.array(segment["matrix"]).reshape(size, size)
            back.append(options.argmax(0))
            best = options.max(0)
        state = int(best.argmax())
        for segment, came in zip(reversed(chain[1:]), reversed(back)):
            fixed[segment["part"], segment["no"]] = (int(came[state]), state)
            state = int(came[state])
        fixed[chain[0]["part"], chain[0]["no"]] = (None, state)
    return fixed


def turns_of(text: str | None, states: Sequence[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of runs of lines with one role; a marker that begins a run is dropped."""
    for role, run in groupby(zip((text or "").split("\n"), states), key=lambda pair: pair[1]):
        first, *rest = [line for line, _ in run]
        marker = next((m for m in map(lambda p: p.match(first), MARKED.values()) if m), None)
        yield role, "\n".join([first[marker.end():] if marker else first, *rest])


def recovered(df: DataFrame, model: Model | None = None, conversation: str = "conv_id", turn: str = "turn", role: str | None = "role", text: str = "text") -> DataFrame:
    """(conversation, turn, piece, given, role, text, rendered) for each recovered turn.

    Without a model it is fitted on the rows of ``df`` whose role is known.
    """
    rows = laid_out(df, conversation, turn, role, text)
    types = {n: rows.schema[n].dataType for n in ("conversation", "turn")}
    kind = (f"`{conversation}` {types['conversation'].simpleString()}, `{turn}` {types['turn'].simpleString()}, "
            "piece int, given string, role string, text string, rendered string")
    if model is None:
        counts = counted(rows)
        if not counts:
            if rows.isEmpty():
                return df.sparkSession.createDataFrame([], kind)
            raise ValueError("no row has a role: give a model")
        model = Model(counts)
    fixed = _fixed(rows, model)
    shared = shipped(rows.sparkSession, (model, fixed))
    schema = pa.schema([(conversation, to_arrow_type(types["conversation"])), (turn, to_arrow_type(types["turn"])), ("piece", pa.int32()),
                        *[(n, pa.string()) for n in ("given", "role", "text", "rendered")]])

    def decode(batches):
        made, known = shared.value

        def solved(group, no):
            lines = [observed(text) for _, _, _, text, _ in group]
            states = iter(made.path([x for ls in lines for x in ls], *known.get((group[0][4], no), (None, None))))
            for (conversation_id, turn_id, given, text_, _), own in zip(group, lines):
                roles = [made.roles[next(states)] for _ in own]
                for piece, (said, content) in enumerate(turns_of(text_, roles)):
                    yield conversation_id, turn_id, piece, given, said, content, TURN.format(role=said, text=content)

        def every():
            held, no = None, 0
            for _, group in groupby(_rows(batches), key=lambda r: (r[0],)):
                if held is not None:  # the first has number 0, the last 1, those between lie here whole
                    yield from solved(held, 2 if no else 0)
                    no = 1
                held = list(group)
            if held is not None:
                yield from solved(held, no)

        block = []
        for row in every():
            block.append(row)
            if len(block) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)
                block = []
        if block:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)

    return rows.mapInArrow(decode, kind)
