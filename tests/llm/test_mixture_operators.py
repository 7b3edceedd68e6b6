"""Source mixing, fill-in-middle frames and vector codes against brute force and round trips."""
from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
import zstandard

from touchline.llm import fill_middle, mixing, vector_codes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


# --- mixing ---------------------------------------------------------------------------------


def shared(sizes, weights, total, most):
    """Targets by repeated sharing, in exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        rest = total - sum(target.values())
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: Fraction(most * sizes[s]) for s in full}
        open_ -= full
    return target


def mixing_rows(draw, n):
    sources = ["b", "a", None, "é", "", "𝒳", "z"]
    rows = []
    for i in range(n):
        words = 0 if draw.random() < 0.1 else int(draw.paretovariate(0.9)) % 5000
        text = None if draw.random() < 0.05 else "\t ".join(["w"] * words)
        rows.append((None if draw.random() < 0.05 else i % (n - 5), text, "en", sources[0] if draw.random() < 0.4 else draw.choice(sources), 0))
    return rows


@pytest.mark.parametrize("part_rows", [40, 1_000_000])
def test_mix_takes_the_targets_up_to_one_document(spark, part_rows):
    rows = mixing_rows(random.Random(3), 600)
    made = mixing.mixed(spark.createDataFrame(rows, SCHEMA), part_rows=part_rows).collect()
    assert len(made) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += size(text)
        largest[source] = max(largest[source], size(text))
    targets = shared(sizes, (5, 2, 1), Fraction(3 * sum(sizes.values()), 2), 2)
    for r in made:
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(targets[r.source]), rel=1e-12)
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source] + 1
    assert sum(targets.values()) == Fraction(3 * sum(sizes.values()), 2)


def test_mix_does_not_depend_on_how_rows_are_dealt(spark):
    rows = mixing_rows(random.Random(4), 400)
    one = mixing.mixed(spark.createDataFrame(rows, SCHEMA), keep=["text"], part_rows=30)
    two = mixing.mixed(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5), keep=["text"])
    key = lambda r: tuple((x is None, x or 0) for x in (r.doc_id, r.size, r.taken)) + (str(r.source), str(r.text))
    assert sorted(map(key, one.collect())) == sorted(map(key, two.collect()))
    other = mixing.mixed(spark.createDataFrame(rows, SCHEMA), keep=["text"], seed=7)
    assert sorted(map(key, one.collect())) != sorted(map(key, other.collect()))


def test_mix_emits_each_document_as_often_as_taken(spark):
    docs = spark.createDataFrame(mixing_rows(random.Random(5), 200), SCHEMA)
    mix = mixing.mixed(docs, keep=["text", "size", "lang"])
    assert mix.columns == ["doc_id", "source", "size", "source_size", "target", "copies", "taken", "text", "lang"]
    out = mixing.emitted(mix)
    assert out.count() == sum(r.copies for r in mix.collect())
    assert {r.copy for r in out.collect()} == {1, 2}


@pytest.mark.parametrize("share, copies", [((2, 1), 2), ((9, 1), 2), ((0, 1), 0)])
def test_mix_at_its_limits(spark, share, copies):
    docs = spark.createDataFrame([(i, "a b c", "en", f"s{i % 3}", 0) for i in range(30)], SCHEMA)
    assert {r.copies for r in mixing.mixed(docs, share=share).collect()} == {copies}


def test_mix_of_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed(empty).collect() == []
    blank = spark.createDataFrame([(1, None, "en", None, 0), (1, " \n", "en", "a", 0), (None, "", "en", "a", 0)], SCHEMA)
    assert {(r.size, r.target, r.copies, r.taken) for r in mixing.mixed(blank).collect()} == {(0, 0.0, 0, 0)}
    clashing = spark.createDataFrame(
        [(1, "a b", "s", 5, 6, 7, 8)], "doc_id long, text string, source string, size long, range long, step int, id int")
    assert [(r.size, r.taken % 2) for r in mixing.mixed(clashing).collect()] == [(2, 0)]
    long = spark.createDataFrame([(1, "w " * 1_000_000, "s"), (2, "x" * 2_000_000, "s")], "doc_id long, text string, source string")
    assert {r.size for r in mixing.mixed(long).collect()} == {1, 1_000_000}


# --- fill in the middle ---------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def filled(doc_id, text):
    """(form, units, prefix, middle, output) by the definition."""
    text = text or ""
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i:8 * i + 8], 16) for i in range(4)]
    one, two = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return "plain", len(units), None, None, text
    p, m, s = "".join(units[:one]), "".join(units[one:two]), "".join(units[two:])
    if h[3] % 100 < 80:
        return "spm", len(units), len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return "psm", len(units), len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts_with_edges(draw, n):
    parts = ["a", "wort", "<", "<P", "S>", " ", "  ", "\n", "\t\x0b", "é", "日本語", "😀", " ", "\x85", "\x1f", "<<S", ">"]
    out = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(n)]
    return out + [None, "", " ", "\n\n", "x", " x", "x ", "a <P> b", "<M>", "<S", "é" * 400, " " * 400, "x" * 400]


@pytest.mark.parametrize("frame_bytes", [1, 3, 16, 1 << 15])
def test_fill_middle_by_its_definition(spark, frame_bytes):
    texts = texts_with_edges(random.Random(frame_bytes), 250)
    rows = [(None if i == 7 else i, t) for i, t in enumerate(texts)] + [(3, "again the same id")]
    store = fill_middle.stored(spark.createDataFrame(rows, "doc_id long, text string"), frame_bytes=frame_bytes)
    made = fill_middle.transformed(store, frames=True).collect()
    assert len(made) == len(rows)
    found = sorted(
        ((r.doc_id is None, r.doc_id or 0), r.form, r.n, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in made)
    want = []
    for doc_id, text in rows:
        form, n, p, m, output = filled(doc_id, text)
        want.append(((doc_id is None, doc_id or 0), form, n, p, m, hexed(output), hexed(text or "")))
    assert found == sorted(want)
    assert {w[1] for w in want} == {"plain", "spm", "psm"}
    for r in made:  # the output is ordinary zstandard, frame after frame
        whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(r.output)
        assert hashlib.sha256(whole).hexdigest() == r.output_sha256


def test_frames_are_independent_and_indexed():
    maker = fill_middle.Frames(7)
    for text in texts_with_edges(random.Random(9), 200):
        data = (text or "").encode()
        n, frames = maker.stored(data)
        assert n == len(UNIT.findall(text or ""))
        assert b"".join(zstandard.ZstdDecompressor().decompress(f[0]) for f in frames) == data
        rows = [dict(zip(fill_middle.FRAME.names, f)) for f in frames]
        ends = list(itertools.accumulate(len(u) for u in UNIT.findall(text or "")))
        for units in range(1, n):
            at, byte, chars = maker.place(rows, units)
            assert chars == ends[units - 1] and at * 7 + byte == len((text or "")[:chars].encode())


def test_only_cut_frames_are_opened():
    maker = fill_middle.Frames(64)
    n, frames = maker.stored(("word " * 5000).encode())
    rows = [dict(zip(fill_middle.FRAME.names, f)) for f in frames]
    opened = []
    plain = maker.unpack
    maker.unpack = lambda data: opened.append(1) or plain(data)
    out, _ = maker.arranged(rows, n, "psm", (1000, 4000))
    assert len(opened) <= 6 and len(out) >= len(frames)


def test_fill_middle_of_odd_tables(spark):
    assert fill_middle.transformed(fill_middle.written(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
    clashing = spark.createDataFrame([(5, "a b c", 1, "x", 2)], "doc_id long, text string, n int, form string, frames int")
    row = fill_middle.transformed(fill_middle.written(clashing)).first()
    assert (row.form, row.n, row.output_sha256) == (filled(5, "a b c")[0], 3, hexed(filled(5, "a b c")[4]))
    long = [(i, t) for i, t in enumerate(["wort é " * 300_000, "x" * 3_000_000, "\n" * 1_000_000, " a" * 500_000])]
    made = fill_middle.transformed(fill_middle.written(spark.createDataFrame(long, "doc_id long, text string"))).collect()
    assert {r.doc_id: (r.n, r.output_sha256) for r in made} == {i: (filled(i, t)[1], hexed(filled(i, t)[4])) for i, t in long}


# --- vector codes ---------------------------------------------------------------------------


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Codes, errors and codebooks in Python's whole numbers."""
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in rows]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[cut[k][p] for k in range(min(entries, len(kept)))] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min(range(len(book)), key=lambda e: (away(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for v in cut:
                groups[near(v[p], books[p])].append(v[p])
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else entry for e, entry in enumerate(books[p])]
    out = {}
    for (i, _), v in zip(kept, cut):
        code = [near(v[p], books[p]) for p in range(parts)]
        out[i] = "".join(f"{c:02x}" for c in code), sum(away(v[p], books[p][c]) for p, c in enumerate(code))
    return out, books


VECTORS = "vec_id long, embedding array<double>, label int"


def test_exact_products_of_any_size():
    draw = np.random.default_rng(1)
    for bits, others in ((3, 3), (12, 12), (25, 25), (29, 29), (40, 18), (58, 1), (1, 58)):
        a, b = draw.integers(-(2**bits), 2**bits, (37, 8)), draw.integers(-(2**others), 2**others, (9, 8))
        want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b] for r in a]
        assert vector_codes.dots(a, b).tolist() == want
    for width in (1, 5, 26):
        a = draw.integers(-(2**40), 2**40, (5, 4))
        parts = vector_codes.limbs(a, width)
        assert (sum(p.astype(np.int64) << (width * i) for i, p in enumerate(parts)) == a).all()
        assert all(np.abs(p).max() < 2**width for p in parts)


@pytest.mark.parametrize("spread", [0.3, 40.0, 10_000.0])
def test_codes_by_their_definition(spark, spread):
    draw = random.Random(int(spread))
    rows = [(i * 3 + 1, [draw.gauss(0, spread) for _ in range(24)]) for i in range(120)]
    rows += [(1000 + i, rows[i % 4][1]) for i in range(60)]  # many equal vectors
    table = spark.createDataFrame([(i, v, None if i % 7 == 0 else i % 3) for i, v in rows], VECTORS).repartition(6)
    codes, books = vector_codes.compressed(table)
    want, want_books = brute_codes(rows)
    made = vector_codes.with_label_errors(codes).collect()
    assert {r.id: (r.code, r.error) for r in made} == want
    assert [b.tolist() for b in books] == want_books
    sums = defaultdict(int)
    for r in made:
        sums[r.label] += r.error
    assert all(r.label_error == sums[r.label] for r in made) and None in sums


def test_codes_of_odd_rows(spark):
    draw = random.Random(8)
    good = [(i, [round(draw.uniform(-1, 1), 1) for _ in range(8)]) for i in range(12)]
    bad = [(50, None), (51, []), (52, [1.0] * 7 + [None]), (53, [float("nan")] * 8), (54, [float("inf")] + [0.0] * 7), (55, [1.0] * 16)]
    table = spark.createDataFrame([(i, v, 1) for i, v in [*good, *bad]], VECTORS)
    codes, books = vector_codes.compressed(table)
    want, _ = brute_codes(good)
    assert {r.id: (r.code, r.error) for r in codes.collect()} == want
    assert [len(b) for b in books] == [12] * 8 and all(r.error == 0 for r in codes.collect())
    back = {r.id: r.vector for r in vector_codes.decoded(codes, books).collect()}
    assert all(abs(x - y) <= 1 / 4096 for i, v in good for x, y in zip(v, back[i]))
    twice = spark.createDataFrame([(None if i % 2 else 4, v, None) for i, v in good + good], VECTORS)
    assert vector_codes.compressed(twice)[0].count() == 24
    empty, none = vector_codes.compressed(spark.createDataFrame([], VECTORS))
    assert vector_codes.with_label_errors(empty).collect() == [] and none == []
    clashing = spark.createDataFrame([(1, [0.5] * 8, 2, "x", 3)], VECTORS + ", code string, cells int")
    assert [(r.id, r.code, r.error) for r in vector_codes.compressed(clashing)[0].collect()] == [(1, "00" * 8, 0)]


def test_vectors_that_cannot_be_coded(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compressed(spark.createDataFrame([(1, [0.5] * 9, 2)], VECTORS))
    with pytest.raises(ValueError, match="too large"):
        vector_codes.compressed(spark.createDataFrame([(1, [1e30] * 8, 2)], VECTORS))
