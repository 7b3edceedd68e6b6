"""Token counts, near copies, quality rules and decontamination against brute force."""
from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from touchline.llm import decontamination, near_copies, quality_rules, token_counts
from touchline.llm.text_queries import tokenizer_text

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, schema=SCHEMA):
    rows = [(i, t, "en", "s", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


# --- token counts ---------------------------------------------------------------------------

PARTS = ["a", "b", "'", "'s", "'ll", "'re", " ", "  ", "\n", "\n\n", "\t", "é", "日本", "😀", "1", "²", "½", "..", "!!", "the",
         " the", "hello", "====", " ", "　", "_", "<|endoftext|>", "<|endof", "I'm", "\r\n", "\x85", "\x1c", "ﬀ", "Ⅷ", "́"]


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(tokenizer_text())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def prefix_counts(library, text):
    return [len(library.encode(text[:i], add_special_tokens=False)) for i in range(1, len(text) + 1)]


def test_every_prefix_has_the_count_of_the_library(counter, library):
    draw = random.Random(1)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))) for _ in range(1500)]
    counter.learn(texts[::2])
    for text in texts:
        assert np.cumsum(counter.differences(text), dtype=int).tolist() == prefix_counts(library, text), repr(text)


def test_words_of_many_letters(counter, library):
    draw = random.Random(2)
    texts = [" ".join("".join(draw.choice("theraino") for _ in range(draw.randint(1, 30))) for _ in range(6)) for _ in range(60)]
    counter.learn(texts)
    for text in texts + ["a" * 3000, "=" * 700, " " * 300 + "x", "é" * 500]:
        assert int(counter.differences(text).sum(dtype=int)) == len(library.encode(text, add_special_tokens=False))
    for text in texts[:10] + ["=" * 150]:
        assert np.cumsum(counter.differences(text), dtype=int).tolist() == prefix_counts(library, text)


def test_tables_answer_budgets(spark, library):
    texts = [None, "", "one two three", "one two three", "x" * 50_000 + " end", "tail  \n "]
    df = docs(spark, texts).selectExpr("doc_id", "text", "'clash' as n_tokens", "'clash' as n_bytes")
    rows = {r["doc_id"]: r for r in token_counts.prefix_tables(df, tokenizer_text(), limits=(2, 5)).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        row = rows[i]
        assert row["n_bytes"] == len(text.encode()) and row["n_tokens"] == len(library.encode(text, add_special_tokens=False))
        if len(text) < 100:
            counts = [0] + prefix_counts(library, text)
            for limit in (2, 5):
                longest = max(k for k, c in enumerate(counts) if c <= limit)
                assert row[f"cut_{limit}"] == longest == token_counts.cut_for(bytes(row["prefix_tokens"]), limit)
            assert [token_counts.tokens_at(bytes(row["prefix_tokens"]), k) for k in range(len(text) + 1)] == counts
    assert token_counts.prefix_tables(df.limit(0), tokenizer_text()).count() == 0


# --- near copies ----------------------------------------------------------------------------


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, distance=3):
    """Component of each position by comparing all pairs."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(prints))]


def varied(draw, n):
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 6)))
    texts = []
    for _ in range(n):
        words = [word() for _ in range(draw.choice([40, 200, 500]))]
        texts.append(" ".join(words))
        for _ in range(draw.randint(0, 4)):
            copy = list(words)
            copy[draw.randrange(len(copy))] = word()
            texts.append(draw.choice([" ", "\n"]).join(copy))
    return texts


def test_fingerprints():
    for text in [None, "", " \n ", "One", "one TWO", "Ä b C d", "a b c d e f", "x\x0by\x0cz w", "a b c"]:
        assert near_copies.simhash(text) % (1 << 64) == plain_print(text)
    long = " ".join(str(i % 7919) for i in range(200_000))
    assert near_copies.simhash(long) % (1 << 64) == plain_print(long)


@pytest.mark.parametrize("members", [20_000, 12])
def test_near_copies_match_all_pairs(spark, members):
    texts = varied(random.Random(5), 25) + [None, "", "  ", "same text here now"] + ["same text here now"] * 30
    prints = [plain_print(t) for t in texts]
    want = plain_classes(prints)
    assert len(set(want)) < len(set(prints))
    df = docs(spark, texts).selectExpr("*", "1 as fingerprint", "2 as first")
    got = {r["doc_id"]: r for r in near_copies.near_copies(df, members=members).collect()}
    assert [int(got[i]["fingerprint"], 16) for i in range(len(texts))] == prints
    assert [got[i]["component_id"] for i in range(len(texts))] == want


def test_balls_find_every_close_pair(spark):
    draw = random.Random(9)
    prints = set()
    for _ in range(30):
        start = draw.getrandbits(64)
        prints.add(start)
        for _ in range(draw.randint(0, 12)):  # chains whose steps are 1 to 4 bits
            for b in draw.sample(range(64), draw.randint(1, 4)):
                start ^= 1 << b
            prints.add(start)
    prints |= {1 << b for b in range(64)} | {0, (1 << 64) - 1, (1 << 64) - 2}
    prints = sorted(prints)
    want = plain_classes(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id long, fingerprint long")
    for members in (20_000, 60):
        led = near_copies.classes(df, "doc_id", members).collect()
        groups = {}
        for row in led:
            groups.setdefault(row["root"], []).append(row["first"])
        got = {i: min(g) for g in groups.values() for i in g}
        assert [got[i] for i in range(len(prints))] == want


def test_one_document_of_each_class_stays(spark):
    texts = varied(random.Random(6), 10) + [None, "", "b c d e"] + ["b c d e"] * 5
    want = plain_classes([plain_print(t) for t in texts])
    df = docs(spark, texts)
    again = df.union(df.where("doc_id in (0, 3)"))
    lost = spark.createDataFrame([(None, "b c d e", "en", "s", 7), (None, "only here x y", "en", "s", 13), (None, "only here x y", "en", "s", 13)], SCHEMA)
    kept = near_copies.without_copies(again.union(lost)).collect()
    named = sorted(r["doc_id"] for r in kept if r["doc_id"] is not None)
    assert named == sorted(set(want))
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["only here x y"]
    assert near_copies.near_copies(df.limit(0)).count() == 0


# --- quality rules --------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_match_plain_ones(monkeypatch):
    draw = random.Random(3)
    texts = [None, "", "\n\n", "a b c a b c a b", "x\x0by é # |", "L1\nL1\n \nL1 \nL2\x0c\nL2\x0c"]
    texts += ["".join(draw.choice(["a ", "b ", "c\n", "## ", "É\t", "AB "]) for _ in range(draw.randint(1, 60))) for _ in range(150)]
    for many in (100_000, 5):
        monkeypatch.setattr(quality_rules, "MANY_WORDS", many)
        for text in texts:
            assert quality_rules.measured(text)[:5] == plain_counts(text), repr(text)


def test_binomial_bounds_are_exact():
    from math import comb

    for n in (1, 7, 40):
        for k in range(n + 1):
            for p in (0.005, 0.3, 0.9):
                exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
                assert quality_rules.binomial_tail(k, n, p) == pytest.approx(exact, abs=1e-12)
    bound = quality_rules.upper_bound(3, 500, 0.01)
    assert quality_rules.binomial_tail(3, 500, bound) == pytest.approx(0.01, abs=1e-6)
    assert quality_rules.upper_bound(0, 1000, 0.05) == pytest.approx(1 - 0.05 ** (1 / 1000), abs=1e-8)


def test_cutoffs_keep_their_limit_and_catch_junk(spark):
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(9000):
        bad = i % 5 == 0
        text = " ".join("w%d" % draw.randrange(10_000) + ("##" if bad else "") for _ in range(60))
        if not bad and draw.random() < 0.002:
            text += " #" * 30
        rows.append((i, text, "xx" if i < 8500 else None, "s", len(text)))
        labels.append((i, 0 if bad else 1, 0))
    df = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0), (10**9, 1, 0)], "doc_id long, quality int, toxic int")
    counted = quality_rules.measures(df, ["doc_id", "lang"])
    chosen = quality_rules.cutoffs(counted, marks).collect()
    assert all(c["bound"] <= quality_rules.RISK for c in chosen)
    assert {c["stratum"] for c in chosen} == {"xx"}  # too few labels without a language
    kept = {r["doc_id"] for r in quality_rules.kept_documents(df, marks).collect()}
    good = {i for i, q, _ in labels if q == 1}
    assert len(good - kept) <= 0.005 * 4 * len(good)
    assert not {i for i in kept if i % 5 == 0 and i < 8500}
    assert kept >= {i for i in good if i >= 8500}
    assert quality_rules.kept_documents(df.limit(0), marks).count() == 0
    assert quality_rules.kept_documents(df, marks.limit(0)).count() == 9000


# --- decontamination ------------------------------------------------------------------------


def plain_verdicts(texts, items, width=13):
    def words(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    out = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            v = words(item)
            size = min(width, len(v))
            for i in range(len(v) - size + 1 if v else 0):
                for j in range(len(w) - size + 1):
                    if w[j:j + size] == v[i:i + size]:
                        hit.update(range(j, j + size))
                        names.add(name)
        names = sorted(str(n) for n in names - {None})
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w), sorted(hit)))
    return out


def contaminated(seed=7):
    draw = random.Random(seed)
    word = lambda: draw.choice(["The", "of", "ünd", "x1", "Alpha", "beta", "c", "d", "é"])
    items = [(i, " ".join(word() for _ in range(draw.choice([2, 5, 13, 20, 40])))) for i in range(12)]
    items += [(None, "Alpha Alpha Alpha beta"), (20, None), (21, "..."), (3, items[3][1])]
    texts = [None, "", "!!!", "Alpha, alpha;ALPHA-beta tail"]
    for _ in range(60):
        body = [word() + draw.choice(["", ".", ",\n"]) for _ in range(draw.randint(0, 80))]
        if draw.random() < 0.6:
            at = draw.randint(0, len(body))
            body[at:at] = [w.upper() for w in (draw.choice(items)[1] or "").split()]
        texts.append(" ".join(body))
    return texts, items


@pytest.mark.parametrize("most", [decontamination.MOST_WINDOWS, 120])
def test_verdicts_match_plain_search(spark, most):
    texts, items = contaminated()
    want = plain_verdicts(texts, items)
    df = docs(spark, texts).selectExpr("*", "7 as hits", "8 as block")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.verdicts(df, benchmark, most=most).collect()}
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert [tuple(got[i][n] for n in names) for i in range(len(texts))] == [w[:5] for w in want]
    kept = {r["doc_id"] for r in decontamination.clean_documents(df, benchmark, most=most).collect()}
    assert kept == {i for i, w in enumerate(want) if not w[4]}
    assert decontamination.verdicts(df, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.clean_documents(df.limit(0), benchmark).count() == 0


def test_spans_are_cut_out(spark):
    item = " ".join(f"q{i}" for i in range(13))
    texts = ["Before, " + item.upper() + "! After.", "nothing", None, item]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r["doc_id"]: r["text"] for r in decontamination.cut_spans(docs(spark, texts), benchmark).collect()}
    assert out == {0: "Before, ! After.", 1: "nothing", 2: None, 3: ""}
