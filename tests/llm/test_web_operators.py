"""Personal data, URL filters and archives against plain versions."""
from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from touchline.llm import personal_data, url_rules, warc
from touchline.llm.web_queries import RULES

# --- personal data --------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - (9 if d > 4 else 0) for i, d in enumerate(int(c) for c in reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "", re.ASCII) if passes(k, m.group())]


def spans(df):
    return {r["doc_id"]: r for r in personal_data.personal_data(df).select(
        "doc_id", personal_data.listed(F.col("base")).alias("base"), personal_data.listed(F.col("every")).alias("every"), "n_email").collect()}


def test_base_spans_match_plain_patterns(spark):
    draw = random.Random(1)
    parts = ["a@b.c", "x.y+z@mail-1.example.com", "@", ".", "a@b", "1.2.3.4", "256.1.1.1", "1.2.3", "0010.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "4111111111111111", " ", " ", "-", "+1 (017) 555-7713", "+4", "+44 20 7946 0958", "(", "é", "😀", "\n", "12", "3", "_", "5500005555555559 "]
    texts = [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "😀 a@b.cc", "+1+1+12345678", "0" * 40]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(1, 12))) for _ in range(600)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, row int, tokens string")
    got = spans(df)
    for i, text in enumerate(texts):
        want = plain_spans(text)
        assert got[i]["base"].split(",") == (want or [""]), repr(text)
        assert got[i]["n_email"] == sum(w.startswith("email") for w in want)


def test_long_texts_take_linear_time(spark):
    texts = ["a" * 200_000 + "@", "1." * 100_000, "a@b" + ".c" * 50_000, "1 " * 50_000, "+" * 100_000, "x@" * 50_000, "+1" + "(" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = spans(df)
    assert got[2]["base"] == f"email:0:{len(texts[2])}"
    assert got[0]["base"] == ""


def test_contexts_discover_unseen_identifiers(spark):
    draw = random.Random(2)
    texts = []
    for i in range(12):
        texts.append(f"reach us now, please call +1 ({100 + i}) 555-{1000 + i} between noon and six {i}")
    texts += ["please call 0171-555-1234 between friends", "we sold 0171-555-9999 pieces of them", "please call nobody", None]
    texts += [f"order {draw.randrange(10**6)} came in today" for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = spans(df)
    start = texts[12].index("0171")
    assert got[12]["every"] == f"phone:{start}:{start + 13}" and got[12]["base"] == ""
    assert all(got[i]["every"] == got[i]["base"] for i in range(len(texts)) if i != 12)
    assert personal_data.personal_data(df.limit(0)).count() == 0


@pytest.mark.parametrize("seeds, unseen, wrong, met", [(3, 1, 0, True), (3, 300, 0, True), (2, 5, 0, False), (4, 40, 1, True), (3, 40, 1, False)])
def test_few_seeds_discover_many_identifiers(spark, seeds, unseen, wrong, met):
    texts = [f"we say please call +1 ({100 + i}) 555-{1000 + i} then wait{'x' * i}" for i in range(seeds)]
    texts += [f"we say please call 0171-555-{1000 + i} or so{'x' * i}" for i in range(unseen)]
    texts += [f"we say please call room{i}5 at once" for i in range(wrong)]
    got = spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    start = texts[0].index("+")
    for i in range(len(texts)):
        own = f"phone:{start}:{start + 13}" if met and seeds <= i < seeds + unseen else got[i]["base"]
        assert got[i]["every"] == own


def test_accepted_identifiers_make_new_patterns(spark):
    texts = [f"please call +1 ({100 + i}) 555-{1000 + i} at {'x' * (i + 1)} y" for i in range(3)]
    texts += [f"please call 0171-555-{1000 + i} for more news" for i in range(3)]  # accepted; they make "> for more"
    texts += ["he has 0171-555-7777 for more news", "he has 0171-555-8888 for less news"]
    got = spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [got[i]["every"] for i in range(3, 8)] == ["phone:12:25"] * 3 + ["phone:7:20", ""]


def test_punctuation_groups_and_digits_in_contexts(spark):
    seeds = [f"now tel 2: +1 ({100 + i}) 555-{1000 + i}, thanks a lot{'x' * i}" for i in range(3)]
    forms = {
        "0171-555-1234": "now tel 2: 0171-555-1234, thanks b", "0171 555 1234": "now tel 2: 0171 555 1234 is it", "0171 555-1235": "now tel 7: 0171 555-1235.",
        "(0171) 555 1236": "now tel 2: (0171) 555 1236", "0171-555-1237": "now tel 2: (0171-555-1237)!", "0171-555-1238": 'now tel 2: 0171-555-1238" 0171-555-1239',
        "(0171)555-1240": "now tel 2: (0171)555-1240;"}
    other = ["we sold 0171 555 1234 pieces", "tel", "now tel x: 0171 555 1241 ok"]
    texts = [*seeds, *forms.values(), *other]
    got = spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for i, (value, text) in enumerate(forms.items(), 3):
        start = text.index(value)
        assert got[i]["every"] == f"phone:{start}:{start + len(value)}", text
    assert all(got[i]["every"] == "" for i in range(10, 13))


def test_spaced_short_cards(spark):
    cards = ["4111 1111 1111 1111", "5500 0055 5555 5559", "4012 8888 8888 1881"]
    texts = [f"paid by card {c} on that day" for c in cards] + ["paid by card 3782 822463 10005 on friday"]
    got = spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [got[i]["every"] for i in range(4)] == ["card:13:32"] * 3 + ["card:13:30"]


# --- URL filters ----------------------------------------------------------------------------


def plain_rule(host, path):
    fit = [(len(r), v, r) for v, r in RULES for name, rest in [r.split("/", 1)]
           if (host == name or host.endswith("." + name)) and path.startswith("/" + rest)]
    return max(fit)[1:] if fit else (None, None)


def test_given_rules(spark):
    urls = [None, "", "no scheme.net/", "http://a.net", "http://a.net/", "HTTP://WWW.Example.NET/en/x?q=1#t", "https://example.com/de/", "https://badexample.com/de/",
            "x://y://z.net/a", "http://é.org/fr/ä?b", "http://org/fr/", "http://a.org/fr", "http://a.net?x=/", "http://A.NET#/", "://net/", "http://a\n.net/b"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'c' as host", "'d' as tokens")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r["page_id"]: r for r in url_rules.judged(df, labels, RULES).collect()}
    for i, url in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
        path = m[2] if m else ""
        verdict, rule = plain_rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict or "allow")
    assert url_rules.judged(df.limit(0), labels, RULES).count() == 0


def plain_mined(rows, least, confidence):
    """Rules by counting every combination of tokens, then the pruning."""
    often = {}
    for tokens, bad in rows:
        for k in range(1, len(tokens) + 1):
            for some in combinations(sorted(tokens), k):
                n = often.setdefault(some, [0, 0])
                n[0] += 1
                n[1] += bad
    total = len(rows)
    rules = {s: (b / n, n) for s, (n, b) in often.items() if b / total >= least and b / n >= confidence}
    return {s: v for s, v in rules.items() if not any(t in rules and rules[t][0] >= v[0] for t in combinations(s, len(s) - 1))}


def test_mined_rules_match_all_combinations(spark):
    draw = random.Random(3)
    rows = []
    for _ in range(400):
        tokens = [t for t in ("h:a", "h:spam", "p:x", "p:buy", "q:r") if draw.random() < 0.5]
        rows.append((tokens, draw.random() < (0.95 if {"h:spam", "p:buy"} <= set(tokens) else 0.15)))
    df = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    got = {tuple(sorted(r["tokens"])): (r["confidence"], r["n"]) for r in url_rules.mined(df, "tokens", "bad", 0.02, 5, 0.6).collect()}
    want = plain_mined(rows, 0.02, 0.6)
    assert got.keys() == want.keys() and want
    for key, (confidence, n) in got.items():
        assert confidence == pytest.approx(want[key][0]) and n == want[key][1]


def test_mined_rules_block(spark):
    draw = random.Random(4)
    pages = [(i, f"http://{'spam' if i % 10 == 0 else 'host' + str(draw.randrange(5))}.example.com/{draw.choice(['buy', 'read'])}/{i}") for i in range(1000)]
    labels = [(i, 0 if i % 10 == 0 and "buy" in u else 1) for i, u in pages if i < 800] + [(None, 0), (5, None)]
    df = spark.createDataFrame([*pages, (None, "http://spam.x.org/buy/"), pages[0]], "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = url_rules.judged(df, marks, RULES).collect()
    assert len(got) == 1002
    for row in got:
        bad = row["host"].startswith("spam") and "/buy/" in row["path"]
        assert (row["verdict"] == "block") == bad


def test_tokens_that_go_together_are_one(spark):
    """Forty tokens in the same labelled urls: 2^40 combinations if they were mined apart."""
    fixed = "/".join(f"part{i}" for i in range(40))
    pages = [(i, f"http://a.shop.example/{fixed}/{i}" if i % 4 == 0 else f"http://b.example/{'news' if i % 2 else 'item'}/{i}") for i in range(400)]
    labels = [(i, 0 if i % 4 == 0 else 1) for i in range(300)]
    more = [(1000, "http://x/part7/z"), (1001, "http://x/part8x/z"), (1002, "http://shop.org/"), (1003, "http://b.example/" + "y/" * 20_000)]
    got = url_rules.judged(spark.createDataFrame([*pages, *more], "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int"), ())
    blocked = {r["page_id"] for r in got.where("verdict = 'block'").collect()}
    assert blocked == {i for i in range(400) if i % 4 == 0} | {1000, 1002}


def test_verdicts_match_all_combinations(spark):
    """Tokens drawn together into classes give the verdicts of rules on single tokens."""
    draw = random.Random(8)
    together = {"a": "a/a2", "b": "b", "spam": "spam/spam2/spam3", "buy": "buy/buy2", "c": "c"}
    made = []
    for _ in range(500):
        some = [t for t in together if draw.random() < 0.5]
        made.append(("http://h/" + "/".join(together[t] for t in some), draw.random() < (0.95 if {"spam", "buy"} <= set(some) else 0.1)))
    others = ["http://h/" + "/".join(draw.sample(["a", "a2", "b", "spam", "spam2", "spam3", "buy", "buy2", "c", "other"], draw.randint(0, 6))) for _ in range(300)]
    urls = [u for u, _ in made] + others
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if bad else 1) for i, (_, bad) in enumerate(made)], "doc_id long, quality int")
    got = {r["page_id"]: r["verdict"] for r in url_rules.judged(df, labels, (), support=0.02, support_rows=5, confidence=0.6).collect()}
    cut = lambda u: {"h:h"} | {"p:" + t for t in u.removeprefix("http://h/").split("/") if t}
    rules = plain_mined([(cut(u), bad) for u, bad in made], 0.02, 0.6)
    assert rules
    for i, url in enumerate(urls):
        assert (got[i] == "block") == any(set(r) <= cut(url) for r in rules), url


# --- archives -------------------------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    odd = "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n😀"
    pages = [(1, "http://a/", "<p>é</p>"), (2, None, None), (3, "http://b/ c\r\nd", odd), (4, "u", ""), (5, "http://a/2", "<p>é</p>"), (0, "z", odd),
             (7, "big", "0123456789" * 300_000), (8, "big2", "0123456789" * 300_000), (8, "big2", "0123456789" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'c' as payload", "1 as original")
    path = str(tmp_path / "a")
    warc.write_archives(df, path)
    got = sorted(tuple(r) for r in warc.resolved(spark, path).collect() for r in [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])])
    first = {}
    for i, _, html in sorted(pages, key=lambda p: p[0]):
        first.setdefault(html or "", i)
    want = []
    for i, _, html in pages:
        body = (html or "").encode()
        original = first[html or ""]
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if i == original else "revisit", None if i == original else original))
    assert got == sorted(want)
    bodies = {r["page"]: bytes(r["payload"]) for r in warc.read_archives(spark, path, payloads=True).where("record_type = 'response'").collect()}
    assert bodies == {str(i): h.encode() for h, i in first.items()}
    assert sum(len(b) for b in bodies.values()) < sum(len(h or "") for _, _, h in pages)


def test_archives_follow_the_format(spark, tmp_path):
    path = str(tmp_path / "b")
    warc.write_archives(spark.createDataFrame([(1, "http://a/", "one"), (2, "http://b/", "one")], "page_id long, url string, html string").coalesce(1), path)
    data = b"".join(gzip.open(p).read() for p in sorted(tmp_path.glob("b/part-*")))
    blocks = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        size = int(fields[b"Content-Length"])
        blocks.append((fields[b"WARC-Type"], rest[:size]))
        assert head.startswith(b"WARC/1.1\r\n") and rest[size:size + 4] == b"\r\n\r\n"
        data = rest[size + 4:]
    assert [b[0] for b in blocks] == [b"response", b"revisit"]
    assert blocks[0][1].endswith(b"\r\n\r\none") and blocks[1][1].endswith(b"\r\n\r\n")


def test_archives_without_ids_and_small_payloads(spark, tmp_path):
    rows = [(None, "a", "same"), (None, "b", "same"), (3, "c", "x"), (4, "d", "x"), (None, "e", "longer text"), (5, "f", "longer text")]
    path = str(tmp_path / "c")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path, least_bytes=2)
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.resolved(spark, path).collect()), key=str)
    assert got == sorted([(None, 4, "response", None), (None, 4, "response", None), (3, 1, "response", None), (4, 1, "response", None),
                          (None, 11, "revisit", 5), (5, 11, "response", None)], key=str)
    empty = str(tmp_path / "d")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), empty)
    assert warc.resolved(spark, empty).count() == 0
