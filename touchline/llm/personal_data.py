"""Personal data by fixed patterns and by bootstrapped context, in DataFrame operations only.

Fixed patterns find e-mail addresses, IPv4 addresses, card and phone numbers in every whole text
(leftmost, non-overlapping for each kind; matches that fail a check are dropped without a retry).

These are the seeds of the bootstrap: the words before and after them are lexical patterns (kind, side,
words). Other tokens with digits or "@", without punctuation around them, and digit groups parted by one space or hyphen are instances that may have the same words around them. On the graph of patterns
and instances Spark iterates: a pattern's confidence is the share of right instances among these and
its instances of the wrong shape (with a prior for doubt), and an instance's score is that at least one of its
patterns is right. Instances of the right shape beside a high-confidence pattern with several different seeds
are discovered as further spans and are seeds of the next round; base spans always stay.

All regular expressions are possessive or guarded by look-behinds, so long texts take time in
proportion to their length.

Defined results: a missing text counts as empty; ids may be missing or repeat, each row is searched
on its own; extra columns are ignored; an empty table gives no rows. Offsets are code points, ends
exclusive.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
# fixed values: the patterns of the four kinds; the same matches as the plain forms, without backtracking
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# a run without white space up to its last character that is no punctuation; what stands before it is cut off afterwards
TOKEN = r"""(?<!\S)[^\s0-9@]*+[0-9@](?:[^\s"'\]}>.,;:!?*`)]++|["'\]}>.,;:!?*`)]++(?=[^\s"'\]}>.,;:!?*`)]))*+"""
LEAD = r"""^(?:["'\[{<.,;:!?*`]|\((?![0-9]++\)[^\s0-9]*+[0-9]))*+"""
# digit groups parted by one space or hyphen, none of them a part of something else
GROUPS = (
    r"(?<![0-9A-Za-z@._+-])(?<![0-9)][ -])(?:\([0-9]++\)|[0-9]++)(?![0-9A-Za-z@]|[.,/:_][0-9])"
    r"(?:[ -](?:\([0-9]++\)|[0-9]++)(?![0-9A-Za-z@]|[.,/:_][0-9]))++")
CONTEXT = 80
SEEDS, TRUST, PRIOR, CHANGE = 3, 0.8, 2.0, 0.001


def found(text: Column, pattern: str, needed: Column, lead: str | None = None) -> Column:
    """Array of (gap, value, left, right) of all matches: ``gap`` counts the code points since the match
    before; left and right are the text around it, at most CONTEXT long. What matches ``lead`` at the
    beginning of a match is left out of it."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    cut = lambda v: F.regexp_extract(v, lead, 0) if lead else F.lit("")
    around = F.zip_with(gaps, matches, lambda g, v: F.struct(
        F.concat(g, F.coalesce(cut(v), F.lit(""))).alias("gap"), F.substr(v, F.char_length(cut(v)) + 1).alias("value")))
    # gaps and values in turn; a context of CONTEXT code points reaches over 2 * CONTEXT + 1 of them at most
    reach = 2 * CONTEXT + 1
    turns = lambda all_, short: F.flatten(F.transform(all_, lambda one: F.array(
        short(one["gap"]), short(F.coalesce(one["value"], F.lit(""))))))
    before = lambda v: F.substring(v, -CONTEXT, CONTEXT)
    after = lambda v: F.substring(v, 1, CONTEXT)
    joined = lambda parts, start, n: F.array_join(F.slice(parts, start, n), "")

    def one(parts, m, i):
        here = 2 * i + 1  # the place of the gap before match i, from 1
        start = F.greatest(F.lit(1), here - reach + 1)
        return F.struct(
            F.char_length(m["gap"]).alias("gap"), m["value"].alias("value"), before(joined(parts["tails"], start, here - start + 1)).alias("left"),
            after(joined(parts["heads"], here + 2, F.lit(reach))).alias("right"))

    # bound to a variable, so that it is made once for each text and not for each match
    held = lambda value, work: F.get(F.transform(F.array(value), work), F.lit(0))
    pairs = held(around, lambda all_: held(
        F.struct(turns(all_, before).alias("tails"), turns(all_, after).alias("heads")),
        lambda parts: F.transform(F.filter(all_, lambda m: m["value"].isNotNull()), lambda m, i: one(parts, m, i))))
    none = F.array().cast("array<struct<gap:int,value:string,left:string,right:string>>")
    return F.when(needed & (F.regexp_instr(text, F.lit(pattern)) > 0), pairs).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether a number's digits pass the Luhn check."""
    back = F.reverse(digits(value))
    at = lambda i: F.substr(back, i + 1, F.lit(1)).cast("int")
    one = lambda i: F.when(i % 2 == 0, at(i)).otherwise(at(i) * 2 - F.when(at(i) > 4, 9).otherwise(0))
    total = F.aggregate(F.sequence(F.lit(0), F.char_length(back) - 1), F.lit(0), lambda s, i: s + one(i))
    return total % 10 == 0


def passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.char_length(digits(value)).between(8, 15)
    return F.lit(True)


def shaped(kind: Column, value: Column) -> Column:
    """Whether a token may be an identifier of a kind that the fixed patterns do not know."""
    n = F.char_length(digits(value))
    return (
        F.when(kind == "email", value.rlike("^[^@]+@[^@]+$"))
        .when(kind == "ip", value.rlike("^[0-9]{1,3}(?:[.:_-][0-9]{1,3}){3}$") | value.rlike("^[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}$"))
        .when(kind == "card", value.rlike("^[0-9 .-]+$") & n.between(13, 19))
        .otherwise(value.rlike("^[0-9 ().+-]+$") & n.between(7, 15)))


def searched(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, a row number, and the raw matches of each kind, of tokens with digits or "@", and of joined digit groups."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(id_column).alias("id"), whole.alias("text"))
    body = F.col("text")
    digit = body.rlike("[0-9]")
    needs = {"email": F.contains(body, F.lit("@")), "ip": digit & F.contains(body, F.lit(".")), "card": digit, "phone": F.contains(body, F.lit("+"))}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    made = [found(body, patterns[k], needs[k]).alias(k) for k in KINDS]
    rows = rows.select("id", *made, found(body, TOKEN, digit | needs["email"], LEAD).alias("token"), found(body, GROUPS, digit).alias("groups"))
    return cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))


def placed(rows: DataFrame) -> DataFrame:
    """(row, kind, value, left, right, start, end) of every match that passes its check; kind "token" (joined digit groups too) is unchecked.

    Places are running sums over the matches of one text, so they take time in proportion to their number.
    """
    each = None
    for kind in (*KINDS, "token", "groups"):
        some = rows.select("row", F.lit(kind).alias("kind"), F.posexplode(kind).alias("no", "m")).select("row", "kind", "no", "m.*")
        each = some if each is None else each.union(some)
    order = Window.partitionBy("row", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.col("gap") + F.char_length("value")).over(order).cast("int")
    spans = each.withColumn("end", ends).withColumn("start", F.col("end") - F.char_length("value"))
    good = F.lit(True)
    for kind in KINDS:
        good = F.when(F.col("kind") == kind, passes(kind, F.col("value"))).otherwise(good)
    return cut_lineage(spans.where(good).withColumn("kind", F.when(F.col("kind") == "groups", "token").otherwise(F.col("kind"))).drop("gap", "no"))


def untouched(spans: DataFrame) -> DataFrame:
    """Tokens that share no code point with a span of a kind, by running extremes in order of their starts.

    Joined digit groups stay if they have the shape of a kind; their parts then stay if they have one on their own.
    """
    base = F.col("kind") != "token"
    forward = Window.partitionBy("row").orderBy("start", "base", "end").rowsBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy("row").orderBy(F.desc("start"), "base", F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    marked = spans.withColumn("base", F.when(base, 0).otherwise(1)).withColumns({
        "reached": F.max(F.when(base, F.col("end"))).over(forward), "coming": F.min(F.when(base, F.col("start"))).over(backward)})
    free = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.coalesce("coming", F.col("end")) >= F.col("end"))
    tokens = marked.where(~base & free).drop("base", "reached", "coming", "kind")
    group = F.contains("value", F.lit(" "))
    fits = F.exists(F.array(*[F.lit(k) for k in KINDS]), lambda k: shaped(k, F.col("value")))
    some = tokens.withColumn("fits", fits).where(~group | F.col("fits"))
    wider = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.max(F.when(group, F.col("end"))).over(wider), F.lit(0))
    return some.withColumn("inside", inside).where("fits OR inside < end").drop("fits", "inside")


def _words(side: Column, left: bool) -> Column:
    """The pattern's words beside a match: the two nearest on that side, in small letters, digits as 0, without punctuation at the match."""
    side = F.regexp_replace(side, r"""["'(\[{<*`]+$""" if left else r"""^["'\]}>.,;:!?*`)]+""", "")
    near = F.regexp_extract(side, r"(\S+\s+\S+)\s*$", 1) if left else F.regexp_extract(side, r"^\s*(\S+\s+\S+)", 1)
    return F.regexp_replace(F.regexp_replace(F.lower(near), "[0-9]", "0"), r"\s+", " ")


def _contexts(rows: DataFrame) -> DataFrame:
    """(row, start, end, value, words) twice for each match: the words before and the words after it."""
    sides = F.array(F.concat(F.lit("< "), _words(F.col("left"), True)), F.concat(F.lit("> "), _words(F.col("right"), False)))
    return rows.withColumn("words", F.explode(sides)).where(F.char_length("words") > 2).drop("left", "right")


def scores(seeds: DataFrame, others: DataFrame, trust: float = TRUST, least: int = SEEDS, prior: float = PRIOR, change: float = CHANGE) -> DataFrame:
    """(kind, value, words, score) of accepted instances that are no seeds, beside their trusted patterns.

    ``seeds`` and ``others`` are rows (kind, value, words) and (value, words). A pattern's confidence is the
    share of its right instances (seeds, and accepted instances by their score) among these and its instances
    of the wrong shape, with a prior of ``trust``; unseen instances of the right shape say nothing until
    they are accepted, however many they are. Accepted instances are seeds of the next round, so they strengthen
    patterns and make new ones. Scores start at 0, can only grow, and are bounded by 1; rounds end when
    none changes by more than ``change``.
    """
    pairs = cut_lineage(others.select("value", "words").distinct())
    kinds = F.array(*[F.lit(k) for k in KINDS])
    edges = pairs.withColumn("kind", F.explode(F.filter(kinds, lambda k: shaped(k, F.col("value"))))).select("kind", "value", "words")
    seeded = seeds.select("kind", "value", "words").distinct().groupBy("kind", "words").agg(F.count("*").alias("right"))
    unseen = edges.groupBy("kind", "words").agg(F.count("*").alias("unseen"))
    # the words that may ever be a pattern, with the instances that can never be right there
    some = seeded.join(unseen, ["kind", "words"], "full").fillna(0).where(F.col("right") + F.col("unseen") >= least)
    beside = pairs.groupBy("words").agg(F.count("*").alias("all"))
    patterns = cut_lineage(some.join(beside, "words").withColumn("wrong", F.col("all") - F.col("unseen")).where("unseen > 0").drop("all", "unseen"))
    edges = cut_lineage(edges.join(patterns.select("kind", "words"), ["kind", "words"]))
    score = cut_lineage(edges.select("kind", "value").distinct().withColumn("score", F.lit(0.0)))
    while True:
        gained = edges.join(score.where(F.col("score") >= trust), ["kind", "value"]).groupBy("kind", "words").agg(
            F.count("*").alias("accepted"), F.sum("score").alias("gain"))
        right = F.col("right") + F.col("gain")
        confidence = F.round((right + prior * trust) / (right + F.col("wrong") + prior), 9)
        trusted = patterns.join(gained, ["kind", "words"], "left").fillna(0, ["accepted", "gain"]).where(F.col("right") + F.col("accepted") >= least)
        trusted = trusted.select("kind", "words", confidence.alias("confidence")).where(F.col("confidence") >= trust)
        beside_trusted = edges.join(trusted, ["kind", "words"])
        again = beside_trusted.groupBy("kind", "value").agg((1 - F.exp(F.sum(F.log(F.lit(1.0) - F.col("confidence"))))).alias("new"))
        both = cut_lineage(score.join(again, ["kind", "value"], "left").select(
            "kind", "value", "score", F.greatest("score", F.coalesce("new", F.lit(0.0))).alias("new")))
        moved = both.agg(F.max(F.col("new") - F.col("score"))).first()[0]
        score = both.select("kind", "value", F.col("new").alias("score"))
        if moved is None or moved <= change:
            return beside_trusted.select("kind", "value", "words").join(score, ["kind", "value"])


def discovered(spans: DataFrame, trust: float = TRUST, **settings) -> DataFrame:
    """(row, kind, start, end) of further spans: tokens beside a trusted pattern that touch no base span."""
    seeds = _contexts(spans.where("kind <> 'token'"))
    others = _contexts(untouched(spans))
    score = scores(seeds, others, trust, **settings).where(F.col("score") >= trust)
    chosen = others.join(score, ["value", "words"])
    # a token that would do for two kinds belongs to the first as listed, and one inside joined digit groups to these
    each = chosen.groupBy("row", "start", "end").agg(F.min(_number()).alias("kind"))
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("reached", F.max("end").over(earlier)).where(F.coalesce("reached", F.lit(0)) <= F.col("start")).drop("reached")


def _number() -> Column:
    """A kind's place in the list, from 0."""
    return (F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")) - 1).cast("int")


def listed(spans: Column) -> Column:
    """kind:start:end of spans (kind number, start, end), by kind as listed, then start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def personal_data(df: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """id, base spans and all spans (arrays of kind number, start, end) of every text, and their counts by kind."""
    rows = searched(df, id_column, text)
    spans = placed(rows)
    base = spans.where("kind <> 'token'").select("row", _number().alias("kind"), "start", "end", F.lit(True).alias("base"))
    further = discovered(spans, **settings).select("row", "kind", "start", "end", F.lit(False).alias("base"))
    span = F.struct("kind", "start", "end")
    by_row = base.union(further).groupBy("row").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.collect_list(F.when(F.col("base"), span)).alias("base"), F.collect_list(span).alias("every"))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return rows.select("id", "row").join(by_row, "row", "left").select(
        F.col("id").alias(id_column), *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        *[F.coalesce(c, none).alias(c) for c in ("base", "every")])
