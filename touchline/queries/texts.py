"""Queries over text and number functions. Messy texts are built from the tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import numeric, text
from touchline.operators.ordered import attach
from touchline.queries.common import query, rounded
from touchline.sources.tables import table


def _s(column):
    return F.col(column).cast("string")


@query("""SELECT l_orderkey, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS outs, CAST(l_linenumber AS VARCHAR) AS rides,
  CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS buckoffs FROM lineitem""")
def packed_pieces(spark, folder):
    """``outs / rides / buckoffs``, the third piece absent in half of the rows."""
    packed = F.concat_ws(" / ", F.col("l_quantity").cast("int").cast("string"), _s("l_linenumber"),
                         F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag")))
    line = table(spark, folder, "lineitem").select("l_orderkey", packed.alias("packed"))
    return text.split_into(line, "packed", ["outs", "rides", "buckoffs"], " / ")


@query("""SELECT p_partkey, substr(p_type, 1, 1) AS sex, substr(p_type, 2) AS kind,
  TRY_CAST(p_size || '.5' AS DOUBLE) AS pct, '%' AS unit FROM part""")
def cut_at_position(spark, folder):
    part = table(spark, folder, "part").withColumn("shown", F.concat(_s("p_size"), F.lit(".5%")))
    sex, kind = text.split_at("p_type", 1)
    number, unit = text.split_at("shown", -1)
    return part.select("p_partkey", sex.alias("sex"), kind.alias("kind"),
                       text.to_number(number).alias("pct"), unit.alias("unit"))


@query("""SELECT p_partkey, replace(p_brand, 'Brand#', 'Maker ') AS maker,
  regexp_replace(p_name, '[aeiou]', '', 'g') AS consonants, TRY_CAST(regexp_replace(p_brand, '[^0-9.]', '', 'g') AS DOUBLE) AS digits
  FROM part""")
def replaced_text(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", text.replace_all("p_brand", "Brand#", "Maker ").alias("maker"),
        text.replace_all("p_name", "[aeiou]", "").alias("consonants"), text.digits_only("p_brand").alias("digits"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE
  (CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END) * round(o_totalprice, 2) END AS earned FROM orders""")
def parsed_numbers(spark, folder):
    """``$-1,234.50 USD`` to a number; text without a number is missing."""
    amount = F.when(F.col("o_orderkey") % 3 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    shown = F.concat(F.lit("$"), F.format_number(amount, 2), F.lit(" USD 7"))
    shown = F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(shown)
    return table(spark, folder, "orders").select("o_orderkey", text.first_number(shown).alias("earned"))


@query("""SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN NULL ELSE 60 + p_size % 30 END AS inches,
  CAST(1950 + p_size AS INTEGER) AS born FROM part""")
def heights_and_births(spark, folder):
    """``5' 11"`` to inches, ``Jul 14, 1988`` to a year."""
    tall = 60 + F.col("p_size") % 30
    shown = F.concat(F.floor(tall / 12).cast("string"), F.lit("' "), (tall % 12).cast("string"), F.lit('"'))
    shown = F.when(F.col("p_size") % 9 == 0, "--").otherwise(shown)
    born = F.date_format(F.make_date(1950 + F.col("p_size"), F.col("p_size") % 12 + 1, F.lit(14)), "MMM d, yyyy")
    return table(spark, folder, "part").select(
        "p_partkey", text.feet_inches(shown).alias("inches"), F.year(text.date_of(born, "MMM d, yyyy")).alias("born"))


@query("""SELECT event_id, contains(text, 'Free Throw 1 of 1') OR contains(text, 'Free Throw 2 of 2') AS last_throw,
    NOT contains(text, 'of 2') AS not_pair, contains(lower(text), 'rebound') AS rebound, upper(event_type) AS loud,
    event_type || ' ' || user_id AS label
  FROM (SELECT *, CASE event_type WHEN 'click' THEN 'Free Throw 1 of 1' WHEN 'view' THEN 'Free Throw 2 of 2'
    WHEN 'error' THEN 'Team REBOUND' WHEN 'signup' THEN 'MISS layup' END AS text FROM events)""")
def text_tests(spark, folder):
    kind = F.col("event_type")
    play = (F.when(kind == "click", "Free Throw 1 of 1").when(kind == "view", "Free Throw 2 of 2")
            .when(kind == "error", "Team REBOUND").when(kind == "signup", "MISS layup"))
    events = table(spark, folder, "events").withColumn("text", play)
    return events.select(
        "event_id", text.mentions("text", "Free Throw 1 of 1", "Free Throw 2 of 2").alias("last_throw"),
        text.lacks("text", "of 2").alias("not_pair"), text.mentions("text", "rebound", fold_case=True).alias("rebound"),
        F.upper(kind).alias("loud"), F.concat(kind, F.lit(" "), _s("user_id")).alias("label"))


@query("""SELECT l_orderkey, l_linenumber, array_to_string(list_transform(list_sort(list_filter(
  [l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey END], lambda x: x IS NOT NULL)),
  lambda x: CAST(x AS VARCHAR)), '_') AS lineup FROM lineitem""")
def canonical_lineups(spark, folder):
    """Order-free key of several id columns, sorted as numbers."""
    extra = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_orderkey"))
    ids = ["l_partkey", "l_suppkey", F.col("l_linenumber").cast("long"), extra]
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", text.canonical_list(ids).alias("lineup"))


@query("""SELECT o_orderkey, unnest(string_split(o_custkey || '_' || o_orderkey || '_' || o_orderstatus, '_')) AS member
  FROM orders""")
def delimited_to_rows(spark, folder):
    packed = F.concat_ws("_", _s("o_custkey"), _s("o_orderkey"), F.col("o_orderstatus"))
    return table(spark, folder, "orders").select("o_orderkey", F.explode(F.split(packed, "_")).alias("member"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE
  round(o_custkey % 3 * 3600 + o_orderkey % 60 * 60 + (o_orderkey % 600) / 10.0, 4) END AS seconds,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE
  round((o_custkey % 3 * 3600 + o_orderkey % 60 * 60 + (o_orderkey % 600) / 10.0) / 60, 4) END AS minutes FROM orders""")
def clock_times(spark, folder):
    """``h:m:s`` and ``m:s`` texts to seconds and minutes; ``DNF`` is missing."""
    hours, rest = F.col("o_custkey") % 3, F.concat_ws(
        ":", (F.col("o_orderkey") % 60).cast("string"), F.format_string("%.1f", (F.col("o_orderkey") % 600) / 10.0))
    shown = F.when(F.col("o_orderkey") % 13 == 0, "DNF").when(hours == 0, rest).otherwise(
        F.concat_ws(":", hours.cast("string"), rest))
    orders = table(spark, folder, "orders").withColumn("clock", shown)
    return rounded(orders.select("o_orderkey", text.clock_seconds("clock").alias("seconds"),
                                 text.clock_minutes("clock").alias("minutes")), "seconds", "minutes")


@query("""SELECT o_orderkey, CASE WHEN k IS NULL THEN NULL WHEN k > 1 THEN 'high' ELSE 'low' END AS strict,
  CASE WHEN k > 1 THEN 'high' ELSE 'low' END AS falls, coalesce(o, 'NONE') AS kept,
  CASE WHEN p = '' THEN 'None Listed' ELSE p END AS listed,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'now' WHEN o_orderpriority = '5-LOW' THEN 'later' ELSE o_orderpriority END AS code
  FROM (SELECT *, nullif(o_orderkey % 4, 3) AS k, nullif(o_orderstatus, 'P') AS o,
    CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS p FROM orders)""")
def branches_and_defaults(spark, folder):
    k = F.nullif(F.col("o_orderkey") % 4, F.lit(3))
    blank = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    return table(spark, folder, "orders").select(
        "o_orderkey", numeric.if_else(k > 1, F.lit("high"), F.lit("low")).alias("strict"),
        F.when(k > 1, "high").otherwise("low").alias("falls"),
        text.missing_to(F.nullif("o_orderstatus", F.lit("P")), "NONE").alias("kept"),
        text.blank_to(blank, "None Listed").alias("listed"),
        text.recode("o_orderpriority", {"1-URGENT": "now", "5-LOW": "later"}).alias("code"))


@query("""SELECT p_partkey, CASE WHEN age BETWEEN 1 AND 12 THEN '0-12' WHEN age BETWEEN 13 AND 18 THEN '13-18'
  WHEN age BETWEEN 19 AND 29 THEN '19-29' WHEN age BETWEEN 30 AND 39 THEN '30-39' WHEN age BETWEEN 40 AND 49 THEN '40-49'
  WHEN age BETWEEN 50 AND 54 THEN '50-54' WHEN age BETWEEN 55 AND 59 THEN '55-59' WHEN age BETWEEN 60 AND 64 THEN '60-64'
  WHEN age BETWEEN 65 AND 69 THEN '65-69' END AS age_group, CASE WHEN year < 1980 THEN 'early' ELSE 'recent' END AS era
  FROM (SELECT p_partkey, p_size * 2 - 3 AS age, 1955 + p_size AS year FROM part)""")
def age_bands(spark, folder):
    part = table(spark, folder, "part")
    return part.select("p_partkey", numeric.bands(F.col("p_size") * 2 - 3, numeric.ROWING_AGE_BANDS).alias("age_group"),
                       F.when(1955 + F.col("p_size") < 1980, "early").otherwise("recent").alias("era"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, round(l_extendedprice / l_quantity, 8) AS per_unit,
  round(100 * (l_discount - l_tax) / nullif(l_tax, 0), 8) AS change, round((1 + l_discount - 1) * 100, 4) AS percent,
  CASE WHEN l_discount > l_tax THEN 1.0::DOUBLE WHEN l_discount = l_tax THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS outcome FROM lineitem""")
def ratios_and_outcomes(spark, folder):
    line = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", numeric.ratio("l_extendedprice", "l_quantity").alias("per_unit"),
        numeric.ratio(F.col("l_discount") - F.col("l_tax"), "l_tax", 100).alias("change"),
        F.round(numeric.percent_change(1 + F.col("l_discount")), 4).alias("percent"),
        numeric.outcome("l_discount", "l_tax").alias("outcome"))
    return rounded(line, "per_unit", "change", places=8)


@query("""SELECT c_custkey, coalesce(CASE n_name WHEN 'NATION_3' THEN 'NORTH' WHEN 'NATION_7' THEN 'SOUTH' END, n_name) AS team
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def codes_by_table(spark, folder):
    """Team codes normalised by a mapping table."""
    mapping = table(spark, folder, "nation").where(F.col("n_nationkey").isin(3, 7)).select(
        "n_nationkey", F.when(F.col("n_nationkey") == 3, "NORTH").otherwise("SOUTH").alias("now"))
    nation = attach(table(spark, folder, "nation"), mapping, ["n_nationkey"])
    named = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.coalesce("now", "n_name").alias("team"))
    return table(spark, folder, "customer").join(named, "c_nationkey").select("c_custkey", "team")
