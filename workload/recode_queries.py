"""Projection, casts, dates, recoding, unions and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbatide.functions import recode as R
from verbatide.functions import text as T
from verbatide.operators import rowsets
from verbatide.plans import prepare
from workload.tables import Query, classed, table

CLASS_OF_BALANCE = (
    "CASE WHEN c_acctbal < 0 THEN 'Negative' WHEN c_acctbal > 0 THEN 'Positive' ELSE 'Neutral' END"
)
LEVELS = """CASE event_type WHEN 'error' THEN 'Extremely Negative' WHEN 'view' THEN 'Negative'
  WHEN 'click' THEN 'Positive' WHEN 'purchase' THEN 'Extremely Positive' ELSE NULL END"""
CLASS_OF_EVENT = (
    "CASE event_type WHEN 'error' THEN 'Negative' WHEN 'view' THEN 'Negative' "
    "WHEN 'click' THEN 'Positive' WHEN 'purchase' THEN 'Positive' ELSE 'Neutral' END"
)


def _levels():
    t = F.col("event_type")
    return (
        F.when(t == "error", "Extremely Negative").when(t == "view", "Negative")
        .when(t == "click", "Positive").when(t == "purchase", "Extremely Positive")
    )


def project_rename(spark, d):
    rows = table(spark, d, "orders", "o_orderkey", "o_orderpriority")
    return R.rename(rows, o_orderkey="id", o_orderpriority="OriginalTweet")


def to_number(spark, d):
    digits = F.substring("c_name", 10, 9)
    return table(spark, d, "customer", "c_custkey", "c_name").select(
        "c_custkey", R.to_number(digits).alias("strict"), R.to_number(F.col("c_name"), strict=False).alias("lenient")
    )


def as_text(spark, d):
    segment = F.when(F.col("c_acctbal") > 0, F.col("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", T.as_text(segment).alias("as_text"))


def class_filter(spark, d):
    return classed(spark, d).where(F.col("Sentiments") == "Negative").select("doc_id", "Sentiments")


def dates(spark, d):
    text = F.date_format("o_orderdate", "yyyy/MM/dd")
    moment = R.to_moment(text, "yyyy/MM/dd")
    parts = R.date_parts(moment)
    rows = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    rows = rows.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])
    day = R.date_from_parts(F.col("year"), F.col("month"), F.col("day"))
    return rows.select("o_orderkey", "year", "month", "day", day.cast("string").alias("date"), R.day_text(day).alias("TweetAt"))


def event_dates(spark, d):
    rows = table(spark, d, "events", "event_id", "ts")
    return rows.select("event_id", *[c.alias(n) for n, c in R.date_parts(F.col("ts")).items()])


def polarity(spark, d):
    name = R.polarity(F.col("c_acctbal"))
    return table(spark, d, "customer", "c_custkey", "c_acctbal").select(
        "c_custkey", name.alias("Sentiments"), R.class_code(name).alias("Feelings")
    )


def collapse_levels(spark, d):
    rows = table(spark, d, "events", "event_id", "event_type")
    return rows.select("event_id", R.collapse_levels(_levels()).alias("Sentiments"))


def numeric_codes(spark, d):
    rows = table(spark, d, "events", "event_id", "event_type")
    name = R.collapse_levels(_levels())
    by_level = {"Extremely Negative": 0, "Negative": 0, "Neutral": 1, "Positive": 2, "Extremely Positive": 2}
    level_code = F.coalesce(R.map_codes(_levels(), by_level), F.lit(-1))
    return rows.select("event_id", R.map_codes(name).alias("code"), level_code.alias("level_code"))


def union_by_name(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    b = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return rowsets.union_by_name(a, b)


def union_by_position(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return rowsets.union_by_position(a, table(spark, d, "supplier", "s_suppkey", "s_name"))


def _parts(parts):
    tagged = [p.withColumn("part", F.lit(i).cast("long")) for i, p in enumerate(parts)]
    return rowsets.union_by_position(*tagged)


def random_split(spark, d):
    orders = table(spark, d, "orders", "o_orderkey")
    return _parts(rowsets.random_split(orders, [0.8, 0.2], 5043))


def random_split_covers(spark, d):
    """Every row is in exactly one part of the random split."""
    return random_split(spark, d).groupBy("o_orderkey").agg(F.count("*").alias("parts"))


def _step(seed: int, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT % 10000)"


def keyed_split(spark, d):
    orders = table(spark, d, "orders", "o_orderkey")
    return _parts(rowsets.keyed_split(orders, "o_orderkey", [0.7, 0.3], 69))


def exact_split(spark, d):
    orders = table(spark, d, "orders", "o_orderkey", "o_orderpriority")
    return _parts(rowsets.exact_split(orders, "o_orderkey", [7, 2, 1], 69, by="o_orderpriority"))


def split_by_step(spark, d):
    """The cut rule of the keyed split, on a step the SQL can also take."""
    step = F.pmod(F.col("o_orderkey"), F.lit(rowsets.SPLIT_STEPS))
    part = rowsets.split_part(step, [0.7, 0.2, 0.1])
    return table(spark, d, "orders", "o_orderkey").select("o_orderkey", part.alias("part"))


def split_covers(spark, d):
    """Every row is in exactly one of the three parts of the nested hold-out."""
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    b = table(spark, d, "customer").select((-F.col("c_custkey") - 1).alias("id"))
    seen = _parts(rowsets.nested_holdout(a, b, "id"))
    return seen.groupBy("id").agg(F.count("*").alias("parts"))


def nested_holdout(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    b = table(spark, d, "customer").select((-F.col("c_custkey") - 1).alias("id"))
    return _parts(rowsets.nested_holdout(a, b, "id"))


def sort_by_count(spark, d):
    counts = table(spark, d, "lineitem", "l_partkey").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return rowsets.most_frequent(counts, "n", "l_partkey")


def top_k(spark, d):
    counts = table(spark, d, "lineitem", "l_partkey").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return rowsets.top_k(counts, 10, "n", "l_partkey")


def rank_slice(spark, d):
    counts = table(spark, d, "lineitem", "l_partkey").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return rowsets.rank_slice(counts, 2, 10, "n", "l_partkey")


def prepared_table(spark, d):
    """Both kinds of input, in canonical form, cleaned and in one table."""
    five = table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("Location"),
        F.concat_ws(" ", F.lit("<b>See</b>"), "event_type", "props").alias("OriginalTweet"),
        F.date_format("ts", "dd-MM-yyyy").alias("TweetAt"),
        _levels().alias("Sentiment"),
    )
    scored = table(spark, d, "customer").select(
        F.concat(F.col("c_name"), F.lit(" @"), F.col("c_mktsegment")).alias("Text"),
        F.col("c_nationkey").cast("string").alias("Location"),
        F.lit("2020-03-09").alias("Date"),
        F.when(F.col("c_acctbal") < 5000, F.col("c_acctbal")).cast("string").alias("Sentiments"),
    )
    return prepare.prepare(five, scored)


PREPARED_SQL = f"""
WITH five AS (
  SELECT user_id::VARCHAR AS Location, {CLASS_OF_EVENT} AS Sentiments, strftime(ts, '%d-%m-%Y') AS TweetAt,
         'see ' || event_type || ' ' || regexp_replace(lower(props), '[!-/:-@\\[-`{{-~]', '', 'g') AS ctext
  FROM events),
scored AS (
  SELECT DISTINCT c_nationkey::VARCHAR AS Location, c_name, c_mktsegment,
         CASE WHEN c_acctbal < 5000 THEN c_acctbal END AS score
  FROM customer),
filled AS (
  SELECT Location, coalesce(score, (SELECT avg(score) FROM scored)) AS score,
         regexp_replace(lower(c_name || ' ' || c_mktsegment), '[!-/:-@\\[-`{{-~]', '', 'g') AS ctext
  FROM scored),
both_ AS (
  SELECT Location, Sentiments, TweetAt, ctext FROM five
  UNION ALL
  SELECT Location, CASE WHEN score < 0 THEN 'Negative' WHEN score > 0 THEN 'Positive' ELSE 'Neutral' END,
         '09-03-2020', ctext FROM filled)
SELECT Location, CASE Sentiments WHEN 'Negative' THEN '1' WHEN 'Positive' THEN '2' ELSE '0' END AS Feelings,
       Sentiments, TweetAt, regexp_replace(trim(ctext), ' +', ' ', 'g') AS ctext
FROM both_"""

COUNTS = "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey"

QUERIES = {
    "project_rename": Query(project_rename, 'SELECT o_orderkey AS id, o_orderpriority AS "OriginalTweet" FROM orders'),
    "to_number": Query(
        to_number,
        """SELECT c_custkey, substr(c_name, 10, 9)::DOUBLE AS strict, TRY_CAST(c_name AS DOUBLE) AS lenient
           FROM customer""",
    ),
    "as_text": Query(
        as_text,
        """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_custkey::VARCHAR ELSE '' END AS as_text FROM customer""",
    ),
    "class_filter": Query(
        class_filter, "SELECT doc_id, 'Negative' AS \"Sentiments\" FROM labels WHERE toxic = 1"
    ),
    "dates": Query(
        dates,
        """SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
                  day(o_orderdate)::INTEGER AS day, strftime(o_orderdate, '%Y-%m-%d') AS date,
                  strftime(o_orderdate, '%d-%m-%Y') AS "TweetAt" FROM orders""",
    ),
    "event_dates": Query(
        event_dates,
        """SELECT event_id, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day
           FROM events""",
    ),
    "polarity": Query(
        polarity,
        f"""SELECT c_custkey, {CLASS_OF_BALANCE} AS "Sentiments",
                   CASE WHEN c_acctbal < 0 THEN '1' WHEN c_acctbal > 0 THEN '2' ELSE '0' END AS "Feelings"
            FROM customer""",
    ),
    "collapse_levels": Query(
        collapse_levels, f'SELECT event_id, {CLASS_OF_EVENT} AS "Sentiments" FROM events'
    ),
    "numeric_codes": Query(
        numeric_codes,
        """SELECT event_id,
                  (CASE WHEN event_type IN ('error', 'view') THEN 2 WHEN event_type IN ('click', 'purchase') THEN 1
                        ELSE 0 END)::INTEGER AS code,
                  (CASE WHEN event_type IN ('error', 'view') THEN 0 WHEN event_type IN ('click', 'purchase') THEN 2
                        ELSE -1 END)::INTEGER AS level_code
           FROM events""",
    ),
    "union_by_name": Query(
        union_by_name,
        """SELECT c_custkey AS id, c_name AS name, c_mktsegment FROM customer
           UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
    ),
    "union_by_position": Query(
        union_by_position,
        "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
    ),
    "random_split": Query(random_split),
    "random_split_covers": Query(random_split_covers, "SELECT o_orderkey, 1::BIGINT AS parts FROM orders"),
    "keyed_split": Query(
        keyed_split, f"SELECT o_orderkey, ({_step(69, 'o_orderkey')} >= 7000)::BIGINT AS part FROM orders"
    ),
    "exact_split": Query(
        exact_split,
        """WITH ranked AS (
             SELECT o_orderkey, o_orderpriority, count(*) OVER (PARTITION BY o_orderpriority) AS n,
                    row_number() OVER (PARTITION BY o_orderpriority
                                       ORDER BY ('0x' || substr(md5('69:' || o_orderkey), 1, 15))::BIGINT, o_orderkey) - 1 AS r
             FROM orders)
           SELECT o_orderkey, o_orderpriority, ((r >= round(n * 0.7))::INT + (r >= round(n * 0.9))::INT)::BIGINT AS part FROM ranked""",
    ),
    "split_by_step": Query(
        split_by_step,
        """SELECT o_orderkey, (CASE WHEN o_orderkey % 10000 >= 9000 THEN 2 WHEN o_orderkey % 10000 >= 7000 THEN 1
                               ELSE 0 END)::INTEGER AS part FROM orders""",
    ),
    "nested_holdout": Query(
        nested_holdout,
        f"""WITH everything AS (SELECT o_orderkey AS id, 9000 AS cut FROM orders UNION ALL SELECT -c_custkey - 1, 8000 FROM customer)
            SELECT id, (CASE WHEN {_step(5043, 'id')} >= cut THEN 2 WHEN {_step(5044, 'id')} >= 8000 THEN 1 ELSE 0 END)::BIGINT
              AS part FROM everything""",
    ),
    "split_covers": Query(
        split_covers,
        """SELECT o_orderkey AS id, 1::BIGINT AS parts FROM orders
           UNION ALL SELECT -c_custkey - 1, 1 FROM customer""",
    ),
    "sort_by_count": Query(sort_by_count, f"{COUNTS} ORDER BY n DESC, l_partkey"),
    "top_k": Query(top_k, f"{COUNTS} ORDER BY n DESC, l_partkey LIMIT 10"),
    "rank_slice": Query(rank_slice, f"{COUNTS} ORDER BY n DESC, l_partkey LIMIT 9 OFFSET 1"),
    "prepared_table": Query(prepared_table, PREPARED_SQL),
}
