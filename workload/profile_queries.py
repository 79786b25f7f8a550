"""Profiles, duplicates and missing values."""

from __future__ import annotations

from verbatide.operators import profile
from workload.sql import GAPS
from workload.tables import Query, events_with_gaps, table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _texts(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "lang", "text")


def _unions(template: str, columns: list[str]) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


EVENT_COLUMNS = ["event_id", "user_id", "event_type"]
ORDER_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}

QUERIES = {
    "column_profile": Query(
        lambda spark, d: profile.column_profile(_orders(spark, d)),
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM orders"
            for c, t in ORDER_TYPES.items()
        ),
    ),
    "null_counts": Query(
        lambda spark, d: profile.null_counts(events_with_gaps(spark, d)),
        f"WITH {GAPS} "
        + _unions("SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM gaps", EVENT_COLUMNS)
        + " UNION ALL SELECT 'value', count(*) FILTER (WHERE value IS NULL OR isnan(value)) FROM gaps",
    ),
    "non_null_counts": Query(
        lambda spark, d: profile.non_null_counts(events_with_gaps(spark, d)),
        f"WITH {GAPS} "
        + _unions("SELECT '{c}' AS \"column\", count({c}) AS non_null FROM gaps", EVENT_COLUMNS)
        + " UNION ALL SELECT 'value', count(*) FILTER (WHERE NOT isnan(value)) FROM gaps",
    ),
    "shape": Query(
        lambda spark, d: profile.shape(table(spark, d, "lineitem")),
        "SELECT count(*) AS rows, 11::BIGINT AS columns FROM lineitem",
    ),
    "first_rows": Query(
        lambda spark, d: profile.first_rows(table(spark, d, "customer"), "c_custkey", 5),
        "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
    ),
    "last_rows": Query(
        lambda spark, d: profile.last_rows(table(spark, d, "customer"), "c_custkey", 3),
        "SELECT * FROM customer ORDER BY c_custkey DESC LIMIT 3",
    ),
    "random_rows": Query(lambda spark, d: profile.random_rows(table(spark, d, "customer"), 10, 5043)),
    "has_duplicates": Query(
        lambda spark, d: profile.has_duplicates(_texts(spark, d), ignore=["doc_id"]),
        "SELECT max(n) > 1 AS any_duplicate FROM (SELECT count(*) AS n FROM documents GROUP BY lang, text)",
    ),
    "has_full_duplicates": Query(
        lambda spark, d: profile.has_duplicates(_texts(spark, d)),
        "SELECT max(n) > 1 AS any_duplicate FROM (SELECT count(*) AS n FROM documents GROUP BY doc_id, lang, text)",
    ),
    "drop_duplicates": Query(
        lambda spark, d: profile.drop_duplicates(table(spark, d, "documents", "lang", "text")),
        "SELECT DISTINCT lang, text FROM documents",
    ),
    "drop_duplicates_keep_first": Query(
        lambda spark, d: profile.drop_duplicates(_texts(spark, d), "doc_id"),
        "SELECT min(doc_id) AS doc_id, lang, text FROM documents GROUP BY lang, text",
    ),
    "impute_mean": Query(
        lambda spark, d: profile.impute_mean(events_with_gaps(spark, d), "value").selectExpr(
            "event_id", "round(value, 6) AS value"
        ),
        f"""WITH {GAPS}
            SELECT event_id, round(CASE WHEN value IS NULL OR isnan(value) THEN
                (SELECT avg(value) FROM gaps WHERE NOT isnan(value)) ELSE value END, 6) AS value
            FROM gaps""",
    ),
    "drop_missing": Query(
        lambda spark, d: profile.drop_missing(events_with_gaps(spark, d), ["value"]).select("event_id", "value"),
        f"WITH {GAPS} SELECT event_id, value FROM gaps WHERE value IS NOT NULL AND NOT isnan(value)",
    ),
}
