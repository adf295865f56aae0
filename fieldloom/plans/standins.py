"""Views of the driver tables in the shapes that the operators take; one text serves Spark and the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "ix": """SELECT '100mN' || CAST(l_suppkey AS STRING) || 'E' || CAST(l_orderkey % 50 AS STRING) AS grid_id,
        l_suppkey AS n, l_orderkey % 50 AS e, l_partkey AS src_id, p_type AS formation, p_brand AS code,
        CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'A' WHEN 'AO' THEN 'B' WHEN 'NF' THEN 'C' WHEN 'NO' THEN 'K' WHEN 'RF' THEN 'A' END AS status,
        CAST(year(l_shipdate) AS BIGINT) AS mapping_year, l_quantity * 10 AS area
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "source": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'http://x/' || CAST(o_orderkey AS STRING) || '.wav' END AS audio,
        (o_orderkey % 180) - 90 AS lat, o_custkey AS cust, o_orderstatus AS sound_status, o_orderpriority AS photo_status, o_totalprice AS price
        FROM {orders}""",
    "source_prev": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN 'http://old' WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'http://x/' || CAST(o_orderkey AS STRING) || '.wav' END AS audio,
        CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE (o_orderkey % 180) - 90 END AS lat, o_custkey AS cust,
        CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS sound_status, o_orderpriority AS photo_status, o_totalprice AS price
        FROM {orders} WHERE o_orderkey % 17 <> 0""",
    "preds": """SELECT user_id AS id, event_type AS model, event_id % 20 AS segment, 'sp ' || CAST(event_id % 37 AS STRING) AS species, value / 400 AS score, ts
        FROM {events}""",
    "allow": """SELECT DISTINCT 'sp ' || CAST(event_id % 30 AS STRING) AS species, 'name ' || CAST(event_id % 30 % 28 AS STRING) AS accepted_name,
        CASE WHEN event_id % 30 % 5 = 0 THEN NULL WHEN event_id % 30 % 5 < 3 THEN 'birds' ELSE 'amphibia' END AS taxon_group,
        event_id % 30 % 4 <> 0 AS present, CASE WHEN event_id % 30 % 3 = 0 THEN 10 WHEN event_id % 30 % 3 = 1 THEN 1 ELSE 4 END AS start_month,
        CASE WHEN event_id % 30 % 3 = 0 THEN 2 WHEN event_id % 30 % 3 = 1 THEN 12 ELSE 9 END AS end_month FROM {events}""",
    "files": """SELECT CAST(floor(doc_id / 2) AS BIGINT) AS id, 'f' || CAST(doc_id AS STRING) AS name, n_chars AS size_bytes, quality IS NOT NULL AS file_exists,
        coalesce(toxic, 0) = 1 AS has_issues, CASE WHEN toxic = 1 THEN 'Bad Tone: x|' || lang || ' ;dup' WHEN quality = 0 THEN 'low_quality;dup' ELSE '' END AS issues, lang
        FROM {documents} LEFT JOIN {labels} USING (doc_id)""",
    "scores": """SELECT user_id AS id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value / 300 END AS score FROM {events}""",
    "pixels": """SELECT label AS file, vec_id % 4 AS band, vec_id AS "row", i AS col, CAST(CASE WHEN (vec_id + i) % 5 = 0 OR vec_id % 50 = 0 THEN -9999 ELSE (vec_id * 7 + i * 3) % 101 END AS DOUBLE) AS value
        FROM {embeddings} CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) AS p""",
    "cube": """SELECT event_type AS var, CAST(user_id % 5 AS DOUBLE) AS x, CAST(user_id % 3 AS DOUBLE) AS y, ts, value FROM {events}""",
    "weather": """SELECT event_type AS var, CAST((user_id % 7) * (user_id % 7) AS DOUBLE) * 1000 AS x, CAST((user_id % 5) * (user_id % 5 + 1) AS DOUBLE) * 1000 AS y,
        date_trunc('hour', ts) AS ts, round(sum(value), 3) AS value FROM {events} GROUP BY 1, 2, 3, 4""",
    "visits": """SELECT c_custkey AS id, CAST(c_custkey % 77 AS DOUBLE) * 500 - 1000 AS x, CAST(c_custkey % 47 AS DOUBLE) * 500 - 1000 AS y, c_custkey % 26 AS day, c_custkey * 37 % 1440 AS minute
        FROM {customer}""",
    "series": """SELECT user_id AS id, date_trunc('hour', ts) AS ts, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM {events}""",
    "polys": """SELECT p_partkey AS poly, p_type AS formation, p_brand AS code, CAST(p_partkey % 97 * 37 AS DOUBLE) AS x0, CAST(p_partkey % 89 * 41 AS DOUBLE) AS y0,
        CAST(p_partkey % 97 * 37 + 20 + p_size * 7 AS DOUBLE) AS x1, CAST(p_partkey % 89 * 41 + 30 + p_size * 5 AS DOUBLE) AS y1, p_size AS mapping_year,
        CASE p_partkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'K' END AS status FROM {part}""",
    "media": """SELECT CAST(floor(doc_id / 3) AS BIGINT) + 1 AS id, 'm' || CAST(doc_id AS STRING) AS name, quality IS NULL OR quality = 1 AS probe_ok, lang <> 'xx' AS decode_ok, n_chars > 40 AS duration_ok,
        CASE WHEN toxic = 1 THEN 'Bad Tone: x|dup' ELSE '' END AS issues, n_chars AS mtime, n_chars AS size_bytes FROM {documents} LEFT JOIN {labels} USING (doc_id)""",
    "retries": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'http://old' ELSE 'http://x/' || CAST(o_orderkey AS STRING) || '.wav' END AS audio, CAST(o_orderkey % 6 AS INT) AS attempts,
        o_orderkey % 23 = 0 AS terminal, CASE WHEN o_orderkey % 5 = 0 THEN 'timeout: 30|http_404' ELSE '' END AS last_error FROM {orders} WHERE o_orderkey % 3 = 0""",
    "times": """SELECT event_id AS id, CASE WHEN event_id % 17 = 0 THEN 'n/a' ELSE replace(CAST(ts AS STRING), ' ', 'T') || CASE WHEN event_id % 3 = 0 THEN '+02:00' WHEN event_id % 3 = 1 THEN 'Z' ELSE '' END END AS stamp,
        user_id FROM {events}""",
    "raw_scores": """SELECT vec_id AS id, label, embedding FROM {embeddings}""",
    "meta": """SELECT o_orderkey AS id, CAST(o_orderkey % 180 - 85 AS DOUBLE) AS lat, CAST(o_custkey % 400 - 190 AS DOUBLE) AS lon,
        CASE WHEN o_orderkey % 19 = 0 THEN 'bad' ELSE '2024-05-0' || CAST(1 + o_orderkey % 9 AS STRING) || 'T04:30:00' || CASE WHEN o_orderkey % 2 = 0 THEN '+02:00' ELSE 'Z' END END AS stamp,
        '100mN' || CAST(o_orderkey % 40 AS STRING) || 'E' || CAST(o_custkey % 50 AS STRING) AS cell, CASE WHEN o_orderkey % 3 > 0 THEN '100mN' || CAST(o_custkey % 40 AS STRING) || 'E' || CAST(o_orderkey % 50 AS STRING) END AS fine
        FROM {orders}""",
    "points": """SELECT c_custkey AS id, c_custkey % 3600 + 0.5 AS x, c_custkey * 7 % 3700 + 0.25 AS y, c_nationkey AS nation FROM {customer}""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def sql_text(name: str) -> str:
    """A view's text for the oracle."""
    return VIEWS[name].format(**{t: t for t in TABLES})


def with_views(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({sql_text(n)})" for n in names)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name].replace('"row"', "`row`")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)
