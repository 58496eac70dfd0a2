"""A postings relation over ``lineitem``, as expressions both engines accept.

An order is a posting and its line numbers 1 to 7 are weekly snapshots.  The
expressions plant the cases that matter: empty and NULL lists, skills outside the
taxonomy, blank locations, odd salaries, timestamps in mixed forms.
"""

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_GROUPED = """SELECT l_orderkey AS k, l_linenumber AS n, max(l_partkey) AS pk,
  max(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey, l_linenumber"""

_COLUMNS = {
    "source": """CASE k % 4 WHEN 0 THEN 'remoteok' WHEN 1 THEN 'jobicy'
        WHEN 2 THEN 'remotive' ELSE 'arbeitnow' END""",
    "external_id": "CAST(k AS STRING)",
    "title": """CASE WHEN k % 10 = 3 AND n % 2 = 0 THEN 'Copywriter' ELSE CASE k % 13 WHEN 0 THEN 'Senior Data Analyst' WHEN 1 THEN 'Analytics Engineer'
        WHEN 2 THEN ' Machine Learning Lead ' WHEN 3 THEN 'Junior Data Scientist'
        WHEN 4 THEN 'BI Developer' WHEN 5 THEN 'Data Engineer, Analytics'
        WHEN 6 THEN 'Head of Insights' WHEN 7 THEN 'Product Analyst (Intern)'
        WHEN 8 THEN 'Staff ML Scientist, Data' WHEN 9 THEN 'Sr. AI Engineer'
        WHEN 10 THEN 'Marketing Analytics Manager' WHEN 11 THEN 'Data Analysts'
        ELSE 'Data Engineer' END END""",
    "company": """CASE WHEN k % 17 = 0 THEN NULL
        ELSE concat('Company ', CAST(k % 40 AS STRING), ' ') END""",
    "location_text": """CASE k % 11 WHEN 0 THEN 'worldwide' WHEN 1 THEN 'Anywhere in the World'
        WHEN 2 THEN 'US' WHEN 3 THEN 'EU' WHEN 4 THEN 'Lahore, Pakistan'
        WHEN 5 THEN 'Karachi, PK' WHEN 6 THEN ' Remote ' WHEN 7 THEN '' WHEN 8 THEN '   '
        WHEN 9 THEN NULL ELSE 'PKK Tower' END""",
    "tags": """CASE k % 5 WHEN 0 THEN 'remote;data' WHEN 1 THEN 'BigData' WHEN 2 THEN ''
        WHEN 3 THEN 'sales;marketing' ELSE 'python' END""",
    "description_text": """CASE k % 6 WHEN 0 THEN 'We use SQL, Python and dbt.'
        WHEN 1 THEN 'R and JavaScript, some Java.' WHEN 2 THEN 'Power BI, github, k8s'
        WHEN 3 THEN 'pyspark on Databricks; A/B tests' WHEN 4 THEN NULL
        ELSE CASE WHEN k % 90 = 5 THEN concat(repeat('some more words ', 900), 'Snowflake')
        ELSE '' END END""",
    "salary_text": """CASE k % 12 WHEN 0 THEN '$90k-120k / year' WHEN 1 THEN '$60k - $80k'
        WHEN 2 THEN '60K to 80K' WHEN 3 THEN '$85k+' WHEN 4 THEN '85k'
        WHEN 5 THEN '$45000 to $ 120000' WHEN 6 THEN '$999 or $5000' WHEN 7 THEN '$90,000'
        WHEN 8 THEN '$90-120k' WHEN 9 THEN 'competitive' WHEN 10 THEN '' ELSE NULL END""",
    "salary_num_text": """CASE WHEN k % 4000 = 6 THEN concat(repeat('0', 20000), '85000') ELSE CASE k % 8 WHEN 0 THEN '85000' WHEN 1 THEN '0' WHEN 2 THEN '-3'
        WHEN 3 THEN 'nan' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'abc' ELSE '1e5' END END""",
    "salary_min_usd": """CASE WHEN sk % 5 < 2 THEN NULL WHEN pk % 50 = 0 THEN CAST(5000 AS DOUBLE)
        WHEN pk % 97 = 0 THEN CAST(130000 + (pk * 37 % 131) * 1000 AS DOUBLE)
        ELSE CAST(30000 + (pk * 37 % 131) * 1000 AS DOUBLE) END""",
    "salary_max_usd": """CASE WHEN sk % 5 < 2 OR pk % 13 = 0 THEN NULL
        WHEN pk % 61 = 0 THEN CAST(900000 AS DOUBLE)
        ELSE CAST(30000 + (pk * 37 % 131) * 1000 + (sk * 13 % 61) * 1000 AS DOUBLE) END""",
    "salary_source": "CASE k % 4 WHEN 2 THEN 'parsed_text' WHEN 3 THEN NULL ELSE 'api' END",
    "posted_at": """CASE k % 6 WHEN 0 THEN '2026-01-05T10:00:00+02:00'
        WHEN 1 THEN '2026-01-05 10:00' WHEN 2 THEN 'not a date' WHEN 3 THEN NULL
        WHEN 4 THEN '2026' ELSE '2026-01-05' END""",
    "url": "concat('https://example.com/job/', CAST(k AS STRING))",
    "fetched_at": "CAST(DATE '2026-01-05' + 7 * (n - 1) + INTERVAL 9 HOUR AS {NTZ})",
    "snapshot_date": "DATE '2026-01-05' + 7 * (n - 1)",
    # The last piece is one of thirty skills, each more frequent than the one before.
    "skills": """CASE WHEN (pk + n) % 9 = 3 THEN '' WHEN (pk + n) % 9 = 4 THEN NULL
        ELSE concat(CASE (pk + n) % 9 WHEN 0 THEN 'SQL;Python' WHEN 1 THEN 'dbt; SQL ;Snowflake'
        WHEN 2 THEN 'SQL;Semantic Layer' WHEN 5 THEN 'SQL;;Python' WHEN 6 THEN 'R'
        WHEN 7 THEN 'Spark;Kafka;AWS' ELSE 'Python;Spark;Airflow' END, ';', CASE
        WHEN (pk * 7 + sk) % 495 < 2 THEN 'SQL' WHEN (pk * 7 + sk) % 495 < 5 THEN 'Python'
        WHEN (pk * 7 + sk) % 495 < 9 THEN 'R' WHEN (pk * 7 + sk) % 495 < 14 THEN 'Scala'
        WHEN (pk * 7 + sk) % 495 < 20 THEN 'Java' WHEN (pk * 7 + sk) % 495 < 27 THEN 'dbt'
        WHEN (pk * 7 + sk) % 495 < 35 THEN 'Airflow' WHEN (pk * 7 + sk) % 495 < 44 THEN 'Dagster'
        WHEN (pk * 7 + sk) % 495 < 54 THEN 'Prefect' WHEN (pk * 7 + sk) % 495 < 65 THEN 'Spark'
        WHEN (pk * 7 + sk) % 495 < 77 THEN 'Kafka' WHEN (pk * 7 + sk) % 495 < 90 THEN 'Snowflake'
        WHEN (pk * 7 + sk) % 495 < 104 THEN 'BigQuery' WHEN (pk * 7 + sk) % 495 < 119 THEN 'Redshift'
        WHEN (pk * 7 + sk) % 495 < 135 THEN 'Databricks' WHEN (pk * 7 + sk) % 495 < 152 THEN 'DuckDB'
        WHEN (pk * 7 + sk) % 495 < 170 THEN 'PostgreSQL' WHEN (pk * 7 + sk) % 495 < 189 THEN 'MySQL'
        WHEN (pk * 7 + sk) % 495 < 209 THEN 'MongoDB' WHEN (pk * 7 + sk) % 495 < 230 THEN 'Tableau'
        WHEN (pk * 7 + sk) % 495 < 252 THEN 'Power BI' WHEN (pk * 7 + sk) % 495 < 275 THEN 'Looker'
        WHEN (pk * 7 + sk) % 495 < 299 THEN 'Metabase' WHEN (pk * 7 + sk) % 495 < 324 THEN 'Excel'
        WHEN (pk * 7 + sk) % 495 < 350 THEN 'Plotly' WHEN (pk * 7 + sk) % 495 < 377 THEN 'Streamlit'
        WHEN (pk * 7 + sk) % 495 < 405 THEN 'AWS' WHEN (pk * 7 + sk) % 495 < 434 THEN 'GCP'
        WHEN (pk * 7 + sk) % 495 < 464 THEN 'Azure' WHEN (pk * 7 + sk) % 495 < 495 THEN 'Docker' END) END""",
    "seniority": """CASE k % 4 WHEN 0 THEN 'senior' WHEN 1 THEN 'mid' WHEN 2 THEN 'junior'
        ELSE 'intern' END""",
    "role_family": """CASE k % 5 WHEN 0 THEN 'Data Analyst' WHEN 1 THEN 'Data Engineer'
        WHEN 2 THEN 'ML Engineer' WHEN 3 THEN 'BI Developer' ELSE 'Other Data' END""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A posting is far wider than the row it comes from, so tasks are cut by rows, not by bytes read.
_ROWS_PER_TASK = 250_000
# What cases are chosen by.  Named, a remainder is computed once and not for each case.  A case is
# met by no missing remainder, so by one that is too large instead, which needs no test for NULL.
# Both keep the code of the projection small enough for the JVM to compile it.
_CHOSEN_BY = re.compile(r"((?:\([pk+ns *7]+\)|\b(?:k|n|pk|sk)) % \d+)(?= WHEN | = | < )")
_REMAINDERS = {
    text: f"r{number}"
    for number, text in enumerate(sorted({m for c in _COLUMNS.values() for m in _CHOSEN_BY.findall(c)}))
}
_MISSING = 10_000


# A value that orders are dealt by may hold the rows of a task, so more tasks than those keep them apart.
_TASKS_PER_DEAL = 4


def raw_postings(
    spark: SparkSession, sf_dir: str, dealt: tuple[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """The relation on Spark, lazily; only the rows are counted, from the files' footers.

    ``dealt`` names a column that follows from the order's number.  The rows then have it too, and
    those of one value lie in one task, so that grouping by it moves no posting.
    """
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    tasks = max(spark.sparkContext.defaultParallelism, -(-items.count() // _ROWS_PER_TASK))
    keys, by = ["l_orderkey", "l_linenumber"], []
    if dealt:
        name, follows = dealt
        items, tasks, by = items.withColumn(name, follows(F.col("l_orderkey"))), tasks * _TASKS_PER_DEAL, [name]
    grouped = (
        items.repartition(tasks, *(by or keys))
        .groupBy(*by, *keys)
        .agg({"l_partkey": "max", "l_suppkey": "max"})
        .toDF(*by, "k", "n", "pk", "sk")
        .selectExpr("*", *[f"coalesce({text}, {_MISSING}) AS {name}" for text, name in _REMAINDERS.items()])
    )
    named = {c: _CHOSEN_BY.sub(lambda m: _REMAINDERS[m[0]], text) for c, text in _COLUMNS.items()}
    return grouped.selectExpr(
        *by,
        *[f"{text.replace('{NTZ}', 'TIMESTAMP_NTZ')} AS {name}" for name, text in named.items()]
    )


def raw_postings_sql() -> str:
    """The same relation as a SELECT for DuckDB."""
    columns = ",\n  ".join(
        f"{text.replace('{NTZ}', 'TIMESTAMP')} AS {name}" for name, text in _COLUMNS.items()
    )
    return f"SELECT\n  {columns}\nFROM ({_GROUPED}) li"
