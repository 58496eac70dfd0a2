import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from jobtide.plans.quality import QualityError
from jobtide.plans import build, ingest, reports
from jobtide.schemas import JOBICY_JOB, RAW
from jobtide.sources import payloads
from jobtide.sources.tables import ensure_raw_table, read_raw
from jobtide.sources.taxonomy import default_skills, default_taxonomy, read_taxonomy, SEED
from jobtide.streaming.landing import ingest_landed

NAMED = {"SQL", "Python", "dbt", "Excel", "Snowflake", "Airflow"}
SKILLS = [skill for skill in default_skills() if skill.skill in NAMED]
FETCHED = datetime(2026, 9, 7, 9, 0, tzinfo=timezone.utc)

REMOTEOK = [
    {"legal": "notice", "position": "Data Analyst"},
    "not an object",
    {"id": 1, "position": " Senior Data Analyst ", "company": "Acme ", "location": "",
     "tags": ["sql", "remote"], "description_generic": "<b>Python</b> &amp; dbt",
     "salary_min": 90000, "salary_max": "120000", "date": "2026-09-01T10:00:00+00:00",
     "url": None},
    {"id": 2, "position": "Writer", "tags": ["BigData"], "salary_min": 0, "url": "u2"},
    {"id": 3, "position": "Writer", "tags": ["prose"]},
    {"id": 4, "position": None, "tags": ["data"]},
]
JOBICY = {"jobs": [
    {"id": 5, "jobTitle": "Product Person", "jobIndustry": ["Business Intelligence"],
     "companyName": "B", "jobGeo": "USA", "jobType": ["full-time"],
     "jobDescription": "<p>Excel</p>", "annualSalaryMin": "", "pubDate": "2026-09-02", "url": "u5"},
    {"id": 6, "jobTitle": "Cook", "jobIndustry": ["Food"]},
]}
REMOTIVE_DATA = {"jobs": [
    {"id": 7, "title": "Analytics Engineer", "company_name": "C", "category": "Data",
     "candidate_required_location": "Pakistan", "salary": "$60k - $80k",
     "description": "<p>Snowflake</p>", "publication_date": "2026-09-03", "url": "u7"},
    {"id": 8, "title": "Copywriter", "category": "Data"},
]}
REMOTIVE_DEV = {"jobs": [
    {"id": 7, "title": "Analytics Engineer (second)", "category": "Dev"},
    {"id": 8, "title": "Data Engineer (second)", "category": "Dev"},
    {"id": 9, "title": "ML Engineer", "category": "Dev", "salary": "competitive"},
]}
ARBEITNOW = [
    {"data": [{"slug": "a-1", "title": "Data Engineer", "company_name": "D", "location": "",
               "remote": True, "tags": [], "description": "Airflow", "created_at": 1767600000,
               "url": "ua"}], "links": {"next": "p2"}},
    {"data": [{"slug": "a-2", "title": "Nurse", "remote": False, "tags": ["Data entry"],
               "created_at": None}]},
]


def land(root, day, source, *payloads, feed=None):
    folder = root / day / source / feed if feed else root / day / source
    folder.mkdir(parents=True, exist_ok=True)
    for number, payload in enumerate(payloads):
        text = payload if isinstance(payload, str) else json.dumps(payload, indent=1)
        (folder / f"page{number}.json").write_text(text, encoding="utf-8")


def land_all(root, day):
    land(root, day, "remoteok", REMOTEOK)
    land(root, day, "jobicy", JOBICY)
    land(root, day, "remotive", REMOTIVE_DATA, feed="data")
    land(root, day, "remotive", REMOTIVE_DEV, feed="software-dev")
    land(root, day, "arbeitnow", *ARBEITNOW)


class Store:
    def __init__(self, spark, root):
        self.spark, self.landing = spark, root / "landing"
        self.table, self.archive = str(root / "raw"), str(root / "archive")

    def run(self, day, fetched=FETCHED):
        return ingest.run_ingestion(
            self.spark, str(self.landing), self.table, self.archive, day, fetched, SKILLS
        )

    def rows(self, *columns):
        found = read_raw(self.spark, self.table).select(*columns).collect()
        return sorted(tuple(row) for row in found)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path)


def test_records(store):
    land_all(store.landing, "2026-09-07")
    result = store.run("2026-09-07")
    assert result.counts == {"remoteok": 2, "jobicy": 1, "remotive": 2, "arbeitnow": 2}
    assert result.skipped == ()
    assert store.rows("source", "external_id", "title", "company", "location_text", "tags") == [
        ("arbeitnow", "a-1", "Data Engineer", "D", "remote", ""),
        ("arbeitnow", "a-2", "Nurse", "", "", "Data entry"),
        ("jobicy", "5", "Product Person", "B", "USA", "full-time;['Business Intelligence']"),
        ("remoteok", "1", "Senior Data Analyst", "Acme", "worldwide", "sql;remote"),
        ("remoteok", "2", "Writer", "", "worldwide", "BigData"),
        ("remotive", "7", "Analytics Engineer", "C", "Pakistan", "Data"),
        ("remotive", "9", "ML Engineer", "", "worldwide", "Dev"),
    ]
    assert store.rows(
        "external_id", "salary_min_usd", "salary_max_usd", "salary_source", "posted_at", "url"
    ) == [
        ("1", 90000.0, 120000.0, "api", "2026-09-01T10:00:00+00:00", "https://remoteok.com/l/1"),
        ("2", None, None, "api", None, "u2"),
        ("5", None, None, "api", "2026-09-02", "u5"),
        ("7", 60000.0, 80000.0, "parsed_text", "2026-09-03", "u7"),
        ("9", None, None, "parsed_text", None, ""),
        ("a-1", None, None, None, "2026-01-05T08:00:00+00:00", "ua"),
        ("a-2", None, None, None, None, ""),
    ]
    assert store.rows("external_id", "description_text", "skills", "seniority", "role_family") == [
        ("1", "Senior Data Analyst Python & dbt", "SQL;Python;dbt", "senior", "Data Analyst"),
        ("2", "Writer", "", "mid", "Other Data"),
        ("5", "Excel", "Excel", "mid", "Other Data"),
        ("7", "Snowflake", "Snowflake", "mid", "Analytics Engineer"),
        ("9", "", "", "mid", "ML Engineer"),
        ("a-1", "Airflow", "Airflow", "mid", "Data Engineer"),
        ("a-2", "", "", "mid", "Other Data"),
    ]


def test_rerun_replaces_only_its_own_partitions(store):
    land_all(store.landing, "2026-09-07")
    land_all(store.landing, "2026-09-14")
    store.run("2026-09-07")
    store.run("2026-09-14")
    before = store.rows("snapshot_date", "source", "external_id")
    store.run("2026-09-14")
    assert store.rows("snapshot_date", "source", "external_id") == before
    changed = [{"legal": "x"}, {"id": 99, "position": "Data Engineer"}]
    land(store.landing, "2026-09-14", "remoteok", changed)
    store.run("2026-09-14")
    kept = [row for row in before if row[:2] != ("2026-09-14", "remoteok")]
    assert store.rows("snapshot_date", "source", "external_id") == sorted(
        [*kept, ("2026-09-14", "remoteok", "99")]
    )


def test_failed_source_is_skipped_and_keeps_its_rows(store, spark):
    land_all(store.landing, "2026-09-07")
    store.run("2026-09-07")
    land(store.landing, "2026-09-07", "jobicy", "<html>down</html>")
    result = store.run("2026-09-07")
    assert result.skipped == ("jobicy",)
    assert ("jobicy", "5") in store.rows("source", "external_id")
    archived = spark.read.parquet(store.archive).select("source").distinct().collect()
    assert "jobicy" not in {row.source for row in archived}


def test_write_errors_are_not_taken_for_a_bad_payload(store, spark):
    batch = spark.range(1).selectExpr("CAST(raise_error('disk full') AS STRING) AS title")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in RAW if f.name != "title"]
    with pytest.raises(Exception, match="disk full"):
        ingest.store_batches({"jobicy": batch.select("title", *columns)}, store.table)


def test_odd_fields_cost_no_board(store):
    land(store.landing, "2026-09-07", "jobicy", {"jobs": [
        {"id": 1, "jobTitle": "Data Analyst", "jobType": "full-time"},
        "text", {"id": 2, "jobTitle": "Data Engineer", "jobType": ["a", "b"], "jobGeo": ["x"]},
    ]})
    land(store.landing, "2026-09-07", "arbeitnow", {"data": [
        {"slug": "s", "title": "Data Analyst", "remote": "yes", "created_at": 1767600000.7, "tags": "x"},
        {"slug": "t", "title": "Data Analyst", "remote": 0, "created_at": "soon", "tags": None},
        {"slug": "u", "title": "Data Analyst", "created_at": 1e300, "tags": {"a": 1}},
    ]})
    land(store.landing, "2026-09-07", "remoteok", [{}, {"id": 9, "position": "Data Analyst", "tags": "sql"}])
    assert store.run("2026-09-07").counts == {"remoteok": 1, "jobicy": 2, "arbeitnow": 3}
    rows = store.rows("external_id", "tags", "location_text", "posted_at")
    assert rows[:2] == [("1", "full-time;", "worldwide", None), ("2", "a;b;", '["x"]', None)]
    assert rows[2] == ("9", "sql", "worldwide", None)
    assert rows[3] == ("s", "x", "remote", "2026-01-05T08:00:00+00:00")
    assert rows[4] == ("t", "", "", None) and rows[5][3] is None


def test_first_listing_wins_over_pages(store):
    page = lambda title: {"jobs": [{"id": 1, "title": title}]}
    land(store.landing, "2026-09-07", "remotive", page("Data Engineer"), page("Copywriter"), feed="data")
    land(store.landing, "2026-09-14", "remotive", page("Copywriter"), page("Data Engineer"), feed="data")
    land(store.landing, "2026-09-14", "remoteok", REMOTEOK)
    for day in ("2026-09-07", "2026-09-14"):
        land(store.landing, day, "remotive", {"jobs": []}, feed="software-dev")
        store.run(day)
    found = [row for row in store.rows("snapshot_date", "source", "title") if row[1] == "remotive"]
    assert found == [("2026-09-07", "remotive", "Data Engineer")]


def test_long_descriptions_are_kept_and_matched(store):
    text = "words " * 5000 + "Snowflake"
    land(store.landing, "2026-09-07", "jobicy", {"jobs": [{"id": 1, "jobTitle": "Data Analyst", "jobDescription": text}]})
    store.run("2026-09-07")
    assert store.rows("description_text", "skills") == [(text, "Snowflake")]


def test_missing_and_empty_sources(store):
    land(store.landing, "2026-09-07", "remoteok", REMOTEOK)
    land(store.landing, "2026-09-07", "jobicy", {"jobs": []})
    land(store.landing, "2026-09-07", "arbeitnow", {"message": "none"})
    result = store.run("2026-09-07")
    assert result.counts == {"remoteok": 2}
    assert set(result.skipped) == {"jobicy", "remotive", "arbeitnow"}


def test_empty_batch_leaves_the_table(store):
    land_all(store.landing, "2026-09-07")
    store.run("2026-09-07")
    before = store.rows("snapshot_date", "source", "external_id")
    land(store.landing, "2026-09-14", "jobicy", {"jobs": []})
    with pytest.raises(ingest.EmptyBatchError):
        store.run("2026-09-14")
    assert store.rows("snapshot_date", "source", "external_id") == before


def test_raw_table_and_reports(store, spark):
    land_all(store.landing, "2026-09-07")
    store.run("2026-09-07")
    ensure_raw_table(spark, "raw_by_name", store.table)
    ensure_raw_table(spark, "raw_by_name", store.table)
    assert spark.table("raw_by_name").count() == 7
    stats = reports.raw_stats(read_raw(spark, store.table)).first()
    assert tuple(stats) == (7, 7, 1, "2026-09-07", "2026-09-07")
    land_all(store.landing, "2026-09-14")
    result = ingest.run_ingestion(
        spark, str(store.landing), store.table, store.archive, "2026-09-14", FETCHED, SKILLS,
        name="raw_by_name",
    )
    assert spark.table("raw_by_name").count() == 14
    assert tuple(result.stats) == (14, 7, 2, "2026-09-07", "2026-09-14")
    assert reports.preview(read_raw(spark, store.table)).count() == 8
    spark.sql("DROP TABLE raw_by_name")


def test_build(store, spark, tmp_path):
    land_all(store.landing, "2026-09-07")
    land_all(store.landing, "2026-09-14")
    store.run("2026-09-07")
    store.run("2026-09-14", datetime(2026, 9, 14, 9, tzinfo=timezone.utc))
    taxonomy, root = default_taxonomy(spark), str(tmp_path / "marts")
    with pytest.raises(QualityError, match="last loaded"):
        build.build(spark, store.table, taxonomy, root, now=datetime(2026, 10, 14, tzinfo=timezone.utc))
    for _ in range(2):
        outcome = build.build(spark, store.table, taxonomy, root, now=datetime(2026, 9, 24, 9))
    assert len(outcome) == 25
    assert {row.status for row in outcome} == {"pass"}
    build.open_views(spark, store.table, taxonomy, root)
    row = spark.sql(
        "SELECT * FROM fct_job_postings WHERE external_id = '1' AND source = 'remoteok'"
    ).first()
    assert (row.days_listed_observed, row.snapshots_present, row.is_active) == (7, 2, True)
    assert row.salary_mid_usd == 105000.0
    trend = spark.sql("SELECT * FROM agg_skill_by_snapshot WHERE skill = 'SQL'").collect()
    assert [r.n_jobs for r in trend] == [1, 1]
    assert spark.sql("SELECT count(*) AS n FROM int_jobs_latest").first().n == 7
    spark.catalog.clearCache()


def test_streamed_landing_equals_batch(store, spark, tmp_path):
    def run():
        checkpoint = str(tmp_path / "checkpoint")
        query = ingest_landed(
            spark, str(store.landing), store.table, checkpoint, SKILLS, lambda: FETCHED
        )
        query.awaitTermination()

    day = "2026-09-07"
    land(store.landing, day, "remoteok", REMOTEOK)
    land(store.landing, day, "arbeitnow", ARBEITNOW[0])
    run()
    assert {row[0] for row in store.rows("external_id")} == {"1", "2", "a-1"}
    # A later page must not replace the earlier one, only complete the partition.
    folder = store.landing / day / "arbeitnow"
    (folder / "late.json").write_text(json.dumps(ARBEITNOW[1]))
    run()
    run()
    assert {row[0] for row in store.rows("external_id")} == {"1", "2", "a-1", "a-2"}


def test_streamed_board_that_fails_is_taken_up_again(store, spark, tmp_path):
    def run():
        query = ingest_landed(
            spark, str(store.landing), store.table, str(tmp_path / "c"), SKILLS, lambda: FETCHED
        )
        query.awaitTermination()

    day = "2026-09-07"
    land(store.landing, day, "remoteok", REMOTEOK)
    land(store.landing, day, "jobicy", "<html>down</html>")
    with pytest.raises(Exception, match="jobicy"):
        run()
    assert {row[0] for row in store.rows("source")} == {"remoteok"}
    land(store.landing, day, "jobicy", JOBICY)
    run()
    assert {row[0] for row in store.rows("source")} == {"remoteok", "jobicy"}


def test_taxonomy_file(spark):
    read = read_taxonomy(spark, str(SEED)).collect()
    assert [tuple(row) for row in read] == [tuple(row) for row in default_skills()]
    assert len(read) == 51
    shown = reports.taxonomy_list(default_taxonomy(spark))
    assert shown.columns == ["skill", "category"] and shown.count() == 51


ODD_DOCUMENTS = [
    '{"jobs":[{"id":1E400,"jobTitle":"a"},{"id":"\\"Infinity\\"","url":-1e999}]}',
    '{"jobs":[{"id":NaN,"jobTitle":"a"},5,"x","",null,[1],{"id":[1e5,{"a":1.0}]},{}]}',
    '{"jobs":[{"id":1},[{"id":2}],{"id":123456789012345678901234567890,"url":0.10}]}',
    '{"jobs":{"id":1}}', '{"jobs":5}', '{"jobs":"[1]"}', '{"jobs":null}', '{"x":[1]}', "{}", "",
    '{"jobs":[{"id":1,"id":2}],"jobs":[{"id":"3"}]}',
    '{"x":{"jobs":[1]},"jobs":[{"id":"\\u00e9 \\" \\n","jobTitle":"\\ud83d\\ude00","jobType":["a"," b"]}]} rest',
    '{"jobs":[{"id":"\\ud83d x","jobType":["\\ud83d",1E400,1e5,-0.0],"url":{"a":"\\ude00"}}]}',
]


def test_documents_read_at_once_give_what_their_elements_give(spark):
    rows = [(str(n), text) for n, text in enumerate(ODD_DOCUMENTS)]
    documents = spark.createDataFrame(rows, "page string, value string")
    elements = payloads.elements_of(documents, "jobs").where(F.ltrim("element").startswith("{"))
    expected = elements.select("page", "position", F.from_json("element", JOBICY_JOB).alias("job"))
    found = payloads.explode_jobs(documents, "jobs", JOBICY_JOB)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert found.count() == 10
    for text in ("<p>", '{"jobs":[{"id":1}', "[]", "5", '{"jobs":[{"id":1,}]}'):
        broken = documents.select("page", F.lit(text).alias("value"))
        with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
            payloads.explode_jobs(broken, "jobs", JOBICY_JOB).collect()
