from datetime import date, datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtide.operators.quantiles import exact_quantiles
from jobtide.operators.versions import first_per_key
from jobtide.plans import marts, quality, reports, staging
from jobtide.schemas import MARTS, RAW
from jobtide.sources.taxonomy import default_taxonomy, taxonomy_frame
from jobtide.functions.skills import Skill

TIMESTAMPS = {
    "2026-01-05T10:00:00+02:00": datetime(2026, 1, 5, 10),
    "2026-01-05T10:00:00Z": datetime(2026, 1, 5, 10),
    "2026-01-05 10:00": datetime(2026, 1, 5, 10),
    "2026-01-05": datetime(2026, 1, 5),
    "2026": None,
    "2026-09": None,
    "10:00": None,
    "not a date": None,
    "": None,
    None: None,
}

BASE = dict(
    source="jobicy",
    external_id="1",
    title=" Data Analyst ",
    company=" ",
    location_text="Remote",
    tags="",
    description_text="",
    salary_min_usd=None,
    salary_max_usd=None,
    salary_source="api",
    posted_at=None,
    url="",
    fetched_at=datetime(2026, 1, 5, 9),
    snapshot_date="2026-01-05",
    skills="SQL",
    seniority="mid",
    role_family="Data Analyst",
)


def raw_rows(spark, *changes):
    rows = [{**BASE, **change} for change in changes]
    return spark.createDataFrame([tuple(row[c] for c in RAW.names) for row in rows], RAW)


def test_timestamps(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(TIMESTAMPS)], "i int, x string")
    rows = df.select("i", staging.timestamp_or_null(F.col("x")).alias("y")).collect()
    assert [r.y for r in sorted(rows, key=lambda r: r.i)] == list(TIMESTAMPS.values())


def test_staging_flags(spark):
    places = {
        "worldwide": ("worldwide", True, False),
        " Karachi, PK": ("Karachi, PK", False, True),
        "PKK": ("PKK", False, False),
        "Épk": ("Épk", False, True),
        "  ": ("unknown", False, False),
        "": ("unknown", False, False),
        None: ("unknown", None, None),
    }
    raw = raw_rows(
        spark, *[dict(external_id=str(i), location_text=p) for i, p in enumerate(places)]
    )
    rows = sorted(staging.stg_jobs(raw).collect(), key=lambda r: r.external_id)
    found = [(r.location_text, r.globally_remote, r.mentions_pakistan) for r in rows]
    assert found == list(places.values())
    assert rows[0].title == "Data Analyst" and rows[0].company == ""
    assert rows[0].fetched_at == datetime(2026, 1, 5, 9)
    assert rows[0].snapshot_date == date(2026, 1, 5)


def test_lifecycle_and_latest(spark):
    raw = raw_rows(
        spark,
        dict(title="old", skills="SQL"),
        dict(
            title="new",
            skills="dbt",
            snapshot_date="2026-01-19",
            fetched_at=datetime(2026, 1, 19),
            salary_min_usd=10.0,
            salary_max_usd=21.0,
        ),
        dict(title="refetched", skills="R", snapshot_date="2026-01-12", fetched_at=datetime(2026, 1, 20)),
        dict(external_id="2"),
        dict(external_id=None, snapshot_date="2026-01-26"),
    )
    fct = {r.external_id: r for r in marts.fct_job_postings(raw).collect()}
    assert set(fct) == {"1", "2"}
    one = fct["1"]
    assert (one.title, one.skills, one.salary_mid_usd) == ("refetched", "R", None)
    assert (one.first_seen_date, one.last_seen_date) == (date(2026, 1, 5), date(2026, 1, 19))
    assert (one.snapshots_present, one.days_listed_observed) == (3, 14)
    # The row without an id still sets the market snapshot.
    assert not one.is_active and not fct["2"].is_active


def test_mart_schemas(spark, sf_dir):
    from jobtide.verification.registry import Relations

    r = Relations(spark, sf_dir)
    built = {
        "fct_job_postings": r.fct,
        "fct_skill_mentions": r.fct_mentions,
        "agg_skill_demand": r.demand,
        "agg_salary_benchmarks": r.benchmarks,
        "agg_skill_by_snapshot": r.trend,
    }
    for name, df in built.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in MARTS[name]
        ]


def test_hot_key_and_ties(spark):
    """A third of all rows under one key; equal order settles the same each time."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string"))
        .otherwise((F.col("id") % 1000).cast("string"))
        .alias("key"),
        (F.col("id") % 7).alias("rank"),
        F.col("id").alias("value"),
    )
    first = first_per_key(df.repartition(16), ["key"], ["rank"])
    again = first_per_key(df.repartition(5, "value"), ["key"], ["rank"])
    assert first.columns == df.columns
    assert first.count() == df.select("key").distinct().count()
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    assert first.where("key is null").first().value == 0


def test_latest_of_tied_versions_does_not_depend_on_the_layout(spark):
    raw = raw_rows(spark, *[dict(title=f"t{i}", external_id=str(i % 3)) for i in range(300)])
    found = {
        tuple(sorted(map(str, staging.jobs_latest(raw.repartition(n)).collect()))) for n in (1, 7)
    }
    assert len(found) == 1 and len(found.pop()) == 3


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(
                st.none(),
                st.floats(-1e300, 1e300),
                st.sampled_from([0.0, 1.0, 50000.0, 50001.0, 50500.0]),
            ),
        ),
        max_size=60,
    )
)
def test_quantiles_like_numpy(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q90": 0.9, "q100": 1.0}
    found = {row.k: row for row in exact_quantiles(df, ["k"], "v", wanted).collect()}
    assert set(found) == {k for k, _ in rows}
    for key, row in found.items():
        values = [v for k, v in rows if k == key and v is not None]
        assert row.n == sum(k == key for k, _ in rows)
        assert row.n_valued == len(values)
        for name, q in wanted.items():
            if values:
                assert row[name] == pytest.approx(np.quantile(values, q), rel=1e-9, abs=1e-9)
            else:
                assert row[name] is None


def test_quantiles_without_keys(spark):
    df = spark.range(100001).select((F.col("id") * 1.0).alias("v"))
    row = exact_quantiles(df, [], "v", {"median": 0.5, "p25": 0.25}).first()
    assert (row.n, row.median, row.p25) == (100001, 50000.0, 25000.0)
    empty = exact_quantiles(df.where("v < 0"), [], "v", {"median": 0.5}).collect()
    assert [r.median for r in empty] == [None]


def test_explorer_search_is_a_regex_on_title_or_company(spark):
    raw = raw_rows(
        spark,
        dict(external_id="1", title="Data Analyst", company=None, posted_at="2026-01-01"),
        dict(external_id="2", title="Cook", company="ANALYSTS inc"),
        dict(external_id="3", title="Cook", company="other", posted_at="2026-01-03"),
        dict(external_id="4", title="Analyst", company="x", posted_at="2026-01-02"),
    )
    fct = marts.fct_job_postings(raw)
    assert [r.title for r in reports.explorer(fct, "ana.yst").collect()] == [
        "Analyst",
        "Data Analyst",
        "Cook",
    ]
    assert reports.explorer(fct, seniorities=[]).count() == 4
    assert reports.explorer(fct, families=["ML Engineer"]).count() == 0


def test_reports_on_nothing(spark, sf_dir):
    raw = raw_rows(spark, {}).where("source = 'none'")
    fct = marts.fct_job_postings(raw)
    mentions = marts.fct_skill_mentions(fct, default_taxonomy(spark))
    demand = marts.agg_skill_demand(mentions, fct)
    row = reports.kpi_row(fct, demand).first()
    assert tuple(row) == (0, 0, 0, None, None, 0)
    assert reports.salary_coverage_by_source(fct).count() == 0


def relations_with_bad_rows(spark):
    raw = raw_rows(
        spark,
        dict(external_id="1", skills="SQL;SQL;Nope"),
        dict(external_id="2", source="craigslist", seniority=None),
        dict(external_id="3", seniority="boss", role_family=None, snapshot_date=None),
        dict(external_id=None, title=None),
        dict(external_id="5", salary_min_usd=15000.0, salary_max_usd=90000.0),
    )
    stg = staging.stg_jobs(raw)
    fct = marts.fct_job_postings(raw)
    # A taxonomy with a name twice doubles mentions.
    mentions = marts.fct_skill_mentions(
        fct, taxonomy_frame(spark, [Skill("SQL", "a", "x"), Skill("SQL", "b", "x")])
    )
    return {
        "raw_job_postings": raw,
        "stg_jobs": stg,
        "fct_job_postings": fct,
        "fct_skill_mentions": mentions,
        "agg_skill_demand": marts.agg_skill_demand(mentions, fct),
        "agg_skill_by_snapshot": marts.agg_skill_by_snapshot(stg),
        "skill_taxonomy": taxonomy_frame(spark, [Skill("dbt", "a", "x")]),
    }


def test_checks_find_planted_rows(spark):
    outcome = quality.summary(relations_with_bad_rows(spark))
    failed = {r.check_name: (r.n_failed, r.status) for r in outcome.collect() if r.n_failed}
    assert failed["not_null_raw_job_postings_external_id"] == (1, "error")
    assert failed["not_null_raw_job_postings_title"] == (1, "error")
    assert failed["not_null_raw_job_postings_snapshot_date"] == (1, "error")
    assert failed["not_null_stg_jobs_job_key"] == (1, "error")
    assert failed["not_null_stg_jobs_seniority"] == (1, "error")
    assert failed["not_null_stg_jobs_role_family"] == (1, "error")
    assert failed["accepted_values_stg_jobs_source"] == (1, "error")
    assert failed["accepted_values_stg_jobs_seniority"] == (1, "error")
    assert failed["accepted_values_fct_job_postings_seniority"] == (1, "error")
    assert failed["unique_fct_skill_mentions_mention_id"][1] == "error"
    assert failed["unique_agg_skill_demand_skill"] == (1, "error")
    assert failed["relationships_fct_skill_mentions_skill"][1] == "error"
    assert failed["salary_sanity_fct_job_postings_salary_mid_usd"] == (1, "warn")
    with pytest.raises(quality.QualityError, match="unique_agg_skill_demand_skill"):
        quality.enforce(outcome)


def test_warnings_do_not_stop(spark):
    raw = raw_rows(spark, dict(salary_min_usd=1.0, salary_max_usd=2.0))
    relations = {"fct_job_postings": marts.fct_job_postings(raw)}
    rows = quality.enforce(quality.summary(relations))
    assert {r.status for r in rows} == {"pass", "warn"}


def test_freshness(spark):
    raw = raw_rows(spark, {})
    found = {
        days: quality.freshness(raw, datetime(2026, 1, 5 + days, 9)).first().status
        for days in (9, 10, 16, 17)
    }
    assert found == {9: "pass", 10: "warn", 16: "warn", 17: "error"}


def test_quantiles_order_no_crowded_bucket_in_one_task(spark):
    """200,000 values within a fifth of a percent: the median needs few of them in order."""
    df = spark.range(200_000).selectExpr("CAST(1000000 + id / 100 AS DOUBLE) AS v")
    found = exact_quantiles(df, [], "v", {"median": 0.5, "p99": 0.99})
    row = found.first()
    assert row["median"] == pytest.approx(np.median(1000000 + np.arange(200_000) / 100))
    assert row["p99"] == pytest.approx(np.quantile(1000000 + np.arange(200_000) / 100, 0.99))
    text = found._jdf.queryExecution().executedPlan().toString()
    # Values are only ever ordered within a slice.
    windows = [line for line in text.splitlines() if "windowspecdefinition" in line and "_value#" in line]
    assert windows and all("_slice#" in line for line in windows if "_value#" in line)


def test_quantiles_of_a_crowd_beside_an_outlier(spark):
    """Nearly all values in one slice of the first cut: no task orders more than a few thousand."""
    df = spark.range(200_000).select((F.lit(1_000_000.0) + F.col("id") * 5e-6).alias("v"))
    df = df.unionByName(spark.createDataFrame([(1_004_000.0,)], "v double"))
    values = np.append(1_000_000.0 + np.arange(200_000) * 5e-6, 1_004_000.0)
    found = exact_quantiles(df, [], "v", {"median": 0.5, "p99": 0.99})
    row = found.first()
    assert row["median"] == pytest.approx(np.quantile(values, 0.5), rel=1e-15)
    assert row["p99"] == pytest.approx(np.quantile(values, 0.99), rel=1e-15)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_part_1#" in plan and "_slice#" in plan
    # What reaches the ordering by value.
    least, most = values.min(), values.max()
    first = np.floor((values - least) / (most - least) * 4096)
    held = values[first == first[100_000]]
    second = np.floor((held - held.min()) / (held.max() - held.min()) * 4096)
    assert len(held) > 100_000 and np.bincount(second.astype(int)).max() < 5000
