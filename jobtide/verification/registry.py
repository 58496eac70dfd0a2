"""Every registered query, next to the SQL it must equal."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions import classify, numbers, skills, text
from jobtide.operators.versions import first_per_key
from jobtide.plans import build, incremental, ingest, marts, quality, reports, staging
from jobtide.schemas import RAW
from jobtide.sources import boards
from jobtide.sources.payloads import read_pages
from jobtide.sources.tables import (
    archive_snapshot,
    ensure_raw_table,
    read_raw,
    scratch_folder,
    upsert_snapshot,
)
from jobtide.sources.taxonomy import default_skills, default_taxonomy
from jobtide.verification import oracles as O
from jobtide.verification import payloads
from jobtide.verification.postings import raw_postings, table


class Relations:
    """The relations over the test tables, each built when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @property
    def raw(self) -> DataFrame:
        return raw_postings(self.spark, self.sf_dir)

    def raw_dealt(self, dealt: tuple) -> DataFrame:
        """The postings with a column more, by which they are dealt to tasks."""
        return raw_postings(self.spark, self.sf_dir, dealt)

    @property
    def taxonomy(self) -> DataFrame:
        return default_taxonomy(self.spark)

    @property
    def stg(self) -> DataFrame:
        return staging.stg_jobs(self.raw)

    @property
    def latest(self) -> DataFrame:
        return staging.jobs_latest(self.raw)

    @property
    def fct(self) -> DataFrame:
        return marts.fct_job_postings(self.raw)

    @property
    def mentions(self) -> DataFrame:
        return staging.skill_mentions(self.raw, self.taxonomy)

    @property
    def fct_mentions(self) -> DataFrame:
        return marts.fct_skill_mentions(self.fct, self.taxonomy)

    @property
    def demand(self) -> DataFrame:
        fct = self.fct
        return marts.agg_skill_demand(marts.fct_skill_mentions(fct, self.taxonomy), fct)

    @property
    def benchmarks(self) -> DataFrame:
        return marts.agg_salary_benchmarks(self.fct)

    @property
    def trend(self) -> DataFrame:
        return marts.agg_skill_by_snapshot(self.stg)

    @property
    def stored_batch(self) -> DataFrame:
        """The postings with the types of the stored table."""
        return self.raw.withColumns(
            {
                "fetched_at": F.col("fetched_at").cast("timestamp"),
                "snapshot_date": F.col("snapshot_date").cast("string"),
            }
        ).select(*RAW.names)


@dataclass(frozen=True)
class Query:
    build: Callable[[Relations], DataFrame]
    oracle: str | None = None


QUERIES: dict[str, Query] = {}


def query(oracle: str | None = None):
    """Register the function under its name."""

    def register(build):
        QUERIES[build.__name__] = Query(build, oracle)
        return build

    return register


# --- models ------------------------------------------------------------------


@query(O.over(("stg",), "SELECT * FROM stg"))
def stg_jobs(r: Relations) -> DataFrame:
    return r.stg


@query(O.over(("stg",), "SELECT * FROM stg"))
def stg_jobs_from_text(r: Relations) -> DataFrame:
    """The same rows from a raw table that holds numbers, moments and dates as text."""
    texts = ("salary_min_usd", "salary_max_usd", "fetched_at", "snapshot_date")
    return staging.stg_jobs(r.raw.withColumns({c: F.col(c).cast("string") for c in texts}))


@query(O.over(("latest",), "SELECT * FROM latest"))
def jobs_latest(r: Relations) -> DataFrame:
    return r.latest


@query(O.over(("lifecycle",), "SELECT * FROM lifecycle"))
def job_lifecycle(r: Relations) -> DataFrame:
    return marts.job_lifecycle(r.raw)


@query(O.over(("fct",), "SELECT * FROM fct"))
def fct_job_postings(r: Relations) -> DataFrame:
    return r.fct


@query(O.over(("mentions",), "SELECT * FROM mentions"))
def skill_mentions(r: Relations) -> DataFrame:
    return r.mentions


@query(O.over(("fct_mentions",), "SELECT * FROM fct_mentions"))
def fct_skill_mentions(r: Relations) -> DataFrame:
    return r.fct_mentions


@query(O.over(("demand",), "SELECT * FROM demand"))
def agg_skill_demand(r: Relations) -> DataFrame:
    return r.demand


@query(O.over(("benchmarks",), "SELECT * FROM benchmarks"))
def agg_salary_benchmarks(r: Relations) -> DataFrame:
    return r.benchmarks


@query(O.over(("trend",), "SELECT * FROM trend"))
def agg_skill_by_snapshot(r: Relations) -> DataFrame:
    return r.trend


# --- reports -----------------------------------------------------------------


@query(
    O.over(
        ("demand",),
        """SELECT count(*) AS active_postings, (SELECT count(*) FROM demand) AS distinct_skills,
  count(salary_mid_usd) AS postings_with_salary,
  100.0 * count(salary_mid_usd) / count(*) AS with_salary_pct,
  quantile_cont(salary_mid_usd, 0.5) AS median_salary_usd,
  count(*) FILTER (WHERE globally_remote) AS globally_open FROM fct WHERE is_active""",
    )
)
def kpi_row(r: Relations) -> DataFrame:
    fct = r.fct
    mentions = marts.fct_skill_mentions(fct, r.taxonomy)
    return reports.kpi_row(fct, marts.agg_skill_demand(mentions, fct))


@query(O.over(("fct",), "SELECT role_family, count(*) AS n FROM fct WHERE is_active GROUP BY 1"))
def postings_by_family(r: Relations) -> DataFrame:
    return reports.postings_by_family(r.fct)


@query(O.over(("fct",), "SELECT seniority, count(*) AS n FROM fct WHERE is_active GROUP BY 1"))
def seniority_mix(r: Relations) -> DataFrame:
    return reports.seniority_mix(r.fct)


@query(
    O.over(
        ("fct",),
        """SELECT source, n, with_salary, round_even(with_salary / n * 100, 1) AS coverage
FROM (SELECT source, count(*) AS n, count(salary_mid_usd) AS with_salary FROM fct GROUP BY source) c""",
    )
)
def salary_coverage_by_source(r: Relations) -> DataFrame:
    return reports.salary_coverage_by_source(r.fct)


@query(O.over(("demand",), "SELECT * FROM demand ORDER BY n_jobs DESC, skill LIMIT 20"))
def top_skills(r: Relations) -> DataFrame:
    return reports.top_skills(r.demand)


@query(
    O.over(
        ("trend", "demand"),
        """SELECT * FROM trend WHERE skill IN
  (SELECT skill FROM demand ORDER BY n_jobs DESC, skill LIMIT 5)""",
    )
)
def top5_skill_trend(r: Relations) -> DataFrame:
    return reports.top_skill_trend(r.trend, r.demand)


@query(
    O.over(
        ("demand",),
        """SELECT * FROM demand WHERE median_salary_mid_usd IS NOT NULL
ORDER BY median_salary_mid_usd DESC, n_jobs DESC, skill LIMIT 14""",
    )
)
def skill_salary_top14(r: Relations) -> DataFrame:
    return reports.best_paid_skills(r.demand)


def _share_sql(order: str) -> str:
    return O.over(
        ("demand",),
        f"""SELECT skill, share_of_active_pct FROM demand
ORDER BY share_of_active_pct {order} NULLS LAST, skill LIMIT 15""",
    )


@query(_share_sql("ASC"))
def chart_skill_share_asc15(r: Relations) -> DataFrame:
    return reports.chart_skill_share(r.demand)


@query(_share_sql("DESC"))
def chart_skill_share_top15(r: Relations) -> DataFrame:
    return reports.chart_skill_share(r.demand, ascending=False)


@query(
    O.over(
        ("benchmarks",),
        """SELECT role_family || ' · ' || seniority AS grp,
  role_family || ' · ' || seniority || ' (n=' || n_postings || ')' AS label,
  p25_usd, median_usd, p75_usd,
  p25_usd / 1000 AS p25_k, median_usd / 1000 AS median_k, p75_usd / 1000 AS p75_k FROM benchmarks""",
    )
)
def salary_band_labels(r: Relations) -> DataFrame:
    return reports.salary_bands(r.benchmarks)


_EXPLORER = ", ".join(V.EXPLORER_COLUMNS)


@query(O.over(("fct",), f"SELECT {_EXPLORER} FROM fct WHERE is_active"))
def explorer(r: Relations) -> DataFrame:
    """The view as it opens: every active posting."""
    return reports.explorer(r.fct)


@query(
    O.over(
        ("fct",),
        f"""SELECT {_EXPLORER} FROM fct WHERE is_active AND globally_remote
  AND (regexp_matches(title, '(?i)engineer|y 1.$') OR regexp_matches(company, '(?i)engineer|y 1.$'))
  AND role_family IN ('Data Engineer', 'ML Engineer') AND seniority IN ('mid', 'senior')""",
    )
)
def explorer_filtered(r: Relations) -> DataFrame:
    return reports.explorer(
        r.fct,
        search="ENGINEER|y 1.$",
        families=["Data Engineer", "ML Engineer"],
        seniorities=["mid", "senior"],
        globally_open=True,
    )


@query(O.over(("fct",), "SELECT DISTINCT role_family FROM fct WHERE is_active"))
def family_choices(r: Relations) -> DataFrame:
    return reports.family_choices(r.fct)


@query(O.over(("raw",), "SELECT DISTINCT snapshot_date FROM raw"))
def snapshots_distinct(r: Relations) -> DataFrame:
    return reports.snapshots(r.raw)


@query(
    O.over(
        ("raw",),
        """SELECT count(*) AS total_rows, count(DISTINCT source || ':' || external_id) AS distinct_jobs,
  count(DISTINCT snapshot_date) AS snapshots, min(snapshot_date) AS first_snap,
  max(snapshot_date) AS latest_snap FROM raw""",
    )
)
def raw_stats(r: Relations) -> DataFrame:
    return reports.raw_stats(r.raw)


@query(O.over(("raw",), "SELECT source, count(*) AS n FROM raw GROUP BY source"))
def batch_counts_by_source(r: Relations) -> DataFrame:
    return reports.batch_counts(r.raw)


# --- data quality ------------------------------------------------------------


@query(
    O.over(
        ("stg",),
        "SELECT job_key AS value, count(*) AS n_records FROM stg GROUP BY 1 HAVING count(*) > 1",
    )
)
def dq_unique(r: Relations) -> DataFrame:
    """On staging, where a posting has a row per snapshot."""
    return quality.repeated_values(r.stg, "job_key")


@query(O.over(("stg",), "SELECT * FROM stg WHERE company IS NULL"))
def dq_not_null(r: Relations) -> DataFrame:
    return quality.null_rows(r.stg, "company")


@query(
    O.over(
        ("raw",),
        """SELECT title AS value, count(*) AS n_records FROM raw
WHERE title NOT IN ('Data Engineer', 'BI Developer') GROUP BY 1""",
    )
)
def dq_accepted_values(r: Relations) -> DataFrame:
    return quality.unaccepted_values(r.raw, "title", ["Data Engineer", "BI Developer"])


@query(
    O.over(
        ("trend", "skill_taxonomy"),
        "SELECT * FROM trend WHERE skill NOT IN (SELECT skill FROM skill_taxonomy)",
    )
)
def dq_relationships(r: Relations) -> DataFrame:
    """On the trend, which counts skills outside the taxonomy."""
    return quality.orphan_rows(r.trend, "skill", r.taxonomy, "skill")


@query(
    O.over(
        ("fct",),
        """SELECT job_key, title, salary_min_usd, salary_max_usd FROM fct
WHERE """
        + O.anomaly_sql(),
    )
)
def dq_salary_sanity(r: Relations) -> DataFrame:
    return quality.salary_anomalies(r.fct)


_LAST_FETCH = datetime(2026, 2, 16, 9)
_AGES = (8, 10, 17)


@query(
    O.over(
        ("raw",),
        """SELECT age AS age_limit_case, max_loaded_at, CAST(age AS DOUBLE) AS age_days,
  CASE age WHEN 8 THEN 'pass' WHEN 10 THEN 'warn' ELSE 'error' END AS status
FROM (SELECT max(fetched_at) AS max_loaded_at FROM raw) m, (VALUES (8), (10), (17)) a(age)""",
    )
)
def dq_freshness(r: Relations) -> DataFrame:
    """As of three fixed moments after the last fetch."""
    found = quality.freshness(r.raw, *[_LAST_FETCH + timedelta(days=age) for age in _AGES])
    return found.select(
        F.col("age_days").cast("int").alias("age_limit_case"), "max_loaded_at", "age_days", "status"
    )


_CHECKED = {
    "raw_job_postings": "raw",
    "stg_jobs": "stg",
    "fct_job_postings": "fct",
    "fct_skill_mentions": "fct_mentions",
    "agg_skill_demand": "demand",
    "agg_skill_by_snapshot": "trend",
}


def _columns(relation: str, *kinds: str) -> list[str]:
    found = [c.column for c in quality.CHECKS if c.relation == relation and c.kind in kinds]
    return list(dict.fromkeys(found))


def _planted(relation: str, df: DataFrame) -> DataFrame:
    """The relation with every row twice, once with nulls and once with odd values."""
    nulls = {
        c: F.lit(None).cast(df.schema[c].dataType) for c in _columns(relation, "not_null")
    }
    odd = {c: F.lit("odd") for c in _columns(relation, "accepted_values", "relationships")}
    return df.unionByName(df).unionByName(df.withColumns(nulls)).unionByName(df.withColumns(odd))


def _planted_sql(relation: str) -> str:
    name = _CHECKED[relation]
    nulls = ", ".join(f"NULL AS {c}" for c in _columns(relation, "not_null"))
    odd = ", ".join(f"'odd' AS {c}" for c in _columns(relation, "accepted_values", "relationships"))
    kinds = [f"SELECT * FROM {name}"] * 2 + [f"SELECT * REPLACE ({nulls}) FROM {name}"]
    kinds.append(f"SELECT * REPLACE ({odd}) FROM {name}" if odd else f"SELECT * FROM {name}")
    return "(" + " UNION ALL ".join(kinds) + ")"


def _summary_sql(relation) -> str:
    """All checks; ``relation`` gives the SQL of a checked relation."""
    parts = []
    for check in quality.CHECKS:
        name, column = relation(check.relation), check.column
        if check.kind == "not_null":
            failed = f"SELECT 1 FROM {name} x WHERE {column} IS NULL"
        elif check.kind == "unique":
            failed = f"""SELECT {column} FROM {name} x WHERE {column} IS NOT NULL
                GROUP BY 1 HAVING count(*) > 1"""
        elif check.kind == "accepted_values":
            accepted = ", ".join(map(O.quoted, check.accepted))
            failed = f"SELECT DISTINCT {column} FROM {name} x WHERE {column} NOT IN ({accepted})"
        elif check.kind == "relationships":
            failed = f"SELECT 1 FROM {name} x WHERE {column} NOT IN (SELECT skill FROM skill_taxonomy)"
        else:
            failed = f"SELECT 1 FROM {name} x WHERE {O.anomaly_sql()}"
        parts.append(
            f"SELECT '{check.name}' AS check_name, '{check.severity}' AS severity, "
            f"(SELECT count(*) FROM ({failed}) f) AS n_failed"
        )
    union = "\nUNION ALL\n".join(parts)
    return O.over(
        ("demand", "trend"),
        f"""SELECT *, CASE WHEN n_failed = 0 THEN 'pass' ELSE severity END AS status
FROM ({union}) c""",
    )


def _written(r: Relations) -> dict[str, DataFrame]:
    """All relations that checks read, as a build leaves them: raw table and marts are written."""
    folder = scratch_folder(r.spark)
    upsert_snapshot(r.stored_batch, f"{folder}/raw")
    raw = read_raw(r.spark, f"{folder}/raw")
    built = build.build_marts(raw, r.taxonomy, f"{folder}/marts")
    return {"raw_job_postings": raw, "skill_taxonomy": r.taxonomy, **build.views(raw), **built}


@query(_summary_sql(_CHECKED.__getitem__))
def dq_summary(r: Relations) -> DataFrame:
    """All 25 checks, on written marts."""
    return quality.summary(_written(r))


@query(_summary_sql(_planted_sql))
def dq_summary_planted(r: Relations) -> DataFrame:
    """All 25 checks where each has something to find."""
    relations = _written(r)
    planted = {name: _planted(name, relations[name]) for name in _CHECKED}
    return quality.summary(relations | planted)


# --- enrichment --------------------------------------------------------------


@query(
    O.over(
        ("raw",),
        f"""SELECT external_id, snapshot_date, salary_text,
  {O.salary_sql('salary_text', 'low')} AS low, {O.salary_sql('salary_text', 'high')} AS high FROM raw""",
    )
)
def salary_text_parse(r: Relations) -> DataFrame:
    bounds = numbers.salary_bounds(F.col("salary_text"))
    return r.raw.select("external_id", "snapshot_date", "salary_text", bounds.alias("b")).select(
        "external_id", "snapshot_date", "salary_text", "b.low", "b.high"
    )


@query(
    O.over(
        ("raw",),
        f"""SELECT external_id, snapshot_date, salary_num_text,
  {O.number_sql('salary_num_text')} AS number FROM raw""",
    )
)
def num_clean(r: Relations) -> DataFrame:
    return r.raw.select(
        "external_id",
        "snapshot_date",
        "salary_num_text",
        numbers.positive_number(F.col("salary_num_text")).alias("number"),
    )


@query(O.over(("raw",), f"SELECT * FROM raw WHERE {O.is_data_title_sql('title')}"))
def title_is_data_job(r: Relations) -> DataFrame:
    return r.raw.where(classify.is_data_title(F.col("title")))


@query(
    O.over(
        ("raw",),
        f"SELECT * FROM raw WHERE {O.is_data_title_sql('title')} OR contains(lower(tags), 'data')",
    )
)
def tags_or_title_filter(r: Relations) -> DataFrame:
    tags = text.split_list(F.col("tags"))
    return r.raw.where(classify.is_data_job(F.col("title"), tags))


def _titles_sql(name: str, sql: str) -> str:
    return O.over(
        ("raw",), f"SELECT external_id, snapshot_date, title, {sql} AS {name} FROM raw"
    )


@query(_titles_sql("seniority", O.seniority_sql("title")))
def classify_seniority(r: Relations) -> DataFrame:
    return r.raw.select(
        "external_id",
        "snapshot_date",
        "title",
        classify.seniority(F.col("title")).alias("seniority"),
    )


@query(_titles_sql("role_family", O.family_sql("title")))
def classify_family(r: Relations) -> DataFrame:
    return r.raw.select(
        "external_id",
        "snapshot_date",
        "title",
        classify.role_family(F.col("title")).alias("role_family"),
    )


@query(
    O.over(
        ("raw",),
        f"""SELECT external_id, snapshot_date, {O.skills_sql('hay')} AS found FROM
  (SELECT *, concat(title, chr(10), replace(tags, ';', ' '), chr(10),
     coalesce(description_text, '')) AS hay FROM raw) h""",
    )
)
def extract_skills(r: Relations) -> DataFrame:
    """Skills of every posting: title, tags and description."""
    found = skills.extract_skills(r.raw.drop("skills"), default_skills(), name="found")
    return found.select("external_id", "snapshot_date", "found")


def _document_skills(r: Relations, hay) -> DataFrame:
    found = skills.match_skills(r.table("documents"), hay, default_skills(), "found")
    return found.select("doc_id", text.join_list(F.col("found")).alias("found"))


@query(f"SELECT doc_id, {O.skills_sql('text')} AS found FROM documents")
def extract_skills_whole_text(r: Relations) -> DataFrame:
    """Skills over whole documents, whatever their length."""
    return _document_skills(r, F.col("text"))


@query(
    f"""SELECT doc_id, {O.skills_sql("concat(source, chr(10), lang, ' R', chr(10), text)")} AS found
FROM documents"""
)
def extract_skills_window(r: Relations) -> DataFrame:
    """As stored with a posting: title, tags and the whole text in one window."""
    tags = F.concat("lang", F.lit(";R"))
    return _document_skills(r, skills.haystack(F.col("source"), tags, F.col("text")))


@query(f"SELECT page_id, {O.clean_sql('html')} AS cleaned FROM pages")
def html_clean(r: Relations) -> DataFrame:
    """Whole pages as plain text."""
    return r.table("pages").select("page_id", text.clean_html(F.col("html")).alias("cleaned"))


@query(f"SELECT page_id, {O.clean_sql('html')} AS cleaned, '' AS tags FROM pages")
def html_clean_stored(r: Relations) -> DataFrame:
    """As stored with a posting: whole pages as descriptions, beside a NULL list."""
    return r.table("pages").select(
        "page_id",
        text.clean_html(F.col("html")).alias("cleaned"),
        text.join_list(F.lit(None).cast("array<string>")).alias("tags"),
    )


# --- sources and ingest ------------------------------------------------------


@query(O.REMOTEOK)
def source_remoteok(r: Relations) -> DataFrame:
    return boards.remoteok(payloads.remoteok(r.raw))


@query(O.JOBICY)
def source_jobicy(r: Relations) -> DataFrame:
    return boards.jobicy(payloads.jobicy(r.raw_dealt(payloads.BY_PAGE)))


@query(O.REMOTIVE)
def source_remotive(r: Relations) -> DataFrame:
    return boards.remotive(payloads.remotive_feeds(r.raw))


@query(O.ARBEITNOW)
def source_arbeitnow(r: Relations) -> DataFrame:
    return boards.arbeitnow(payloads.arbeitnow(r.raw))


@query(O.ARBEITNOW)
def source_arbeitnow_cut(r: Relations) -> DataFrame:
    """The board's jobs as large pages, which are cut at their elements."""
    folder = f"{scratch_folder(r.spark)}/arbeitnow"
    payloads.land_as_large_pages(payloads.arbeitnow(r.raw_dealt(payloads.BY_FILE)), "data", folder)
    return boards.arbeitnow(read_pages(r.spark, folder, "data", 1 << 20))


@query(O.ARBEITNOW)
def ingest_beside_failed_board(r: Relations) -> DataFrame:
    """What is stored of a good board when another one sends no JSON and the rest nothing."""
    folder, day = scratch_folder(r.spark), "2026-02-16"
    dealt = r.raw_dealt(payloads.BY_FILE)
    payloads.land_as_large_pages(payloads.arbeitnow(dealt), "data", f"{folder}/landing/{day}/arbeitnow")
    broken = r.raw.select(F.concat(F.lit("<p>"), F.max("title")).alias("value"))
    broken.write.text(f"{folder}/landing/{day}/jobicy")
    result = ingest.run_ingestion(
        r.spark, f"{folder}/landing", f"{folder}/raw", f"{folder}/archive", day, _LAST_FETCH, default_skills()
    )
    if set(result.counts) != {"arbeitnow"}:
        raise AssertionError(f"stored: {result.counts}")
    given = ("fetched_at", "snapshot_date", "skills", "seniority", "role_family")
    return read_raw(r.spark, f"{folder}/raw").drop(*given)


@query(O.DEDUPE)
def dedupe_first_wins(r: Relations) -> DataFrame:
    """First row per id over two overlapping feeds."""
    raw = r.raw.select(F.col("external_id").alias("id"), "title", "snapshot_date")
    early = raw.where("snapshot_date <= date'2026-01-19'").withColumn("feed", F.lit(0))
    late = raw.where("snapshot_date >= date'2026-01-12'").withColumn("feed", F.lit(1))
    return first_per_key(early.unionByName(late), ["id"], ["feed", "snapshot_date"])


_STORED = ", ".join(
    "CAST(snapshot_date AS VARCHAR) AS snapshot_date" if name == "snapshot_date" else name
    for name in RAW.names
)


def _unzoned(stored: DataFrame) -> DataFrame:
    """Stored rows with their moments as wall-clock time, which both engines print alike."""
    return stored.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))


_RERUN = """source IN ('remoteok', 'jobicy') AND snapshot_date =
  (SELECT max(snapshot_date) FROM raw)"""


def _rerun_sql(raw: str) -> str:
    return f"""SELECT * REPLACE (CASE WHEN {_RERUN.replace("raw", raw)} THEN concat(title, ' (updated)')
  ELSE title END AS title) FROM {raw}
  WHERE NOT ({_RERUN.replace("raw", raw)}) OR CAST(external_id AS BIGINT) % 3 <> 0"""


def _rerun(batch: DataFrame) -> DataFrame:
    """A second run of the last snapshot for two boards, with other titles and fewer rows."""
    last = batch.agg(F.max("snapshot_date")).scalar()
    return batch.where(
        (F.col("snapshot_date") == last)
        & F.col("source").isin("remoteok", "jobicy")
        & (F.col("external_id").cast("bigint") % 3 != 0)
    ).withColumn("title", F.concat("title", F.lit(" (updated)")))


@query(O.over(("raw",), f"SELECT {_STORED} FROM ({_rerun_sql('raw')}) r"))
def snapshot_upsert(r: Relations) -> DataFrame:
    """The stored table after a second run of the last snapshot that reached two boards.

    The second run has other titles, and fewer rows.
    """
    path = f"{scratch_folder(r.spark)}/raw"
    batch = r.stored_batch
    upsert_snapshot(batch, path)
    upsert_snapshot(_rerun(batch), path)
    return _unzoned(read_raw(r.spark, path))


@query(O.over(("raw",), f"SELECT {_STORED} FROM raw"))
def raw_table_by_name(r: Relations) -> DataFrame:
    """The raw table under a name, with partitions that came after the name."""
    folder = scratch_folder(r.spark)
    name = f"raw_{folder.rsplit('-', 1)[1]}"
    batch = r.stored_batch
    upsert_snapshot(batch.where("snapshot_date <= '2026-01-19'"), f"{folder}/raw")
    ensure_raw_table(r.spark, name, f"{folder}/raw")
    upsert_snapshot(batch.where("snapshot_date > '2026-01-19'"), f"{folder}/raw")
    ensure_raw_table(r.spark, name, f"{folder}/raw")
    return _unzoned(r.spark.table(name)).select(*RAW.names)


@query(
    O.over(
        ("raw",),
        f"""SELECT {_STORED} FROM raw WHERE snapshot_date < (SELECT max(snapshot_date) FROM raw)
  OR source = 'arbeitnow'""",
    )
)
def snapshot_archive(r: Relations) -> DataFrame:
    """The archive after the last day was written again with one board only."""
    path = f"{scratch_folder(r.spark)}/archive"
    batch = r.stored_batch
    archive_snapshot(batch, path)
    last = batch.agg(F.max("snapshot_date")).scalar()
    archive_snapshot(
        batch.where((F.col("snapshot_date") == last) & (F.col("source") == "arbeitnow")), path
    )
    return _unzoned(read_raw(r.spark, path))


@query(O.over(("fct",), "SELECT * FROM fct", raw=_rerun_sql("first_raw")))
def fct_incremental(r: Relations) -> DataFrame:
    """The fact table after four updates: early snapshots, the next two, and a second run.

    The second run takes versions away that had won, and changes others.
    """
    folder = scratch_folder(r.spark)
    batch = r.stored_batch
    steps = (
        batch.where("snapshot_date <= '2026-02-02'"),
        batch.where("snapshot_date = '2026-02-09'"),
        batch.where("snapshot_date = '2026-02-16'"),
        _rerun(batch),
    )
    for step in steps:
        upsert_snapshot(step, f"{folder}/raw")
        incremental.update(r.spark, f"{folder}/raw", f"{folder}/state")
    return incremental.fct_job_postings(r.spark, f"{folder}/state")


@query(O.over(("demand",), "SELECT * FROM demand"))
def published_demand(r: Relations) -> DataFrame:
    """A written mart as readers see it, after a build that its checks turned down.

    The raw table is written once, as for a deployed build: builds and checks read its columns
    instead of making each posting anew.
    """
    root = scratch_folder(r.spark)
    upsert_snapshot(r.stored_batch, f"{root}/raw")
    raw = read_raw(r.spark, f"{root}/raw")
    # The postings name some skills twice.
    checks = [c for c in quality.CHECKS if c.column != "mention_id"]
    build.publish(raw, r.taxonomy, root, checks)
    planted = raw.withColumn("title", F.when(F.col("source") != "jobicy", F.col("title")))
    try:
        build.publish(planted.where("source <> 'remotive'"), r.taxonomy, root, checks)
    except quality.QualityError:
        return build.published_marts(r.spark, root)["agg_skill_demand"]
    raise AssertionError("a mart with missing titles was published")
