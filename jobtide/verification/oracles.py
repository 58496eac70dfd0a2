"""DuckDB statements whose rows the Spark queries must equal.

Each statement is a chain of common table expressions over the test tables; only
the relations a query needs are put in front of it.
"""

import re

from jobtide import fixed_values as V
from jobtide.functions.skills import Skill
from jobtide.sources.taxonomy import default_skills
from jobtide.verification.postings import raw_postings_sql

# RE2 knows no lookaround, and its \b sees ASCII only.
_BEFORE = r"(?:^|[^\pL\pN_])"
_AFTER = r"(?:$|[^\pL\pN_])"
_WITHOUT_LOOKAROUND = {
    "R": "(^|[^A-Za-z])R([^A-Za-z]|$)",
    "Java": r"(?i)\bjava\b",
    "Git": r"(?i)\bgit\b|\bgithub\b",
}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def re2(skill: Skill) -> str:
    pattern = _WITHOUT_LOOKAROUND.get(skill.skill, skill.regex)
    pattern = re.sub(r"(^|\(\?i\)|\|)\\b", lambda m: m.group(1) + _BEFORE, pattern)
    return pattern.replace(r"\b", _AFTER)


def skills_sql(hay: str) -> str:
    """The ``;``-joined skills found in a column."""
    cases = ",\n".join(
        f"CASE WHEN regexp_matches({hay}, {quoted(re2(s))}) THEN {quoted(s.skill)} END"
        for s in default_skills()
    )
    return f"array_to_string([s FOR s IN [{cases}] IF s IS NOT NULL], ';')"


def number_sql(text: str) -> str:
    """Text to a number above zero, or NULL."""
    value = f"try_cast({text} AS DOUBLE)"
    return f"CASE WHEN {value} > 0 AND NOT isnan({value}) THEN {value} END"


def salary_sql(text: str, bound: str) -> str:
    """One bound of a salary text."""
    group, pick = (1, "list_min") if bound == "low" else (2, "list_max")
    rng, one, full = map(quoted, (V.SALARY_RANGE_K, V.SALARY_SINGLE_K, V.SALARY_FULL))
    amounts = f"""[CAST(x AS DOUBLE) FOR x IN regexp_extract_all({text}, {full}, 1)
        IF CAST(x AS DOUBLE) >= {V.SALARY_FULL_MIN}]"""
    return f"""CASE WHEN regexp_matches({text}, {rng})
        THEN CAST(regexp_extract({text}, {rng}, {group}) AS DOUBLE) * 1000
        WHEN regexp_matches({text}, {one})
        THEN CAST(regexp_extract({text}, {one}, 1) AS DOUBLE) * 1000
        ELSE {pick}({amounts}) END"""


def is_data_title_sql(title: str) -> str:
    return f"regexp_matches({title}, {quoted(V.DATA_TITLE)})"


def seniority_sql(title: str) -> str:
    t = f"lower({title})"
    return f"""CASE WHEN regexp_matches({t}, {quoted(V.SENIORITY_INTERN)}) THEN 'intern'
        WHEN regexp_matches({t}, {quoted(V.SENIORITY_JUNIOR)}) THEN 'junior'
        WHEN regexp_matches({t}, {quoted(V.SENIORITY_SENIOR)}) THEN 'senior' ELSE 'mid' END"""


def family_sql(title: str) -> str:
    t = f"lower({title})"
    return f"""CASE WHEN contains({t}, 'analytics engineer') THEN 'Analytics Engineer'
        WHEN regexp_matches({t}, {quoted(V.FAMILY_ML)}) THEN 'ML Engineer'
        WHEN contains({t}, 'scientist') AND contains({t}, 'data') THEN 'Data Scientist'
        WHEN contains({t}, 'business intelligence')
          OR regexp_matches({t}, {quoted(V.FAMILY_BI)}) THEN 'BI Developer'
        WHEN contains({t}, 'analyst') THEN 'Data Analyst'
        WHEN contains({t}, 'engineer') THEN 'Data Engineer'
        WHEN contains({t}, 'analytics') THEN 'Data Analyst' ELSE 'Other Data' END"""


_SPACE = r"[\s\v\x1c-\x1f\x{0085}\pZ]+"


def clean_sql(text: str) -> str:
    """Decode the entities that occur, drop tags, collapse whitespace."""
    for entity, character in (
        ("&quot;?", '"'),
        ("&copy;?", "©"),
        ("&middot;?", "·"),
        ("&nbsp;?", " "),
        ("&lt;?", "<"),
        ("&gt;?", ">"),
        ("&amp;?", "&"),
    ):
        text = f"regexp_replace({text}, '{entity}', '{character}', 'g')"
    text = f"regexp_replace({text}, '{V.HTML_TAG}', ' ', 'g')"
    return f"trim(regexp_replace({text}, '{_SPACE}', ' ', 'g'))"


def anomaly_sql() -> str:
    """Salaries outside the band, inverted, or too wide apart."""
    low, high = V.SALARY_BAND
    return f"""salary_min_usd < {low} OR salary_max_usd > {high}
  OR salary_min_usd > salary_max_usd OR salary_max_usd > salary_min_usd * {V.MAX_SALARY_RATIO}"""


def stripped_sql(text: str) -> str:
    return f"trim(coalesce({text}, ''))"


def _taxonomy_sql() -> str:
    rows = ",\n".join(
        f"({i}, {quoted(s.skill)}, {quoted(s.category)})" for i, s in enumerate(default_skills())
    )
    return f"SELECT skill, category FROM (VALUES {rows}) v(i, skill, category)"


_RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": ((), raw_postings_sql()),
    "skill_taxonomy": ((), _taxonomy_sql()),
    "stg": (
        ("raw",),
        r"""SELECT md5(source || ':' || external_id) AS job_key, source, external_id,
  trim(title) AS title, trim(company) AS company,
  CASE WHEN trim(location_text) <> '' THEN trim(location_text) ELSE 'unknown' END AS location_text,
  tags, description_text, skills, seniority, role_family, salary_min_usd, salary_max_usd,
  salary_source, try_cast(posted_at AS TIMESTAMP) AS posted_at, url, fetched_at, snapshot_date,
  regexp_matches(lower(raw.location_text), 'world|anywhere|global|earth|remote') AS globally_remote,
  regexp_matches(lower(raw.location_text), 'pakistan|\bpk\b') AS mentions_pakistan
FROM raw""",
    ),
    "latest": (
        ("stg",),
        """SELECT * EXCLUDE (version) FROM (SELECT *, row_number() OVER (PARTITION BY job_key
  ORDER BY fetched_at DESC, snapshot_date DESC) AS version FROM stg) v WHERE version = 1""",
    ),
    "lifecycle": (
        ("stg",),
        """SELECT job_key, min(snapshot_date) AS first_seen_date, max(snapshot_date) AS last_seen_date,
  count(DISTINCT snapshot_date) AS snapshots_present FROM stg GROUP BY job_key""",
    ),
    "fct": (
        ("latest", "lifecycle"),
        """SELECT job_key, source, external_id, title, company, location_text, seniority, role_family,
  salary_min_usd, salary_max_usd, salary_source,
  round((salary_min_usd + salary_max_usd) / 2.0, 0) AS salary_mid_usd,
  globally_remote, mentions_pakistan, posted_at, url, tags, skills, first_seen_date, last_seen_date,
  snapshots_present, CAST(greatest(last_seen_date - first_seen_date, 0) AS BIGINT)
    AS days_listed_observed,
  last_seen_date = (SELECT max(snapshot_date) FROM stg) AS is_active
FROM latest a JOIN lifecycle b USING (job_key)""",
    ),
    "mentions": (
        ("latest", "skill_taxonomy"),
        """SELECT md5(job_key || '::' || e.skill) AS mention_id, job_key, e.skill,
  category AS skill_category
FROM (SELECT job_key, trim(piece) AS skill
      FROM (SELECT job_key, unnest(string_split(skills, ';')) AS piece FROM latest
            WHERE skills <> '') p) e JOIN skill_taxonomy t ON t.skill = e.skill""",
    ),
    "fct_mentions": (
        ("mentions", "fct"),
        """SELECT mention_id, job_key, skill, skill_category, role_family, seniority, salary_mid_usd,
  globally_remote, is_active, first_seen_date FROM mentions m JOIN fct f USING (job_key)""",
    ),
    "demand": (
        ("fct_mentions",),
        f"""SELECT skill, skill_category, count(*) AS n_jobs,
  round(100.0 * count(*) / (SELECT count(*) FROM fct WHERE is_active), 1) AS share_of_active_pct,
  round(quantile_cont(salary_mid_usd, 0.5), 0) AS median_salary_mid_usd,
  count(salary_mid_usd) AS n_with_salary
FROM fct_mentions WHERE is_active GROUP BY skill, skill_category HAVING count(*) >= {V.MIN_GROUP_SIZE}""",
    ),
    "benchmarks": (
        ("fct",),
        f"""SELECT role_family, seniority, count(*) AS n_postings,
  round(quantile_cont(salary_mid_usd, 0.25), 0) AS p25_usd,
  round(quantile_cont(salary_mid_usd, 0.5), 0) AS median_usd,
  round(quantile_cont(salary_mid_usd, 0.75), 0) AS p75_usd
FROM fct WHERE salary_mid_usd BETWEEN {V.SALARY_BAND[0]} AND {V.SALARY_BAND[1]}
GROUP BY role_family, seniority HAVING count(*) >= {V.MIN_GROUP_SIZE}""",
    ),
    "trend": (
        ("stg",),
        """SELECT snapshot_date, trim(piece) AS skill, count(*) AS n_jobs
FROM (SELECT snapshot_date, unnest(string_split(skills, ';')) AS piece FROM stg WHERE skills <> '') p
GROUP BY ALL""",
    ),
}


def _needed(relation: str, found: dict[str, str]) -> None:
    inputs, text = _RELATIONS[relation]
    for name in inputs:
        _needed(name, found)
    found.setdefault(relation, text)


def over(relations: tuple[str, ...], select: str, raw: str | None = None) -> str:
    """``select`` with the relations it reads in front of it.

    ``raw`` is what to read from ``first_raw`` in place of the raw table as it is.
    """
    found: dict[str, str] = {}
    for relation in relations:
        _needed(relation, found)
    if raw:
        found = {"first_raw": found["raw"]} | found | {"raw": raw}
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in found.items())
    return f"WITH {ctes}\n{select}" if ctes else select


def _record_sql(**columns: str) -> str:
    html = """concat('<p>', coalesce(description_text, ''), '</p>\n\n<ul><li>R&amp;D</li></ul> ',
      '&lt;b&gt;apply&lt;/b&gt;&nbsp;now &quot;', source, '&quot; ')"""
    html = columns.pop("description", "{html}").replace("{html}", html)
    where = columns.pop("where")
    rows = columns.pop("rows", "raw")
    columns = {
        "company": stripped_sql("company"),
        "title": stripped_sql("title"),
        "tags": "tags",
        "description_text": clean_sql(html),
        "url": "url",
        **columns,
    }
    listed = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return over(("raw",), f"SELECT {listed} FROM {rows} WHERE {where}")


_JOB_ID = "concat(external_id, '-', CAST(snapshot_date AS STRING))"
_TAGS_OR_TITLE = f"({is_data_title_sql('title')} OR contains(lower(tags), 'data'))"


def _location_sql(default: str) -> str:
    return f"trim(CASE WHEN location_text <> '' THEN location_text ELSE {default} END)"


REMOTEOK = _record_sql(
    source="'remoteok'",
    external_id=_JOB_ID,
    location_text=_location_sql("'worldwide'"),
    description="concat(title, ' ', {html})",
    salary_min_usd=number_sql("salary_num_text"),
    salary_max_usd="salary_max_usd",
    salary_source="'api'",
    posted_at="posted_at",
    url=f"CASE WHEN url LIKE '%3' THEN concat('{V.REMOTEOK_URL_PREFIX}', {_JOB_ID}) ELSE url END",
    where=_TAGS_OR_TITLE,
)
JOBICY = _record_sql(
    source="'jobicy'",
    external_id="external_id",
    location_text=_location_sql("'worldwide'"),
    tags="concat(tags, ';', role_family)",
    salary_min_usd="salary_min_usd",
    salary_max_usd=number_sql("salary_num_text"),
    salary_source="'api'",
    posted_at="posted_at",
    where=is_data_title_sql("concat(title, ' ', role_family)"),
)
_FIRST_WINS = """(SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY feed, snapshot_date) AS nth
  FROM (SELECT *, 0 AS feed FROM raw WHERE snapshot_date <= DATE '2026-01-19'
        UNION ALL
        SELECT *, 1 AS feed FROM raw WHERE snapshot_date >= DATE '2026-01-12') u) d"""
REMOTIVE = _record_sql(
    source="'remotive'",
    external_id="external_id",
    location_text=_location_sql("'worldwide'"),
    tags="seniority",
    salary_min_usd=salary_sql("salary_text", "low"),
    salary_max_usd=salary_sql("salary_text", "high"),
    salary_source="'parsed_text'",
    posted_at="CAST(snapshot_date AS STRING)",
    rows=_FIRST_WINS,
    where=f"nth = 1 AND {is_data_title_sql('title')}",
)
ARBEITNOW = _record_sql(
    source="'arbeitnow'",
    external_id=_JOB_ID,
    location_text=_location_sql("CASE WHEN CAST(external_id AS BIGINT) % 2 = 0 THEN 'remote' ELSE '' END"),
    salary_min_usd="CAST(NULL AS DOUBLE)",
    salary_max_usd="CAST(NULL AS DOUBLE)",
    salary_source="CAST(NULL AS VARCHAR)",
    posted_at="""CASE WHEN CAST(external_id AS BIGINT) % 7 <> 0 THEN strftime(TIMESTAMP '1970-01-01'
      + to_seconds(1767600000 + CAST(external_id AS BIGINT)), '%Y-%m-%dT%H:%M:%S+00:00') END""",
    where=_TAGS_OR_TITLE,
)
DEDUPE = over(
    ("raw",),
    f"""SELECT external_id AS id, CAST(feed AS INTEGER) AS feed, title, snapshot_date
FROM {_FIRST_WINS} WHERE nth = 1""",
)
