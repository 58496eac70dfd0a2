"""Fixed schemas, so that no type is ever inferred from a first batch."""

from pyspark.sql import types as T

S, D, B = T.StringType(), T.DoubleType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


RAW = _struct(
    ("source", S),
    ("external_id", S),
    ("title", S),
    ("company", S),
    ("location_text", S),
    ("tags", S),
    ("description_text", S),
    ("salary_min_usd", D),
    ("salary_max_usd", D),
    ("salary_source", S),
    ("posted_at", S),
    ("url", S),
    ("fetched_at", T.TimestampType()),
    ("snapshot_date", S),
    ("skills", S),
    ("seniority", S),
    ("role_family", S),
)

TAXONOMY = _struct(
    ("skill", S),
    ("category", S),
    ("regex", S),
    ("case_sensitive", T.IntegerType()),
)

FCT_JOB_POSTINGS = _struct(
    ("job_key", S),
    ("source", S),
    ("external_id", S),
    ("title", S),
    ("company", S),
    ("location_text", S),
    ("seniority", S),
    ("role_family", S),
    ("salary_min_usd", D),
    ("salary_max_usd", D),
    ("salary_source", S),
    ("salary_mid_usd", D),
    ("globally_remote", B),
    ("mentions_pakistan", B),
    ("posted_at", T.TimestampNTZType()),
    ("url", S),
    ("tags", S),
    ("skills", S),
    ("first_seen_date", T.DateType()),
    ("last_seen_date", T.DateType()),
    ("snapshots_present", T.LongType()),
    ("days_listed_observed", T.LongType()),
    ("is_active", B),
)

FCT_SKILL_MENTIONS = _struct(
    ("mention_id", S),
    ("job_key", S),
    ("skill", S),
    ("skill_category", S),
    ("role_family", S),
    ("seniority", S),
    ("salary_mid_usd", D),
    ("globally_remote", B),
    ("is_active", B),
    ("first_seen_date", T.DateType()),
)

AGG_SKILL_DEMAND = _struct(
    ("skill", S),
    ("skill_category", S),
    ("n_jobs", T.LongType()),
    ("share_of_active_pct", D),
    ("median_salary_mid_usd", D),
    ("n_with_salary", T.LongType()),
)

AGG_SALARY_BENCHMARKS = _struct(
    ("role_family", S),
    ("seniority", S),
    ("n_postings", T.LongType()),
    ("p25_usd", D),
    ("median_usd", D),
    ("p75_usd", D),
)

AGG_SKILL_BY_SNAPSHOT = _struct(
    ("snapshot_date", T.DateType()),
    ("skill", S),
    ("n_jobs", T.LongType()),
)

MARTS = {
    "fct_job_postings": FCT_JOB_POSTINGS,
    "fct_skill_mentions": FCT_SKILL_MENTIONS,
    "agg_skill_demand": AGG_SKILL_DEMAND,
    "agg_salary_benchmarks": AGG_SALARY_BENCHMARKS,
    "agg_skill_by_snapshot": AGG_SKILL_BY_SNAPSHOT,
}

# Landed payloads: only the fields that are read, all as text because the boards
# mix JSON types; sources.payloads makes sense of lists and flags.
REMOTEOK_JOB = _struct(
    ("id", S),
    ("position", S),
    ("company", S),
    ("location", S),
    ("tags", S),
    ("description_generic", S),
    ("salary_min", S),
    ("salary_max", S),
    ("date", S),
    ("url", S),
)

JOBICY_JOB = _struct(
    ("id", S),
    ("jobTitle", S),
    ("jobIndustry", S),
    ("companyName", S),
    ("jobGeo", S),
    ("jobType", S),
    ("jobDescription", S),
    ("annualSalaryMin", S),
    ("annualSalaryMax", S),
    ("pubDate", S),
    ("url", S),
)

REMOTIVE_JOB = _struct(
    ("id", S),
    ("title", S),
    ("company_name", S),
    ("candidate_required_location", S),
    ("category", S),
    ("description", S),
    ("salary", S),
    ("publication_date", S),
    ("url", S),
)

ARBEITNOW_JOB = _struct(
    ("slug", S),
    ("title", S),
    ("company_name", S),
    ("location", S),
    ("remote", S),
    ("tags", S),
    ("description", S),
    ("created_at", S),
    ("url", S),
)
