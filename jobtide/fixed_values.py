"""Values the results depend on, stated plainly and in one place.

FIXED VALUES: every constant below must stay exactly as it is for the results
to be right.  Patterns are written as Python regular expressions; see
``functions.text.java_regex`` for how they are handed to Spark.
"""

# --- FIXED VALUES: boards and labels -----------------------------------------
SOURCES = ("remoteok", "jobicy", "remotive", "arbeitnow")
SENIORITIES = ("intern", "junior", "mid", "senior")
DEFAULT_SENIORITY = "mid"
ROLE_FAMILIES = (
    "Analytics Engineer",
    "ML Engineer",
    "Data Scientist",
    "BI Developer",
    "Data Analyst",
    "Data Engineer",
    "Other Data",
)
REMOTIVE_FEEDS = ("data", "software-dev")
DEFAULT_LOCATION = "worldwide"
UNKNOWN_LOCATION = "unknown"
REMOTEOK_URL_PREFIX = "https://remoteok.com/l/"

# --- FIXED VALUES: title patterns --------------------------------------------
DATA_TITLE = (
    r"(?i)\b(data\s?(analyst|scientist|engineer)|analytics|machine learning|ml "
    r"|business intelligence|\bbi\b|quantitative|statistic|etl|analytics "
    r"engineer|decision science|insights)\b"
)
SENIORITY_INTERN = r"\b(intern|trainee|apprentice)\b"
SENIORITY_JUNIOR = r"\b(junior|jr\.?|entry[- ]level|graduate)\b"
SENIORITY_SENIOR = r"\b(senior|sr\.?|staff|principal|lead|head of|manager|director)\b"
FAMILY_ML = r"machine learning|\bml\b|ai engineer"
FAMILY_BI = r"\bbi\b"

# --- FIXED VALUES: salary text -----------------------------------------------
SALARY_RANGE_K = r"(?i)\$?\s*(\d{2,3})\s*k\s*(?:-|–|to)\s*\$?\s*(\d{2,3})\s*k"
SALARY_SINGLE_K = r"(?i)\$\s*(\d{2,3})\s*k\b"
SALARY_FULL = r"(?i)\$\s*(\d{4,6})\b"
SALARY_FULL_MIN = 20000.0

# --- FIXED VALUES: text handling ---------------------------------------------
HTML_TAG = r"<[^>]+>"
LIST_SEPARATOR = ";"

# --- FIXED VALUES: location flags (ASCII word boundaries) --------------------
GLOBALLY_REMOTE = r"world|anywhere|global|earth|remote"
MENTIONS_PAKISTAN = r"pakistan|(?<![0-9A-Za-z_])pk(?![0-9A-Za-z_])"

# --- FIXED VALUES: marts, checks and reports ---------------------------------
SALARY_BAND = (20000, 600000)
MAX_SALARY_RATIO = 4
MIN_GROUP_SIZE = 2
FRESHNESS_WARN_DAYS = 9
FRESHNESS_ERROR_DAYS = 16
TREND_TOP_SKILLS = 5
TOP_SKILLS = 20
SALARY_TOP_SKILLS = 14
CHART_SKILLS = 15
EXPLORER_COLUMNS = (
    "title",
    "company",
    "location_text",
    "seniority",
    "role_family",
    "salary_min_usd",
    "salary_max_usd",
    "source",
    "posted_at",
    "url",
)
