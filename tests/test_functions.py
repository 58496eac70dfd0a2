import html
import html.entities
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions import classify, numbers, skills, text
from jobtide.sources.boards import _industry_text, epoch_to_iso
from jobtide.sources.taxonomy import default_skills


def evaluate(spark, values, expression, dtype="string"):
    """One result per value, in order."""
    rows = [(i, value) for i, value in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {dtype}")
    out = df.select("i", expression(F.col("x")).alias("y")).collect()
    return [row.y for row in sorted(out, key=lambda row: row.i)]


SALARY_TEXTS = {
    "$90k-120k / year": (90000.0, 120000.0),
    "$60k - $80k": (60000.0, 80000.0),
    "60K to 80K": (60000.0, 80000.0),
    "50k–70k": (50000.0, 70000.0),
    "90k - 120k": (90000.0, 120000.0),
    "$85k+": (85000.0, 85000.0),
    "$45000 to $ 120000": (45000.0, 120000.0),
    "$120000 or $45000 or $3000": (45000.0, 120000.0),
    "85k": (None, None),
    "$999 or $5000": (None, None),
    "$90,000": (None, None),
    "$90-120k": (None, None),
    "competitive": (None, None),
    "": (None, None),
    None: (None, None),
    "€50k–€70k": (None, None),
}


def test_salary_bounds(spark):
    found = evaluate(spark, SALARY_TEXTS, numbers.salary_bounds)
    assert [tuple(row) for row in found] == list(SALARY_TEXTS.values())


NUMBERS = {
    "12": 12.0,
    "1e5": 100000.0,
    " 7.5 ": 7.5,
    ".5": 0.5,
    "1_000": 1000.0,
    "inf": float("inf"),
    "0": None,
    "-3": None,
    "nan": None,
    "": None,
    "abc": None,
    "12d": None,
    "0x1p3": None,
    "1__0": None,
    None: None,
}


def test_positive_number(spark):
    assert evaluate(spark, NUMBERS, numbers.positive_number) == list(NUMBERS.values())


def test_positive_number_of_long_text(spark):
    """No run of digits, however long, may fill the stack."""
    texts = ["0" * 100_000 + "85", "1_" * 100_000 + "1", "1_" * 100_000, "." + "0" * 100_000 + "1e100005", "9" * 100_000 + "x"]
    assert evaluate(spark, texts, numbers.positive_number) == [85.0, float("inf"), None, 1e4, None]


TITLES = {
    "Senior Data Analyst": ("senior", "Data Analyst"),
    "Analytics Engineer": ("mid", "Analytics Engineer"),
    "Machine Learning Lead": ("senior", "ML Engineer"),
    "Junior Data Scientist": ("junior", "Data Scientist"),
    "BI Developer": ("mid", "BI Developer"),
    "Data Engineer, Analytics": ("mid", "Data Engineer"),
    "Head of Insights": ("senior", "Other Data"),
    "Product Analyst (Intern)": ("intern", "Data Analyst"),
    "Staff ML Scientist, Data": ("senior", "ML Engineer"),
    "Sr. AI Engineer": ("senior", "ML Engineer"),
    "Marketing Analytics Manager": ("senior", "Data Analyst"),
    "Jr Data Analyst": ("junior", "Data Analyst"),
    "Senior Intern": ("intern", "Other Data"),
    "Entry-level Statistician": ("junior", "Other Data"),
    "Scientist, Data Platform": ("mid", "Data Scientist"),
    "Leadership Coach": ("mid", "Other Data"),
    "Internal Tools Engineer": ("mid", "Data Engineer"),
}


def test_title_classifiers(spark):
    assert evaluate(spark, TITLES, classify.seniority) == [s for s, _ in TITLES.values()]
    assert evaluate(spark, TITLES, classify.role_family) == [f for _, f in TITLES.values()]


def test_every_label_is_known(spark):
    assert {s for s, _ in TITLES.values()} == set(V.SENIORITIES)
    assert {f for _, f in TITLES.values()} == set(V.ROLE_FAMILIES)


DATA_TITLES = {
    "Data Analyst": True,
    "DataEngineer": True,
    "ML Engineer": True,
    "Head of Insights": True,
    "Data Analysts": False,
    "Data Engineering": False,
    "ML": False,
    "Lead ML": False,
    "Statistics tutor": False,
    "Statistician": False,
    "Backend dev": False,
}


def test_data_title(spark):
    assert evaluate(spark, DATA_TITLES, classify.is_data_title) == list(DATA_TITLES.values())


def test_tags_count_too(spark):
    tags = [["BigData"], ["sales", None], None, [], ["remote", "data"]]
    found = evaluate(spark, tags, classify.any_tag_mentions_data, "array<string>")
    assert found == [True, False, False, False, True]


def test_clean_html(spark):
    cases = {
        "Tom &amp; &lt;b&gt;x&lt;/b&gt; <p>y</p>&nbsp;z": "Tom & x y z",
        "  a\n\t<br/>\x1cb&eacute;&#33; ": "a bé!",
        "plain": "plain",
        "R&ampD": "R&D",
        "": "",
        None: "",
    }
    assert evaluate(spark, cases, text.clean_html) == list(cases.values())
    long = "ab " * 9000
    assert evaluate(spark, [long], text.clean_html) == [long.strip()]
    cut = evaluate(spark, [long], lambda x: text.clean_html(x, max_chars=12000))
    assert cut == [long[:12000]]


def test_entities_like_python(spark):
    """Every name with and without its end, in longer words, and numbers of all kinds."""
    names = sorted({n.rstrip(";") for n in html.entities.html5})
    values = [f"&{n};" for n in names] + [f"&{n}" for n in names] + [f"&{n}x;y" for n in names[::7]]
    numbers_ = [*range(0, 0x180), 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF, 0x110000, 10**7, 10**30]
    values += [f"&#{n};" for n in numbers_] + [f"&#x{n:X}" for n in numbers_] + [f"&#X{n:x};1" for n in numbers_]
    values += ["&", "&;", "&#;", "&#x;", "& amp;", "&&amp;;", "&#0000000000065;", "&a" * 40, "&" + "n" * 40, "&notit;", "&é&lt", "&#x1F600&#9;"]
    assert evaluate(spark, values, text.unescape_entities) == [html.unescape(v) for v in values]
    long = "a&amp;&#66;&nope " * 50_000
    assert evaluate(spark, [long, None], text.unescape_entities) == [html.unescape(long), None]


def test_no_worker_for_entities(spark):
    df = spark.createDataFrame([("a",)], "x string").select(text.clean_html(F.col("x")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan and "InArrow" not in plan


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(st.sampled_from("ab <>&;#x39amptlgquo/ \x1d\n\té"), max_size=40),
        min_size=20,
        max_size=40,
    )
)
def test_clean_html_like_python(spark, values):
    expected = [
        re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", html.unescape(v))).strip() for v in values
    ]
    assert evaluate(spark, values, text.clean_html) == expected


def test_strip_and_default(spark):
    values = ["  x\t ", "", None, "  "]
    assert evaluate(spark, values, text.strip) == ["x", "", None, ""]
    found = evaluate(spark, values, lambda x: text.default_if_empty(x, "d"))
    assert found == ["  x\t ", "d", "d", "  "]


def test_half_even(spark):
    values = [0.25, 0.35, 2.5, 66.66]
    found = evaluate(spark, values, lambda x: numbers.round_half_even(x, 1), "double")
    assert found == [0.2, 0.4, 2.5, 66.7]


def test_percent_of_nothing(spark):
    assert evaluate(spark, [0, 4], lambda x: numbers.percent(F.lit(1), x), "bigint") == [None, 25.0]


def test_epoch(spark):
    found = evaluate(spark, [1767600000, 1, None], epoch_to_iso, "bigint")
    assert found == ["2026-01-05T08:00:00+00:00", "1970-01-01T00:00:01+00:00", None]


def test_industry(spark):
    cases = {
        "Data Science": "Data Science",
        '["Data Science","BI"]': "['Data Science', 'BI']",
        "[]": "[]",
        None: "",
    }
    assert evaluate(spark, cases, _industry_text) == list(cases.values())


def found_skills(spark, values, rows=None, **many):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    out = skills.match_skills(df, F.col("x"), rows or default_skills(), "found", **many).collect()
    return [row.found for row in sorted(out, key=lambda row: row.i)]


def python_skills(value):
    return [s.skill for s in default_skills() if re.search(s.regex, value)]


def test_skill_example(spark):
    row = ("Analyst", "remote;data", "We use SQL, R and JavaScript; Power BI, github")
    df = spark.createDataFrame([row], "title string, tags string, description_text string")
    assert skills.extract_skills(df, default_skills()).first().skills == "SQL;R;Power BI;Git"


def test_skill_window(spark):
    row = ("", "", "x" * 5998 + " sql sql")
    df = spark.createDataFrame([row], "title string, tags string, description_text string")
    assert skills.extract_skills(df, default_skills()).first().skills == "SQL"
    assert skills.extract_skills(df, default_skills(), max_chars=6000).first().skills == ""


WORDS = [
    "sql", "SQL", "python", "R", "r", "Java", "JavaScript", "dbt", "pyspark", "Spark", "big query",
    "postgresql", "postgres", "power bi", "powerbi", "git", "github", "scikit-learn", "sklearn",
    "a/b test", "ab tests", "ab testings", "statistic", "data modelling", "dashboards", "llms",
    "gen ai", "genai", "data storytelling", "data storytelié", "semantic layer", "éR", "sqlé",
    "ſql", "AİRFLOW", "Kafka", "k8s", "excel", "excellent", "data contracts",
]
SEPARATORS = [" ", "\n", ", ", "-", "_", "", "/", "é", " ", ";"]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.lists(st.tuples(st.sampled_from(WORDS), st.sampled_from(SEPARATORS)), max_size=8),
        min_size=60,
        max_size=60,
    )
)
def test_skills_like_python(spark, drawn):
    values = ["".join(a + b for a, b in pairs) for pairs in drawn]
    assert found_skills(spark, values) == [python_skills(v) for v in values]
    assert found_skills(spark, values, many=1) == [python_skills(v) for v in values]


def test_one_pass_over_thousands_of_patterns(spark):
    """Texts that begin with, overlap and hold one another; patterns without any."""
    made = [skills.Skill(f"s{i}", "c", rf"(?i)\b{w}{i % 40}\b") for i, w in enumerate(["data", "dat", "model", "da ta"] * 60)]
    made += [skills.Skill(f"n{i}", "c", rf"(?i)ata{i}|\bmodel{i}x\b") for i in range(40)]
    made += [skills.Skill("any", "c", r"(?i)[0-9]{3}"), skills.Skill("two", "c", r"\bGX\b"), skills.Skill("r", "c", r"R")]
    made += default_skills()
    rng = random.Random(2)
    words = ["data", "dat", "model", "da ta", "ata", "GX", "gx", "R", "sql", "é", "_", "x"]
    values = ["".join(rng.choice(words) + rng.choice(["", " ", "7", "12", "39", "-"]) for _ in range(30)) for _ in range(60)]
    assert len(made) >= skills.MANY_PATTERNS
    expected = [[s.skill for s in made if re.search(s.regex, v)] for v in values]
    assert found_skills(spark, values, made) == expected == found_skills(spark, values, made, many=10**6)
    assert found_skills(spark, ["", None], made) == [[], []]
    assert found_skills(spark, ["sql"], [skills.Skill("any", "c", "[0-9]")] * 300) == [[]]


@pytest.mark.parametrize("word", WORDS)
def test_required_text_is_in_every_match(word):
    for skill in default_skills():
        match = re.search(skill.regex, word)
        needed = skills.required_texts(skill.regex)
        if match and needed and word.isascii():
            held = match.group()
            if skill.regex.startswith("(?i)"):
                held, needed = held.lower(), [text.lower() for text in needed]
            assert any(text in held for text in needed)


def test_unusual_patterns_are_always_run(spark):
    assert skills.required_texts(r"(?i)colou?r+") is None
    assert skills.required_texts(r"[Dd]ata") is None
    assert skills.required_texts(r"(?i)(a|b)") is None
    assert skills.required_texts(r"a|(b)") is None
    assert skills.required_texts(r"((x)y)z") is None
    rows = [skills.Skill("n", "c", r"(?i)[0-9]{3}"), skills.Skill("m", "c", "a.c")]
    assert found_skills(spark, ["x123", "abc", "12"], rows) == [["n"], ["m"], []]
