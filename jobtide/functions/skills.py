"""Skill matching: a taxonomy of patterns against text, in one projection.

Every pattern is a literal of the plan, so it is compiled once per task and no
row is multiplied.  A regular expression run over a whole text costs about ten
times as much as a plain substring search, and most texts hold few of the
skills.  So each pattern runs only where a text it cannot match without occurs.
That changes the cost, never the result.

From ``MANY_PATTERNS`` on, the texts are not searched for one by one: one expression, which
shares their common beginnings, lists those that occur in a single pass over the text, and only
the patterns they belong to are run.  So a row costs about the same whether the taxonomy holds a
hundred patterns or thousands.
"""

import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions.text import java_regex, join_list


class Skill(NamedTuple):
    """One taxonomy row.  Case handling is part of the pattern."""

    skill: str
    category: str
    regex: str
    case_sensitive: int = 0


# The only characters outside ASCII that equal an ASCII letter when case is
# ignored: dotted and dotless i, long s, the Kelvin sign.
FOLDING = ("\u0130\u0131\u017f\u212a", "iisk")

_IGNORE_CASE = "(?i)"
_NO_WIDTH = re.compile(r"\(\?<?[=!][^()]*\)|\\b")
_BREAKS = re.compile(
    r"\([^()]*\)[?*+]?"  # a group
    r"|\\.[?*+]?"  # a class such as \w
    r"|.[?*]"  # an optional character
)
_PLAIN = re.compile(r"[A-Za-z0-9 /_-]+")


def required_texts(pattern: str) -> list[str] | None:
    """Texts of which a match always holds at least one, or None if unknown.

    One text per alternative: its longest plain run.  Anything out of the
    ordinary gives None, which only means that the pattern is always run.
    """
    body = pattern.removeprefix(_IGNORE_CASE)
    body = _NO_WIDTH.sub("", body)
    body = _BREAKS.sub("\0", body)
    if re.search(r"[^A-Za-z0-9 /_|\0-]", body):
        return None
    runs = [
        max(_PLAIN.findall(alternative), key=len, default="")
        for alternative in body.split("|")
    ]
    return runs if all(runs) else None


def _may_match(pattern: str, text: Column, lowered: Column) -> Column | None:
    runs = required_texts(pattern)
    if runs is None:
        return None
    if pattern.startswith(_IGNORE_CASE):
        found = [lowered.contains(run.lower()) for run in runs]
    else:
        found = [text.contains(run) for run in runs]
    gate = found[0]
    for other in found[1:]:
        gate = gate | other
    return gate


def _foldable(text: Column) -> Column:
    """Lower case, so that every match ignoring case is plain ASCII."""
    folds = reduce(lambda a, b: a | b, [text.contains(char) for char in FOLDING[0]])
    return F.lower(F.when(folds, F.translate(text, *FOLDING)).otherwise(text))


# Patterns from which one pass over the text pays.
MANY_PATTERNS = 200
# Shorter texts occur nearly everywhere, so they would tell nothing.
_SHORTEST = 3
_LOOKUP_CHARS = 2


def _starts_a_word(pattern: str, run: str) -> bool:
    """Whether every alternative that holds ``run`` begins a word with it."""
    body = pattern.removeprefix(_IGNORE_CASE)
    holders = [alternative for alternative in body.split("|") if run in alternative]
    return run[0].isalnum() and all(a.startswith(rf"\b{run}") for a in holders)


def any_of(texts: Iterable[str]) -> str:
    """A pattern for the longest of some texts that begins at a place.

    Texts share their common beginnings, so a place is left after a few characters.
    """
    root: dict = {}
    for text in texts:
        node = root
        for char in text:
            node = node.setdefault(char, {})
        node[""] = {}

    def written(node: dict) -> str:
        """Behind the node's character."""
        chain = ""
        while len(node) == 1 and "" not in node:
            ((char, node),) = node.items()
            chain += re.escape(char)
        ways = [re.escape(char) + written(kid) for char, kid in sorted(node.items()) if char]
        if not ways:
            return chain
        return chain + "(?:" + "|".join(ways) + ")" + ("?" if "" in node else "")

    return written(root)


def _looked_up(table: Column) -> Callable[[Column], Column]:
    return lambda hit: F.element_at(F.element_at(table, F.substring(hit, 1, _LOOKUP_CHARS)), hit)


class OnePass:
    """The texts that patterns cannot match without, and the patterns of each."""

    def __init__(self, skills: Sequence[Skill]):
        self.always: list[int] = []
        at_words, anywhere = defaultdict(set), defaultdict(set)
        for number, row in enumerate(skills):
            runs = required_texts(row.regex)
            if runs is None or min(map(len, runs)) < _SHORTEST and not all(
                len(run) >= _LOOKUP_CHARS and _starts_a_word(row.regex, run) for run in runs
            ):
                self.always.append(number)
                continue
            for run in runs:
                group = at_words if _starts_a_word(row.regex, run) else anywhere
                group[run.lower()].add(number)
        self.groups = [(r"\b", at_words), ("", anywhere)]

    def candidates(self, lowered: Column) -> Column:
        """Numbers of the patterns to run, in order."""
        found = [F.array(*map(F.lit, self.always)).cast("array<int>")]
        for before, texts in self.groups:
            if not texts:
                continue
            lookup = defaultdict(dict)
            for text in texts:
                # A text that begins with others says that those occur, too.
                starts = (texts[text[:end]] for end in range(1, len(text) + 1) if text[:end] in texts)
                lookup[text[:_LOOKUP_CHARS]][text] = sorted(set().union(*starts))
            # A map is searched from its start, so it is cut into small ones.
            table = F.from_json(F.lit(json.dumps(lookup)), "map<string, map<string, array<int>>>")
            pattern = java_regex(f"{before}(?=({any_of(texts)}))")
            hits = F.array_distinct(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1)))
            found.append(F.flatten(F.transform(hits, _looked_up(table))))
        return F.array_sort(F.array_distinct(F.concat(*found)))


def _match_many(df: DataFrame, text: Column, skills: Sequence[Skill], name: str) -> DataFrame:
    source = F.col("_text")
    patterns = F.from_json(F.lit(json.dumps([java_regex(s.regex) for s in skills])), "array<string>")
    names = F.from_json(F.lit(json.dumps([s.skill for s in skills])), "array<string>")
    found = F.filter("_candidates", lambda i: F.rlike(source, F.element_at(patterns, i + 1)))
    return (
        df.withColumn("_text", text)
        .withColumn("_lowered", _foldable(source))
        .withColumn("_candidates", OnePass(skills).candidates(F.col("_lowered")))
        .withColumn(name, F.transform(F.coalesce(found, F.array().cast("array<int>")), lambda i: F.element_at(names, i + 1)))
        .drop("_text", "_lowered", "_candidates")
    )


def match_skills(
    df: DataFrame, text: Column, skills: Iterable[Skill], name: str, many: int = MANY_PATTERNS
) -> DataFrame:
    """Add the list ``name``: skills found in ``text``, in taxonomy order.

    The text and its lower-case form are columns of their own projections, so
    they are computed once and not once per pattern.  A null text has no skills.
    """
    skills = list(skills)
    if len(skills) >= many:
        return _match_many(df, text, skills, name)
    source, lowered = F.col("_text"), F.col("_lowered")
    hits = []
    for row in skills:
        hit = source.rlike(java_regex(row.regex))
        gate = _may_match(row.regex, source, lowered)
        hits.append(F.when(hit if gate is None else gate & hit, F.lit(row.skill)))
    return (
        df.withColumn("_text", text)
        .withColumn("_lowered", _foldable(source))
        .withColumn(name, F.array_compact(F.array(*hits)))
        .drop("_text", "_lowered")
    )


def haystack(
    title: Column,
    tags: Column,
    text: Column,
    max_chars: int | None = None,
) -> Column:
    """Title, tags and the cleaned text, one per line.

    ``tags`` is the joined text.  The whole text counts unless ``max_chars`` is given.
    """
    empty = F.lit("")
    body = text if max_chars is None else F.substring(text, 1, max_chars)
    return F.concat(
        F.coalesce(title, empty),
        F.lit("\n"),
        F.replace(F.coalesce(tags, empty), F.lit(V.LIST_SEPARATOR), F.lit(" ")),
        F.lit("\n"),
        F.coalesce(body, empty),
    )


def extract_skills(
    df: DataFrame,
    skills: Iterable[Skill],
    max_chars: int | None = None,
    name: str = "skills",
) -> DataFrame:
    """Add the ``;``-joined skills of postings."""
    hay = haystack(F.col("title"), F.col("tags"), F.col("description_text"), max_chars)
    return match_skills(df, hay, skills, name).withColumn(name, join_list(F.col(name)))
