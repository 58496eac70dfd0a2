"""Text expressions shared by the normalizers."""

import html
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide import fixed_values as V

# Python's whitespace also holds the four ASCII separators, Java's does not.
WHITESPACE = r"[\s\x1c-\x1f]"
# Runs of whitespace that are not a single space already.  One class begins the pattern, so that
# other characters are passed after one look.
_TO_COLLAPSE = rf"{WHITESPACE}(?:(?<=[^ ])|{WHITESPACE}){WHITESPACE}*+"


def java_regex(pattern: str) -> str:
    """A Python pattern as Spark should see it.

    Python matches ``\\b``, ``\\w``, ``\\s`` and case on all of Unicode; Java
    does so only under the ``U`` flag.
    """
    return "(?U)" + pattern


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(java_regex(pattern))


def strip(text: Column) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.regexp_replace(text, java_regex(rf"^{WHITESPACE}+|{WHITESPACE}+$"), "")


def default_if_empty(text: Column, default: Column | str) -> Column:
    """``default`` for NULL and for the empty text; blanks stay."""
    default = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(text, F.lit("")), default)


def join_list(items: Column) -> Column:
    """List to ``;``-joined text; a NULL list gives the empty text."""
    return F.concat_ws(V.LIST_SEPARATOR, items)


def split_list(text: Column) -> Column:
    """``;``-joined text to list; empty pieces stay."""
    return F.split(text, V.LIST_SEPARATOR, -1)


# A reference as Python reads it: by number, or by a name of up to 32 characters.
_REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32}+;?)"
# Names that texts are full of; ``&`` itself comes last.
_USUAL = ("nbsp;", "quot;", "gt;", "lt;", "amp;")
# An ampersand that begins another reference than those, or may.
_UNUSUAL = rf"&(?!(?:{'|'.join(_USUAL)})|[\t\n\f <&;]|\z)"
_REPLACEMENT = "\ufffd"
_LAST = 0x10FFFF


def _odd_numbers() -> dict[int, str]:
    """Numbers that do not stand for the character of that number, and what they stand for."""
    noncharacters = [plane * 0x10000 + low for plane in range(17) for low in (0xFFFE, 0xFFFF)]
    asked = [*range(0xA0), *range(0xFDD0, 0xFDF0), *noncharacters]
    return {n: found for n in asked if (found := html.unescape(f"&#{n};")) != chr(n)}


def _tables() -> Column:
    """What names (by first letter, as a map is searched from its start) and odd numbers stand for."""
    names: dict[str, dict[str, str]] = {}
    # The old ones, which need no semicolon, come first.
    for known in sorted(html5, key=lambda n: (n.rstrip(";") not in html5, n)):
        names.setdefault(known[0], {})[known] = html5[known]
    numbers = {str(n): text for n, text in _odd_numbers().items()}
    kind = "struct<names: map<string,map<string,string>>, numbers: map<string,string>>"
    return F.from_json(F.lit(json.dumps({"names": names, "numbers": numbers})), kind)


def _by_number(digits: Column, base: int, odd: Column) -> Column:
    """The character of a number, whose digits may be any number."""
    plain = F.regexp_replace(digits, "^0+", "")
    number = F.conv(F.concat(F.lit("0"), plain), base, 10).cast("int")
    character = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    small = (
        F.when((number > _LAST) | number.between(0xD800, 0xDFFF), _REPLACEMENT)
        .otherwise(F.coalesce(F.try_element_at(odd, number.cast("string")), character))
    )
    return F.when(F.length(plain) > 7, _REPLACEMENT).otherwise(small)


def _by_name(name: Column, names: Column) -> Column:
    """What a name stands for; of a longer text its longest beginning that is a name."""
    found = lambda x: F.try_element_at(F.try_element_at(names, F.substring(name, 1, 1)), x)
    # Only names without a semicolon can begin something else.
    longest = max(len(known) for known in html5 if not known.endswith(";"))
    starts = [
        F.when(F.length(name) > size, F.concat(found(F.substring(name, 1, size)), F.substring(name, size + 1, 33)))
        for size in range(longest, 1, -1)
    ]
    return F.coalesce(found(name), *starts)


def _decoded(reference: Column, tables: Column) -> Column:
    digits = F.regexp_extract(reference, "^&#[xX]?([0-9a-fA-F]+)", 1)
    usual = F.lit(None).cast("string")
    for name in _USUAL:
        usual = F.when(reference == f"&{name}", html5[name]).otherwise(usual)
    other = (
        F.when(reference.rlike("^&#[xX]"), _by_number(digits, 16, tables["numbers"]))
        .when(reference.startswith("&#"), _by_number(digits, 10, tables["numbers"]))
        .otherwise(F.coalesce(_by_name(F.substring(reference, 2, 33), tables["names"]), reference))
    )
    return F.coalesce(usual, other)


def unescape_entities(text: Column) -> Column:
    """Decode HTML entities as Python does, in the JVM.

    The names come from Python's own table when the plan is built.  Text without an ampersand is
    left alone, and one that holds none but the usual names is decoded by plain replacement:
    those stand for no letter, so no replacement makes a reference, and that of ``&`` is last.
    """
    references = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    # The tables once in the plan, and the references decoded once.
    decoded = lambda tables: F.transform(references, lambda r: _decoded(r, tables))
    between = F.split(text, _REFERENCE, -1)

    def joined(found: Column) -> Column:
        pieces = F.transform(between, lambda piece, i: F.concat(piece, F.coalesce(F.get(found, i), F.lit(""))))
        return F.array_join(pieces, "")

    found = F.transform(F.transform(F.array(_tables()), decoded), joined)[0]
    plain = text
    for name in _USUAL:
        plain = F.replace(plain, F.lit(f"&{name}"), F.lit(html5[name]))
    return F.when(~text.contains("&"), text).when(~text.rlike(_UNUSUAL), plain).otherwise(found)


def clean_html(text: Column, max_chars: int | None = None) -> Column:
    """Unescape, drop tags, collapse whitespace and strip.

    Entities are decoded first, so escaped tags are dropped as well.  NULL gives
    the empty text.  The whole text is kept unless ``max_chars`` is given.
    """
    spaced = F.regexp_replace(unescape_entities(text), V.HTML_TAG, " ")
    cleaned = F.trim(F.regexp_replace(spaced, java_regex(_TO_COLLAPSE), " "))
    if max_chars is not None:
        cleaned = F.substring(cleaned, 1, max_chars)
    return F.coalesce(cleaned, F.lit(""))
