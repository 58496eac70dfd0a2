"""Surrogates for personal data, in DataFrame functions only.

Mentions are found by patterns.  Every distinct entity gets a surrogate drawn from a keyed hash:
same kind, script, gender and format, and the same wherever it is named, so that references still
hold together.  Surrogates are checked over the whole corpus: two entities never share one, and
none is an entity that occurs; who collides draws again.

A phone number, card or other number is one entity in whatever way it is punctuated, and each
mention keeps its own punctuation; a number that fails the card checksum is no card.  The local
part and the host of an address are entities of their own, so addresses of one host keep one.

Names are replaced word by word (``Mr Gray``, ``Paul Gray`` share a surname).  A title shows that
they are names and gives the gender of the given name, which is the first of several words.  In
the same document their words are then replaced wherever they stand capitalised, with or without
a title, and a word that is a given name once is one in all its mentions.
"""

import secrets
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import let, settle, unused, workspace

MALE = r"Mr|Sir|Herrn?|Monsieur|Señor|Sr|Господин|г-н|Κύριος|Κος"
FEMALE = r"Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Mademoiselle|Señora|Señorita|Sra|Srta|Госпожа|г-жа|Κυρία|Κα"
# Repeated groups are possessive: the engine then goes through them in a loop, not in calls.
_WORD = r"\p{Lu}[\p{L}\p{M}]*+(?:['’-]\p{Lu}[\p{L}\p{M}]*+)*+"
_LABEL = r"[\p{L}\p{N}]++(?:-++[\p{L}\p{N}]++)*+"
_START = r"(?<![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# Kind, pattern, and the text that a mention cannot do without, in order of precedence.
KINDS = (
    ("secret", r"""(?<![\p{L}\p{N}])(?i:api[_-]?key|access[_-]?key|secret|token|passw(?:or)?d|pwd)["']?\s*[=:]\s*["']?[A-Za-z0-9_+/=.~!@#$%^&*-]{6,}"""),
    ("email", rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}._%+-]*+@{_LABEL}(?:\.{_LABEL})++"),
    ("iban", r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"),
    ("ipv6", r"(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]*[0-9])(?!(?:[0-9A-Fa-f]*:){9})(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\p{L}\p{N}:]|\.[0-9])"),
    ("mac", r"(?<![\p{L}\p{N}:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![\p{L}\p{N}:-])"),
    ("ipv4", rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.[0-9])"),
    ("ssn", r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])"),
    ("card", r"(?<![\p{L}\p{N}-])(?:[3-6][0-9]{3}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720))[ -]?(?:[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}|[0-9]{6}[ -]?[0-9]{5})(?![\p{L}\p{N}])"),
    ("phone", r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,4}|(?<!\()\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![\p{L}\p{N}])"),
    ("hex", r"(?<![\p{L}\p{N}])(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{32,}(?![\p{L}\p{N}])"),
    ("name", rf"{_START}(?:{MALE}|{FEMALE})\.? +{_WORD}(?: {_WORD}){{0,3}}"),
)
_ANY = "|".join(f"(?:{pattern})" for _, pattern in KINDS)
# Texts without these hold no mention; the search for them is cheap.
_GATE = r"[0-9@]|(?i:key|secret|token|passw|pwd)"
_TITLES = [*MALE.replace("Herrn?", "Herr").split("|"), *FEMALE.split("|")]

# Letters that stand for the sixteen hexadecimal digits, by script; of other scripts, Latin ones.
LATIN = "abcdefghiklmnrst"
SCRIPTS = {
    "Cyrillic": "абвгдежзиклмнорс",
    "Greek": "αβγδεζηικλμνορστ",
    "Hebrew": "אבגדהוזחטיכלמנסע",
    "Arabic": "ابتجحدرزسصعفقكلم",
    "Devanagari": "अआइउकखगचजटडतदनपम",
    "Thai": "กขคงจชดตทนบปพมรล",
    "Hangul": "가나다라마바사아자차카타파하고노",
    "Hiragana": "あいうえおかきくけこさしすせそた",
    "Katakana": "アイウエオカキクケコサシスセソタ",
    "Han": "山川田中村木林森石原小大高西東北",
    "Armenian": "աբգդեզէըթժիլխծկհ",
    "Georgian": "აბგდევზთიკლმნოპჟ",
}
# Names are drawn from syllables and end as given names (by gender) or surnames do.
SYLLABLES = {
    "Latin": "ba be da do el ka la le ma mi na ra ri sa ta vi".split(),
    "Cyrillic": "ба бо ва ви да ди ка ко ла ли ма ми на ни ра ро".split(),
    "Greek": "βα γα δα θε κα κο λα λε μα μι να νι πα ρα σα τα".split(),
}
ENDINGS = {
    "Latin": {"m": "n rd s l us rt nd ldo".split(), "f": "na la ra ssa nne lia tte ina".split(), "": "son ley man ton field well sen ner".split()},
    "Cyrillic": {"m": "н р слав мир й м с л".split(), "f": "на ла я ра ва ия ина ета".split(), "": "енко ко ич дзе ян ых ук юк".split()},
    "Greek": {"m": "ς νης ρης ος λης κος νος σης".split(), "f": "να λα ρα ία νη κη νια θη".split(), "": "κης δης πουλος ίδης ου άκος λου νού".split()},
}
_HEX = "0123456789abcdef"
_STREAM = 128
_ROUNDS = 64


def _kind(mention: Column) -> Column:
    """The first kind whose pattern covers the whole mention."""
    tried = [F.when(mention.rlike(rf"^(?:{pattern})$"), F.lit(kind)) for kind, pattern in KINDS]
    return F.coalesce(*tried, F.lit("other"))


def _entity(kind: Column, mention: Column) -> Column:
    """What a mention stands for: the same for all ways to write it."""
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(mention, "[^0-9]", ""))
        .when(kind.isin("mac", "ipv6"), F.lower(F.regexp_replace(mention, "-", ":")))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind.isin("host", "name"), F.lower(mention))
        .otherwise(mention)
    )


def _streams(seed: Column) -> Column:
    """Digits of a keyed hash in several alphabets."""
    code = F.sha2(seed, 512)
    # A second hash makes decimal digits even enough: its digits above 9 are left out.
    decimals = F.concat(
        *[F.regexp_replace(F.sha2(F.concat(seed, F.lit(f"/{i}")), 512), "[a-f]", "") for i in range(3)],
        F.lit("7294618350" * 4),
    )
    return F.struct(
        code.alias("hex"),
        F.substring(decimals, 1, _STREAM).alias("decimal"),
        F.translate(code, _HEX, LATIN).alias("latin"),
        *[F.translate(code, _HEX, letters).alias(script) for script, letters in SCRIPTS.items()],
    )


def _alike(text: Column, streams: Column, hexadecimal: Column) -> Column:
    """``text`` with each letter and digit replaced by one of its script and case."""

    def sign(c: Column, i: Column) -> Column:
        at = F.pmod(i, F.lit(_STREAM)) + 1
        pick = lambda name: F.substring(streams[name], at, F.lit(1))
        cased = lambda x: F.when(c == F.upper(c), F.upper(x)).otherwise(x)
        drawn = F.when(hexadecimal & c.rlike("[0-9A-Fa-f]"), F.when(c.rlike("[A-F]"), F.upper(pick("hex"))).otherwise(pick("hex")))
        drawn = drawn.when(c.rlike("[0-9]"), pick("decimal")).when(c.rlike(r"\p{IsLatin}"), cased(pick("latin")))
        for script in SCRIPTS:
            drawn = drawn.when(c.rlike(rf"\p{{Is{script}}}") & c.rlike(r"\p{L}"), cased(pick(script)))
        return (
            drawn.when(c.rlike(r"\p{L}"), pick("latin"))
            .when(c.rlike(r"[\p{M}\p{N}]"), F.lit(""))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), sign), "")


def _luhn(digits: Column) -> Column:
    """The digits with the last one replaced by the check digit of those before."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    doubled = F.transform(
        F.split(F.reverse(body), ""),
        lambda d, i: F.when(
            F.pmod(i, F.lit(2)) == 0, F.floor(d.cast("int") * 2 / 10) + F.pmod(d.cast("int") * 2, F.lit(10))
        ).otherwise(d.cast("int")),
    )
    total = F.aggregate(doubled, F.lit(0).cast("bigint"), lambda s, d: s + d)
    return F.concat(body, F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))


def _name(entity: Column, gender: Column, streams: Column, attempt: Column) -> Column:
    """A name of the script and gender; null for what is no plain word of a known script."""

    def digit(i: Column) -> Column:
        return F.conv(F.substring(streams["hex"], i + 1, F.lit(1)), 16, 10).cast("int")

    # About as long, and longer the more draws were in vain.
    count = F.least(F.greatest(F.ceil(F.length(entity) / 3), F.lit(1)), F.lit(3)) + F.floor(attempt / 4)
    found = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        listed = F.array(*map(F.lit, syllables))
        stem = _stem(listed, count, digit)
        ending = F.lit("")
        for own, endings in ENDINGS[script].items():
            ends = F.array(*map(F.lit, endings))
            ending = F.when(gender == own, F.element_at(ends, F.pmod(digit(F.lit(0)), F.lit(len(endings))) + 1)).otherwise(ending)
        found = F.when(entity.rlike(rf"^[\p{{Is{script}}}\p{{M}}]+$"), F.concat(stem, ending)).otherwise(found)
    return found


def _stem(listed: Column, count: Column, digit) -> Column:
    taken = F.transform(F.sequence(F.lit(1), count.cast("int")), lambda i: F.element_at(listed, digit(i) + 1))
    return F.array_join(taken, "")


def _surrogate(kind: Column, entity: Column, gender: Column, key: str, attempt: Column) -> Column:
    """The surrogate that an entity draws at an attempt."""
    seed = F.concat_ws("\u0001", F.lit(key), kind, entity, gender, attempt.cast("string"))
    top = F.substring_index(entity, ".", -1)  # the last part of a host is kept

    def drawn(streams: Column) -> Column:
        no = F.lit(False)
        alike = _alike(entity, streams, kind.isin("hex", "ipv6", "mac"))
        stem = F.substring(entity, F.lit(1), F.length(entity) - F.length(top) - 1)
        # Of cards that begin with 2, only some series exist.
        prefix = F.when(entity.startswith("2"), 4).otherwise(1)
        octets = F.array_join(
            F.transform(
                F.sequence(F.lit(0), F.lit(3)),
                lambda i: (
                    F.pmod(F.conv(F.substring(streams["hex"], i * 4 + 1, F.lit(4)), 16, 10).cast("int"), F.lit(222)) + 1
                ).cast("string"),
            ),
            ".",
        )
        return (
            F.when(kind == "email", _alike(F.substring_index(entity, "@", 1), streams, no))
            .when(kind == "host", F.concat(_alike(stem, streams, no), F.lit("."), top))
            .when(kind == "ipv4", octets)
            .when(kind == "card", _luhn(F.concat(F.substring(entity, F.lit(1), prefix), F.substring(alike, prefix + 1, F.length(alike) - prefix))))
            .when(kind == "phone", F.concat(F.substring(entity, 1, 1), F.substring(alike, F.lit(2), F.length(alike) - 1)))
            .when(kind == "iban", F.concat(F.substring(entity, 1, 2), F.substring(alike, F.lit(3), F.length(alike) - 2)))
            .when(kind == "word", F.coalesce(_name(entity, gender, streams, attempt), alike))
            .otherwise(alike)
        )

    drawn_once = let(_streams(seed), drawn)
    # After many collisions the form gives way: the whole hash is surely free.
    hashed = F.concat(F.lit("x"), F.sha2(seed, 256))
    hashed = F.when(kind == "host", F.concat(hashed, F.lit("."), top)).otherwise(hashed)
    return F.when(attempt < _ROUNDS, drawn_once).otherwise(hashed)


def draw_surrogates(entities: DataFrame, key: str, folder: str) -> DataFrame:
    """``kind, entity, gender, surrogate``, one to one within a kind, for distinct entities."""
    entities = settle(entities.select("kind", "entity", "gender").distinct(), folder, "entities")
    taken = entities.select("kind", F.col("entity").alias("surrogate")).distinct()
    open_, done, number = entities, [], 0
    while True:
        drawn = open_.withColumn(
            "surrogate",
            _surrogate(F.col("kind"), F.col("entity"), F.col("gender"), key, F.lit(number)),
        )
        # An entity that occurs, or one drawn before, is no free surrogate.
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(
            F.min(F.struct("entity", "gender")).alias("who")
        )
        won = settle(
            first.select("kind", "who.entity", "who.gender", "surrogate"), folder, f"drawn-{number}"
        )
        done.append(won)
        left = settle(
            open_.join(won, ["kind", "entity", "gender"], "left_anti"), folder, f"left-{number}"
        )
        number += 1
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
        open_ = left
        taken = taken.unionByName(won.select("kind", "surrogate"))


def _mentions(texts: DataFrame) -> DataFrame:
    """``key columns, at, mention, kind``: the mentions of each text in order."""
    return texts.select(
        "doc_id", "text_hash", F.posexplode(F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))).alias("at", "mention")
    ).withColumn("kind", _kind(F.col("mention")))


def _parts(mentions: DataFrame) -> DataFrame:
    """Mentions cut into what is kept (``entity`` null) and the entities to replace."""
    male = F.col("mention").rlike(rf"^(?:{MALE})\.? ")
    gender = F.when(male, "m").otherwise("f")
    name = F.split("mention", r"(?<= )")  # the title and each word keep their blank
    whole = F.array(
        F.struct(F.lit(0).alias("i"), F.col("kind").alias("kind"), F.col("mention").alias("part"), F.lit("").alias("gender"))
    )
    label = F.regexp_extract("mention", r"""^[^=:]*[=:]\s*["']?""", 0)
    secret = F.array(
        F.struct(F.lit(0).alias("i"), F.lit(None).cast("string").alias("kind"), label.alias("part"), F.lit("").alias("gender")),
        F.struct(F.lit(1).alias("i"), F.lit("secret").alias("kind"), F.substring("mention", F.length(label) + 1, F.length("mention")).alias("part"), F.lit("").alias("gender")),
    )
    email = F.array(
        F.struct(F.lit(0).alias("i"), F.lit("email").alias("kind"), F.substring_index("mention", "@", 1).alias("part"), F.lit("").alias("gender")),
        F.struct(F.lit(1).alias("i"), F.lit(None).cast("string").alias("kind"), F.lit("@").alias("part"), F.lit("").alias("gender")),
        F.struct(F.lit(2).alias("i"), F.lit("host").alias("kind"), F.substring_index("mention", "@", -1).alias("part"), F.lit("").alias("gender")),
    )
    digits = F.regexp_replace("mention", "[^0-9]", "")
    no_card = F.array(
        F.struct(F.lit(0).alias("i"), F.lit(None).cast("string").alias("kind"), F.col("mention").alias("part"), F.lit("").alias("gender"))
    )
    names = F.transform(
        name,
        lambda w, i: F.struct(
            i.alias("i"),
            F.when(i > 0, F.lit("word")).alias("kind"),
            w.alias("part"),
            # Only a given name has an ending of its gender: the first of several words.
            F.when((i == 1) & (F.size(name) > 2), gender).otherwise("").alias("gender"),
        ),
    )
    kind = F.col("kind")
    cut = (
        F.when(kind == "name", names)
        .when(kind == "secret", secret)
        .when(kind == "email", email)
        .when((kind == "card") & (_luhn(digits) != digits), no_card)
        .otherwise(whole)
    )
    return mentions.select("doc_id", "text_hash", "at", "mention", F.inline(cut)).select(
        "doc_id",
        "text_hash",
        "at",
        F.col("i").alias("part_at"),
        "part",
        "kind",
        "gender",
        F.when(F.col("kind") == "word", F.lower(F.trim("part")))
        .when(F.col("kind") == "email", F.lower("mention"))
        .otherwise(_entity(F.col("kind"), F.col("part")))
        .alias("entity"),
    )


def _by_person(parts: DataFrame) -> DataFrame:
    """``parts`` where a word that is a given name in its document has that gender throughout."""
    given = (
        parts.where("kind = 'word' and gender <> ''")
        .groupBy(
            F.col("doc_id").alias("given_id"), F.col("text_hash").alias("given_hash"), F.col("entity").alias("given")
        )
        .agg(F.min("gender").alias("given_gender"))
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("given_id"))
        & (F.col("text_hash") == F.col("given_hash"))
        & (F.col("entity") == F.col("given"))
        & (F.col("kind") == "word")
    )
    gender = F.coalesce("given_gender", "gender").alias("gender")
    return parts.join(given, same, "left").select(
        "doc_id", "text_hash", "at", "part_at", "part", "kind", gender, "entity"
    )


def _written(kind: Column, part: Column, surrogate: Column) -> Column:
    """The surrogate in the way the mention is written."""
    digits = F.regexp_replace(surrogate, "[^0-9A-Za-z]", "")
    punctuated = let(
        F.split(part, ""),
        lambda signs: F.array_join(
            F.transform(
                signs,
                lambda c, i: F.when(
                    c.rlike("[0-9A-Za-z]"),
                    F.substring(
                        digits,
                        F.size(F.filter(F.slice(signs, 1, i + 1), lambda x: x.rlike("[0-9A-Za-z]"))),
                        F.lit(1),
                    ),
                ).otherwise(c),
            ),
            "",
        ),
    )
    blank = F.when(F.endswith(part, F.lit(" ")), " ").otherwise("")
    cased = _as_name(F.trim(part), surrogate)
    fits = F.length(digits) == F.length(F.regexp_replace(part, "[^0-9A-Za-z]", ""))
    return (
        F.when(kind.isNull(), part)
        .when(kind == "word", F.concat(cased, blank))
        .when(kind.isin("phone", "card", "ssn", "iban", "mac") & fits, punctuated)
        .when(kind.isin("email", "host") & (part == F.upper(part)) & (part != F.lower(part)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def _as_name(word: Column, surrogate: Column) -> Column:
    """The surrogate in capitals or with one, as the word it stands for."""
    upper = (word == F.upper(word)) & (F.length(word) > 1)
    capital = F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substring(surrogate, F.lit(2), F.length(surrogate)))
    return F.when(upper, F.upper(surrogate)).otherwise(capital)


def _renamed(gap: Column, names: Column) -> Column:
    """Text between mentions with its capitalised words replaced where ``names`` has them."""
    word = _START + _WORD

    def swapped(words: Column) -> Column:
        between = F.split(gap, word, -1)

        def new(w: Column) -> Column:
            # A word joined to others, as in GRAY'S, where the whole is no name.
            head = F.regexp_extract(w, r"^[\p{L}\p{M}]+", 0)
            tail = F.substring(w, F.length(head) + 1, F.length(w))
            whole = _as_name(w, F.try_element_at(names, F.lower(w)))
            part = F.concat(_as_name(head, F.try_element_at(names, F.lower(head))), tail)
            return F.coalesce(whole, part, w, F.lit(""))

        return F.array_join(F.transform(between, lambda x, i: F.concat(x, new(F.get(words, i)))), "")

    return let(F.regexp_extract_all(gap, F.lit(word), F.lit(0)), swapped)


def _suspect(text: Column) -> Column:
    """Whether a text may hold a mention: cheap tests, then the patterns."""
    titled = reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in _TITLES])
    return F.coalesce((text.rlike(_GATE) | titled) & text.rlike(_ANY), F.lit(False))


def session_key(spark: SparkSession) -> str:
    """The key that the session names in ``spark.jobtide.pii.key``; if none, one drawn for it.

    Who has the key can work out which surrogate stands for whom, so there is no other default.
    """
    key = spark.conf.get("spark.jobtide.pii.key", None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set("spark.jobtide.pii.key", key)
    return key


def replacements(documents: DataFrame, key: str, folder: str | None = None) -> DataFrame:
    """``doc_id, text_hash, n_entities, kinds, surrogates, names``: what replaces each mention, in order.

    One row for each distinct (``doc_id``, text) that may hold a mention; ``names`` maps the words of
    its persons' names to theirs.
    """
    folder = folder or workspace(documents.sparkSession)
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = _parts(_mentions(texts.where(_suspect(F.col("text")))))
    parts = settle(_by_person(settle(found, folder, "found-parts")), folder, "parts")
    named = parts.where("kind is not null")
    surrogates = settle(draw_surrogates(named, key, folder), folder, "surrogates")
    # Few entities or many: Spark picks the join, and splits the rows of one that is everywhere.
    drawn = parts.join(surrogates, ["kind", "entity", "gender"], "left")
    written = _written(F.col("kind"), F.col("part"), F.col("surrogate"))
    pieces = settle(
        drawn.select("doc_id", "text_hash", "at", "part_at", "kind", "entity", "surrogate", written.alias("piece")),
        folder,
        "pieces",
    )
    mentions = (
        pieces.groupBy("doc_id", "text_hash", "at")
        .agg(
            F.array_sort(F.collect_set(F.struct("part_at", "piece"))).alias("pieces"),
            F.max(F.when(F.col("kind") == "word", "name").when(F.col("kind") != "host", F.col("kind"))).alias("kind"),
        )
        .select("doc_id", "text_hash", "at", "kind", F.array_join("pieces.piece", "").alias("piece"))
    )
    names = (
        pieces.where("kind = 'word'")
        .groupBy(F.col("doc_id").alias("named_id"), F.col("text_hash").alias("named_hash"))
        .agg(F.map_from_entries(F.sort_array(F.collect_set(F.struct("entity", "surrogate")))).alias("names"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("named_id")) & (F.col("text_hash") == F.col("named_hash"))
    listed = mentions.groupBy("doc_id", "text_hash").agg(
        F.count("kind").alias("n_entities"),
        F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"),
        F.sort_array(F.collect_list(F.struct("at", "piece")))["piece"].alias("surrogates"),
    )
    none = F.create_map().cast("map<string,string>")
    return listed.join(names, same, "left").select(
        "doc_id", "text_hash", "n_entities", "kinds", "surrogates", F.coalesce("names", none).alias("names")
    )


def pseudonymized(documents: DataFrame, key: str) -> DataFrame:
    """``documents`` with surrogates in ``text``, and ``n_entities``, ``kinds`` added at the end.

    Needs ``doc_id`` and ``text``; all columns and rows stay, repeated ones too, and a null id is
    an id like any other.  Null and empty texts, and texts without a mention, stay as they are
    with 0 entities and empty kinds; these texts are not shuffled.  Names that follow one with a
    title are replaced like it but not counted.  Who has ``key`` can link surrogates to entities.
    """
    if not key:
        raise ValueError("surrogates need a key")
    folder = workspace(documents.sparkSession)
    found = settle(replacements(documents, key, folder), folder, "replaced")
    hash_, id_, text_, count_, kinds_, list_, names_ = unused(
        documents, "own_hash", "found_id", "found_hash", "n_entities", "kinds", "surrogates", "names"
    )
    found = found.toDF(id_, text_, count_, kinds_, list_, names_)
    suspect = _suspect(F.col("text"))
    none = [F.lit(0).cast("bigint").alias(count_), F.lit("").alias(kinds_)]
    clean = documents.where(~suspect).select("*", *none)
    touched = documents.where(suspect).withColumn(hash_, F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(text_))
    gaps = F.split("text", _ANY, -1)
    rebuilt = let(
        gaps,
        lambda g: F.array_join(
            F.flatten(
                F.transform(
                    g,
                    lambda gap, i: F.array(
                        F.when(F.size(F.col(names_)) > 0, _renamed(gap, F.col(names_))).otherwise(gap),
                        F.coalesce(F.get(F.col(list_), i), F.lit("")),
                    ),
                )
            ),
            "",
        ),
    )
    columns = [rebuilt.alias("text") if c == "text" else F.col(c) for c in documents.columns]
    changed = touched.join(found, same, "left").select(
        *columns, F.coalesce(count_, F.lit(0)).alias(count_), F.coalesce(kinds_, F.lit("")).alias(kinds_)
    )
    return clean.unionByName(changed)
