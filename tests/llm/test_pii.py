import re

import pytest
from pyspark.sql import functions as F

from jobtide.llm import pii

SCHEMA = "doc_id long, text string, kinds string"


@pytest.fixture(scope="module")
def changed(spark):
    def run(texts, key="k"):
        df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
        out = pii.pseudonymized(df, key)
        assert out.columns[:3] == ["doc_id", "text", "kinds"]
        return [r.text for r in out.orderBy("doc_id").collect()]

    return run


FORMS = [
    "+1 (404) 555-9194", "404-555-9195", "tebg.92@mail1.example.com", "94.182.225.142",
    "4939918345101225", "4939-9183-4510-1225", "123-45-6789", "DE89 3704 0044 0532 0130 00",
    "00:1A:2b:3c:4d:5e", "fe80:0:0:0:0:0:0:1", "1cc70516e0d322a6ab337a55224c508422771b75",
]


def shape(text):
    return re.sub(r"[0-9]", "9", re.sub("[A-Z]", "A", re.sub("[a-z]", "a", text)))


def test_kinds_keep_their_form(changed):
    out = changed([f"Here: {form}, and on." for form in FORMS])
    for form, text in zip(FORMS, out, strict=True):
        new = re.fullmatch("Here: (.*), and on.", text)[1]
        assert new != form
        if ":" not in form and len(form) < 40 and form.count(".") != 3:
            assert shape(new) == shape(form)
    assert all(0 <= int(x) <= 255 for x in re.findall(r"\d+", out[3]))
    digits = [int(c) for c in re.search(r"\d{16}", out[4])[0]]
    assert sum(sum(divmod(d * 2, 10)) if i % 2 == 0 else d for i, d in enumerate(digits)) % 10 == 0


def test_coreference_and_distinctness(changed):
    out = changed([
        "a.b@mail1.example.com A.B@MAIL1.EXAMPLE.COM c@mail1.example.com",
        "+1 (404) 555-9194 or +1-404-555-9194", "Mr. Paul Gray met Mr Gray and Mrs Anna Gray",
        "г-н Иванов, Госпожа Анна Иванова", "Frau Müller-Lang",
        " ".join(f"10.0.{i // 250}.{i % 250}" for i in range(600)),
    ])
    mails = out[0].split()
    assert mails[0].lower() == mails[1].lower() and mails[1].isupper()
    assert mails[2] != mails[0] and mails[2].split("@")[1] == mails[0].split("@")[1]
    assert len(set(re.sub(r"\D", "", p) for p in out[1].split(" or "))) == 1
    first, surname = re.match(r"Mr\. (\w+) (\w+) met", out[2]).groups()
    assert out[2] == f"Mr. {first} {surname} met Mr {surname} and Mrs {out[2].split()[-2]} {surname}"
    assert first.lower().endswith(tuple(pii.ENDINGS["Latin"]["m"]))
    assert out[2].split()[-2].lower().endswith(tuple(pii.ENDINGS["Latin"]["f"]))
    assert not re.search("[A-Za-z]", out[3]) and "Иванов" not in out[3]
    assert re.fullmatch(r"Frau \w+-\w+", out[4])
    assert len(set(out[5].split())) == 600


def test_surrogates_are_no_entities_of_the_corpus(spark, monkeypatch):
    # One digit leaves ten forms: with nine taken, entities must still differ.
    rows = [("hex", str(d), "") for d in range(7)]
    folder = pii.workspace(spark)
    df = spark.createDataFrame(rows, "kind string, entity string, gender string")
    monkeypatch.setattr(pii, "_ROUNDS", 6)
    out = pii.draw_surrogates(df, "k", folder).collect()
    drawn = [r.surrogate for r in out]
    assert len(out) == 7 and len(set(drawn)) == 7 and not set(drawn) & {r[1] for r in rows}


def test_key_changes_surrogates_and_runs_agree(changed):
    text = ["call +1 (404) 555-9194"]
    assert changed(text) == changed(text) != changed(text, "other")


def test_clean_and_odd_texts_stay(changed):
    texts = [
        None, "", "nothing 12 3.14 2024-01-05 1.2.3", "v1.2.3.4.5", "the Sir", "a@b", "x" * 100_000,
        "price $5, 100%, 1,000,000 rows", "id 12345678", "Mr nobody", "token of thanks",
    ]
    assert changed(texts) == texts


def test_rows_and_secrets(spark):
    rows = [(1, "password=3d4bc476f7469ffa8a", ""), (1, "password=3d4bc476f7469ffa8a", ""), (None, 'token = "ab12cd34ef"', ""), (2, None, "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("own_hash", F.lit(1))
    out = pii.pseudonymized(df, "k").collect()
    assert len(out) == 4
    texts = {str(r.doc_id): r.text for r in out}
    assert texts["1"].startswith("password=") and "3d4b" not in texts["1"]
    assert re.fullmatch(r'token = "[a-z]{2}\d{2}[a-z]{2}\d{2}[a-z]{2}"', texts["None"])
    assert pii.pseudonymized(df.limit(0), "k").collect() == []


def is_card(text):
    digits = [int(c) for c in reversed(text)]
    return sum(sum(divmod(d * 2, 10)) if i % 2 else d for i, d in enumerate(digits)) % 10 == 0


def test_documents_hold_no_original(spark, sf_dir):
    """Of the numbers of sixteen digits, those that are card numbers go and the others stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pattern = r"[\w.]+@[\w.]+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b[0-9a-f]{40}\b"
    before = {m for r in docs.collect() for m in re.findall(pattern, r.text)}
    plain = {m for m in before if re.fullmatch(r"\d{16}", m) and not is_card(m)}
    out = pii.pseudonymized(docs, "k").collect()
    after = "\n".join(r.text for r in out)
    assert before - plain and len(out) == docs.count()
    assert not [m for m in before - plain if m in after]
    assert all(m in after for m in plain)


def test_forms_and_their_decoys(spark):
    plants = {
        "card 4539578763621486": "4539578763621486", "card 2223000048400011": "2223000048400011",
        "(555-123-4567)": "555-123-4567", "(+49 30 1234567)": "+49 30 1234567", "555 123 4567": "555 123 4567",
        "at 2001:db8::1 and": "2001:db8::1", "at fe80::1 and": "fe80::1", "from ::ffff:10.1.2.3 on": "10.1.2.3",
        "password: hunterabcdef": "hunterabcdef", '{"password": "abc12345"}': "abc12345",
    }
    decoys = [
        "order id 4000000000000001", "id 2100000000000005", "id 2721000000000004", "std::vector a::b",
        "1555 123 45678", "passwords are long", "the key: a b", "at 12:30:45", "x:: y",
    ]
    texts = [*plants, *decoys]
    df = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], SCHEMA)
    out = sorted(pii.pseudonymized(df, "k").collect(), key=lambda r: r.doc_id)
    for (text, value), row in zip(plants.items(), out, strict=False):
        before, after = text.split(value)
        assert value not in row.text, text
        assert row.text.startswith(before) and row.text.endswith(after), row.text
        assert row[3] == 1
    assert [r.text for r in out[len(plants) :]] == decoys
    assert all(r[3] == 0 for r in out[len(plants) :])


def test_later_mentions_of_a_person(changed):
    """With and without a title, in any order, in capitals; other words stay."""
    out = changed([
        "Mr Paul Gray met Anna. Later Paul Gray said so. Gray left. GRAY'S hat, the gray cat, Grayson.",
        "Mr Paul and Mr Paul Gray. Paul!", "Gray day", "Mrs Anna Maria Luise Schmidt-Lang, then Schmidt-Lang and Luise",
        "Γιάννης: Κύριος Γιάννης Νέρος, ο Νέρος.",
    ])
    first, last = re.match(r"Mr (\w+) (\w+) met", out[0]).groups()
    assert first != "Paul" and last != "Gray"
    assert out[0] == (
        f"Mr {first} {last} met Anna. Later {first} {last} said so. {last} left. {last.upper()}'S hat, the gray cat, Grayson."
    )
    assert out[1] == f"Mr {first} and Mr {first} {last}. {first}!"
    assert out[2] == "Gray day"
    words = re.fullmatch(r"Mrs (\w+) (\w+) (\w+) (\w+-\w+), then (.*) and (.*)", out[3]).groups()
    assert words[3] == words[4] and words[2] == words[5] and not {"Anna", "Maria", "Luise"} & set(words)
    name = re.fullmatch(r"(\w+): Κύριος (\w+) (\w+), ο (\w+)\.", out[4])
    assert name[1] == name[2] != "Γιάννης" and name[3] == name[4] != "Νέρος"
    assert re.fullmatch(r"[\u0370-\u03ff]+", name[1])


def test_brute_force_on_a_small_corpus(changed):
    """One surrogate per word and person all over the corpus, none of them a word that occurs."""
    given, surnames = ["Paul", "Karl", "Mark", "Otto"], [f"{a}{b}" for a in ("Gray", "Stone", "Hill", "Wood") for b in ("", "er", "man", "s")]
    texts = [f"Mr {g} {s} saw Mrs Eva {t}. {s} and {t} and {g}." for g in given for s in surnames for t in surnames[:4]]
    maps, found = [], set()
    for text, out in zip(texts, changed(texts), strict=True):
        words = [re.findall(r"\w+", x) for x in (text, out)]
        for old, new in zip(*words, strict=True):
            if old in ("Mr", "Mrs", "saw", "and"):
                assert old == new
            else:
                maps.append((old, new))
                found.add(new)
    assert len(set(maps)) == len({a for a, _ in maps}) == len(found)
    assert not found & {a for a, _ in maps}


def test_scripts_are_kept(changed):
    out = changed(["山田@例え.com", "иван@почта.рф", "דוד@דואר.com", "a@b.com", "อรุณ@ไทย.com"])
    for text, pattern in zip(out, (r"[\u4e00-\u9fff]{2}@[\u4e00-\u9fff][\u3040-\u309f]\.com", r"[\u0400-\u04ff]{4}@[\u0400-\u04ff]{5}\.рф", r"[\u0590-\u05ff]{3}@[\u0590-\u05ff]{4}\.com", r"[a-z]@\w+\.com", r"[\u0e00-\u0e7f]+@[\u0e00-\u0e7f]+\.com"), strict=True):
        assert re.fullmatch(pattern, text), text
    assert "山田" not in out[0] and "иван" not in out[1]


def test_hosts_stay_apart(changed):
    """Far more hosts of two letters than sixteen letters tell apart at a draw."""
    hosts = [f"{a}{b}.org" for a in "abcdefghij" for b in "abcdefghij"]
    out = changed([f"me@{h} you@{h}" for h in hosts])
    new = [sorted(set(re.findall(r"@(\S+)", t))) for t in out]
    assert all(len(n) == 1 for n in new) and len({n[0] for n in new}) == len(hosts)
    assert not {n[0] for n in new} & set(hosts) and all(n[0].endswith(".org") for n in new)


def test_no_key_no_surrogates(spark):
    df = spark.createDataFrame([(1, "a@b.com", "")], SCHEMA)
    with pytest.raises(ValueError, match="key"):
        pii.pseudonymized(df, "")
    assert pii.session_key(spark) == pii.session_key(spark) and len(pii.session_key(spark)) == 64


def test_long_texts_of_every_pattern(changed):
    n = 100_000
    texts = [
        "a@" + "a." * n + "com", "Mr " + "-".join(["Ab"] * n) + " Gray", "x@" + "b-" * n + "c.com", "password: " + "a1" * n,
        "1" * n, "1-" * n, "::" * n, "ab:" * n, "AB12 " + "ABCD " * n, "deadbeef1" * n, "a@" * n, "+1 " + "22 " * n, "1.2.3." * n,
    ]
    out = changed(texts)
    assert len(out) == len(texts)
    assert out[0].startswith("a@") is False or out[0] != texts[0]
    assert "Gray" not in out[1] and out[3].startswith("password: ") and out[3] != texts[3]
