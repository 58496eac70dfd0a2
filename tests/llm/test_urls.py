import random

from jobtide.llm import urls
from jobtide.llm.components import components
from jobtide.llm.common import workspace

SCHEMA = "page_id long, url string, html string, rule string"
LINK = '<html><LINK REL="canonical" href="%s"></html>'
MOVE = "<meta http-equiv='refresh' content='0; url=%s'>"


def verdicts(spark, rows, rules=urls.RULES):
    df = spark.createDataFrame([(*row, "clash") for row in rows], SCHEMA)
    return sorted((str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, rules).collect())


def test_rules(spark):
    rows = [
        (1, "http://A.Example.org/es/x", None), (2, "http://example.org/en/12?a", None),
        (3, "http://notexample.org/es/", None), (4, "http://com/fr/", ""), (5, "x://a.com/de/#f", ""),
        (6, "http://a.com/DE/", ""), (7, "http://example.org", ""), (8, None, None), (9, "no scheme", None),
        (9, "no scheme", None), (None, "http://a.org/", ""), (10, "http://É.net/?u=http://a.org/", ""),
    ]
    assert verdicts(spark, rows) == sorted([
        ("1", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("2", "example.org", "/en/12", "example.org/en/1", "block"),
        ("3", "notexample.org", "/es/", "org/", "allow"),
        ("4", "com", "/fr/", "com/fr/", "allow"), ("5", "a.com", "/de/", "com/de/", "block"),
        ("6", "a.com", "/DE/", None, "allow"), ("7", "example.org", "", None, "allow"),
        ("8", "", "", None, "allow"), ("9", "", "", None, "allow"), ("9", "", "", None, "allow"),
        ("None", "a.org", "/", "org/", "allow"), ("10", "É.net", "/", None, "allow"),
    ])
    assert verdicts(spark, []) == []


def test_aliases(spark):
    rows = [
        (1, "http://x.net/a", LINK % "http://y.net/b"),  # a chain to a blocked address
        (2, "https://y.net/b#top", MOVE % "http://z.com/de/1?p=1&amp;q=2"),
        (3, "http://q.net/d/z", LINK % "/w"), (4, "http://q.net/w", None),
        (5, "http://p.net/", LINK % "http://shop.com/fr/"),  # blocked and allowed: allowed
        (6, "http://p.net", MOVE % "//z.com/de/2"),
        (7, "http://r.org/x", LINK % "http://z.com/de/9"),  # its own rule allows it
        (8, "http://s.net/d/e", LINK % "f"), (9, "http://s.net/d/f", MOVE % "http://z.com/de/5"),
        (10, "http://lone.net/", LINK % "http://lone.net/"),
    ]
    got = {i: v for i, _, _, _, v in verdicts(spark, rows)}
    assert got == {
        "1": "block", "2": "block", "3": "allow", "4": "allow", "5": "allow", "6": "allow",
        "7": "allow", "8": "block", "9": "block", "10": "allow",
    }


def test_components_against_brute_force(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(220)]
    edges += [(1000, 1000 + i) for i in range(300)] + [(2000 + i, 2001 + i) for i in range(60)]
    edges += [(5, 5), (3000, 3000), (3000, 3000)]
    label = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    df = spark.createDataFrame([*edges, (None, 4)], "a long, b long")
    assert sorted(map(tuple, components(df, workspace(spark)).collect())) == sorted(label.items())
    assert components(df.limit(0), workspace(spark)).collect() == []
