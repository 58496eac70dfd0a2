"""Every registered query against its SQL, on the small tables."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    """Rows with columns in name order, sorted; floats to nine digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else f"{value:.9g}"
        return str(value)

    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", [n for n in entry.QUERIES if n in entry.oracle_sql()])
def test_query(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    result = duck.execute(entry.oracle_sql()[name])
    expected = canonical([c[0] for c in result.description], result.fetchall())
    assert canonical(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).count() == 30
