"""The correctness gate: every registered query vs its DuckDB twin (sf0.001)."""

import pytest

import __spark_entry__ as E
import oracle_check as O

from .conftest import SF_SMALL

# the fits without a twin have tests of their own (test_models, test_bruteforce)
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return O.duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    spdf = E.queries()[name](spark, SF_SMALL).toPandas()
    ok, msg = O.compare(spdf, con.execute(E.oracle_sql()[name]).df())
    assert ok and len(spdf) > 0, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 2 and sum(r["winner"] for r in rows) == 1
    assert [f.name for f in df.schema.fields][:2] == ["model", "mae"]
