"""Every registered query against its DuckDB oracle on sf0.001: row count,
column names and the multiset of rows (columns sorted by name)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import rows_of

from entiprof.plans.oracle import ORACLE_SQL
from entiprof.plans.queries import QUERIES as OWN

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(OWN) == set(ORACLE_SQL) and len(OWN) >= 41
    # the other keys are those of the training-data subpackage, where it is installed
    assert set(OWN) <= set(QUERIES) and set(ORACLE_SQL) <= set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(OWN) == set(entry._llm("QUERIES"))


@pytest.mark.parametrize("key", sorted(OWN))
def test_query_matches_oracle(spark, duck, key):
    got = QUERIES[key](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLE[key]).df()
    gcols, grows = rows_of(got)
    wcols, wrows = rows_of(want)
    assert gcols == wcols
    assert len(got) == len(want)
    assert grows == wrows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 66
    assert df.count() > 0
