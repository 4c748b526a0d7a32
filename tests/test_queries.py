"""Every named query against its SQL answer on the smallest tables."""

from __future__ import annotations

import pytest
from compare import differences, duck

from __spark_entry__ import CORPUS, CORPUS_ORACLE, entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_answer():
    assert set(queries()) - set(CORPUS) == set(oracle_sql()) - set(CORPUS_ORACLE)
    assert set(CORPUS_ORACLE) <= set(CORPUS)


def test_flagship(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    if name not in oracle_sql():
        assert df.count() > 0
        return
    problem, _ = differences(df, con, oracle_sql()[name])
    assert problem == ""
