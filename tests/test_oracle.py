"""Every query against its SQL on the smallest tables."""

import pytest

from checks import queries
from checks.compare import connect, differences
from checks.queries import QUERIES
from checks.sql import ORACLE
from plain_rows import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, ORACLE[name]) is None


def test_train_forest_fits_the_operators_own_forest(monkeypatch):
    asked = []

    def fit(train, target, names, **params):
        asked.append(params)
        raise StopIteration

    monkeypatch.setattr(queries, "_model_table", lambda spark, sf: (None, []))
    monkeypatch.setattr(queries.mf, "split_rows", lambda df, keys: (None, None))
    monkeypatch.setattr(queries.forest, "train_forest", fit)
    with pytest.raises(StopIteration):
        QUERIES["train_forest"](None, SMALL)
    assert asked == [{}]
