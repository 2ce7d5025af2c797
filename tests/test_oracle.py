"""Registered jobs against their DuckDB oracle (the driver's check, at sf0.001)."""

import pytest

from oracle_harness import compare, duck
from sightline.plans import registry

registry.load_all()
NAMES = sorted(registry.ORACLE)
EMPTY_AT_THIS_SIZE: set[str] = set()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, sf_small, name):
    info = compare(spark, con, name, registry.QUERIES[name], registry.ORACLE[name], sf_small)
    assert info["ok"], info
    proves_nothing = info["spark_rows"] == 0 and name not in EMPTY_AT_THIS_SIZE
    assert not proves_nothing, f"{name} is empty on both sides"


def test_every_job_has_a_check():
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "rank" in df.columns
