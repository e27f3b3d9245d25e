"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from tests.oracle_compare import run
from tidemark.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sf_dir", [SF])
def test_all_queries_match_oracle(spark, sf_dir):
    res = run(sf_dir, list(QUERIES), spark=spark, verbose=False)
    assert all(v[0] == "checked" for v in res.values())
    bad = {k: v[2] for k, v in res.items() if v[2]}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "conversion_rate" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())


def test_results_do_not_depend_on_session_settings(spark):
    """The driver's session may differ: another time zone, ANSI off, AQE off."""
    keys = {"spark.sql.session.timeZone": "America/Los_Angeles", "spark.sql.ansi.enabled": "false",
            "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        res = run(SF, list(QUERIES), spark=spark, verbose=False)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    bad = {k: v[2] for k, v in res.items() if v[2]}
    assert not bad, bad
