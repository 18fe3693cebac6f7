import __spark_entry__ as E
from techmine.plans import registry


def test_contract_keys():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50
    # names must not hint at anything but what they compute
    assert not any(k.startswith("op") or "pipeline" in k for k in registry.QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["topic_name", "tech_name", "shared_works"]
    assert df.count() > 0
