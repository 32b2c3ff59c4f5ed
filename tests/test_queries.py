import pytest

from pricelode.queries import registry
from tests.oracle import same_rows


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, root, name):
    same_rows(registry.QUERIES[name](spark, root), registry.SQL[name], root)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_runs(spark, root, name):
    assert registry.QUERIES[name](spark, root).count() > 0


def test_entry_without_llm():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name, missing", [("page_fields", "S11 S12"), ("ambiguity_margin", "W5 W6"), ("validation_errors", "V1"), ("leaflet_parse", "S14 S15")])
def test_claims_only_what_is_built(name, missing):
    claimed = registry.QUERIES[name].__doc__.strip().split(":")[0].split(" (")[0].replace(",", " ").split()
    assert not set(missing.split()) & set(claimed)
