"""Tables with parameters and session variables in SQL text."""

import pytest

from checks import messages as m
from topictables import Catalog, json_table, table_topic

PARAMETERS = {"first": "BIGINT", "place": "INT DEFAULT 1"}


@pytest.fixture()
def catalog(spark, sf_dir, tmp_path):
    m.event_props(m.table(spark, sf_dir, "events")).write.parquet(str(tmp_path / "topic"))
    stored = spark.read.parquet(str(tmp_path / "topic"))
    table = json_table(table_topic(stored, "event_props"), {"k": "INT"}, keep=["offset", "partition"])
    found = Catalog(spark, "shop")
    found.create_function("events_after", table, PARAMETERS, "offset > first AND partition = place")
    return found, table


def test_function_is_a_filter(catalog):
    catalog, table = catalog
    for call, condition in (("50", "offset > 50 AND partition = 1"), ("first => 7, place => 2", "offset > 7 AND partition = 2")):
        got = catalog.sql(f"SELECT * FROM events_after({call})")
        assert got.columns == table.columns
        assert sorted(got.collect()) == sorted(table.filter(condition).collect())
    joined = catalog.sql("SELECT a.offset FROM events_after(5) a JOIN events_after(10, 1) b ON a.offset = b.offset WHERE a.k >= 0")
    assert sorted(joined.collect()) == sorted(table.filter("offset > 10 AND partition = 1 AND k >= 0").select("offset").collect())


def test_filters_reach_the_scan(catalog):
    catalog, _ = catalog
    catalog.set_variable("last_offset", "BIGINT", 80)
    got = catalog.sql("SELECT k FROM events_after(50) WHERE offset < last_offset AND k > 1")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(offset,50)" in plan and "LessThan(offset,80)" in plan and "EqualTo(partition,1)" in plan
    assert plan.count("from_json") + plan.count("jsontostructs") <= 2  # the parser, and its place in the scan's listing
    assert "BatchEvalPython" not in plan


def test_variables(spark, catalog):
    catalog, table = catalog
    for value in (3, 4):
        catalog.set_variable("least", "INT", value)
        assert catalog.sql("SELECT least AS v").first()["v"] == value
    catalog.set_variable("word", "STRING", "it's; --")
    assert catalog.sql("SELECT word AS v").first()["v"] == "it's; --"
    for call in (lambda: catalog.set_variable("a b", "INT", 1), lambda: catalog.create_function("a-b", table, {}, "true")):
        with pytest.raises(ValueError, match="is not the name"):
            call()
