"""Distinct values and filings per attribute name: stored with each batch, merged by summaries."""

import pytest

from conftest import rows
from shredloom.operators import attributes
from shredloom.sources.store import LongStore

# Two batches and two years that share values, and one filing id in both years.
BATCHES = [
    [("x/1_public.xml", '<r returnVersion="v1"><a u="USD" e=""/><a u="EUR"/></r>', "2020"),
     ("x/2_public.xml", '<r returnVersion="v1"><a u="USD"/></r>', "2020"), ("x/bad", "<r>", "2020")],
    [("x/1_public.xml", '<r returnVersion="v2"><a u="USD"/><a e=""/></r>', "2021"),
     ("x/3_public.xml", "<r><a/></r>", "2021")]]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = LongStore(spark, str(tmp_path_factory.mktemp("sets")))
    for batch in BATCHES:
        made.append(spark.createDataFrame(batch, "url string, xml string, TaxYear string"))
    return made


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sets_say_the_same_as_attribute_rows(store):
    for years in (None, [2020], [2021], [1999]):
        want = rows(attributes.summarize_attributes(store.table("ATTRIBUTES", years)))
        assert rows(attributes.summarize_sets(store.table("ATTRIBUTE_SETS", years))) == want
    by = {row.attr_name: row for row in attributes.summarize_sets(
        store.table("ATTRIBUTE_SETS")).collect()}
    assert tuple(by["u"]) == ("u", 4, 2, 2, "EUR")   # filing 1 counts once
    assert tuple(by["e"]) == ("e", 2, 1, 1, None)


def test_null_is_a_value_and_a_filing(spark):
    table = spark.createDataFrame([
        ("a", "k", "1"), ("a", "k", None), ("b", "k", ""), (None, "k", "0"), ("a", "e", ""),
        ("a", None, "x")], "OBJECTID string, attr_name string, attr_value string")
    assert rows(attributes.summarize_sets(attributes.attribute_sets(table))) == rows(
        attributes.summarize_attributes(table))
    empty = table.limit(0)
    assert rows(attributes.summarize_sets(attributes.attribute_sets(empty))) == []


def test_a_summary_scans_no_attribute_rows(store):
    plan = plan_of(attributes.summarize_sets(store.table("ATTRIBUTE_SETS")))
    assert "ATTRIBUTE_SETS" in plan and "xpath" not in plan and "/ATTRIBUTES" not in plan


def test_compaction_merges_sets(spark, tmp_path):
    made = LongStore(spark, str(tmp_path))
    for batch in BATCHES:
        for row in batch[:2]:
            made.append(spark.createDataFrame([row], "url string, xml string, TaxYear string"))
    before = rows(attributes.summarize_sets(made.table("ATTRIBUTE_SETS")))
    parts = made.table("ATTRIBUTE_SETS").count()
    made.compact()
    made.remove_replaced()
    assert rows(attributes.summarize_sets(made.table("ATTRIBUTE_SETS"))) == before
    assert made.table("ATTRIBUTE_SETS").count() < parts
