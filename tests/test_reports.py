import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shredloom.operators import attributes, pathset, profile, reports, top_rows

FLAT = "TaxYear string, OBJECTID string, XPATH2 string"


def flat(spark):
    return spark.createDataFrame([
        ("2020", "a", "/r"), ("2020", "a", "/r/x"), ("2020", "a", "/r/x"), ("2020", "b", "/r"),
        ("2021", "c", "/r"), ("2021", "c", "/r/y"), ("2020", "nokeys", "/r")], FLAT)


def keys(spark):
    return spark.createDataFrame([
        ("2020", "a", "2019v1"), ("2020", "a", "2020v2"), ("2020", "a", "2020v2"),
        ("2020", "b", "2020v2"), ("2021", "c", "2021v1")], "TaxYear string, OBJECTID string, VERSION string")


def test_a_filing_with_two_versions_counts_twice(spark):
    out = reports.xpath_report(flat(spark), keys(spark))
    assert [tuple(row) for row in out.collect()] == [
        ("/r", 4, "2019v1, 2020v2, 2021v1"), ("/r/x", 4, "2019v1, 2020v2"), ("/r/y", 1, "2021v1")]


def test_all_years_against_the_crosswalk(spark):
    cc = spark.createDataFrame([("/r/x", "X", "2018"), ("/never", "NEVER", "2018")],
                               "xpath string, variable_name string, latest_version string")
    out = reports.process_xpaths(flat(spark), keys(spark), [2020, "2021"], cc, as_of_year=2021)
    got = out.select("xpath", "count_occurrences", "first_year", "last_year", "current_version",
                     "variable_name", "concordance_latest_version", "path_type")
    assert [tuple(row) for row in got.collect()] == [
        ("/never", None, None, None, None, "NEVER", "2018", "DATA"),
        ("/r", 4, "2019", "2021", True, None, None, "HEADER"),
        ("/r/x", 4, "2019", "2020", False, "X", "2018", "DATA"),
        ("/r/y", 1, "2021", "2021", True, None, None, "DATA")]
    one = reports.process_xpaths(flat(spark), keys(spark), [2021], as_of_year=2021)
    assert [row.xpath for row in one.collect()] == ["/r", "/r/y"]
    mine = reports.process_xpaths(flat(spark), keys(spark), [2021], classify=lambda path: F.lit("parent"))
    assert {row.path_type for row in mine.collect()} == {"HEADER"}
    with pytest.raises(ValueError):
        reports.process_xpaths(flat(spark), keys(spark), [])


def test_versions_may_be_missing(spark):
    bare = keys(spark).where("OBJECTID = 'b'").withColumn("VERSION", F.lit(None).cast("string"))
    out = reports.process_xpaths(flat(spark), bare, [2020], as_of_year=2020).first()
    assert (out.count_occurrences, out.first_year, out.last_year) == (1, None, None)


def test_path_types_do_not_depend_on_sort_order(spark):
    paths = spark.createDataFrame([(p,) for p in ("/R", "/R/A", "/R/A-x", "/R/A.y", "/R/A/b", "/R/A/b", None)],
                                  "xpath string")
    assert dict(pathset.classify_paths(paths).collect()) == {
        "/R": "parent", "/R/A": "parent", "/R/A-x": "terminal", "/R/A.y": "terminal", "/R/A/b": "terminal"}
    assert sorted(r[0] for r in pathset.parent_paths(paths).collect()) == ["", "/R", "/R/A"]
    assert sorted(r[0] for r in pathset.terminal_paths(paths).collect()) == ["/R/A-x", "/R/A.y", "/R/A/b"]


def test_attribute_summary_counts_null_as_a_value(spark):
    table = spark.createDataFrame([
        ("a", "n", "/n", "k", "1"), ("a", "n", "/n", "k", None), ("b", "n", "/n", "k", ""),
        (None, "n", "/n", "k", "0"), ("a", "n", "/n", "e", "")],
        "OBJECTID string, node_name string, xpath string, attr_name string, attr_value string")
    assert [tuple(row) for row in attributes.summarize_attributes(table).collect()] == [
        ("k", 4, 3, 4, "0"), ("e", 1, 1, 1, None)]
    with pytest.raises(ValueError):
        attributes.summarize_attributes(table.drop("attr_value"))
    assert attributes.retrieve_attributes(table, "b").count() == 1
    assert attributes.retrieve_attributes(table, ["a", "b"]).count() == 4
    assert attributes.retrieve_attributes(table, [f"x{i}" for i in range(2000)] + ["b"]).count() == 1
    assert attributes.retrieve_attributes(table, url="https://h/OID-none_public.xml").count() == 0
    assert rows(attributes.retrieve_attributes(table, "a", limit=1)) == [("a", "n", "/n", "e", "")]


def test_top_rows_by_range_are_those_of_a_sort(spark, monkeypatch):
    draw = random.Random(3)
    data = [(draw.choice(["hot", "hot", None, f"k{draw.randint(0, 40)}"]), draw.randint(0, 9),
             draw.choice([None, "x", "y"])) for _ in range(600)] + [("hot", 1, "x")] * 200
    table = spark.createDataFrame(data, "a string, `b.c` long, d string")
    order = [table[f"`{name}`"] for name in table.columns]
    everything = [tuple(row) for row in table.orderBy(*order).collect()]
    monkeypatch.setattr(top_rows, "AT_ONCE", 7)
    nulls = sum(row[0] is None for row in data)
    for n in (0, 5, 8, nulls, nulls + 1, 350, 799, 800, 5_000):
        found = [tuple(row) for row in top_rows.top_rows(table, table.columns, n).collect()]
        assert found == everything[:n], n
    assert top_rows.top_rows(table.limit(0), table.columns, 50).isEmpty()


def test_tables_are_counted_in_one_job(spark, tmp_path):
    tables = {}
    for k in range(4):
        spark.range(10 * k).write.parquet(str(tmp_path / str(k)))
        tables[str(k)] = spark.read.schema("id long").parquet(str(tmp_path / str(k)))
    spark.sparkContext.setJobGroup("profile", "profile")
    try:
        out = profile.profile_tables(spark, tables)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("profile")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [row.n_rows for row in out.collect()] == [0, 10, 20, 30]
    assert len(jobs) <= 1 + len(tables)  # with AQE one map stage of each table, one result
    plan = profile._counted(tables)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<>" in plan and "id:bigint" not in plan


def test_profiles_and_previews(spark):
    good = spark.createDataFrame([(2, "b"), (1, "a")], "k long, v string")
    out = profile.profile_tables(spark, {"good": good, "bad": lambda: spark.read.parquet("/no/such/table")})
    bad, fine = out.collect()
    assert (fine.table_name, fine.n_rows, fine.n_cols, fine.error) == ("good", 2, 2, None)
    assert bad.table_name == "bad" and bad.n_rows is None and "no/such" in bad.error
    assert rows(profile.preview_table({"good": good}, "good", 1)) == [(1, "a")]
    assert set(profile.preview_tables({"good": good})) == {"good"}
    with pytest.raises(ValueError, match="good"):
        profile.preview_table({"good": good}, "other")
