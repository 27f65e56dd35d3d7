import pytest
from pyspark.sql import functions as F

from shredloom.functions import ids, paths, versions


def one(spark, expression, *values):
    names = [f"c{i}" for i in range(len(values))]
    frame = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
    return frame.select(expression(*[F.col(n) for n in names])).first()[0]


@pytest.mark.parametrize("given, expected", [
    ("123456789", "EIN-12-3456789"), ("987654321", "EIN-98-7654321"), ("12-3456789", "EIN-12-3456789"),
    ("1234567", "EIN-00-1234567"), ("12345678901", "EIN-12-3456789"), ("", "EIN-00-0000000"),
    (None, None)])
def test_format_ein_id(spark, given, expected):
    assert one(spark, ids.format_ein, given) == expected


@pytest.mark.parametrize("given, expected", [
    ("EIN-12-3456789", "123456789"), ("EIN-98-7654321", "987654321")])
def test_format_ein_digits(spark, given, expected):
    assert one(spark, lambda c: ids.format_ein(c, "n"), given) == expected


def test_format_ein_rejects_other_targets(spark):
    with pytest.raises(ValueError):
        ids.format_ein(F.lit("1"), "x")


def test_object_id(spark):
    base = "https://filings.example.org/xml/"
    url = f"{base}202220139349301207_public.xml"
    assert one(spark, ids.object_id, url) == "OID-202220139349301207"
    assert one(spark, lambda c: ids.object_id(c, [base]), url) == "OID-202220139349301207"
    for folder in ids.KNOWN_FOLDERS:
        assert one(spark, ids.object_id, f"http://h/{folder}/7_public.xml") == "OID-7"
    for unknown in ("https://h/other/7", "https://h/xml/2021/7", "https://h/a/xml/7",
                    "file:/data/xml/7", "7"):
        assert one(spark, ids.object_id, f"{unknown}_public.xml") == f"OID-{unknown}"
    other = "https://other.example.org/a+b/1_public.xml"
    assert one(spark, lambda c: ids.object_id(c, [base]), other) == (
        "OID-https://other.example.org/a+b/1")
    assert one(spark, lambda c: ids.object_id(c, ["https://other.example.org/a+b/"]), other) == "OID-1"


LONG = "/Return/ReturnData/ScheduleO[3]/Detail/Line[12]"


@pytest.mark.parametrize("path, index, table", [
    (LONG, "12", "TID-00012"), ("/a/b", "0", "TID-00000"), ("/a[3]/b", "3", "TID-00003"),
    ("/a[2]/b[123456]/c", "123456", "TID-123456"), ("/a[99999]", "99999", "TID-99999"),
    ("/a[4]/b[@x]/c", "4", "TID-00004")])
def test_last_index_and_table_id(spark, path, index, table):
    assert one(spark, paths.last_index, path) == index
    assert one(spark, paths.table_id, path) == table


@pytest.mark.parametrize("path, kind, header", [
    ("/Return", "parent", "//"), ("/A/B/C", "terminal", "//A/B"), ("/A/B/C/D", "parent", "//C/D"),
    ("/A/B", "terminal", "//A"), ("/A/B", "parent", "//B"), ("/A/B/C", "parent", "//B/C"),
    ("/A", "terminal", "//"), ("/A/B/C/D/E", "terminal", "//C/D")])
def test_table_header(spark, path, kind, header):
    assert one(spark, paths.table_header, path, kind) == header


def test_normalize_path(spark):
    path = "/efile:Return/irs:Data[2]/Group[12]/Leaf"
    assert one(spark, paths.normalize_path, path) == "/Return/Data/Group/Leaf"
    assert one(spark, lambda c: paths.normalize_path(c, legacy=True), path) == (
        "/Return/irs:Data[2]/Group[12]/Leaf")


def test_names(spark):
    assert one(spark, paths.leaf_name, "/a/b:c") == "b:c"
    assert one(spark, paths.local_name, "/a/b:c[3]") == "c"


def test_headers_match_whole_segments_unless_legacy(spark):
    def hit(path, legacy=False):
        return one(spark, lambda c: paths.under_headers(c, ["//a/b"], legacy), path)
    assert hit("/r/a/b") and hit("/r/a/b/c") and not hit("/r/a/bGrp/c")
    assert hit("/r/a/bGrp/c", legacy=True)


@pytest.mark.parametrize("text, merged, first, last", [
    ("2014v5.0, 2013v3.0,2014v5.0", "2013v3.0;;2014v5.0", "2013", "2014"),
    (" , ", "", None, None), ("2020v1.0", "2020v1.0", "2020", "2020")])
def test_version_lists(spark, text, merged, first, last):
    frame = spark.createDataFrame([(text,)], "schema_versions string")
    assert tuple(versions.summarize_versions(frame).first()) == (merged, first, last)
