import pytest
from pyspark.sql import functions as F

from conftest import rows
from shredloom.operators import crosswalk, shred, xml_rows
from shredloom.sources.filings import pack_filings, read_filings, read_packed_filings

COMPACT = ('<Return xmlns="u" xmlns:x="v" returnVersion="2020v1.0"><ReturnHeader>'
           '<Filer><EIN>1</EIN></Filer><TaxYr>2020</TaxYr></ReturnHeader>'
           '<ReturnData><Form x:kind="k" n="2"><G><V>1</V></G><G><V>2</V></G></Form></ReturnData></Return>')
INDENTED = COMPACT.replace("><", ">\n  <")
BASE = "https://filings.example.org/xml/"
CROSSWALK = [("/Return/ReturnHeader/TaxYr", "YEAR", "T-T00-A"),
             ("/Return/ReturnHeader/TaxYr", "YEAR2", "T-T00-A"),
             ("/Return/ReturnData/Form/G/V", "V", "T-T01-B")]


def filings(spark, *documents):
    return spark.createDataFrame(
        [(f"{BASE}{i}_public.xml", xml) for i, xml in enumerate(documents)], "url string, xml string")


def names(spark, listed=CROSSWALK):
    return spark.createDataFrame(listed, "xpath string, variable_name string, rdb_table string")


def test_long_table(spark):
    out = shred.shred_elements(filings(spark, COMPACT), names(spark, CROSSWALK[:1] + CROSSWALK[2:]))
    assert [tuple(row) for row in out.orderBy("ORDER").collect()] == [
        ("OID-0", 1, "/Return", "/Return", "//", "TID-00000", "parent", "", "Return",
         "VERSION: 2020v1.0"),
        ("OID-0", 2, "/Return/ReturnHeader", "/Return/ReturnHeader", "//ReturnHeader", "TID-00000",
         "parent", "", "ReturnHeader", "12020"),
        ("OID-0", 3, "/Return/ReturnHeader/Filer", "/Return/ReturnHeader/Filer",
         "//ReturnHeader/Filer", "TID-00000", "parent", "", "Filer", "1"),
        ("OID-0", 4, "/Return/ReturnHeader/Filer/EIN", "/Return/ReturnHeader/Filer/EIN",
         "//ReturnHeader/Filer", "TID-00000", "terminal", "", "EIN", "1"),
        ("OID-0", 5, "/Return/ReturnHeader/TaxYr", "/Return/ReturnHeader/TaxYr",
         "//Return/ReturnHeader", "TID-00000", "terminal", "T-T00-A", "YEAR", "2020"),
        ("OID-0", 6, "/Return/ReturnData", "/Return/ReturnData", "//ReturnData", "TID-00000",
         "parent", "", "ReturnData", "12"),
        ("OID-0", 7, "/Return/ReturnData/Form", "/Return/ReturnData/Form", "//ReturnData/Form",
         "TID-00000", "parent", "", "Form", "12"),
        ("OID-0", 8, "/Return/ReturnData/Form/G[1]", "/Return/ReturnData/Form/G", "//Form/G",
         "TID-00001", "parent", "", "G", "1"),
        ("OID-0", 9, "/Return/ReturnData/Form/G[1]/V", "/Return/ReturnData/Form/G/V", "//Form/G",
         "TID-00001", "terminal", "T-T01-B", "V", "1"),
        ("OID-0", 10, "/Return/ReturnData/Form/G[2]", "/Return/ReturnData/Form/G", "//Form/G",
         "TID-00002", "parent", "", "G", "2"),
        ("OID-0", 11, "/Return/ReturnData/Form/G[2]/V", "/Return/ReturnData/Form/G/V", "//Form/G",
         "TID-00002", "terminal", "T-T01-B", "V", "2"),
    ]


def test_indented_twin_and_shuffled_input_shred_alike(spark):
    plain = shred.shred_elements(filings(spark, COMPACT, INDENTED), names(spark))
    first = rows(plain.where("OBJECTID = 'OID-0'").drop("OBJECTID"))
    assert first == rows(plain.where("OBJECTID = 'OID-1'").drop("OBJECTID"))
    spread = filings(spark, COMPACT, INDENTED).orderBy(F.desc("url")).repartition(3)
    assert rows(plain) == rows(shred.shred_elements(spread, names(spark)))


def test_missing_version_and_legacy_paths(spark):
    bare = filings(spark, "<efile:R xmlns:efile='u'><a/><a/></efile:R>")
    assert [row.VALUE for row in shred.shred_elements(bare).where("ORDER = 1").collect()] == ["VERSION: NA"]
    assert [row.XPATH2 for row in shred.shred_elements(bare).orderBy("ORDER").collect()] == [
        "/R", "/R/a", "/R/a"]
    kept = shred.shred_elements(bare, legacy_paths=True).orderBy("ORDER")
    assert [(row.XPATH2, row.VARIABLE_NAME) for row in kept.collect()] == [
        ("/R", "R"), ("/R/a[1]", "a[1]"), ("/R/a[2]", "a[2]")]


def test_crosswalk_duplicates_multiply_rows(spark):
    out = shred.shred_elements(filings(spark, COMPACT), names(spark)).where("ORDER = 5")
    assert sorted(row.VARIABLE_NAME for row in out.collect()) == ["YEAR", "YEAR2"]


def test_large_crosswalk_is_joined_with_a_salt(spark, monkeypatch):
    elements = shred.shred_elements(filings(spark, COMPACT, INDENTED)).drop("VARIABLE_NAME", "RDB_TABLE")
    small = rows(crosswalk.map_concordance(elements, names(spark)))
    monkeypatch.setattr(crosswalk, "fits_broadcast", lambda df: False)
    large = crosswalk.map_concordance(elements, names(spark))
    assert rows(large) == small
    assert "_salt" in large._jdf.queryExecution().analyzed().toString()


def test_projecting_the_crosswalk_twice_is_harmless(spark):
    once = crosswalk.project_concordance(names(spark))
    assert once.columns == ["XPATH", "VARIABLE_NAME", "RDB_TABLE"]
    assert rows(crosswalk.project_concordance(once)) == rows(once)


def test_attributes(spark):
    assert rows(shred.shred_attributes(filings(spark, COMPACT, "<r/>"))) == sorted([
        ("OID-0", "Return", "/Return", "returnVersion", "2020v1.0"),
        ("OID-0", "Form", "/Return/ReturnData/Form", "kind", "k"),
        ("OID-0", "Form", "/Return/ReturnData/Form", "n", "2")], key=repr)


def test_keys(spark):
    out = shred.extract_keys(filings(spark, COMPACT, "<r/>")).orderBy("OBJECTID").collect()
    assert tuple(out[0])[:7] == ("OID-0", f"{BASE}0_public.xml", "2020v1.0", "1", None, None, "2020")
    assert tuple(out[1]) == ("OID-1", f"{BASE}1_public.xml") + (None,) * 9


def test_failures_do_not_touch_other_filings(spark):
    bomb = '<!DOCTYPE r [<!ENTITY e "x">]><r>&e;</r>'
    mixed = filings(spark, "<r>", COMPACT, bomb, None)
    assert sorted(row.url[-12:-11] for row in shred.failed_filings(mixed).collect()) == ["0", "2", "3"]
    assert shred.shred_elements(mixed).select("OBJECTID").distinct().count() == 1
    counts = shred.shred_counts(shred.long_rows(mixed)).first()
    assert tuple(counts) == (1, 3, 11)


def test_one_huge_document_leaves_in_many_batches(spark):
    xml = "<r>" + "".join(f"<g><v>{i}</v></g>" for i in range(60_000)) + "</r>"
    out = shred.shred_elements(filings(spark, xml, COMPACT))
    got = out.where("OBJECTID = 'OID-0'").agg(
        F.count("*"), F.max("ORDER"), F.count_distinct("TABLE_ID"), F.max("TABLE_ID")).first()
    assert tuple(got) == (120_001, 120_001, 60_001, "TID-60000")


def test_files_and_packed_filings_read_alike(spark, tmp_path):
    landing = tmp_path / "xml"
    landing.mkdir()
    for name, xml in (("7_public.xml", INDENTED), ("a b+c_public.xml", "<r>\n<a/>\n</r>")):
        (landing / name).write_text(xml)
    read = read_filings(spark, str(landing), BASE)
    assert sorted(row.url for row in read.collect()) == [
        f"{BASE}7_public.xml", f"{BASE}a b+c_public.xml"]
    assert shred.shred_elements(read).count() == 13
    pack_filings(read, str(tmp_path / "packed"))
    assert rows(read_packed_filings(spark, str(tmp_path / "packed"))) == rows(read)


@pytest.mark.parametrize("parent_text", [True, False])
def test_large_documents_give_the_rows_of_small_ones(spark, monkeypatch, parent_text):
    docs = filings(spark, '<x:Return returnVersion="2020v1.0" xmlns:x="u"><a k="1">1<b/> 2</a><a/></x:Return>',
                   "<Return><a></Return>", "<r/>", "", None)
    known = rows(shred.long_rows(docs, parent_text=parent_text))
    monkeypatch.setattr(xml_rows, "LARGE", -1)
    assert rows(shred.long_rows(docs, parent_text=parent_text)) == known
    assert len(known) == 4 + 1 + 1 + 2
