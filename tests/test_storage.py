import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from shredloom.operators import filing_index, merge, profile, shred
from shredloom.plans import jobs
from shredloom.sources import tables
from shredloom.sources.filings import (
    pack_filings, read_filing_stream, read_filings, read_packed_filings)
from shredloom.sources.store import LongStore, open_snapshot
from shredloom.streaming.updates import update_stream

BASE = "https://filings.example.org/xml/"


def filing(i, version="2020v1.0"):
    return (f"{BASE}{i}_public.xml", f'<Return returnVersion="{version}"><a k="1">{i}</a></Return>')


def filings(spark, *numbers, broken=()):
    data = [filing(i) for i in numbers] + [(f"{BASE}{i}_public.xml", "<oops>") for i in broken]
    return spark.createDataFrame(data, "url string, xml string")


def index(spark, *numbers, year="2020"):
    return spark.createDataFrame([(f"{BASE}{i}_public.xml", year, "990") for i in numbers],
                                 "URL string, TaxYear string, FormType string")


def ids(store, table="KEYS"):
    return sorted(row.OBJECTID for row in store.table(table).select("OBJECTID").distinct().collect())


def test_build_update_and_resume(spark, folder):
    store = LongStore(spark, folder)
    landed = filings(spark, 1, 2, 3, 4, broken=[8, 9])
    assert jobs.build_year(store, landed, 2020, index=index(spark, 1, 2, 8)) == {
        "n_filings": 2, "n_failed": 1, "n_elements": 4}
    assert ids(store) == ids(store, "FLATXML") == ids(store, "ATTRIBUTES") == ["OID-1", "OID-2"]
    assert [row.url for row in store.table("FAILED_URLS").collect()] == [f"{BASE}8_public.xml"]
    # Known failures are pending no more, but an update tries them again.
    assert jobs.resume_year(store, landed, "2020", index(spark, 1, 2, 8)) is None
    assert jobs.update_year(store, landed, "2020", index(spark, 1, 2, 3, 3))["n_filings"] == 1
    assert jobs.update_year(store, landed, 2020, index(spark, 1, 2, 3)) is None
    assert jobs.resume_year(store, landed, 2020, index(spark, 1, 2, 3, 4, 9))["n_failed"] == 1
    assert store.table("FLATXML").count() == 8 and ids(store)[-1] == "OID-4"
    assert jobs.build_year(store, landed, 2019, index=index(spark, 1)) is None


def test_a_url_landed_twice_is_stored_once(spark, folder):
    store = LongStore(spark, folder)
    twice = filings(spark, 1, 2).unionByName(filings(spark, 2))
    assert jobs.build_year(store, twice, 2020)["n_elements"] == 4


def test_unfinished_batches_are_invisible(spark, folder, monkeypatch):
    store = LongStore(spark, folder)
    year = filings(spark, 1, 2).withColumn("TaxYear", F.lit("2020"))
    write = LongStore._write

    def dies(self, table, batch, rows):
        if table == "KEYS":
            raise RuntimeError("lost")
        write(self, table, batch, rows)
    monkeypatch.setattr(LongStore, "_write", dies)
    with pytest.raises(RuntimeError):
        store.append(year, batch="b1")
    assert store.table("FLATXML").isEmpty() and store.table("ATTRIBUTES").isEmpty()
    monkeypatch.setattr(LongStore, "_write", write)
    assert store.append(year, batch="b1")["n_filings"] == 2
    assert store.append(year, batch="b1") is None
    assert store.table("FLATXML").count() == 4


def test_snapshot_views(spark, folder):
    store = LongStore(spark, folder)
    store.append(filings(spark, 1, 2).withColumn("TaxYear", F.lit("2020")))
    assert open_snapshot(spark, folder).first()[0] == 2
    assert spark.sql("SELECT count(*) FROM flatxml JOIN keys USING (OBJECTID)").first()[0] == 4
    assert {"attributes", "flatxml", "keys"} <= set(tables.list_tables(spark))
    plan = store.table("FLATXML", [2020]).where("RDB_TABLE = 'T' AND TYPE = 'terminal'").select("VALUE")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(RDB_TABLE,T)" in text and "EqualTo(TYPE,terminal)" in text
    assert "TaxYear" in text.split("PartitionFilters")[1].split("]")[0]


def test_stream_of_files_stores_each_filing_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = LongStore(spark, str(tmp_path / "store"))

    def land(*numbers):
        for i in numbers:
            (landing / f"{i}_public.xml").write_text(filing(i)[1])

    def run(checkpoint="offsets"):
        stream = read_filing_stream(spark, str(landing), BASE).withColumn("TaxYear", F.lit("2020"))
        update_stream(stream, store, str(tmp_path / checkpoint), name=checkpoint).awaitTermination()
    land(1, 2)
    run()
    land(3)
    run()
    run()
    assert ids(store) == ["OID-1", "OID-2", "OID-3"] and store.table("FLATXML").count() == 6
    run("again")  # a new stream over the same files finds them all stored
    assert store.table("FLATXML").count() == 6


def test_merge_update_is_idempotent(spark):
    def side(*numbers):
        keys = spark.createDataFrame([(f"OID-{i}", i) for i in numbers], "OBJECTID string, n int")
        return {"KEYS": keys, "FLATXML": keys.withColumn("extra" if 9 in numbers else "old", F.lit("x")),
                "OTHER": keys}
    once = merge.merge_update(side(1, 2), side(2, 9))
    assert set(once) == {"KEYS", "FLATXML"}
    assert rows(once["FLATXML"]) == [("OID-1", 1, "x", None), ("OID-2", 2, "x", None), ("OID-9", 9, None, "x")]
    assert rows(merge.merge_update(once, side(2, 9))["KEYS"]) == rows(once["KEYS"])


def test_merge_counts_and_mismatches(spark):
    full = {"KEYS": spark.range(3), "FLATXML": spark.range(5)}
    parts = [{"KEYS": spark.range(3)}, {"KEYS": spark.range(0), "ATTRIBUTES": spark.range(1)}]
    out = merge.validate_merge(full, parts)
    assert [tuple(row) for row in out.collect()] == [
        ("FLATXML", 5, None, None, None), ("KEYS", 3, 3, 2, True), ("ATTRIBUTES", None, 1, 1, False)]
    assert merge.mismatches(out).count() == 2
    with pytest.raises(ValueError):
        merge.validate_merge(full, [])
    with pytest.raises(ValueError):
        merge.merge_shards([])


def test_missing_filings_treat_null_as_a_value(spark):
    listed = spark.createDataFrame([("u1", "2020"), ("u1", "2020"), (None, "2020"), ("u2", "2020"), ("u3", "2021")],
                                   "URL string, TaxYear string")
    stored = spark.createDataFrame([("u2",)], "URL string")
    assert rows(filing_index.missing_filings(listed, stored, 2020)) == sorted([("u1",), (None,)], key=repr)
    with_null = stored.unionByName(spark.createDataFrame([(None,)], "URL string"))
    assert rows(filing_index.missing_filings(listed, with_null, "2020")) == [("u1",)]


@pytest.mark.parametrize("ranges", [1, 7])
def test_chunk_labels_with_one_dominant_year_and_url(spark, ranges):
    listed = spark.range(5_003).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("URL"),
        F.when(F.col("id") % 10 < 7, F.lit("2020")).when(F.col("id") % 10 == 7, F.lit(None)).otherwise(F.lit("2021")).alias("TaxYear"))
    got = filing_index.label_chunks(listed, 25, partitions=ranges)
    year = Window.partitionBy("TaxYear")
    place = F.row_number().over(year.orderBy("URL"))
    total = F.count(F.lit(1)).over(year)
    want = listed.withColumn("p", place).withColumn("n", total).selectExpr(
        "URL", "TaxYear", """concat('G', lpad(ceil(p / 25), length(ceil(n / 25)), '0'), '{',
        CASE WHEN ceil(p / 25) < ceil(n / 25) THEN 25 ELSE n - (ceil(n / 25) - 1) * 25 END, '}') AS chunk""")
    assert rows(got) == rows(want)


def test_tables_grow_columns(spark, folder):
    old = spark.createDataFrame([(1, "x")], "k int, a string")
    new = spark.createDataFrame([("y", 2)], "b string, k int")
    tables.append_long_tables([{"KEYS": old}, {"FLATXML": old}], folder)
    tables.append_long_tables([{"KEYS": new}], folder)
    assert rows(tables.read_rows(spark, f"{folder}/KEYS").select("k", "a", "b")) == [
        ("1", "x", None), ("2", None, "y")]
    assert tables.align_columns(new, ["k", "a"]).columns == ["k", "a", "b"]


def test_created_tables_are_not_overwritten(spark, folder):
    tables.create_as(spark.range(2), f"{folder}/t")
    tables.insert_as(spark.range(1), f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 3
    with pytest.raises(Exception, match="(?i)exists"):
        tables.create_as(spark.range(1), f"{folder}/t")


def test_stream_takes_a_filing_landed_twice_once(spark, tmp_path):
    store = LongStore(spark, str(tmp_path / "store"))
    landing = str(tmp_path / "landing")
    both = filings(spark, 1, 2).unionByName(filings(spark, 2, broken=[7])).withColumn("TaxYear", F.lit("2020"))
    both.write.parquet(landing)
    stream = spark.readStream.schema(both.schema).parquet(landing)
    update_stream(stream, store, str(tmp_path / "offsets")).awaitTermination()
    assert ids(store) == ["OID-1", "OID-2"] and store.table("FLATXML").count() == 4
    assert store.table("FAILED_URLS").count() == 1


def test_one_url_may_belong_to_two_years(spark, folder):
    store = LongStore(spark, folder)
    listed = index(spark, 1, 2).unionByName(index(spark, 2, year="2021"))
    assert jobs.build_years(store, filings(spark, 1, 2), listed)["n_elements"] == 6
    assert rows(store.table("KEYS").select("TaxYear", "OBJECTID")) == [
        ("2020", "OID-1"), ("2020", "OID-2"), ("2021", "OID-2")]
    assert jobs.build_years(store, filings(spark, 1, 2), listed, [2020, "2021"]) is None
    assert store.table("FLATXML", [2021]).count() == 2


def test_streams_with_default_names_lose_nothing(spark, tmp_path):
    store = LongStore(spark, str(tmp_path / "store"))
    for n, numbers in enumerate(((1, 2), (3, 4), (1, 2))):
        path = str(tmp_path / f"landing{n}")
        landed = filings(spark, *numbers).withColumn("TaxYear", F.lit("2021" if n == 2 else "2020"))
        landed.write.parquet(path)
        stream = spark.readStream.schema(landed.schema).parquet(path)
        update_stream(stream, store, str(tmp_path / f"offsets{n}")).awaitTermination()
    assert rows(store.table("KEYS").select("TaxYear", "OBJECTID")) == [
        ("2020", f"OID-{i}") for i in (1, 2, 3, 4)] + [("2021", "OID-1"), ("2021", "OID-2")]


def test_a_filing_in_two_years_and_one_without_in_one_batch(spark, tmp_path):
    store, path = LongStore(spark, str(tmp_path / "store")), str(tmp_path / "landing")
    landed = filings(spark, 1).crossJoin(spark.createDataFrame(
        [("2020",), ("2021",), (None,)], "TaxYear string"))
    landed.write.parquet(path)
    stream = spark.readStream.schema(landed.schema).parquet(path)
    for checkpoint in ("one", "reset"):
        update_stream(stream, store, str(tmp_path / checkpoint)).awaitTermination()
    assert rows(store.table("KEYS").select("TaxYear")) == [("2020",), ("2021",), (None,)]


def test_two_documents_with_one_id_are_not_mixed(spark, folder):
    store = LongStore(spark, folder)
    other = "https://elsewhere.example.org/xml/1_public.xml"
    two = filings(spark, 1).unionByName(spark.createDataFrame(
        [(other, "<Return><b>2</b></Return>")], "url string, xml string"))
    listed = index(spark, 1).unionByName(spark.createDataFrame(
        [(other, "2020", "990")], "URL string, TaxYear string, FormType string"))
    for _ in range(3):
        jobs.update_year(store, two, 2020, listed)
        assert store.table("FLATXML").count() == 2 and store.table("KEYS").count() == 1
        assert [(row.stage, BASE in row.reason) for row in store.table("FAILED_URLS").collect()] == [
            ("identity", False)]


def test_files_of_one_name_in_two_folders_are_two_filings(spark, folder):
    store = LongStore(spark, folder)
    other = "https://filings.example.org/other/1_public.xml"
    two = filings(spark, 1).unionByName(spark.createDataFrame(
        [(other, "<Return><b>2</b></Return>")], "url string, xml string"))
    listed = index(spark, 1).unionByName(spark.createDataFrame(
        [(other, "2020", "990")], "URL string, TaxYear string, FormType string"))
    for _ in range(2):
        jobs.update_year(store, two, 2020, listed)
        assert store.table("FLATXML").count() == 4 and store.table("FAILED_URLS").isEmpty()
        assert rows(store.table("KEYS").select("OBJECTID", "URL")) == [
            ("OID-1", f"{BASE}1_public.xml"), (f"OID-{other[:-len('_public.xml')]}", other)]


def test_dead_letters_are_unique_and_go_once_stored(spark, folder):
    store, listed = LongStore(spark, folder), index(spark, 1, 2)
    for _ in range(2):
        jobs.update_year(store, filings(spark, 1, broken=[2]), 2020, listed)
    assert store.table("FAILED_URLS").count() == 1
    jobs.update_year(store, filings(spark, 1, 2), 2020, listed)
    assert store.table("FAILED_URLS").isEmpty() and ids(store) == ["OID-1", "OID-2"]


def test_merge_update_keeps_a_second_year(spark):
    def side(*years):
        return {"KEYS": spark.createDataFrame([(y, "OID-1") for y in years], "TaxYear string, OBJECTID string")}
    assert rows(merge.merge_update(side("2020"), side("2020", "2021"))["KEYS"]) == [
        ("2020", "OID-1"), ("2021", "OID-1")]


ENCODED = {
    "a": '<?xml version="1.0" encoding="ISO-8859-1"?><r v="ü">é</r>'.encode("latin-1"),
    "b": '<r v="ü">é</r>'.encode(),
    "c": '<?xml version="1.0" encoding="UTF-16"?><r v="ü">é</r>'.encode("utf-16"),
    "d": '<?xml version="1.0" encoding="windows-1252"?><r v="ü">é</r>'.encode("cp1252"),
    "e": '<?xml version="1.0" encoding="UTF-8"?><r v="ü">é</r>'.encode("utf-8-sig"),
}


def land_encoded(folder):
    folder.mkdir()
    for name, data in ENCODED.items():
        (folder / f"{name}.xml").write_bytes(data)
    (folder / "f.xml").write_bytes(b'<?xml version="1.0" encoding="no-such-one"?><r/>')
    (folder / "g.xml").write_bytes(b"<r>\xff</r>")


def encoded_results(store):
    found = {row.OBJECTID: row.attr_value for row in store.table("ATTRIBUTES").collect()}
    assert found == {f"OID-{name}.xml": "ü" for name in ENCODED}
    assert {row.url[-5:] for row in store.table("FAILED_URLS").collect()} == {"f.xml", "g.xml"}


def test_files_are_read_by_the_encoding_they_declare(spark, tmp_path):
    land_encoded(tmp_path / "xml")
    store = LongStore(spark, str(tmp_path / "store"))
    jobs.build_year(store, read_filings(spark, str(tmp_path / "xml"), BASE), 2020)
    encoded_results(store)
    elements = shred.shred_elements(read_filings(spark, str(tmp_path / "xml")), parent_text=True)
    assert elements.count() == len(ENCODED)


def test_a_stream_reads_the_same_encodings(spark, tmp_path):
    land_encoded(tmp_path / "xml")
    store = LongStore(spark, str(tmp_path / "store"))
    stream = read_filing_stream(spark, str(tmp_path / "xml"), BASE).withColumn("TaxYear", F.lit("2020"))
    update_stream(stream, store, str(tmp_path / "offsets")).awaitTermination()
    encoded_results(store)


def scanned(df):
    """Rows that the file scans of a plan gave, after running it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value()
               for k in range(leaves.size()) if "FileScan" in leaves.apply(k).toString()
               or "Scan parquet" in leaves.apply(k).toString())


def test_an_update_reads_few_row_groups_of_a_packed_landing(spark, tmp_path):
    docs = spark.range(20_000).select(
        F.format_string(f"{BASE}%06d_public.xml", "id").alias("url"),
        F.concat(F.lit('<Return returnVersion="2020v1.0"><a>'), F.sha2(F.col("id").cast("string"), 512),
                 F.lit("</a></Return>")).alias("xml"))
    pack_filings(docs, str(tmp_path / "packed"), files=4, group_bytes=1 << 15)
    packed = read_packed_filings(spark, str(tmp_path / "packed"))
    urls = [f"{BASE}{k:06d}_public.xml" for k in range(0, 20_000, 1_000)]
    asked = packed.where(F.col("url").isin(urls))
    assert asked.count() == 20 and scanned(packed) == 20_000
    assert scanned(asked) < 0.2 * 20_000
    # One that is not there lies between the smallest and largest URL, and reads nothing much.
    none = packed.where(F.col("url") == f"{BASE}010000x_public.xml")
    assert scanned(none) < 0.02 * 20_000

    store = LongStore(spark, str(tmp_path / "store"))
    index = docs.select(F.col("url").alias("URL"), F.lit("2020").alias("TaxYear"))
    first = index.where(~F.col("URL").isin(urls))
    assert jobs.update_year(store, packed, 2020, first)["n_filings"] == 19_980
    assert jobs.update_year(store, packed, 2020, index)["n_filings"] == 20
    assert jobs.update_year(store, packed, 2020, index) is None
    values = store.table("FLATXML").where("XPATH2 = '/Return/a'")
    want = docs.select(F.md5(F.concat_ws("", F.col("url"), F.col("xml"))))
    assert values.count() == want.count() == store.table("KEYS").select("URL").distinct().count()


def test_profile_survives_an_unreadable_table(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"PAR1 this is no table PAR1")
    schema = "id long"
    found = profile.profile_tables(spark, {
        name: spark.read.schema(schema).parquet(str(tmp_path / name)) for name in ("good", "bad")}, 2)
    by = {row.table_name: row for row in found.collect()}
    assert by["good"].n_rows == 3 and len(by["good"].first_rows) == 2 and by["good"].error is None
    assert by["bad"].n_rows is None and by["bad"].error


def test_compaction_keeps_rows_in_few_files(spark, tmp_path):
    store = LongStore(spark, str(tmp_path))
    for i in (1, 2, 3, 4):
        store.append(filings(spark, i, broken=[i + 10]).repartition(3).withColumn(
            "TaxYear", F.lit("2020")), batch=f"b{i}")
    tables_before = {name: rows(store.table(name)) for name in ("FLATXML", "KEYS", "ATTRIBUTES", "FAILED_URLS")}
    assert store.compact() == {"n_filings": 4, "n_failed": 4, "n_elements": 8}
    assert store.commits().count() == 1 and store.has_batch("b1")
    assert {name: rows(store.table(name)) for name in tables_before} == tables_before
    files = [p for p in (tmp_path / "FLATXML").rglob("part-*.parquet") if "BATCH=compact" in str(p)]
    assert len(files) == 2  # one good and one failed
    assert sorted(store.remove_replaced()) == ["b1", "b2", "b3", "b4"] and store.compact() is None
    assert {name: rows(store.table(name)) for name in tables_before} == tables_before
    store.append(filings(spark, 5).withColumn("TaxYear", F.lit("2020")))
    assert store.compact()["n_filings"] == 5 and ids(store)[-1] == "OID-5"
