"""What keeps shredding in proportion to its input: small landed files, ids and paths made once."""

import glob

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shredloom.functions import paths
from shredloom.operators import xml_rows
from shredloom.operators.shred import long_rows
from shredloom.sources.filings import pack_filings

ODD_PATHS = ["/A", "/A/B", "/A/B[2]", "/A/B[12]/C", "/A[1]/irs:B[3]/efile:C", "/irs:A", "/irs:",
             "/A/efile:irs:B[100000]/C.d-e_f/G", "/Ä/ß[7]/日本/irs:x", "/A/efile:", "/A/Birs:C"]


@pytest.mark.parametrize("legacy", [False, True])
def test_texts_of_paths_are_those_of_the_expressions(spark, legacy):
    cases = [(path, kids) for path in ODD_PATHS for kids in (0, 2)] + [(None, None)]
    wanted = paths.derive_paths(
        spark.createDataFrame(cases, "XPATH string, N_CHILDREN int").coalesce(1), legacy)
    got = xml_rows.PathTexts(paths.PATH_PREFIXES, legacy).columns(
        pa.array([c[0] for c in cases], pa.string()), pa.array([c[1] for c in cases], pa.int32()))
    assert [tuple(row) for row in wanted.select("XPATH2", "TABLE_ID", "TABLE_HEADER").collect()
            ] == list(zip(*(column.to_pylist() for column in got)))


def test_ids_are_made_before_documents_become_elements(spark):
    docs = spark.createDataFrame([("https://x.org/1_public.xml", "<A><B/></A>")],
                                 "url string, xml string")
    plan = long_rows(docs)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("MapInArrow", 1)
    assert "regexp" not in above.lower() and "AS OBJECTID" in below


@pytest.mark.parametrize("large", [False, True])
def test_root_texts_and_repeated_urls_stay_in_the_document(monkeypatch, large):
    if large:
        monkeypatch.setattr(xml_rows, "LARGE", 1)
    docs = pa.RecordBatch.from_pydict({
        "url": ["u1", "u2", "u3"], "xml": ["<A v='1'><B>x<C>y</C></B><B>z</B></A>", "<A>t</A>", "no"]})

    def rows(**options):
        return sorted((row for batch in xml_rows.element_batches(**options)(iter([docs]))
                       for row in batch.select(["url", "ORDER", "XPATH", "VALUE"]).to_pylist()),
                      key=lambda row: (row["url"] or "", row["XPATH"] or ""))

    whole, lean = rows(), rows(root_text=False, once=("url",))
    assert [row["VALUE"] for row in whole if row["ORDER"] == 1] == ["xyz", "t"]
    wanted = [{**row, "url": row["url"] if row["ORDER"] <= 1 else None,
               "VALUE": row["VALUE"] if row["ORDER"] != 1 else None} for row in whole]
    assert lean == sorted(wanted, key=lambda row: (row["url"] or "", row["XPATH"] or ""))


def test_long_rows_ask_for_no_root_text(spark, monkeypatch):
    asked = []
    make = xml_rows.element_batches
    monkeypatch.setattr(xml_rows, "element_batches", lambda *a, **k: asked.append(a) or make(*a, **k))
    docs = spark.createDataFrame([("u", "<A returnVersion='7'><B>x</B></A>")], "url string, xml string")
    rows = long_rows(docs).orderBy("ORDER").select("URL", "VALUE").collect()
    assert [tuple(row) for row in rows] == [("u", "VERSION: 7"), (None, "x")]
    assert asked[0][2:] == (False, ("url",))


def test_landed_files_hold_few_documents(spark, tmp_path):
    docs = spark.range(0, 95, 1, 2).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.lit("<A/>").alias("xml"))
    pack_filings(docs, str(tmp_path / "packed"), dealt=False, file_rows=10)
    assert len(glob.glob(str(tmp_path / "packed" / "*.parquet"))) == 10
    assert spark.read.parquet(str(tmp_path / "packed")).distinct().count() == 95
