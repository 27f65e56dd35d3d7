"""Headline timings as one JSON line. `BENCH_SF_DIR` and `BENCH_CPUS` choose data and cores."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from shredloom.operators import attributes, reports, shred, wide
from shredloom.plans import jobs
from shredloom.session import scratch_path, session
from shredloom.sources.store import LongStore
from shredloom_checks import fixtures as fx
from shredloom_checks.queries import YEARS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    """Runs a plan to its last row without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action):
        started = time.time()
        result = action()
        seconds[name] = round(time.time() - started, 3)
        return result

    # Input of the bench, not part of it: documents landed as Parquet, and warm workers.
    landed = fx.landed(spark, SF_DIR)
    docs, index, names = landed.select("url", "xml"), fx.index(spark, SF_DIR), fx.concordance(spark)
    run(shred.shred_elements(docs.limit(100), names))

    late = (F.col("TaxYear") == "1996") & (F.col("o_orderkey") % 100 == 0)
    store = LongStore(spark, scratch_path(spark, "bench"))
    counts = timed("shred_and_store", lambda: store.append(
        landed.where(~late).select("url", "xml", "TaxYear"), names))
    timed("update_year_1pct", lambda: jobs.update_year(store, docs, 1996, index, names))

    timed("shred_elements", lambda: run(shred.shred_elements(docs, names)))
    timed("shred_attributes", lambda: run(shred.shred_attributes(docs)))
    flat, keys = store.table("FLATXML"), store.table("KEYS")
    plain_keys = keys.drop("TaxYear")
    timed("build_table", lambda: run(wide.build_table(flat, plain_keys, names, fx.HEADER_TABLE)))
    timed("build_rdb_table", lambda: run(wide.build_rdb_table(
        flat, plain_keys, names, ["//Form/LineItemGrp"], fx.LINES_TABLE,
        paths=store.table("PATHS"))))
    timed("extract_tables", lambda: jobs.extract_tables(
        flat, keys, names, fx.table_headers(spark), [fx.HEADER_TABLE, fx.LINES_TABLE], YEARS,
        scratch_path(spark, "csv"), paths=store.table("PATHS")))
    timed("xpath_report", lambda: run(reports.summary_report(store.table("PATHS"))))
    timed("process_xpaths", lambda: run(reports.process_summary(
        store.table("PATHS"), YEARS, names, as_of_year=2001)))
    timed("summarize_attributes", lambda: run(
        attributes.summarize_sets(store.table("ATTRIBUTE_SETS"))))

    # Filings of about a thousand elements: every thirtieth one, its lines repeated. The share of
    # the total stays as it was; only the rate is reported.
    lines = F.regexp_extract("xml", "<LineItemGrp>.*</LineItemGrp>", 0)
    long_docs = landed.where(F.col("o_orderkey") % 30 == 0).select("url", "TaxYear", F.replace(
        "xml", F.lit("</Form>"), F.concat(F.repeat(lines, F.lit(40)), F.lit("</Form>"))).alias("xml"))
    started = time.time()
    long_counts = LongStore(spark, scratch_path(spark, "long")).append(long_docs, names)
    long_seconds = time.time() - started

    store_rate = counts["n_filings"] / seconds["shred_and_store"]
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "filings": counts["n_filings"], "elements": counts["n_elements"],
        "elements_per_long_filing": round(long_counts["n_elements"] / long_counts["n_filings"]),
        "elements_per_sec_stored_long_filings": round(long_counts["n_elements"] / long_seconds),
        "filings_per_sec_stored": round(store_rate),
        "elements_per_sec_shredded": round(counts["n_elements"] / seconds["shred_elements"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
