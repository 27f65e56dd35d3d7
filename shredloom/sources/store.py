"""The long store: FLATXML, ATTRIBUTES, KEYS, dead letters and summaries in Parquet, one root.

    <root>/<table>/BATCH=<id>/TaxYear=<year>/…      FLATXML also by STATUS=ok|failed
    <root>/COMMITS/                                 one row per finished batch, written last

A batch is parsed once: FLATXML keeps each element's attributes and the filing's URL, so the
other tables are pruned scans of what was just written. Readers see only batches with a
commit row; a run that died half way leaves files nobody reads, and running it again cannot
duplicate anything.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shredloom import schemas
from shredloom.operators.attributes import attribute_sets
from shredloom.operators.identity import matched
from shredloom.operators.shred import attributes_of, failures_of, keys_of, long_rows, paths_of
from shredloom.session import path_exists, remove_path

ROWS_PER_FILE = 4_000_000  # of a compacted table
# What no reader here uses is not made: histograms of sizes, and dictionaries of texts, which
# outgrow them.
PARQUET = {"parquet.size.statistics.enabled": "false"}
FLAT_PARQUET = {**PARQUET, "parquet.enable.dictionary#VALUE": "false"}

YEAR = T.StructField("TaxYear", T.StringType())
BATCH = T.StructField("BATCH", T.StringType())
TABLES = {
    "FLATXML": schemas.FLATXML_STORED.fields + [T.StructField("STATUS", T.StringType())],
    "ATTRIBUTES": schemas.ATTRIBUTES.fields,
    "KEYS": schemas.KEYS.fields,
    "PATHS": schemas.PATHS.fields,
    "ATTRIBUTE_SETS": schemas.ATTRIBUTE_SETS.fields,
    "FAILED_URLS": schemas.FAILED_URLS.fields,
}
USER_COLUMNS = {
    "FLATXML": schemas.FLATXML, "ATTRIBUTES": schemas.ATTRIBUTES, "KEYS": schemas.KEYS,
    "PATHS": schemas.PATHS, "ATTRIBUTE_SETS": schemas.ATTRIBUTE_SETS, "FAILED_URLS": schemas.FAILED_URLS,
}


@dataclass(frozen=True)
class LongStore:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _all_commits(self) -> DataFrame:
        return self._stored("COMMITS", schemas.COMMITS_STORED)

    def commits(self) -> DataFrame:
        """One row per finished batch that no compaction has replaced."""
        commits = self._all_commits()
        replaced = commits.select(F.explode("REPLACES").alias("BATCH"))
        return commits.join(replaced, "BATCH", "left_anti").select(*schemas.COMMITS.fieldNames())

    def _stored(self, table: str, schema: T.StructType) -> DataFrame:
        if not path_exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def table(self, name: str, years: list[int | str] | None = None) -> DataFrame:
        """Rows of finished batches, with TaxYear; only the asked years are scanned."""
        schema = T.StructType(TABLES[name] + [YEAR, BATCH])
        rows = self._stored(name, schema).join(
            self.commits().select("BATCH"), "BATCH", "left_semi")
        if years is not None:
            rows = rows.where(F.col("TaxYear").isin([str(year) for year in years]))
        if name == "FLATXML":
            rows = rows.where(F.col("STATUS") == "ok")
        if name == "FAILED_URLS":
            rows = self._still_failed(rows, years)
        return rows.select(*USER_COLUMNS[name].fieldNames(), "TaxYear")

    def _still_failed(self, rows: DataFrame, years) -> DataFrame:
        """One dead letter per document and year, without those stored since."""
        once = rows.groupBy("TaxYear", "url").agg(
            F.min(F.struct("stage", "reason")).alias("why")).select(
            "TaxYear", "url", "why.stage", "why.reason")
        done = self.table("KEYS", years).select("TaxYear", F.col("URL").alias("url"))
        return matched(once, done, ["TaxYear", "url"], "left_anti")

    def has_batch(self, batch: str) -> bool:
        return not self._all_commits().where(F.col("BATCH") == batch).isEmpty()

    def append(self, filings: DataFrame, crosswalk: DataFrame | None = None,
               batch: str | None = None, refused: DataFrame | None = None,
               **options) -> dict[str, int] | None:
        """Shreds filings `(url, xml, TaxYear)` into the store; returns the counts.

        With a `batch` id of the caller's, a batch finished before is left alone (None).
        `refused` are documents that get dead letters unread: `(TaxYear, url, stage, reason)`.
        """
        if batch is None:
            batch = uuid.uuid4().hex
        elif self.has_batch(batch):
            return None
        filings = filings.select("url", "xml", F.col("TaxYear").cast("string").alias("TaxYear"))
        rows = long_rows(filings, crosswalk, **options).withColumn(
            "STATUS", F.when(F.col("ERROR").isNull(), F.lit("ok")).otherwise(F.lit("failed")))
        # Sorted so that Parquet statistics skip parents and other tables, and a filing's rows
        # of one table lie together: pivots then combine them before the shuffle.
        shredded, keyed = Observation(), Observation()
        (rows.sortWithinPartitions("TaxYear", "STATUS", "TYPE", "RDB_TABLE", "OBJECTID", "ORDER")
         .observe(shredded, F.count_if(F.col("ERROR").isNotNull()).alias("n_failed"),
                  F.count_if(F.col("ERROR").isNull()).alias("n_elements"))
         .write.mode("overwrite").options(**FLAT_PARQUET).partitionBy("TaxYear", "STATUS")
         .parquet(self._batch_path("FLATXML", batch)))

        stored = self.spark.read.schema(T.StructType(TABLES["FLATXML"] + [YEAR])).parquet(
            self._batch_path("FLATXML", batch))
        good = stored.where(F.col("STATUS") == "ok")
        self._write("ATTRIBUTES", batch, attributes_of(good))
        self._write("ATTRIBUTE_SETS", batch, attribute_sets(self.spark.read.schema(
            T.StructType(TABLES["ATTRIBUTES"] + [YEAR])).parquet(
                self._batch_path("ATTRIBUTES", batch))))
        self._write("PATHS", batch, paths_of(good).coalesce(1))
        failures = failures_of(stored.where(F.col("STATUS") == "failed"))
        self._write("FAILED_URLS", batch, failures if refused is None else failures.unionByName(
            refused.withColumn("TaxYear", F.col("TaxYear").cast("string"))))
        self._write("KEYS", batch, keys_of(good).observe(
            keyed, F.count(F.lit(1)).alias("n_filings")))

        counts = {**keyed.get, **shredded.get}
        self._commit(batch, counts, [])
        return counts

    def _commit(self, batch: str, counts: dict[str, int], replaces: list[str]) -> None:
        row = (batch, counts["n_filings"], counts["n_failed"], counts["n_elements"], replaces)
        (self.spark.createDataFrame([row], schemas.COMMITS_STORED)
         .coalesce(1).write.mode("append").parquet(self.path("COMMITS")))

    def compact(self, rows_per_file: int = ROWS_PER_FILE) -> dict[str, int] | None:
        """Rewrites all finished batches as one, in few files; None with fewer than two batches.

        Rows are dealt by ranges of year, type, table and filing, so that a table's rows lie in
        few files and scans skip the others. One commit row makes the new batch visible and the
        old ones invisible; batches finished meanwhile stay as they are. `remove_replaced`
        deletes the old files, once no reader has them open.
        """
        done = self.commits().collect()  # one row per batch
        if len(done) < 2:
            return None
        counts = {name: sum(row[name] for row in done)
                  for name in ("n_filings", "n_failed", "n_elements")}
        old, batch = [row.BATCH for row in done], f"compact-{uuid.uuid4().hex}"
        kept = F.col("BATCH").isin(old)
        by = ("TaxYear", "STATUS", "TYPE", "RDB_TABLE", "OBJECTID", "ORDER")
        flat = self._stored("FLATXML", T.StructType(TABLES["FLATXML"] + [YEAR, BATCH]))
        (self._in_ranges(flat.where(kept).drop("BATCH"), by, counts["n_elements"], rows_per_file)
         .write.mode("overwrite").options(**FLAT_PARQUET).partitionBy("TaxYear", "STATUS")
         .parquet(self._batch_path("FLATXML", batch)))
        for name, order, n in (("ATTRIBUTES", ("TaxYear", "OBJECTID"), counts["n_elements"]),
                               ("KEYS", ("TaxYear", "OBJECTID"), counts["n_filings"]),
                               ("FAILED_URLS", ("TaxYear", "url"), counts["n_failed"])):
            rows = self._stored(name, T.StructType(TABLES[name] + [YEAR, BATCH]))
            self._write(name, batch, self._in_ranges(
                rows.where(kept).drop("BATCH"), order, n, rows_per_file))
        paths = self._stored("PATHS", T.StructType(TABLES["PATHS"] + [YEAR, BATCH])).where(kept)
        by = ("TaxYear", "XPATH2", "TYPE", "RDB_TABLE", "VERSION")
        self._write("PATHS", batch, paths.groupBy(*by).agg(
            F.sum("n_rows").alias("n_rows")).coalesce(1))
        by = ("TaxYear", "attr_name", "kind", "item")
        sets = self._stored("ATTRIBUTE_SETS", T.StructType(
            TABLES["ATTRIBUTE_SETS"] + [YEAR, BATCH])).where(kept)
        self._write("ATTRIBUTE_SETS", batch, self._in_ranges(
            sets.groupBy(*by).agg(F.sum("n_rows").alias("n_rows")), by, counts["n_elements"],
            rows_per_file))
        self._commit(batch, counts, old)
        return counts

    def _in_ranges(self, rows: DataFrame, by, count: int, per_file: int) -> DataFrame:
        return rows.repartitionByRange(max(1, -(-count // per_file)), *by).sortWithinPartitions(*by)

    def remove_replaced(self) -> list[str]:
        """Deletes the files of batches that a compaction has replaced; returns their ids."""
        gone = [row[0] for row in self._all_commits().select(F.explode("REPLACES")).collect()]
        for batch in gone:
            for name in TABLES:
                remove_path(self.spark, self._batch_path(name, batch))
        return gone

    def _batch_path(self, table: str, batch: str) -> str:
        return f"{self.path(table)}/BATCH={batch}"

    def _write(self, table: str, batch: str, rows: DataFrame) -> None:
        (rows.write.mode("overwrite").options(**PARQUET).partitionBy("TaxYear")
         .parquet(self._batch_path(table, batch)))

    def tables(self) -> list[str]:
        """The tables that have been written, in order of name."""
        return [name for name in sorted(TABLES) if path_exists(self.spark, self.path(name))]

    def open(self, years: list[int | str] | None = None) -> DataFrame:
        """Registers flatxml, attributes and keys as views; returns how many returns there are."""
        for name in ("FLATXML", "ATTRIBUTES", "KEYS"):
            self.table(name, years).createOrReplaceTempView(name.lower())
        return self.table("KEYS", years).agg(F.count(F.lit(1)).alias("n_returns"))


def open_snapshot(spark: SparkSession, root: str,
                  years: list[int | str] | None = None) -> DataFrame:
    """A stored snapshot as views `flatxml`, `attributes`, `keys`, and its number of returns."""
    return LongStore(spark, root).open(years)
