"""Landed filings and filing indexes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shredloom import schemas


# Columns of files read whole, as Spark fixes them.
FILES = "path string, modificationTime timestamp, length long, content binary"

# A landing is packed into row groups of this size, so that a reader can skip most of them.
GROUP_BYTES = 8 << 20


def read_filings(spark: SparkSession, path: str | list[str], base: str | None = None) -> DataFrame:
    """`(url, xml)` of a directory of XML files, one document per file.

    The URL is the file's path, or `base` and the file's name. Documents stay as the bytes of
    the file: the parser decodes each as its byte order mark or declaration says.
    """
    return _named(spark.read.format("binaryFile").load(path), base)


def read_filing_stream(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """The same as a stream of newly landed files."""
    return _named(spark.readStream.format("binaryFile").schema(FILES).load(path), base)


def _named(files: DataFrame, base: str | None) -> DataFrame:
    file_path = F.col("_metadata.file_path")
    url = file_path if base is None else F.concat(
        F.lit(base), F.url_decode(F.replace(
            F.substring_index(file_path, "/", -1), F.lit("+"), F.lit("%2B"))))
    return files.select(url.alias("url"), F.col("content").alias("xml"))


def read_packed_filings(spark: SparkSession, path: str) -> DataFrame:
    """Filings packed as Parquet with `url` and `xml`: far fewer, larger files to list."""
    return spark.read.parquet(path)


def pack_filings(filings: DataFrame, path: str, mode: str = "errorifexists",
                 files: int | None = None, group_bytes: int = GROUP_BYTES,
                 dealt: bool = True, file_rows: int = 0) -> None:
    """Packs small files into Parquet for repeated use: a landing that readers can skip in.

    Documents are dealt and sorted by URL into small row groups with Bloom filters on the URL,
    so that an update which asks for few documents by URL reads few row groups. `dealt=False`
    moves no document: each task sorts what it has. With `file_rows` a file holds at most so
    many documents: the smaller the files, the fewer documents Spark gives one task to shred.
    """
    if dealt:
        filings = filings.repartitionByRange(*([files, "url"] if files else ["url"]))
    packed = filings.sortWithinPartitions("url").write.mode(mode)
    if file_rows:  # a filter as small as the file
        packed = packed.option("maxRecordsPerFile", file_rows).option(
            "parquet.bloom.filter.expected.ndv#url", file_rows)
    (packed.option("parquet.bloom.filter.enabled#url", "true")
     .option("parquet.block.size", group_bytes).parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A filing index with a header line: URL, TaxYear, FormType."""
    return spark.read.csv(path, header=True, schema=schemas.INDEX)


def same_year(year: int | str):
    """Year filter, compared as text so that 2021 and "2021" are alike."""
    return F.col("TaxYear").cast("string") == str(year)


def split_index_by_year(index: DataFrame, years: Iterable[int | str],
                        path: str | None = None) -> DataFrame:
    """The index of the asked years; with `path`, also stored by year."""
    wanted = sorted({str(year) for year in years})
    part = index.where(F.col("TaxYear").cast("string").isin(wanted))
    if path:
        part.write.mode("overwrite").partitionBy("TaxYear").parquet(path)
    return part
