"""Filing and organisation identifiers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the identifier formats.
FILE_SUFFIX = "_public.xml"
FILING_PREFIX = "OID-"
EIN_PREFIX = "EIN-"
# Folders in which hosts publish one file per filing, named by its number.
KNOWN_FOLDERS = ("EfileData/XmlFiles", "xml", "xml2/2022_TEOS_XML_01A", "xml2/2022_TEOS_XML_02A")


def object_id(url: Column, bases: Sequence[str] | None = None) -> Column:
    """Filing id of a URL.

    Known URL bases are removed, any other is kept whole, so that files of one name in two
    folders stay two filings. Known are `bases`, or else the known folders of any host.
    """
    if bases is None:
        folders = "|".join(_literal(folder) for folder in KNOWN_FOLDERS)
        name = F.regexp_replace(url, f"^https?://[^/]+/(?:{folders})/(?=[^/]*$)", "")
    else:
        pattern = "|".join(_literal(base) for base in bases)
        name = F.regexp_replace(url, pattern, "") if pattern else url
    return F.concat(F.lit(FILING_PREFIX), F.replace(name, F.lit(FILE_SUFFIX), F.lit("")))


def _literal(text: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", text)


def format_ein(ein: Column, to: str = "id") -> Column:
    """`id`: `EIN-12-3456789`, zero-padded to nine digits; `n`: digits only."""
    digits = F.regexp_replace(ein.cast("string"), "[^0-9]", "")
    if to == "n":
        return digits
    if to != "id":
        raise ValueError("`to` must be 'id' or 'n'")
    padded = F.when(F.length(digits) < 9, F.lpad(digits, 9, "0")).otherwise(digits)
    return F.concat(F.lit(EIN_PREFIX), F.substring(padded, 1, 2), F.lit("-"),
                    F.substring(padded, 3, 7))


def normalize_ids(df: DataFrame, url: str = "URL", ein: str = "EIN",
                  bases: Sequence[str] | None = None) -> DataFrame:
    """Adds OBJECTID from the URL, and EIN_ID and EIN_N from the EIN, where those exist."""
    added = {}
    if url in df.columns:
        added["OBJECTID"] = object_id(F.col(url), bases)
    if ein in df.columns:
        added["EIN_ID"] = format_ein(F.col(ein), "id")
        added["EIN_N"] = format_ein(F.col(ein), "n")
    return df.withColumns(added) if added else df
