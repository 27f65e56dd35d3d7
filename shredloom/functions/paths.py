"""Expressions over element paths. All of them stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The namespace prefixes that XPATH2 drops.
PATH_PREFIXES = ("irs:", "efile:")


def normalize_path(xpath: Column, legacy: bool = False) -> Column:
    """Path without sibling indexes and without the known prefixes.

    `legacy=True` drops only the last prefix and keeps the indexes, for results that must
    equal tables made before indexes were really removed.
    """
    if legacy:
        return F.replace(xpath, F.lit(PATH_PREFIXES[-1]), F.lit(""))
    # Most paths have no index: the pattern is tried only on those that do.
    out = F.when(F.contains(xpath, F.lit("[")), F.regexp_replace(xpath, r"\[[0-9]+\]", "")
                 ).otherwise(xpath)
    for prefix in PATH_PREFIXES:
        out = F.replace(out, F.lit(prefix), F.lit(""))
    return out


def last_index(xpath: Column) -> Column:
    """The last `[n]` anywhere on the path as text, `0` when there is none."""
    found = F.regexp_extract(xpath, r"^.*\[(\d+)\]", 1)
    return F.when(found == "", F.lit("0")).otherwise(found)


def table_id(xpath: Column) -> Column:
    """`TID-` and the last index, at least five digits wide."""
    inside = F.substring_index(F.substring_index(xpath, "[", -1), "]", 1)
    # Text after the last bracket is nearly always the index; the pattern is for the rest.
    number = F.coalesce(inside.try_cast("bigint"), last_index(xpath).try_cast("bigint"))
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(5)), F.lit("0"))
    return F.when(F.contains(xpath, F.lit("[")), F.concat(F.lit("TID-"), padded)
                  ).otherwise(F.lit("TID-00000"))


def table_header(xpath: Column, node_type: Column) -> Column:
    """Two nodes of context: the element and its parent, or the parent and grandparent.

    The root is never context of itself: `/A` as a parent gives `//`, `/A/B` gives `//B`.
    """
    after_root = F.locate("/", xpath, 2)
    own = F.when(after_root > 0, F.substring(xpath, after_root, F.length(xpath))
                 ).otherwise(F.lit(""))
    above = F.substring(xpath, F.lit(1), F.length(xpath) - F.length(leaf_name(xpath)) - 1)
    context = F.when(node_type == "parent", own).otherwise(above)
    return F.concat(F.lit("//"), F.ltrim(F.substring_index(context, "/", -2), F.lit("/")))


def leaf_name(xpath: Column) -> Column:
    """Last segment of a path."""
    return F.substring_index(xpath, "/", -1)


def local_name(xpath: Column) -> Column:
    """Last segment without its prefix and sibling index."""
    return F.substring_index(F.regexp_replace(leaf_name(xpath), r"\[\d+\]$", ""), ":", -1)


def node_type(n_children: Column) -> Column:
    """`parent` when the element holds other elements, else `terminal`."""
    return F.when(n_children > 0, F.lit("parent")).otherwise(F.lit("terminal"))


def root_version(version: Column) -> Column:
    """Text stored as the value of a root element."""
    return F.concat(F.lit("VERSION: "), F.coalesce(version, F.lit("NA")))


def under_headers(xpath: Column, headers: list[str], legacy_regex: bool = False) -> Column:
    """Whether a path lies at or below one of the headers (`//a/b` matches segment-wise).

    `legacy_regex=True` takes the headers as one unanchored pattern, which also matches
    longer names (`/a/bGrp` for `//a/b`).
    """
    if not headers:
        return F.lit(False)
    wanted = [header.replace("//", "/") for header in headers]
    if legacy_regex:
        return xpath.rlike("|".join(wanted))
    closed = F.concat(xpath, F.lit("/"))
    hit = F.lit(False)
    for header in wanted:
        hit = hit | F.contains(closed, F.lit(header.rstrip("/") + "/"))
    return hit


def derive_paths(elements: DataFrame, legacy_paths: bool = False) -> DataFrame:
    """Adds XPATH2, TYPE, TABLE_ID, TABLE_HEADER and LEAF_NAME to a table of elements.

    Needs XPATH, and N_CHILDREN unless TYPE is there already.
    """
    if "TYPE" not in elements.columns:
        elements = elements.withColumn("TYPE", node_type(F.col("N_CHILDREN")))
    return (
        elements
        .withColumn("XPATH2", normalize_path(F.col("XPATH"), legacy_paths))
        .withColumns({
            "TABLE_ID": table_id(F.col("XPATH")),
            "TABLE_HEADER": table_header(F.col("XPATH2"), F.col("TYPE")),
            "LEAF_NAME": leaf_name(F.col("XPATH2")),
        })
    )
