"""The crosswalk from element paths to variable and table names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shredloom.operators.sizing import fits_broadcast

CROSSWALK_COLUMNS = ["XPATH", "VARIABLE_NAME", "RDB_TABLE"]
SALTS = 64


def project_concordance(concordance: DataFrame) -> DataFrame:
    """The three columns the mapping needs, in upper case. Harmless when applied twice."""
    by_upper = {name.upper(): name for name in concordance.columns}
    return concordance.select(*[F.col(by_upper[name]).alias(name) for name in CROSSWALK_COLUMNS])


def map_concordance(elements: DataFrame, crosswalk: DataFrame | None) -> DataFrame:
    """Left join on XPATH2; unmapped rows keep their last path segment and an empty table.

    A path listed twice in the crosswalk gives two rows. The same few paths occur in every
    filing, so a shuffle on the path alone would be skewed: a crosswalk within the broadcast
    bound is broadcast, a larger one is joined on the path and a salt.
    """
    if crosswalk is None:
        return elements.withColumns({
            "VARIABLE_NAME": F.substring_index("XPATH2", "/", -1), "RDB_TABLE": F.lit("")})
    names = project_concordance(crosswalk).select(
        F.col("XPATH").alias("_path"), F.col("VARIABLE_NAME").alias("_variable"),
        F.col("RDB_TABLE").alias("_table"))
    same_path = F.col("XPATH2") == F.col("_path")
    if fits_broadcast(names):
        joined = elements.join(F.broadcast(names), same_path, "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        joined = (
            elements
            .withColumn("_salt", F.pmod(F.xxhash64("OBJECTID", "ORDER"), F.lit(SALTS)).cast("int"))
            .join(names.select("*", salts.alias("_copy")),
                  same_path & (F.col("_salt") == F.col("_copy")), "left")
            .drop("_salt", "_copy")
        )
    return joined.withColumns({
        "VARIABLE_NAME": F.coalesce("_variable", F.substring_index("XPATH2", "/", -1)),
        "RDB_TABLE": F.coalesce("_table", F.lit("")),
    }).drop("_path", "_variable", "_table")
