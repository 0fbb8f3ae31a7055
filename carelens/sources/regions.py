"""The region look-up: codes, names and short names held as parallel arrays in a configuration file."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.fixed_values import REGIONS
from carelens.operators.joins import broadcast_when_small

_FIELDS = "code int, ncc string, nom string"


def read_region_config(spark: SparkSession, path: str) -> DataFrame:
    """Region rows from a JSON configuration: the arrays of each entry are zipped by position."""
    entry = "region array<struct<code: array<int>, ncc: array<string>, nom: array<string>>>"
    entries = spark.read.schema(entry).json(path, multiLine=True).selectExpr("inline(region)")
    return entries.selectExpr("inline(arrays_zip(code, ncc, nom))")


def configured_regions(spark: SparkSession) -> DataFrame:
    """The built-in region rows."""
    return spark.createDataFrame(list(REGIONS), _FIELDS)


def label_region(df: DataFrame, regions: DataFrame, code: str) -> DataFrame:
    """Add a region's name (``ncc``) and short name (``nom``) by its code; the look-up is one row per region."""
    names = broadcast_when_small(regions.selectExpr("code AS __code", "ncc", "nom"), [regions])
    return df.join(names, F.expr(f"{code} = __code"), "left").drop("__code")
