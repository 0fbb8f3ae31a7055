"""Writing tables and reports."""

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.fixed_values import COMPLAINT_VARIANT_REGIONS, LABELS
from carelens.functions.dates import run_stamp
from carelens.functions.keys import ref
from carelens.plans.reports import COMPLAINTS, CONTROL, INCIDENTS, TARGETING, report_fields, sheet
from carelens.scratch import written
from carelens.sources.regions import label_region

SHEETS = {TARGETING: "ciblage", CONTROL: "controle"}


def land_table(df: DataFrame, path: str) -> None:
    """Persist a cleaned table, replacing what was there."""
    df.write.mode("overwrite").parquet(path)


def land_keyed(df: DataFrame, name: str, key: str, path: str, buckets: int) -> DataFrame:
    """Persist a cleaned table as ``name``, dealt into buckets of its key and sorted in each; returns what is stored.

    Tables landed with the same number of buckets join and group by that key where they lie: neither side is shuffled or
    sorted again, however many such joins follow.  Rows of one key share a bucket, so a table whose key is heavy
    (``heavy_keys``) is better landed by ``land_table``.
    """
    writer = df.repartition(buckets, F.col(ref(key))).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


FOLDERS = ("region_code", "nom")


def arrange_by_region(report: DataFrame, order: str = LABELS["finess"]) -> DataFrame:
    """Rows in (region, establishment) ranges, sorted: a large region is spread over many tasks and files.

    The folder columns lead, as the writer would otherwise sort again by them and lose the rest of the order.  The row
    hash lets a range end within an establishment that has very many rows.
    """
    rest = ", ".join(ref(c) for c in report.columns if c not in (order, *FOLDERS))
    keys = [*map(F.col, FOLDERS), F.col(ref(order)), F.expr(f"xxhash64({rest})")]
    return report.repartitionByRange(*keys).sortWithinPartitions(*keys)


@contextmanager
def _arranged(both: DataFrame, regions: DataFrame) -> Iterator[DataFrame]:
    """The rows of both reports by region, on the executors' disks while sheets are cut from them.

    They are written before they are arranged: ranges are found by looking at all rows first, which would otherwise join
    the whole report once for that and once more to sort it.
    """
    labelled = written(label_region(both, regions, "region_code").drop("ncc"), "report")
    stored = arrange_by_region(labelled).persist(StorageLevel.DISK_ONLY)
    try:
        yield stored
    finally:
        stored.unpersist()


def _write(rows: DataFrame, folder: str, fmt: str = "parquet") -> None:
    """Replaces the regions at hand; other regions of the folder stay."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*FOLDERS)
    if fmt == "csv":
        writer.csv(folder, header=True, sep=";")
    else:
        writer.parquet(folder)


def export_report(
    both: DataFrame,
    path: str,
    regions: DataFrame,
    day: dt.date,
    fmt: str = "parquet",
    complaint_regions: tuple[int, ...] = COMPLAINT_VARIANT_REGIONS,
) -> dict[str, str]:
    """Write both reports of every region, from rows built for both; returns the folder of each sheet.

    ``{path}/{ddmmyyyy}/{sheet}/region_code=…/nom=…`` holds one region, each file a sorted run of establishments.
    The rows are joined, shuffled and sorted once and kept on the executors' disks while the sheets are cut from them; what a lost
    executor held is computed again.  ``csv`` gives each region the columns of its own variant, in
    ``{sheet}_csv/{variant}``.  Regions exported before on the same day stay.
    """
    root = f"{path}/{run_stamp(day)}"
    special = f"coalesce(region_code IN ({', '.join(map(str, complaint_regions)) or 'NULL'}), false)"
    folders = {}
    with _arranged(both, regions) as stored:
        for kind, name in SHEETS.items():
            rows = sheet(stored, kind)
            if fmt == "parquet":
                folders[name] = f"{root}/{name}"
                _write(rows, folders[name])
                continue
            for variant, own in ((INCIDENTS, f"NOT {special}"), (COMPLAINTS, special)):
                layout = [LABELS[f] for f in report_fields(kind, variant)]
                if set(layout) <= set(rows.columns):  # else no region of this variant was reported
                    folders[f"{name}_{variant}"] = f"{root}/{name}_csv/{variant}"
                    _write(rows.where(own).select(*FOLDERS, *map(ref, layout)), folders[f"{name}_{variant}"], "csv")
    return folders


MANIFEST = "sheet string, region_code int, nom string, run string, published timestamp, n_rows bigint, checksum decimal(38,0)"


def publish_report(
    both: DataFrame, path: str, regions: DataFrame, day: dt.date, covered: DataFrame | None = None
) -> str:
    """Write both reports of every region into a folder of this run and publish it by a manifest; returns the run.

    ``{path}/{ddmmyyyy}/{sheet}/run=…/region_code=…/nom=…`` holds the rows.  They count from the moment the manifest has a
    line for each sheet and region (with rows and a checksum of them): a run that dies before leaves what was published
    earlier as it was, and is not seen.  ``covered`` (a column ``code``) names the regions of this run; one of them that has
    no rows any more is published empty.  Without it the run covers the regions that it has rows of.
    """
    root, run = f"{path}/{run_stamp(day)}", uuid.uuid4().hex
    lines = []
    with _arranged(both, regions) as stored:
        for kind, name in SHEETS.items():
            folder = f"{root}/{name}/run={run}"
            sheet(stored, kind).write.partitionBy(*FOLDERS).parquet(folder)
            lines.append(_region_lines(both.sparkSession.read.parquet(folder), name))
    found = lines[0].unionByName(lines[1])
    if covered is not None:
        asked = label_region(covered.selectExpr("code").distinct(), regions, "code").selectExpr("code AS region_code", "nom")
        asked = asked.withColumn("sheet", F.explode(F.array(*map(F.lit, SHEETS.values()))))
        own = found.withColumnRenamed("nom", "own")
        found = asked.join(own, ["sheet", "region_code"], "full").selectExpr(
            "sheet", "region_code", "coalesce(nom, own) AS nom", "coalesce(n_rows, 0) AS n_rows", "checksum"
        )
    whole = found.selectExpr("sheet", "region_code", "nom", f"'{run}' AS run", "current_timestamp() AS published", "n_rows", "checksum")
    # One file, so the manifest has all of the run's lines or none.
    whole.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return run


def _region_lines(rows: DataFrame, name: str) -> DataFrame:
    columns = ", ".join(ref(c) for c in sorted(rows.columns))
    figures = [F.expr("count(1)").alias("n_rows"), F.expr(f"sum(CAST(xxhash64({columns}) AS DECIMAL(38,0)))").alias("checksum")]
    return rows.groupBy(*FOLDERS).agg(*figures).selectExpr(f"'{name}' AS sheet", "CAST(region_code AS INT) AS region_code", "nom", "n_rows", "checksum")


def manifest(spark: SparkSession, path: str, day: dt.date) -> DataFrame:
    """The line that counts for each sheet and region of a day: the last one published."""
    lines = spark.read.schema(MANIFEST).parquet(f"{path}/{run_stamp(day)}/manifest")
    last = lines.groupBy("sheet", "region_code").agg(F.max_by(F.struct("nom", "run", "published", "n_rows", "checksum"), "published").alias("x"))
    return last.select("sheet", "region_code", "x.*")


def published(spark: SparkSession, path: str, day: dt.date, name: str) -> DataFrame:
    """The rows of a sheet as published: of every region those of its last run."""
    current = manifest(spark, path, day).where((F.col("sheet") == name) & (F.col("n_rows") > 0))
    folder = f"{path}/{run_stamp(day)}/{name}"
    lines = current.select(F.col("run").alias("__run"), F.col("region_code").alias("__region"))
    rows = spark.read.option("basePath", folder).option("mergeSchema", True).parquet(f"{folder}/run=*")
    return rows.join(lines, F.expr("run = __run AND region_code <=> __region"), "left_semi").drop("run")


def damaged(spark: SparkSession, path: str, day: dt.date) -> DataFrame:
    """(sheet, region_code, n_rows, found): published regions whose files no longer hold what the manifest says."""
    lines = manifest(spark, path, day).select("sheet", "region_code", "n_rows", "checksum")
    held = [_region_lines(published(spark, path, day, name), name) for name in SHEETS.values()]
    held = held[0].unionByName(held[1]).selectExpr("sheet", "region_code", "n_rows AS found", "checksum AS own")
    joined = lines.join(held, ["sheet", "region_code"], "left").selectExpr("*", "coalesce(found, 0) AS n_found")
    return joined.where("n_rows <> n_found OR NOT checksum <=> own").selectExpr("sheet", "region_code", "n_rows", "n_found AS found")
