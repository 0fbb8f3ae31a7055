from pyspark.sql import SparkSession


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("carelens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataValueLength", "2000")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
