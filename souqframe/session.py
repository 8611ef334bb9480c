"""Sessions for tests, the bench and local runs; on a cluster, bring your own."""

from pyspark.sql import SparkSession

# The rules' projections would grow into methods larger than the JVM compiles; and three outcomes can
# be written side by side without a sort. Orders are texts that repeat much, so the tables are packed well.
TUNING = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def tune(spark: SparkSession) -> SparkSession:
    """Gives a session the settings the rules run faster with."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", name: str = "souqframe", **settings: str) -> SparkSession:
    """A local session in UTC and with adaptive execution, as the engine expects, and tuned."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
