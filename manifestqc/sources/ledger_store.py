"""Upload ledger storage: a table ``(folder, path, status, updated_at)``,
partitioned by folder, so resuming reads one folder's partition only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

CLEARED = "cleared"
LEDGER_SCHEMA = T.StructType([
    T.StructField("folder", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("updated_at", T.TimestampType(), True),
])


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def read_ledger(spark: SparkSession, location: str, folder: str) -> DataFrame:
    """Ledger rows of one folder.  Only a location that does not exist reads as
    empty; any other failure is raised, or all files would be sent again."""
    try:
        df = spark.read.schema(LEDGER_SCHEMA).parquet(location)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty_ledger(spark)
        raise
    return df.filter((F.col("folder") == F.lit(folder)) & (F.col("status") != F.lit(CLEARED)))


def write_ledger(ledger: DataFrame, location: str, slices: int = 64) -> None:
    """Replace the partitions of the folders present in ``ledger`` only
    (dynamic partition overwrite); other folders are untouched.  The paths of a
    folder are spread over up to ``slices`` tasks (and files), so one large
    submission is not one task."""
    (ledger.select(*[f.name for f in LEDGER_SCHEMA.fields])
        .repartition("folder", F.pmod(F.xxhash64("path"), F.lit(slices)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("folder")
        .parquet(location))


def clear_ledger(spark: SparkSession, location: str, folder: str) -> None:
    """Drop one folder's progress: its partition is replaced by a one-row
    tombstone version (an empty frame would overwrite no partition)."""
    marker = spark.createDataFrame([(folder, "", CLEARED, None)], LEDGER_SCHEMA)
    write_ledger(marker, location)
