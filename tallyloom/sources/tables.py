"""Delimited tables: plans, accounting, telemetry; and stored arrays."""

from pyspark.sql import DataFrame, SparkSession

from tallyloom import schemas

_SAMPLES = {
    "sep": ",",
    "header": True,
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
    "timestampFormat": "yyyy/MM/dd HH:mm:ss.SSS",
}


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """A written plan; ids stay strings whatever they look like."""
    return spark.read.schema(schemas.PLAN).csv(path, sep="\t", header=True)


def read_accounting(spark: SparkSession, path: str) -> DataFrame:
    """Bar-separated job accounting, all fields as strings."""
    return spark.read.csv(path, sep="|", header=True)


def read_gpu_samples(spark: SparkSession, path: str, **options) -> DataFrame:
    """Monitor output: fields separated by a comma and spaces."""
    return spark.read.schema(schemas.GPU_SAMPLES).options(**{**_SAMPLES, **options}).csv(path)


def stream_gpu_samples(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The same samples as an endless stream of files."""
    reader = spark.readStream.schema(schemas.GPU_SAMPLES).options(**{**_SAMPLES, **options})
    return reader.csv(folder)


def read_model_arrays(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MODEL_ARRAYS).parquet(path)
