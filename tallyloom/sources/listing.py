"""Files whose path encodes their key."""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.names import path_regex

#: Tasks that list names, for each core; by default Spark takes one a folder, up to 10,000, and
#: each costs more than many folders.
_LISTING_TASKS = 4
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

_SCHEME = r"^[a-zA-Z][\w+.-]*:(//[^/]*)?(?=/)"


def decoded_path() -> Column:
    """The scanned file's path as text."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def exists_or_empty(load, empty_schema: str, spark: SparkSession) -> DataFrame:
    """``load()``, or no rows where nothing matches the path: absent files are an empty table."""
    tasks = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(tasks), _LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], empty_schema)
    finally:
        spark.conf.set(_LISTING, tasks)


def path_id(pattern: str, path: str = "path") -> Column:
    """What stands for ``{id}`` in a path; empty where the pattern doesn't fit."""
    return F.regexp_extract(F.regexp_replace(path, _SCHEME, ""), path_regex(re.sub(_SCHEME, "", pattern)), 1)


def scan_ids(spark: SparkSession, pattern: str) -> DataFrame:
    """``(id, path)`` of every file that matches a pattern with ``{id}`` holes.

    Only names are listed, no content is read. A hole that occurs twice has to
    hold the same id both times.
    """
    listed = exists_or_empty(
        lambda: spark.read.format("binaryFile").load(pattern.replace("{id}", "*")).select("path"),
        "path string",
        spark,
    )
    bare = F.regexp_replace("path", _SCHEME, "")
    regex = path_regex(re.sub(_SCHEME, "", pattern))
    return listed.where(bare.rlike(regex)).select(path_id(pattern).alias("id"), "path")


def scan_artifacts(spark: SparkSession, patterns: dict[str, str]) -> DataFrame:
    """``(kind, id, path)`` over several patterns."""
    found = spark.createDataFrame([], schemas.ARTIFACTS)
    for kind, pattern in patterns.items():
        found = found.unionByName(scan_ids(spark, pattern).withColumn("kind", F.lit(kind)))
    return found
