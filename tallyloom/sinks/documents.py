"""Input and composed documents, one per line in a few part files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.operators.existence import pending
from tallyloom.sources.listing import decoded_path, exists_or_empty

_INDEX = "file string, id string"


def _ints(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def single_document(id_: Column, sequence: Column) -> Column:
    """JSON of a one-chain document."""
    chain = F.struct(F.lit(fixed.SINGLE_CHAIN).alias("id"), sequence.alias("sequence"))
    return F.to_json(
        F.struct(
            id_.alias("name"),
            F.array(F.struct(chain.alias("protein"))).alias("sequences"),
            _ints(fixed.SINGLE_SEEDS).alias("modelSeeds"),
            F.lit(fixed.DIALECT).alias("dialect"),
            F.lit(fixed.SINGLE_VERSION).alias("version"),
        )
    )


def stored_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids of the documents in a folder, from the index in its ``_ids`` folder.

    The index tells which files it covers. Files that it lacks, of other writers or of a write
    that was lost before its index, are read once and added; no other document is.
    """
    index = f"{path}/_ids"

    def covered() -> DataFrame:
        return exists_or_empty(lambda: spark.read.schema(_INDEX).parquet(index), _INDEX, spark)

    files = exists_or_empty(
        lambda: spark.read.format("binaryFile").load(path).select(decoded_path().alias("file")),
        "file string",
        spark,
    )
    # Names of files only, which the scan below lists on the driver in any case.
    new = [r["file"] for r in files.join(covered().select("file"), "file", "left_anti").collect()]
    if new:
        texts = spark.read.text(new)
        names = texts.select(decoded_path().alias("file"), F.get_json_object("value", "$.name").alias("id"))
        names.write.mode("append").parquet(index)
    return covered().select("id")


def write_inputs(
    records: DataFrame, path: str, compression: str | None = None, order: str | None = None
) -> None:
    """Append documents of ``(id, seq)`` whose id the folder does not hold yet.

    Of rows with one id the first by ``order`` is written, without an order that of the
    smallest sequence. One writer at a time.
    """
    fresh = pending(records, stored_ids(records.sparkSession, path))
    place = F.struct(*([order] if order else []), "seq")
    first = fresh.groupBy("id").agg(F.min(place).alias("_first")).select("id", "_first.seq")
    writer = first.select(single_document(F.col("id"), F.col("seq"))).write.mode("append")
    writer.text(path, compression=compression or "none")
    stored_ids(records.sparkSession, path)


def composed_document(name: Column, entries: Column, seeds: list[int]) -> Column:
    """JSON of a many-chain document from raw entry texts; absent fields are written as null."""
    head = F.to_json(
        F.struct(
            F.lit(fixed.DIALECT).alias("dialect"),
            F.lit(fixed.COMPOSED_VERSION).alias("version"),
            name.alias("name"),
        )
    )
    tail = F.to_json(
        F.struct(
            _ints(seeds).alias("modelSeeds"),
            F.lit(None).cast("string").alias("bondedAtomPairs"),
            F.lit(None).cast("string").alias("userCCD"),
        ),
        {"ignoreNullFields": "false"},
    )
    return F.concat(
        F.rtrim(head, F.lit("}")), F.lit(',"sequences":['), F.array_join(entries, ","),
        F.lit("],"), F.ltrim(tail, F.lit("{")),
    )


def entry_texts(sequences: Column) -> Column:
    """Parsed protein entries back as JSON texts."""

    def one(e: Column) -> Column:
        only = F.element_at(e["chain_ids"], 1)
        body = F.struct(only.alias("id"), e["sequence"].alias("sequence"))
        return F.to_json(F.struct(body.alias("protein")))

    return F.transform(sequences, one)


def write_composed(
    composed: DataFrame, path: str, seeds: list[int] = fixed.COMPOSED_SEEDS
) -> None:
    """Write the whole (``status = 'ok'``) composed records, gzipped."""
    entries = F.col("entries") if "entries" in composed.columns else entry_texts(F.col("sequences"))
    whole = composed.where("status = 'ok'")
    documents = whole.select(composed_document(F.col("name"), entries, seeds))
    documents.write.text(path, compression="gzip")


def write_routed(
    composed: DataFrame, path: str, seeds: list[int] = fixed.COMPOSED_SEEDS
) -> None:
    """Write all composed records in one pass: whole ones as documents under ``sink=documents``,
    the others as ``{id, status}`` under ``sink=quarantine``, both gzipped."""
    entries = F.col("entries") if "entries" in composed.columns else entry_texts(F.col("sequences"))
    ok = F.col("status") == "ok"
    value = F.when(ok, composed_document(F.col("name"), entries, seeds)).otherwise(
        F.to_json(F.struct("id", "status"))
    )
    routed = composed.select(value.alias("value"), F.when(ok, "documents").otherwise("quarantine").alias("sink"))
    routed.write.partitionBy("sink").text(path, compression="gzip")
