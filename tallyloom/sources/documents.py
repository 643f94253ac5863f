"""Nested JSON documents, plain or gzipped."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.sizes import chain_ids
from tallyloom.sources.listing import decoded_path, exists_or_empty, path_id

_KINDS = ["protein", "rna", "dna", "ligand"]
_HEAD = "name string, dialect string, version int, modelSeeds array<int>"
_CHAIN = "struct<id: variant, sequence: string>"
_DOCUMENT_NAME = r"([^/]+?)(?:_data)?\.json(?:\.gz)?$"


def _texts(spark: SparkSession, path: str, whole_files: bool) -> DataFrame:
    return exists_or_empty(
        lambda: spark.read.text(path, wholetext=whole_files).select(
            "value", decoded_path().alias("path")
        ),
        "value string, path string",
        spark,
    )


def entry_structs(json: Column) -> Column:
    """``sequences`` of a document text as ``array<struct<kind, chain_ids, sequence>>``."""
    fields = ", ".join(f"{k}: {_CHAIN}" for k in _KINDS)
    parsed = F.from_json(json, f"sequences array<struct<{fields}>>")["sequences"]

    def one(entry: Column) -> Column:
        kind = F.coalesce(*[F.when(entry[k].isNotNull(), F.lit(k)) for k in _KINDS])
        body = F.coalesce(*[entry[k] for k in _KINDS])
        return F.struct(
            kind.alias("kind"),
            chain_ids(body["id"]).alias("chain_ids"),
            body["sequence"].alias("sequence"),
        )

    return F.transform(parsed, one)


def scan_inputs(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Documents under a path or glob; gzip is told by the ``.gz`` suffix.

    With ``whole_files`` each file is one document and its id is the file name, or what
    stands for ``{id}`` where ``path`` has such a hole; otherwise each line is one and its id
    is the document's name. ``entries`` keeps each entry of ``sequences`` as JSON text.
    Columns not selected are not parsed.
    """
    texts = _texts(spark, path.replace("{id}", "*"), whole_files)
    head = F.from_json("value", _HEAD)
    by_path = path_id(path) if "{id}" in path else F.regexp_extract("path", _DOCUMENT_NAME, 1)
    id_ = by_path if whole_files else head["name"]
    return texts.select(
        id_.alias("id"),
        "path",
        head["name"].alias("name"),
        head["dialect"].alias("dialect"),
        head["version"].alias("version"),
        head["modelSeeds"].alias("model_seeds"),
        entry_structs(F.col("value")).alias("sequences"),
        F.from_json("value", "sequences array<string>")["sequences"].alias("entries"),
    )


def scan_scores(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """``(path, ranking_score, iptm, ptm)`` of confidence summaries; a field that is absent is NULL."""
    texts = _texts(spark, path, whole_files)
    return texts.select("path", F.from_json("value", schemas.SCORES).alias("s")).select(
        "path", "s.*"
    )
