"""Plans, manifests, reports and sequence files."""

import gzip
import os
import re
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators.batching import in_size_order
from tallyloom.operators.compose import ordered
from tallyloom.session import mounted, small_table, spread

#: What Spark writes as %XX in the names of folders, and its name for no value.
_ESCAPED = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_plan(plan: DataFrame, path: str, refresh: bool = False) -> None:
    """Write the plan once; an existing one is kept unless ``refresh``."""
    table = in_size_order(plan.select(*schemas.PLAN_COLUMNS))
    mode = "overwrite" if refresh else "ignore"
    table.write.mode(mode).csv(path, sep="\t", header=True)


def write_manifests(
    plan: DataFrame, path: str, paths: list[Column], by: str = "batch_id"
) -> None:
    """One path per line, in a folder per ``by`` value; all rows are listed.

    For as many batches as a file system holds folders; a larger campaign reads
    its batches from the written plan, which is laid out by batch.
    """
    lines = plan.select(by, F.explode(F.array(*paths)).alias("value"))
    spread(lines, by).write.partitionBy(by).text(path)


def write_file_each(rows: DataFrame, by: str, path: str) -> None:
    """The lines ``value`` of each value of ``by`` as a gzipped file, in a folder ``by=...`` below
    ``path``, a fresh folder.

    Below a mounted folder tasks make the files themselves: Hadoop starts a process for the
    permissions of each file and each folder there, which takes far longer than the file.
    """
    dealt = spread(rows.select(F.col(by).cast("string").alias(by), "value"), by)
    folder = mounted(rows.sparkSession, path)
    if folder is None:
        dealt.write.partitionBy(by).text(path, compression="gzip")
        return

    def run(batches):
        task, files = TaskContext.get(), 0
        lines = (x for b in batches for x in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for name, group in groupby(lines, lambda x: x[0] or None):
            own = _NO_VALUE if name is None else _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", name)
            place = f"{folder}/{by}={own}"
            os.makedirs(place, exist_ok=True)
            # A task that runs again replaces its files; none is seen half written.
            made = f"{place}/.{task.taskAttemptId()}"
            with open(made, "wb") as file, gzip.GzipFile("", "wb", 6, file) as out:
                for _, line in group:
                    out.write(f"{line or ''}\n".encode())
            os.replace(made, f"{place}/part-{task.partitionId():05}.txt.gz")
            files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    dealt.sortWithinPartitions(by).mapInArrow(run, "files long").write.format("noop").mode("overwrite").save()


def write_markdown(report: DataFrame, path: str) -> None:
    """A pipe table, in as many part files as the report has ranges of rows; read in the order
    of their names they are one table."""
    names = report.columns
    numeric = {n for n, t in report.dtypes if t in ("double", "float", "int", "bigint")}
    rule = ["---:" if n in numeric else ":---" for n in names]
    head = ["| " + " | ".join(names) + " |", "| " + " | ".join(rule) + " |"]
    cells = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    body = report.select(F.monotonically_increasing_id().alias("n"), row.alias("value"))
    top = [{"n": i - len(head), "value": line} for i, line in enumerate(head)]
    table = body.unionAll(small_table(report.sparkSession, top, "n bigint, value string"))
    table.orderBy("n").select("value").write.text(path)


def fasta_record(id_: Column, sequence: Column) -> Column:
    return F.concat(F.lit(">"), id_, F.lit("\n"), sequence)


def write_fasta(records: DataFrame, path: str) -> None:
    """Records of ``(id, seq)``."""
    records.select(fasta_record(F.col("id"), F.col("seq"))).write.text(path)


def write_complex_fasta(members: DataFrame, path: str) -> None:
    """Member records of ``(complex, pos, id, seq)`` joined in position order, one text per complex.

    Complexes have a bounded number of members.
    """
    record = fasta_record(F.col("id"), F.col("seq"))
    joined = members.groupBy("complex").agg(
        F.array_join(ordered(F.col("pos"), record), "\n").alias("value")
    )
    spread(joined.select("complex", "value"), "complex").write.partitionBy("complex").text(path)


def write_accounting(table: DataFrame, path: str) -> None:
    """All fields unchanged, tab-separated."""
    table.write.csv(path, sep="\t", header=True)
