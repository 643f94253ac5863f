"""The planning query: from inputs and finished results to cost-bounded batches."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions.costs import CostModel, Quadratic
from tallyloom.functions.names import filled
from tallyloom.functions.sizes import in_window, token_count
from tallyloom.operators.batching import assign_batches
from tallyloom.operators.existence import pending, required, with_exists
from tallyloom.operators.progress import shares
from tallyloom.session import written
from tallyloom.sources.documents import scan_inputs
from tallyloom.sources.listing import scan_ids

INPUT_PATH = "inputs/{id}.json"
OUTPUT_PATH = "outputs/{id}_data.json.gz"
PREDICTION_PATH = "predictions/{id}/{id}_model.cif.gz"

CHECKED = "tokens_check"
FINISHED = "tokens_check & pred_isfile"
PENDING = "tokens_check & ~pred_isfile"


def flagged(
    sized: DataFrame, done: DataFrame, window: tuple[int, int] = fixed.BATCH_WINDOW
) -> DataFrame:
    """``(id, tokens)`` with the size check and the existence flag."""
    checked = sized.select(
        "id",
        F.col("tokens").cast("bigint").alias("tokens"),
        in_window(F.col("tokens"), window).alias("tokens_check"),
    )
    return with_exists(checked, done)


def plan_batches(
    sized: DataFrame,
    done: DataFrame,
    hours: float = fixed.BATCH_HOURS,
    cost: CostModel = Quadratic(),
    window: tuple[int, int] = fixed.BATCH_WINDOW,
    json: str = INPUT_PATH,
    pred: str = PREDICTION_PATH,
    **limits: int,
) -> DataFrame:
    """The nine-column plan of all pending, right-sized ids.

    Only ``(id, tokens)`` is shuffled; paths and flags are added to the result.
    """
    fitting = sized.select("id", F.col("tokens").cast("bigint").alias("tokens")).where(
        in_window(F.col("tokens"), window)
    )
    batched = assign_batches(pending(fitting, done), cost, hours, **limits)
    return batched.select(
        "id",
        filled(json, F.col("id")).alias("json"),
        "tokens",
        filled(pred, F.col("id")).alias("pred"),
        F.lit(True).alias("tokens_check"),
        F.lit(False).alias("pred_isfile"),
        "weight",
        "weight_cumsum",
        "batch_id",
    )


def progress(flags: DataFrame) -> DataFrame:
    """Right-sized, finished and pending counts with their share of all ids."""
    return shares(flags, {"checked": CHECKED, "finished": FINISHED, "pending": PENDING})


@dataclass(frozen=True)
class Campaign:
    plan: DataFrame
    progress: DataFrame
    unmatched: DataFrame


def plan_folder(
    spark: SparkSession,
    root: str,
    hours: float = fixed.BATCH_HOURS,
    cost: CostModel = Quadratic(),
    window: tuple[int, int] = fixed.BATCH_WINDOW,
    inputs: str = INPUT_PATH,
    outputs: str = OUTPUT_PATH,
    predictions: str = PREDICTION_PATH,
) -> Campaign:
    """Plan a campaign folder of inputs, outputs and predictions, one file each, by path patterns.

    Ids come from the outputs, sizes from the inputs; an output without an
    input is reported in ``unmatched`` and left out of the plan. Documents are
    parsed once: the sizes are written to the shared folder.
    """
    listed = scan_ids(spark, f"{root}/{outputs}").select("id")
    documents = scan_inputs(spark, f"{root}/{inputs}")
    sizes = documents.select("id", token_count(F.col("sequences")).alias("tokens"))
    sized = written(required(listed, sizes), "sizes")
    done = scan_ids(spark, f"{root}/{predictions}").select("id")
    found = sized.where("found")
    plan = plan_batches(found, done, hours, cost, window, f"{root}/{inputs}", f"{root}/{predictions}")
    return Campaign(
        plan, progress(flagged(found, done, window)), sized.where("not found").select("id")
    )
