"""Planning, progress and scoring over documents (inputs) and labels (finished results)."""

from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions.costs import Quadratic
from tallyloom.functions.sizes import in_window
from tallyloom.functions.text import thousands
from tallyloom.operators import batching, dimensions, existence, progress, scoring
from tallyloom.operators.fit import fitted_cost, quadratic_fit
from tallyloom.operators.ordered import by_size
from tallyloom.plans import campaign
from tallyloom.plans.registry import query, table

HOURS = fixed.BATCH_HOURS
SPLITS = 20

SIZED_SQL = "SELECT doc_id AS id, n_chars AS tokens FROM documents"
WEIGHT_SQL = (
    "((1.44451398e-04 * tokens + -1.18261348e-01) * tokens + 5.38503478e+01) / 3600.0"
)
PLAN_SQL = f"""
pend AS (
  SELECT doc_id AS id, n_chars AS tokens FROM documents d
  WHERE n_chars > 16 AND n_chars <= 6000
    AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)),
weighed AS (SELECT id, tokens, {WEIGHT_SQL} AS weight FROM pend),
summed AS (
  SELECT *, sum(weight) OVER (ORDER BY tokens, id ROWS UNBOUNDED PRECEDING) AS weight_cumsum
  FROM weighed),
plan AS (
  SELECT *, CAST(floor(floor(weight_cumsum) / 3) AS BIGINT) AS batch_id FROM summed)
"""


def sized(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("n_chars").alias("tokens")
    )


def done(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))


def raw_plan(spark, sf_dir):
    return campaign.plan_batches(sized(spark, sf_dir), done(spark, sf_dir), HOURS)


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("batch_plan", f"""WITH {PLAN_SQL}
SELECT id, 'inputs/' || id || '.json' AS json, tokens,
  'predictions/' || id || '/' || id || '_model.cif.gz' AS pred,
  true AS tokens_check, false AS pred_isfile,
  round(weight, 6) AS weight, round(weight_cumsum, 6) AS weight_cumsum, batch_id
FROM plan""")
def batch_plan(spark, sf_dir):
    return rounded(raw_plan(spark, sf_dir), "weight", "weight_cumsum")


@query("batch_summary", f"""WITH {PLAN_SQL}
SELECT batch_id, count(*) AS no_of_sequences, round(sum(weight), 6) AS predicted_runtime,
  'predictions_batch' || batch_id || '_' || count(*) AS label
FROM plan GROUP BY batch_id""")
def batch_summary(spark, sf_dir):
    return rounded(batching.batch_summary(raw_plan(spark, sf_dir)), "predicted_runtime")


@query("batch_members", f"""WITH {PLAN_SQL}
SELECT batch_id, count(*) AS no_of_sequences,
  string_agg(CAST(id AS VARCHAR), ' ' ORDER BY tokens, id) AS members
FROM plan GROUP BY batch_id""")
def batch_members(spark, sf_dir):
    members = batching.batch_members(raw_plan(spark, sf_dir))
    return members.withColumn("members", F.array_join("members", " "))


@query("plan_head", f"""WITH {PLAN_SQL}
SELECT id, tokens, round(weight_cumsum, 6) AS weight_cumsum, batch_id
FROM plan ORDER BY tokens, id LIMIT 10""")
def plan_head(spark, sf_dir):
    head = batching.plan_head(raw_plan(spark, sf_dir), 10, "tokens", "id")
    return rounded(head, "weight_cumsum").select("id", "tokens", "weight_cumsum", "batch_id")


@query("plan_tail", f"""WITH {PLAN_SQL}
SELECT id, tokens, round(weight_cumsum, 6) AS weight_cumsum, batch_id
FROM plan ORDER BY tokens DESC, id DESC LIMIT 10""")
def plan_tail(spark, sf_dir):
    tail = batching.plan_tail(raw_plan(spark, sf_dir), 10, "tokens", "id")
    return rounded(tail, "weight_cumsum").select("id", "tokens", "weight_cumsum", "batch_id")


@query("pending", f"""SELECT id, tokens FROM ({SIZED_SQL})
WHERE tokens > 16 AND tokens <= 6000 AND id NOT IN (SELECT doc_id FROM labels)""")
def pending(spark, sf_dir):
    inputs = sized(spark, sf_dir).where(in_window(F.col("tokens"), fixed.BATCH_WINDOW))
    return existence.pending(inputs, done(spark, sf_dir))


@query("finished", f"""SELECT id, tokens FROM ({SIZED_SQL})
WHERE tokens > 16 AND tokens <= 6000 AND id IN (SELECT doc_id FROM labels)""")
def finished(spark, sf_dir):
    inputs = sized(spark, sf_dir).where(in_window(F.col("tokens"), fixed.BATCH_WINDOW))
    return existence.finished(inputs, done(spark, sf_dir))


@query("exists_flag", f"""SELECT id, tokens, tokens > 16 AND tokens <= 6000 AS tokens_check,
  id IN (SELECT doc_id FROM labels) AS pred_isfile FROM ({SIZED_SQL})""")
def exists_flag(spark, sf_dir):
    flags = campaign.flagged(sized(spark, sf_dir), done(spark, sf_dir))
    return flags.select("id", "tokens", "tokens_check", "pred_isfile")


@query("progress_counts", f"""WITH f AS (
  SELECT tokens > 16 AND tokens <= 6000 AS c, id IN (SELECT doc_id FROM labels) AS d
  FROM ({SIZED_SQL})),
n AS (
  SELECT 'checked' AS step, count(*) FILTER (c) AS n, count(*) AS total FROM f
  UNION ALL SELECT 'finished', count(*) FILTER (c AND d), count(*) FROM f
  UNION ALL SELECT 'pending', count(*) FILTER (c AND NOT d), count(*) FROM f)
SELECT step, n, total, round(n / total, 6) AS share,
  format('{{:,}}', n) || ' of ' || format('{{:,}}', total)
    || printf(' (%.2f%%)', 100 * n / total) AS text
FROM n""")
def progress_counts(spark, sf_dir):
    flags = campaign.flagged(sized(spark, sf_dir), done(spark, sf_dir))
    return rounded(campaign.progress(flags), "share")


@query("row_counts", """SELECT name, n, format('{:,}', n) AS text FROM (
  SELECT 'documents' AS name, count(*) AS n FROM documents
  UNION ALL SELECT 'labels', count(*) FROM labels
  UNION ALL SELECT 'lineitem', count(*) FROM lineitem)""")
def row_counts(spark, sf_dir):
    counts = [
        table(spark, sf_dir, name).agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        for name in ("documents", "labels", "lineitem")
    ]
    rows = counts[0].unionAll(counts[1]).unionAll(counts[2])
    return rows.select("name", "n", thousands(F.col("n")).alias("text"))


@query("refitted_plan", """WITH p AS (
  SELECT CAST(n_chars AS DOUBLE) AS a, CAST(n_chars AS DOUBLE) * n_chars AS b,
    CAST(strlen(text) AS DOUBLE) AS y FROM documents),
m AS (
  SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb,
    covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS b_y FROM p),
c AS (
  SELECT *, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS c2,
    (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS c1 FROM m),
cost AS (SELECT c2, c1, my - c2 * mb - c1 * ma AS c0 FROM c),
pend AS (
  SELECT doc_id AS id, n_chars AS tokens FROM documents d
  WHERE n_chars > 16 AND n_chars <= 6000
    AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)),
weighed AS (
  SELECT id, tokens, ((c2 * tokens + c1) * tokens + c0) / 3600 AS weight FROM pend, cost),
summed AS (
  SELECT *, sum(weight) OVER (ORDER BY tokens, id ROWS UNBOUNDED PRECEDING) AS s FROM weighed)
SELECT CAST(floor(floor(s) / 3) AS BIGINT) AS batch_id, count(*) AS no_of_sequences,
  round(sum(weight), 3) AS predicted_runtime
FROM summed GROUP BY ALL""")
def refitted_plan(spark, sf_dir):
    """Batches under a cost refitted from observations: bytes stand in for seconds."""
    observed = table(spark, sf_dir, "documents").select(
        "n_chars", F.octet_length("text").alias("seconds")
    )
    cost = fitted_cost(quadratic_fit(observed, "n_chars", "seconds"))
    plan = campaign.plan_batches(sized(spark, sf_dir), done(spark, sf_dir), HOURS, cost)
    summary = batching.batch_summary(plan).drop("label")
    return summary.withColumn("predicted_runtime", F.round("predicted_runtime", 3))


STAGES = ["inputs", "outputs", "predictions"]


def artifacts(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    good = labels.where("quality = 1")
    frames = [table(spark, sf_dir, "documents"), labels, good]
    named = [
        f.select(F.lit(s).alias("kind"), F.col("doc_id").alias("id"))
        for s, f in zip(STAGES, frames, strict=True)
    ]
    return named[0].unionAll(named[1]).unionAll(named[2])


FLAGS_SQL = """flags AS (
  SELECT id, bool_or(k = 1) AS inputs, bool_or(k = 2) AS outputs, bool_or(k = 3) AS predictions
  FROM (SELECT doc_id AS id, 1 AS k FROM documents
        UNION ALL SELECT doc_id, 2 FROM labels
        UNION ALL SELECT doc_id, 3 FROM labels WHERE quality = 1)
  GROUP BY id)"""


@query("stage_funnel", f"""WITH {FLAGS_SQL}
SELECT 0 AS position, 'inputs' AS stage, count(*) FILTER (inputs) AS n,
  CAST(0 AS BIGINT) AS missing FROM flags
UNION ALL SELECT 1, 'outputs', count(*) FILTER (outputs),
  count(*) FILTER (inputs AND NOT outputs) FROM flags
UNION ALL SELECT 2, 'predictions', count(*) FILTER (predictions),
  count(*) FILTER (outputs AND NOT predictions) FROM flags""")
def stage_funnel(spark, sf_dir):
    return progress.funnel(progress.stage_flags(artifacts(spark, sf_dir), STAGES), STAGES)


@query("stage_missing", f"""WITH {FLAGS_SQL}
SELECT id, CASE WHEN NOT inputs THEN 'inputs' WHEN NOT outputs THEN 'outputs'
  ELSE 'predictions' END AS missing_stage
FROM flags WHERE NOT (inputs AND outputs AND predictions)""")
def stage_missing(spark, sf_dir):
    flags = progress.stage_flags(artifacts(spark, sf_dir), STAGES)
    return progress.missing_between(flags, STAGES)


@query("failure_accounting", """WITH o AS (
  SELECT n_chars AS tokens, CASE
    WHEN quality = 1 THEN 'done' WHEN n_chars <= 16 THEN 'too_small'
    WHEN n_chars > 6000 THEN 'too_large' WHEN quality = 0 THEN 'failed'
    ELSE 'pending' END AS outcome
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT outcome, count(*) AS n, min(tokens) AS least, max(tokens) AS most FROM o GROUP BY outcome""")
def failure_accounting(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = documents.select("doc_id", F.col("n_chars").alias("tokens")).join(
        labels.select("doc_id", "quality"), "doc_id", "left"
    )
    quality = F.coalesce("quality", F.lit(-1))
    why = progress.outcome(F.col("tokens"), quality == 1, quality == 0)
    return joined.groupBy(why.alias("outcome")).agg(
        F.count("*").alias("n"), F.min("tokens").alias("least"), F.max("tokens").alias("most")
    )


@query("id_union", "SELECT doc_id AS id FROM documents UNION SELECT doc_id FROM labels")
def id_union(spark, sf_dir):
    return existence.union_ids(sized(spark, sf_dir), done(spark, sf_dir))


@query("size_order_index", f"""SELECT id, tokens,
  row_number() OVER (ORDER BY tokens, id) - 1 AS pos FROM ({SIZED_SQL})""")
def size_order_index(spark, sf_dir):
    return by_size(sized(spark, sf_dir), "tokens", "id").select("id", "tokens", "pos")


@query("equal_effort_splits", f"""WITH w AS (
  SELECT id, tokens, CAST(tokens AS DOUBLE) * tokens AS sq FROM ({SIZED_SQL})),
t AS (SELECT sum(sq) AS total, min(sq) / sum(sq) AS low FROM w),
c AS (
  SELECT id, tokens, low,
    sum(sq) OVER (ORDER BY tokens, id ROWS UNBOUNDED PRECEDING) / total AS share
  FROM w, t),
b AS (
  SELECT id, tokens, share,
    CAST(least(greatest(ceil((share - low) / ((1.0 - low) / {SPLITS})) - 1, 0), {SPLITS - 1})
      AS BIGINT) AS bin
  FROM c),
r AS (
  SELECT bin, floor(coalesce(sum(n) OVER (
    ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2) AS batch_id
  FROM (SELECT bin, count(*) AS n FROM b GROUP BY bin))
SELECT id, tokens, round(share, 6) AS share, b.bin, CAST(batch_id AS BIGINT) AS batch_id
FROM b JOIN r ON b.bin = r.bin""")
def equal_effort_splits(spark, sf_dir):
    return rounded(batching.equal_effort(sized(spark, sf_dir), splits=SPLITS), "share")


@query("size_tier_a", f"""SELECT id, tokens,
  CASE WHEN tokens < 200 THEN '04:00' WHEN tokens < 2500 THEN '24:00'
    WHEN tokens < 3500 THEN '48:00' ELSE '120:00' END AS runtime,
  CASE WHEN tokens < 200 THEN '10240' WHEN tokens < 1500 THEN '20240'
    WHEN tokens < 2500 THEN '40000' ELSE '80000' END AS gpu_mem,
  CASE WHEN tokens < 1500 THEN 120000 WHEN tokens < 3500 THEN 240000
    ELSE 320000 END AS scratch_mb,
  CASE WHEN tokens < 200 THEN 1 WHEN tokens < 1500 THEN 2 WHEN tokens < 3500 THEN 4
    ELSE 8 END AS mem_fraction
FROM ({SIZED_SQL})""")
def size_tier_a(spark, sf_dir):
    tier = dimensions.tier_of(F.col("tokens"), fixed.TIERS_A)
    return sized(spark, sf_dir).withColumn("tier", tier).select(
        "id", "tokens", "tier.runtime", "tier.gpu_mem", "tier.scratch_mb", "tier.mem_fraction"
    )


@query("size_tier_b", """WITH d AS (
  SELECT doc_id AS id, n_chars AS tokens,
    CASE WHEN lang = 'en' THEN 'monomer' ELSE 'multimer' END AS kind FROM documents)
SELECT id, tokens, kind,
  CASE WHEN kind = 'monomer' THEN
      CASE WHEN tokens <= 500 THEN '04:00:00' WHEN tokens <= 2500 THEN '24:00:00'
        ELSE '48:00:00' END
    WHEN tokens > 2500 THEN '120:00:00' WHEN tokens >= 1000 THEN '48:00:00' END AS runtime,
  CASE WHEN kind = 'monomer' THEN
      CASE WHEN tokens <= 500 THEN '11g' WHEN tokens <= 2500 THEN '24g' ELSE '40g' END
    WHEN tokens > 2500 THEN '80g' WHEN tokens >= 1000 THEN '24g' END AS gpu_mem
FROM d""")
def size_tier_b(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("n_chars").alias("tokens"),
        F.when(F.col("lang") == "en", "monomer").otherwise("multimer").alias("kind"),
    )
    tier = dimensions.tier_of(F.col("tokens"), fixed.TIERS_B, F.col("kind"))
    return documents.withColumn("tier", tier).select(
        "id", "tokens", "kind", "tier.runtime", "tier.gpu_mem"
    )


LADDER_SQL = ", ".join(
    "({})".format(
        ", ".join(
            "NULL" if v is None else repr(v)
            for v in (step, n + 1, r["runtime"][n], r["mem_mb"][n], r["disk_mb"][n],
                      r["gpu_mem"][n])
        )
    )
    for step, r in fixed.LADDERS.items()
    for n in range(len(r["runtime"]))
)


@query("attempt_ladder", f"""WITH ladder(step, attempt, runtime, mem_mb, disk_mb, gpu_mem) AS (
  VALUES {LADDER_SQL}),
l AS (
  SELECT l_orderkey, l_linenumber AS attempt, CASE l_returnflag WHEN 'A' THEN 'pipeline'
    WHEN 'R' THEN 'prediction' ELSE 'multimer' END AS step FROM lineitem)
SELECT l.l_orderkey, l.step, l.attempt, runtime, mem_mb, disk_mb, gpu_mem,
  runtime IS NULL AS exhausted
FROM l LEFT JOIN ladder ON l.step = ladder.step AND l.attempt = ladder.attempt""")
def attempt_ladder(spark, sf_dir):
    step = (
        F.when(F.col("l_returnflag") == "A", "pipeline")
        .when(F.col("l_returnflag") == "R", "prediction")
        .otherwise("multimer")
    )
    runs = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", step.alias("step"), F.col("l_linenumber").alias("attempt")
    )
    return dimensions.with_ladder(runs)


def _load_cost_scorer():
    """A scorer that predicts seconds from sizes, standing in for a model."""
    model = Quadratic()

    def score(batch):
        n = batch["tokens"].astype("float64")
        seconds = ((model.c2 * n + model.c1) * n + model.c0).round(6)
        return batch.assign(score=seconds, batch_rows=len(batch))[
            ["id", "batch_id", "batch_rows", "score"]
        ]

    return score


@query("batched_scoring", f"""WITH {PLAN_SQL}
SELECT id, batch_id, count(*) OVER (PARTITION BY batch_id) AS batch_rows,
  round(weight * 3600, 6) AS score FROM plan""")
def batched_scoring(spark, sf_dir):
    plan = raw_plan(spark, sf_dir).select("id", "tokens", "batch_id")
    schema = "id bigint, batch_id bigint, batch_rows bigint, score double"
    return scoring.score_batches(plan, _load_cost_scorer, schema)


@query("one_job_scoring", f"""WITH {PLAN_SQL}
SELECT id, round(weight * 3600, 6) AS score FROM plan""")
def one_job_scoring(spark, sf_dir):
    todo = pending(spark, sf_dir).withColumn("batch_id", F.lit(0))
    schema = "id bigint, batch_id bigint, batch_rows bigint, score double"
    return scoring.score_all(todo, _load_cost_scorer, schema).select("id", "score")


def _load_reciprocal():
    """A step that fails on records shorter than 100."""

    def step(row):
        if row["tokens"] < 100:
            raise ValueError("too short")
        return row["tokens"] / 8

    return step


@query("per_row_step", f"""SELECT id, tokens,
  CASE WHEN tokens >= 100 THEN tokens / 8 END AS result,
  CASE WHEN tokens < 100 THEN 'ValueError: too short' END AS error
FROM ({SIZED_SQL}) WHERE tokens > 16 AND tokens <= 6000
  AND id NOT IN (SELECT doc_id FROM labels)""")
def per_row_step(spark, sf_dir):
    return scoring.run_each(pending(spark, sf_dir), _load_reciprocal)
