"""Readers and writers compared by content: whole files, lines, arrays, reports, quarantine."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions import costs, sizes
from tallyloom.operators import batching, compose, progress
from tallyloom.plans import campaign
from tallyloom.plans.log_queries import EVENT_LINES_SQL, event_lines
from tallyloom.plans.planning_queries import HOURS, PLAN_SQL, WEIGHT_SQL, done, sized
from tallyloom.plans.record_queries import prefixed
from tallyloom.plans.registry import query, table
from tallyloom.session import fresh_folder, spread
from tallyloom.sinks import documents as document_sinks
from tallyloom.sinks import tables as table_sinks
from tallyloom.sources import documents, listing, sequences, tables
from tallyloom.sources.listing import path_id
from tallyloom.sources.logs import scan_logs

#: One file for each id, in a folder that names it.
ONE_FILE = "id={id}/part-*"


def _supplier_id():
    return F.concat(F.lit("s."), F.col("s_suppkey").cast("string"))


def _one_file_each(rows, folder):
    """``(id, value)`` as one gzipped file for each id."""
    table_sinks.write_file_each(rows, "id", folder)


def _supplier_document():
    """A supplier's name, said again as often as its nation's number; every third is two chains."""
    sequence = F.expr("repeat(s_name, 1 + 15 * s_nationkey)")
    one = F.to_json(F.struct(F.struct(F.lit("A").alias("id"), sequence.alias("sequence")).alias("protein")))
    two = F.to_json(
        F.struct(F.struct(F.array(F.lit("A"), F.lit("B")).alias("id"), sequence.alias("sequence")).alias("protein"))
    )
    return document_sinks.composed_document(
        F.col("s_name"), F.array(F.when(F.col("s_suppkey") % 3 == 0, two).otherwise(one)), [1]
    )


FOLDER_SQL = f"""inputs AS (
  SELECT 's.' || s_suppkey AS id, s_suppkey AS k,
    length(s_name) * (1 + 15 * s_nationkey) * CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS tokens
  FROM supplier WHERE s_suppkey % 11 <> 0),
fit AS (
  SELECT id, tokens, {WEIGHT_SQL} AS weight FROM inputs
  WHERE k % 7 <> 0 AND k % 5 <> 0 AND tokens > 16 AND tokens <= 6000),
summed AS (
  SELECT *, sum(weight) OVER (ORDER BY tokens, id ROWS UNBOUNDED PRECEDING) AS weight_cumsum FROM fit)"""


def _planned(spark, sf_dir):
    """A campaign folder of one input, output and prediction a supplier, planned from its files."""
    suppliers = table(spark, sf_dir, "supplier")
    root = fresh_folder(spark, "campaign")
    rows = suppliers.select(_supplier_id().alias("id"), _supplier_document().alias("value"), "s_suppkey")
    _one_file_each(rows.where("s_suppkey % 11 <> 0").drop("s_suppkey"), f"{root}/inputs")
    listed = rows.select("id", F.lit("x").alias("value"), "s_suppkey").where("s_suppkey % 7 <> 0")
    _one_file_each(listed.drop("s_suppkey"), f"{root}/outputs")
    _one_file_each(listed.where("s_suppkey % 5 = 0").drop("s_suppkey"), f"{root}/predictions")
    folders = {f: f"{f}/{ONE_FILE}" for f in ("inputs", "outputs", "predictions")}
    return root, campaign.plan_folder(spark, root, HOURS, **folders)


@query("plan_from_files", f"""WITH {FOLDER_SQL}
SELECT id, 'inputs/id=' || id || '/part-*' AS json, CAST(tokens AS BIGINT) AS tokens,
  'predictions/id=' || id || '/part-*' AS pred, round(weight, 6) AS weight,
  round(weight_cumsum, 6) AS weight_cumsum,
  CAST(floor(floor(weight_cumsum) / 3) AS BIGINT) AS batch_id FROM summed""")
def plan_from_files(spark, sf_dir):
    """The batch plan of a folder that holds one gzipped document a file, chain ids as lists too."""
    root, planned = _planned(spark, sf_dir)
    inside = {c: F.replace(F.col(c), F.lit(f"{root}/")) for c in ("json", "pred")}
    cut = planned.plan.withColumns({**inside, **{c: F.round(c, 6) for c in ("weight", "weight_cumsum")}})
    return cut.select("id", "json", "tokens", "pred", "weight", "weight_cumsum", "batch_id")


@query("unmatched_files", """SELECT 's.' || s_suppkey AS id FROM supplier
WHERE s_suppkey % 7 <> 0 AND s_suppkey % 11 = 0""")
def unmatched_files(spark, sf_dir):
    """Outputs without an input."""
    return _planned(spark, sf_dir)[1].unmatched


@query("whole_files", """SELECT 's.' || s_suppkey AS id, s_name AS name,
  CAST(length(s_name) * (1 + 15 * s_nationkey) * CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS tokens,
  CASE WHEN s_suppkey % 3 = 0 THEN 'A,B' ELSE 'A' END AS chains FROM supplier""")
def whole_files(spark, sf_dir):
    """Documents of one gzipped file each; a chain id is one text or a list."""
    folder = fresh_folder(spark, "inputs")
    rows = table(spark, sf_dir, "supplier").select(_supplier_id().alias("id"), _supplier_document().alias("value"))
    _one_file_each(rows, folder)
    read = documents.scan_inputs(spark, f"{folder}/{ONE_FILE}")
    return read.select(
        "id", "name", sizes.token_count(F.col("sequences")).alias("tokens"),
        F.array_join(F.col("sequences")[0]["chain_ids"], ",").alias("chains"),
    )


@query("artifact_kinds", """SELECT 'scores' AS kind, 's.' || s_suppkey AS id FROM supplier
UNION ALL SELECT 'models', 's.' || s_suppkey FROM supplier WHERE s_acctbal > 0""")
def artifact_kinds(spark, sf_dir):
    """Files of two kinds, told by their paths."""
    folder = fresh_folder(spark, "artifacts")
    rows = table(spark, sf_dir, "supplier").select(_supplier_id().alias("id"), F.lit("x").alias("value"), "s_acctbal")
    _one_file_each(rows.drop("s_acctbal"), f"{folder}/scores")
    _one_file_each(rows.where("s_acctbal > 0").drop("s_acctbal"), f"{folder}/models")
    found = listing.scan_artifacts(spark, {k: f"{folder}/{k}/{ONE_FILE}" for k in ("scores", "models")})
    return found.select("kind", "id")


@query("score_files", """SELECT 's.' || s_suppkey AS id, s_acctbal / 100 AS ranking_score,
  CASE WHEN s_suppkey % 4 <> 0 THEN s_acctbal / 200 END AS iptm, CAST(s_nationkey AS DOUBLE) / 25 AS ptm,
  round(CASE WHEN s_suppkey % 4 <> 0 THEN 0.8 * (s_acctbal / 200) + 0.2 * (CAST(s_nationkey AS DOUBLE) / 25) END, 6) AS confidence
FROM supplier""")
def score_files(spark, sf_dir):
    """Confidence summaries of one file each, with fields that nobody asks for; single chains have no iptm."""
    folder = fresh_folder(spark, "scores")
    summary = F.to_json(
        F.struct(
            (F.col("s_acctbal") / 100).alias("ranking_score"),
            F.array(F.col("s_acctbal")).alias("chain_iptm"),
            F.when(F.col("s_suppkey") % 4 != 0, F.col("s_acctbal") / 200).alias("iptm"),
            (F.col("s_nationkey").cast("double") / 25).alias("ptm"),
        )
    )
    _one_file_each(table(spark, sf_dir, "supplier").select(_supplier_id().alias("id"), summary.alias("value")), folder)
    read = documents.scan_scores(spark, f"{folder}/{ONE_FILE.replace('{id}', '*')}")
    confidence = F.lit(fixed.CONFIDENCE_IPTM) * F.col("iptm") + F.lit(fixed.CONFIDENCE_PTM) * F.col("ptm")
    return read.select(
        path_id(f"{folder}/{ONE_FILE}").alias("id"), "ranking_score", "iptm", "ptm", F.round(confidence, 6).alias("confidence")
    )


@query("model_arrays_roundtrip", """SELECT 'v' || vec_id AS id, label AS model,
  len(embedding)::BIGINT AS n, embedding[1]::DOUBLE AS first, embedding[len(embedding)]::DOUBLE AS last,
  embedding[2]::DOUBLE AS corner FROM embeddings""")
def model_arrays_roundtrip(spark, sf_dir):
    """Vectors as stored model arrays: a flat one and a nested one, read with their declared types."""
    vector = F.col("embedding").cast("array<double>")
    rows = table(spark, sf_dir, "embeddings").select(
        prefixed("v", "vec_id").alias("id"), F.col("label").alias("model"), vector.alias("plddt"),
        F.array(F.array(vector)).alias("logits"), F.lit(1).alias("other"),
    )
    folder = fresh_folder(spark, "arrays")
    rows.write.parquet(folder)
    read = tables.read_model_arrays(spark, folder)
    return read.select(
        "id", "model", F.size("plddt").cast("bigint").alias("n"), F.get("plddt", F.lit(0)).alias("first"),
        F.try_element_at("plddt", F.lit(-1)).alias("last"), F.col("logits")[0][0][1].alias("corner"),
    )


@query("markdown_lines", """WITH r AS (
  SELECT event_type, count(*) AS n, max(event_id) AS last FROM events GROUP BY event_type)
SELECT 0::BIGINT AS place, '| event_type | n | last |' AS line
UNION ALL SELECT 1, '| :--- | ---: | ---: |'
UNION ALL SELECT 1 + row_number() OVER (ORDER BY event_type),
  '| ' || event_type || ' | ' || n || ' | ' || last || ' |' FROM r""")
def markdown_lines(spark, sf_dir):
    """Every line of a pipe table, with its place in the table."""
    report = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.max("event_id").alias("last")
    )
    folder = fresh_folder(spark, "report")
    table_sinks.write_markdown(report.orderBy("event_type"), folder)
    lines = scan_logs(spark, folder)
    # One row for each part file.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.groupBy("file").agg(F.count("*").alias("_n")).select(
        "file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    return lines.join(starts, "file").select((F.col("_start") + F.col("line_no")).alias("place"), "line")


@query("log_lines", f"""WITH {EVENT_LINES_SQL}
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS line_no, line FROM lines""")
def log_lines(spark, sf_dir):
    """A log for each user, scanned back with the number of each line."""
    folder = fresh_folder(spark, "logs")
    ordered = spread(event_lines(spark, sf_dir), "user_id").sortWithinPartitions("user_id", "ts", "event_id")
    ordered.select("user_id", F.concat("line", F.lit(" \t ")).alias("value")).write.partitionBy("user_id").text(folder)
    lines = scan_logs(spark, f"{folder}/user_id=*")
    return lines.select(
        F.regexp_extract("file", "/user_id=([0-9]+)/", 1).cast("bigint").alias("user_id"), "line_no", "line"
    )


@query("fasta_head", """SELECT 'd' || doc_id AS id, length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS n
FROM documents ORDER BY doc_id LIMIT 10""")
def fasta_head(spark, sf_dir):
    """The first ten records of a sequence file in document order."""
    letters = F.regexp_replace("text", "[^A-Za-z]", "")
    records = table(spark, sf_dir, "documents").orderBy("doc_id").select(
        prefixed("d", "doc_id").alias("id"), F.regexp_replace(letters, "(.{60})", "$1\n").alias("seq")
    )
    folder = fresh_folder(spark, "fasta")
    table_sinks.write_fasta(records, folder)
    read = sequences.read_fasta(spark, folder, stop=10)
    return read.select("id", F.length("seq").cast("bigint").alias("n"))


@query("complex_window", """WITH f AS (
  SELECT n_chars > 16 AND n_chars <= 2500 AS c, doc_id % 3 = 0 AS a, doc_id IN (SELECT doc_id FROM labels) AS d
  FROM documents),
n AS (
  SELECT 'fitting' AS step, count(*) FILTER (c) AS n, count(*) AS total FROM f
  UNION ALL SELECT 'aligned', count(*) FILTER (c AND a), count(*) FROM f
  UNION ALL SELECT 'done', count(*) FILTER (c AND d), count(*) FROM f)
SELECT step, n, total, round(n / total, 6) AS share FROM n""")
def complex_window(spark, sf_dir):
    """Stages of complexes inside their own window: fitting, aligned and done."""
    flags = campaign.flagged(sized(spark, sf_dir), done(spark, sf_dir), fixed.COMPLEX_WINDOW)
    marked = flags.withColumn("aligned", F.col("id") % 3 == 0)
    counts = progress.shares(
        marked,
        {"fitting": "tokens_check", "aligned": "tokens_check & aligned", "done": "tokens_check & pred_isfile"},
    )
    return counts.select("step", "n", "total", F.round("share", 6).alias("share"))


@query("batch_member_chunks", f"""WITH {PLAN_SQL},
placed AS (SELECT *, row_number() OVER (ORDER BY tokens, id) - 1 AS pos FROM plan)
SELECT batch_id, pos // 50 AS chunk, count(*) AS no_of_sequences,
  string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS members
FROM placed GROUP BY ALL""")
def batch_member_chunks(spark, sf_dir):
    """Members of the planned batches in lists of at most 50."""
    fitting = sized(spark, sf_dir).where(sizes.in_window(F.col("tokens"), fixed.BATCH_WINDOW))
    left = fitting.join(done(spark, sf_dir), "id", "left_anti")
    assigned = batching.assign_batches(left, costs.Quadratic(), HOURS)
    chunks = batching.member_chunks(assigned, 50)
    return chunks.withColumn("members", F.array_join("members", " "))


@query("first_write_wins", """SELECT 'p' || (p_partkey % 1000) AS id,
  min(p_name) FILTER (p_size < 25) AS early, min(p_name) AS any_name, length(coalesce(min(p_name) FILTER (p_size < 25), min(p_name))) AS tokens
FROM part GROUP BY ALL""")
def first_write_wins(spark, sf_dir):
    """Many rows for one id, in two writes: one document each, of the first write that has it."""
    part = table(spark, sf_dir, "part")
    records = part.select(F.concat(F.lit("p"), (F.col("p_partkey") % 1000).cast("string")).alias("id"), F.col("p_name").alias("seq"), "p_size")
    folder = fresh_folder(spark, "inputs")
    document_sinks.write_inputs(records.where("p_size < 25").drop("p_size"), folder)
    document_sinks.write_inputs(records.drop("p_size"), folder)
    read = documents.scan_inputs(spark, folder, whole_files=False)
    names = records.groupBy("id").agg(
        F.min(F.when(F.col("p_size") < 25, F.col("seq"))).alias("early"), F.min("seq").alias("any_name")
    )
    return read.select("id", sizes.token_count(F.col("sequences")).alias("tokens")).join(names, "id", "left")


@query("composed_and_quarantined", """SELECT 'documents' AS sink, 'c' || (o_custkey % 25) || '_n' || (o_orderkey % 25) AS name, 'ok' AS status,
  CAST(length(a.n_name) + length(b.n_name) AS BIGINT) AS tokens
FROM (SELECT DISTINCT o_custkey % 25 AS o_custkey, o_orderkey % 25 AS o_orderkey FROM orders)
  JOIN nation a ON a.n_nationkey = o_custkey JOIN nation b ON b.n_nationkey = o_orderkey
UNION ALL SELECT 'quarantine', 'x' || o_orderkey || '_n1', 'missing_member', NULL FROM orders WHERE o_orderkey % 100 = 1""")
def composed_and_quarantined(spark, sf_dir):
    """Pairs composed from a cache in one pass: documents in one sink, keys with lost members in the other."""
    nation, orders = table(spark, sf_dir, "nation"), table(spark, sf_dir, "orders")
    key = F.col("n_nationkey").cast("string")
    singles = nation.select(F.concat(F.lit("c"), key).alias("id"), F.col("n_name").alias("seq")).unionAll(
        nation.select(F.concat(F.lit("n"), key), F.col("n_name"))
    )
    cache_folder, folder = fresh_folder(spark, "cache"), fresh_folder(spark, "composed")
    document_sinks.write_inputs(singles, cache_folder)
    cache = documents.scan_inputs(spark, cache_folder, whole_files=False)
    pairs = orders.select(
        F.concat(F.lit("c"), (F.col("o_custkey") % 25).cast("string"), F.lit("_n"), (F.col("o_orderkey") % 25).cast("string")).alias("id")
    )
    lost = orders.where("o_orderkey % 100 = 1").select(F.concat(prefixed("x", "o_orderkey"), F.lit("_n1")).alias("id"))
    document_sinks.write_routed(compose.compose(pairs.unionAll(lost), cache.select("id", "name", "entries")), folder)
    whole = documents.scan_inputs(spark, f"{folder}/sink=documents", whole_files=False).select(
        F.lit("documents").alias("sink"), "name", F.lit("ok").alias("status"), sizes.token_count(F.col("sequences")).alias("tokens")
    )
    kept = spark.read.text(folder).where("sink = 'quarantine'").select(F.from_json("value", "id string, status string").alias("q"))
    return whole.unionAll(
        kept.select(F.lit("quarantine"), F.col("q.id"), F.col("q.status"), F.lit(None).cast("bigint"))
    )
