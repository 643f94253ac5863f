"""Sources and sinks, each written to the shared folder and read back."""

from pyspark.sql import functions as F

from tallyloom.functions import names, sizes
from tallyloom.functions.text import log_captures
from tallyloom.operators import compose, dimensions, existence
from tallyloom.plans.log_queries import CAPTURE_SQL, EVENT_LINES_SQL, event_lines
from tallyloom.plans.planning_queries import PLAN_SQL, raw_plan
from tallyloom.plans.record_queries import jobname_sql, prefixed
from tallyloom.plans.registry import query, table
from tallyloom.session import fresh_folder
from tallyloom.sinks import documents as document_sinks
from tallyloom.sinks import tables as table_sinks
from tallyloom.sources import documents, keylists, listing, sequences, tables
from tallyloom.sources.logs import scan_logs

LETTERS = "[^A-Za-z]"


@query("fasta_roundtrip", """SELECT 'd' || doc_id AS id,
  length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n,
  md5(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS digest
FROM documents""")
def fasta_roundtrip(spark, sf_dir):
    """Document letters as wrapped sequence records with a described header."""
    letters = F.regexp_replace("text", LETTERS, "")
    records = table(spark, sf_dir, "documents").select(
        F.concat(prefixed("d", "doc_id"), F.lit(" "), F.col("source"), F.lit("|>x")).alias("id"),
        F.regexp_replace(letters, "(.{60})", "$1\n").alias("seq"),
    )
    folder = fresh_folder(spark, "fasta")
    table_sinks.write_fasta(records, folder)
    read = sequences.read_fasta(spark, folder)
    return read.select("id", F.length("seq").cast("bigint").alias("n"), F.md5("seq").alias("digest"))


@query("complex_fasta", """SELECT 'o' || l_orderkey AS complex, count(*) AS members,
  CAST(sum(length(p_name)) AS BIGINT) AS letters
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""")
def complex_fasta(spark, sf_dir):
    """Orders as complexes of their parts: member records written, read back, counted per order."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").alias("p_partkey")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    wide = compose.lookup_join(
        lines, parts, "p_partkey", ["l_orderkey", "l_linenumber", "l_suppkey"], "inner"
    )
    complex_ = prefixed("o", "l_orderkey")
    header = F.concat(complex_, F.lit("+"), prefixed("p", "p_partkey"))
    folder = fresh_folder(spark, "complexes")
    sequence = F.translate("p_name", " ", "-")
    table_sinks.write_fasta(wide.select(header.alias("id"), sequence.alias("seq")), folder)
    read = sequences.read_fasta(spark, folder)
    return read.groupBy(F.split_part("id", F.lit("+"), F.lit(1)).alias("complex")).agg(
        F.count("*").alias("members"), F.sum(F.length("seq")).cast("bigint").alias("letters")
    )


@query("input_json_roundtrip", """SELECT 'p' || p_partkey AS id, 'p' || p_partkey AS name,
  length(p_name || '"' || p_type) AS tokens, 1 AS entries, 'A' AS chain,
  CAST(4 AS INTEGER) AS seed
FROM part""")
def input_json_roundtrip(spark, sf_dir):
    """Parts as documents; the second write finds the first one's ids and skips them."""
    part = table(spark, sf_dir, "part")
    text = F.concat("p_name", F.lit('"'), F.col("p_type"))
    records = part.select(prefixed("p", "p_partkey").alias("id"), text.alias("seq"), "p_size")
    folder = fresh_folder(spark, "inputs")
    document_sinks.write_inputs(records.where("p_size < 25").drop("p_size"), folder)
    document_sinks.write_inputs(records.drop("p_size"), folder)
    read = documents.scan_inputs(spark, folder, whole_files=False)
    return read.select(
        "id",
        "name",
        sizes.token_count(F.col("sequences")).alias("tokens"),
        F.size("entries").alias("entries"),
        F.col("sequences")[0]["chain_ids"][0].alias("chain"),
        F.col("model_seeds")[0].alias("seed"),
    )


@query("listing_roundtrip", "SELECT DISTINCT source AS id FROM documents")
def listing_roundtrip(spark, sf_dir):
    """Document ids in a folder per source; the sources come back from the paths alone."""
    folder = fresh_folder(spark, "listing")
    rows = table(spark, sf_dir, "documents").select(
        "source", F.col("doc_id").cast("string").alias("value")
    )
    rows.write.partitionBy("source").text(folder)
    return listing.scan_ids(spark, f"{folder}/source={{id}}/part-*").select("id").distinct()


@query("composed_json_roundtrip", f"""WITH s AS (
  SELECT DISTINCT {jobname_sql("s_name")} AS a, s_name, {jobname_sql("n_name")} AS b, n_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT a || '_' || b AS name, length(s_name) + length(n_name) AS tokens, 'B,C' AS chains,
  CAST(2 AS INTEGER) AS version, CAST(1 AS INTEGER) AS seed FROM s""")
def composed_json_roundtrip(spark, sf_dir):
    """Single documents written, cached entries re-lettered as raw text, gzipped and read back."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    a, b = names.jobname(F.col("s_name")), names.jobname(F.col("n_name"))
    singles = supplier.select(a.alias("id"), F.col("s_name").alias("seq")).unionAll(
        nation.select(b.alias("id"), F.col("n_name").alias("seq"))
    )
    cache_folder, folder = fresh_folder(spark, "cache"), fresh_folder(spark, "composed")
    document_sinks.write_inputs(singles, cache_folder, compression="gzip")
    cache = documents.scan_inputs(spark, cache_folder, whole_files=False)
    keys = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(a, F.lit("_"), b).alias("id")
    )
    composed = compose.compose(keys, cache.select("id", "name", "entries"))
    document_sinks.write_composed(composed, folder)
    read = documents.scan_inputs(spark, folder, whole_files=False)
    chains = F.transform("sequences", lambda e: e["chain_ids"][0])
    return read.select(
        "name",
        sizes.token_count(F.col("sequences")).alias("tokens"),
        F.array_join(chains, ",").alias("chains"),
        "version",
        F.col("model_seeds")[0].alias("seed"),
    )


@query("tsv_roundtrip", f"""WITH {PLAN_SQL}
SELECT CAST(id AS VARCHAR) AS id, 'inputs/' || id || '.json' AS json, tokens,
  'predictions/' || id || '/' || id || '_model.cif.gz' AS pred,
  true AS tokens_check, false AS pred_isfile,
  round(weight, 6) AS weight, round(weight_cumsum, 6) AS weight_cumsum, batch_id
FROM plan""")
def tsv_roundtrip(spark, sf_dir):
    """The plan written once; a second write leaves it as it is."""
    plan = raw_plan(spark, sf_dir)
    folder = fresh_folder(spark, "plan")
    table_sinks.write_plan(plan, folder)
    table_sinks.write_plan(plan.where("false"), folder)
    return tables.read_plan(spark, folder).withColumns(
        {c: F.round(c, 6) for c in ("weight", "weight_cumsum")}
    )


@query("proteome_roundtrip", f"""SELECT p_partkey || ' ' || p_brand AS entry,
  {jobname_sql("p_partkey || ' ' || p_brand")} AS id, p_name AS seq, length(p_name) AS n FROM part""")
def proteome_roundtrip(spark, sf_dir):
    """Parts as a gzipped table of named sequences; other columns are ignored on reading."""
    entry = F.concat(F.col("p_partkey").cast("string"), F.lit(" "), F.col("p_brand"))
    rows = table(spark, sf_dir, "part").select(
        entry.alias("Entry"), F.col("p_type").alias("Other"), F.col("p_name").alias("Sequence")
    )
    folder = fresh_folder(spark, "proteome")
    rows.write.csv(folder, sep="\t", header=True, compression="gzip")
    read = sequences.read_proteome(spark, folder)
    return read.select(
        F.col("id").alias("entry"),
        names.jobname(F.col("id")).alias("id"),
        "seq",
        F.length("seq").cast("bigint").alias("n"),
    )


@query("complexes_roundtrip", """SELECT 'o' || o_orderkey AS id,
  o_orderpriority || ',' || o_orderstatus AS seq, length(o_orderpriority) + 2 AS n FROM orders""")
def complexes_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        prefixed("o", "o_orderkey").alias("id"),
        F.concat("o_orderpriority", F.lit(","), F.col("o_orderstatus")).alias("sequence"),
    )
    folder = fresh_folder(spark, "complexes")
    rows.write.csv(folder, header=True)
    read = sequences.read_complexes(spark, folder)
    return read.withColumn("n", F.length("seq").cast("bigint"))


@query("keylist_roundtrip", f"""SELECT {jobname_sql("s_name")} AS id FROM supplier""")
def keylist_roundtrip(spark, sf_dir):
    """Supplier names as a key list with trailing comments, comment lines and blanks."""
    id_ = names.jobname(F.col("s_name"))
    line = F.array(
        F.concat(F.lit("# "), F.col("s_name")),
        F.concat(id_, F.lit("  # nation "), F.col("s_nationkey").cast("string")),
        F.lit(" "),
    )
    folder = fresh_folder(spark, "keys")
    table(spark, sf_dir, "supplier").select(F.explode(line)).write.text(folder)
    return keylists.read_keys(spark, folder)


@query("manifest_roundtrip", f"""WITH {PLAN_SQL}
SELECT CAST(batch_id AS INTEGER) AS batch_id, unnest(['inputs/' || id || '.json',
  'predictions/' || id || '/' || id || '_model.cif.gz']) AS path
FROM plan""")
def manifest_roundtrip(spark, sf_dir):
    """One folder of paths per batch."""
    folder = fresh_folder(spark, "manifests")
    plan = raw_plan(spark, sf_dir)
    table_sinks.write_manifests(plan, folder, [F.col("json"), F.col("pred")])
    return spark.read.text(folder).select("batch_id", F.col("value").alias("path"))


@query("score_table", """SELECT event_id, json_extract(props, '$.k')::DOUBLE / 100 AS ranking_score,
  round(0.8 * value / 100 + 0.2 * (json_extract(props, '$.k')::DOUBLE / 100), 6) AS confidence
FROM events""")
def score_table(spark, sf_dir):
    """Confidence summaries as JSON, read with declared fields."""
    k = F.get_json_object("props", "$.k").try_cast("double") / 100
    scores = table(spark, sf_dir, "events").select(
        F.to_json(
            F.struct(
                F.col("event_id"), k.alias("ranking_score"),
                (F.col("value") / 100).alias("iptm"), k.alias("ptm"), F.lit("x").alias("other"),
            )
        ).alias("value")
    )
    folder = fresh_folder(spark, "scores")
    scores.write.text(folder, compression="gzip")
    parsed = F.from_json("value", "event_id bigint, ranking_score double, iptm double, ptm double")
    read = spark.read.text(folder).select(parsed.alias("s")).select("s.*")
    confidence = F.round(F.lit(0.8) * F.col("iptm") + F.lit(0.2) * F.col("ptm"), 6)
    return read.select("event_id", "ranking_score", confidence.alias("confidence"))


@query("markdown_report", """SELECT 'rows' AS what, count(DISTINCT event_type) + 2 AS n
FROM events""")
def markdown_report(spark, sf_dir):
    """A pipe table of events per type: two head lines and one line per type."""
    report = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    folder = fresh_folder(spark, "report")
    table_sinks.write_markdown(report.orderBy("event_type"), folder)
    rows = spark.read.text(folder).where("value like '| % |'")
    return rows.agg(F.lit("rows").alias("what"), F.count("*").alias("n")).select("what", "n")


@query("accounting_roundtrip", """SELECT CAST(event_id AS VARCHAR) AS JobID, event_type AS State,
  props AS Comment, CAST(value AS VARCHAR) AS MaxRSS FROM events""")
def accounting_roundtrip(spark, sf_dir):
    """Bar-separated accounting re-delimited with tabs, all fields unchanged."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("JobID"), F.col("event_type").alias("State"),
        F.col("props").alias("Comment"), F.col("value").alias("MaxRSS"),
    )
    bars, tabs = fresh_folder(spark, "sstat"), fresh_folder(spark, "sstat")
    rows.write.csv(bars, sep="|", header=True)
    table_sinks.write_accounting(tables.read_accounting(spark, bars), tabs)
    return spark.read.csv(tabs, sep="\t", header=True)


@query("gpu_samples_roundtrip", """SELECT CAST(user_id AS INTEGER) AS index,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type AS name, value AS mem_used FROM events""")
def gpu_samples_roundtrip(spark, sf_dir):
    """Samples written the way the monitor prints them, comma and space between fields."""
    stamp = F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    fields = F.concat_ws(
        ", ", F.col("user_id").cast("string"), F.lit("8"), F.concat(stamp, F.lit(".000")),
        F.col("event_type"), F.lit("0"), F.lit("0"), F.lit("80000"), F.lit("80000"),
        F.col("value").cast("string"),
    )
    folder = fresh_folder(spark, "samples")
    rows = table(spark, sf_dir, "events").select(fields.alias("value"))
    rows.write.text(folder)
    samples = tables.read_gpu_samples(spark, folder, header=False)
    return samples.select(
        "index", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "name", "mem_used"
    )


@query("log_roundtrip", f"""WITH {EVENT_LINES_SQL}, {CAPTURE_SQL}
SELECT count(*) AS lines, count(n_tokens) AS sizes, count(runtime_sec) AS runtimes,
  count(done_processing) AS dones, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM caught""")
def log_roundtrip(spark, sf_dir):
    """Log lines written to files and scanned back with file and line number."""
    folder = fresh_folder(spark, "logs")
    event_lines(spark, sf_dir).select(F.concat("line", F.lit("  "))).write.text(folder)
    lines = scan_logs(spark, folder)
    caught = lines.select(
        "file", "line_no", *[c.alias(n) for n, c in log_captures(F.col("line")).items()]
    )
    return caught.agg(
        F.count_distinct("file", "line_no").alias("lines"),
        F.count("n_tokens").alias("sizes"),
        F.count("runtime_sec").alias("runtimes"),
        F.count("done_processing").alias("dones"),
        F.sum("n_tokens").alias("tokens"),
    )


@query("variant_scores", """SELECT r_name AS variant, s_suppkey AS id,
  s_acctbal >= 1000 * r_regionkey AS isfile,
  CASE WHEN s_acctbal >= 1000 * r_regionkey THEN s_acctbal END AS ranking_score
FROM supplier CROSS JOIN region""")
def variant_scores(spark, sf_dir):
    """Every supplier under every region: which results exist, and their scores where they do."""
    regions = table(spark, sf_dir, "region").select("r_name", "r_regionkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    crossed = dimensions.per_row(suppliers, regions, "region").withColumn("variant", F.col("region.r_name"))
    expected = crossed.select(
        "variant", F.col("s_suppkey").alias("id"), F.concat_ws("/", "variant", "s_suppkey").alias("path")
    )
    listing = crossed.where(F.col("s_acctbal") >= 1000 * F.col("region.r_regionkey")).select(
        F.concat_ws("/", "variant", "s_suppkey").alias("path"), "s_acctbal"
    )
    flagged = existence.with_exists(expected, listing, "path", "isfile")
    scored = flagged.join(listing, "path", "left")
    return scored.select("variant", "id", "isfile", F.col("s_acctbal").alias("ranking_score"))
