"""Lines, log captures, event assembly, the cost fit and change detection."""

from pyspark.sql import functions as F

from tallyloom.functions import text as text_functions
from tallyloom.operators import events, fit
from tallyloom.plans.registry import query, table
from tallyloom.sources.logs import runtime_observations, text_lines
from tallyloom.sources.sequences import fasta_stats

LINES_SQL = """SELECT doc_id, CAST(n - 1 AS INTEGER) AS line_no, lines[n] AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
  unnest(range(1, len(lines) + 1)) AS r(n)"""


def document_lines(spark, sf_dir):
    return text_lines(table(spark, sf_dir, "documents"), "text", "doc_id")


@query("residue_lines", f"SELECT * FROM ({LINES_SQL}) WHERE NOT regexp_matches(line, '[0-9>]')")
def residue_lines(spark, sf_dir):
    return document_lines(spark, sf_dir).where(text_functions.is_residue_line(F.col("line")))


@query("marker_lines", f"SELECT * FROM ({LINES_SQL}) WHERE contains(line, ' the ')")
def marker_lines(spark, sf_dir):
    return document_lines(spark, sf_dir).where(text_functions.has_marker(F.col("line"), " the "))


@query("log_union", """SELECT 'document' AS kind, doc_id AS id, length(text) AS n FROM documents
UNION ALL SELECT 'benchmark', item_id, length(text) FROM benchmark""")
def log_union(spark, sf_dir):
    n = F.length("text").cast("bigint").alias("n")
    documents = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), n
    )
    benchmark = table(spark, sf_dir, "benchmark").select(
        F.lit("benchmark").alias("kind"), F.col("item_id").alias("id"), n
    )
    return documents.unionByName(benchmark)


@query("file_stats", """SELECT source AS file, count(*) AS sequences,
  CAST(sum(length(text)) AS BIGINT) AS sum_len, max(length(text)) AS max_len,
  CASE WHEN count(*) = 1 THEN 'monomer' ELSE 'multimer' END AS kind
FROM documents GROUP BY source""")
def file_stats(spark, sf_dir):
    records = table(spark, sf_dir, "documents").select(
        F.col("source").alias("file"), F.col("text").alias("seq")
    )
    return fasta_stats(records)


K = "CAST(json_extract(props, '$.k') AS BIGINT)"
EVENT_LINES_SQL = f"""lines AS (
  SELECT user_id, ts, event_id, CASE event_type
    WHEN 'view' THEN 'w x y z Calculating bucket size for input with ' || {K} || ' tokens.'
    WHEN 'click' THEN 'Running model inference and extracting output structures for seeds (4,) took '
      || value || ' seconds.'
    WHEN 'purchase' THEN 'Done processing fold input e' || event_id || '.'
    ELSE event_type || ' ' || value END AS line
  FROM events)"""
CAPTURE_SQL = r"""caught AS (
  SELECT *,
    CAST(nullif(regexp_extract(line,
      '^\S+ \S+ \S+ \S+ Calculating bucket size for input with ([-+]?[0-9]+) tokens\.$', 1), '')
      AS BIGINT) AS n_tokens,
    CAST(nullif(regexp_extract(line, 'for seeds \(4,\) took ([0-9.]+) seconds\.$', 1), '')
      AS DOUBLE) AS runtime_sec,
    nullif(regexp_extract(line, '^Done processing fold input (\S+)\.$', 1), '') AS done_processing
  FROM lines)"""


def event_lines(spark, sf_dir):
    """Each event as the log line its type stands for."""
    k = F.get_json_object("props", "$.k")
    line = (
        F.when(
            F.col("event_type") == "view",
            F.concat(
                F.lit("w x y z Calculating bucket size for input with "), k, F.lit(" tokens.")
            ),
        )
        .when(
            F.col("event_type") == "click",
            F.concat(
                F.lit(
                    "Running model inference and extracting output structures "
                    "for seeds (4,) took "
                ),
                F.col("value").cast("string"),
                F.lit(" seconds."),
            ),
        )
        .when(
            F.col("event_type") == "purchase",
            F.concat(
                F.lit("Done processing fold input e"), F.col("event_id").cast("string"), F.lit(".")
            ),
        )
        .otherwise(F.concat("event_type", F.lit(" "), F.col("value").cast("string")))
    )
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", line.alias("line"))


@query("log_capture", f"""WITH {EVENT_LINES_SQL}, {CAPTURE_SQL}
SELECT event_id, n_tokens, runtime_sec, done_processing FROM caught""")
def log_capture(spark, sf_dir):
    captures = text_functions.log_captures(F.col("line"))
    return event_lines(spark, sf_dir).select(
        "event_id", *[c.alias(n) for n, c in captures.items()]
    )


ASSEMBLY_SQL = """SELECT user_id,
  arg_max(n_tokens, row(ts, event_id)) FILTER (n_tokens IS NOT NULL) AS n_tokens,
  arg_max(runtime_sec, row(ts, event_id)) FILTER (runtime_sec IS NOT NULL) AS runtime_sec,
  arg_max(done, row(ts, event_id)) FILTER (done IS NOT NULL) AS done
FROM (SELECT *, count(done) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seg FROM captured)
GROUP BY user_id, seg HAVING count(done) > 0"""
EVENTS_SQL = f"""WITH captured AS (
  SELECT user_id, ts, event_id, CASE WHEN event_type = 'view' THEN {K} END AS n_tokens,
    CASE WHEN event_type = 'click' THEN value END AS runtime_sec,
    CASE WHEN event_type = 'purchase' THEN event_id END AS done
  FROM events)
SELECT *, n_tokens IS NOT NULL AND runtime_sec IS NOT NULL AS complete FROM ({ASSEMBLY_SQL})"""

EVENT_ORDER = ["ts", "event_id"]
CAPTURES = ["n_tokens", "runtime_sec"]


def captured_events(rows):
    """Views carry a size, clicks a runtime, purchases finish."""

    def when(kind, value):
        return F.when(F.col("event_type") == kind, value)

    return rows.where(F.col("event_type").isin("view", "click", "purchase")).select(
        "user_id",
        *EVENT_ORDER,
        when("view", F.get_json_object("props", "$.k").try_cast("bigint")).alias("n_tokens"),
        when("click", F.col("value")).alias("runtime_sec"),
        when("purchase", F.col("event_id")).alias("done"),
    )


@query("event_assembly", EVENTS_SQL)
def event_assembly(spark, sf_dir):
    captured = captured_events(table(spark, sf_dir, "events"))
    assembled = events.assemble_events(captured, ["user_id"], EVENT_ORDER, CAPTURES, "done")
    return assembled.drop("segment")


@query("quadratic_fit", """WITH p AS (
  SELECT l_quantity AS a, l_quantity * l_quantity AS b, l_extendedprice AS y FROM lineitem),
m AS (
  SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa,
    var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS b_y
  FROM p),
c AS (
  SELECT *, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS c2,
    (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS c1 FROM m)
SELECT round(c2, 4) AS c2, round(c1, 4) AS c1, round(my - c2 * mb - c1 * ma, 4) AS c0, n FROM c""")
def quadratic_fit(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return rounded_fit(fit.quadratic_fit(lines, "l_quantity", "l_extendedprice"))


def rounded_fit(fitted):
    return fitted.select(*[F.round(c, 4).alias(c) for c in ("c2", "c1", "c0")], "n")


@query("runtime_model", f"""WITH {EVENT_LINES_SQL}, {CAPTURE_SQL},
captured AS (SELECT * REPLACE (done_processing AS done_processing), done_processing AS done
  FROM caught),
o AS (SELECT * FROM ({ASSEMBLY_SQL}) WHERE n_tokens IS NOT NULL AND runtime_sec IS NOT NULL),
p AS (
  SELECT CAST(n_tokens AS DOUBLE) AS a, CAST(n_tokens AS DOUBLE) * n_tokens AS b,
    runtime_sec AS y FROM o),
m AS (
  SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa,
    var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS b_y
  FROM p),
c AS (
  SELECT *, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS c2,
    (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS c1 FROM m)
SELECT round(c2, 4) AS c2, round(c1, 4) AS c1, round(my - c2 * mb - c1 * ma, 4) AS c0, n FROM c""")
def runtime_model(spark, sf_dir):
    """From log lines to a refitted cost model: capture, assemble, fit."""
    observed = runtime_observations(event_lines(spark, sf_dir), ("user_id",), tuple(EVENT_ORDER))
    return rounded_fit(fit.quadratic_fit(observed.where("complete"), "n_tokens", "runtime_sec"))


CHANGES_SQL = """SELECT user_id, event_id, event_type FROM (
  SELECT *, lag(event_type) OVER w AS previous, row_number() OVER w AS n FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE n = 1 OR event_type IS DISTINCT FROM previous"""


@query("change_only", CHANGES_SQL)
def change_only(spark, sf_dir):
    samples = table(spark, sf_dir, "events").select("user_id", *EVENT_ORDER, "event_type")
    changed = events.changes_only(samples, "event_type", ["user_id"], EVENT_ORDER)
    return changed.select("user_id", "event_id", "event_type")
