"""Names, nested records, composition and arrays."""

from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions import arrays, costs, names, sizes
from tallyloom.operators import compose, dimensions, events, existence
from tallyloom.operators.skew import lookup_join
from tallyloom.plans.campaign import PREDICTION_PATH
from tallyloom.plans.registry import query, table

JOBNAME_SQL = (
    r"regexp_replace(translate(lower(trim({0})), ' _', '--'), '[^\p{{Ll}}\p{{N}}._-]', '', 'g')"
)


def jobname_sql(column):
    return JOBNAME_SQL.format(column)


@query("jobname", f"""SELECT kind, key, raw, {jobname_sql("raw")} AS job_id FROM (
  SELECT 'part' AS kind, p_partkey AS key, p_name AS raw FROM part
  UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
  UNION ALL SELECT 'order', o_orderkey, o_orderpriority FROM orders)""")
def jobname(spark, sf_dir):
    def named(kind, name, key, raw):
        rows = table(spark, sf_dir, name)
        return rows.select(
            F.lit(kind).alias("kind"), F.col(key).alias("key"), F.col(raw).alias("raw")
        )

    rows = (
        named("part", "part", "p_partkey", "p_name")
        .unionAll(named("supplier", "supplier", "s_suppkey", "s_name"))
        .unionAll(named("order", "orders", "o_orderkey", "o_orderpriority"))
    )
    return rows.withColumn("job_id", names.jobname(F.col("raw")))


@query("jobname_first_wins", f"""SELECT p_partkey, p_name, job_id,
  row_number() OVER (PARTITION BY job_id ORDER BY p_partkey) = 1 AS written
FROM (SELECT p_partkey, p_name, {jobname_sql("p_name")} AS job_id FROM part)""")
def jobname_first_wins(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", names.jobname(F.col("p_name")).alias("job_id")
    )
    return events.first_wins(parts, "job_id", "p_partkey")


@query("id_checks", f"""SELECT kind, key, value,
  regexp_matches(value, '^[\\w.-]*$') AS valid, {jobname_sql("value")} = value AS canonical
FROM (SELECT 'brand' AS kind, p_partkey AS key, p_brand AS value FROM part
  UNION ALL SELECT 'type', p_partkey, p_type FROM part
  UNION ALL SELECT 'url', page_id, url FROM pages)""")
def id_checks(spark, sf_dir):
    part, pages = table(spark, sf_dir, "part"), table(spark, sf_dir, "pages")

    def checked(rows, kind, key, value):
        return rows.select(
            F.lit(kind).alias("kind"), F.col(key).alias("key"), F.col(value).alias("value")
        )

    rows = (
        checked(part, "brand", "p_partkey", "p_brand")
        .unionAll(checked(part, "type", "p_partkey", "p_type"))
        .unionAll(checked(pages, "url", "page_id", "url"))
    )
    value = F.col("value")
    return rows.select(
        "*",
        names.id_is_valid(value).alias("valid"),
        (names.jobname(value) == value).alias("canonical"),
    )


@query("path_columns", r"""SELECT page_id, url,
  regexp_extract(url, '([^/]+?)(?:\.[^./]*)?$', 1) AS stem,
  CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS bare,
  'predictions/' || page_id || '/' || page_id || '_model.cif.gz' AS pred
FROM pages""")
def path_columns(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        names.record_name(url).alias("stem"),
        names.without_prefix(url, "https://").alias("bare"),
        names.filled(PREDICTION_PATH, F.col("page_id")).alias("pred"),
    )


@query("header_accession", """SELECT s_suppkey, line,
  CASE WHEN line[1] = '>' THEN '>' || split_part(line, '|', 2) ELSE line END AS fixed_line
FROM (
  SELECT s_suppkey, '>sp|' || s_suppkey || '|' || s_name AS line FROM supplier
  UNION ALL SELECT s_suppkey, s_name || '|' || s_nationkey FROM supplier)""")
def header_accession(spark, sf_dir):
    header = F.concat(F.lit(">sp|"), F.col("s_suppkey").cast("string"), F.lit("|"), F.col("s_name"))
    body = F.concat("s_name", F.lit("|"), F.col("s_nationkey").cast("string"))
    lines = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.explode(F.array(header, body)).alias("line")
    )
    return lines.withColumn("fixed_line", names.accession_header(F.col("line")))


@query("token_count", """SELECT conv_id, CAST(sum(entries) AS BIGINT) AS entries,
  CAST(sum(CASE WHEN role = 'system' THEN 0
    ELSE (CASE WHEN role = 'user' THEN 1 ELSE 2 END) * (length(text) - entries + 1) END)
    AS BIGINT) AS tokens
FROM (SELECT *, len(string_split(text, chr(10))) AS entries FROM conversations)
GROUP BY conv_id""")
def token_count(spark, sf_dir):
    """Each turn is a nested record with one entry per line; sizes are summed per conversation."""
    kind = F.when(F.col("role") == "system", "ligand").otherwise("protein")
    chains = F.when(F.col("role") == "user", F.array(F.lit("A"))).otherwise(
        F.array(F.lit("A"), F.lit("B"))
    )
    entries = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            kind.alias("kind"), chains.alias("chain_ids"), line.alias("sequence")
        ),
    )
    records = table(spark, sf_dir, "conversations").select("conv_id", entries.alias("sequences"))
    counted = records.select(
        "conv_id",
        F.size("sequences").cast("bigint").alias("entries"),
        sizes.token_count(F.col("sequences")).alias("tokens"),
    )
    return counted.groupBy("conv_id").agg(
        F.sum("entries").alias("entries"), F.sum("tokens").alias("tokens")
    )


@query("json_field", """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
  round(0.8 * (CAST(json_extract(props, '$.k') AS DOUBLE) / 100) + 0.2 * (value / 100), 6)
    AS confidence
FROM events""")
def json_field(spark, sf_dir):
    k = F.get_json_object("props", "$.k").try_cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        k.alias("k"),
        F.round(
            costs.model_confidence(k.cast("double") / 100, F.col("value") / 100), 6
        ).alias("confidence"),
    )


#: Letters of a position up to three of them: B to Z, AA to ZZ, AAA to ZZZ.
LETTER_SQL = """CASE WHEN turn < 25 THEN chr(CAST(66 + turn AS INTEGER))
      WHEN turn < 701 THEN chr(CAST(64 + (turn + 1) // 26 AS INTEGER))
        || chr(CAST(65 + (turn + 1) % 26 AS INTEGER))
      ELSE chr(CAST(64 + ((turn + 1) // 26 - 1) // 26 AS INTEGER))
        || chr(CAST(65 + ((turn + 1) // 26 - 1) % 26 AS INTEGER))
        || chr(CAST(65 + (turn + 1) % 26 AS INTEGER)) END"""


@query("compose_members", f"""WITH g AS (
  SELECT conv_id, count(*) AS members, min(turn) >= 0 AS fits,
    count(DISTINCT turn) = count(*) AS single,
    string_agg(role, '_' ORDER BY turn) AS name,
    string_agg({LETTER_SQL}, ',' ORDER BY turn) AS chains,
    CAST(sum(length(text)) AS BIGINT) AS tokens
  FROM conversations GROUP BY conv_id)
SELECT conv_id, members, CASE WHEN NOT fits THEN 'negative_position'
    WHEN NOT single THEN 'repeated_position' ELSE 'ok' END AS status,
  CASE WHEN fits AND single THEN name END AS name,
  CASE WHEN fits AND single THEN chains END AS chains, tokens
FROM g""")
def compose_members(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.length("text").alias("size")
    )
    return compose.compose_positions(turns, "conv_id", "turn", "role", "size")


def single_member(id_, sequence):
    """Columns of a one-chain document."""
    entry = F.struct(
        F.lit("protein").alias("kind"),
        F.array(F.lit(fixed.SINGLE_CHAIN)).alias("chain_ids"),
        sequence.alias("sequence"),
    )
    return [id_.alias("id"), id_.alias("name"), F.array(entry).alias("sequences")]


@query("composite_key", f"""WITH s AS (
  SELECT {jobname_sql("s_name")} AS a, length(s_name) AS la, s_acctbal >= 0 AS cached,
    {jobname_sql("n_name")} AS b, length(n_name) AS lb
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT a || '_' || b AS id, CAST(2 AS BIGINT) AS members,
  CASE WHEN cached THEN 'ok' ELSE 'missing_member' END AS status,
  CASE WHEN cached THEN a || '_' || b END AS name,
  CASE WHEN cached THEN 'B,C' END AS chains,
  CASE WHEN cached THEN la + lb END AS tokens
FROM s""")
def composite_key(spark, sf_dir):
    """Supplier-nation pairs composed from a cache that lacks suppliers in debt."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    a, b = names.jobname(F.col("s_name")), names.jobname(F.col("n_name"))
    keys = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(a, F.lit("_"), b).alias("id")
    )
    cache = (
        supplier.where("s_acctbal >= 0")
        .select(*single_member(a, F.col("s_name")))
        .unionAll(nation.select(*single_member(b, F.col("n_name"))))
    )
    return with_sizes(compose.compose(keys, cache))


def with_sizes(composed):
    chains = F.transform("sequences", lambda e: e["chain_ids"][0])
    ok = F.col("status") == "ok"
    return composed.select(
        "id", "members", "status", "name",
        F.when(ok, F.array_join(chains, ",")).alias("chains"),
        F.when(ok, sizes.token_count(F.col("sequences"))).alias("tokens"),
    )


PAIRS_SQL = """pairs AS (
  SELECT DISTINCT 'p' || l_partkey AS a, 's' || l_suppkey AS b FROM lineitem)"""


@query("compose_pairs", f"""WITH {PAIRS_SQL}
SELECT a || '_' || b AS id, CAST(2 AS BIGINT) AS members, 'ok' AS status,
  a || '_' || b AS name, 'B,C' AS chains, length(p_name) + length(s_name) AS tokens
FROM pairs JOIN part ON a = 'p' || p_partkey JOIN supplier ON b = 's' || s_suppkey""")
def compose_pairs(spark, sf_dir):
    """Every part-supplier pair of the order lines, composed from parts and suppliers."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    cache = part.select(*single_member(prefixed("p", "p_partkey"), F.col("p_name"))).unionAll(
        supplier.select(*single_member(prefixed("s", "s_suppkey"), F.col("s_name")))
    )
    return with_sizes(compose.compose(line_pairs(spark, sf_dir), cache))


def prefixed(letter, key):
    return F.concat(F.lit(letter), F.col(key).cast("string"))


def line_pairs(spark, sf_dir):
    pair = F.concat(prefixed("p", "l_partkey"), F.lit("_"), prefixed("s", "l_suppkey"))
    return table(spark, sf_dir, "lineitem").select(pair.alias("id"))


@query("distinct_members", """SELECT DISTINCT 'p' || l_partkey AS member FROM lineitem
UNION SELECT 's' || l_suppkey FROM lineitem""")
def distinct_members(spark, sf_dir):
    return compose.distinct_members(line_pairs(spark, sf_dir))


@query("pair_tokens", f"""WITH {PAIRS_SQL}
SELECT a || '_' || b AS id, CAST(2 AS BIGINT) AS members,
  CAST(p_size AS BIGINT) AS tokens, CAST(1 AS BIGINT) AS missing
FROM pairs JOIN part ON a = 'p' || p_partkey""")
def pair_tokens(spark, sf_dir):
    """Key sizes from parts only: the supplier member of each pair has none."""
    lookup = table(spark, sf_dir, "part").select(
        prefixed("p", "p_partkey").alias("id"), F.col("p_size").alias("tokens")
    )
    return compose.total_size(line_pairs(spark, sf_dir), lookup)


@query("compose_tokens", """SELECT l_orderkey, count(*) AS members,
  CAST(coalesce(sum(p_size), 0) AS BIGINT) AS tokens,
  count(*) FILTER (p_size IS NULL) AS missing
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 2) ON l_partkey = p_partkey
GROUP BY l_orderkey""")
def compose_tokens(spark, sf_dir):
    """Order sizes from part sizes; parts of the smallest sizes count as not yet sized."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").alias("p_partkey")
    )
    parts = table(spark, sf_dir, "part").where("p_size > 2").select("p_partkey", "p_size")
    wide = lookup_join(lines, parts, "p_partkey", ["l_orderkey", "l_linenumber", "l_suppkey"])
    return compose.summed(wide, ["l_orderkey"], "p_size")


@query("required_lookup", """SELECT d.doc_id AS id, quality, quality IS NOT NULL AS found
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def required_lookup(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    return existence.required(documents, labels)


@query("variant_cross", """SELECT s_suppkey, r_name AS variant,
  r_name || '/' || s_suppkey || '/' || s_suppkey || '_scores.json.gz' AS expected
FROM supplier CROSS JOIN region""")
def variant_cross(spark, sf_dir):
    """Regions are the variants."""
    regions = table(spark, sf_dir, "region").select("r_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    crossed = dimensions.per_row(suppliers, regions).withColumn("variant", F.col("variant.r_name"))
    scores = names.filled("/{id}/{id}_scores.json.gz", F.col("s_suppkey"))
    return crossed.withColumn("expected", F.concat("variant", scores))


@query("array_slice", """SELECT vec_id, len(embedding) AS n, CAST(embedding[11] AS DOUBLE) AS at_10,
  CAST(embedding[1001] AS DOUBLE) AS at_1000, len(embedding[11:1000]) AS cut_n,
  CAST(embedding[11:1000][1] AS DOUBLE) AS cut_0
FROM embeddings""")
def array_slice(spark, sf_dir):
    vector = F.col("embedding")
    cut = arrays.cut(vector, 10, 1000)
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.size(vector).cast("bigint").alias("n"),
        arrays.at(vector, 10).cast("double").alias("at_10"),
        arrays.at(vector, 1000).cast("double").alias("at_1000"),
        F.size(cut).cast("bigint").alias("cut_n"),
        arrays.at(cut, 0).cast("double").alias("cut_0"),
    )


@query("array_series", """SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos,
  CAST(embedding[pos] AS DOUBLE) AS value
FROM embeddings, unnest(range(1, len(embedding) + 1)) AS r(pos) WHERE label = 1""")
def array_series(spark, sf_dir):
    chosen = table(spark, sf_dir, "embeddings").where("label = 1")
    return arrays.series(chosen, "embedding", "vec_id").withColumn(
        "value", F.col("value").cast("double")
    )
