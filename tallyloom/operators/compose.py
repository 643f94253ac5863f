"""Composing many-member records from single-member ones."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions.names import chain_letter
from tallyloom.operators.skew import HOT_ROWS, hot_keys, lookup_join, salted_join


#: Neighbouring positions of a group that are joined at once.
_RUN = 1024

#: Most rows of keys that a task is given to make distinct and to sum up.
TASK_KEYS = 500_000


def members_of(key: Column, delimiter: str = fixed.MEMBER_DELIMITER) -> Column:
    return F.split(key, re.escape(delimiter))


def ordered(position: Column, value: Column) -> Column:
    """Aggregate: values of a group as a list in position order.

    For groups whose length is bounded beforehand.
    """
    pairs = F.sort_array(F.collect_list(F.struct(position.alias("pos"), value.alias("value"))))
    return F.transform(pairs, lambda p: p["value"])


def distinct_members(
    keys: DataFrame, key: str = "id", delimiter: str = fixed.MEMBER_DELIMITER
) -> DataFrame:
    """Members needed by all keys, each once."""
    return keys.select(F.explode(members_of(F.col(key), delimiter)).alias("member")).distinct()


def expanded(
    keys: DataFrame, key: str = "id", delimiter: str = fixed.MEMBER_DELIMITER
) -> DataFrame:
    """One row per key and member position."""
    return keys.select(key, F.posexplode(members_of(F.col(key), delimiter)).alias("pos", "member"))


def key_tasks(keys: DataFrame, task_keys: int = TASK_KEYS) -> int:
    """How many tasks take all ``keys``, with about ``task_keys`` rows each.

    Partitions cut by their bytes are too large: names compress to a tenth of what they take in
    a task.
    """
    least = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-keys.select("id").count() // task_keys))


def distinct_keys(
    keys: DataFrame, hot: DataFrame | None, task_keys: int = TASK_KEYS, tasks: int | None = None
) -> DataFrame:
    """Every ``id`` once, dealt by id over ``tasks`` (or :func:`key_tasks`).

    Without ``hot`` members no id has more rows than a task may be given; else rows become one
    where they are read, before they are dealt out.
    """
    ids = keys.select("id")
    return (ids if hot is None else ids.distinct()).repartition(tasks or key_tasks(keys, task_keys), "id").distinct()


def _member_rows(cache: DataFrame, field: str) -> DataFrame:
    """What a composed record takes from its members, as little as goes through a shuffle.

    A name that is the member itself is left to be read from the key, and chains of parsed
    entries are lettered anew in any case.
    """
    entry = F.element_at(field, -1)
    if field == "sequences":
        entry = F.when(entry.isNotNull(), F.struct(entry["kind"].alias("kind"), entry["sequence"].alias("sequence")))
    same = F.col("name").cast("string").eqNullSafe(F.col("id").cast("string"))
    return cache.select(
        F.col("id").alias("member"),
        same.alias("_same"),
        F.when(~same, F.col("name")).alias("_name"),
        entry.alias("_entry"),
        (F.size(field) == 1).alias("_single"),
    )


def compose(
    keys: DataFrame,
    cache: DataFrame,
    delimiter: str = fixed.MEMBER_DELIMITER,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Compose every distinct key ``id`` from the ``cache`` of single-member documents.

    ``cache`` has ``id``, ``name`` and ``sequences`` (or raw ``entries``), one row
    per id. The result has ``id, name, members, status`` and ``sequences`` re-lettered
    in key order (``entries`` likewise). Only ``status = 'ok'`` rows are whole; the
    other states are ``missing_member``, ``not_single`` and ``no_entry_id`` (a raw entry
    whose body doesn't begin with its id). A key has as many members as its text names; they
    are brought together as the one row that they become.
    """
    field = "entries" if "entries" in cache.columns else "sequences"
    hot = hot_keys(expanded(keys, "id", delimiter), ["member"], hot_rows)
    tasks = key_tasks(keys)
    wide = salted_join(
        expanded(distinct_keys(keys, hot, tasks=tasks), "id", delimiter),
        _member_rows(cache, field),
        "member",
        ["id", "pos"],
        hot,
        hot_rows=hot_rows,
    )
    place = F.struct(
        "pos", F.col("_same").alias("same"), F.col("_name").alias("name"), F.col("_entry").alias("entry")
    )
    # Dealt out before, not after lists of one member are made and sorted in every task.
    grouped = wide.repartition(tasks, "id").groupBy("id").agg(
        F.sort_array(F.collect_list(place)).alias("_all"),
        F.count_if(F.col("_single").isNull()).alias("_missing"),
        F.count_if(~F.col("_single")).alias("_odd"),
        F.count_if(~F.col("_same")).alias("_renamed"),
    )
    members = members_of(F.col("id"), delimiter)
    count = F.size(members)
    renamed = F.transform("_all", lambda m: F.when(m["same"], F.get(members, m["pos"])).otherwise(m["name"]))
    name = F.array_join(renamed, fixed.MEMBER_DELIMITER)
    if delimiter == fixed.MEMBER_DELIMITER:
        as_named = (F.col("_renamed") == 0) & (F.size("_all") == count)
        name = F.when(as_named, F.col("id")).otherwise(name)
    status = (
        F.when(F.col("_missing") > 0, "missing_member")
        .when(F.col("_odd") > 0, "not_single")
        .otherwise("ok")
    )
    reletter = reletter_raw if field == "entries" else reletter_parsed
    lettered = grouped.withColumns(
        {"_status": status, "members": count.cast("bigint"), "_lettered": reletter(F.col("_all.entry"))}
    )
    # An entry that is lost on the way makes the whole record invalid.
    lost = (F.col("_status") == "ok") & F.exists("_lettered", lambda e: e.isNull())
    ok = F.col("status") == "ok"
    return lettered.withColumn("status", F.when(lost, "no_entry_id").otherwise(F.col("_status"))).select(
        "id",
        F.when(ok, name).alias("name"),
        "members",
        "status",
        F.when(ok, F.col("_lettered")).alias(field),
    )


def reletter_parsed(entries: Column) -> Column:
    """Parsed entries with the chain letter of their position."""
    return F.transform(
        entries,
        lambda e, i: F.struct(
            e["kind"].alias("kind"),
            F.array(chain_letter(i)).alias("chain_ids"),
            e["sequence"].alias("sequence"),
        ),
    )


#: The start of an entry's text up to its id, which is its body's first field.
_UP_TO_ID = r'^(\s*\{\s*"(?:[^"\\]|\\.)*"\s*:\s*\{\s*"id"\s*:\s*)'
_ID = r'("(?:[^"\\]|\\.)*"|\[[^\]]*\])'


def reletter_raw(entries: Column) -> Column:
    """Raw JSON entries with the chain letter of their position in place of their id.

    Only the id's text is replaced, all else stays as it is written. An entry whose body
    doesn't begin with an id is NULL.
    """

    def one(raw: Column, i: Column) -> Column:
        head = F.regexp_extract(raw, _UP_TO_ID + _ID, 1)
        found = F.regexp_extract(raw, _UP_TO_ID + _ID, 0)
        rest = F.substring(raw, F.length(found) + 1, F.length(raw))
        return F.when(F.length(found) > 0, F.concat(head, F.lit('"'), chain_letter(i), F.lit('"'), rest))

    return F.transform(entries, one)


def compose_positions(df: DataFrame, by: str, pos: str, name: str, size: str) -> DataFrame:
    """Compose rows already expanded to one per member: ``name``, ``chains`` and ``tokens``.

    Rows are reduced per position, positions are joined in runs of ``_RUN``, and runs to the
    whole: a group of any length brings together no more than the text that it becomes.
    Groups with a negative or repeated position have a status other than ``ok`` and no name;
    every group has its ``tokens``.
    """
    placed = df.groupBy(by, pos).agg(
        F.count("*").alias("_n"), F.min(name).alias("_name"), F.sum(size).alias("_size")
    )
    place, letter = F.col(pos), chain_letter(F.col(pos))
    runs = placed.groupBy(by, F.floor(place / _RUN).alias("_run")).agg(
        F.array_join(ordered(place, F.col("_name")), fixed.MEMBER_DELIMITER).alias("_names"),
        F.array_join(ordered(place, letter), ",").alias("_letters"),
        F.count_if(F.col("_name").isNotNull()).alias("_named"),
        F.sum("_size").alias("_size"),
        F.sum("_n").alias("_rows"),
        F.max("_n").alias("_copies"),
        F.min(pos).alias("_first"),
    )
    run = F.col("_run")
    grouped = runs.groupBy(by).agg(
        ordered(run, F.when(F.col("_named") > 0, F.col("_names"))).alias("_names"),
        ordered(run, F.col("_letters")).alias("_letters"),
        F.sum("_rows").alias("members"),
        F.sum("_size").cast("bigint").alias("tokens"),
        F.max("_copies").alias("_copies"),
        F.min("_first").alias("_first"),
    )
    status = (
        F.when(F.col("_first") < 0, "negative_position")
        .when(F.col("_copies") > 1, "repeated_position")
        .otherwise("ok")
    )
    ok = F.col("status") == "ok"
    return grouped.withColumn("status", status).select(
        by,
        "members",
        "status",
        F.when(ok, F.array_join("_names", fixed.MEMBER_DELIMITER)).alias("name"),
        F.when(ok, F.array_join("_letters", ",")).alias("chains"),
        "tokens",
    )


def total_size(
    keys: DataFrame,
    sizes: DataFrame,
    delimiter: str = fixed.MEMBER_DELIMITER,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Summed member ``tokens`` of every distinct key ``id``, from one lookup of ``(id, tokens)``."""
    hot = hot_keys(expanded(keys, "id", delimiter), ["member"], hot_rows)
    wide = salted_join(
        expanded(distinct_keys(keys, hot), "id", delimiter),
        sizes.withColumnRenamed("id", "member"),
        "member",
        ["id", "pos"],
        hot,
        hot_rows=hot_rows,
    )
    return summed(wide, ["id"], "tokens")


def summed(wide: DataFrame, by: list[str], size: str) -> DataFrame:
    """Per key: members, their total size and how many have no size."""
    return wide.groupBy(*by).agg(
        F.count("*").alias("members"),
        F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("tokens"),
        F.count_if(F.col(size).isNull()).alias("missing"),
    )
