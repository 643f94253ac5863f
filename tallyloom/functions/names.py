"""Identifiers, labels and the paths derived from them."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom import fixed


def jobname(raw: Column) -> Column:
    """Lower-case name of letters, numerics and ``-._``; never holds an underscore."""
    trimmed = F.btrim(raw, F.lit(fixed.WHITE_SPACE))
    dashed = F.translate(F.lower(trimmed), " _", "--")
    return F.regexp_replace(dashed, r"[^\p{IsLowercase}\p{N}._-]", "")


def accession_header(line: Column) -> Column:
    """Headers shrink to their second ``|`` field; other lines stay as they are."""
    field = F.coalesce(F.get(F.split(line, r"\|"), F.lit(1)), F.lit(""))
    return F.when(line.startswith(">"), F.concat(F.lit(">"), field)).otherwise(line)


def filled(pattern: str, id_: Column) -> Column:
    """``pattern`` with every ``{id}`` replaced by the id column."""
    parts: list[Column] = []
    for i, text in enumerate(pattern.split("{id}")):
        if i:
            parts.append(id_.cast("string"))
        if text:
            parts.append(F.lit(text))
    return F.concat(*parts)


def without_prefix(col: Column, prefix: str) -> Column:
    """Strip a fixed prefix where it is present."""
    return F.when(col.startswith(prefix), F.substr(col, F.lit(len(prefix) + 1))).otherwise(col)


def record_name(path: Column) -> Column:
    """Last path component without its last extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def id_is_valid(id_: Column) -> Column:
    return id_.rlike(fixed.ID_PATTERN)


def chain_letter(position: Column) -> Column:
    """Letters of a 0-based member position: B to Z, then AA, AB and so on; NULL if negative.

    Six letters are enough for 300 million members.
    """
    rest = position.cast("bigint") + F.lit(ord(fixed.FIRST_COMPOSED_LETTER) - ord("A") + 1)
    letters = []
    for _ in range(6):
        letters.insert(0, F.when(rest > 0, F.chr(F.lit(ord("A")) + (rest - 1) % 26)).otherwise(""))
        rest = F.floor((rest - 1) / 26)
    return F.when(position >= 0, F.concat(*letters))


def batch_label(batch_id: Column, rows: Column, prefix: str = "predictions") -> Column:
    return F.format_string(f"{prefix}_batch%d_%d", batch_id, rows)


def path_regex(pattern: str) -> str:
    """Regex of a path pattern: the first hole captures, later holes must repeat it.

    ``*`` stands for any characters of one path component.
    """
    first, *rest = [re.escape(p).replace(r"\*", "[^/]*") for p in pattern.split("{id}")]
    if not rest:
        raise ValueError("pattern needs an {id} hole")
    return "(?U)" + first + r"([\w.-]*)" + r"\1".join(rest) + "$"
