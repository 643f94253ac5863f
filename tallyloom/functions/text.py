"""Line predicates, log captures and display formats."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom import fixed


def is_residue_line(line: Column) -> Column:
    """Neither a digit nor ``>`` anywhere."""
    return ~line.rlike("[0-9>]")


def has_marker(line: Column, marker: str = fixed.WALL_CLOCK_MARKER) -> Column:
    return line.contains(marker)


def _captured(line: Column, pattern: str) -> Column:
    """The pattern's group, NULL without a match: casting an empty text is slow."""
    return F.nullif(F.regexp_extract(line, pattern, 1), F.lit(""))


def log_captures(line: Column) -> dict[str, Column]:
    """The three values a job log line may carry, NULL where it does not."""
    return {
        "n_tokens": _captured(line, fixed.LOG_SIZE).try_cast("bigint"),
        "runtime_sec": _captured(line, fixed.LOG_RUNTIME).try_cast("double"),
        "done_processing": _captured(line, fixed.LOG_DONE),
    }


def may_capture(line: Column) -> Column:
    """True for every line with a capture and few others; far cheaper than the patterns."""
    found = [line.contains(words) for words in fixed.LOG_WORDS]
    return found[0] | found[1] | found[2]


def lines_of(text: Column) -> Column:
    """A text as an array of lines."""
    return F.split(text, "\n")


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def percent(share: Column) -> Column:
    """A share of 1 as ``(12.34%)``; NULL stays NULL."""
    return F.when(share.isNotNull(), F.format_string("(%.2f%%)", share * 100))
