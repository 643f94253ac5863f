"""A table of thresholds compiled into one projection of text ratios.

All of it is Spark's own expressions: row by row, no shuffle and no user function.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks between words, symbols that are counted, frequent words of four languages.
BLANKS = "[\\\\x20\\\\x09-\\\\x0D]+"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = """a an and are as at be by for from in is it of on or that the this to was with
au aux avec dans de des du elle en est et il la le les ne pas par pour que qui sur un une
als auf das dem den der des die ein eine für im in ist mit nicht sich und von zu
con como del el es las lo los no para por se su una y""".split()


class Rule(NamedTuple):
    """A metric stays between its bounds; None is no bound, and an undefined metric passes."""

    metric: str
    least: float | None
    most: float | None


#: A text with too few words, or mostly of repeated ones, fails whatever the other rules say.
BASE = [Rule("n_words", 50, None), Rule("repeat_percent", None, 50)]
RULES = [
    Rule("mean_word_length", 2, 12),
    Rule("symbols_per_word", None, 0.1),
    Rule("stop_word_share", 0.03, None),
    Rule("dup_line_share", None, 0.5),
]

_REPEATED = """
filter(_windows, (x, i) -> coalesce({before}, false) OR coalesce({after}, false))
"""
_SAME = """get(_windows, i {step} 1).hash = x.hash
  AND _words[get(_windows, i {step} 1).at] = _words[x.at]
  AND _words[get(_windows, i {step} 1).at + 1] = _words[x.at + 1]
  AND _words[get(_windows, i {step} 1).at + 2] = _words[x.at + 2]"""

METRICS = {
    "n_words": "n_words",
    "repeat_percent": "100 * n_repeat_words / nullif(n_words, 0)",
    "mean_word_length": "word_chars / nullif(n_words, 0)",
    "symbols_per_word": "n_symbols / nullif(n_words, 0)",
    "stop_word_share": "n_stop_words / nullif(n_words, 0)",
    "dup_line_share": "n_dup_lines / nullif(n_lines, 0)",
}


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of each whole text that the rules need.

    Words of a repeated window are found by sorting the windows' hashes with their places;
    neighbours of equal hash are compared word by word. A null text counts as having no
    words and all counts 0; repeated rows stay; columns named like a count are replaced.
    """
    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    kept = [c for c in df.columns if c not in COUNTS]
    named = [F.col(f"`{c}`").alias(f"_kept{i}") for i, c in enumerate(kept)]
    keys = [f"_kept{i}" for i in range(len(kept))]
    step = df.select(*named, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    step = step.select(
        *keys,
        "_text",
        F.expr(f"array_remove(split(_text, '{BLANKS}'), '')").alias("_words"),
        F.expr(f"filter(split(_text, '\\n'), x -> x RLIKE '[^{BLANKS[1:-2]}]')").alias("_lines"),
    )
    step = step.select(
        *keys, "_text", "_words", "_lines",
        F.expr(
            """CASE WHEN size(_words) < 3 THEN array() ELSE
            sort_array(transform(sequence(0, size(_words) - 3), i -> named_struct(
            'hash', xxhash64(_words[i], _words[i + 1], _words[i + 2]), 'at', i))) END"""
        ).alias("_windows"),
    )
    same = {k: _SAME.format(step=s) for k, s in (("before", "-"), ("after", "+"))}
    counts = {
        "n_words": "size(_words)",
        "word_chars": "length(array_join(_words, ''))",
        "n_symbols": f"length(_text) - length(translate(_text, '{SYMBOLS}', ''))",
        "n_lines": "size(_lines)",
        "n_dup_lines": "size(_lines) - size(array_distinct(_lines))",
        "n_repeat_words": "size(array_distinct(flatten(transform("
        + _REPEATED.format(**same)
        + ", x -> array(x.at, x.at + 1, x.at + 2)))))",
        "n_stop_words": f"size(filter(_words, x -> lower(x) IN ({stops})))",
    }
    # One row made by a generator: later filters can't be pushed below it, where the counts
    # would be computed again for each use.
    made = ", ".join(f"'{c}', CAST({counts[c]} AS BIGINT)" for c in COUNTS)
    step = step.select(*keys, F.expr(f"inline(array(named_struct({made})))"))
    return step.select(*[F.col(k).alias(c) for k, c in zip(keys, kept, strict=True)], *COUNTS)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words"]


def compiled(rules: list[Rule]) -> Column:
    """True where a row keeps all rules, never null."""
    kept = F.lit(True)
    for rule in rules:
        metric = F.expr(METRICS[rule.metric])
        if rule.least is not None:
            kept &= F.coalesce(metric >= rule.least, F.lit(True))
        if rule.most is not None:
            kept &= F.coalesce(metric <= rule.most, F.lit(True))
    return kept


def judged(
    df: DataFrame, text: str = "text", rules: list[Rule] = RULES, base: list[Rule] = BASE
) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``: neither the base nor a rule is broken."""
    got = measured(df, text).drop("base_failed", "kept")
    return got.withColumn("base_failed", ~compiled(base)).withColumn(
        "kept", ~F.col("base_failed") & compiled(rules)
    )


def kept_rows(df: DataFrame, rules: list[Rule] = RULES, base: list[Rule] = BASE) -> DataFrame:
    """The rows of ``df``, as they are, whose column ``text`` keeps all rules."""
    packed = df.select(F.struct("*").alias("_row"), F.col("text").alias("text"))
    return judged(packed, rules=rules, base=base).where("kept").select("_row.*")
