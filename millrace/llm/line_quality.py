"""Quality rules, line first: judge every line, drop the lines that fail, reject documents that lose too much.

Only DataFrame expressions; one narrow stage, no shuffle, so one hot source or key cannot skew it.

Defined results. Null text counts as empty. An empty text has no words, so base_failed is true and kept
false; its cleaned text is empty. Repeated rows are judged each for itself. Very long texts are processed
whole. An empty table gives no row. Extra columns of the input stay unless a new column has the same name (any case); then the new one wins.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, words

# Characters counted as symbols, punctuation of sentences, separators of menu lines, signs of either.
SYMBOLS = "#*$%&|<>"
PAUSE = ".!?…。！？:;,"
SEPARATOR = r"[|»›•→]|>{1,2}|::"
ODD = r"[#*$%&|<>»›•→]|[!?:]{2}"
# Phrases of boilerplate lines.
BOILERPLATE = (
    "all rights reserved",
    "cookie",
    "privacy policy",
    "terms of use",
    "terms of service",
    "javascript",
    "subscribe to our",
    "sign up for",
    "log in",
    "sign in",
    "click here",
    "read more",
    "share this",
    "lorem ipsum",
    "powered by",
)

NEW_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text", "lost_chars")


def _line_fails(
    line: Column,
    has_odd: Column,
    has_phrase: Column,
    max_symbol_share: float,
    max_bangs_share: float,
    min_separators: int,
    boilerplate_words: int,
    min_line_words: int,
) -> Column:
    """True for a line with a word that breaks a punctuation, navigation or boilerplate rule.

    Cheap tests stand first: a line of plain prose costs two short regex scans and no word split.
    has_odd, has_phrase: whether any such sign or boilerplate phrase stands in the whole text, tested once
    per document.
    """
    n = F.size(words(line))
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    symbols = count(f"[{SYMBOLS}]") > max_symbol_share * n
    bangs = count("[!?]{2,}") > max_bangs_share * n
    navigation = (count(SEPARATOR) >= min_separators) & (n < 6 * count(SEPARATOR))
    bare = ~line.rlike(f"[{PAUSE}]") & (F.length(line) > 12 * n) & (n >= min_line_words)
    boilerplate = has_phrase & F.lower(line).rlike("|".join(BOILERPLATE)) & (n <= boilerplate_words)
    return (has_odd & (symbols | bangs | navigation)) | bare | boilerplate


def clean_lines(
    df: DataFrame,
    text: str = "text",
    *,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_lost: float = 0.5,
    max_symbol_share: float = 0.25,
    max_bangs_share: float = 0.25,
    min_separators: int = 3,
    boilerplate_words: int = 20,
    min_line_words: int = 8,
) -> DataFrame:
    """Add counts, base_failed, the cleaned text, the characters it lost and the verdict kept.

    Words are runs of non-white-space characters. n_repeat_words counts the words inside three-word
    windows found at least twice in the text, n_dup_lines the lines with a word that equal an earlier line.
    base_failed: fewer than min_words words, or more than max_repeat_percent of them repeated. A line that
    fails a rule goes, and so does a repeat of an earlier line; kept is false if base_failed, or if more than
    max_lost of the characters in lines with words went.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = df.drop(*[c for c in df.columns if c.lower() in NEW_COLUMNS])
    held = base.withColumns({"_line_quality_words": words(body), "_line_quality_lines": F.split(body, "\n"), "_line_quality_low": F.lower(body)})
    # The last two words start no full window; their shorter keys equal no other key of the text.
    triples = F.transform(
        F.col("_line_quality_words"),
        lambda w, i: F.struct(F.xxhash64(w, F.get("_line_quality_words", i + 1), F.get("_line_quality_words", i + 2)).alias("h"), i.alias("p")),
    )
    held = held.withColumns(
        {
            "_line_quality_triples": F.sort_array(triples),
            "_line_quality_full": F.filter("_line_quality_lines", lambda x: x.rlike(f"[^{SPACE}]")),
            "_line_quality_odd": body.rlike(ODD),
            "_line_quality_phrase": reduce(or_, [F.contains(F.col("_line_quality_low"), F.lit(x)) for x in BOILERPLATE]),
        }
    )
    neighbour = lambda i: F.get("_line_quality_triples", i)["h"]
    held = held.withColumns(
        {
            "_line_quality_starts": F.sort_array(
                F.transform(
                    F.filter(
                        "_line_quality_triples",
                        lambda t, i: F.coalesce(neighbour(i + 1) == t["h"], F.lit(False))
                        | ((i > 0) & F.coalesce(neighbour(i - 1) == t["h"], F.lit(False))),
                    ),
                    lambda t: t["p"],
                )
            ),
            "_line_quality_distinct": F.array_distinct("_line_quality_full"),
        }
    )
    fails = lambda x: _line_fails(
        x, F.col("_line_quality_odd"), F.col("_line_quality_phrase"), max_symbol_share, max_bangs_share, min_separators, boilerplate_words, min_line_words
    )
    held = held.withColumns({"_line_quality_good": F.filter("_line_quality_distinct", lambda x: ~fails(x))})
    n = F.size("_line_quality_words").cast("long")
    counted = held.withColumns(
        {
            "n_words": n,
            "word_chars": F.length(F.array_join("_line_quality_words", "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).cast("long"),
            "n_dup_lines": (F.size("_line_quality_full") - F.size("_line_quality_distinct")).cast("long"),
            "n_repeat_words": F.aggregate(
                F.transform("_line_quality_starts", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_line_quality_starts", i + 1) - p, F.lit(3)))),
                F.lit(0).cast("long"),
                lambda acc, x: acc + x,
            ),
            "clean_text": F.array_join("_line_quality_good", "\n"),
            "lost_chars": (F.length(F.array_join("_line_quality_full", "")) - F.length(F.array_join("_line_quality_good", ""))).cast("long"),
            "_line_quality_all_chars": F.length(F.array_join("_line_quality_full", "")),
        }
    )
    judged = counted.withColumn(
        "base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    ).withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") <= max_lost * F.col("_line_quality_all_chars")))
    return judged.select(*base.columns, *NEW_COLUMNS)


def passing(df: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of clean_lines() that are kept.

    The row number in the filter keeps the optimizer from copying the verdict's whole expression below it, where it
    would be computed again for every step that it is made of.
    """
    judged = clean_lines(df, text, **how).withColumn("_line_quality_row", F.monotonically_increasing_id())
    return judged.where("kept and _line_quality_row >= 0").drop("_line_quality_row")
