"""Line-first quality rules, in built-in functions only.

Each line is judged alone by punctuation, navigation and boilerplate rules; failing lines go,
and a document that loses too much of its text that way is rejected. Base rules on words and
repetition come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shredloom.llm.common import BLANK, NOT_BLANK, numbered, without

# Fixed values of the rules.
SYMBOLS = r"[#*$%&|<>]"
SHOUT = r"[!?]{2,}"
SEPARATORS = ("|", "»", "›", "•", "·")
ENDS = r"[.!?…。:;,\"'”’)\]]\s*$"
BOILERPLATE = (r"(?i)(enable javascript|accept (all )?cookies|cookie policy|privacy policy"
               r"|terms of (use|service)|lorem ipsum|subscribe to our newsletter"
               r"|click here to|skip to (main )?content|page not found)")

ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
         "kept", "clean_text")

MIN_WORDS = 50
MAX_REPEATED = 50       # percent of words inside repeated windows
MAX_SYMBOL_SHARE = 0.15  # of the characters of a line
MAX_SHOUT_SHARE = 0.3    # runs of exclamation marks for each word of a line
MIN_SEPARATORS = 3
MAX_SEPARATOR_SHARE = 0.2
MIN_OPEN_WORDS = 3       # a line without an end mark needs so many words
MAX_BOILERPLATE_WORDS = 25
MIN_KEPT_SHARE = 0.5     # of the characters of all lines with a word


def count_of(line: Column, pattern: str) -> Column:
    return F.size(F.split(line, pattern)) - 1


def good_line(line: Column) -> Column:
    """Whether a line passes the punctuation, navigation and boilerplate rules."""
    tokens = F.array_remove(F.split(line, BLANK), "")
    n_words = F.size(tokens)
    punctuation = (
        (count_of(line, SYMBOLS) > F.lit(MAX_SYMBOL_SHARE) * F.length(line))
        | (count_of(line, SHOUT) > F.lit(MAX_SHOUT_SHARE) * n_words)
        | (~line.rlike(ENDS) & (n_words < MIN_OPEN_WORDS)))
    separators = F.size(F.filter(tokens, lambda token: token.isin(*SEPARATORS)))
    navigation = ((separators >= MIN_SEPARATORS)
                  & (separators > F.lit(MAX_SEPARATOR_SHARE) * n_words))
    boilerplate = line.rlike(BOILERPLATE) & (n_words <= MAX_BOILERPLATE_WORDS)
    return ~(punctuation | navigation | boilerplate)


def covered_words(positions: Column) -> Column:
    """Words covered by 3-word windows that start at these ascending positions."""
    following = F.concat(F.slice(positions, 2, F.greatest(F.size(positions), F.lit(1))),
                         F.array(F.element_at(positions, -1) + 3))
    gaps = F.zip_with(positions, following, lambda a, b: F.least(b - a, F.lit(3)))
    return F.when(F.size(positions) == 0, F.lit(0)).otherwise(
        F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap))


def quality_rules(docs: DataFrame, text: str = "text",
                  min_kept_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """Adds the measures, `base_failed`, `kept` and `clean_text` (the lines that passed).

    Null and empty texts have no words and are rejected. A line without a word is neither
    judged nor counted as lost; it stays in `clean_text`. Repeated rows are judged each on its
    own. Columns of the input with the names added here are replaced.

    Store the result, or pass it through a generator, before filtering by what is added: Spark
    moves a filter below the measures and then computes them again inside each other.
    """
    docs = without(docs, ADDED)
    columns, names = docs.columns, numbered(docs)
    docs, text = docs.toDF(*names.values()), names[text]
    pieces, lines = "_q_pieces", "_q_lines"
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.withColumns({
        pieces: F.split(body, BLANK), lines: F.split(body, "\n"), "_q_chars": F.length(body),
    }).withColumns({
        "_q_words": F.array_remove(F.col(pieces), ""),
        # Each split point is one white space character; all others are in words.
        "word_chars": (F.col("_q_chars") - F.size(pieces) + 1).cast("long"),
        "n_symbols": count_of(body, SYMBOLS).cast("long"),
        "_q_full": F.filter(lines, lambda line: line.rlike(NOT_BLANK)),
    })
    window_hash = F.transform(
        F.slice("_q_words", 1, F.greatest(F.size("_q_words") - 2, F.lit(0))),
        lambda word, i: F.struct(
            F.xxhash64(word, F.get("_q_words", i + 1), F.get("_q_words", i + 2)).alias("h"),
            i.alias("at")))
    sorted_windows = base.withColumn("_q_windows", F.sort_array(window_hash))
    # Windows equal to their neighbour in hash order occur twice or more.
    equal_next = F.zip_with(
        F.slice("_q_windows", 1, F.greatest(F.size("_q_windows") - 1, F.lit(0))),
        F.slice("_q_windows", 2, F.greatest(F.size("_q_windows") - 1, F.lit(0))),
        lambda a, b: a["h"] == b["h"])
    flagged = sorted_windows.withColumn("_q_equal", equal_next)
    repeated = F.zip_with(
        F.col("_q_windows"),
        F.zip_with(F.concat(F.array(F.lit(False)), F.col("_q_equal")),
                   F.concat(F.col("_q_equal"), F.array(F.lit(False))), lambda a, b: a | b),
        lambda window, twice: F.when(twice, window["at"]))
    placed = flagged.withColumn("_q_places", F.when(
        F.exists("_q_equal", lambda x: x), F.sort_array(F.array_compact(repeated))
    ).otherwise(F.array().cast("array<int>")))
    n_words = F.size("_q_words").cast("long")
    full_chars = F.aggregate("_q_full", F.lit(0), lambda t, line: t + F.length(line))
    kept_chars = F.aggregate(F.filter("_q_full", good_line), F.lit(0),
                             lambda t, line: t + F.length(line))
    measured = placed.withColumns({
        "n_words": n_words,
        "n_dup_lines": (F.size("_q_full") - F.size(F.array_distinct("_q_full"))).cast("long"),
        "n_repeat_words": covered_words(F.col("_q_places")).cast("long"),
    }).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    judged = measured.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(
        kept_chars >= F.lit(min_kept_share) * full_chars))
    clean = F.array_join(F.filter(
        lines, lambda line: ~line.rlike(NOT_BLANK) | good_line(line)), "\n")
    return judged.withColumn(
        "clean_text", F.when(F.col("kept"), clean)
    ).select(*docs.columns, *ADDED).toDF(*columns, *ADDED)
