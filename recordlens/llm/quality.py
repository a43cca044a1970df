"""Line-first quality rules with built-in functions only.

Each line is judged by punctuation, navigation and boilerplate rules and failed
lines are removed; a document that loses too much of its text that way is
rejected.  All work is per row inside the scan's stage: no shuffle, no Python.

Nulls: a null text counts as empty.  Repeated rows keep their rows.  A document
without words fails the base rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rules:
    """Thresholds of the line and document rules."""

    min_words: int = 50                 # base: fewer words fail
    max_repeat_percent: int = 50        # base: share of words in repeated 3-word windows
    max_lost_percent: int = 50          # share of the characters in removed lines
    min_separators: int = 3             # navigation: separators of a menu line ...
    max_separator_percent: int = 20     # ... and their share of its words
    max_shout_percent: int = 30         # punctuation: words that end in ! or ?
    max_symbol_percent: int = 30        # punctuation: words that end in a symbol
    long_line_words: int = 20           # punctuation: shorter lines must end like a sentence
    boilerplate_words: int = 25         # boilerplate phrases condemn lines up to this length


#: Phrases of notices and navigation text (lower case).
BOILERPLATE = ("licensed under", "all rights reserved", "terms of use", "terms of service", "privacy policy",
               "cookie policy", "use of cookies", "enable javascript", "lorem ipsum", "sign up for our newsletter",
               "click here to", "general public license", "mit license", "copyright (c)")

#: Marks that end a sentence or clause: Latin, CJK, Arabic, Indic, Armenian, Ethiopic, Burmese, Khmer, Tibetan.
_END = r"[.!?…。！？:;؟۔؛।॥։።။។།][\"'”’»)\]]*[\x20\x09-\x0D]*$"
#: Thai and Lao write no marks at the end of a sentence.
_UNMARKED = r"[\u0E00-\u0EFF]"
_SEPARATOR = r"(?:^|[\x20\x09-\x0D])[|»›>•·](?:$|(?=[\x20\x09-\x0D]))"
_SHOUT = r"[!?][\"'”’»)\]]*(?:$|(?=[\x20\x09-\x0D]))"
_SYMBOL = r"[#*$%&|<>][.,;:!?]*(?:$|(?=[\x20\x09-\x0D]))"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _has_any(text: Column, characters: str) -> Column:
    found = text.contains(characters[0])
    for c in characters[1:]:
        found = found | text.contains(c)
    return found


def line_passes(line: Column, rules: Rules) -> Column:
    """Whether a line that has a word passes all line rules.

    Cheap byte searches come first: most lines need no regular expression.
    """
    n = F.size(words_of(line))

    def within(marks: str, pattern: str, percent: int, least: int = 0) -> Column:
        count = F.regexp_count(line, F.lit(pattern))
        return ~_has_any(line, marks) | F.exists(F.array(count), lambda k: (k < least) | (k * 100 <= n * percent))

    def has_phrase(low: Column) -> Column:
        found = low.contains(BOILERPLATE[0])
        for p in BOILERPLATE[1:]:
            found = found | low.contains(p)
        return found

    stops = line.endswith(".") | line.rlike(_END) | (n >= rules.long_line_words) | line.rlike(_UNMARKED)
    return (stops
            & within("!?", _SHOUT, rules.max_shout_percent)
            & within("#*$%&|<>", _SYMBOL, rules.max_symbol_percent)
            & within("|»›>•·", _SEPARATOR, rules.max_separator_percent, rules.min_separators)
            & ~(F.exists(F.array(F.lower(line)), has_phrase) & (n <= rules.boilerplate_words)))


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the array."""
    n = F.size(words)

    def covered(h: Column) -> Column:
        marked = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        twice = F.transform(F.array(marked), lambda s: F.filter(
            s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))[0]
        places = F.array_sort(F.transform(twice, lambda x: x["p"]))
        return F.transform(F.array(places), lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
            F.lit(0).cast("bigint"), lambda total, k: total + k))[0]

    # Windows are compared by their 64-bit hash.
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    return F.transform(F.array(hashes), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("bigint")))[0]


def quality(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per document: base counts, line verdicts, ``kept`` and the cleaned text.

    ``n_removed_lines`` counts the lines with a word that fail a line rule or
    repeat an earlier line, ``n_lost_chars`` their characters; ``clean_text`` is
    what is left.  ``kept`` is false if the base rule fails or the removed lines
    hold more than ``max_lost_percent`` of the characters.
    """
    src = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    split = src.select(
        "doc_id", "text", words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(HAS_WORD)).alias("lines"))
    lists = split.select("doc_id", "text", "words", "lines", F.array_distinct("lines").alias("once"))
    judged = lists.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size("once")).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.length(F.array_join("lines", "")).cast("bigint").alias("n_line_chars"),
        F.filter("once", lambda x: line_passes(x, rules)).alias("good"))
    # A repeated line is judged once; of the copies only the first can stay.
    counted = judged.select(
        *[c for c in judged.columns if c != "good"],
        (F.col("n_lines") - F.size("good")).cast("bigint").alias("n_removed_lines"),
        (F.col("n_line_chars") - F.length(F.array_join("good", ""))).cast("bigint").alias("n_lost_chars"),
        F.array_join("good", "\n").alias("clean_text"))
    failed = (F.col("n_words") < rules.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent)
    kept = ~failed & (F.col("n_lost_chars") * 100 <= F.col("n_line_chars") * rules.max_lost_percent)
    return counted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          failed.alias("base_failed"), kept.alias("kept"), "n_lines", "n_removed_lines",
                          "n_line_chars", "n_lost_chars", "clean_text")
