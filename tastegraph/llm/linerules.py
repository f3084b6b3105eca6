"""Quality rules, line first: bad lines go, then documents that lost too much go.

Each line that holds a word is judged by itself by three rules:

* punctuation: a line is prose if it ends in a sentence mark or has one in every ``words_per_mark`` words; a line of some
  length in which every second word carries a mark is shouting or dotted leaders, not prose;
* navigation: separators and symbols for a good part of its words, as in menus, tables and tag clouds;
* boilerplate: a short line with a stock phrase of licences, notices and page furniture.

Lines that fail a rule are removed. A document is rejected if its words are too few or repeat themselves (both judged on
the text as it came), or if the removed lines held more than ``most_lost`` per cent of its word characters.

All of it is one pass of Spark functions over each row: no shuffle, no Python. Repeated five-word windows are found by
sorting window hashes with their positions inside the row and comparing the windows behind equal hashes word by word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words, symbols that are counted, words in a window.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Sentence marks, closing marks that may follow them, and separators of menus beside the counted symbols.
MARKS, CLOSING, SEPARATORS = ".!?…。", "\"')\\]»”’", "»›•·→"
#: Stock phrases, in any case.
PHRASES = [
    "all rights reserved", "licensed under", "released under the", "terms of (?:use|service)", "privacy policy",
    "cookie policy", "uses? cookies", "enable javascript", "lorem ipsum", "copyright (?:\\(c\\)|©|[0-9]{4})",
    "click here", "read more", "sign up", "log in", "subscribe to", "share (?:this|on)", "follow us", "back to top",
    "skip to (?:main )?content", "powered by",
]


@dataclass(frozen=True)
class Rules:
    """Limits of the rules."""

    words_per_mark: int = 60  # fewer marks than one in so many words, and none at the end: no prose
    shouting_words: int = 8  # from so many words on, marks for more than half of them are too many
    words_per_separator: int = 4  # a separator for every so many words: navigation
    boilerplate_words: int = 30  # a stock phrase counts in lines of up to so many words
    most_lost: int = 50  # per cent of the word characters that may go with the lines
    least_words: int = 10
    most_repeated: int = 20  # per cent of the words that may lie in repeated windows


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def _word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, SPACE + "+", ""))


def _count(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def line_verdict(line: Column, rules: Rules) -> Column:
    """The first rule that the line fails, or null."""
    n = F.size(_words(line))
    marks, separators = _count(line, MARKS), _count(line, SYMBOLS + SEPARATORS)
    ends = line.rlike(f"[{MARKS}][{CLOSING}]*{SPACE}*\\z")
    return (
        F.when((separators >= 2) & (separators * rules.words_per_separator >= n), "navigation")
        .when(~ends & (marks * rules.words_per_mark < n), "punctuation")
        .when((n >= rules.shouting_words) & (marks * 2 > n), "punctuation")
        .when((n <= rules.boilerplate_words) & line.rlike("(?iu)" + "|".join(PHRASES)), "boilerplate")
    )


def _neighbour_equal(rows: Column, field: str):
    """Whether an entry of a sorted array of structs equals the one before or after it in one field."""
    return lambda entry, i: F.coalesce(F.get(rows, i - 1)[field] == entry[field], F.lit(False)) | F.coalesce(
        F.get(rows, i + 1)[field] == entry[field], F.lit(False))


def _fallen(rule: str) -> Column:
    return F.size(F.filter("_judged", lambda x: x["failed"] == rule)).cast("long")


def judged(docs: DataFrame, rules: Rules | None = None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in a struct ``row`` and, beside it, what the rules found:

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long); n_lines, the lines with a word; n_punctuation,
    n_navigation and n_boilerplate, those that fell by each rule; kept_chars, the word characters of the other lines;
    clean_text, these lines joined by a line feed; base_failed; kept.

    A null or empty text has no words, so it fails; its clean_text is empty. Repeated rows are judged alike, each by itself.
    """
    rules = rules or Rules()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(row, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"))
    base = base.select(
        "row", "_text", _words(F.col("_text")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{SPACE[1:]}")).alias("_lines"),
    )
    # windows of equal hash, then windows of equal words; where a window is repeated, all its words count
    last = F.size("_words") - WINDOW
    hashed = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)]))
    base = base.withColumn("_hashes", F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform("_hashes", lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
    base = base.withColumn("_placed", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), placed))
    alike = F.filter("_placed", _neighbour_equal(F.col("_placed"), "hash"))
    base = base.withColumn("_alike", F.sort_array(F.transform(
        alike, lambda x: F.struct(F.array_join(F.slice("_words", x["at"] + 1, WINDOW), " ").alias("window"), x["at"].alias("at")))))
    starts = F.sort_array(F.filter("_alike", _neighbour_equal(F.col("_alike"), "window")).getField("at"))
    covered = F.aggregate(
        F.coalesce(starts, F.array().cast("array<int>")), F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last")),
        lambda held, at: F.struct((held["total"] + F.least(F.lit(WINDOW), at - held["last"])).alias("total"), at.alias("last")),
        lambda held: held["total"])
    lines = F.transform("_lines", lambda x: F.struct(x.alias("line"), line_verdict(x, rules).alias("failed")))
    base = base.select("row", "_text", "_words", "_lines", covered.alias("_repeated"), lines.alias("_judged"))
    base = base.withColumn(
        "clean_text", F.array_join(F.transform(F.filter("_judged", lambda x: x["failed"].isNull()), lambda x: x["line"]), "\n"))
    found = base.select(
        "row",
        F.size("_words").cast("long").alias("n_words"),
        _word_chars(F.col("_text")).cast("long").alias("word_chars"),
        _count(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeated").cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        *[_fallen(rule).alias(f"n_{rule}") for rule in ("punctuation", "navigation", "boilerplate")],
        _word_chars(F.col("clean_text")).cast("long").alias("kept_chars"),
        "clean_text",
    )
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.most_repeated * F.col("n_words"))
    enough = 100 * F.col("kept_chars") >= (100 - rules.most_lost) * F.col("word_chars")
    found = found.withColumns({"base_failed": failed, "kept": ~failed & enough})
    # through a generator of one row: a filter on the verdict is not pushed below it, where it would repeat all expressions
    return found.select("row", F.inline(F.array(F.struct(*found.columns[1:]))))


def cleaned(docs: DataFrame, rules: Rules | None = None, text: str = "text") -> DataFrame:
    """The documents that stay, with their failing lines removed; columns as in ``docs``."""
    found = judged(docs, rules, text).where("kept")
    return found.select(*[F.col("clean_text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def digests(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """(doc_id, the counts, base_failed, kept, clean_sha256) for each row of (doc_id, text)."""
    found = judged(docs.select("doc_id", "text"), rules)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_punctuation", "n_navigation", "n_boilerplate", "kept_chars", F.sha2(F.col("clean_text").cast("binary"), 256).alias("clean_sha256"))
