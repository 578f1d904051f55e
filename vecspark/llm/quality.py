"""Line-first quality rules, in DataFrame functions alone.

Every line of a text is judged first. A line fails when it is

* boilerplate: the table repeats it, or it is short and holds one of a list of phrases;
* navigation: at least three separators, one for every four words or more;
* punctuation: symbols make up a tenth of its characters, or doubled marks
  follow two words in five.

Failing lines are removed, and a document is rejected when what it keeps is
less than half of its characters. Before that come the base rules: fewer than
ten words, or over a fifth of the words in five-word windows that occur twice
or more in the text.

A line, by its letters alone, is repeated when it stands in one document of a
hundred (ten at least), and these have ten different numbers of lines or more.
Copies and near copies of a text have the same lines and as many of them, so
that a large group of them repeats none. At most 100 lines for each line of a
mean document can be repeated, which bounds what is sent to the tasks; documents
are counted by their rows, and a line once in each.

Null and empty texts have no words and fail the base rules; their cleaned text
is empty. Blank lines are never removed and count for nothing; lines without
letters are never repeated ones. Very long texts are judged whole. Copies and
rows with one id all stay, each judged by itself. Columns other than ``doc_id``
and ``text`` are ignored. An empty table gives none.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space, symbols, separators of menus, phrases of boilerplate lines.
SPACE = "[\\x20\\x09-\\x0D]"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
SEPARATORS = "[|>»•·]"
DOUBLED = "[!?*#$%&]{2,}"
PHRASES = (
    "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "enable javascript", "lorem ipsum", "click here", "sign up", "log in", "subscribe now", "share this", "read more",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_LETTERS = "".join(c for c in map(chr, range(1, 128)) if not c.isalpha() and c != "\n")
SHORT_LINE = 12                           # words up to which a phrase decides
WINDOW = 5
MIN_WORDS, MAX_REPEATED = 10, 20          # per cent
MIN_KEPT = 0.5
COMMON_SHARE, COMMON_LEAST = 100, 10      # one document of so many, so many at least


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def windows_of(hashes: Column) -> Column:
    """The hash of every run of WINDOW words."""
    return F.when(F.size(hashes) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - WINDOW),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)]))).otherwise(F.array().cast("array<long>"))


def _covered(places: Column) -> Column:
    """Words covered by windows that start at the given ascending places."""
    gaps = F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)


def _repeated(windows: Column) -> Column:
    """Words covered by windows whose hash occurs more than once, given all windows in order."""
    def places(marked: Column) -> Column:
        return F.array_sort(F.array_compact(F.transform(marked, lambda x, j: F.when(
            (x["h"] == F.get(marked, j + 1)["h"]) | (x["h"] == F.get(marked, j - 1)["h"]), x["i"]))))

    marked = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return bound(bound(marked, places), _covered)


def repeat_words(words: Column) -> Column:
    """Words in WINDOW-word windows found twice or more, first ones included."""
    def count(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(_repeated(windows))

    return bound(bound(F.transform(words, lambda w: F.xxhash64(w)), windows_of), count)


def _length(parts: Column) -> Column:
    return F.length(F.array_join(parts, "")).cast("long")


def line_letters(text: Column) -> Column:
    """The letters of each line, A-Z in lower case."""
    return F.split(F.translate(text, UPPER + NO_LETTERS, LOWER), "\n")


def common_lines(docs: DataFrame) -> list[int]:
    """Keys of the lines that the table repeats; see the module's docstring for their bound."""
    def sized(lines: Column) -> Column:
        keys = F.array_distinct(F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.xxhash64(x)))
        return F.transform(keys, lambda key: F.struct(key.alias("key"), F.size(lines).alias("size")))

    keys = docs.select(F.inline(bound(line_letters(F.coalesce("text", F.lit(""))), sized)))
    sizes = keys.groupBy("key", "size").agg(F.count("*").alias("n"))
    least = max(COMMON_LEAST, -(-docs.count() // COMMON_SHARE))
    found = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("sizes"))
    return [r["key"] for r in found.where((F.col("n") >= least) & (F.col("sizes") >= COMMON_LEAST)).select("key").collect()]


def line_fails(line: Column, phrases: tuple[str, ...] = PHRASES) -> Column:
    """Whether a line by itself is boilerplate, navigation or mostly punctuation."""
    size, words = F.length(line), F.size(F.split(F.trim(line), " +"))
    rules = [
        (F.regexp_count(line, F.lit(SEPARATORS)) >= 3) & (F.regexp_count(line, F.lit(SEPARATORS)) * 4 >= words),
        F.regexp_count(line, F.lit(SYMBOLS)) * 10 >= size,
        F.regexp_count(line, F.lit(DOUBLED)) * 5 >= words * 2,
    ]
    if phrases:
        rules.append((words <= SHORT_LINE) & F.lower(line).rlike(f"\\b({'|'.join(phrases)})\\b"))
    return reduce(or_, rules)


def judge(docs: DataFrame, min_kept: float = MIN_KEPT, phrases: tuple[str, ...] = PHRASES) -> DataFrame:
    """One row per document with the base counts, ``base_failed``, ``cleaned`` (text), ``kept_share`` and ``kept``."""
    common = common_lines(docs)
    text = F.coalesce("text", F.lit(""))
    cut = docs.select("doc_id", text.alias("text"))
    cut = cut.select("doc_id", "text", words_of(F.col("text")).alias("words"), F.split("text", "\n").alias("lines"))

    def duplicates(lines: Column) -> Column:
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")

    def blank(line: Column) -> Column:
        return F.btrim(line, F.lit(SPACES)) == ""

    def clean(lines: Column) -> Column:
        kept = lambda x: blank(x) | ~line_fails(x, phrases)
        if not common:
            return F.filter(lines, kept)
        repeated = lambda letters: F.xxhash64(letters).isin(common)
        return F.array_compact(F.zip_with(lines, line_letters(F.col("text")), lambda x, letters: F.when(kept(x) & (blank(x) | ~repeated(letters)), x)))

    counted = cut.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), _length(F.col("words")).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        bound(F.filter("lines", lambda x: ~blank(x)), duplicates).alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        _length(F.col("lines")).alias("chars"),
        clean(F.col("lines")).alias("clean"))
    counted = counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array_join("clean", "\n").alias("cleaned"),
        (_length(F.col("clean")) / F.greatest("chars", F.lit(1))).alias("kept_share"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("kept_share") >= min_kept))
