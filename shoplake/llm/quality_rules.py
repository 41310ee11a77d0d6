"""Quality rules, line first: judge lines, drop the failing ones, reject documents that lose too much.

Each line with at least one word is checked by three rules:

* punctuation: at most ``NOISY_SHARE`` of its words end in a run of three or more symbols or in ``!!``
  (a line without a final stop passes);
* navigation: ``|``, ``>``, bullets or similar separators standing alone after its first word make up more than
  ``SEPARATOR_SHARE`` of its words, and there are two of them or a bar or guillemet is among them (a list item's bullet
  or one dash is none);
* boilerplate: phrases of page furniture (cookie notices, script warnings, placeholder text) make up at least
  ``FURNITURE_SHARE`` of its words, or it repeats an earlier line of the document.

Failing lines are removed.  A document is kept when it passes the base rule
(at least 20 words; at most 30 % of its words in 8-word windows that occur
twice) and its remaining lines hold at least ``keep_share`` of its characters.

Everything is one narrow map over the documents in DataFrame functions: no
shuffle, so no key can be hot, and a row needs memory in proportion to its own
text only.

Edge cases: null text counts as empty (0 words, base rule fails); rows are
judged one by one, so ties and repeated rows get equal results; extra columns
are ignored by ``quality_signals`` and passed through by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_of, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
NOISY_SHARE = 0.3
SEPARATOR_SHARE = 0.15
FURNITURE_SHARE = 0.25
KEEP_SHARE = 0.5
# FIXED VALUES: phrases of page furniture, lower case
BOILERPLATE = ("enable javascript", "javascript is disabled", "lorem ipsum", "we use cookies", "cookie policy",
               "accept all cookies", "terms of use", "terms of service", "all rights reserved",
               "skip to content", "click here to subscribe", "sign up for our newsletter")
# FIXED VALUES: how placeholder text goes on
PLACEHOLDER = ("dolor sit amet", "consectetur adipiscing elit", "sed do eiusmod tempor", "incididunt ut labore et dolore")


def _dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _window_hashes(words: Column, window: int = WINDOW) -> Column:
    """One hash per ``window``-word window, in text order; null when the text is shorter."""
    n = F.size(words)
    return F.when(n >= window, F.transform(F.sequence(F.lit(1), n - (window - 1)),
                                           lambda i: F.xxhash64(F.slice(words, i, window))))


def _covered(hashes: Column, window: int) -> Column:
    """Number of words in windows that occur twice or more.

    Window hashes sorted with their positions put equal windows side by side.
    The caller does this only for documents that have an equal pair, that is
    fewer distinct hashes than windows.
    """
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twins(order: Column) -> Column:
        def equals(k: Column, x: Column) -> Column:
            return F.coalesce(F.get(order, k)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(order, lambda x, k: equals(k - 1, x) | equals(k + 1, x)),
                                        lambda x: x["i"]))
    return _union_length(let(pairs, twins), window)


def _union_length(starts: Column, window: int) -> Column:
    """Length of the union of [s, s + window) over sorted starts."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last"))
    return F.aggregate(starts, zero, lambda a, s: F.struct(
        (a["n"] + F.least(F.lit(window), s - a["last"])).alias("n"), s.alias("last")),
        lambda a: a["n"])


def _first_copies(lines: Column) -> Column:
    """The lines without those equal to an earlier one, in text order; sorting puts copies side by side."""
    pairs = F.sort_array(F.transform(lines, lambda x, i: F.struct(x.alias("line"), i.alias("i"))))

    def firsts(order: Column) -> Column:
        return F.sort_array(F.transform(
            F.filter(order, lambda p, k: F.coalesce(F.get(order, k - 1)["line"] != p["line"], F.lit(True))),
            lambda p: F.struct(p["i"].alias("i"), p["line"].alias("line"))))
    return F.transform(let(pairs, firsts), lambda p: p["line"])


def _line_fails(line: Column) -> Column:
    words = words_of(line)
    n = F.size(words)
    noisy = F.size(F.filter(words, lambda w: w.rlike(r"(?:[#*$%&|<>]{3,}|!!+)$")))
    inner = F.filter(words, lambda w, i: (i > 0) & w.rlike(r"^[|<>»›·•/\\\-]+$"))
    bars = let(inner, lambda b: (F.size(b) > n * F.lit(SEPARATOR_SHARE)) & (
        (F.size(b) > 1) | F.exists(b, lambda w: w.rlike("[|»›]"))))
    phrases = "|".join(BOILERPLATE + PLACEHOLDER)
    phrase_words = F.size(F.split(F.array_join(F.regexp_extract_all(F.lower(line), F.lit(phrases), F.lit(0)), " "), " "))
    furniture = F.when(F.lower(line).rlike(phrases), phrase_words >= n * F.lit(FURNITURE_SHARE)).otherwise(F.lit(False))
    return (noisy > n * F.lit(NOISY_SHARE)) | bars | furniture


def quality_signals(docs: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Per document: counts, base verdict, cleaned text and final verdict.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lines, n_lines_removed, clean_text.
    """
    return _signals(docs.select("doc_id", text_of("text").alias("text")), keep_share)


def _signals(rows: DataFrame, keep_share: float, also: tuple = ()) -> DataFrame:
    text = F.col("text")
    a = rows.withColumn("words", words_of(text)).withColumn(
        "lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    b = (a.withColumn("hashes", _window_hashes(F.col("words")))
         .withColumn("n_dup_lines", _dup_lines(F.col("lines"))))
    # only documents with a repeated line sort their lines
    once = F.when(F.col("n_dup_lines") > 0, _first_copies(F.col("lines"))).otherwise(F.col("lines"))
    c = b.withColumn("once", once).withColumn("good", F.filter("once", lambda x: ~_line_fails(x)))
    d = (c.withColumn("n_words", F.size("words").cast("long"))
         .withColumn("word_chars", F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long"))
         .withColumn("n_symbols", F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"))
         .withColumn("n_repeat_words", F.when(
             F.size(F.array_distinct("hashes")) < F.size("hashes"),
             _covered(F.col("hashes"), WINDOW)).otherwise(F.lit(0).cast("long"))))
    e = (d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                      | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
         .withColumn("clean_text", F.concat_ws("\n", "good"))
         .withColumn("kept_chars", F.aggregate("good", F.lit(0), lambda s, x: s + F.length(x)))
         .withColumn("line_chars", F.aggregate("lines", F.lit(0), lambda s, x: s + F.length(x))))
    kept = ~F.col("base_failed") & (F.col("kept_chars") >= F.col("line_chars") * F.lit(keep_share))
    return e.select(
        "doc_id", *also, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("good")).cast("long").alias("n_lines_removed"), "clean_text")


def clean(docs: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """The kept documents with all their columns; ``text`` holds the remaining lines, ``n_chars`` their length."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = _signals(docs.select("doc_id", text_of("text").alias("text"), row), keep_share, also=("_row",))
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    out = F.struct(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
    # a generator over no or one row: a filter would be pushed down with copies of every expression above the scan
    return judged.select(F.inline(F.when(F.col("kept"), F.array(out))))
