"""Line-first quality rules: lines that fail go, then documents that lose too much text go. Built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import BLANKS, WORD, let, word_count, words_of

SYMBOLS = "#*$%&|<>"
# Phrases of page furniture, lower case; fixed values.
BOILERPLATE = ("all rights reserved", "accept cookies", "cookie policy", "enable javascript", "click here", "read more", "sign in",
               "log in to", "terms of use", "terms of service", "privacy policy", "subscribe to our", "share this", "lorem ipsum", "back to top")


@dataclass(frozen=True)
class LineRules:
    """What a line must hold to and how much of a document must be left."""

    endings: str = r"[.!?:;…。！？][\"'”’»)\]*]*$"   # a line of prose ends in one of these
    unended_words: int = 10                         # a line this long is prose, even if it is cut before its end
    separators: str = r"(?:^|\s)[|»›•·>/](?=\s|$)"  # between the items of a menu
    most_separators: int = 1
    symbols_per_word: float = 0.3
    least_kept_words: float = 0.7                   # share of the words that the kept lines must hold


def symbol_count(text: Column) -> Column:
    """Characters of ``SYMBOLS``; most texts have none and are only scanned."""
    return F.when(text.rlike(f"[{SYMBOLS}]"), F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).otherwise(F.lit(0)).cast("bigint")


def judged_line(line: Column, rules: LineRules) -> Column:
    """The line, its words, and whether it fails: navigation, symbols, shouting, page furniture, or no end of a sentence.
    Blank lines pass."""
    def judged(bare: Column) -> Column:
        n = word_count(bare)
        furniture = let(F.lower(bare), lambda low: F.exists(F.array(*[F.lit(x) for x in BOILERPLATE]), lambda x: F.contains(low, x)))

        def failed(n: Column) -> Column:
            return (bare != "") & (
                ((n < rules.unended_words) & ~F.substring(bare, -12, 12).rlike(rules.endings))
                | (symbol_count(bare) > rules.symbols_per_word * n)
                | ((n >= 3) & ~bare.rlike(r"\p{Ll}") & bare.rlike(r"\p{Lu}"))
                | (bare.rlike(rules.separators) & (F.regexp_count(bare, F.lit(rules.separators)) > rules.most_separators))
                | furniture)
        return let(n, lambda n: F.struct(line.alias("line"), n.alias("n"), failed(n).alias("bad")))
    return let(F.btrim(line, F.lit(BLANKS)), judged)


def repeat_words(words: Column) -> Column:
    """Words in windows of three words that occur twice or more. Windows are compared by hashes inside one text; only texts
    in which a hash occurs twice sort theirs."""
    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            twin = lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])
            return F.sort_array(F.filter(F.transform(s, lambda x, k: F.when(twin(x, k), x["i"])), lambda p: p.isNotNull()))

        def length(p: Column) -> Column:
            gaps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
            return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda n, g: n + g)
        return let(let(ordered, positions), length)

    def windows(w: Column) -> Column:
        n = F.greatest(F.size(w) - 2, F.lit(0))
        pairs = F.zip_with(w, F.slice(w, F.lit(2), F.greatest(F.size(w), F.lit(1))), lambda a, b: F.xxhash64(a, b))
        return F.slice(F.zip_with(pairs, F.slice(w, F.lit(3), F.greatest(F.size(w), F.lit(1))), lambda a, b: F.xxhash64(a, b)), F.lit(1), n)

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(hashes)).otherwise(F.lit(0).cast("bigint"))
    return let(let(words, windows), counted)


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed. A null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    n_words, n_repeat = F.col("n_words"), F.col("n_repeat_words")
    per_text = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n"), F.length(F.array_join(w, "")).cast("bigint").alias("c"), repeat_words(w).alias("r")))
    return (docs.withColumn("_w", per_text)
            .withColumns({"n_words": F.col("_w.n"), "word_chars": F.col("_w.c"), "n_symbols": symbol_count(text),
                          "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
                          "n_repeat_words": F.col("_w.r")})
            .withColumn("base_failed", (n_words < 50) | (100 * n_repeat > 50 * n_words)).drop("_w"))


def line_cleaned(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with clean_text (the lines that pass, in order), n_lines_failed, n_words_kept and n_words_all.

    A line fails on its own (``judged_line``). No line is dropped for lack of words, and blank lines stay, so a text
    without failures comes back unchanged. A null text stays null and counts no lines."""
    kept = F.filter(F.col("_lines"), lambda x: ~x["bad"])
    total = lambda lines: F.coalesce(F.aggregate(lines, F.lit(0).cast("bigint"), lambda n, x: n + x["n"]), F.lit(0).cast("bigint"))
    return (docs.withColumn("_lines", F.transform(F.split(F.col("text"), "\n", -1), lambda x: judged_line(x, rules)))
            .withColumns({"clean_text": F.array_join(F.transform(kept, lambda x: x["line"]), "\n"),
                          "n_lines_failed": F.coalesce(F.size(F.filter("_lines", lambda x: x["bad"])), F.lit(0)).cast("bigint"),
                          "n_words_kept": total(kept), "n_words_all": total(F.col("_lines"))}).drop("_lines"))


def quality(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Base counts, cleaned text and ``kept``: false where the base counts fail or too few words are left."""
    left = line_cleaned(base_counts(docs), rules)
    return left.withColumn("kept", ~F.col("base_failed") & (F.col("n_words_kept") >= rules.least_kept_words * F.col("n_words_all")))
