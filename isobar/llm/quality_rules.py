"""Quality rules, line first: rules judge each line, failing lines go, and documents that lose too much text are rejected.

Only built-in DataFrame functions; every figure of a document is computed inside its own row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

#: Phrases of licence, consent and navigation lines.
BOILERPLATE = r"(?i)licensed under|all rights reserved|copyright \d|©|cookie (policy|settings)|privacy policy|terms of (use|service)|click here|subscribe (now|to)|sign (in|up)|log ?in|enable javascript|powered by"
#: Parts of these phrases in lower case: a text with none of them has no such line.
HINTS = ("licensed under", "all rights reserved", "copyright ", "©", "cookie ", "privacy policy", "terms of ", "click here", "subscribe ", "sign in", "sign up", "login", "log in", "enable javascript", "powered by")
SYMBOLS = r"[#*$%&|<>]"
BARS = r"(?:^|[\x20\x09])[|•·»>]"
#: Two capitals with no other letter between them, which a line of mostly capitals has.
CAPITALS = r"\p{Lu}\P{L}*+\p{Lu}"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(h: Column, size: int) -> Column:
    """The number of words inside a window of size words that occurs twice or more in the array h of word hashes."""
    win = F.slice(F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)])), 1, F.greatest(F.size(h) - (size - 1), F.lit(0)))

    def covered(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = let(placed, lambda s: F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])))
        return F.aggregate(
            F.array_sort(F.transform(same, lambda x: x["i"])),
            F.struct(F.lit(-size).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(size), p - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    # few texts repeat a window; only theirs are sorted
    return let(win, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long")))


def line_fails(line: Column, hashes: Column, marked: Column, barred: Column, loud: Column, symbols_per_word: float, shout: float, distinct: float) -> Column:
    """True for a line with words (hashes: one number a word) that breaks a rule:

    punctuation: more than symbols_per_word symbols of `#*$%&|<>`, or doubled exclamation marks, per word;
    navigation: bars or bullets between every one or two words;
    shouting: capitals are over shout of 20 or more letters;
    repetition: of 8 or more words under distinct are different.
    marked, barred and loud: whether the whole text has any character that the first three rules look for.
    """
    n = F.size(hashes)
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    return (
        (marked & (F.regexp_count(line, F.lit(SYMBOLS)) + F.regexp_count(line, F.lit("!!+")) > symbols_per_word * n))
        | (barred & (2 * F.regexp_count(line, F.lit(BARS)) >= n))
        | (loud & line.rlike(CAPITALS) & (letters >= 20) & (F.regexp_count(line, F.lit(r"\p{Lu}")) > shout * letters))
        | ((n >= 8) & (F.size(F.array_distinct(hashes)) < distinct * n))
    )


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    *,
    symbols_per_word: float = 0.3,
    shout: float = 0.6,
    distinct: float = 0.25,
    most_lost: float = 0.5,
    most_removed: float = 0.8,
    least_words: int = 10,
    most_repeated: float = 0.2,
) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, n_bad_lines, clean_text and kept.

    A line is what stands between newlines; lines without a word are neither judged nor counted, and stay in clean_text.
    base_failed: under least_words words, or over most_repeated of the words lie in 5-word windows that occur twice or more.
    Lines with a phrase of BOILERPLATE and lines that break a rule (line_fails) are left out of clean_text.
    kept: not base_failed, at most most_removed of the characters of all lines with words are in lines that go for any
    reason, and of those without boilerplate, of which there must be some, at most most_lost are in lines that break a rule:
    a licence line goes, but says little against its document; a text that is next to nothing without such lines is rejected.
    A null or empty text has no words: all counts 0, base_failed true, kept false, clean_text null or empty.
    Rows are judged one by one: repeated rows give repeated results. Columns of docs with the names above are replaced; all
    others are kept, whatever they are called.
    """
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_bad_lines", "clean_text", "kept"]
    df = docs.drop(*[c for c in docs.columns if c.lower() in out and c != text])
    own = [c for c in df.columns if not (c == text and c.lower() in out)]
    t, lines, hashes, kinds, full, base = (free_name(df, f"_{k}") for k in ("text", "lines", "hashes", "kinds", "full", "base"))
    marked, barred, loud, known, win, bad = (free_name(df, f"_{k}") for k in ("marked", "barred", "loud", "known", "win", "bad"))
    c = F.col
    # other white space counts as a space here; few texts have any
    df = df.withColumn(base, F.coalesce(c(text), F.lit("")))
    df = df.withColumn(t, F.when(c(base).rlike(r"[\x09\x0B-\x0D]"), F.regexp_replace(base, r"[\x09\x0B-\x0D]", " ")).otherwise(c(base)))
    df = df.withColumn(win, F.lower(base))
    df = df.withColumns(
        {
            lines: F.split(base, "\n"),
            hashes: F.transform(F.split(t, "\n"), lambda x: F.transform(F.array_remove(F.split(x, " "), ""), lambda w: F.xxhash64(w))),
            "n_symbols": F.regexp_count(base, F.lit(SYMBOLS)).cast("long"),
            barred: c(base).rlike("[|•·»>]"),
            loud: c(base).rlike(CAPITALS),
            known: reduce(lambda a, b: a | b, [F.contains(c(win), F.lit(h)) for h in HINTS]),
        }
    )
    df = df.withColumn(marked, (c("n_symbols") > 0) | F.contains(c(base), F.lit("!!")))
    # of each line: 0 without words, 1 boilerplate, 2 breaks a rule, 3 good
    kind = lambda x, h: F.when(F.size(h) == 0, 0).when(c(known) & x.rlike(BOILERPLATE), 1).when(line_fails(x, h, c(marked), c(barred), c(loud), symbols_per_word, shout, distinct), 2).otherwise(3)
    df = df.withColumn(kinds, F.zip_with(lines, hashes, kind))
    df = df.withColumns({full: F.array_compact(F.zip_with(lines, kinds, lambda x, k: F.when(k > 0, x))), bad: F.array_contains(kinds, 1) | F.array_contains(kinds, 2)})
    chars = lambda *of: F.length(F.array_join(F.array_compact(F.zip_with(lines, kinds, lambda x, k: F.when(k.isin(*of), x))), ""))
    clean = F.when(c(bad), F.array_join(F.array_compact(F.zip_with(lines, kinds, lambda x, k: F.when(~k.isin(1, 2), x))), "\n")).otherwise(c(base))
    few = F.when(c(bad), (chars(2, 3) > 0) & (chars(2) <= most_lost * chars(2, 3)) & (chars(1, 2) <= most_removed * chars(1, 2, 3))).otherwise(F.lit(True))
    df = df.withColumns(
        {
            hashes: F.flatten(hashes),
            "word_chars": F.length(F.replace(F.replace(t, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))).cast("long"),
            "n_lines": F.size(full).cast("long"),
            "n_dup_lines": (F.size(full) - F.size(F.array_distinct(full))).cast("long"),
            "n_bad_lines": F.when(c(bad), F.size(kinds) - F.size(F.array_remove(F.array_remove(kinds, 1), 2))).otherwise(F.lit(0)).cast("long"),
            bad: few,
            win: F.when(c(text).isNotNull(), clean),
        }
    )
    df = df.withColumns({"n_words": F.size(hashes).cast("long"), "n_repeat_words": repeated_words(c(hashes), 5)})
    df = df.withColumn("base_failed", (c("n_words") < least_words) | (100 * c("n_repeat_words") > round(100 * most_repeated) * c("n_words")))
    df = df.withColumn("kept", ~c("base_failed") & c(bad)).withColumn("clean_text", c(win))
    # a filter on the verdict isn't pushed below a generator, so nothing above is computed twice
    return df.select(*own, F.inline(F.array(F.struct(*out))))
