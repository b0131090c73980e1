"""Quality rules by distribution divergence, with DataFrame functions only.

Each text has a histogram of character classes and one of common words. The reference of a language
is made in two rounds over all its documents that are long enough for both histograms, each with the
same weight: first the mean of all, then the mean of those that are no farther from the first mean
than they are on average, so that junk does not pull the reference towards itself. A document is
rejected if its Jensen-Shannon distance (base 2, square root of the divergence) from the reference
of its own language exceeds a limit, for the classes alone or for both histograms together; the
limit for both is wider for short texts, whose shares scatter by the root of their length. Texts
shorter than the minimum lengths are not judged by that histogram, and neither are languages of which
too few documents are known.

Words are the runs of characters other than U+0020 and U+0009 to U+000D. A null text has no words
and fails the base rule; null languages are one language of their own. Every row gets a verdict of
its own, so repeated rows and repeated or null ids are kept apart; an empty table gives an empty
result. Only the columns named are read, and added columns carry the prefix `_quality_`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.operators.small_side import broadcast_if_small
from windrow.session import scratch_path

# fixed values: frequent function words of English, German, French and Spanish
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "with", "as", "be", "at", "by", "this", "from",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als",
    "le", "la", "les", "de", "et", "un", "une", "du", "que", "est", "pour", "qui", "dans", "par", "sur", "au",
    "el", "los", "y", "se", "las", "por", "con", "no", "su", "para", "es", "al", "lo",
)
BLANKS = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
_P = "_quality_"
ROUNDING = 1e-9  # equal distances may differ by this from their mean


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeated_percent: int = 50
    min_chars: int = 200  # characters in words, for the classes
    min_judged_words: int = 50  # for the common words
    min_documents: int = 20  # of a language, for its reference
    max_class_distance: float = 0.35
    max_total_distance: float = 0.4  # both distances together, of an endless text
    short_allowance: float = 1.0  # added to it, divided by the root of the number of words


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def _repeated_words(words: Column) -> Column:
    """Words inside windows of three words that occur twice or more in `words`."""

    def covered(windows: Column) -> Column:
        again = F.filter(
            windows,
            lambda x, i: (F.get(windows, i - 1)["h"] == x["h"]) | (F.get(windows, i + 1)["h"] == x["h"]),
        )
        at = F.sort_array(F.transform(again, lambda x: x["i"]))
        return let(
            at,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1), x + 3) - x).cast("long")),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )
    return F.when(F.size(words) >= 4, let(F.sort_array(windows), covered)).otherwise(F.lit(0).cast("long"))


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))


def _count(codes: Column, code: str) -> Column:
    return F.length(codes) - F.length(F.translate(codes, code, ""))


def _class_counts(text: Column, n_chars: Column) -> Column:
    """Lower-case ASCII letters, upper-case, digits, symbols, other ASCII, not ASCII."""
    rest = F.regexp_replace(F.coalesce(text, F.lit("")), "[a-z\\x20\\x09-\\x0D]+", "")

    def counts(r: Column) -> Column:
        upper = F.length(r) - F.length(F.regexp_replace(r, "[A-Z]+", ""))
        digit = F.length(r) - F.length(F.regexp_replace(r, "[0-9]+", ""))
        symbol = _count(r, SYMBOLS)
        foreign = F.length(F.regexp_replace(r, "[\\x00-\\x7F]+", ""))
        other = F.length(r) - upper - digit - symbol - foreign
        return F.array(*(x.cast("long") for x in (n_chars - F.length(r), upper, digit, symbol, other, foreign)))

    return let(rest, counts)


def _common_counts(words: Column) -> Column:
    """How often each common word occurs (in lower case), and how many words are none."""
    found = F.filter(words, lambda w: w.isin(*COMMON_WORDS))

    def counts(hits: Column) -> Column:
        spaced = F.concat(F.lit(" "), F.array_join(hits, "  "), F.lit(" "))

        def each(text: Column) -> Column:
            lost = [F.length(text) - F.length(F.replace(text, F.lit(f" {w} "))) for w in COMMON_WORDS]
            parts = [(n / (len(w) + 2)).cast("long") for n, w in zip(lost, COMMON_WORDS)]
            return F.array(*parts, (F.size(words) - F.size(hits)).cast("long"))

        return let(spaced, each)

    return let(found, counts)


def _histograms(words: Column, text: Column) -> Column:
    n_chars = F.length(F.array_join(words, ""))
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        n_chars.cast("long").alias("word_chars"),
        _class_counts(text, n_chars).alias("classes"),
        _common_counts(words).alias("common"),
    )


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return let(total, lambda n: F.transform(counts, lambda x: x / n))


def measure(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """`docs` with a struct `_quality_m` of everything that is counted in a text."""

    def measured(w: Column) -> Column:
        return F.struct(_histograms(w, F.col(text)).alias("h"), _repeated_words(w).alias("n_repeat_words"))

    lines = let(_lines(F.col(text)), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return docs.withColumns(
        {
            f"{_P}m": let(words_of(F.col(text)), measured),
            f"{_P}dup_lines": lines,
            f"{_P}key": F.coalesce(F.col(lang), F.lit("")),
        }
    )


def _distances(rows: DataFrame, rules: Rules) -> DataFrame:
    """`rows` with the distances from the histograms `_quality_classes` and `_quality_common`, null for short texts."""
    h = F.col(f"{_P}m.h")
    return rows.withColumns(
        {
            f"{_P}class_distance": F.when(h["word_chars"] >= rules.min_chars, distance(_shares(h["classes"]), F.col(f"{_P}classes"))),
            f"{_P}word_distance": F.when(h["n_words"] >= rules.min_judged_words, distance(_shares(h["common"]), F.col(f"{_P}common"))),
        }
    )


def _means(long_enough: DataFrame, least: int) -> DataFrame:
    """A row for each language of at least `least` documents: the mean of their histograms."""
    h = F.col(f"{_P}m.h")
    shares = long_enough.select(f"{_P}key", _shares(h["classes"]).alias("classes"), _shares(h["common"]).alias("common"))
    lengths = {"classes": 6, "common": len(COMMON_WORDS) + 1}
    sums = shares.groupBy(f"{_P}key").agg(
        F.count("*").alias("n"),
        *(F.avg(F.get(name, F.lit(i))).alias(f"{name}{i}") for name, n in lengths.items() for i in range(n)),
    )
    return sums.filter(F.col("n") >= least).select(
        F.col(f"{_P}key").alias(f"{_P}lang"),
        *(F.array(*(f"{name}{i}" for i in range(n))).alias(f"{_P}{name}") for name, n in lengths.items()),
    )


def references(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """A row for each language: mean class and common-word histograms of its documents near the mean of all."""
    h = F.col(f"{_P}m.h")
    long_enough = measured.filter((h["word_chars"] >= rules.min_chars) & (h["n_words"] >= rules.min_judged_words))
    means = broadcast_if_small(_means(long_enough, rules.min_documents))
    both = F.col(f"{_P}class_distance") + F.col(f"{_P}word_distance")
    first = _distances(long_enough.join(means, F.col(f"{_P}key") == F.col(f"{_P}lang")), rules).select(
        f"{_P}key", f"{_P}m", both.alias(f"{_P}both")
    )
    middle = first.groupBy(F.col(f"{_P}key").alias(f"{_P}lang")).agg(F.avg(f"{_P}both").alias(f"{_P}middle"))
    near = first.join(broadcast_if_small(middle), F.col(f"{_P}key") == F.col(f"{_P}lang")).filter(
        F.col(f"{_P}both") <= F.col(f"{_P}middle") + ROUNDING
    )
    return _means(near, 1)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares, between 0 and 1; null without a second one."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    return F.when(q.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x))))


def judge(measured: DataFrame, refs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """`measured` without its helper columns, with a struct `_quality_`: counts, distances, verdicts."""
    m = f"{_P}m"
    rows = measured.join(refs, F.col(f"{_P}key") == F.col(f"{_P}lang"), "left")
    h = F.col(f"{m}.h")
    n_words, n_repeat = h["n_words"], F.col(f"{m}.n_repeat_words")
    base_failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeated_percent * n_words)
    rows = _distances(rows, rules)
    by_both = F.col(f"{_P}class_distance") + F.col(f"{_P}word_distance")
    limit = rules.max_total_distance + rules.short_allowance / F.sqrt(F.greatest(n_words, F.lit(1)))
    passed = ~F.coalesce(F.col(f"{_P}class_distance") > rules.max_class_distance, F.lit(False)) & ~F.coalesce(
        by_both > limit, F.lit(False)
    )
    return rows.select(
        *(c for c in measured.columns if c not in (m, f"{_P}dup_lines", f"{_P}key")),
        F.struct(
            n_words.alias("n_words"),
            h["word_chars"].alias("word_chars"),
            h["classes"][3].alias("n_symbols"),
            F.col(f"{_P}dup_lines").alias("n_dup_lines"),
            n_repeat.alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            (~base_failed & passed).alias("kept"),
            F.col(f"{_P}class_distance").alias("class_distance"),
            F.col(f"{_P}word_distance").alias("word_distance"),
        ).alias(_P),
    )


def quality(
    docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang", drop: tuple[str, ...] = ()
) -> DataFrame:
    """`judge` against references taken from all of `docs`; the columns in `drop` are not kept.

    Every text is read once: what was counted in it goes to a table in the shared folder, from
    which the references and then the verdicts are made. Texts are not shuffled.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "quality")
    measure(docs, text, lang).drop(*drop).write.parquet(path)
    measured = spark.read.parquet(path)
    return judge(measured, broadcast_if_small(references(measured, rules)), rules)


def keep(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of `docs` that pass."""
    return quality(docs, rules, text, lang).filter(F.col(f"{_P}.kept")).select(*docs.columns)
