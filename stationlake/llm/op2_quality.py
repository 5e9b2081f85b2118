"""Quality rules: a threshold table compiled into one Spark projection (no user functions).

``measures`` computes the text statistics, ``RULES`` is the threshold table, and
``apply_rules`` turns a table like it into one boolean per rule plus ``kept``.

Defined results: a null text counts as empty (no words, no lines with a word; base fails).
Repeated rows are judged each on its own; extra columns pass through ``apply_rules``
untouched (measure columns replace columns of the same name). The 5-word windows are
compared by a 64-bit hash within one text. Work per text is n log n in its length, so one
very long text is one slow row but never a failure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import table

# ---- fixed values: word separators, symbols, base thresholds --------------------------
SPACE = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
STOP_WORDS = ["the", "of", "and", "to", "in", "that", "is", "for", "with", "on",
              "le", "la", "les", "de", "des", "et", "en", "un", "une", "que", "qui", "est", "dans", "pour",
              "der", "die", "das", "und", "von", "zu", "den", "ist", "mit", "ein", "eine", "nicht",
              "el", "los", "las", "y", "del", "se", "por", "con", "para"]


@dataclass(frozen=True)
class Rule:
    """Keep a text when ``low <= measure <= high`` (either bound may be None)."""
    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        m = F.col(self.measure)
        test = F.lit(True)
        if self.low is not None:
            test = test & (m >= self.low)
        if self.high is not None:
            test = test & (m <= self.high)
        return F.coalesce(test, F.lit(False))


#: The threshold table. Ratios are per word, per character of a word, or per line with a word.
RULES = [
    Rule("enough_words", "n_words", low=MIN_WORDS),
    Rule("few_repeats", "repeat_ratio", high=MAX_REPEAT_PERCENT / 100),
    Rule("word_length", "mean_word_chars", low=2.0, high=15.0),
    Rule("few_symbols", "symbol_ratio", high=0.2),
    Rule("few_shouts", "shout_ratio", high=0.3),
    Rule("mixed_case", "upper_ratio", high=0.5),
    Rule("stop_words", "n_stop_words", low=1),
    Rule("few_dup_lines", "dup_line_ratio", high=0.5),
    Rule("few_bullets", "bullet_ratio", high=0.9),
    Rule("few_cut_lines", "ellipsis_ratio", high=0.5),
]


def _left(text: str, pattern: str) -> str:
    """SQL: number of characters of ``text`` that are left when ``pattern`` is removed."""
    return f"CAST(char_length(regexp_replace({text}, r'{pattern}', '')) AS BIGINT)"


def _repeat_words() -> str:
    """SQL: words covered by windows whose hash occurs twice or more.

    Windows are sorted by (hash, place); neighbours with equal hashes are repeats. Their
    places, sorted, each cover the words up to the next place or a whole window.
    ``transform(array(x), v -> ...)[0]`` binds a value to a name.
    """
    places = ("sort_array(transform(filter(s, (x, j) -> get(s, j - 1).h <=> x.h OR get(s, j + 1).h <=> x.h),"
              " x -> x.i))")
    covered = (f"aggregate(transform(p, (v, j) -> CAST(least({WINDOW}, coalesce(get(p, j + 1) - v, {WINDOW}))"
               " AS BIGINT)), 0L, (a, v) -> a + v)")
    pairs = "sort_array(transform(_wins, (h, i) -> named_struct('h', h, 'i', i)))"
    return f"transform(transform(array({pairs}), s -> {places}), p -> {covered})[0]"


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the text statistics as columns, in stacked projections of built-in functions.

    Each helper column (leading underscore) is used more than once by the next projection,
    which keeps Spark from evaluating it twice.
    """
    t, full, size = "_text", f"(size(_words) >= {WINDOW})", "size(_words)"
    own = [c for c in df.columns if c not in MEASURES]
    base = df.select(*[F.col(f"`{c}`") for c in own], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(t))
    split = base.withColumns({
        "_words": F.expr(f"filter(split({t}, r'{SPACE}'), w -> w <> '')"),
        "_lines": F.expr(f"filter(split({t}, '\\n'), l -> l rlike r'[^\\x20\\x09-\\x0D]')")})
    wins = split.withColumn("_wins", F.expr(
        f"CASE WHEN {full} THEN transform(sequence(1, {size} - {WINDOW - 1}),"
        f" i -> xxhash64(slice(_words, i, {WINDOW}))) ELSE CAST(array() AS ARRAY<BIGINT>) END"))
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    counted = wins.withColumns({
        "n_words": F.expr(f"CAST({size} AS BIGINT)"),
        "word_chars": F.expr("CAST(char_length(array_join(_words, '')) AS BIGINT)"),
        "n_symbols": F.expr(_left(t, NOT_SYMBOL)),
        "n_dup_lines": F.expr("CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT)"),
        "n_repeat_words": F.expr("CASE WHEN size(array_distinct(_wins)) < size(_wins)"
                                 f" THEN {_repeat_words()} ELSE 0L END"),
        "n_lines": F.expr("CAST(size(_lines) AS BIGINT)"),
        "n_stop_words": F.expr(f"CAST(size(array_intersect(array({stops}), _words)) AS BIGINT)"),
        "_shouts": F.expr(_left(t, "[^!]+")),
        "_upper": F.expr(_left(t, r"[^\p{Lu}]+")),
        "_bullets": F.expr(r"CAST(size(filter(_lines, l -> l rlike r'^[\x20\x09]*[-*•]')) AS BIGINT)"),
        "_cut": F.expr(r"CAST(size(filter(_lines, l -> l rlike r'(\.\.\.|…)[\x20\x09-\x0D]*$')) AS BIGINT)")})
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return counted.withColumns({
        "repeat_ratio": F.col("n_repeat_words") / words,
        "mean_word_chars": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "shout_ratio": F.col("_shouts") / words,
        "upper_ratio": F.col("_upper") / chars,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "bullet_ratio": F.col("_bullets") / lines,
        "ellipsis_ratio": F.col("_cut") / lines}).select(*own, *MEASURES)


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
            "repeat_ratio", "mean_word_chars", "symbol_ratio", "shout_ratio", "upper_ratio", "dup_line_ratio",
            "bullet_ratio", "ellipsis_ratio"]


def apply_rules(df: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Measured rows plus ``failed`` (names of the rules broken), ``base_failed`` and ``kept``."""
    n, rep = F.col("n_words"), F.col("n_repeat_words")
    broken = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]))
    return (df.withColumn("base_failed", (n < MIN_WORDS) | (100 * rep > MAX_REPEAT_PERCENT * n))
            .withColumn("failed", broken)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))


def quality(df: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    return apply_rules(measures(df, text), rules)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.array_join("failed", ",").alias("failed"))
