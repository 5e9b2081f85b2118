"""Text analysis of station names as Spark column expressions.

The rules are this library's (the reference names its analyzers without defining
them): lower-case, split on anything that is not a letter or digit, drop French
stop words. Positions are counted before stop words are removed, in names and queries
alike, so a phrase matches across a removed word only where both have one.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ------------------------------------------------------------------
# French stop words dropped by the name analyzer.
FRENCH_STOP_WORDS = [
    "a", "au", "aux", "avec", "ce", "ces", "dans", "de", "des", "du", "elle", "en", "et", "eux",
    "il", "je", "la", "le", "les", "leur", "lui", "ma", "mais", "me", "même", "mes", "moi", "mon",
    "ne", "nos", "notre", "nous", "on", "ou", "par", "pas", "pour", "qu", "que", "qui", "sa", "se",
    "ses", "son", "sur", "ta", "te", "tes", "toi", "ton", "tu", "un", "une", "vos", "votre", "vous",
    "c", "d", "j", "l", "à", "m", "n", "s", "t", "y", "été", "étée", "étées", "étés", "étant",
    "suis", "es", "est", "sommes", "êtes", "sont", "serai", "seras", "sera", "ceci", "cela", "celà",
    "cet", "cette", "ici", "ils", "leurs", "quel", "quels", "quelle", "quelles", "sans", "soi",
]
SPLIT_PATTERN = r"[^\p{L}\p{N}]+"
NGRAM_MIN, NGRAM_MAX = 3, 4          # n-gram analyzer
# ------------------------------------------------------------------------------------

_STOP = sorted(set(FRENCH_STOP_WORDS))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _stop_array() -> Column:
    return F.array(*[F.lit(w) for w in _STOP])


def _sql_raw_tokens(name: str) -> str:
    return f"filter(split(lower(`{name}`), r'{SPLIT_PATTERN}'), t -> t != '')"


def _sql_stop() -> str:
    return "array(" + ", ".join("'" + w + "'" for w in _STOP) + ")"


def raw_tokens(text) -> Column:
    """Lower-cased words before stop-word removal (empty pieces dropped)."""
    if isinstance(text, str):
        return F.expr(_sql_raw_tokens(text))
    return F.filter(F.split(F.lower(text), SPLIT_PATTERN), lambda t: t != "")


def analyze(text) -> Column:
    """The name analyzer, array<string>.

    For a column name the whole expression is one SQL snippet (one call to build);
    the same rules apply to any Column expression.
    """
    if isinstance(text, str):
        return F.expr(f"filter({_sql_raw_tokens(text)}, t -> NOT array_contains({_sql_stop()}, t))")
    stop = _stop_array()
    return F.filter(raw_tokens(text), lambda t: ~F.array_contains(stop, t))


def analyze_positions(text) -> Column:
    """D01 with positions: array<struct<pos:int, term:string>>, stop words leave gaps."""
    if isinstance(text, str):
        return F.expr(f"filter(transform({_sql_raw_tokens(text)}, (t, i) -> named_struct('pos', i, 'term', t)), "
                      f"x -> NOT array_contains({_sql_stop()}, x.term))")
    stop = _stop_array()
    with_pos = F.transform(raw_tokens(text), lambda t, i: F.struct(i.alias("pos"), t.alias("term")))
    return F.filter(with_pos, lambda x: ~F.array_contains(stop, x["term"]))


def _grams_of(t: Column, n: int) -> Column:
    return F.when(F.length(t) >= n,
                  F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: t.substr(i, F.lit(n))))


def ngrams(tokens: Column, lo: int = NGRAM_MIN, hi: int = NGRAM_MAX) -> Column:
    """Distinct character n-grams (lo..hi) of every token; short tokens give none.

    The length guard matters: ``sequence(1, 0)`` would count down and make junk grams.
    """
    empty = F.array().cast("array<string>")
    per_token = F.transform(tokens, lambda t: F.flatten(F.array(
        *[F.coalesce(_grams_of(t, n), empty) for n in range(lo, hi + 1)])))
    return F.array_distinct(F.flatten(per_token))


# ---- the same analysis in plain Python, for query literals in SQL checks and tests --
def text_positions(text: str) -> list[tuple[int, str]]:
    """(position, term) of a query text; stop words leave gaps."""
    spaced = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in text.lower())
    return [(i, t) for i, t in enumerate(spaced.split()) if t not in set(_STOP)]


def analyze_text(text: str) -> list[str]:
    return [t for _, t in text_positions(text)]


def stop_words() -> list[str]:
    return list(_STOP)


def ngrams_text(tokens: list[str], lo: int = NGRAM_MIN, hi: int = NGRAM_MAX) -> list[str]:
    """Python twin of :func:`ngrams` for query literals (distinct, first-seen order)."""
    out = []
    for t in tokens:
        for n in range(lo, hi + 1):
            out += [t[i:i + n] for i in range(len(t) - n + 1)]
    return list(dict.fromkeys(out))
