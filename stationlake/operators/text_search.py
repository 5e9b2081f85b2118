"""Text search on station names (D02-D08). Hits are readings, as in the reference.

Every search works on the name dimension: the distinct names with their number of readings
and analysed tokens. It is built by one partially aggregated ``groupBy(name)`` (only the
name column is read), or passed in as ``names`` where it is kept as a table of its own
(:func:`name_dimension`). Names are matched and scored there; the matching names are then
joined back to the readings (a broadcast join while Spark finds them small) for a top-k.

The query string is analysed with the same rules as the names
(:func:`stationlake.functions.text.text_positions`); it is a literal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions.distance import deletions, deletions_text, osa
from stationlake.functions.text import (NGRAM_MAX, NGRAM_MIN, analyze, analyze_positions, analyze_text, ngrams,
                                        ngrams_text, text_positions)

# BM25 parameters (the search engine's defaults).
K1, B = 1.2, 0.75
HIT_COLUMNS = ("name", "station_id", "ts", "num_bikes_available", "station_status")


def name_dimension(df: DataFrame, field: str = "name") -> DataFrame:
    """Distinct names with their number of readings and analysed tokens."""
    return (df.filter(F.col(field).isNotNull()).groupBy(F.col(field).alias("name"))
            .agg(F.count(F.lit(1)).alias("n_docs"))
            .withColumn("toks", analyze("name")))


def _hits(df: DataFrame, matched: DataFrame, order: list[Column], size: int, extra: tuple[str, ...] = (),
          fields=HIT_COLUMNS) -> DataFrame:
    """Top readings of the matched names; ``fields``: their columns, "*" for the whole reading."""
    own = list(df.columns) if fields == "*" else list(fields)
    rows = df.select(*dict.fromkeys([*own, "name", "ts", "station_id"]))
    return rows.join(matched, "name").orderBy(*order, F.col("ts").desc(), "station_id").limit(size).select(*own, *extra)


def _nothing(df: DataFrame, extra: dict[str, str], fields=HIT_COLUMNS) -> DataFrame:
    own = list(df.columns) if fields == "*" else list(fields)
    return df.select(*own, *[F.lit(None).cast(t).alias(c) for c, t in extra.items()]).limit(0)


def _starts_with(t: str):
    return lambda x: x.startswith(t)


def _is(t: str):
    return lambda x: x == F.lit(t)


def _holds(t: str) -> Column:
    return F.array_contains("toks", F.lit(t))


def corpus_stats(names: DataFrame, terms: list[str]) -> Column:
    """One scalar subquery: readings with a name (``n``), total tokens (``len``), and per
    distinct query term the readings whose name holds it (``df0``, ``df1``, ...)."""
    cols = [F.sum("n_docs").cast("double").alias("n"), F.sum(F.col("n_docs") * F.size("toks")).alias("len")]
    for i, t in enumerate(dict.fromkeys(terms)):
        cols.append(F.sum(F.when(_holds(t), F.col("n_docs")).otherwise(0)).alias(f"df{i}"))
    return names.agg(F.struct(*cols).alias("s")).scalar()


def bm25_score(terms: list[str], stats: Column) -> Column:
    """BM25 (k1 1.2, b 0.75, idf ln(1 + (N - df + 0.5) / (df + 0.5))), 6 decimals.

    Summed over the query terms in query order (a repeated term counts again).
    """
    distinct = list(dict.fromkeys(terms))
    avgdl = stats["len"] / stats["n"]
    norm = F.lit(K1) * (1 - F.lit(B) + F.lit(B) * F.size("toks").cast("double") / avgdl)
    score = F.lit(0.0)
    for t in terms:
        dfreq = stats[f"df{distinct.index(t)}"]
        idf = F.log(1 + (stats["n"] - dfreq + 0.5) / (dfreq + 0.5))
        tf = F.size(F.filter("toks", _is(t))).cast("double")
        score = score + idf * tf / (tf + norm)
    return F.round(score, 6)


def match_terms(df: DataFrame, query: str, operator: str = "and", size: int = 10, fields=HIT_COLUMNS,
                names: DataFrame | None = None) -> DataFrame:
    """D02 (``operator='and'``: every query term in the name) / match with ``'or'``.

    Ordered by BM25 score, then newest reading, then station id. A query with no
    terms left after analysis matches nothing.
    """
    q = analyze_text(query)
    if not q:
        return _nothing(df, {"score": "double"}, fields)
    names = names if names is not None else name_dimension(df)
    tests = [_holds(t) for t in dict.fromkeys(q)]
    hit = names.filter(reduce(lambda a, b: (a & b) if operator == "and" else (a | b), tests))
    scored = hit.select("name", bm25_score(q, corpus_stats(names, q)).alias("score"))
    return _hits(df, scored, [F.col("score").desc()], size, ("score",), fields)


def name_scores(df: DataFrame, query: str, names: DataFrame | None = None) -> DataFrame:
    """D08 table: BM25 score per name matching any query term."""
    q = analyze_text(query)
    names = names if names is not None else name_dimension(df)
    hit = reduce(lambda a, b: a | b, [_holds(t) for t in dict.fromkeys(q)])
    return names.filter(hit).select("name", "n_docs", bm25_score(q, corpus_stats(names, q)).alias("score"))


def phrase_prefix(df: DataFrame, query: str, size: int = 20, fields=HIT_COLUMNS,
                  names: DataFrame | None = None) -> DataFrame:
    """The query's terms as a phrase whose last term is a prefix.

    The terms must stand in the name at the distances they have in the query, stop words
    counted on both sides; the last must start a token. Every expansion counts (no cap).
    Ordered by fewest name tokens, newest reading, station id.
    """
    q = text_positions(query)
    if not q:
        return _nothing(df, {}, fields)
    names = names if names is not None else name_dimension(df)

    def at(first: Column, distance: int, t: str, last: bool):
        return lambda x: ((x["term"].startswith(t) if last else (x["term"] == F.lit(t)))
                          & (x["pos"] == first["pos"] + distance))

    def phrase_at(first: Column) -> Column:
        conds = [F.exists("tp", at(first, pos - q[0][0], t, k == len(q) - 1)) for k, (pos, t) in enumerate(q)]
        return reduce(lambda a, b: a & b, conds)

    hit = names.withColumn("tp", analyze_positions("name")).filter(F.exists("tp", phrase_at))
    return _hits(df, hit.select("name", F.size("toks").alias("_n")), [F.col("_n").asc()], size, (), fields)


def ngram_match(df: DataFrame, query: str, size: int = 20, lo: int = NGRAM_MIN, hi: int = NGRAM_MAX,
                fields=HIT_COLUMNS, names: DataFrame | None = None) -> DataFrame:
    """Names sharing any character n-gram (lo..hi) with the query.

    Ordered by number of shared grams, then newest reading, then station id.
    """
    qg = ngrams_text(analyze_text(query), lo, hi)
    if not qg:
        return _nothing(df, {"shared": "bigint"}, fields)
    names = names if names is not None else name_dimension(df)
    grams = F.array(*[F.lit(g) for g in qg])
    shared = F.size(F.array_intersect(ngrams(F.col("toks"), lo, hi), grams)).cast("bigint")
    hit = names.select("name", shared.alias("shared")).filter(F.col("shared") > 0)
    return _hits(df, hit, [F.col("shared").desc()], size, ("shared",), fields)


def auto_fuzziness(length: int) -> int:
    """Edits allowed by 'AUTO': 0 up to 2 characters, 1 up to 5, else 2."""
    return 0 if length <= 2 else (1 if length <= 5 else 2)


#: Edits up to which terms are found by their deletion neighbourhood; beyond it (no request's
#: 'AUTO' goes there) a term has too many shorter forms and all terms of a fitting length are compared.
INDEX_EDITS = 2


def deletion_index(names: DataFrame, k: int = INDEX_EDITS) -> DataFrame:
    """(variant, term): each vocabulary term under all it becomes by up to ``k`` deletions.

    May be kept as a table, sorted by variant; a search reads the variants of its word only.
    """
    vocab = names.select(F.explode("toks").alias("term")).distinct()
    return vocab.select(F.explode(deletions(F.col("term"), k)).alias("variant"), "term")


def fuzzy_terms(df: DataFrame, value: str, fuzziness="AUTO", prefix_length: int = 0,
                max_expansions: int | None = None, names: DataFrame | None = None,
                index: DataFrame | None = None) -> DataFrame:
    """D05 expansion: vocabulary terms within the allowed edits of ``value``.

    Both sides are lower-cased. Terms that share a deletion variant with the word are
    candidates (``index``: a kept :func:`deletion_index`), the distance is worked out for
    those only. A request may ask for the first ``prefix_length`` characters
    to be the same, and for the ``max_expansions`` closest terms only (ties by term); by
    default every term within the edits counts.
    """
    v = value.lower()
    k = auto_fuzziness(len(v)) if fuzziness == "AUTO" else int(fuzziness)
    if index is None:
        names = names if names is not None else name_dimension(df)
    if k <= INDEX_EDITS:
        found = index if index is not None else deletion_index(names, k)
        vocab = found.filter(F.col("variant").isin(deletions_text(v, k))).select("term").distinct()
    else:
        vocab = (index.select("term") if index is not None else names.select(F.explode("toks").alias("term"))).distinct()
    near = (F.abs(F.length("term") - len(v)) <= k) & (F.left("term", F.lit(prefix_length)) == v[:prefix_length])
    out = vocab.filter(near).withColumn("distance", osa(F.col("term"), F.lit(v))).filter(F.col("distance") <= k)
    return out.orderBy("distance", "term").limit(max_expansions) if max_expansions else out


def fuzzy_match(df: DataFrame, value: str, fuzziness="AUTO", prefix_length: int = 0,
                max_expansions: int | None = None, size: int = 10, fields=HIT_COLUMNS,
                names: DataFrame | None = None, index: DataFrame | None = None) -> DataFrame:
    """Readings whose name holds a term within the allowed edits.

    Ordered by smallest distance, newest reading, station id.
    """
    names = names if names is not None else name_dimension(df)
    near = fuzzy_terms(df, value, fuzziness, prefix_length, max_expansions, names, index)
    hit = (names.select("name", F.explode("toks").alias("term")).join(near, "term")
           .groupBy("name").agg(F.min("distance").alias("distance")))
    return _hits(df, hit, [F.col("distance").asc()], size, ("distance",), fields)


#: What a completion table's row completes: a whole name, or a token of it.
WHOLE, TOKEN = "name", "token"


def completion_table(names: DataFrame) -> DataFrame:
    """(kind, key, name, n_docs): every name under its lower-cased text and under each of its tokens."""
    whole = names.select(F.lit(WHOLE).alias("kind"), F.lower("name").alias("key"), "name", "n_docs")
    tokens = names.select(F.lit(TOKEN).alias("kind"), F.explode(F.array_distinct("toks")).alias("key"), "name", "n_docs")
    return whole.union(tokens)


def write_completions(names: DataFrame, path: str, page_rows: int = 2000) -> None:
    """Keeps the completion table sorted by kind and key: a prefix is one short stretch of it."""
    (completion_table(names).repartitionByRange("kind", "key", "name").sortWithinPartitions("kind", "key", "name")
     .write.option("parquet.page.row.count.limit", page_rows).parquet(path))


def starts_in_range(key: str, prefix: str) -> Column:
    """``key`` starts with ``prefix`` as a range of keys, which is pushed to the scan and prunes a sorted table."""
    least = F.col(key) >= prefix
    stem = prefix.rstrip(chr(0x10FFFF))
    if not stem:
        return least
    code = ord(stem[-1]) + 1
    code = 0xE000 if 0xD800 <= code <= 0xDFFF else code  # no characters there
    return least & (F.col(key) < stem[:-1] + chr(code))


def autocomplete(df: DataFrame, prefix: str, size: int = 10, names: DataFrame | None = None,
                 completions: DataFrame | None = None) -> DataFrame:
    """Distinct names starting with the prefix (case-insensitive), alphabetical.

    ``completions``: a kept :func:`completion_table`; then readings aren't read at all.
    """
    if completions is not None:
        hit = completions.filter((F.col("kind") == WHOLE) & starts_in_range("key", prefix.lower()))
        return hit.select("name").orderBy("name").limit(size)
    found = names if names is not None else df.groupBy("name").agg(F.count(F.lit(1)).alias("n_docs"))
    return found.filter(F.lower("name").startswith(prefix.lower())).select("name").orderBy("name").limit(size)


def edge_ngram_match(df: DataFrame, query: str, size: int = 10, fields=HIT_COLUMNS,
                     names: DataFrame | None = None, completions: DataFrame | None = None) -> DataFrame:
    """Names with a token that starts with a query term, of whatever length.

    Ordered by number of matched query terms, newest reading, station id. With a kept
    :func:`completion_table` the names come from one stretch of it per term.
    """
    q = analyze_text(query)
    if not q:
        return _nothing(df, {"matched": "bigint"}, fields)
    if completions is not None:
        ranges = [starts_in_range("key", t) for t in q]
        tokens = completions.filter((F.col("kind") == TOKEN) & reduce(lambda a, b: a | b, ranges))
        found = [F.max(r.cast("bigint")) for r in ranges]
        hit = tokens.groupBy("name").agg(reduce(lambda a, b: a + b, found).alias("matched"))
        return _hits(df, hit, [F.col("matched").desc()], size, ("matched",), fields)
    names = names if names is not None else name_dimension(df)
    per_term = [F.exists("toks", _starts_with(t)).cast("bigint") for t in q]
    hit = names.select("name", reduce(lambda a, b: a + b, per_term).alias("matched")).filter(F.col("matched") > 0)
    return _hits(df, hit, [F.col("matched").desc()], size, ("matched",), fields)
