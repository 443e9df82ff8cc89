"""Operator 6, quality rules: divergence from what a language usually looks like.

A document is described by two histograms: its characters by class and its counts
of the common words of its language. Each is compared with the reference of that
language by Jensen-Shannon distance (square root of the divergence in bits, 0 to
1). A reference is the sum over all documents of the language that pass the base
rule, so it is a few numbers however large the corpus is. Only DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import GAP, cut, let, llm_query, table, without, words_of
from larkspur.operators.ranking import small_side

#: The character classes, each as what is removed from the text in this order; the rest is the last class.
CLASSES = ["\\p{Ll}+", GAP + "+", "\\p{Lu}+", "[0-9]+", "[.,;:!?'\"()-]+"]
#: Characters counted as symbols; none belongs to one of the first four classes.
SYMBOLS = "#*$%&|<>"
#: Common words by language.
COMMON_WORDS: Mapping[str, str] = {
    "en": "the of and to in a is that for it was on with as be at by this are from or an",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como",
}


@dataclass(frozen=True)
class Limits:
    """Thresholds; a distance test abstains below its minimum length."""

    min_words: int = 10
    max_repeat_percent: int = 20
    min_class_chars: int = 200
    max_class_distance: float = 0.33
    min_common_words: int = 100
    max_word_distance: float = 0.315
    min_reference_words: int = 2000


LIMITS = Limits()


def base_counts(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, _classes and _words.

    ``docs`` needs ``text``; null and empty texts count nothing. Columns of these
    names that are already there are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = docs.withColumns({
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "_words": words_of(F.col("text")),
        "_t0": F.length(text), "_r": text,
    })
    for k, pattern in enumerate(CLASSES, 1):
        if k == len(CLASSES):
            df = df.withColumn("n_symbols", (F.length("_r") - F.length(F.translate("_r", SYMBOLS, ""))).cast("long"))
        df = df.withColumn("_r", F.regexp_replace("_r", pattern, "")).withColumn(f"_t{k}", F.length("_r"))
    n = [F.col(f"_t{k}") for k in range(len(CLASSES) + 1)]
    counts = [(a - b).cast("double") for a, b in zip(n, n[1:])] + [n[-1].cast("double")]
    return df.withColumns({
        "_classes": F.array(*counts),
        "word_chars": (n[0] - (n[1] - n[2])).cast("long"),
        "n_words": F.size("_words").cast("long"),
        "n_repeat_words": let(_windows(F.col("_words")), lambda w: _covered(w)).cast("long"),
    }).drop("_r", *[f"_t{k}" for k in range(len(CLASSES) + 1)])


def _windows(words: Column, width: int = 5) -> Column:
    """A hash for each window of ``width`` words."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(
        F.size(h) >= width,
        F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[h[i + k] for k in range(width)])),
    ).otherwise(F.array().cast("array<bigint>")))


def _covered(windows: Column, width: int = 5) -> Column:
    """How many words lie in a window that is found twice or more."""

    def repeated(s: Column) -> Column:
        same = lambda j, k: F.get(s, j + k)["h"] == F.get(s, j)["h"]
        return F.filter(s, lambda e, j: F.coalesce(same(j, -1), F.lit(False)) | F.coalesce(same(j, 1), F.lit(False)))

    def union_length(found: Column) -> Column:
        starts = F.sort_array(F.transform(found, lambda e: e["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(width), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )

    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(let(placed, repeated), union_length)).otherwise(0)


def profiles(docs: DataFrame, common: Mapping[str, str] = COMMON_WORDS, limits: Limits = LIMITS) -> DataFrame:
    """``base_counts`` with base_failed, _lang and _hits: how often each common word of
    the language occurs, then all other words (only these where no words are listed). One pass over the texts."""
    dictionary = {lang: words.split() for lang, words in common.items()}
    known = sorted({w for words in dictionary.values() for w in words})
    df = base_counts(docs).withColumn("_found", F.filter("_words", lambda w: w.isin(known))).drop("_words")
    found = F.col("_found")
    hits = F.array().cast("array<double>")
    for lang, words in dictionary.items():
        each = let(found, lambda f, words=words: F.transform(
            F.array(*[F.lit(w) for w in words]), lambda w: F.size(F.filter(f, lambda x: x == w)).cast("double")))
        hits = F.when(F.col("lang") == lang, each).otherwise(hits)
    return df.withColumns({
        "_lang": F.col("lang"),
        "_hits": let(hits, lambda h: F.concat(h, F.array(F.col("n_words") - F.aggregate(h, F.lit(0.0), lambda a, x: a + x)))),
        "base_failed": (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")),
    }).drop("_found")


def references(profiled: DataFrame, common: Mapping[str, str] = COMMON_WORDS, limits: Limits = LIMITS) -> DataFrame:
    """Shares by language (_ref) from ``profiles``: class_ref and word_ref, array<double>.

    Summed over all documents of a language that pass the base rule, whatever the
    language: those without listed words have character classes only. Languages
    with fewer than ``min_reference_words`` words, and null, have no row.
    """
    k, m = len(CLASSES) + 1, max((len(w.split()) for w in common.values()), default=0) + 1
    sums = profiled.where("NOT base_failed AND _lang IS NOT NULL").groupBy("_lang").agg(
        F.sum("n_words").alias("n"), *[F.sum(F.col("_classes")[i]).alias(f"c{i}") for i in range(k)],
        *[F.sum(F.coalesce(F.get("_hits", F.lit(i)), F.lit(0.0))).alias(f"w{i}") for i in range(m)])
    total = sum((F.col(f"c{i}") for i in range(1, k)), F.col("c0"))
    return sums.where(F.col("n") >= limits.min_reference_words).select(
        F.col("_lang").alias("_ref"), F.array(*[F.try_divide(F.col(f"c{i}"), total) for i in range(k)]).alias("class_ref"),
        F.array(*[F.try_divide(F.col(f"w{i}"), F.col("n")) for i in range(m)]).alias("word_ref"))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts from shares of the same length."""

    def term(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def shares(c: Column) -> Column:
        return let(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), lambda n: F.transform(c, lambda x: F.try_divide(x, n)))

    terms = F.zip_with(shares(counts), reference, lambda p, q: (term(p, (p + q) / 2) + term(q, (p + q) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))


def quality_rules(docs: DataFrame, key: str = "doc_id", common: Mapping[str, str] = COMMON_WORDS, limits: Limits = LIMITS) -> DataFrame:
    """Judge every document: key, base counts, base_failed, both distances and kept.

    ``docs`` needs ``key``, text and lang; other columns are not read. A document
    whose language has no reference (null or too rare) is not compared: what it
    looks like in another language or script says nothing about it. A language
    without listed words is compared by its characters only. Null and empty texts
    fail the base rule, as they have no words. Repeated rows are judged alike, one
    row for each. An empty table gives an empty result.

    The texts are read once: what is kept of each is a row of numbers, written to
    the shared folder, from which references and distances are made. References
    are a row per language, joined by broadcast if they are counted to be few.
    """
    rows = cut(profiles(docs.select(key, "text", "lang"), common, limits).drop("text", "lang"))
    refs = small_side(cut(references(rows, common, limits)))
    both = rows.join(refs, F.col("_lang") == F.col("_ref"), "left")
    chars = F.aggregate("_classes", F.lit(0.0), lambda a, x: a + x)
    words = F.slice("word_ref", 1, F.size("_hits"))
    known, listed = F.col("_ref").isNotNull(), F.size("_hits") > 1
    judged = both.withColumns({
        "class_distance": F.when(known & (chars >= limits.min_class_chars), distance(F.col("_classes"), F.col("class_ref"))),
        "word_distance": F.when(known & listed & (F.col("n_words") >= limits.min_common_words), distance(F.col("_hits"), words)),
    })
    near = (F.coalesce("class_distance", F.lit(0.0)) <= limits.max_class_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= limits.max_word_distance)
    return judged.withColumn("kept", ~F.col("base_failed") & near).drop("_classes", "_hits", "_lang", "_ref", "class_ref", "word_ref")


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's first stage: rejected documents go. Rows that share a doc_id go together."""
    return without(docs, quality_rules(docs).where("NOT kept").select("doc_id"), "doc_id")


_JS = "sqrt(greatest(0, sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)))"
_SQL = f"""
WITH dict(lang, i, w) AS (SELECT l, unnest(range(1, len(ws) + 1)), unnest(ws) FROM (SELECT l, string_split(x, ' ') AS ws
    FROM (VALUES {", ".join(f"('{lang}', '{words}')" for lang, words in COMMON_WORDS.items())}) AS v(l, x))),
d AS (SELECT doc_id, coalesce(text, '') AS t, lang FROM documents),
w AS (SELECT doc_id, t, lang, list_filter(string_split_regex(t, '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls FROM d),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
grams AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] AS g FROM win),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY 1),
base AS (SELECT w.doc_id, t, lang, ws, len(ws) AS n_words, length(regexp_replace(t, '[ \\t-\\r]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(cover.n, 0) AS n_repeat_words FROM w LEFT JOIN cover USING (doc_id)),
b AS (SELECT *, n_words < {LIMITS.min_words} OR 100 * n_repeat_words > {LIMITS.max_repeat_percent} * n_words AS base_failed,
    regexp_replace(t, '\\p{{Ll}}+', '', 'g') AS r FROM base),
c AS (SELECT *, regexp_replace(r, '[ \\t-\\r]+', '', 'g') AS r2 FROM b),
e AS (SELECT *, regexp_replace(r2, '\\p{{Lu}}+', '', 'g') AS r3 FROM c),
f AS (SELECT *, regexp_replace(r3, '[0-9]+', '', 'g') AS r4 FROM e),
g AS (SELECT *, regexp_replace(r4, '[.,;:!?''"()-]+', '', 'g') AS r5 FROM f),
h AS (SELECT *, [length(t) - length(r), length(r) - length(r2), length(r2) - length(r3), length(r3) - length(r4), length(r4) - length(r5), length(r5)] AS cl FROM g),
cls AS (SELECT doc_id, lang, k, cl[k] AS n, length(t) AS chars, base_failed FROM h, (SELECT unnest(range(1, 7)) AS k)),
size AS (SELECT lang, sum(n_words) AS n FROM h WHERE NOT base_failed GROUP BY 1),
csum AS (SELECT lang, k, sum(n) AS n FROM cls WHERE NOT base_failed AND lang IN (SELECT lang FROM size WHERE n >= {LIMITS.min_reference_words}) GROUP BY 1, 2),
cref AS (SELECT lang, k, n / sum(n) OVER (PARTITION BY lang) AS q FROM csum),
cdist AS (SELECT doc_id, {_JS} AS x FROM (SELECT doc_id, n / chars AS p, q FROM cls JOIN cref USING (lang, k) WHERE chars >= {LIMITS.min_class_chars}) GROUP BY 1),
uses AS (SELECT doc_id, lang, y AS w, count(*) AS n FROM (SELECT doc_id, lang, unnest(ws) AS y FROM h) GROUP BY 1, 2, 3),
hit AS (SELECT h.doc_id, h.lang, dict.i, h.n_words, h.base_failed, coalesce(u.n, 0) AS n FROM h JOIN dict USING (lang) LEFT JOIN uses u ON u.doc_id = h.doc_id AND u.w = dict.w),
hall AS (SELECT * FROM hit UNION ALL SELECT doc_id, lang, 0, n_words, base_failed, n_words - sum(n) FROM hit GROUP BY doc_id, lang, n_words, base_failed),
wref AS (SELECT lang, i, sum(hall.n) / size.n AS q FROM hall JOIN size USING (lang) WHERE NOT base_failed AND size.n >= {LIMITS.min_reference_words} GROUP BY lang, i, size.n),
wdist AS (SELECT doc_id, {_JS} AS x FROM (SELECT doc_id, n / n_words AS p, q FROM hall JOIN wref USING (lang, i) WHERE n_words >= {LIMITS.min_common_words}) GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(cdist.x, 0) <= {LIMITS.max_class_distance} AND coalesce(wdist.x, 0) <= {LIMITS.max_word_distance} AS kept
FROM b LEFT JOIN cdist USING (doc_id) LEFT JOIN wdist USING (doc_id)"""


@llm_query("op6_quality_rules", _SQL)
def op6_quality_rules(spark, sf_dir):
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
