"""Quality rules by distribution divergence (operator 6), native.

Every document gets two histograms: character classes, and the common words
of its language.  Each is compared with the language's reference -- the
same histogram summed over the corpus' documents of that language -- by
Jensen-Shannon distance (base 2, 0 to 1).  A document is rejected when it
fails the base rules (fewer than 50 words, or more than half of its words
in repeated three-word windows) or when a distance exceeds its limit;
documents below ``guard_words`` words are too short for the comparison and
only the base rules decide.

Defined results: a null text counts as empty and fails the base rules; a
null or unknown language is compared with the documents of the same
language value, by character classes only; repeated rows are judged alike;
no rows, no output.  Extra columns stay; columns called like those added
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import GAP, stored

# Frequent function words of the corpus' languages.
COMMON = {
    "en": "the of and a to in is that it was for on are with as this from by at be or an".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par sur au plus".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
# Character classes, as what a class leaves when all else is removed.
CLASSES = {"upper": r"[^\p{Lu}]+", "digit": r"[^0-9]+", "stop": r"[^.,;:!?'\"()-]+", "other": r"[\p{L}0-9\x20\x09-\x0D.,;:!?'\"()-]+"}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _left(text: Column, removed: str) -> Column:
    return F.length(F.regexp_replace(text, removed, "")).cast("long")


def repeat_words(ws: Column) -> Column:
    """Words that lie in a three-word window found twice or more (windows
    are known by 64-bit hash).  The hashes that repeat come from the sorted
    hashes; where they are few, each window is looked up among them, else
    hashes are sorted with their positions."""
    def hashes(a: Column) -> Column:
        each = F.transform(a, lambda w, i: F.xxhash64(w, F.get(a, i + 1), F.get(a, i + 2)))
        return F.slice(each, F.lit(1), F.size(a) - 2)

    def some(h: Column) -> Column:
        return once(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, j: x == F.get(s, j + 1))))

    def starts(h: Column, twice: Column) -> Column:
        found = F.filter(F.transform(h, lambda x, j: F.when(F.array_contains(twice, x), j)), lambda j: j.isNotNull())
        rows = F.sort_array(F.transform(h, lambda x, j: F.struct(x.alias("h"), j.alias("j"))))
        near = lambda r, rs, k: F.get(rs, k)["h"].eqNullSafe(r["h"])
        sorted_ = once(rows, lambda rs: F.sort_array(F.filter(F.transform(
            rs, lambda r, k: F.when(near(r, rs, k - 1) | near(r, rs, k + 1), r["j"])), lambda j: j.isNotNull())))
        return F.when(F.size(twice) <= 24, found).otherwise(sorted_)

    def covered(at: Column) -> Column:
        return F.aggregate(
            at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
            lambda acc, i: F.struct((acc["n"] + i + 3 - F.greatest(i, acc["to"])).alias("n"), (i + 3).alias("to")),
            lambda acc: acc["n"]).cast("long")

    none = F.lit(0).cast("long")
    judge = lambda h: once(F.struct(h.alias("h"), some(h).alias("t")), lambda s: F.when(
        F.size(s["t"]) == 0, none).otherwise(covered(starts(s["h"], s["t"]))))
    return F.when(F.size(ws) < 4, none).otherwise(once(hashes(ws), judge))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def measure(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts and both histograms (``__chars``, ``__common``)."""
    added = [*COUNTS, "base_failed", "char_js", "word_js", "kept"]
    docs = docs.drop(*[c for c in docs.columns if c in added])
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(F.col("__t"), F.lit(" \t\n\u000b\f\r"))
    rows = docs.withColumn("__t", text).withColumn(
        "__ws", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP)))
    ws = F.col("__ws")
    lines = F.filter(F.split("__t", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\u000b\f\r"))) > 0)
    rows = rows.withColumn("__lines", lines).withColumn("n_words", F.size(ws).cast("long"))
    rows = rows.withColumns({f"__c_{k}": _left(F.col("__t"), v) for k, v in CLASSES.items()})
    rows = rows.withColumn("word_chars", F.length(F.array_join(ws, "")).cast("long")) \
        .withColumn("__c_space", F.length("__t") - F.col("word_chars")) \
        .withColumn("n_symbols", _left(F.col("__t"), "[^#*$%&|<>]+")) \
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long")) \
        .withColumn("n_repeat_words", repeat_words(ws)) \
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    named = [F.col(f"__c_{k}") for k in (*CLASSES, "space")]
    lower = F.length("__t").cast("long") - sum(named[1:], named[0])
    rows = rows.withColumn("__chars", F.array(lower, *named))
    rows = rows.withColumn("__common", _common(ws, F.col(lang_col), F.col("n_words")))
    return rows.drop("__t", "__ws", "__lines", *[f"__c_{k}" for k in (*CLASSES, "space")])


def _common(ws: Column, lang: Column, n: Column) -> Column:
    """Counts of the language's common words, then of all other words."""
    of = F.lit(None).cast("array<long>")
    for name, listed in COMMON.items():
        of = F.when(lang == name, _counts(ws, listed)).otherwise(of)
    return once(of, lambda c: F.when(c.isNotNull(), F.concat(c, F.array(n - F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)))))


def _counts(ws: Column, listed: list[str]) -> Column:
    cased = [*listed, *map(str.capitalize, listed), *map(str.upper, listed)]
    found = F.transform(F.filter(ws, lambda w: w.isin(cased)), lambda w: F.lower(w))
    many = lambda f, w: F.size(F.filter(f, lambda x: x == w)).cast("long")
    return once(found, lambda f: F.array(*[many(f, w) for w in listed]))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays of one length (null if
    either is null or sums to 0)."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def term(x, y):
        return once((x + y) / 2, lambda m: part(x, m) + part(y, m))

    def distance(s):
        div = F.aggregate(F.zip_with(s["p"], s["q"], lambda x, y: term(x / s["tp"], y / s["tq"])), F.lit(0.0), lambda a, t: a + t) / 2
        return F.when((s["tp"] > 0) & (s["tq"] > 0), F.sqrt(F.greatest(div, F.lit(0.0))))

    return once(F.struct(p.alias("p"), q.alias("q"), total(p).alias("tp"), total(q).alias("tq")), distance)


def _sums(col: str, n: int) -> list[Column]:
    return [F.sum(F.get(F.col(col), F.lit(i))).alias(f"{col}{i}") for i in range(n)]


def references(measured: DataFrame, lang_col: str = "lang") -> DataFrame:
    """Summed histograms of the documents of each language (one row per
    language value, from documents that pass the base rules)."""
    width = 1 + max(map(len, COMMON.values()))
    sums = measured.filter(~F.col("base_failed")).groupBy(F.col(lang_col).alias("__lang")) \
        .agg(*_sums("__chars", 2 + len(CLASSES)), *_sums("__common", width))
    pack = lambda c, n: F.filter(F.array(*[F.col(f"{c}{i}") for i in range(n)]), lambda x: x.isNotNull())
    return sums.select("__lang", pack("__chars", 2 + len(CLASSES)).alias("__ref_chars"),
                       pack("__common", width).alias("__ref_common"))


def quality(docs: DataFrame, char_limit: float = 0.25, word_limit: float = 0.3, guard_words: int = 100,
            text_col: str = "text", lang_col: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """The input rows (or only the columns ``carry``) with the base counts,
    ``base_failed``, ``char_js``, ``word_js`` (null under the guard) and
    ``kept``.  Texts are measured once: rows and measures are written to the
    shared folder and read again when the references are known."""
    carry = docs.columns if carry is None else carry
    measured = measure(docs, text_col, lang_col)
    mine = [c for c in carry if c in measured.columns and c not in (*COUNTS, "base_failed")]
    measured = stored(measured.select(*mine, F.col(lang_col).alias("__l"), *COUNTS, "base_failed", "__chars", "__common"), "quality-measures")
    refs = references(measured, "__l")
    rows = measured.join(refs, measured["__l"].eqNullSafe(refs["__lang"]), "left")
    long = F.col("n_words") >= guard_words
    rows = rows.withColumn("char_js", F.when(long, js_distance(F.col("__chars"), F.col("__ref_chars")))) \
        .withColumn("word_js", F.when(long & F.col("__common").isNotNull(), js_distance(F.col("__common"), F.col("__ref_common"))))
    kept = ~F.col("base_failed") & (F.coalesce("char_js", F.lit(0.0)) <= char_limit) & (F.coalesce("word_js", F.lit(0.0)) <= word_limit)
    return rows.withColumn("kept", kept).select(*mine, *COUNTS, "base_failed", "char_js", "word_js", "kept")
