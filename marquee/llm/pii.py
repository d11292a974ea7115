"""Personal data by bootstrapped contextual extraction (operator 2), native.

Base entities come from patterns: e-mail addresses, IPv4 numbers, payment
cards (Luhn) and phone numbers, leftmost and without overlap per kind.
They seed the bootstrap.  An entity's lexical pattern is the word before
it (the last word of the stretch from the previous match of the same
expression, itself included, to the entity, of any length; none if that
stretch has no word).  Instances are the texts that stand behind a pattern: base entities, and
other identifier-like words, or runs of several groups of digits, fit for a
kind (of a run, the longest stretch of whole groups that is fit; a run ends
before a base entity).  Patterns and instances form a bipartite graph, scored
in rounds: a pattern's confidence is the summed score of the occurrences of
its instances of a kind over how often the pattern's word occurs in the corpus
at all, so copies of texts change neither the one nor the other's share; an
instance's score is the highest confidence of its patterns (seeds stay at 1).
Instances behind a pattern of enough confidence and support (distinct seeds)
become new spans.

Base matching equals plain leftmost matching: the possessive forms below
only keep Java's engine from backtracking over, or restarting within, a run
of characters where that can change nothing.

Defined results: a null text counts as empty; positions are code points,
end exclusive; new spans never overlap base spans of the same row and are
never base spans; repeated rows get the same spans; no rows, no output.
Overlaps are found by sweeps over sorted spans, positions by prefix sums, so
work within a text of n spans grows as n^(4/3) array moves at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import GAP, stored, words
from marquee.llm.quality import once

KINDS = ("email", "ip", "card", "phone")
# The base patterns (see above for their form) and, per kind,
# a test that a text must pass before its pattern is tried.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRIED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
SPAN = "array<struct<kind:string,start:int,stop:int,text:string>>"
_FAR = 2**31 - 1
MORE = "array<struct<start:int,stop:int,text:string,kinds:array<string>,word:string>>"


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (part(p).try_cast("int") <= 255))

    def luhn(d):
        n = F.length(d)
        total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + once(
            F.substr(d, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
        return total % 10 == 0

    return once(digits, lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))


def _scan(values: Column, kind: str, unit: int, op) -> Column:
    """What ``op`` makes of all values before each one (``unit`` before the
    first): within short stretches, over the stretches, then together, since
    an array grows by copying."""
    def fold(v):
        none = F.struct(F.lit(unit).cast(kind).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(v, none, lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def run(v):
        side = F.ceil(F.cbrt(F.size(v))).cast("int")
        local = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / side).cast("int") - 1), lambda k: fold(F.slice(v, k * side + 1, side)))
        return once(local, lambda w: F.flatten(F.zip_with(w, fold(F.transform(w, lambda s: s["at"]))["out"],
                                                          lambda s, o: F.transform(s["out"], lambda x: op(o, x)))))

    return once(values, lambda v: F.when(F.size(v) > 0, run(v)).otherwise(F.array().cast(f"array<{kind}>")))


def _around(spans: Column, others: Column) -> Column:
    """Per span (sorted by start): ``reach``, the last end of the others that
    start no later, and ``next``, the first start of the others after it."""
    marks = F.array_sort(F.concat(
        F.transform(others, lambda s: F.struct(s["start"].alias("start"), F.lit(False).alias("own"), s["stop"].alias("stop"))),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(True).alias("own"), s["stop"].alias("stop")))))

    def swept(m):
        reach = _scan(F.transform(m, lambda x: F.when(x["own"], 0).otherwise(x["stop"])), "int", 0, F.greatest)
        after = F.reverse(_scan(F.reverse(F.transform(m, lambda x: F.when(x["own"], _FAR).otherwise(x["start"]))), "int", _FAR, F.least))
        rows = F.zip_with(F.zip_with(reach, after, lambda r, n: F.struct(r.alias("reach"), n.alias("next"))), m,
                          lambda x, y: F.struct(x["reach"].alias("reach"), x["next"].alias("next"), y["own"].alias("own")))
        return F.filter(rows, lambda x: x["own"])

    return once(marks, swept)


def _matches(text: Column, tried: Column, pattern: str) -> Column:
    """All matches, and the pieces before each (to be placed)."""
    found = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return F.when(tried, found).otherwise(F.struct(F.array().cast("array<string>").alias("gaps"), F.array().cast("array<string>").alias("found")))


def _placed(s: Column) -> Column:
    """array<struct<start, stop, text, word>> of matches: the pieces between
    them give the positions, a match and the piece after it the word before
    the next match."""
    gaps = F.slice(s["gaps"], F.lit(1), F.size(s["found"]))
    size = F.zip_with(gaps, s["found"], lambda g, m: F.length(g) + F.length(m))
    last = F.slice(F.concat(F.array(F.lit("")), s["found"]), F.lit(1), F.size(s["found"]))
    parts = F.arrays_zip(_scan(size, "int", 0, lambda x, y: x + y).alias("at"), gaps.alias("gap"), last.alias("last"), s["found"].alias("m"))

    def one(x):
        a = x["at"] + F.length(x["gap"])
        return F.struct(a.alias("start"), (a + F.length(x["m"])).alias("stop"), x["m"].alias("text"),
                        _last_word(F.concat(x["last"], x["gap"])).alias("word"))

    return F.transform(parts, one)


def _last_word(text: Column) -> Column:
    return F.lower(F.substring_index(F.rtrim(F.regexp_replace(text, GAP, " ")), " ", -1))


def with_base(rows: DataFrame) -> DataFrame:
    """The rows with ``__base``: all base entities of ``__t``, by kind as
    listed, then by start."""
    digits = F.regexp_like("__t", F.lit("[0-9](?:[ -]?[0-9]){15}"))
    tried = {k: digits if TRIED[k] is None else F.contains("__t", F.lit(TRIED[k])) for k in KINDS}
    rows = rows.withColumn("__all", F.array(*[_matches(F.col("__t"), tried[k], PATTERN[k]) for k in KINDS]))
    rows = rows.withColumn("__all", F.transform("__all", _placed))

    def checked(kind, found):
        return F.transform(F.filter(found, lambda s: _valid(kind, s["text"])), lambda s: F.struct(
            F.lit(kind).alias("kind"), *[s[c].alias(c) for c in ("start", "stop", "text", "word")]))

    return rows.withColumn("__base", F.concat(*[checked(k, F.get("__all", F.lit(i))) for i, k in enumerate(KINDS)])).drop("__all")


def _fit(word: Column) -> Column:
    """Kinds that an identifier-like word may be."""
    digits = F.length(F.regexp_replace(word, "[^0-9]", ""))
    kinds = F.array(
        F.when(word.rlike(r"^[^@]+@[^@]+$"), F.lit("email")),
        F.when(word.rlike(r"^[0-9A-Fa-f]{0,4}([.:][0-9A-Fa-f]{0,4}){3,7}$"), F.lit("ip")),
        F.when(digits.between(12, 19) & ~word.rlike("[A-Za-z]"), F.lit("card")),
        F.when(digits.between(6, 15) & ~word.rlike("[A-Za-z]"), F.lit("phone")))
    return F.filter(kinds, lambda k: k.isNotNull())


# brackets and quotes before an identifier, but not the bracket of its own first group: (030) 12
_HEAD = r"^[\"'(<\[{]*?(?=\([0-9+][^()]*\).*[0-9])|^[\"'(<\[{]+"
_EDGE = _HEAD + r"|[\"')>\]},;.!?]+$"
_HAS = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*"
# Runs of digits of several groups, by kind: as many digits as ``_fit`` asks for.
_RUN = {kind: rf"(?<![^\x20\x09-\x0D])[\"'(<\[{{+]{{0,3}}[0-9](?:(?:\.(?=[0-9])|[\x20()/-]){{0,3}}[0-9]){{{low - 1},{high - 1}}}"
              r"(?=[\"')>\]},;.!?]*(?:[\x20\x09-\x0D]|\z))" for kind, low, high in (("card", 12, 19), ("phone", 6, 15))}


def with_context(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with ``__base`` and ``__more``: base spans and other
    identifier-like words, each with the word before it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = with_base(docs.withColumn("__t", text))

    def headed(r, x):
        """The run up to the first base entity in it, if a whole group ends there."""
        stop = F.when(x["reach"] > r["start"], r["start"]).when(x["next"] < r["stop"], x["next"])
        head = F.substr(r["text"], F.lit(1), F.greatest(stop - r["start"], F.lit(0)))
        cut = F.when(head.rlike(r"[0-9)] +$"), F.regexp_replace(head, r"[^0-9)]+$", "")).otherwise(F.lit(""))
        return F.struct(r["start"].alias("start"), F.when(stop.isNull(), r["text"]).otherwise(cut).alias("text"), r["word"].alias("word"))

    def trimmed(kinds):
        def one(w):
            head = F.length(w["text"]) - F.length(F.regexp_replace(w["text"], _HEAD, ""))
            parts = F.struct((w["start"] + head).alias("start"), F.regexp_replace(w["text"], _EDGE, "").alias("core"))
            return once(parts, lambda p: F.struct(p["start"].alias("start"), (p["start"] + F.length(p["core"])).alias("stop"),
                                                  p["core"].alias("text"), kinds(p["core"]).alias("kinds"), w["word"].alias("word")))
        return one

    def only(kind):
        return lambda core: F.filter(_fit(core), lambda k: k == kind)

    def without(kind):
        """A word's kinds but the one of which a run covers it."""
        def one(w, x):
            free = (x["reach"] <= w["start"]) & (x["next"] >= w["stop"])
            return F.struct(w["start"].alias("start"), w["stop"].alias("stop"), w["text"].alias("text"),
                            F.filter(w["kinds"], lambda k: free | (k != kind)).alias("kinds"), w["word"].alias("word"))
        return one

    def apart(w, x):
        return F.when((x["reach"] <= w["start"]) & (x["next"] >= w["stop"]) & (F.length(F.regexp_replace(w["text"], _EDGE, "")) >= 5), w)

    # one column per step: no lambda names a column that would be computed
    # again, and the analyzer's rounds grow with the depth of an expression
    t = F.col("__t")
    some = F.regexp_like(t, F.lit(r"[0-9][\x20()./-]+[0-9]"))
    found = [_matches(t, some, _RUN[k]) for k in _RUN] + [_matches(t, F.regexp_like(t, F.lit("[0-9@]")), _HAS)]
    rows = rows.withColumn("__all", F.array(*found)).withColumn("__all", F.transform("__all", _placed))
    rows = rows.withColumn("__near", F.transform("__all", lambda f: _around(f, F.col("__base"))))
    pair = lambda i, use: F.zip_with(F.get("__all", F.lit(i)), F.get("__near", F.lit(i)), use)
    for i, kind in enumerate(_RUN):
        run = F.transform(F.filter(pair(i, headed), lambda r: r["text"] != ""), trimmed(only(kind)))
        rows = rows.withColumn(f"__{kind}", F.filter(run, lambda r: F.size(r["kinds"]) > 0))
    rows = rows.withColumn("__f", F.transform(F.filter(pair(2, apart), lambda w: w.isNotNull()), trimmed(_fit)))
    rows = rows.withColumn("__near", F.transform(F.array(*[f"__{k}" for k in _RUN]), lambda r: _around(F.col("__f"), r)))
    left = F.col("__f")
    for i, kind in enumerate(_RUN):
        left = F.zip_with(left, F.get("__near", F.lit(i)), without(kind))
    rows = rows.withColumn("__more", F.concat("__card", "__phone", F.filter(left, lambda w: F.size(w["kinds"]) > 0)).cast(MORE))
    return rows.drop("__all", "__near", "__f", *[f"__{kind}" for kind in _RUN])


def patterns(narrow: DataFrame, texts: DataFrame, text_col: str = "text", rounds: int = 3,
             confidence: float = 0.5, support: int = 5) -> DataFrame:
    """(kind, word, conf) of the patterns that may discover."""
    seeds = narrow.select(F.explode("__base").alias("s")).select("s.kind", "s.word", "s.text").withColumn("seed", F.lit(True))
    more = narrow.select(F.explode("__more").alias("m")).select(F.explode("m.kinds").alias("kind"), "m.word", "m.text") \
        .withColumn("seed", F.lit(False))
    graph = seeds.unionByName(more).filter("word <> ''").groupBy("kind", "word", "text", "seed").agg(F.count("*").alias("times"))
    lexical = graph.filter("seed").groupBy("kind", "word").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= support)
    # how often a pattern's word occurs at all: counted per word first, over
    # every text, so that no word is shuffled once for each occurrence
    total = texts.select(F.explode(words(F.lower(F.coalesce(F.col(text_col), F.lit(""))))).alias("word")) \
        .groupBy("word").agg(F.count("*").alias("total"))
    lexical = stored(lexical.join(total, "word"), "pii-patterns")
    graph = stored(graph.join(lexical, ["kind", "word"], "left_semi"), "pii-graph")
    score = graph.select("kind", "text", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("score")).groupBy("kind", "text").agg(F.max("score").alias("score"))
    scored = None
    for _ in range(rounds):
        scored = graph.join(score, ["kind", "text"]).groupBy("kind", "word").agg(F.sum(F.col("score") * F.col("times")).alias("mass"), F.sum("times").alias("n")) \
            .join(lexical, ["kind", "word"]).withColumn("conf", F.col("mass") / F.greatest("n", "total"))
        scored = stored(scored.select("kind", "word", "conf"), "pii-scores")
        score = graph.join(scored, ["kind", "word"]).groupBy("kind", "text") \
            .agg(F.max(F.when(F.col("seed"), 1.0).otherwise(F.col("conf"))).alias("score"))
        score = stored(score, "pii-instances")
    return scored.filter(F.col("conf") >= confidence)


def find_pii(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The input rows with ``base`` and ``found``: base spans, and the spans
    that high-confidence patterns add (kind, start, stop, text)."""
    docs = docs.drop(*[c for c in ("base", "found") if c in docs.columns])
    keyed = docs.withColumn("__row", F.xxhash64(F.col(text_col)))
    # the filter comes after the write: Catalyst would move it below the steps
    # that make its columns, and compute them many times over
    narrow = stored(with_context(keyed, text_col).select("__row", "__base", "__more"), "pii-spans") \
        .filter((F.size("__base") > 0) | (F.size("__more") > 0))
    good = patterns(narrow, docs, text_col, **options)
    new = narrow.select("__row", F.explode("__more").alias("m")).select("__row", "m.*").withColumn("kind", F.explode("kinds")) \
        .join(good, ["kind", "word"]).groupBy("__row", "start").agg(F.max_by(F.struct("kind", "stop", "text"), F.struct("conf", "kind", "stop")).alias("s")) \
        .select("__row", "start", "s.*").groupBy("__row").agg(F.sort_array(F.collect_set(F.struct("kind", "start", "stop", "text"))).alias("found"))
    plain = F.transform("__base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["text"].alias("text")))
    out = with_base(keyed.withColumn("__t", F.coalesce(F.col(text_col), F.lit("")))).join(new, "__row", "left")
    return out.withColumn("base", plain.cast(SPAN)).withColumn("found", F.coalesce("found", F.array().cast(SPAN))) \
        .select(*docs.columns, "base", "found")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, by kind as listed, then start, joined by
    commas."""
    order = F.array(*[F.lit(k) for k in KINDS])
    rows = F.sort_array(F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"),
                                                        s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
