"""The registered queries of this subpackage, one per operator, and their
DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op1_mix_sources")
def op1(spark, sf_dir):
    """Every document with the words that the mix takes from it."""
    from marquee.llm.mixing import plan_mix
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken",
                                 F.transform("draws", lambda d: d["shard"]).alias("shards"))


@register("op9_bpe")
def op9(spark, sf_dir):
    """Encode every text, decode it again, and digest both."""
    from marquee.llm.bpe import decode, encode
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer_path()
    rows = decode(encode(docs, path).select("doc_id", "ids"), path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@register("op4_maxscore", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id query_id, c.vec_id vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""")
def op4(spark, sf_dir):
    """Five best inner products of every fiftieth vector."""
    from marquee.llm.topk import top_k
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(rows, rows.filter(F.col("vec_id") % 50 == 0))


_BASE_QUALITY = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') ws FROM d),
k AS (SELECT doc_id, list_transform(range(1, greatest(len(ws) - 1, 1)), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2]) tri FROM w),
u AS (SELECT doc_id, unnest(tri) g, unnest(range(1, len(tri) + 1)) p FROM k),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) n FROM u) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT q) n FROM (SELECT doc_id, unnest([p, p+1, p+2]) q FROM r) GROUP BY 1),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls FROM d)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) n_words,
       CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) word_chars,
       CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) n_symbols,
       CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) n_dup_lines,
       CAST(coalesce(c.n, 0) AS BIGINT) n_repeat_words
FROM w JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)"""


@register("op6_quality_rules")
def op6(spark, sf_dir):
    """Base counts of every document, its distances and the verdict."""
    from marquee.llm.quality import quality
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality(docs, carry=["doc_id"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                "base_failed", "kept", F.round("char_js", 6).alias("char_js"), F.round("word_js", 6).alias("word_js"))


@register("op8_warc")
def op8(spark, sf_dir):
    """Write the pages' archives, read them back, assemble transactions."""
    from marquee.llm.warc import read_records, transactions, write_archive
    from marquee.session import scratch_path
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path, compression="gzip")
    rows = transactions(read_records(spark, path, payloads=False))
    return rows.select("capture.page_id", "capture.payload_bytes", "capture.payload_digest",
                       F.col("capture.type").alias("record_type"), "capture.refers_to",
                       (F.coalesce("n_request", F.lit(0)) + F.coalesce("n_metadata", F.lit(0))).alias("n_tied"))


@register("op7_repair_files")
def op7(spark, sf_dir):
    """Write the token files of all documents and read them back."""
    import zlib

    from marquee.llm.repair import read_token_files, write_token_files
    from marquee.session import scratch_path
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer_path())
    rows = read_token_files(spark, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
    return rows.withColumnRenamed("value", "ids_crc32")


@register("op10_substring_dedup")
def op10(spark, sf_dir):
    """Every document without the words that smaller ids already have."""
    from marquee.llm.substring import duplicate_spans, without_spans
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = without_spans(docs, duplicate_spans(docs))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


@register("op3_ngram_join")
def op3(spark, sf_dir):
    """Set size and component of every document."""
    from marquee.llm.ngram_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op5_line_dedup")
def op5(spark, sf_dir):
    """Per document: its lines with a word, and the lines that go."""
    from marquee.llm.line_dedup import BLANK, _row, repeated_lines
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = repeated_lines(docs)
    count = F.size(F.filter(F.split("text", "\n"), lambda x: ~x.rlike(BLANK)))
    rows = docs.select("doc_id", _row("doc_id", "text").alias("row"), F.when(F.col("text").isNull(), 0).otherwise(count).cast("long").alias("n_lines"))
    return rows.join(gone, "row", "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"))


@register("op2_pii")
def op2(spark, sf_dir):
    """Personal data of every document: base counts and all spans."""
    from marquee.llm.pii import KINDS, find_pii, listed
    rows = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(_of_kind("base", k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                       listed(F.concat("base", "found")).alias("spans"))


def _of_kind(col: str, kind: str):
    return F.filter(col, lambda s: s["kind"] == kind)


@register("op12_hard_negatives", """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id anchor, c.vec_id vec, a.label = c.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) score
      FROM e a JOIN e c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
p AS (SELECT anchor, vec, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec) <= 5)
SELECT p.anchor AS anchor_id, p.vec AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.vec ORDER BY n.score DESC, n.vec) AS INTEGER) AS rank,
       n.vec AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor = p.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3""")
def op12(spark, sf_dir):
    """Three hard negatives of each positive of every fiftieth vector."""
    from marquee.llm.hard_negatives import hard_negatives
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, label, F.col("vec_id") % 50 == 0)


@register("op13_prefix_trie", r"""
WITH t AS (SELECT conv_id c, coalesce(role, '') r, coalesce(text, '') x,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) p
           FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, own, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT))),
               lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                        lambda u, o: CASE WHEN u % 2 = 1 THEN xor(u // 2, 3988292384) ELSE u // 2 END)), 4294967295) % 4 AS BIGINT) h
      FROM (SELECT c, count(*) own FROM t GROUP BY c)),
j AS (SELECT k.c, t.p d, t.r, t.x FROM k JOIN t ON t.c = k.c - k.c % 20 AND t.p <= k.h
      UNION ALL
      SELECT k.c, t.p - k.h + least(k.h, coalesce(b.own, 0)), t.r, t.x FROM k JOIN t ON t.c = k.c AND t.p > k.h LEFT JOIN k b ON b.c = k.c - k.c % 20),
m AS (SELECT k.c, coalesce(max(j.d), 0) n FROM k LEFT JOIN j ON j.c = k.c GROUP BY k.c),
f AS (SELECT c, d, sha256(string_agg(sha256(r) || sha256(x), '') OVER (PARTITION BY c ORDER BY d)) s,
             len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) w FROM j
      UNION ALL SELECT c, 0, '', 0 FROM k),
g AS (SELECT d, s, min(f.c) conv_id, count(*) n_convs, max(w) w, sha256(coalesce(string_agg(CAST(f.c AS VARCHAR), ',' ORDER BY f.c) FILTER (WHERE m.n = d), '')) ends
      FROM f JOIN m USING (c) GROUP BY d, s),
a AS (SELECT g.*, up.s ps, pg.conv_id parent FROM g LEFT JOIN f up ON up.c = g.conv_id AND up.d = g.d - 1 LEFT JOIN g pg ON pg.d = g.d - 1 AND pg.s = up.s),
kids AS (SELECT parent, d - 1 d, count(*) n FROM a WHERE parent IS NOT NULL GROUP BY ALL),
b AS (SELECT a.*, coalesce(kids.n, 0) n_children FROM a LEFT JOIN kids ON kids.parent = a.conv_id AND kids.d = a.d),
subs AS (SELECT f.d, f.s, sum((b.n_convs - 1) * b.w) saved, count(*) FILTER (WHERE b.n_children = 0) leaves
         FROM b JOIN f ON f.c = b.conv_id AND f.d <= b.d GROUP BY f.d, f.s)
SELECT conv_id, CAST(b.d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM b JOIN subs ON subs.d = b.d AND subs.s = b.s""")
def op13(spark, sf_dir):
    """The nodes of the prefix trie of the rebuilt conversations."""
    from marquee.llm.prefix_trie import numbered_turns, prefix_trie, rebuilt
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie(rebuilt(numbered_turns(rows))).drop("enter", "leave")


@register("op11_language_id")
def op11(spark, sf_dir):
    """The language of every text, learned from four fifths of the ids."""
    from marquee.llm.lang_id import identify, train
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = train(docs, learn=fold != 0, keep=fold == 1)
    rows = docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text")
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", F.round("score", 9).alias("score"), "accepted")
