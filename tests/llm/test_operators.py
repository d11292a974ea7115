"""Edge rows and brute-force comparisons for the operators of the
training-data subpackage."""

import random
import re

import pytest
from pyspark.sql import functions as F

rng = random.Random(7)
VOCAB = [f"w{i:03d}" for i in range(300)]
BODY = " ".join(rng.choice(VOCAB) for _ in range(400))
NEAR = BODY.split()
NEAR[50] = "changed"
EDGE = [
    (1, BODY, "en", "a", "x"), (2, " ".join(NEAR), "en", "a", "x"), (3, BODY, "en", "b", "x"), (3, BODY, "en", "b", "x"),
    (4, None, "en", None, "x"), (5, "", None, "b", "x"), (6, " \n\t ", "de", "c", "x"), (None, "one two", "fr", "c", "x"),
    (7, "one", None, "c", None), (8, "word " * 30_000, "en", "a", "x"), (9, "x" * 50_000, "en", None, "x"),
    (10, "One TWO three four five six\nshort line\nshort line", "en", "c", "x"),
]
KIND = "doc_id long, text string, lang string, source string, size string"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, KIND).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KIND)


def path():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def test_targets_cap_and_reshare():
    from marquee.llm.mixing import targets
    got = targets([100, 10, 1000], (5, 2, 1), 150, 2)
    assert got[0] == 200 and got[1] == 20 and abs(sum(got) - 1665) < 1e-9
    assert targets([0, 0]) == [0, 0] and targets([]) == []


def test_splitting_tree_is_a_partition():
    import numpy as np
    from marquee.llm.mixing import SplittingTree
    counts = [100, 7, 33]
    src = np.repeat(np.arange(3), counts)
    place = np.concatenate([np.arange(c) for c in counts])
    got = SplittingTree(counts, 7, 3).shard(src, place)
    again = SplittingTree(counts, 7, 3).shard(src[::-1], place[::-1])[::-1]
    assert (got == again).all() and np.bincount(got, minlength=7).tolist() == [20] * 7


def test_mix_reaches_targets(edge, none):
    from marquee.llm.mixing import mix, plan_mix
    rows = plan_mix(edge).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert len(rows) == len(EDGE)
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault((r.source, r.target), []).append(r.taken)
    for (_, target), taken in by.items():
        assert target - 3 <= sum(taken) <= target
    assert plan_mix(none).count() == 0
    words = sum(len(r.text.split()) for r in mix(edge).select("text").collect())
    assert words == sum(r.taken for r in rows)


def test_bpe_equals_library(edge, none):
    from tokenizers import Tokenizer

    from marquee.llm.bpe import decode, encode
    lib = Tokenizer.from_file(path())
    rows = decode(encode(edge, path()), path()).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        want = lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == lib.decode(want, skip_special_tokens=False)
    assert encode(none, path()).count() == 0


def test_quality_counts(edge, none):
    from marquee.llm.quality import quality
    rows = quality(edge).collect()
    assert len(rows) == len(EDGE) and quality(none).count() == 0
    for r in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        tri = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
        many = {t for t in tri if tri.count(t) > 1} if len(ws) < 1000 else set(tri)
        hit = {i + k for i, t in enumerate(tri) if t in many for k in range(3)}
        assert (r.n_words, r.n_repeat_words) == (len(ws), len(hit))
        assert r.base_failed == (len(ws) < 50 or 2 * len(hit) > len(ws)) and not (r.base_failed and r.kept)


def test_ngram_components(edge, none):
    from marquee.llm.ngram_join import jaccard_components
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_components(edge).collect()}
    comp = {d: c for (d, _), c in got.items()}
    assert comp[1] == comp[2] == comp[3] == 1 and comp[4] == 4 and comp[5] == 5 and comp[7] == 7 and comp[None] is None
    assert dict(got.keys())[4] == 0 and dict(got.keys())[7] == 1
    assert jaccard_components(none).count() == 0


def test_components_of_a_long_chain(spark):
    from marquee.llm.linking import components
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(
        spark.createDataFrame([(1000, 1001), (1002, 1001), (5, 5)], "a long, b long"))
    got = {r.node: r.comp for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1002] == 1000


def test_line_dedup(edge, none):
    from marquee.llm.line_dedup import dedup_lines
    rows = {r.doc_id: r for r in dedup_lines(edge).collect()}
    assert rows[1].text == BODY and rows[2].text == "" and rows[3].text == "" and rows[4].text is None
    assert rows[10].removed == [2] and rows[10].text.endswith("six\nshort line") and rows[6].text == " \n\t "
    assert dedup_lines(edge).count() == len(EDGE) and dedup_lines(none).count() == 0


def test_substring_dedup(edge, none):
    from marquee.llm.substring import duplicate_spans, without_spans
    rows = {r.doc_id: r for r in without_spans(edge, duplicate_spans(edge)).collect()}
    assert rows[1].n_removed == 0 and rows[3].n_removed == 400 and rows[2].kept_words == "changed"
    assert (rows[4].n_words, rows[None].n_removed, rows[8].n_removed) == (0, 0, 0)
    assert without_spans(none, duplicate_spans(none)).count() == 0


def test_token_files_round_trip(edge, none, tmp_path):
    from tokenizers import Tokenizer

    from marquee.llm.repair import compress, expand, id_range, read_token_files, write_token_files
    import numpy as np
    ids = np.array([5, 6, 7] * 400 + [9] + [5, 6] * 300)
    last = np.zeros(len(ids), bool)
    last[[1200, len(ids) - 1]] = True
    rules, lengths, sym, first = compress(ids, last)
    assert len(sym) < len(ids) / 2 and (expand(sym, rules) == ids).all() and (expand(sym[first[1]:], rules) == ids[1201:]).all()
    assert (id_range(sym, rules, lengths, 1000, 1300) == ids[1000:1300]).all()
    lib, spark = Tokenizer.from_file(path()), edge.sparkSession
    write_token_files(edge, str(tmp_path / "t"), path())
    rows = read_token_files(spark, str(tmp_path / "t"), lambda i: int(i.sum())).collect()
    want = {}
    for d, t, *_ in EDGE:
        want.setdefault(d, []).append(lib.encode(t or "", add_special_tokens=False).ids + [1])
    assert len(rows) == len(EDGE) and all((r.n_tokens, r.value) in [(len(i), sum(i)) for i in want[r.doc_id]] for r in rows)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    write_token_files(none, str(tmp_path / "e"), path())
    assert read_token_files(spark, str(tmp_path / "e"), lambda i: 0).count() == 0


def test_top_k(spark):
    from marquee.llm.topk import top_k
    rows = [(i, [rng.uniform(-1, 1) for _ in range(40)]) for i in range(120)]
    rows += [(200, None), (201, [None] + [0.0] * 39), (202, [float("nan")] * 40), (203, rows[3][1]), (204, []), (205, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    import numpy as np
    ok = {i: np.floor(256 * np.float32(v).astype(float)) for i, v in rows[:120] + [rows[123]]}
    got = {}
    for r in top_k(df, df.filter("vec_id % 10 = 0"), shard_rows=30).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 120, 10):
        best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert top_k(df.limit(0), df.limit(0)).count() == 0


def test_warc_transactions(spark, tmp_path):
    from marquee.llm.warc import read_records, transactions, write_archive
    pages = [(1, "http://a/1", "<p>é\r\n\r\nWARC/1.1\r\n</p>"), (2, "http://a/2", "same"), (5, None, "same"), (3, "http://a\n3", None),
             (4, "u", ""), (None, "n", "null id")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    write_archive(df, str(tmp_path / "w"))
    rows = {r.capture.page_id: r for r in transactions(read_records(spark, str(tmp_path / "w"))).collect()}
    assert len(rows) == 6 and all(r.n_request == r.n_metadata == 1 for r in rows.values())
    assert rows[2].capture.type == "revisit" and rows[2].capture.refers_to == 5 and rows[5].capture.type == "response"
    assert bytes(rows[1].capture.payload).decode() == pages[0][2] and rows[3].capture.refers_to == 4


def test_pii_bootstrap(spark):
    from marquee.llm.pii import find_pii, listed
    rows = [(i, f"text {i} hotline: +1 (456) 555-2{i}86 and more words here") for i in range(10)]
    rows += [(20, "call hotline: 555-238671 now"), (21, "the 555-238671 items"), (22, None), (23, "a@b.c_d@e.f 1.2.3.400 1.2.3.4"),
             (24, "é 4111 1111 1111 1111 and 4111111111111112")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.b, r.f) for r in find_pii(df).select("doc_id", listed("base").alias("b"), listed("found").alias("f")).collect()}
    assert got[0] == ("phone:16:33", "") and got[20] == ("", "phone:14:24") and got[21] == ("", "") and got[22] == ("", "")
    assert got[23][0] == "email:0:5,email:5:11,ip:22:29" and got[24][0] == "card:2:21"
    assert find_pii(df.limit(0)).count() == 0


def test_line_dedup_of_long_lines(spark):
    from marquee.llm.line_dedup import dedup_lines
    r = random.Random(5)
    def han(n): return "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(n))
    docs = []
    for i in range(40):                                     # no spaces, the first characters differ
        line = han(400)
        docs += [(2 * i, line), (2 * i + 1, chr(0x3041 + i) + line[i % 2:])]
    docs += [(100, "|".join(["a"] * 125)), (101, "|" + "|".join(["a"] * 130))]   # periodic, 249 and 260 characters
    base = han(249)
    docs += [(102, base), (103, han(3) + base)]             # 249 and 252 characters
    got = {x.doc_id: x.removed for x in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [i for i, x in got.items() if bool(x) != (i % 2 == 1)] == []


def test_repair_of_long_copies():
    import numpy as np

    from marquee.llm.repair import compress, expand
    one = np.arange(100, 500)
    ids, last = np.tile(one, 1000), np.tile(one == 499, 1000)
    rules, lengths, sym, first = compress(ids, last)
    assert len(sym) == 1000 and len(rules) == 399 and lengths.max() == 400 and (expand(sym, rules, lengths) == ids).all()
    assert first.tolist() == list(range(1000))
    r = np.random.default_rng(3)
    for k, n in ((2, 5000), (3, 5000), (1, 1000), (40, 60_000), (2000, 60_000)):
        ids = np.minimum(r.integers(0, k, n), r.integers(0, k, n))
        last = r.random(n) < 0.01
        last[-1] = True
        rules, lengths, sym, first = compress(ids, last)
        assert (expand(sym, rules) == ids).all() and (expand(sym, rules, lengths) == ids).all()
        stop = np.append(first[1:], len(sym))
        docs = [expand(sym[a:b], rules, lengths) for a, b in zip(first, stop)]
        assert [len(d) for d in docs] == np.diff(np.append(-1, np.flatnonzero(last))).tolist()
        seen, left = {}, -1                                 # no pair is left that occurs 24 times without overlap
        for a, b in zip(first, stop):
            left = -1
            for i in range(a, b - 1):
                p = (sym[i], sym[i + 1])
                if p[0] != p[1] or left != i:
                    seen[p] = seen.get(p, 0) + 1
                    left = i + 1 if p[0] == p[1] else -1
        assert max(seen.values(), default=0) < 24


def test_pii_of_a_copied_corpus(spark):
    from marquee.llm.pii import find_pii, listed
    rows = [f"mail: user{i}@host{i}.org and hotline: +1 (456) 555-2{i}86 and more words here" for i in range(8)]
    some = {"ask mail: root@localhost now": "email:10:24", "call hotline: (030) 123 45 67, again": "phone:14:29",
            "call hotline: 030 123456. 5 more": "phone:14:24", "call hotline: 030 1234 10.0.0.1 next": "phone:14:22",
            "the hotline is 030 123 45 67": "", "call hotline: 12 34 56 78 90 12 34 56 78 90": "phone:14:34"}
    for copies in (1, 3, 20):
        df = spark.createDataFrame([(t,) for t in [*rows, *some] * copies], "text string")
        got = find_pii(df).select("text", listed("found").alias("f")).collect()
        assert len(got) == copies * len([*rows, *some])
        assert {(r.text, r.f) for r in got} == {*some.items(), *((t, "") for t in rows)}


def test_warc_payloads_and_file_sizes(spark, tmp_path):
    from marquee.llm.warc import read_records, transactions, write_archive
    pages = [(i, f"http://a/{i}", chr(97 + i % 7) * (50_000 * (i % 5) + 10)) for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    write_archive(df, str(tmp_path / "w"), file_bytes=400_000)
    files = list((tmp_path / "w").glob("part-*"))
    assert max(f.stat().st_size for f in files) <= 400_000
    rows = {r.capture.page_id: r for r in transactions(read_records(spark, str(tmp_path / "w"))).collect()}
    assert len(rows) == 60 and all(r.n_request == r.n_metadata == 1 for r in rows.values())
    text = {i: t for i, _, t in pages}
    for i, r in rows.items():
        assert text[r.capture.refers_to if r.capture.type == "revisit" else i] == text[i]
        assert r.capture.type == "revisit" or bytes(r.capture.payload).decode() == text[i]
    (tmp_path / "bad").mkdir()
    for f in files:
        (tmp_path / "bad" / f.name).write_bytes(f.read_bytes().replace(b"aaaa", b"aaab", 1))
    with pytest.raises(Exception, match="payload differs from its digest"):
        read_records(spark, str(tmp_path / "bad"), payloads=False).collect()


def test_substring_dedup_of_a_shared_id(spark):
    from marquee.llm.substring import duplicate_spans, without_spans
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    docs = [(1, a), (2, "x " + a), (2, b + " " + b), (2, b + " " + b), (3, b)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.text): (r.n_removed, r.kept_words) for r in without_spans(df, duplicate_spans(df)).collect()}
    assert got == {docs[0]: (0, a), docs[1]: (40, "x"), docs[2]: (0, b + " " + b), docs[4]: (40, "")}


def brute_spans(text):
    """Base spans by plain leftmost matching."""
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                good = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                two = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                good = 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in two) % 10 == 0
            else:
                good = kind == "email" or 8 <= len(digits) <= 15
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii_base_spans_equal_brute_force(spark, edge, none):
    from marquee.llm.pii import find_pii, listed
    r = random.Random(9)
    parts = ["a@b.org", "x.y@h-1.co.uk", "@", "4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.1", "1.2.3.400", "1.2.3.4.5", "+1 (456) 555-2386",
             "+49", "12", "é", "😀", " ", " ", "\n", "\u00a0", "-", ".", "(", "call", "id:", "0000000000000000"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(1, 40))) for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(i, t, "kept", t) for i, t in enumerate(texts)], "doc_id long, text string, base string, word string")
    rows = find_pii(df).select("doc_id", "word", listed("base").alias("b")).collect()
    assert len(rows) == len(texts)
    assert [(x.doc_id, x.b) for x in rows if x.b != brute_spans(texts[x.doc_id]) or x.word != texts[x.doc_id]] == []
    got = find_pii(edge).select("doc_id", "text", "size", listed("base").alias("b"), listed("found").alias("f")).collect()
    assert len(got) == len(EDGE) and all(x.b == brute_spans(x.text) and x.f == "" for x in got)


def test_pii_of_texts_full_of_numbers(spark):
    from marquee.llm.pii import find_pii, listed
    seeds = [(i, f"code{'x' * 90}: +1 (456) 555-2{i}86 end") for i in range(9)]      # a context word of 95 characters
    many = " ".join(str(100_000 + 7 * i) for i in range(20_000))
    mails = ", ".join(f"u{i}@h.org 4111 1111 1111 1111" for i in range(4_000))
    more = [(20, many), (21, mails), (22, f"code{'x' * 90}:{' ' * 100}555-238671 now")]
    got = {x.doc_id: x for x in find_pii(spark.createDataFrame(seeds + more, "doc_id long, text string"))
           .select("doc_id", "text", listed("base").alias("b"), listed("found").alias("f")).collect()}
    assert all(x.b == brute_spans(x.text) for x in got.values())
    assert got[21].b.count(":") == 16_000 and got[20].f == got[21].f == ""
    at = 95 + 100
    assert got[22].f == f"phone:{at}:{at + 10}"


def test_mix_replaces_clashing_columns(spark):
    from marquee.llm.mixing import mix
    df = spark.createDataFrame([(i, "one two three", "a", "p", "s", "x") for i in range(4)],
                               "doc_id long, text string, source string, pass string, shard string, pos string")
    rows = mix(df).select("doc_id", "pass", "shard", "pos").collect()
    assert len(rows) == 6 and all(isinstance(r["pass"], int) and isinstance(r.shard, int) and isinstance(r.pos, int) for r in rows)


def test_near_copies_are_sought_where_texts_lie(spark):
    """Texts and sets are not moved to be joined with ids: a bitmap of the
    ids goes to them, keeps every wanted row and drops nearly all others."""
    from marquee.llm.common import among
    rows = spark.range(-3000, 60000).select("id", F.concat(F.lit("text "), "id").alias("text"))
    ids = spark.range(-3000, 60000, 30).select(F.col("id").alias("other"))
    left = among(rows, "id", ids)
    got = [r.id for r in left.collect()]
    want = set(range(-3000, 60000, 30))
    assert want <= set(got) and len(got) == len(set(got)) < 1.15 * 63000 / 30 + 0.1 * 63000
    assert left.columns == rows.columns and among(rows, "id", ids.limit(0)).count() == 0
    assert set(range(-3000, 60000, 30)) <= {r.id for r in among(rows, "id", ids, most=1 << 10).collect()}    # a full bitmap drops less
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan.split("Join Inner")[-1].split("\n")[0] or "rightHint=(strategy=broadcast)" in plan


def test_plain_words_are_encoded_without_the_splitter():
    """Letters, with or without a last mark, are cut without a pattern; ids
    stay those of the library."""
    from tokenizers import Tokenizer

    from marquee.llm.repair import LibraryWords
    lib, words = Tokenizer.from_file(path()), LibraryWords(path())
    ids = lambda w: tuple(lib.encode(w, add_special_tokens=False).ids)
    odd = ["a.b", "..", ".", "x,.", "don't", "Straße,", "ΣΑΣ.", "é", "͸a", "<|endoftext|>.", "a<|endoftext|>", "12,", "東京."]
    assert [tuple(x) for x in words([w.encode() for w in odd])] == [ids(w) for w in odd]

    def fail(word):
        raise AssertionError(word)

    words.cut.pieces = fail
    plain = ["Plain", "WORD,", "end.", "word", "a", "A.", "Unbelievableness"]
    assert [tuple(x) for x in words([w.encode() for w in plain])] == [ids(w) for w in plain]
