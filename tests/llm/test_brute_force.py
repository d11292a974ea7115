"""Operators without SQL against brute force on small random corpora, with
columns named like those the operators add."""

import gzip
import hashlib
import random
import re
from base64 import b32encode
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def union(links, nodes):
    """Smallest node of each node's component."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def corpus(seed, n=60):
    """Texts with copies, edited copies and shared passages."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)] + ["É", "ǅ", "a b", "X", "😀"]
    passage = [r.choice(vocab) for _ in range(40)]
    texts = []
    for i in range(n):
        ws = [r.choice(vocab) for _ in range(r.choice((0, 1, 4, 5, 12, 13, 14, 60, 90)))]
        if texts and i % 3 == 0:
            ws = WORD.findall(r.choice(texts) or "")
            for _ in range(r.choice((0, 1, 2, 6))):
                if ws:
                    ws[r.randrange(len(ws))] = r.choice(vocab)
        if i % 4 == 1:
            cut = r.randrange(20)
            at = r.randrange(len(ws) + 1)
            ws[at:at] = passage[cut:cut + r.choice((12, 13, 20))]
        texts.append("".join(w + r.choice((" ", "\n", "\t ", "  ")) for w in ws))
    return texts + [None, "", " \n", "w1 w2 w3", "W1 w2 W3", texts[7], texts[7]]


def frame(spark, texts, names=()):
    """doc_id in another order than the rows, and clashing extra columns."""
    extra = "".join(f", {n} string" for n in names)
    rows = [(i * 7 % 1009, t, *("own" for _ in names)) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, f"doc_id long, text string{extra}").repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(spark, seed):
    from marquee.llm.ngram_join import jaccard_components
    rows, df = frame(spark, corpus(seed), ("component_id", "n_shingles", "bkt", "row"))
    sets = {}
    for d, t, *_ in rows:
        ws = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")]
        sets[d] = {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = union(links, ids)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect()}
    assert links and got == {d: (len(sets[d]), comp[d]) for d in ids}


@pytest.mark.parametrize("seed", [3, 4])
def test_substring_dedup(spark, seed):
    from marquee.llm.substring import duplicate_spans, without_spans
    rows, df = frame(spark, corpus(seed), ("n_words", "n_removed", "kept_words", "row", "spans"))
    words = {d: WORD.findall(t or "") for d, t, *_ in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 12):
            first.setdefault(tuple(words[d][i:i + 13]), d)
    want = {}
    for d, ws in words.items():
        gone = {i + k for i in range(len(ws) - 12) if first[tuple(ws[i:i + 13])] < d for k in range(13)}
        want[d] = (len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_words) for r in without_spans(df, duplicate_spans(df)).collect()}
    assert any(n for _, n, _ in want.values()) and got == want


def test_line_dedup(spark):
    from marquee.llm.line_dedup import dedup_lines
    r = random.Random(6)
    lines = []
    for i in range(90):
        line = " ".join(r.choice(["alpha", "beta", "gamma", "delta", "kilo", "lima", "mike", "oscar"]) + str(r.randrange(30)) for _ in range(14))
        if i % 3 == 2:      # few characters changed: similar enough, or nearly so
            line = list(r.choice(lines))
            for _ in range(r.choice((0, 1, 1, 2, 3))):
                line[r.randrange(len(line))] = "#"
            line = "".join(line)
        lines.append(line)
    texts = ["\n".join(r.choice(lines + ["", "  ", "short"]) for _ in range(r.randrange(1, 7))) for _ in range(60)] + [None, "", "\n"]
    rows, df = frame(spark, texts, ("removed", "line", "bands", "key"))
    shingles = lambda s: {s[i:i + 10] for i in range(len(s) - 9)} or {s}
    sets = {x: shingles(x) for t in texts for x in (t or "").split("\n") if WORD.search(x)}
    names = sorted(sets)
    links = [(a, b) for a in names for b in names if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = union(links, names)
    seen, want = set(), {}
    for d, t, *_ in sorted(rows, key=lambda x: x[0]):
        gone = []
        for no, x in enumerate((t or "").split("\n")):
            if x in comp:
                if comp[x] in seen:
                    gone.append(no)
                seen.add(comp[x])
        want[d] = gone
    got = {x.doc_id: x for x in dedup_lines(df).collect()}
    assert links and {d: x.removed for d, x in got.items()} == want
    for d, t, *_ in rows:
        left = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[d])
        assert got[d].text == left and got[d].line == got[d].bands == "own"


def test_quality_base_columns_equal_sql(spark):
    import duckdb

    from marquee.llm.queries import _BASE_QUALITY, QUERIES
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({_BASE_QUALITY})").fetchall())
    rows = QUERIES["op6_quality_rules"](spark, path).select(*names, "base_failed", "kept").collect()
    assert sorted(tuple(r)[:6] for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) and not (r.base_failed and r.kept)


def test_quality_counts_of_odd_texts(spark):
    from marquee.llm.quality import quality
    texts = corpus(8) + ["a\n a\na\n\n \nb | # <x>", "a b c a b c a b", "x " * 60, "é é # \x1c|"]
    rows, df = frame(spark, texts, ("n_words", "kept", "base_failed", "char_js"))
    got = {r.doc_id: r for r in quality(df.withColumn("lang", F.lit(None).cast("string"))).collect()}
    for d, t, *_ in rows:
        ws = WORD.findall(t or "")
        tri = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
        many = {g for g in tri if tri.count(g) > 1}
        repeat = {i + k for i, g in enumerate(tri) if g in many for k in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == \
            (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(repeat))


def test_mix_plan(spark):
    """Targets in exact fractions; what is taken, counted from the mix."""
    from marquee.llm.mixing import mix, plan_mix
    r = random.Random(10)
    names = ["zeta", "Alpha", "beta", "😀", "￿", None, ""]
    rows = [(i, " ".join("w" for _ in range(r.choice((0, 1, 30, 200)))) if i % 17 else None, r.choice(names[:2] + names), "own", "own")
            for i in range(150)] + [(None, "one two", "beta", "own", "own")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, taken string").repartition(4)
    size = lambda t: len(WORD.findall(t or ""))
    order = sorted({x[2] for x in rows if x[2] is not None}) + [None]
    sums = {s: sum(size(x[1]) for x in rows if x[2] == s) for s in order}
    weigh = {s: Fraction((5, 2, 1)[i % 3]) for i, s in enumerate(order)}
    want, left, open_ = {}, Fraction(3 * sum(sums.values()), 2), set(order)
    while open_:
        share = {s: left * weigh[s] / sum(weigh[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sums[s]}
        for s in full or open_:
            want[s] = Fraction(2 * sums[s]) if full else share[s]
        left -= sum(want[s] for s in full)
        open_ = open_ - full if full else set()
    got = plan_mix(df).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert len(got) == len(rows)
    for s in order:
        some = [x for x in got if x.source == s]
        assert all(x.source_size == sums[s] and abs(x.target - want[s]) < 1e-6 for x in some)
        assert abs(sum(x.taken for x in some) - want[s]) <= 3
    texts = {x[0]: x[1] for x in rows}
    assert all(x.size == size(texts[x.doc_id]) and 0 <= x.taken <= 2 * x.size for x in got)
    assert sorted((x.doc_id or -1, x.taken) for x in got) == sorted((x.doc_id or -1, x.taken) for x in plan_mix(df.repartition(2)).collect())
    drawn = {}
    for x in mix(df).select("doc_id", "text").collect():
        drawn[x.doc_id] = drawn.get(x.doc_id, 0) + size(x.text)
    assert drawn == {x.doc_id: x.taken for x in got if x.taken}


def test_warc_digests_and_compression(spark, tmp_path):
    from marquee.llm.warc import read_records, transactions, write_archive
    pages = [(1, "u", "<p>é😀</p>", "x"), (2, "u", "same", "x"), (2, "u", "same", "x"), (1, "v", "same", "x"), (3, None, None, "x"),
             (4, "u", "", "x"), (None, "u", "same", "x"), (9, "w", "long " * 20_000, "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, digest string")
    best = {}
    for i, _, h, _ in pages:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h, _ in pages:
        raw = (h or "").encode()
        again = best[h or ""] != (-1 if i is None else i)
        want.append((i, len(raw), b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", best[h or ""] if again else None))
    key = lambda x: tuple(map(str, x))
    for kind in ("none", "gzip"):
        path = tmp_path / kind
        write_archive(df, str(path), compression=kind)
        assert all((f.read_bytes()[:2] == b"\x1f\x8b") == (kind == "gzip") for f in path.glob("part-*"))
        rows = transactions(read_records(spark, str(path))).select(
            "capture.page_id", "capture.payload_bytes", "capture.payload_digest", "capture.type", "capture.refers_to", "n_request", "n_metadata").collect()
        assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key) and all(r.n_request == r.n_metadata == 1 for r in rows)
        write_archive(df.limit(0), str(tmp_path / f"{kind}-none"), compression=kind)
        assert transactions(read_records(spark, str(tmp_path / f"{kind}-none"))).count() == 0
    data = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "gzip").glob("part-*"))
    assert data.count(b"WARC/1.1\r\n") == 3 * len(pages)


def test_transactions_of_loose_records(spark):
    """Records that nothing ties, and several requests of one capture."""
    from marquee.llm.warc import RECORD, transactions
    row = lambda kind, i, to: (kind, i, to, None, None, "u", None, None, None)
    df = spark.createDataFrame([row("response", "a", None), row("request", "r2", "a"), row("request", "r1", "a"), row("revisit", "b", None),
                                row("metadata", "m", "gone"), row("metadata", "b", None)], RECORD)
    got = {r.capture.id: (r.request and r.request.id, r.n_request, r.metadata, r.n_metadata) for r in transactions(df).collect()}
    assert got == {"a": ("r1", 2, None, None), "b": (None, None, None, None)}


# ---------------------------------------------------------------- pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, rows):
    """Result of each stage over ``rows``, by brute-force-checked columns."""
    from corpus_pipeline import STAGES
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {}
    for name, stage in STAGES:
        out[name] = (docs, stage(spark, docs, "unused"))
        docs = out[name][1]
    return out


def test_pipeline_stages(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from corpus_pipeline import ORACLE_SQL, STAGES
    assert [n for n, _ in STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "token_ids"] and ORACLE_SQL is None
    r = random.Random(12)
    base = [" ".join(r.choice(["the", "of", "and"]) + " " + f"word{r.randrange(900)}" for _ in range(70)) for _ in range(30)]
    near = base[3].split()
    near[0] = "other"
    ws = base[4].split()
    split = "\n".join(" ".join(ws[i:i + 10]) for i in range(0, len(ws), 10))     # other lines, same shingles
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate(base)]
    rows += [(100, base[2], "en", "a", len(base[2])), (101, " ".join(near), "en", "b", 1), (102, split, "en", None, 1),
             (103, "too short", "en", "a", 9), (104, None, None, None, None), (105, "same word again " * 40, "en", "b", 1),
             (None, base[5] + " more", None, "b", 1), (106, base[6] + "\n" + base[7], "en", "a", 1)]
    got = stages(spark, rows)
    ids = {name: sorted(str(x.doc_id) for x in out.select("doc_id").distinct().collect()) for name, (_, out) in got.items()}
    every = {str(x[0]) for x in rows}
    assert every - set(ids["quality_rules"]) == {"103", "104", "105"}      # the others are clean
    # equal lines go, also the two of 106; so does the near copy; a null id comes first
    assert set(ids["quality_rules"]) - set(ids["line_dedup"]) == {"100", "101", "106", "5"}
    assert set(ids["line_dedup"]) - set(ids["near_duplicates"]) == {"102"}
    for name in ("quality_rules", "line_dedup", "near_duplicates", "mixing"):
        assert got[name][1].columns == COLUMNS
    for x in got["line_dedup"][1].collect():
        assert x.n_chars == len(x.text)
    before, after = got["mixing"]
    texts = {x.doc_id: x.text for x in before.collect()}
    drawn = after.collect()
    words = lambda t: WORD.findall(t)
    for x in drawn:
        assert " ".join(words(x.text)) in " ".join(words(texts[x.doc_id])) and x.n_chars == len(x.text)
    total = sum(len(words(t)) for t in texts.values())
    assert abs(sum(len(words(x.text)) for x in drawn) - 1.5 * total) <= 6
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = sorted((str(x.doc_id), list(x.ids), x.n_tokens) for x in got["token_ids"][1].collect())
    want = [(str(x.doc_id), lib.encode(x.text, add_special_tokens=False).ids) for x in got["token_ids"][0].collect()]
    assert tokens == sorted((d, i, len(i)) for d, i in want)


def test_pipeline_of_nothing_and_of_rejects(spark):
    for rows in ([], [(1, None, None, None, None), (1, "", "en", "a", 0), (None, "few words", None, None, 9)]):
        assert [out.count() for _, out in stages(spark, rows).values()] == [0] * 5


def test_substring_seeds_and_windows_are_made_once(spark):
    """op10: the plan makes seeds and windows once and moves them once; rows
    that share an id or have none keep their own words."""
    from marquee.llm.substring import duplicate_spans, without_spans
    a, b = " ".join(f"w{i}" for i in range(20)), " ".join(f"v{i}" for i in range(20))
    docs = spark.createDataFrame([(1, a), (2, a + " x"), (2, b + " y"), (3, b), (None, a), (None, b), (4, None), (5, "y " + a)], "doc_id long, text string")
    out = without_spans(docs, duplicate_spans(docs))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas seeds(") == 1 and plan.count("MapInPandas windows(") == 1
    got = sorted((r.doc_id or 0, r.text or "", r.n_words, r.n_removed, r.kept_words) for r in out.collect())
    assert got == sorted([(1, a, 20, 0, a), (2, a + " x", 21, 20, "x"), (2, b + " y", 21, 0, b + " y"), (3, b, 20, 20, ""), (0, a, 20, 0, a),
                          (0, b, 20, 0, b), (4, "", 0, 0, ""), (5, "y " + a, 21, 20, "y")])


def test_ngram_prefixes_are_made_once(spark, monkeypatch):
    """op3: prefix tokens are counted where they lie, not joined with their
    own counts."""
    from marquee.llm import ngram_join as ng
    plans, store = {}, ng.stored
    monkeypatch.setattr(ng, "stored", lambda df, name: (plans.__setitem__(name, df._jdf.queryExecution().executedPlan().toString()), store(df, name))[1])
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(3, text), (1, text + " x"), (2, "other words " * 9), (4, text)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ng.jaccard_components(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 1}
    assert plans["ngram-alive"].count("MapInPandas") == 1 and plans["ngram-core"].count("Scan parquet") == 1
