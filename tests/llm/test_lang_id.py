"""Language identification: n-grams, held-out accuracy, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "/root/testdata/sf0.01/documents.parquet"


def plain_grams(text):
    """All n-grams of a text by a plain loop."""
    raw = b" " + text.lower().encode("utf-8", "surrogatepass") + b" "
    raw = bytes(32 if b in b"\t\n\v\f\r" else b for b in raw)
    return [raw[i:i + n] for n in (2, 3, 4, 5) for i in range(len(raw) - n + 1)
            if b" " not in raw[i + 1:i + n - 1] and raw[i:i + n].strip(b" ")]


@pytest.mark.parametrize("text", ["", "a", "Über  den\tWolken\n", "x" * 3000, "日本語 テキスト", "\ud800 b", " "])
def test_every_gram_is_counted_once(text):
    from marquee.llm.lang_id import counts
    grams = plain_grams(text)
    at, times = counts(text)
    assert times.sum() == len(grams)
    assert len(at) <= len(set(grams))


def test_long_texts_in_pieces_equal_whole(monkeypatch):
    from marquee.llm import lang_id
    texts = ["alpha beta gamma " * 200, None, "", "z" * 1000, "à la carte, s'il vous plaît " * 50, " \n "]
    table = np.arange((lang_id.BUCKETS + 1) * 2, dtype=np.int64).reshape(-1, 2) % 1009
    whole = lang_id.logits(texts, table)
    alone = np.concatenate([lang_id.logits([t], table) for t in texts])
    monkeypatch.setattr(lang_id, "PIECE", 97)
    assert (whole == alone).all() and (lang_id.logits(texts, table) == whole).all()
    for t, row in zip(texts, whole):
        at, times = lang_id.counts(t)
        monkeypatch.setattr(lang_id, "PIECE", 1 << 18)
        assert (table[at] * times[:, None].astype(np.int64)).sum(axis=0).tolist() == (row - table[-1] * (_places(t) - times.sum())).tolist()


def _places(text):
    return 4 * (len((text or "").lower().encode()) + 2)


def test_calibration_keeps_the_precision():
    from marquee.llm.lang_id import calibrate, softmax
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 3, 4000)
    scores = rng.normal(0, 1, (4000, 3))
    scores[np.arange(4000), truth] += 2.0
    warm, least = calibrate(scores * 5, truth, 0.95)
    p = softmax(scores * 5 / warm)
    taken = p.max(axis=1) >= least
    assert 2.2 < warm < 2.9               # log odds are twice the plain scores
    assert 0.05 < taken.mean() < 0.95 and (p.argmax(axis=1) == truth)[taken].mean() >= 0.95
    assert calibrate(np.zeros((0, 3)), truth[:0], 0.9) == (1.0, 0.0)


def test_held_out_accuracy(spark):
    from marquee.llm.lang_id import identify, train
    docs = spark.read.parquet(DOCS)
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = train(docs, fold != 0, fold == 1, per_lang=150)
    test = docs.filter(fold == 0)
    rows = identify(test, model).select("doc_id", "lang", "lang_pred", "score", "accepted").collect()
    again = identify(test.repartition(7), model).select("doc_id", "lang", "lang_pred", "score", "accepted").collect()
    assert sorted(rows) == sorted(again)
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_edge_rows(spark):
    from marquee.llm.lang_id import identify, train
    kind = "doc_id long, text string, lang string, score string, accepted string, lang_pred string"
    rows = [(i, "the cat and the dog of the house " * (1 + i % 3), "en", "x", "y", "z") for i in range(40)]
    rows += [(100 + i, "der Hund und die Katze im Haus " * (1 + i % 3), "de", "x", "y", "z") for i in range(40)]
    rows += [(200, None, "en", "x", "y", "z"), (201, "", "en", "x", "y", "z"), (202, "12 34 !?", "de", "x", "y", "z"), (None, "the dog", None, None, None, None),
             (203, "der Hund", None, "x", "y", "z"), (204, "und die Katze " * 30_000, "de", "x", "y", "z"), (205, "the dog", "en", "x", "y", "z"), (205, "the dog", "en", "x", "y", "z")]
    df = spark.createDataFrame(rows, kind).repartition(3)
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = train(df, fold != 0, fold == 1)
    got = identify(df, model).collect()
    assert len(got) == len(rows) and model.langs == ["de", "en"]
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and not by[i].accepted for i in (200, 201, 202))
    assert by[203].lang_pred == "de" and by[204].lang_pred == "de" and by[None].lang_pred == "en" and by[205].lang_pred == "en"
    none = df.limit(0)
    empty = train(none, fold != 0, fold == 1)
    assert identify(none, empty).count() == 0 and empty.langs == []
    assert {r.lang_pred for r in identify(df, empty).collect()} == {"und"}
