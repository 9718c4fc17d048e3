import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewell.llm import langid
from scorewell.llm.langid import Settings, calibrate, counts, ftrl, keep_known, language_table, predict_one, train, weighted
from tests.conftest import SF_ORACLE

SMALL = Settings(bits=12, per_language=60)


def made(n, seed=1):
    """Two languages of different letters; some letters are shared."""
    rnd = random.Random(seed)
    word = lambda abc: "".join(rnd.choice(abc) for _ in range(rnd.randrange(2, 8)))
    return [(k, " ".join(word("abcdeé" if k % 2 else "edxyzü") for _ in range(rnd.randrange(3, 40))), "aa" if k % 2 else "zz") for k in range(n)]


def plain_counts(text, s):
    """n-grams of the letters, words apart by one space, one space around."""
    t = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not t.strip():
        return {}
    t = " " + " ".join(t.split()) + " "
    out = {}
    for n in range(1, s.longest + 1):
        for k in range(len(t) - n + 1):
            out[t[k : k + n]] = out.get(t[k : k + n], 0) + 1
    return out


@pytest.mark.parametrize("block", [4, 5, 7, 1 << 20])
def test_counts_are_those_of_whole_texts(monkeypatch, block):
    texts = ["", "   ", "12 .", "a", "Ab c", "ab  1c--Dé.", "xyz" * 20, " lead and trail ", "a1b2c3d4e5", "日本語 テスト"]
    s = Settings(bits=15)
    want = [counts(t, s) for t in texts]
    monkeypatch.setattr(langid, "BLOCK", block)
    for t, (at, n) in zip(texts, want):
        got = counts(t, s)
        assert got[0].tolist() == at.tolist() and got[1].tolist() == n.tolist()
        assert n.sum() == max(0, sum(plain_counts(t, s).values()) - 1)  # the space before the text is none by itself


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = language_table(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 150 < len(held) < 350
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_calibrated_scores_are_near_the_share_of_right_ones(make):
    rnd = random.Random(5)
    rows = [(i, t[: rnd.randrange(1, 6)], l) for i, t, l in made(1500)]  # a few letters: hard
    docs = make(rows)
    got = [r for r in language_table(docs, Settings(bits=12, per_language=400)).join(docs.select("doc_id", "lang"), "doc_id").collect() if r.held_out]
    right = sum(r.lang_pred == r.lang for r in got) / len(got)
    assert abs(right - sum(r.score for r in got) / len(got)) < 0.1


def test_rows_of_all_kinds(make):
    rows = made(200) + [(1000, None), (1001, ""), (1002, "123 ... !"), (1003, "x" * 200_000, "zz"), (None, "xyz xyz", "zz"), (7, "abc abc", None), (7, "abc abc", None)]
    got = language_table(make(rows, clash=True), SMALL).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[1003].lang_pred == "zz" and by[None].held_out is False
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)


def test_held_out_labels_dont_matter(make):
    import zlib

    rows = made(200)
    other = [(i, t, "qq" if zlib.crc32(str(i).encode()) % 4 == 2 else l) for i, t, l in rows]
    a, b = (sorted(map(tuple, language_table(make(r), SMALL).collect())) for r in (rows, other))
    assert a == b


def test_no_labels_one_label_and_empty(make):
    rows = [(k, "some text", None) for k in range(8)]
    assert {(r.lang_pred, r.score) for r in language_table(make(rows)).collect()} == {("und", 0.0)}
    assert {r.lang_pred for r in language_table(make([(k, "some text", "en") for k in range(8)])).collect()} == {"en"}
    assert language_table(make(rows).where("false")).count() == 0


def test_document_frequencies_cover_all_training_documents(make):
    rows = made(120)
    m = train(make(rows), F.lit(True), Settings(bits=12, per_language=5))
    df = np.zeros(1 << 12, int)
    for _, t, _ in rows:
        df[counts(t, m.settings)[0]] += 1
    assert np.allclose(m.idf, np.log((1 + len(rows)) / (1 + df)) + 1)


def test_sample_is_bounded(make):
    seen = []
    original = langid.ftrl

    def spy(rows, k, s):
        seen.append(len(rows))
        return original(rows, k, s)

    langid.ftrl = spy
    try:
        train(make(made(600)), F.lit(True), Settings(bits=10, per_language=50))
    finally:
        langid.ftrl = original
    assert 40 < seen[0] < 130


def test_ftrl_is_sparse_under_l1_and_separates():
    s, rnd = Settings(bits=6, l1=0.05, epochs=5), np.random.default_rng(1)
    rows = [(np.array([y, 10 + int(rnd.integers(20))]), np.array([1.0, 0.2]), y) for y in rnd.integers(0, 3, 300)]
    w = ftrl(rows, 3, s)
    assert (w == 0).mean() > 0.5
    assert all((x @ w[at] + w[-1]).argmax() == y for at, x, y in rows)


def test_temperature_is_the_best_on_a_grid():
    rnd = np.random.default_rng(2)
    logits = rnd.normal(0, 8, (400, 3))
    y = np.where(rnd.random(400) < 0.7, logits.argmax(axis=1), rnd.integers(0, 3, 400))

    def loss(t):
        x = logits / t
        x = x - np.log(np.exp(x).sum(axis=1, keepdims=True))
        e = 3 / 403
        return -((1 - e) * x[np.arange(400), y] + e * x.mean(axis=1)).mean()

    t = calibrate(logits, y)
    assert loss(t) <= min(loss(x) for x in np.geomspace(0.05, 20, 300)) + 1e-6


def test_keeping_known_languages(make):
    rows = made(300) + [(1000, None), (1001, "1 2 3"), (1002, "")]
    docs = make(rows, clash=True)
    kept = keep_known(docs, 0.35, SMALL)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(300))
    unlabelled = make([(1, "abc", None), (2, "...", None)])
    assert [r.doc_id for r in keep_known(unlabelled, 0.35).collect()] == [1]
    assert keep_known(docs.where("false"), 0.35).count() == 0


def test_prediction_is_pure_in_the_text(make):
    m = train(make(made(200)), F.lit(True), SMALL)
    at, n = counts("abcde", SMALL)
    x = weighted(at, n, m.idf) @ m.weights[at] + m.weights[-1]
    p = np.exp(x / m.temperature) / np.exp(x / m.temperature).sum()
    assert predict_one("abcde", m) == (m.labels[int(p.argmax())], pytest.approx(float(p.max())))
