import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewell.llm import hmm_lm
from scorewell.llm.hmm_lm import (
    Hmm, Settings, baum_welch, expected, expected_of_documents, forward, initial, lapped, make_blocks, open_block, score, score_table, segments, shard_files, trained,
)
from scorewell.llm.common import SPACED, blank_text, utf8, words, written


def plain_words(text):
    return (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()


def base(rows):
    """The base columns by plain counting."""
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 5
    c = Counter()
    for i, t, *_ in rows:
        if fold(i) not in (1, None):
            c.update(plain_words(t))
            c[None] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for i, t, *_ in rows:
        tokens = [*plain_words(t), None]
        out.append((i, fold(i) == 1, len(tokens), sum(c[w] > 0 for w in tokens), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)))
    return out


def corpus(n=120, seed=1):
    rnd = random.Random(seed)
    sets = [[f"{p}{k}" for k in range(40)] for p in ("a", "B", "ç")]
    return [(k, " ".join(rnd.choice(sets[k % 3]) for _ in range(rnd.randrange(0, 60)))) for k in range(n)]


ODD = [(1000, None), (1001, ""), (1002, " \t"), (1003, "only\x00here ONLY\x00here"), (1004, "a1 " * 9000), (5, "A1 a1"), (5, "A1 a1"), (None, "a1 zz")]


def test_base_columns_equal_plain_counting(make):
    rows = corpus() + ODD
    got = score_table(make(rows, clash=True), Settings(iterations=1)).collect()
    key = lambda t: (str(t[0]), t[2], round(t[5], 6))
    for a, b in zip(sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key), sorted(base(rows), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-12)


def all_paths(m, seq):
    """Likelihood as the sum over all paths of states."""
    k, total = len(m.start), 0.0
    for path in np.ndindex(*[k] * len(seq)):
        p = m.start[path[0]] * m.emit[seq[0], path[0]]
        for a, b, x in zip(path, path[1:], seq[1:]):
            p *= m.move[a, b] * m.emit[x, b]
        total += p
    return total


def random_model(rng, k=3, symbols=5):
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return Hmm(norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((symbols, k)), 0))


def test_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    m = random_model(rng)
    lens = np.array([1, 6, 3, 6, 2])
    seq = rng.integers(0, 5, lens.sum())
    starts = np.cumsum(lens) - lens
    want = [math.log10(all_paths(m, seq[s : s + n])) for s, n in zip(starts, lens)]
    assert forward(m, seq, starts, lens) == pytest.approx(want, rel=1e-12)


def test_expected_counts_are_the_posterior_ones():
    rng = np.random.default_rng(2)
    m = random_model(rng, 2, 4)
    seq = np.array([0, 3, 1, 1, 2, 0])
    lens, starts = np.array([4, 2]), np.array([0, 4])
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for s, n in zip(starts, lens):
        x = seq[s : s + n]
        total = all_paths(m, x)
        for path in np.ndindex(*[2] * n):
            p = m.start[path[0]] * m.emit[x[0], path[0]]
            for a, b, y in zip(path, path[1:], x[1:]):
                p *= m.move[a, b] * m.emit[y, b]
            p /= total
            start[path[0]] += p
            for a, b in zip(path, path[1:]):
                move[a, b] += p
            for a, y in zip(path, x):
                emit[y, a] += p
    got = expected(m, seq, starts, lens)
    assert np.allclose(got[0], start) and np.allclose(got[1], move) and np.allclose(got[2], emit)
    assert got[3] == pytest.approx(forward(m, seq, starts, lens).sum())


def test_long_sequences_dont_underflow():
    m = random_model(np.random.default_rng(3))
    n = 50_000
    got = forward(m, np.zeros(n, int), np.array([0]), np.array([n]))
    assert np.isfinite(got).all() and got[0] < -1000


def test_segments_cover_each_sequence():
    at, lens = segments(np.array([0, 10, 12]), np.array([10, 2, 7]), 4)
    assert [(a, a + n) for a, n in zip(at.tolist(), lens.tolist())] == [(0, 4), (4, 8), (8, 10), (10, 12), (12, 16), (16, 19)]


def blocks_of(docs):
    return make_blocks(docs.select(F.col("doc_id"), blank_text(F.col("text")).alias("text"), F.lit(False).alias("held_out"), F.lit(True).alias("learn")))


def test_each_iteration_is_no_worse_and_partitions_dont_matter(make):
    s = Settings(iterations=4, prior=0.0, class_bits=8, segment=10**6)
    one, two = (baum_welch(blocks_of(make(corpus(), parts=p)).cache(), s) for p in (1, 7))
    assert all(b >= a - 1e-6 for a, b in zip(one[1], one[1][1:])) and one[1][-1] > one[1][0]
    assert np.allclose(one[0].emit, two[0].emit) and one[1] == pytest.approx(two[1])


def test_blocks_hold_the_words(make):
    docs = make([(k, "x y x z" + " w" * k) for k in range(10)], parts=1)
    row = blocks_of(docs).collect()[0]
    x = open_block(row.asDict())
    assert x.lens.tolist() == [4 + k for k in np.frombuffer(row.ids, "<i8")] and len(row.words) == 4
    assert np.bincount(x.tokens).tolist() == sorted(np.bincount(x.tokens).tolist(), reverse=True) == row.train


def test_model_beats_the_base_on_held_out_texts(make):
    rows = corpus(400, 3)
    got = [r for r in score_table(make(rows), Settings(class_bits=10, iterations=12, stay=50.0)).collect() if r.held_out]
    assert len(got) > 40
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_scores_sum_to_one_over_all_words(make):
    """With one class a text's probability is that of its words; known words and one unknown sum to 1."""
    s = Settings(class_bits=0 + 1, iterations=2)
    rows = [(k, "a b b c") for k in range(10)]
    known = ["a", "b", "c"]
    asked = [(100 + k, w) for k, w in enumerate([*known, "never"])] + [(200, "")]
    df = make(rows + asked)
    got = {r.doc_id: r.score for r in score(df, F.col("doc_id") < 100, F.lit(False), s).collect()}
    # P(one word, end) over the known words, plus unknown words (each class has room for one), is what ends after one word
    assert sum(10 ** got[100 + k] for k in range(3)) < 1 and got[200] < 0 and all(math.isfinite(v) for v in got.values())


def test_nothing_to_learn_from_and_empty(make):
    docs = make([(1, "a b"), (2, None)])
    got = score(docs, F.lit(False), F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in got} == {(0, 0, 0.0)} and all(r.score <= 0 for r in got)
    assert score_table(docs.where("false")).count() == 0


def test_start_is_seeded():
    a, b = initial(Settings()), initial(Settings())
    assert (a.emit == b.emit).all() and np.allclose(a.emit.sum(axis=0), 1) and np.allclose(a.move.sum(axis=1), 1)


# --- words -----------------------------------------------------------------------------------------


def stored_blocks(docs, learn=None):
    """Blocks as ``score`` stores them."""
    learn = F.lit(True) if learn is None else learn
    return written(make_blocks(docs.select(F.col("doc_id"), blank_text(F.col("text")).alias("text"), F.lit(False).alias("held_out"), learn.alias("learn"))), "t")


@pytest.mark.parametrize("rounds, states", [(1, 3), (3, 2)])
def test_scores_equal_plain_recursion_row_by_row(make, rounds, states):
    """From the table of words: each document's probability by loops over its words and all states."""
    rows, s = corpus(60) + ODD, Settings(states=states, iterations=3, word_rounds=rounds, class_bits=6)
    docs = make(rows, clash=True, parts=4)
    learn = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False))
    n_ends = sum(r[0] is not None and r[0] % 3 != 0 for r in rows)
    m, words_, _ = trained(b := stored_blocks(docs, learn), shard_files(b), n_ends, s)
    table_ = {}
    for r in words_.where("word IS NOT NULL").collect():
        c = [r[f"c{k}"] for k in range(states - 1)]
        table_[r["word"]] = (r["train"], [*c, r["train"] - sum(c)])
    c_all = Counter()
    for i, t, *_ in rows:
        if i is not None and i % 3 != 0:
            c_all.update(plain_words(t))
    assert m.n == sum(c_all.values()) + n_ends and m.v == len(c_all) + 1

    def emission(word):
        h = hash_of(word)
        train, counts = table_[h]
        assert train == c_all[word] and sum(counts) == pytest.approx(train) and min(counts) > -1e-4
        return [(max(c, 0) / q + 0.5) / (m.n + 0.5 * (m.v + 1)) for c, q in zip(counts, m.shares)]

    end = [(c / q + 0.5) / (m.n + 0.5 * (m.v + 1)) for c, q in zip(m.ends, m.shares)]
    want = []
    for i, t, *_ in rows:
        total, a = 0.0, None
        for e in [*map(emission, plain_words(t)), end]:
            p = m.start if a is None else [sum(a[x] * m.move[x][y] for x in range(states)) for y in range(states)]
            a = [x * y for x, y in zip(p, e)]
            total += math.log10(sum(a))
            a = [x / sum(a) for x in a]
        want.append((str(i), len(plain_words(t)) + 1, total))
    got = [(str(r.doc_id), r.n_tokens, r.score) for r in score(docs, learn, F.lit(False), s).collect()]
    for a, b in zip(sorted(got, key=lambda r: (r[:2], round(r[2], 6))), sorted(want, key=lambda r: (r[:2], round(r[2], 6))), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-6)


def hash_of(word):
    import pyarrow as pa

    return int(words(*utf8(pa.array([word.decode()])), SPACED)[0].view(np.int64)[0])


def test_each_state_has_one_word_and_what_is_known_sums_to_one(make):
    """All known words, the end and one unknown: the probabilities of each state sum to 1."""
    docs = make(corpus(80), parts=3)
    s = Settings(iterations=4, class_bits=6)
    m, words_, _ = trained(b := stored_blocks(docs), shard_files(b), 80, s)
    rows = {r["word"]: r for r in words_.where("word IS NOT NULL").collect()}.values()
    counts = np.array([[r[f"c{k}"] for k in range(s.states - 1)] for r in rows])
    e = m.emissions(np.array([r["train"] for r in rows]), counts)
    unknown = 0.5 / (m.n + 0.5 * (m.v + 1))
    assert np.allclose(e.sum(axis=0) + unknown, 1, atol=0.02)  # shares hold the prior besides the counts
    assert len(e) == m.v


def test_likelihood_never_falls_and_settles(make):
    """On classes and, from there, on words; and what the words gain over their classes."""
    docs = make(corpus(150, 4), parts=3)
    blocks = stored_blocks(docs)
    s = Settings(iterations=30, word_rounds=5, class_bits=5, prior=0.0, lap=10**6, settled=1e-4)
    _, _, history = trained(blocks, shard_files(blocks), 150, s)
    on_words, on_classes = history[-s.word_rounds + 1 :], history[: -s.word_rounds + 1]
    assert all(b >= a - 1e-6 for a, b in zip(on_classes, on_classes[1:]))
    assert all(b >= a - 0.02 * abs(a) / 100 for a, b in zip(on_words, on_words[1:]))  # up to the half counts
    assert len(on_classes) < 31  # settled before the bound


def test_laps_make_cut_documents_count_as_whole_ones():
    rng = np.random.default_rng(4)
    m = random_model(rng, 3, 6)
    lens = np.array([500, 1, 37, 64, 128])
    seq, starts = rng.integers(0, 6, lens.sum()), np.cumsum(lens) - lens
    whole = expected(m, seq, starts, lens)
    for size, lap in ((64, 30), (50, 40), (1, 60)):
        cut = expected_of_documents(m, seq, starts, lens, Settings(segment=size, lap=lap))
        for a, b in zip(cut, whole):
            assert np.allclose(a, b, rtol=1e-4, atol=1e-3)
        # every token counts once, and every move: also those over a cut
        assert cut[2].sum() == pytest.approx(lens.sum()) and cut[1].sum() == pytest.approx((lens - 1).sum()) and cut[0].sum() == pytest.approx(len(lens))


def test_segments_go_in_groups_of_bounded_size(monkeypatch):
    parts = lapped(np.array([0, 1000]), np.array([1000, 3]), 10, 2)
    groups = [*parts.groups(100)]
    assert all(g.lens.sum() <= 100 for g in groups) and sum(len(g.lens) for g in groups) == len(parts.lens) == 101
    assert [len(g.lens) for g in parts.groups(1)] == [1] * 101
    m = random_model(np.random.default_rng(5), 2, 4)
    seq = np.random.default_rng(6).integers(0, 4, 1003)
    args = (m, seq, np.array([0, 1000]), np.array([1000, 3]), Settings(segment=10, lap=2))
    want = expected_of_documents(*args)
    monkeypatch.setattr(hmm_lm, "GROUP", 100)
    assert all(np.allclose(a, b) for a, b in zip(expected_of_documents(*args), want))


def test_words_do_better_on_held_out_texts_than_classes_alone(make):
    """Words of a class that belong to different topics: their class can't tell them apart, their counts can."""
    rows = corpus(400, 3)
    def gain(**kw):
        got = [r for r in score_table(make(rows), Settings(class_bits=2, iterations=12, stay=50.0, **kw)).collect() if r.held_out]
        return sum(r.score - r.base_score for r in got)

    one, three = gain(), gain(word_rounds=4)
    assert one > 0 and three > one


def test_common_word_is_one_row_a_shard_and_blocks_are_not_shuffled(make):
    docs = make([(k, "the " * 30 + f"w{k}") for k in range(300)], parts=6)
    blocks = stored_blocks(docs)
    m, words_, _ = trained(blocks, shard_files(blocks), 300, Settings(iterations=1))
    per = words_.where("word IS NOT NULL").groupBy("word").count().agg(F.max("count")).first()[0]
    assert per == len(blocks.select(F.input_file_name()).distinct().collect())
    # a shard is a task by itself
    parts = words_.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("shard").alias("n")).collect()
    assert {r["n"] for r in parts} == {1}
    plan = score(docs, F.lit(True), F.lit(False), Settings(iterations=1))._jdf.queryExecution().optimizedPlan().toString()
    assert " lens#" not in plan and "lens" not in plan and "CoGroup" not in plan
