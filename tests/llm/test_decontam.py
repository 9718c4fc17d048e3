import random

import numpy as np
import pyarrow as pa
import pytest

from scorewell.llm.decontam import (
    Settings, clean, contamination, gated, matches, nearest_passage, passage_distance, prepare, simulated_recall, size_of, walk_keys, walks_for,
)

rnd = random.Random(1)
VOCAB = ["word%d" % k for k in range(3000)]


def text(n, r=rnd):
    return [r.choice(VOCAB) for _ in range(n)]


def edited(w, k, r=rnd):
    """k random word edits."""
    w = list(w)
    for _ in range(k):
        c, at = r.random(), r.randrange(len(w))
        if c < 0.5:
            w[at] = "new%d" % r.randrange(999)
        elif c < 0.75:
            w.insert(at, "new%d" % r.randrange(999))
        else:
            del w[at]
    return w


def plain_distance(item, region):
    """Textbook semi-global edit distance."""
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(region, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_passage_distance_is_the_textbook_one():
    r = np.random.default_rng(1)
    for _ in range(300):
        item, region = r.integers(0, 5, r.integers(1, 9)), r.integers(0, 5, r.integers(0, 15))
        d, end = passage_distance(item, region)
        assert d == plain_distance(item.tolist(), region.tolist())
        got = nearest_passage(item, region, len(item))
        if got and len(region):
            assert got[0] == d and 0 <= got[1] <= end


@pytest.fixture()
def benchmark(spark):
    r = random.Random(7)
    items = [(k, text(r.randrange(14, 60), r)) for k in range(60)] + [(100, text(5, r)), (101, text(3, r)), (102, text(11, r)), (103, text(1, r))]
    rows = [(k, " ".join(w).capitalize() + ".") for k, w in items] + [(200, None), (201, ""), (202, "..."), (None, "no id here at all, none")]
    return dict(items), spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "'x' AS doc_id")


def brute(docs, items, share=0.2):
    out = {}
    for i, t in docs:
        w = [x for x in "".join(c.lower() if c.isalnum() else " " for c in t or "").split()]
        for k, item in items.items():
            d = plain_distance(item, w)
            if d <= int(share * len(item)):
                out[i, k] = d
    return out


def test_rows_equal_brute_force(make, benchmark):
    items, table = benchmark
    r = random.Random(9)
    docs = []
    for k in range(150):
        body = text(r.randrange(0, 60), r)
        if k % 3 == 0:
            item = items[r.choice(list(range(60)))]
            body += edited(item, r.randrange(0, 1 + len(item) // 8), r) + text(r.randrange(0, 30), r)
        docs.append((k, r.choice([" ", "\n", ", "]).join(body).title()))
    docs += [(900, None), (901, ""), (902, " ".join(items[100])), (903, "x " * 3000 + " ".join(items[5]) + " y" * 3000), (904, " ".join(items[102]))]
    got = {(x.doc_id, x.item_id): x.edits for x in contamination(make(docs, clash=True), table).collect()}
    want = brute(docs, items)
    assert set(got) <= set(want)
    assert all(got[p] == want[p] for p in got)
    long = {p for p in want if len(items[p[1]]) >= 11}
    assert len(long & set(got)) >= 0.97 * len(long) and len(long) > 40
    exact = {p for p, d in want.items() if d == 0}
    assert exact <= set(got)  # every exact passage, of short items too


def test_place_of_the_passage(make, benchmark):
    items, table = benchmark
    docs = make([(1, " ".join(text(30) + items[3] + text(30)))])
    row = contamination(docs, table).where("item_id = 3").first()
    assert (row.edits, row.item_words, row.first_word) == (0, len(items[3]), 30)


def test_recall_at_the_largest_share(make, benchmark):
    items, table = benchmark
    docs, r = [], random.Random(4)
    for k in range(60):
        docs.append((k, " ".join(text(20, r) + edited(items[k], int(0.18 * len(items[k])), r) + text(20, r))))
    want = {p for p in brute(docs, items) if p[0] == p[1]}
    got = {(x.doc_id, x.item_id) for x in contamination(make(docs), table).collect()}
    assert len(got & want) >= 0.95 * len(want) and len(want) > 50


def test_clean_keeps_the_others_whole(make, benchmark):
    items, table = benchmark
    rows = [(k, " ".join(text(40))) for k in range(30)] + [(50, " ".join(text(9) + items[0])), (51, None), (52, ""), (53, " ".join(items[0])), (30, "twice the same"), (30, "twice the same")]
    docs = make(rows, clash=True)
    kept = clean(docs, table)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((i, t or "") for i, t in rows if i not in (50, 53))


def test_blocks_of_items_give_the_same(make, benchmark):
    items, table = benchmark
    docs = make([(k, " ".join(items[k])) for k in range(60)])
    rows = lambda s: sorted(map(tuple, contamination(docs, table, s).collect()))
    assert rows(Settings(block_words=100)) == rows(Settings())


def test_empty_tables(make, benchmark):
    _, table = benchmark
    docs = make([(1, "a b c")])
    assert contamination(docs.where("false"), table).count() == 0
    assert contamination(docs, table.where("false")).count() == 0
    assert clean(docs, table.where("false")).count() == 1


def test_walks_see_windows_only():
    r, s = np.random.default_rng(2), Settings()
    h = r.integers(1, 2**63, 100, dtype=np.uint64)
    a = walk_keys(h, np.array([10]), 8, 0, s)
    other = h.copy()
    other[:10] = 5
    other[18:] = 7
    assert walk_keys(other, np.array([10]), 8, 0, s) == a
    assert walk_keys(h[:18], np.array([10]), 8, 0, s) == a  # at the end of the words
    near = [np.mean([walk_keys(np.r_[h[:14], np.uint64(k), h[15:]], np.array([10]), 8, w, s) == walk_keys(h, np.array([10]), 8, w, s) for w in range(6)]) for k in range(50)]
    assert np.mean(near) > 0.05  # one changed word often leaves a walk's key as it was


@pytest.mark.parametrize("n", range(5, 21))
def test_recall_of_each_length_at_the_full_share(n):
    """Of all passages with int(0.2 n) edits, as many as the settings promise, less what 300 trials may be off."""
    r = random.Random(n)
    items = {k: text(n, r) for k in range(300)}
    docs = [(k, " ".join(text(20 + k % 4, r) + edited(w, int(0.2 * n), r) + text(20, r))) for k, w in items.items()]
    want = {k for k, t in docs if brute([(k, t)], {k: items[k]})}
    found = matches(pa.array([t for _, t in docs]), prepare(list(items), [" ".join(w) for w in items.values()], Settings()))
    assert len(want) == 300
    assert sum((k, k) in found for k in want) >= 0.92 * len(want)


def test_many_equal_keys_are_looked_at_in_parts(monkeypatch):
    x = prepare(list(range(50)), ["the " * 5 + f"w{k}" for k in range(50)], Settings())
    column = pa.array(["the " * 300 + "w7", "the the the the the w9 and"])
    whole = matches(column, x)
    monkeypatch.setattr("scorewell.llm.decontam.PAIRS", 100)
    assert matches(column, x) == whole and whole[1, 9] == (0, 0) and whole[0, 7] == (0, 295)


@pytest.mark.parametrize("cut", [1, 2, 5])
def test_passage_without_its_first_words_at_the_start_of_the_first_document(cut):
    w = text(40, random.Random(cut))
    x = prepare([7], [" ".join(w)], Settings())
    doc = " ".join(w[cut:] + text(10))
    alone, second = matches(pa.array([doc]), x), matches(pa.array(["some other text", doc]), x)
    assert alone == {(0, 0): (cut, 0)} and second == {(1, 0): (cut, 0)}


def test_items_without_an_id_take_part(spark, make):
    item = text(30)
    table = spark.createDataFrame([(None, " ".join(item)), (None, None), (1, " ".join(text(30)))], "item_id bigint, text string")
    docs = make([(1, " ".join(text(9) + item)), (2, " ".join(text(40)))])
    assert [tuple(r) for r in contamination(docs, table).collect()] == [(1, None, 0, 30, 9)]
    assert [r.doc_id for r in clean(docs, table).collect()] == [2]


@pytest.mark.parametrize("n", [22, 25, 28, 32, 33, 36, 40, 45, 50, 57, 64, 90])
def test_recall_of_longer_items_at_the_full_share(n):
    """The same beyond 20 words, also where lengths share a window size."""
    r = random.Random(n)
    items = {k: text(n, r) for k in range(150)}
    docs = [(k, " ".join(text(20 + k % 4, r) + edited(w, int(0.2 * n), r) + text(20, r))) for k, w in items.items()]
    found = matches(pa.array([t for _, t in docs]), prepare(list(items), [" ".join(w) for w in items.values()], Settings()))
    assert sum((k, k) in found for k in items) >= 0.9 * len(items)


def test_windows_have_the_size_of_their_items():
    s = Settings()
    assert [size_of(n, s) for n in range(1, 34)] == list(range(1, 34))
    sizes = [size_of(n, s) for n in range(33, 3000)]
    assert sizes == sorted(sizes) and all(0.9 * n <= size <= n for n, size in zip(range(33, 3000), sizes))
    assert len(set(sizes)) < 60
    x = prepare([1, 2, 3], [" ".join(text(n)) for n in (7, 40, 41)], s)
    assert [(c.size, c.most) for c in x.classes] == [(7, 1), (39, 8)]


def test_gate_never_leaves_out_the_window_at_a_passages_start():
    """However the allowed edits fall, that window has all but ``most`` of the item's words, or the text ends before."""
    r = random.Random(12)
    for _ in range(400):
        n = r.randrange(5, 40)
        item, most = text(n, r), int(0.2 * n)
        passage = edited(item, r.randrange(most + 1), r)
        doc = [["other"] * r.randrange(5), passage, ["other"] * r.randrange(3)]
        words_ = sum(doc, [])
        known = np.concatenate([[0], np.cumsum([w in item for w in words_])])
        start = len(doc[0])
        while passage and passage[0] not in item:  # a passage may begin with the first word that the item has
            passage, start = passage[1:], start + 1
        assert start in gated(known, n, most)


def test_passages_at_the_end_of_a_text_are_found_by_padded_windows():
    for cut in (1, 3, 7):
        w = text(40, random.Random(cut))
        x = prepare([7], [" ".join(w)], Settings())
        docs = ["before " * 9 + " ".join(w[: 40 - cut]), " ".join(w[:10]) + " unrelated words"]
        assert matches(pa.array(docs), x) == {(0, 0): (cut, 9)}


def test_simulated_recall_grows_with_the_walks():
    s = Settings(recall=1.1, walks=6, trials=200)
    for n in (6, 17, 40, 70):
        share = simulated_recall(n, s)
        assert len(share) == 6 and share == sorted(share) and share[0] < share[-1] and share[-1] > 0.85
    assert walks_for(4, Settings()) == 1 and walks_for(17, Settings()) == len(simulated_recall(17, Settings()))
