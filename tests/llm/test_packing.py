import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from scorewell.llm import bin_completion
from scorewell.llm.bin_completion import Packing, best_fit, bound, complete, dive, dominated, fillings, ways
from scorewell.llm.packing import Settings, Slots, numbered, packed, pieces, pieces_of, sequences
from scorewell.llm.queries import tokenizer_path
from scorewell.llm.token_file import encoder
from tests.llm.test_token_file import TEXTS


# --- the search --------------------------------------------------------------------------------


def optimum(items, capacity):
    """Least number of bins, over all orders of the items."""
    best = [(99, 0)] * (1 << len(items))
    best[0] = (0, capacity)
    for m in range(1 << len(items)):
        n, load = best[m]
        for k, size in enumerate(items):
            if not m >> k & 1:
                then = (n, load + size) if load + size <= capacity else (n + 1, size)
                best[m | 1 << k] = min(best[m | 1 << k], then)
    return best[-1][0]


def items_of(bins, capacity):
    got = Counter()
    for pattern, n in bins.items():
        assert n > 0 and sum(size * k for size, k in pattern) <= capacity
        for size, k in pattern:
            got[size] += k * n
    return got


def test_search_finds_the_least_number_of_bins():
    rnd, better = random.Random(3), 0
    for _ in range(250):
        capacity = rnd.choice([7, 10, 20, 50, 100])
        items = [rnd.randrange(1, capacity + 1) if rnd.random() < 0.4 else rnd.randrange(max(1, capacity // 6), capacity // 2 + 1) for _ in range(rnd.randrange(0, 11))]
        p = complete(Counter(items), capacity, 5000, 500)
        want = optimum(items, capacity) if items else 0
        assert items_of(p.bins, capacity) == Counter(items)
        assert p.proven and p.n == want >= p.least
        better += sum(best_fit(Counter(items), capacity).values()) > want
    assert better  # best fit alone wouldn't do


@pytest.mark.parametrize("times", [1, 5, 1001])
def test_search_beats_best_fit_where_it_errs(times):
    """Best fit puts the 3s with the 4 or with each other and wastes room; 4+2+2 and 3+3+2 waste none."""
    counts = {4: times, 3: 2 * times, 2: 3 * times}
    p = complete(counts, 8)
    assert sum(best_fit(counts, 8).values()) > 2 * times
    assert p.n == 2 * times == p.least and p.proven and items_of(p.bins, 8) == Counter(counts)


def test_many_items_of_few_sizes_are_few_patterns():
    counts = {900: 10**9, 700: 3 * 10**9 + 1, 4096: 5 * 10**8, 1: 10**9, 2000: 7}
    p = complete(counts, 4096)
    assert items_of(p.bins, 4096) == Counter(counts) and len(p.bins) < 40
    # 900 + 900 + 700 + 700 + 700 and 700 * 5 are the best fillings: 1.3e9 sequences with the full ones.
    assert 1.3e9 <= p.n <= 1.301e9


def test_best_fit_equals_one_item_at_a_time():
    rnd = random.Random(9)
    for _ in range(100):
        items = sorted((rnd.randrange(1, 40) for _ in range(rnd.randrange(60))), reverse=True)
        rooms = []
        for size in items:
            fits = [r for r in rooms if r >= size]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 50) - size)
        assert sum(best_fit(Counter(items), 50).values()) == len(rooms)


def test_bound_is_never_more_than_the_optimum():
    rnd = random.Random(4)
    for _ in range(200):
        items = [rnd.randrange(1, 21) for _ in range(rnd.randrange(1, 9))]
        assert -(-sum(items) // 20) <= bound(Counter(items), 20) <= optimum(items, 20)
    assert bound({11: 4}, 20) == 4 and bound({}, 20) == 0


def test_fillings_are_the_undominated_ones():
    ways, whole = fillings({6: 1, 4: 1, 3: 2, 2: 2}, 6, 10, 100)
    assert whole and sorted(map(tuple, ways)) == [((4, 1),)]  # 2 + 2 gives way to the 4
    ways, _ = fillings({6: 1, 3: 2, 2: 2}, 6, 10, 100)
    assert sorted(map(tuple, ways)) == [((2, 2),), ((3, 1),)]  # neither can stand for the other
    assert dominated([(2, 1)], 1 << 3, 1) and not dominated([(2, 1)], 1 << 3, 0)
    assert dominated([], 1 << 1, 1) and not dominated([(2, 1)], 1 << 2, 1)
    assert dominated([(2, 2)], 1 << 4, 0) and dominated([(2, 1), (1, 1)], 1 << 3, 0)


def test_search_that_ends_early_packs_every_item():
    counts = Counter(random.Random(1).choices(range(900, 1500), k=300))
    p = complete(counts, 4096, nodes=3, most_fillings=2)
    assert items_of(p.bins, 4096) == counts and p.least <= p.n <= sum(best_fit(counts, 4096).values())
    with pytest.raises(ValueError, match="from 1 to 10"):
        complete({11: 1}, 10)


def crowded(n, spare):
    """Lengths of which most are about 310, with so many tokens to spare in the fewest sequences."""
    rnd = random.Random(5)
    counts = Counter(max(20, min(4096, int(rnd.gauss(310, 12) if rnd.random() < 0.6 else rnd.paretovariate(1.2) * 90))) for _ in range(n))
    counts[(-sum(k * m for k, m in counts.items()) - spare) % 4096] += 1
    return +counts


def test_little_room_to_spare_is_met_without_a_long_search(monkeypatch):
    """The search took 300 nodes and 38 seconds here, and found nothing."""
    counts, visited = crowded(6000, 150), []
    real = bin_completion.best_fit
    monkeypatch.setattr(bin_completion, "best_fit", lambda *a: visited.append(a) or real(*a))
    p = complete(counts, 4096)
    assert items_of(p.bins, 4096) == counts and p.proven
    assert p.n == -(-sum(k * n for k, n in counts.items()) // 4096) < sum(real(counts, 4096).values())
    assert len(visited) < 10


def test_nodes_are_made_when_they_are_due(monkeypatch):
    counts = {k: 1 + k % 7 for k in range(1200, 1500)}  # best fit and the dive stay above the bound
    asked, real = [], bin_completion.bound
    monkeypatch.setattr(bin_completion, "bound", lambda *a: asked.append(a) or real(*a))
    p = complete(counts, 4096, nodes=10)
    assert not p.proven and items_of(p.bins, 4096) == counts
    assert len(asked) < 30  # before 644: of all fillings of each node


def test_many_sizes_that_each_fill_a_bin():
    """One way a size, each a level deeper: this was a RecursionError."""
    counts = {size: 1 for size in range(1010, 2049)}
    found, whole = fillings(counts, 2048, 4096, 50)
    assert found == [[(2047, 1)]] and not whole
    assert items_of(complete(counts, 4096, nodes=3).bins, 4096) == counts


def test_ways_are_all_but_those_with_room_for_the_smallest():
    left = {2: 2, 3: 2, 5: 1}
    got = list(ways([2, 3, 5], left, 8))
    assert [room for taken, room in got] == [8 - sum(s * n for s, n in taken) for taken, _ in got]
    every = {(a, b, c) for a in range(3) for b in range(3) for c in range(2) if 2 * a + 3 * b + 5 * c <= 8}
    kept = {(a, b, c) for a, b, c in every if (a + 1, b, c) not in every}
    assert sorted(tuple(dict(taken).get(s, 0) for s in (2, 3, 5)) for taken, _ in got) == sorted(kept)
    assert got[0] == (((5, 1), (3, 1)), 0) and list(ways([], {}, 4)) == [((), 4)]


@pytest.mark.parametrize("most, spare", [(1, 0), (3, 10), (1000, 10**6)])
def test_dive_packs_every_item(most, spare):
    rnd = random.Random(6)
    for _ in range(100):
        capacity = rnd.choice([1, 9, 60])
        counts = Counter(rnd.randrange(1, capacity + 1) for _ in range(rnd.randrange(40)))
        assert items_of(dive(counts, capacity, most, spare), capacity) == counts


def test_domination_equals_trying_every_part():
    rnd = random.Random(7)
    for _ in range(500):
        filling = [(size, rnd.randrange(1, 4)) for size in sorted(rnd.sample(range(1, 12), rnd.randrange(4)), reverse=True)]
        items = [size for size, n in filling for _ in range(n)]
        room, x = rnd.randrange(5), rnd.randrange(1, 30)
        parts = [[size for k, size in enumerate(items) if m >> k & 1] for m in range(1 << len(items))]
        # In place of none or one, it is larger; of more, it may be as large.
        want = any(sum(p) + (len(p) < 2) <= x <= sum(p) + room for p in parts)
        assert dominated(filling, 1 << x, room) == want


# --- places ------------------------------------------------------------------------------------


def test_slots_fill_every_sequence_without_gaps():
    counts = Counter(random.Random(2).choices(range(1, 60), k=500))
    packing = complete(counts, 100)
    slots, got = Slots.of(packing), defaultdict(list)
    for length, n in counts.items():
        seq, off = slots.places(np.full(n, length), np.arange(n))
        for q, o in zip(seq.tolist(), off.tolist()):
            got[q].append((o, length))
    assert sorted(got) == list(range(packing.n))
    for inside in got.values():
        at = 0
        for o, length in sorted(inside):
            assert o == at
            at += length
        assert at <= 100


def test_numbers_within_a_length():
    seen = np.zeros(10, np.int64)
    assert numbered(np.array([3, 5, 3, 3, 5]), seen).tolist() == [0, 0, 1, 2, 1]
    assert numbered(np.array([5, 1, 3]), seen).tolist() == [2, 0, 3]
    assert numbered(np.zeros(0, np.int64), seen).tolist() == []


# --- documents ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def brute(tokenizer, rows, capacity):
    out = []
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            raw = np.array(ids[k : k + capacity], "<u4").tobytes()
            out.append((doc_id, k // capacity, k, len(raw) // 4, zlib.crc32(raw)))
    return sorted(out, key=key)


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("most", [5, 64, 1 << 22])
@pytest.mark.parametrize("capacity", [1, 4, 100])
def test_pieces_of_long_texts_in_parts(tokenizer, most, capacity):
    s = Settings(capacity=capacity)
    for text in [*TEXTS, "word " * 33, "x" * 200, " ", "\n\n a"]:
        got = [(None, p, start, len(ids), zlib.crc32(ids.tobytes())) for _, p, start, ids in pieces_of(encoder(tokenizer_path()), pa.array([text], pa.string()), s, most)]
        assert got == brute(tokenizer, [(None, text)], capacity)


def sound(got, capacity):
    """Every sequence without gaps and within the capacity; returns how many there are."""
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for inside in by.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def corpus():
    rnd = random.Random(8)
    rows = [(k, " ".join(rnd.choice(["one", "two", "Three,", "été", "x1y2"]) for _ in range(int(rnd.paretovariate(0.7) * 3) % 700))) for k in range(300)]
    rows += [(400 + k, "hot text of six words") for k in range(150)]  # a third of all rows has one length
    return rows + [(1000, None), (1001, ""), (1002, "long " * 5000), (None, "null id"), (None, "null id"), (7, "again"), (7, "again")]


@pytest.mark.parametrize("capacity", [16, 128, 4096])
def test_packing_equals_brute_force_in_pieces_and_needs_few_sequences(make, tokenizer, capacity):
    rows, s = corpus(), Settings(capacity=capacity)
    df = make(rows, clash=True, parts=7).selectExpr("*", "'x' AS length", "'y' AS part", "'z' AS sequence_id", "1 AS first")
    got = packed(df, tokenizer_path(), s)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = got.collect()
    want = brute(tokenizer, rows, capacity)
    assert sorted((tuple(r)[:5] for r in got), key=key) == want
    assert sound(got, capacity) == complete(Counter(r[3] for r in want), capacity).n
    least = -(-sum(r[3] for r in want) // capacity)
    assert sound(got, capacity) == least if capacity > 16 else sound(got, capacity) <= 1.02 * least  # full but for the last


def test_sequences_hold_the_ids_of_their_pieces(make, tokenizer):
    rows, s = corpus(), Settings(capacity=256)
    want = Counter((r[0], r[1], r[3], r[4]) for r in brute(tokenizer, rows, 256))
    got = Counter()
    for r in sequences(make(rows, parts=5), tokenizer_path(), s).collect():
        ids, at = bytes(r["ids"]), 0
        for p in r["pieces"]:
            assert p["offset"] == at
            at += p["length"]
            got[p["doc_id"], p["piece"], p["length"], zlib.crc32(ids[4 * p["offset"] : 4 * at])] += 1
        assert len(ids) == 4 * at <= 1024
    assert got == want


def test_empty_table(make):
    none = make([(1, "a")]).where("false")
    assert packed(none, tokenizer_path()).count() == 0 and sequences(none, tokenizer_path()).count() == 0


def test_numbers_are_stored_with_the_pieces(make):
    """A task's numbers are read, not made again: two reads give the same places."""
    cut = pieces(make(corpus(), parts=6), tokenizer_path(), Settings())
    plan = cut._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and cut.count() == len({(r["part"], r["length"], r["nth"]) for r in cut.collect()})
    assert isinstance(complete({}, 10), Packing)
