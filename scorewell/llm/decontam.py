"""Benchmark decontamination under word edits.

Documents and benchmark items are sequences of words (letters and digits,
A-Z lower-cased).  A document is contaminated by an item if one of its
passages can be turned into the whole item with at most ``Settings.share`` of
the item's words inserted, deleted or replaced.

Items are sought by length, each with windows of its own size: of a document, the
windows of that many words in which enough words are those items' at all.  (A passage
within the allowed edits misses one word for each edit at most, so the window at its
start always has enough.)  Each goes through CGK random walks (the walk repeats
or advances a word by a coin that the step and the word decide, so that few edits
change few of its outputs: edit distance becomes Hamming distance).  Of each walk's
outputs some are sampled into a hash key, several times; an equal key makes a
candidate.  There are as many walks as it takes for the share of passages at the
full number of edits that become candidates, simulated on random words for each
length, to reach ``Settings.recall``.  Each candidate is verified by the exact
edit distance between the item and the passage around the window.

Lengths above ``Settings.exact`` words are taken together in classes that differ by a
tenth at most; their windows have the size of the shortest, and of a longer item
its first words.

Items travel to the documents in blocks of bounded size, so documents are never
shuffled and no pair of texts is formed that shares no key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import ALNUM, blank_text, mix, slices, tidy, utf8, words


@dataclass(frozen=True)
class Settings:
    #: Edits allowed, as a share of the item's words.
    share: float = 0.2
    #: Outputs of a walk in a key, and keys of a walk.
    samples: int = 3
    sets: int = 3
    #: Walks at most.
    walks: int = 32
    #: Least share of edited passages, of each item length, that must become candidates; measured on so many random items.
    recall: float = 0.99
    trials: int = 300
    #: Lengths that have windows of exactly their size; longer ones share windows within this ratio.
    exact: int = 32
    ratio: float = 1.1
    #: Words of items sent to the documents at once.
    block_words: int = 1_000_000
    seed: int = 29


# --- random walks -------------------------------------------------------------------------------

PAD = np.uint64(0x2545F4914F6CDD1D)


def walk_key_sets(h: np.ndarray, at: np.ndarray, size: int, walk: int, s: Settings, ends: np.ndarray | None = None) -> list[np.ndarray]:
    """Keys of the windows of ``size`` words that start at ``at``, from outputs of one CGK walk sampled ``sets`` times.

    A window that reaches beyond its text's end (``ends``) goes on with padding.
    """
    rng = np.random.default_rng([s.seed, size, walk])
    steps = 2 * size  # by then about half of the walks have read the whole window
    coins = rng.integers(1, 2**63, steps, dtype=np.uint64) | np.uint64(1)
    picked = [frozenset(rng.choice(steps, min(s.samples, steps), replace=False).tolist()) for _ in range(s.sets)]
    length = size if ends is None else np.minimum(size, ends - at)
    place, keys = np.zeros(len(at), np.int64), [np.full(len(at), walk * s.sets + k, np.uint64) for k in range(s.sets)]
    with np.errstate(over="ignore"):
        for j in range(1 + max(max(p) for p in picked)):
            word = np.where(place < length, h[np.minimum(at + place, len(h) - 1)], PAD)
            for k, p in enumerate(picked):
                if j in p:
                    key = (keys[k] ^ word) * np.uint64(0x9E3779B97F4A7C15)
                    keys[k] = key ^ (key >> np.uint64(29))
            place += ((word * coins[j]) >> np.uint64(63)).astype(np.int64)
    return [mix(key) for key in keys]


def walk_keys(h: np.ndarray, at: np.ndarray, size: int, walk: int, s: Settings) -> np.ndarray:
    """The first of a walk's keys of each window."""
    return walk_key_sets(h, at, size, walk, s)[0]


# --- how many walks ---------------------------------------------------------------------------------


def edited(item: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """The item after so many random edits: half of them replace a word, the others insert or delete one."""
    w = item.tolist()
    for _ in range(edits):
        kind, at, new = rng.random(), int(rng.integers(len(w))) if w else 0, int(rng.integers(1, 2**63))
        if kind < 0.5 and w:
            w[at] = new
        elif kind < 0.75 or not w:
            w.insert(at, new)
        else:
            del w[at]
    return np.array(w, np.uint64)


def size_of(n: int, s: Settings) -> int:
    """The size of the windows by which items of ``n`` words are sought."""
    if n <= s.exact:
        return n
    size = s.exact + 1
    while (longer := max(size + 1, int(size * s.ratio))) <= n:
        size = longer
    return size


def simulated_recall(n: int, s: Settings) -> list[float]:
    """By number of walks: the share of items of ``n`` random words that share a key with their passage at
    the full number of edits, found as ``candidates`` does among other words."""
    rng, most, size = np.random.default_rng([s.seed, n]), int(s.share * n), size_of(n, s)
    items, bodies, windows = [], [], []
    lead = 0
    for _ in range(s.trials):
        item = rng.integers(1, 2**63, n, dtype=np.uint64)
        around = rng.integers(1, 2**63, 2 * n, dtype=np.uint64)
        doc = np.concatenate([around[:n], edited(item, most, rng), around[n:]])
        windows.append(gated(np.concatenate([[0], np.cumsum(np.isin(doc, item))]), size, most) + lead)
        items.append(item)
        bodies.append(doc)
        lead += len(doc)
    text, body, at = np.concatenate(items), np.concatenate(bodies), np.concatenate(windows)
    whose = np.repeat(np.arange(s.trials), [len(w) for w in windows])
    ends = np.cumsum([len(b) for b in bodies])[whose]
    found, share = np.zeros(s.trials, bool), []
    for w in range(s.walks):
        mine = walk_key_sets(text, np.arange(s.trials) * n, size, w, s)
        for a, b in zip(mine, walk_key_sets(body, at, size, w, s, ends), strict=True):
            found[whose[a[whose] == b]] = True
        share.append(float(found.mean()))
        if share[-1] >= s.recall:
            break
    return share


@lru_cache(maxsize=None)
def walks_for(n: int, s: Settings) -> int:
    """Walks that items of ``n`` words need for the recall, ``Settings.walks`` at most."""
    return 1 if not int(s.share * n) else len(simulated_recall(n, s))


# --- items ----------------------------------------------------------------------------------------


@dataclass
class Keys:
    """Sorted keys of the items of one class, and whose they are."""

    size: int
    #: Edits allowed to the longest of them.
    most: int
    walks: int
    keys: np.ndarray
    item: np.ndarray
    #: Which words of the vocabulary (and, last, of none) they have.
    has: np.ndarray


@dataclass
class Items:
    ids: list[int | None]
    words: list[np.ndarray]
    vocabulary: np.ndarray
    classes: list[Keys]
    settings: Settings


def prepare(ids: list[int | None], texts: list[str], s: Settings) -> Items:
    """Items without words take no part."""
    h, _, _, first = words(*utf8(pa.array(texts, pa.string())), ALNUM)
    each = [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    used = [k for k, w in enumerate(each) if len(w)]
    each, ids = [each[k] for k in used], [ids[k] for k in used]
    vocabulary = np.unique(h)
    members: dict[int, list[int]] = {}
    for k, w in enumerate(each):
        members.setdefault(size_of(len(w), s), []).append(k)
    classes = []
    for size, mine in sorted(members.items()):
        longest = max(len(each[k]) for k in mine)
        walks = max(walks_for(n, s) for n in {len(each[k]) for k in mine})
        text = np.concatenate([each[k] for k in mine])
        starts = np.cumsum([0, *(len(each[k]) for k in mine)])[:-1]
        keys = np.concatenate([key for w in range(walks) for key in walk_key_sets(text, starts, size, w, s)])
        order = np.argsort(keys, kind="stable")
        has = np.append(np.isin(vocabulary, text), False)
        classes.append(Keys(size, int(s.share * longest), walks, keys[order], np.tile(mine, walks * s.sets)[order], has))
    return Items(ids, each, vocabulary, classes, s)


def item_blocks(benchmark: DataFrame, s: Settings) -> Iterator[Items]:
    """The items (item_id, text) in blocks of about ``block_words`` words.

    Rows with the same id, or with none, are items of their own.
    """
    rows = benchmark.select(F.col("item_id").try_cast("bigint").alias("item_id"), blank_text(F.col("text")).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (6 * s.block_words)))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        if part:
            yield prepare([r["item_id"] for r in part], [r["text"] for r in part], s)


# --- candidates and verification -------------------------------------------------------------------


def passage_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """(edits, end) of the passage of the region that is nearest to the whole item; the first such end."""
    row = np.zeros(len(region) + 1, np.int64)
    ramp = np.arange(len(region) + 1)
    for i, w in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (region != w))
        row = np.minimum.accumulate(new - ramp) + ramp
    end = int(row.argmin())
    return int(row[end]), end


def nearest_passage(item: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int] | None:
    """(edits, start in the region), or None if more than ``most`` are needed."""
    if not len(region) or _among(item, np.sort(region)).sum() < len(item) - most:  # each missing word costs an edit
        return None
    edits, end = passage_distance(item, region)
    if edits > most:
        return None
    _, back = passage_distance(item[::-1], region[:end][::-1])
    return edits, end - back


#: Pairs of equal keys that one vectorised step looks at.
PAIRS = 1 << 20


def gated(known: np.ndarray, size: int, most: int) -> np.ndarray:
    """Places whose window of ``size`` words has all but ``most`` among the known, which ``known`` counts before each place.

    Near a text's end a window may count words of the next text, never fewer than its own.
    """
    n = len(known) - 1
    after = np.concatenate([known[size:], np.full(min(size, n + 1), known[-1])])[: n]
    return np.flatnonzero(after - known[:n] >= max(1, size - most))


def candidates(h: np.ndarray, first: np.ndarray, x: Items) -> Iterator[tuple[int, int, int]]:
    """(document, item, word where the item would start), from equal keys; each once.

    A region with too few words that the item's class has is left out.
    """
    s, lens = x.settings, np.array([len(w) for w in x.words], np.int64)
    most = (s.share * lens).astype(np.int64)
    at = np.minimum(np.searchsorted(x.vocabulary, h), max(len(x.vocabulary) - 1, 0))
    word = np.where(x.vocabulary[at] == h, at, len(x.vocabulary)) if len(x.vocabulary) else np.zeros(len(h), np.int64)
    for c in x.classes:
        known = np.zeros(len(h) + 1, np.int32)
        np.cumsum(c.has[word], out=known[1:])
        at = gated(known, c.size, c.most)
        doc = np.searchsorted(first, at, "right") - 1
        ends = first[doc + 1]
        keep = ends - at >= c.size - c.most
        at, doc, ends = at[keep], doc[keep], ends[keep]
        found = []
        for keys in (key for w in range(c.walks) for key in (walk_key_sets(h, at, c.size, w, s, ends) if len(at) else ())):
            low = np.searchsorted(c.keys, keys, "left")
            count = np.searchsorted(c.keys, keys, "right") - low
            hit = np.flatnonzero(count)
            ends_of = np.cumsum(count[hit])
            for part in np.split(hit, np.unique(np.searchsorted(ends_of, np.arange(PAIRS, ends_of[-1] if len(hit) else 0, PAIRS)))):
                times = count[part]
                entry = np.repeat(low[part] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
                part = np.repeat(part, times)
                of, item, start = doc[part], c.item[entry], at[part]
                a = np.maximum(first[of], start - most[item])
                b = np.minimum(first[of + 1], start + lens[item] + 3 * most[item])
                enough = known[b] - known[a] >= lens[item] - most[item]
                if enough.any():
                    found.append(np.unique(np.stack([of, item, start], axis=1)[enough], axis=0))
        if found:
            yield from np.unique(np.concatenate(found), axis=0).tolist()


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def matches(column: pa.Array, x: Items) -> dict[tuple[int, int], tuple[int, int]]:
    """(document, item): (edits, first word of the passage in the document), the fewest edits, then the first place."""
    h, _, _, first = words(*utf8(column), ALNUM)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    done: dict[tuple[int, int], int] = {}
    for doc, item, start in candidates(h, first, x):
        w = x.words[item]
        most = int(x.settings.share * len(w))
        # The candidates of a pair come in order; one region serves all starts within its slack.
        if (doc, item) in done and start <= done[doc, item]:  # a start may be negative
            continue
        done[doc, item] = start + most
        low, high = max(int(first[doc]), start - most), min(int(first[doc + 1]), start + len(w) + 3 * most)
        if got := nearest_passage(w, h[low:high], most):
            at = (got[0], low + got[1] - int(first[doc]))
            if (doc, item) not in best or at < best[doc, item]:
                best[doc, item] = at
    return best


RESULT = "doc_id bigint, item_id bigint, edits bigint, item_words bigint, first_word bigint"


def _text_only(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").try_cast("bigint").alias("doc_id"), blank_text(F.col("text")).alias("text"))


def contamination(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per (document, item) found: the fewest edits and where the passage starts, in words.

    Null and empty texts hold nothing; an id that is no number is null; texts of any
    length are read whole, and of passages with equally few edits the first counts; a row of ``docs`` with a repeated id gives
    rows of its own.  Other columns play no part; no documents or no items, no rows.
    """
    s, found = settings or Settings(), None
    for x in item_blocks(benchmark, s):

        def run(batches: Iterator[pa.RecordBatch], x: Items = x) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    best = matches(part.column("text"), x)
                    ids = part.column("doc_id").to_pylist()
                    cols = [[], [], [], [], []]
                    for (doc, item), (edits, at) in best.items():
                        for col, v in zip(cols, (ids[doc], x.ids[item], edits, len(x.words[item]), at), strict=True):
                            col.append(v)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in cols], names=["doc_id", "item_id", "edits", "item_words", "first_word"]
                    )

        part = _text_only(docs).mapInArrow(tidy(run), RESULT)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], RESULT) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents without a passage of any item, with all their columns."""
    for x in item_blocks(benchmark, settings or Settings()):

        def run(batches: Iterator[pa.RecordBatch], x: Items = x) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    keep = np.ones(part.num_rows, bool)
                    keep[[doc for doc, _ in matches(part.column("text"), x)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(tidy(run), docs.schema)
    return docs
