"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts and benchmark items are sequences of words (ASCII letters lower-cased, punctuation
dropped). A document leaks an item if some window of it is within an edit distance of a
fifth of the item's words.

The CGK embedding walks a string at random: at each step it emits the current word and, by a
random bit of that word, stays or moves on. Two strings at small edit distance that walk by
the same bits emit sequences at small Hamming distance. Bit sampling then compares a few
positions of the emitted sequences: windows that agree in all sampled positions of one of
the repeated hashes become candidates. The number of positions and of repeats follows, for
each item size, from the recall asked for and the chance that a passage at that size's edit
bound agrees with its item; where too many repeats were needed, every window is a candidate.
Candidates are decided by the exact edit distance.

Windows are item-sized and start at every word. Within k edits, an item of n words keeps at
least n - 2 - 3k of its word triples, so only windows with that many triples of one item are
embedded; where that number is not positive, all windows are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.llm.common import ROW, drop, id_and_text, keyed
from strataward.llm.words import mix, run_hashes, slices, word_hashes

BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
EDIT_PERCENT = 20
GRAM = 3
RECALL = 0.99  # share of the passages at the edit bound that become candidates
SAMPLED = 4  # emitted positions in a hash, at most
REPEATS = 64  # of hashes with two positions or more, at most
MOST_REPEATS = 256  # of hashes with one position, at most
# Steps of a walk per word of the item. CGK's third one mostly emits what follows the end, on which any two windows agree.
STRETCH = 2
PASSAGES, WALKS = 64, 48  # passages of each kind of edit, and walks over each, that chances are taken from
EACH_SIZE = 60  # items up to this size have chances of their own
BLOCK_BYTES = 1 << 20  # benchmark text held by a task at once
MARK_BITS = 22


def edited_windows(n: int, kind: int, rng: np.random.Generator) -> np.ndarray:
    """Windows of n words on passages that use up the edits of the item 1 .. n by replacing, inserting or deleting words."""
    k = bound_of(n)
    out = np.empty((PASSAGES, n), np.int64)
    for own in out:
        item, new = np.arange(1, n + 1), np.arange(n + 1, n + 1 + k)
        if kind == 0:
            item[rng.choice(n, k, replace=False)] = new
        elif kind == 1:
            item = np.insert(item, 1 + rng.choice(n - 1, k, replace=False), new)
        else:
            item = np.concatenate((np.delete(item, rng.choice(n, k, replace=False)), new))
        own[:] = item[:n]
    return out


@lru_cache(maxsize=512)
def collision_chances(n: int) -> np.ndarray:
    """Chance that a passage at the edit bound agrees with its item in 1 .. SAMPLED sampled positions, by kind of edit and passage.

    The words of an item are distinct here, which is the worst case: walks that are apart
    agree in no word.
    """
    rng = np.random.Generator(np.random.PCG64(n))
    steps = STRETCH * n
    item = np.append(np.arange(1, n + 1), 0)
    windows = np.concatenate([edited_windows(n, kind, rng) for kind in range(3)])
    windows = np.repeat(np.pad(windows, ((0, 0), (0, 1))), WALKS, axis=0)
    row = np.arange(len(windows))
    at, there, equal = np.zeros_like(row), np.zeros_like(row), np.zeros_like(row)
    for _ in range(steps):
        word, other = item[at], windows[row, there]
        same = word == other
        equal += same
        coins = rng.integers(0, 4, len(row))
        at += (coins & 1) * (word > 0)
        there += np.where(same, coins & 1, coins >> 1) * (other > 0)
    drawn = np.arange(SAMPLED)[:, None]
    chance = np.cumprod(np.maximum(equal - drawn, 0) / (steps - drawn), axis=0)
    return chance.reshape(SAMPLED, 3, PASSAGES, WALKS).mean(axis=3)


@lru_cache(maxsize=4096)
def hash_plan(n: int, recall: float = RECALL) -> tuple[int, int]:
    """Sampled positions and repeats for items of n words: the most positions whose repeats stay in bounds.

    No repeats: every window is compared. Chances fall with the size, so sizes above
    ``EACH_SIZE`` take those of the next of some sizes.
    """
    if not bound_of(n):
        return min(SAMPLED, STRETCH * n), 1
    if n > EACH_SIZE:
        step = 5 << max(0, n.bit_length() - 6)
        n = -(-n // step) * step
    if n > 4 * MOST_REPEATS:
        return 0, 0
    chances = collision_chances(n)
    for sampled in range(SAMPLED, 0, -1):
        repeats = np.arange(1, (REPEATS if sampled > 1 else MOST_REPEATS) + 1)
        share = (1 - (1 - chances[sampled - 1][:, :, None]) ** repeats).mean(axis=1).min(axis=0)
        enough = np.flatnonzero(share >= recall)
        if len(enough):
            return sampled, int(repeats[enough[0]])
    return 0, 0


@lru_cache(maxsize=512)
def walk_plan(n: int, sampled: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """Per repeat and step: the multiplier that gives a word's random bit, and whether the step is sampled."""
    rng = np.random.Generator(np.random.PCG64(1000 + n))
    steps = STRETCH * n
    bits = rng.integers(0, 2**63, (repeats, steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    taken = np.zeros((repeats, steps), bool)
    for r in range(repeats):
        taken[r, rng.choice(steps, sampled, replace=False)] = True
    return bits, taken


def embed(words: np.ndarray, starts: np.ndarray, n: int, plan: tuple[int, int]) -> np.ndarray:
    """Sampled keys, one row per repeat, of the windows of n words at ``starts``; a walk past the end emits 0."""
    bits, sampled = walk_plan(n, *plan)
    repeats = len(bits)
    padded = np.concatenate((words, np.zeros(1, np.uint64)))
    ends = np.minimum(starts + n, len(words))
    at = np.repeat(starts[None, :], repeats, axis=0)
    key = np.repeat(np.arange(1, repeats + 1, dtype=np.uint64)[:, None], len(starts), axis=1)
    for step in range(bits.shape[1]):
        word = np.where(at < ends, padded[np.minimum(at, len(words))], np.uint64(0))
        take = sampled[:, step]
        if take.any():
            key[take] = mix(key[take] + word[take])
        at = at + ((word * bits[:, step : step + 1]) >> np.uint64(63)).astype(np.int64)
    return key


class Items:
    """A block of benchmark items with an index of their word triples and of their sampled keys."""

    def __init__(self, ids: list[int], words: list[np.ndarray], plans: dict[int, tuple[int, int]] | None = None) -> None:
        self.ids, self.words = ids, words
        self.plans = {n: hash_plan(n) for n in {len(w) for w in words}} if plans is None else plans
        self.sized: dict[int, list[int]] = {}
        self.marks = np.zeros(1 << MARK_BITS, bool)
        self.grams: dict[int, list[int]] = {}
        self.open_sizes: set[int] = set()
        self.tables: dict[int, list[dict[int, list[int]]]] = {}
        for i, w in enumerate(words):
            n = len(w)
            if least_grams(n) <= 0:
                self.open_sizes.add(n)
            for g in np.unique(run_hashes(w, GRAM)):
                self.marks[int(g >> np.uint64(64 - MARK_BITS))] = True
                self.grams.setdefault(int(g), []).append(i)
            self.sized.setdefault(n, []).append(i)
            tables = self.tables.setdefault(n, [{} for _ in range(self.plans[n][1])])
            if tables:
                for table, key in zip(tables, embed(w, np.array([0]), n, self.plans[n])[:, 0]):
                    table.setdefault(int(key), []).append(i)


def bound_of(n: int) -> int:
    return n * EDIT_PERCENT // 100


def least_grams(n: int) -> int:
    """Triples of an item of n words that are left within the edit bound."""
    return n - (GRAM - 1) - GRAM * bound_of(n)


def window_starts(words: np.ndarray, items: Items) -> dict[int, np.ndarray]:
    """For each item size, where windows start that have enough triples of one item of that size."""
    grams = run_hashes(words, GRAM)
    near = np.flatnonzero(items.marks[(grams >> np.uint64(64 - MARK_BITS)).astype(np.int64)])
    places: dict[int, list[int]] = {}
    for p, g in zip(near.tolist(), grams[near].tolist()):
        for i in items.grams.get(g, ()):
            places.setdefault(i, []).append(p)
    found: dict[int, list[np.ndarray]] = {n: [np.arange(len(words))] for n in items.open_sizes}
    for i, at in places.items():
        n = len(items.words[i])
        least, width = least_grams(n), n + bound_of(n) - GRAM + 1
        if n in items.open_sizes or len(at) < least:
            continue
        for first, last in zip(at, at[least - 1 :]):
            if last - first < width:
                found.setdefault(n, []).append(np.arange(max(0, last - width + 1), first + 1))
    return {n: np.unique(np.concatenate(s)) for n, s in found.items()}


def edit_distance(window: np.ndarray, item: np.ndarray, bound: int) -> tuple[int, int]:
    """Least edits from ``item`` to a beginning of ``window``, and that beginning's length; bound + 1 if more."""
    m = len(item)
    row = np.arange(len(window) + 1)
    span = np.arange(len(window) + 1)
    for i in range(1, m + 1):
        step = np.empty_like(row)
        step[0] = i
        step[1:] = np.minimum(row[1:] + 1, row[:-1] + (window != item[i - 1]))
        row = np.minimum.accumulate(step - span) + span  # insertions run along the row
        if row.min() > bound:
            return bound + 1, 0
    best = int(row.argmin())
    return int(row[best]), best


def candidates(words: np.ndarray, starts: np.ndarray, n: int, items: Items) -> Iterator[tuple[int, int]]:
    """(start, item number) of windows that share a key with an item of n words, or of all windows where there are no keys."""
    if not items.tables[n]:
        yield from ((s, i) for s in starts.tolist() for i in items.sized[n])
        return
    for table, keys in zip(items.tables[n], embed(words, starts, n, items.plans[n]).tolist()):
        for s, key in zip(starts.tolist(), keys):
            for i in table.get(key, ()):
                yield s, i


def find_leaks(words: np.ndarray, items: Items) -> list[tuple[int, int, int, int]]:
    """(item number, first word, words, edits) of the best window of each leaked item; the first of equally good ones."""
    found: dict[int, tuple[int, int, int]] = {}
    for n, starts in (window_starts(words, items) if len(words) else {}).items():
        k = bound_of(n)
        tried: set[tuple[int, int]] = set()
        for s, i in candidates(words, starts, n, items):
            best = found.get(i, (0, 0, k))[2]  # only as good a window matters
            if (s, i) in tried or (i in found and best == 0):
                continue
            tried.add((s, i))
            edits, size = edit_distance(words[s : s + n + k], items.words[i], best)
            if edits <= best and (i not in found or (edits, s) < (found[i][2], found[i][0])):
                found[i] = (s, size, edits)
    return [(i, *where) for i, where in sorted(found.items())]


def item_blocks(benchmark: DataFrame, recall: float = RECALL) -> Iterator[Items]:
    """Benchmark items in blocks of bounded size; empty items are left out, repeated ids stay."""
    texts = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for block in range(blocks):
        own = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        words, offsets = word_hashes([r.text.encode().lower() for r in own], BREAK)
        each = [(r.item_id, words[b:e]) for r, b, e in zip(own, offsets[:-1], offsets[1:]) if e > b]
        yield Items([i for i, _ in each], [w for _, w in each], {n: hash_plan(n, recall) for n in {len(w) for _, w in each}})


def leaks(rows: DataFrame, benchmark: DataFrame, recall: float = RECALL) -> DataFrame:
    """``_row``, ``doc_id``, ``item_id``, ``start``, ``length``, ``edits``: one row per document and leaked item.

    ``start`` and ``length`` count words of the document; of several windows the one with the
    fewest edits is given. ``recall`` is asked for at the edit bound; passages with fewer edits
    are found more often. Null and empty texts and items leak nothing. The documents are
    read once per block of items (``BLOCK_BYTES`` of benchmark text); they are not shuffled.
    """
    schema = f"{ROW} long, doc_id long, item_id long, start int, length int, edits int"
    texts = id_and_text(rows)
    spark = rows.sparkSession
    parts = []
    for items in item_blocks(benchmark, recall):
        held = spark.sparkContext.broadcast((items.ids, items.words, items.plans))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            own = Items(*held.value)
            for batch in batches:
                for part, said in slices(batch):
                    words, offsets = word_hashes([t.lower() for t in said], BREAK)
                    out = [
                        (row, doc, own.ids[i], s, n, e)
                        for row, doc, b, end in zip(part[ROW].to_pylist(), part["doc_id"].to_pylist(), offsets[:-1], offsets[1:])
                        for i, s, n, e in find_leaks(words[b:end], own)
                    ]
                    columns = list(zip(*out)) if out else [()] * 6
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[ROW, "doc_id", "item_id", "start", "length", "edits"])

        parts.append(texts.mapInArrow(run, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL) -> DataFrame:
    """``doc_id``, ``item_id``, ``start``, ``length``, ``edits`` of every leak; clean documents have no row."""
    return leaks(keyed(docs), benchmark, recall).drop(ROW)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL) -> DataFrame:
    """The documents that leak no benchmark item, with their own columns."""
    rows = keyed(docs)
    return drop(rows, leaks(rows, benchmark, recall).select(ROW).distinct())
