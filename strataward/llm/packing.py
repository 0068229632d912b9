"""Best-fit packing with large-item matching.

Texts become token ids; a document longer than the capacity is cut into full pieces and a
last one. Packing needs lengths only, and there are at most as many lengths as the capacity:
the plan is made on the histogram of lengths, so its size does not depend on the corpus.
Pieces above a third of the capacity go two to a sequence at most, each with the largest
that still fits beside it. Smaller pieces, longest first, go to the tightest gap. The plan
says, for ranges of the pieces of one length, which sequences they go to and at which
offset; each piece finds its place from its number among the pieces of its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.llm.common import ROW, id_and_text, keyed, numbered, store
from strataward.llm.words import slices

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
CACHE_WORDS = 500_000
GROUP_WORDS = 64
BUCKET_PIECES = 200_000
NEAR_BYTES = 1 << 18
TAIL = b".,"
# Lead bytes of U+0300 to U+037F: only these marks compose with ASCII letters, and not always with both cases.
COMBINING = (b"\xcc", b"\xcd")
_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Token ids of texts through the ids of their words, which repeat.

    The tokenizer drops white space and never joins across it, so the ids of a text are the
    ids of its words in order. ASCII letters are lower-cased first, as the tokenizer does
    itself. Texts with a special token's string, in whatever case, or with combining marks, are
    encoded whole and as they are: the tokenizer finds special tokens, and composes, before it
    lower-cases. The cache is bounded: when it is full, the words used since it was last cut stay.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _encode(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _encode_plain(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters only, some words to a call: each word is one unit, whose last id ends it.

        Where a word makes more than one unit after all, the ends don't add up, and its
        neighbours are encoded one by one.
        """
        groups = [words[i : i + GROUP_WORDS] for i in range(0, len(words), GROUP_WORDS)]
        out: list[bytes] = []
        for own, e in zip(groups, self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) != len(own) or cuts[-1] != 4 * len(ids):
                out += self._encode(own)
                continue
            whole = ids.tobytes()
            out += [whole[a:b] for a, b in zip([0, *cuts], cuts)]
        return out

    def _known(self, words: set[bytes]) -> set[bytes]:
        """Take what the old cache has over to the young one; returns the words still to learn."""
        had = words & self.old.keys()
        self.young.update(zip(had, map(self.old.__getitem__, had)))
        return words - had

    def _learn(self, words: set[bytes]) -> None:
        """Get words into the young cache: from the old one, from a known stem, or from the tokenizer."""
        words = self._known(words)
        tails: list[tuple[bytes, bytes, bytes]] = []
        for w in [w for w in words if w[-1] in TAIL]:
            stem = w.rstrip(TAIL)  # a run of these is one unit apart from the letters before it
            if stem.isalpha() or stem.decode().isalpha():
                tails.append((w, stem, w[len(stem) :]))
        whole = words.difference([w for w, _, _ in tails])
        parts = {p for _, stem, tail in tails for p in (stem, tail)}.difference(self.young, whole)
        ask = list(whole | self._known(parts))
        alpha = [w.isalpha() or w.decode().isalpha() for w in ask]
        plain, rest = list(compress(ask, alpha)), [w for w, a in zip(ask, alpha) if not a]
        self.young.update(zip(plain, self._encode_plain(plain)))
        self.young.update(zip(rest, self._encode(rest)))
        get = self.young.__getitem__
        self.young.update([(w, get(stem) + get(tail)) for w, stem, tail in tails])

    def _cut(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """Runs of texts of about ``NEAR_BYTES``."""
        ends = np.cumsum([len(t) for t in texts])
        cuts, i = [], 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + NEAR_BYTES, side="right")))
            cuts.append((i, j))
            i = j
        return cuts

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        low = [t.lower() for t in texts]
        whole = [any(s in x for s in self.special) or any(c in x for c in COMBINING) for x in low]
        said = [[] if w else x.split() for x, w in zip(low, whole)]
        cuts = self._cut(low)
        need = [set().union(*said[i:j]) for i, j in cuts]
        missing = set().union(*[words.difference(self.young) for words in need])
        if missing:
            self._learn(missing)
        out: list[bytes] = []
        for (i, j), words in zip(cuts, need):
            near = dict(zip(words, map(self.young.__getitem__, words)))  # small enough for the processor's cache
            out += [b"".join(map(near.__getitem__, w)) for w in said[i:j]]
        apart = [i for i, w in enumerate(whole) if w]
        for i, own in zip(apart, self._encode([texts[i] for i in apart])):
            out[i] = own
        if len(self.young) > CACHE_WORDS:
            self.old, self.young = self.young, {}
        return out


def encoder(file: str) -> WordEncoder:
    """The worker's encoder; made once per process."""
    if file not in _encoders:
        _encoders[file] = WordEncoder(file)
    return _encoders[file]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(rows: DataFrame, file: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``_row``, ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` of every piece."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file)
        for batch in batches:
            for part, texts in slices(batch):
                out: list[tuple] = []
                for row, doc, ids in zip(part[ROW].to_pylist(), part["doc_id"].to_pylist(), encode.ids(texts)):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        out.append((row, doc, piece, at // 4, len(own) // 4, zlib.crc32(own), own))
                columns = list(zip(*out)) if out else [()] * 7
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                names = [ROW, "doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    lists = [np.frombuffer(b, "<u4").astype(np.int32) for b in columns[6]]
                    arrays.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"{ROW} long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return id_and_text(rows).mapInArrow(run, schema)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Plan from the number of pieces of each length.

    Returns (length, from, to, first, per_bin, offset): pieces number ``from`` to ``to`` - 1 of
    a length go to the sequences from ``first`` on, ``per_bin`` to each, from ``offset`` on.
    """
    plan: list[tuple[int, int, int, int, int, int]] = []
    used = dict.fromkeys(counts, 0)
    left = {n: c for n, c in counts.items() if c > 0}
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first bin, bins)
    open_gaps: list[int] = []
    bins = 0

    def place(length: int, n_bins: int, per_bin: int, first: int, gap: int) -> None:
        n = n_bins * per_bin
        plan.append((length, used[length], used[length] + n, first, per_bin, capacity - gap))
        used[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]

    def leave(gap: int, first: int, n_bins: int) -> None:
        if gap and n_bins:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(open_gaps, gap)
            gaps[gap].append((first, n_bins))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        top = large[-1]
        if top not in left:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - top) - 1
        while at >= 0 and large[at] not in left:
            del large[at]
            at -= 1
        if at < 0:
            n, mate = left[top], None
        elif large[at] == top:
            n, mate = left[top] // 2, top
            if not n:  # one is left over: the next smaller one goes beside it
                below = [m for m in large[:at] if m in left]
                n, mate = 1, below[-1] if below else None
        else:
            mate = large[at]
            n = min(left[top], left[mate])
        if mate == top:
            place(top, n, 2, bins, capacity)
            leave(capacity - 2 * top, bins, n)
        else:
            place(top, n, 1, bins, capacity)
            if mate is not None:
                place(mate, n, 1, bins, capacity - top)
            leave(capacity - top - (mate or 0), bins, n)
        bins += n
    for length in sorted(left, reverse=True):
        while length in left:
            at = bisect.bisect_left(open_gaps, length)
            if at == len(open_gaps):
                per_bin = capacity // length
                full = left[length] // per_bin
                if full:
                    place(length, full, per_bin, bins, capacity)
                    leave(capacity - per_bin * length, bins, full)
                    bins += full
                else:
                    n = left[length]
                    place(length, 1, n, bins, capacity)
                    leave(capacity - n * length, bins, 1)
                    bins += 1
                continue
            gap = open_gaps[at]
            first, n_bins = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], open_gaps[at]
            per_bin = gap // length
            full = min(n_bins, left[length] // per_bin)
            if full:
                place(length, full, per_bin, first, gap)
                leave(gap - per_bin * length, first, full)
                leave(gap, first + full, n_bins - full)
            else:
                n = left[length]
                place(length, 1, n, first, gap)
                leave(gap - n * length, first, 1)
                leave(gap, first + 1, n_bins - 1)
    return plan


def _plan_table(df: DataFrame, plan: Sequence[tuple]) -> DataFrame:
    schema = "p_length long, lo long, hi long, first long, per_bin long, p_offset long"
    return df.sparkSession.createDataFrame(list(plan), schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every row of ``pieces`` (``_row``, ``piece``, ``length``, ...) a ``sequence_id`` and an ``offset``.

    The driver sees the histogram of lengths, at most ``capacity`` rows, and the plan, whose
    size depends on the capacity only. No piece is dropped; an empty table stays empty.
    """
    counts = dict(pieces.groupBy("length").count().collect())
    plan = plan_bins(counts, capacity)
    buckets = max(16, -(-sum(counts.values()) // BUCKET_PIECES))
    ranked = numbered(pieces, ["length"], [ROW, "piece"], buckets, "rank")
    table = _plan_table(pieces, plan)
    fits = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    at = F.col("rank") - F.col("lo")
    return ranked.join(F.broadcast(table), fits).select(
        *pieces.columns, (F.col("first") + F.floor(at / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + at % F.col("per_bin") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, file: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` (and ``ids``) of every piece.

    A null or empty text is the end id alone. Repeated rows are packed each; null ids stay null.
    """
    pieces = store(token_pieces(keyed(docs), file or tokenizer_path(), capacity, end_id, with_ids), "pieces")
    return pack(pieces, capacity).drop(ROW)
