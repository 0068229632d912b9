"""Token counts by byte-pair merging with a heap and a linked list.

A text becomes units as the tokenizer file says (normalisation, then letter runs, digits and
symbol runs as bytes). A unit starts as one symbol per byte, the last with the mark of a word's
end. Adjacent pairs wait in a heap by rank; the lowest is merged in a linked list of symbols,
which makes at most two new pairs. What is counted is the symbols minus the merges: no ids and
no token strings are made. A unit of n bytes costs n log n, so a word of a million letters is
no different from others.

Words repeat, so each worker keeps the counts of words it has met, up to a bound.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.llm.words import slices

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
CACHE_WORDS = 300_000
CACHED_BYTES = 64  # a longer word is counted anew each time
# Lead bytes of U+0300 to U+037F: only with these can composition tell an upper-case ASCII letter from a lower-case one.
COMBINING = (b"\xcc", b"\xcd")
_counters: dict[str, "TokenCounter"] = {}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    chars = dict(zip(shown, map(chr, shown))) | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [chars[b] for b in range(256)]


class TokenCounter:
    """Counts tokens as the tokenizer of one file gives them, without begin, end or added tokens.

    Special strings inside a text are found before anything else and count one each.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        names: dict[str, int] = {}
        for token in model["vocab"]:
            names[token] = len(names)
        missing = [c for c in byte_symbols() if c not in names or c + self.suffix not in names]
        if model["type"] != "BPE" or missing:
            raise ValueError("a byte-level BPE file with a symbol for every byte is needed")
        self.width = len(names)
        self.inner = [names[c] for c in byte_symbols()]
        self.last = [names[c + self.suffix] for c in byte_symbols()]
        self.of_char = {c: b for b, c in enumerate(byte_symbols())}
        # pair of symbols: rank of their merge, and the symbol it makes
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.rank[names[left] * self.width + names[right]] = len(self.made)
            self.made.append(names[left + right])
        self.normalize = Tokenizer.from_file(file).normalizer.normalize_str
        self.split = Tokenizer.from_file(file).pre_tokenizer.pre_tokenize_str
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = [s.encode() for s in special]
        self.special_parts = re.compile("|".join(map(re.escape, special)).encode()) if special else None
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def unit(self, data: bytes) -> int:
        """Tokens of one unit of at least one byte: its symbols minus its merges."""
        n = len(data)
        inner, rank, made, width = self.inner, self.rank.get, self.made, self.width
        symbol = [inner[b] for b in data]
        symbol[-1] = self.last[data[-1]]
        # rank and place in one number: the heap gives the lowest rank, the leftmost first
        heap = [r << 32 | i for i, pair in enumerate(zip(symbol, symbol[1:])) if (r := rank(pair[0] * width + pair[1])) is not None]
        if not heap:
            return n
        heapify(heap)
        after = array("i", range(1, n + 1))
        before = array("i", range(-1, n - 1))
        merges = 0
        while heap:
            top = heappop(heap)
            r, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if j >= n or symbol[i] < 0 or rank(symbol[i] * width + symbol[j]) != r:
                continue  # one of the two has been merged since
            symbol[i] = new = made[r]
            symbol[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(new * width + symbol[k])) is not None:
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := rank(symbol[h] * width + new)) is not None:
                heappush(heap, r << 32 | h)
            merges += 1
        return n - merges

    def word(self, word: bytes) -> int:
        """Tokens of text without special strings; a run without white space is enough."""
        if word.isalpha():  # ASCII letters only
            return self.unit(word.lower())
        units = self.split(self.normalize(word.decode()))
        return sum(self.unit(bytes(map(self.of_char.__getitem__, shown))) for shown, _ in units)

    def marked(self, text: bytes) -> int:
        """Tokens of a text that may hold special strings."""
        found = self.special_parts.findall(text)
        return len(found) + sum(self.count([p])[0] for p in self.special_parts.split(text))

    def _learn(self, words: set[bytes]) -> None:
        for w in words:
            known = self.old.get(w)
            if known is None:
                stem = w.rstrip(b".,")  # a run of these after letters is a unit of its own
                if stem and stem != w and stem.isalpha():
                    known = self._known(stem) + self._known(w[len(stem) :])
                else:
                    known = self.word(w)
            self.young[w] = known

    def _known(self, word: bytes) -> int:
        known = self.young.get(word)
        if known is None:
            known = self.old.get(word)
            if known is None:
                known = self.word(word)
            self.young[word] = known
        return known

    def count(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text (UTF-8)."""
        marked = [any(s in t for s in self.special) for t in texts]
        said = [[] if m else (t if any(c in t for c in COMBINING) else t.lower()).split() for t, m in zip(texts, marked)]
        missing = set().union(*said) - self.young.keys()
        long = {w: self.word(w) for w in missing if len(w) > CACHED_BYTES}
        self._learn(missing - long.keys())
        self.young.update(long)
        get = self.young.__getitem__
        out = [sum(map(get, words)) for words in said]
        for w in long:
            del self.young[w]
        if len(self.young) > CACHE_WORDS:
            self.old, self.young = self.young, {}
        return [self.marked(t) if m else n for t, m, n in zip(texts, marked, out)]


def counter(file: str) -> TokenCounter:
    """The worker's counter; made once per process."""
    if file not in _counters:
        _counters[file] = TokenCounter(file)
    return _counters[file]


def count_tokens(docs: DataFrame, file: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row of ``docs``.

    A null or empty text has no bytes and no tokens. Null and repeated ids and repeated rows
    stay as they are: one row comes out for each that goes in, and an empty table gives none.
    Other columns are not read. Whole texts are counted; one of many megabytes passes a worker
    alone, and only a run of bytes without white space is held as one unit. Rows are
    independent: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(file)
        for batch in batches:
            for part, texts in slices(batch):
                sizes = pc.fill_null(pc.binary_length(part["text"]), 0).cast(pa.int64())
                counts = pa.array(tokens.count(texts), pa.int64())
                yield pa.RecordBatch.from_arrays([part["doc_id"], sizes, counts], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
