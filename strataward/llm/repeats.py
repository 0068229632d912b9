"""Substring deduplication by repeated-phrase automata.

A window is 50 consecutive words. The first document, in id order, that has a window keeps
it; in later documents the words it covers go.

1. Anchors: the least hash among a window's 20-word runs. Equal windows have equal anchors,
   so a window can recur only if its anchor is in two documents. Anchors are a few percent of
   the windows and are all that is shuffled for the whole corpus.
2. Confirmed passages: windows under recurring anchors are counted exactly by hash, with the
   first document of each. Runs of confirmed windows in their first document are the phrases.
3. Automata: phrases are dealt to shards by their anchors. A shard compiles one Aho-Corasick
   automaton over words as letters. The neighbourhoods of recurring anchors in all documents
   stream through the automata of their shards, and each hit is extended word by word.

A document equal to an earlier one, word for word, needs no search: all its windows recur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.llm.common import ROW, id_and_text, keyed, store
from strataward.llm.words import lists, run_hashes, slices, window_minima, word_hashes

WINDOW = 50
ANCHOR = 20
SHARD_ANCHORS = 20_000
GROUP_BYTES = 16 << 20
PIECE_WINDOWS = 256
CORE_STARTS = 25  # window starts of one phrase, so that its windows share at least WINDOW - 24 words
NO_ID = (1 << 63) - 1  # null ids come after all others
FIRST_LETTER, LETTERS = 0x10000, 0xF0000
UNKNOWN = "x"


def _anchors(words: np.ndarray) -> np.ndarray:
    """The anchor of each window of a document."""
    return window_minima(run_hashes(words, ANCHOR), WINDOW - ANCHOR + 1)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch):
            words, offsets = word_hashes(texts)
            each = [_anchors(words[b:e]) if e - b >= WINDOW else words[:0] for b, e in zip(offsets[:-1], offsets[1:])]
            each = [np.unique(a[np.concatenate(([True], a[1:] != a[:-1]))]) if len(a) else a for a in each]
            digests = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part[ROW], part["ord"], pa.array(np.diff(offsets)), pa.array(digests), lists(each, pa.int64())],
                names=[ROW, "ord", "n_words", "sha", "anchors"],
            )


def _cut(shards: int):
    """Pieces of documents around their recurring anchors, one run of windows of one shard each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                words, offsets = word_hashes(texts)
                wanted = part["anchors"].to_pylist()
                rows, ords = part[ROW].to_pylist(), part["ord"].to_pylist()
                out: list[tuple] = []
                for i, text in enumerate(texts):
                    own = words[offsets[i] : offsets[i + 1]]
                    anchors = _anchors(own)
                    shard = np.where(np.isin(anchors, np.array(wanted[i], np.int64).view(np.uint64)), (anchors % np.uint64(shards)).astype(np.int64), -1)
                    hashes = run_hashes(own, WINDOW).view(np.int64)
                    said = text.split()
                    edges = np.flatnonzero(np.diff(shard)) + 1
                    for b, e in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(shard)]))):
                        for s in range(b, e, PIECE_WINDOWS) if shard[b] >= 0 else ():
                            t = min(s + PIECE_WINDOWS, e)
                            out.append((rows[i], ords[i], int(shard[b]), s, b" ".join(said[s : t + WINDOW - 1]), hashes[s:t]))
                columns = list(zip(*out)) if out else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                     pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.binary()), lists(list(columns[5]), pa.int64())],
                    names=[ROW, "ord", "shard", "start", "words", "hashes"],
                )

    return run


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of confirmed windows of a document, cut so that all windows of a phrase overlap."""
    for batch in batches:
        for part, texts in slices(batch):
            out: list[tuple] = []
            for text, order, confirmed in zip(texts, part["ord"].to_pylist(), part["confirmed"].to_pylist()):
                said = text.split()
                at = np.array([(c["shard"], c["pos"]) for c in confirmed], np.int64).reshape(-1, 2)
                at = at[np.lexsort((at[:, 1], at[:, 0]))]
                cuts = np.flatnonzero((np.diff(at[:, 0]) != 0) | (np.diff(at[:, 1]) != 1)) + 1
                for run in np.split(at, cuts):
                    for s in range(0, len(run), CORE_STARTS):
                        piece = run[s : s + CORE_STARTS]
                        first, last = int(piece[0, 1]), int(piece[-1, 1])
                        out.append((int(piece[0, 0]), order, last - first, b" ".join(said[first : last + WINDOW])))
            columns = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.binary())],
                names=["shard", "first", "slack", "phrase"],
            )


def compile_phrases(phrases: list[tuple[int, int, bytes]]) -> tuple[ahocorasick.Automaton, dict[bytes, str]]:
    """One automaton for phrases (first document, window starts - 1, words), and the letter of each word.

    Words become letters, so a match is a match of whole words. The automaton looks for the
    words that all windows of a phrase share; the words beside them are kept with it.
    """
    letters: dict[bytes, str] = {}
    found: dict[str, list[tuple[int, str, str]]] = {}
    for first, slack, phrase in phrases:
        said = "".join([letters.setdefault(w, chr(FIRST_LETTER + len(letters))) for w in phrase.split()])
        core = said[slack : len(said) - slack]
        found.setdefault(core, []).append((first, said[:slack], said[len(said) - slack :] if slack else ""))
    if len(letters) > LETTERS:
        raise ValueError("a shard has more words than letters; use more shards")
    automaton = ahocorasick.Automaton()
    for core, beside in found.items():
        automaton.add_word(core, (len(core), beside))
    if found:
        automaton.make_automaton()
    return automaton, letters


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def locate(automaton: ahocorasick.Automaton, letters: dict[bytes, str], words: bytes, order: int) -> list[tuple[int, int]]:
    """Spans of words of a piece that windows of earlier documents cover."""
    said = "".join([letters.get(w, UNKNOWN) for w in words.split()])
    spans = []
    for end, (size, beside) in automaton.iter(said) if len(automaton) else ():
        begin = end + 1 - size
        for first, before, after in beside:
            if first < order:
                left = _common(before[::-1], said[max(0, begin - len(before)) : begin][::-1])
                right = _common(after, said[end + 1 : end + 1 + len(after)])
                if left + size + right >= WINDOW:
                    spans.append((begin - left, end + 1 + right))
    return spans


def _locate_group(phrases: pd.DataFrame, pieces: pd.DataFrame) -> pd.DataFrame:
    automaton, letters = compile_phrases(list(zip(phrases["first"], phrases["slack"], phrases["phrase"])))
    out = [
        (row, start + b, start + e)
        for row, order, start, words in zip(pieces[ROW], pieces["ord"], pieces["start"], pieces["words"])
        for b, e in locate(automaton, letters, words, order)
    ]
    return pd.DataFrame(out, columns=[ROW, "begin", "end"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words removed from each document, and the digest and text of what stays."""
    for batch in batches:
        for part, texts in slices(batch):
            removed, digests, kept_texts = [], [], []
            for text, spans in zip(texts, part["spans"].to_pylist()):
                said = text.split()
                change = np.zeros(len(said) + 1, np.int64)
                for s in spans:
                    change[s["begin"]] += 1
                    change[s["end"]] -= 1
                stays = np.cumsum(change[:-1]) == 0
                kept = b" ".join([said[i] for i in np.flatnonzero(stays)])
                removed.append(int(len(said) - stays.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept)
            yield pa.RecordBatch.from_arrays(
                [part[ROW], pa.array(removed, pa.int64()), pa.array(digests), pa.array(kept_texts, pa.binary()).cast(pa.string())],
                names=[ROW, "cut_words", "cut_sha", "cut_text"],
            )


def repeated_spans(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(figures of every row, documents with recurring anchors, spans to remove from these)."""
    texts = id_and_text(rows).select(ROW, F.coalesce("doc_id", F.lit(NO_ID)).alias("ord"), "text")
    seen = store(texts.mapInArrow(_scan, f"{ROW} long, ord long, n_words long, sha string, anchors array<long>"), "anchors")
    long_ = seen.where(F.col("n_words") >= WINDOW)
    firsts = long_.groupBy("sha").agg(F.min("ord").alias("first"))
    figures = store(
        seen.drop("anchors").join(firsts, "sha", "left").select(ROW, "ord", "n_words", "sha", F.coalesce(F.col("ord") > F.col("first"), F.lit(False)).alias("copy")), "figures"
    )
    own = long_.join(figures.where("NOT copy").select(ROW), ROW, "left_semi").select(ROW, "ord", F.explode("anchors").alias("anchor"))
    twice = store(own.groupBy("anchor").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).where("lo < hi").select("anchor"), "twice")
    shards = max(1, -(-twice.count() // SHARD_ANCHORS))
    wanted = own.join(twice, "anchor").groupBy(ROW).agg(F.collect_list("anchor").alias("anchors"))
    found = store(texts.join(wanted, ROW), "documents")
    pieces = store(
        found.mapInArrow(_cut(shards), f"{ROW} long, ord long, shard int, start int, words binary, hashes array<long>"), "pieces"
    )
    windows = pieces.select("shard", ROW, "ord", "start", F.posexplode("hashes").alias("i", "h"))
    pos = F.col("start") + F.col("i")
    confirmed = (
        windows.groupBy("shard", "h")
        .agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"), F.min_by(ROW, "ord").alias(ROW), F.min_by(pos, "ord").alias("pos"))
        .where("lo < hi").groupBy(ROW).agg(F.collect_list(F.struct("shard", "pos")).alias("confirmed"))
    )
    phrases = found.drop("anchors").join(confirmed, ROW).mapInArrow(_phrases, "shard int, first long, slack int, phrase binary")
    salts = pieces.groupBy("shard").agg(F.ceil(F.sum(F.octet_length("words")) / GROUP_BYTES).cast("int").alias("salts"))
    salted_phrases = phrases.join(salts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "first", "slack", "phrase")
    salted_pieces = pieces.join(salts, "shard").select(
        "shard", F.pmod(F.xxhash64(ROW, "start"), F.col("salts")).cast("int").alias("salt"), ROW, "ord", "start", "words"
    )
    spans = (
        salted_phrases.groupBy("shard", "salt").cogroup(salted_pieces.groupBy("shard", "salt"))
        .applyInPandas(_locate_group, f"{ROW} long, begin int, end int")
    )
    return figures, found, spans


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, where words went, ``kept_text``, for every row.

    A null text has no words; fewer than 50 words lose none. Rows with equal ids do not cut
    each other; null ids come after all others. ``kept_text`` is null where nothing was
    removed from the text (and empty where it repeats an earlier document as a whole).
    """
    rows = keyed(docs)
    figures, found, spans = repeated_spans(rows)
    merged = spans.groupBy(ROW).agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    cut = found.drop("anchors", "ord").join(merged, ROW).mapInArrow(_without, f"{ROW} long, cut_words long, cut_sha string, cut_text string")
    copy = F.col("copy")
    return figures.join(cut, ROW, "left").select(
        F.nullif("ord", F.lit(NO_ID)).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut_words", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("cut_text")).alias("kept_text"),
    )
