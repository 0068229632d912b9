"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A letter trigram is the product of its letters'
vectors, those of the first and second letter rotated by two places and one, so order counts.
A text's profile is the sum over its trigrams; a language's prototype is the sum of the unit
profiles of its training texts. The prediction is the prototype with the largest cosine.

Random letter vectors overlap a little, and every language shares much of its trigrams with
the others, so the mean of the prototypes is taken from both sides before the cosine.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataward.llm.common import chosen, store
from strataward.llm.words import slices

DIMENSIONS = 512
FOLDS = 5
MAX_TRAIN = 5_000  # training texts of a language at most, about; chosen by a hash of id and text
ROWS = 4096  # letter vectors; letters beyond share them by their code
NONE = "und"
_tables: dict[str, np.ndarray] = {}


def letter_vectors() -> np.ndarray:
    """Vectors of the letter rows; row 0 stands for the gap between words."""
    if "vectors" not in _tables:
        rng = np.random.Generator(np.random.PCG64(7))
        _tables["vectors"] = (rng.integers(0, 2, (ROWS, DIMENSIONS), dtype=np.int8) * 2 - 1).astype(np.int8)
        for shift in (1, 2):
            _tables[f"turned{shift}"] = np.roll(_tables["vectors"], shift, axis=1)
    return _tables["vectors"]


def letter_rows() -> np.ndarray:
    """Row of each code point: 0 for everything but letters; upper case counts as lower case."""
    if "rows" not in _tables:
        rows = np.zeros(sys.maxunicode + 1, np.int16)
        for code in range(sys.maxunicode + 1):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                rows[code] = 1 + ord(low[0]) % (ROWS - 1)
        _tables["rows"] = rows
    return _tables["rows"]


def profile(text: str) -> np.ndarray | None:
    """Sum of the trigram vectors of a text; None without letters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = letter_rows()[codes].astype(np.int64)
    if not letters.any():
        return None
    letters = np.concatenate(([0], letters, [0]))
    letters = letters[(letters != 0) | np.concatenate(([True], letters[:-1] != 0))]  # one gap between words
    grams = (letters[:-2] * ROWS + letters[1:-1]) * ROWS + letters[2:]
    grams, counts = np.unique(grams, return_counts=True)
    plain = letter_vectors()
    total = np.zeros(DIMENSIONS)
    for begin in range(0, len(grams), 2048):
        g = grams[begin : begin + 2048]
        bound = _tables["turned2"][g // (ROWS * ROWS)] * _tables["turned1"][g // ROWS % ROWS] * plain[g % ROWS]
        total += counts[begin : begin + 2048].astype(np.float32) @ bound.astype(np.float32)
    return total


def _unit(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v)
    return v / size if size else v


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of unit profiles per language, one set per task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for part, texts in slices(batch):
            for lang, text in zip(part["lang"].to_pylist(), texts):
                p = profile(text.decode("utf-8", "replace"))
                if p is not None:
                    sums[lang] = sums.get(lang, 0) + _unit(p)
    langs = [lang for lang in sums for _ in range(DIMENSIONS)]
    values = np.concatenate(list(sums.values())) if sums else np.empty(0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(sums))), pa.array(values)], names=["lang", "place", "value"]
    )


def fold() -> Column:
    """The row's fold by its id; rows without an id count as held out."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % FOLDS, F.lit(0))


def training_rows(known: DataFrame, max_train: int) -> DataFrame:
    """About ``max_train`` rows of each language, by a hash of id and text; a rarer language keeps all its rows.

    A language of which none is chosen (copies of one row) keeps all of them as well.
    """
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    shares = store(counts.select("lang", (F.lit(float(max_train)) / F.col("n")).alias("share")), "language_shares")
    # one row per language, as many as the prototypes that the driver gets
    sample = known.join(F.broadcast(shares), "lang").where(chosen(F.col("share"), "doc_id", "text"))
    left_out = shares.join(sample.select("lang").distinct(), "lang", "left_anti").select("lang")
    names = [r["lang"] for r in left_out.collect()]
    if names:
        sample = sample.unionByName(known.where(F.col("lang").isin(names)).withColumn("share", F.lit(1.0)))
    return sample.select("lang", "text")


def prototypes(docs: DataFrame, max_train: int = MAX_TRAIN) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes, learned from about ``max_train`` texts each outside fold 0.

    The sums are made in the tasks; the driver gets one vector per language.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != 0)).select("doc_id", "lang", "text")
    sample = training_rows(known, max_train)
    sums = sample.mapInArrow(_bundle, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).orderBy("lang").collect()
    vectors = np.array([[x["value"] for x in r["v"]] for r in rows]).reshape(len(rows), DIMENSIONS)
    return [r["lang"] for r in rows], np.array([_unit(v) for v in vectors]).reshape(len(rows), DIMENSIONS)


def identify(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (0 to 1: half of one plus the cosine) of every row.

    ``und`` with score 0 for a null text, a text without letters, and where no language was
    learned. Ties go to the first language in order. Other columns are not read, and
    repeated rows are all judged.
    """
    langs, vectors = prototypes(docs, max_train)
    middle = vectors.mean(axis=0) if len(langs) > 1 else np.zeros(DIMENSIONS)
    centred = np.array([_unit(v - middle) for v in vectors]).reshape(len(langs), DIMENSIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                names, scores = [], []
                for text in texts:
                    p = profile(text.decode("utf-8", "replace")) if langs else None
                    if p is None:
                        names.append(NONE)
                        scores.append(0.0)
                        continue
                    cosines = centred @ _unit(_unit(p) - middle)
                    best = int(np.argmax(cosines))
                    names.append(langs[best])
                    scores.append(float(min(1.0, max(0.0, (1 + cosines[best]) / 2))))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == 0).alias("held_out"), "text")
    return read.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
