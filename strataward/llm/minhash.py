"""Near-duplicate groups by MinHash with banding, signature verification, and star components.

Documents are sets of distinct 5-word shingles. Documents with one and the same set are one
member. Universal hash minima are cut into bands; members that agree in a band share a
bucket. Inside buckets, pairs are not written out: in each round a few members of a bucket
(its centres) are held against those that are not yet known to be connected with them, first
by signature, then by the full sets, and then leave the bucket. A bucket ends when all its
members are in one component. A member leaves a bucket early if a bound shows that it can
have no partner there: shingles that no other candidate has cannot be shared. The same bound
is held against each pair, and a pair is looked at in its first common band only. From the
second round on, the triangle inequality of the Jaccard distance excludes pairs whose distances
to their bucket's first centre differ by more than a link's distance.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataward.llm.common import ROW, id_and_text, id_order, keep, keyed, store
from strataward.llm.components import components
from strataward.llm.words import lists, mix, run_hashes, slices, word_hashes

SHINGLE = 5
BANDS, BAND_ROWS = 20, 5
LINK_PERCENT = 85  # of op2_minhash_dedup
STAGE_PERCENT = 80  # of a stage without a threshold of its own
CENTRE_GROWTH = 32
_RNG = np.random.Generator(np.random.PCG64(97))
_A = _RNG.integers(1, 2**32, BANDS * BAND_ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, BANDS * BAND_ROWS, dtype=np.uint64).astype(np.uint32)
CHUNK = 1 << 15


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than k make one shingle, none make none."""
    out = []
    for begin, end in zip(offsets[:-1], offsets[1:]):
        w = words[begin:end]
        runs = run_hashes(w, k) if len(w) >= k else (mix(run_hashes(w, len(w)) + np.uint64(len(w))) if len(w) else w)
        out.append(np.unique(runs))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima per set; empty sets get the largest value everywhere."""
    sizes = np.array([len(s) for s in sets])
    out = np.full((len(sets), len(_A)), np.iinfo(np.uint32).max, np.uint32)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    x = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(sizes[full])
    starts = ends - sizes[full]
    for begin in range(0, len(x), CHUNK):  # a piece that stays in the cache for all functions
        end = min(begin + CHUNK, len(x))
        first, last = np.searchsorted(ends, begin, side="right"), np.searchsorted(starts, end, side="left")
        cuts = np.maximum(starts[first:last], begin) - begin
        part, rows = x[begin:end], full[first:last]
        for i in range(len(_A)):
            out[rows, i] = np.minimum(out[rows, i], np.minimum.reduceat(part * _A[i] + _B[i], cuts))
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band."""
    keys = np.zeros((len(sig), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(sig), band + 1, np.uint64)
        for i in range(BAND_ROWS):
            h = mix(h + sig[:, band * BAND_ROWS + i].astype(np.uint64))
        keys[:, band] = h
    return keys


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch):
            sets = shingle_hashes(*word_hashes([t.lower() for t in texts]))
            sig = signatures(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    part[ROW], pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], pa.string()),
                    lists(list(band_keys(sig)), pa.int64()),
                ],
                names=[ROW, "n", "same", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch):
            sets = shingle_hashes(*word_hashes([t.lower() for t in texts]))
            sig = signatures(sets)
            marks = (band_keys(sig) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part[ROW], lists(sets, pa.int64()), lists(list(sig.astype(np.uint8).view(np.int8)), pa.int8()), lists(list(marks), pa.int32())],
                names=["row", "shingles", "sig", "marks"],
            )


def _linked(both: Column, na: Column, nb: Column, percent: int) -> Column:
    return 100 * both >= percent * (na + nb - both)


def signature_share(percent: int) -> float:
    """Share of equal minima, in hundredths, that a pair at the link threshold is 4.2 standard deviations above."""
    p = percent / 100
    return max(0, math.floor(percent - 420 * math.sqrt(p * (1 - p) / len(_A)))) / 100


def _signatures_agree(percent: int) -> Column:
    """Whether enough minima of a member and a centre are equal, by their last 8 bits."""
    equal = F.aggregate(F.zip_with("sig", "c_sig", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return equal >= signature_share(percent) * len(_A)


def _candidates(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of buckets that are not all in one component and may still find a partner there.

    A member with n shingles, of which c are shared with any other candidate, can only link
    with sets of at most c * (100 + percent) / percent - n shingles.
    """
    if labels is None:
        label = members.withColumn("comp", F.col("row"))
    else:
        label = members.join(labels, members["row"] == labels["node"], "left").select(*members.columns, F.coalesce("component", "row").alias("comp"))
    least = label.groupBy("bucket").agg(F.min("n").alias("least"))
    able = label.join(least, "bucket").where("most >= least").drop("least")
    mixed = able.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket")
    return able.join(mixed, "bucket")


def near_links(rows: DataFrame, percent: int = LINK_PERCENT) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(figures per row, smallest row of each set, component of each linked row or None); sets link from ``percent`` of similarity on."""
    texts = id_and_text(rows).select(ROW, "text")
    seen = store(texts.mapInArrow(_scan, f"{ROW} long, n long, same string, bands array<long>"), "minhash")
    same = store(seen.where("same IS NOT NULL").groupBy("same").agg(F.min(ROW).alias("row")), "members")
    members = seen.where("same IS NOT NULL").join(same.select(F.col("row").alias(ROW)), ROW, "left_semi")
    exploded = members.select(F.col(ROW).alias("row"), F.posexplode("bands").alias("band", "bucket"))
    shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("bucket")
    buckets = store(exploded.join(shared, "bucket"), "buckets")
    # the list of candidates grows with the corpus, so it is never broadcast
    wanted = buckets.select(F.col("row").alias(ROW)).distinct().hint("merge")
    sets = store(
        texts.join(wanted, ROW, "left_semi").mapInArrow(_sets, "row long, shingles array<long>, sig array<tinyint>, marks array<int>"), "sets"
    )
    alone = (
        sets.select("row", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("k"))
        .where("k = 1").groupBy("row").agg(F.count(F.lit(1)).alias("alone"))
    )
    n = F.size("shingles").cast("long")
    bound = sets.select("row", n.alias("n"), "marks", "sig").join(alone, "row", "left").select(
        "row", "n", "marks", "sig", F.floor((F.col("n") - F.coalesce("alone", F.lit(0))) * (100 + percent) / percent - F.col("n")).alias("most")
    )
    members = buckets.join(store(bound, "bounds"), "row").withColumn("away", F.lit(None).cast("double"))
    open_ = store(_candidates(members, None).drop("comp"), "open")
    facts = store(sets.drop("marks", "sig").join(open_.select("row").distinct(), "row", "left_semi"), "facts")
    labels, centres = None, 1
    while not open_.isEmpty():
        live = store(_candidates(open_, labels), "live")
        middle = live.withColumn("at", F.row_number().over(W.partitionBy("bucket").orderBy("row"))).where(f"at <= {centres}").drop("at")
        # centres are the smallest rows of a bucket, so c_row < row meets every pair once
        c = middle.select("bucket", *[F.col(x).alias(f"c_{x}") for x in ("row", "n", "most", "comp", "marks", "sig", "away")])
        first_band = F.array_position(F.zip_with("marks", "c_marks", lambda x, y: x == y), True) == F.col("band") + 1
        apart = F.coalesce(F.abs(F.col("away") - F.col("c_away")) > 1 - percent / 100 + 1e-9, F.lit(False))
        pairs = live.join(c, "bucket").where(F.expr("c_row < row AND comp <> c_comp AND n <= c_most AND c_n <= most") & ~apart & first_band & _signatures_agree(percent))
        pairs = pairs.select(F.least("row", "c_row").alias("a"), F.greatest("row", "c_row").alias("b")).distinct()
        seen_pairs = store(_verify(store(pairs, "pairs"), facts, percent), "links")
        found = seen_pairs.where("linked").select("a", "b")
        if not found.isEmpty():
            known = found if labels is None else found.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
            labels = store(components(known), "labels")
        rest = live.drop("comp").join(middle.select("bucket", "row"), ["bucket", "row"], "left_anti")
        if centres == 1:
            far = seen_pairs.select("a", "b", "distance")
            rest = rest.join(middle.select("bucket", F.col("row").alias("centre")), "bucket").withColumns({"a": F.least("row", "centre"), "b": F.greatest("row", "centre")})
            rest = rest.join(far, ["a", "b"], "left").select(*[c for c in open_.columns if c != "away"], F.col("distance").alias("away"))
        open_ = store(rest, "open")
        centres *= CENTRE_GROWTH
    return seen, same, labels


def _verify(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs with the exact distance of their full sets and whether they are linked."""

    sets = pairs
    for end in "ab":
        sets = sets.join(facts.select(F.col("row").alias(end), F.col("shingles").alias(f"shingles_{end}")), end)
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    exact = sets.select("a", "b", both.alias("both"), F.size("shingles_a").alias("na"), F.size("shingles_b").alias("nb"))
    distance = 1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))
    return exact.select("a", "b", distance.alias("distance"), _linked(F.col("both"), F.col("na"), F.col("nb"), percent).alias("linked"))


def near_groups(rows: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """``_row``, ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every keyed row.

    A null or blank text has an empty set and is linked with nothing. ``component_id`` is the
    smallest ``doc_id`` of the component; null ids come last. Of repeated rows one stays.
    """
    seen, same, labels = near_links(rows, percent)
    classes = same.withColumnRenamed("row", "comp") if labels is None else (
        same.join(labels, same["row"] == labels["node"], "left").select("same", F.coalesce("component", "row").alias("comp"))
    )
    ids = id_and_text(rows).select(ROW, "doc_id")
    all_rows = store(
        seen.select(ROW, "n", "same").join(classes, "same", "left").select(ROW, "n", F.coalesce("comp", ROW).alias("comp")).join(ids, ROW), "near"
    )
    first = all_rows.groupBy("comp").agg(F.min(id_order()).alias("first"))
    return all_rows.join(first, "comp").select(
        ROW, "doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"), (F.col("first.row") == F.col(ROW)).alias("kept")
    )


def minhash_dedup(docs: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``; an empty table gives none."""
    return near_groups(keyed(docs), percent).drop(ROW)


def drop_near_copies(docs: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """One document of each group of near copies, with the columns of ``docs``."""
    rows = keyed(docs)
    return keep(rows, near_groups(rows, percent).where("kept"))
