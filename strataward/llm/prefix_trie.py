"""Prefix trie of rebuilt conversations by composable fingerprints.

A run of turns has a fingerprint that composes: (length m, value v) and (n, w) make
(m + n, v + B^m w) modulo a prime, for three primes at once. It is a monoid, so a long
conversation is fingerprinted in ranges of turns that are put together afterwards, and a
rebuilt conversation - the head of its base, then its own turns from there on - needs no
text: the fingerprints of its beginnings follow from those of the two originals,

    F(head of k turns) + B^(k - h) (F_own(i) - F_own(h)).

Turns are stored once, with the digest of role and text as their name. Every beginning of a
rebuilt conversation is a member row that refers to its last turn by this name; members with
one length and fingerprint are a node. That is then verified: all members of a node must have
the same last turn and the same parent, which by induction over the length makes them equal.
If a node fails, everything is done again with other bases.

Sums over subtrees need no walk: a node is owned by its smallest member, the nodes that a
conversation owns are the last ones on its path, and every node of a subtree is owned by
exactly one conversation through the subtree's top. So a subtree's sum is the sum of its
members' owned totals, less what the top's owner owns above it.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataward.llm.common import store, streamed

FAMILY = 5
HEADS = 9  # heads of 0 to 8 turns
CELL_TURNS = 4096
PRIMES = (2**31 - 1, 2**31 - 19, 2**31 - 61)  # three largest primes below 2^31
DIGITS = 8  # hexadecimal digits of an exponent
NODE = ["depth", "hi", "lo"]
PARENT = ["phi", "plo"]


class Monoid:
    """Fingerprints of runs of turns, as three columns of residues."""

    def __init__(self, seed: int) -> None:
        self.bases = [random.Random(f"{seed} {p}").randrange(2**20, p - 2**20) for p in PRIMES]
        self.seed = seed

    def turn(self, name: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(name, F.lit(3 * self.seed + i)), F.lit(PRIMES[i]))

    def power(self, exponent: Column, i: int) -> Column:
        """B^exponent, digit by digit, for exponents below 2^32."""
        p, out = PRIMES[i], None
        for digit in range(DIGITS):
            step = pow(self.bases[i], 16**digit, p)
            table = F.array(*[F.lit(pow(step, d, p)).cast("long") for d in range(16)])
            part = F.element_at(table, (F.shiftright(exponent, 4 * digit).bitwiseAND(F.lit(15)) + 1).cast("int"))
            out = part if out is None else out * part % p
        return out

    def back(self, places: Column, i: int) -> Column:
        """B^-places for 0 to 8 places."""
        p = PRIMES[i]
        inverse = pow(self.bases[i], -1, p)
        return F.element_at(F.array(*[F.lit(pow(inverse, d, p)).cast("long") for d in range(HEADS)]), (places + 1).cast("int"))

    def parts(self, make) -> list[Column]:
        return [make(i) for i in range(len(PRIMES))]


def packed(values: list[Column]) -> tuple[Column, Column]:
    """Three residues in two longs."""
    return values[0] * 2**31 + values[1], values[2]


def stored_turns(turns: DataFrame, monoid: Monoid) -> DataFrame:
    """``conv_id``, ``pos``, ``name``, ``bytes`` and fingerprints before (``e0`` ...) and after (``f0`` ...) every turn.

    Ranges of turn numbers are fingerprinted by themselves; a range's place in its
    conversation then shifts its values.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.floor(F.col("turn") / CELL_TURNS).alias("cell"), name.alias("name"), F.octet_length(text).cast("long").alias("bytes"),
    )
    order = W.partitionBy("conv_id", "cell").orderBy("turn", "name")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    at = rows.withColumn("at", (F.row_number().over(order) - 1).cast("long"))
    terms = at.select("*", *[(monoid.turn(F.col("name"), i) * monoid.power(F.col("at"), i) % p).alias(f"t{i}") for i, p in enumerate(PRIMES)])
    local = terms.select("conv_id", "cell", "at", "name", "bytes", *[f"t{i}" for i in range(3)], *[(F.coalesce(F.sum(f"t{i}").over(before), F.lit(0)) % p).alias(f"s{i}") for i, p in enumerate(PRIMES)])
    local = store(local, "turn_ranges")
    cells = local.groupBy("conv_id", "cell").agg(F.count(F.lit(1)).alias("n"), *[(F.sum(f"t{i}") % p).alias(f"v{i}") for i, p in enumerate(PRIMES)])
    earlier = W.partitionBy("conv_id").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    starts = starts.select(
        F.col("conv_id").alias("c"), F.col("cell").alias("k"), "start",
        *[(F.coalesce(F.sum(F.col(f"v{i}") * monoid.power(F.col("start"), i) % p).over(earlier), F.lit(0)) % p).alias(f"b{i}") for i, p in enumerate(PRIMES)],
    )
    both = local.join(starts, (F.col("conv_id") == F.col("c")) & F.col("cell").eqNullSafe(F.col("k")))
    shift = monoid.parts(lambda i: monoid.power(F.col("start"), i))
    ahead = [(F.col(f"b{i}") + shift[i] * F.col(f"s{i}")) % p for i, p in enumerate(PRIMES)]
    after = [(F.col(f"b{i}") + shift[i] * ((F.col(f"s{i}") + F.col(f"t{i}")) % p)) % p for i, p in enumerate(PRIMES)]
    found = both.select(
        "conv_id", (F.col("start") + F.col("at")).alias("pos"), "name", "bytes",
        *[c.alias(f"e{i}") for i, c in enumerate(ahead)], *[c.alias(f"f{i}") for i, c in enumerate(after)],
    )
    return store(found, "stored_turns")


def rebuild_plan(turns: DataFrame) -> DataFrame:
    """For each conversation: its own turns ``n``, ``h``, the base's turns taken ``k``, and the base's head.

    ``head`` has the first ``k`` turns of the base; ``own`` the fingerprint of the own first ``h`` turns.
    """
    early = F.when(F.col("pos") < HEADS - 1, F.struct("pos", "name", "bytes", *[f"e{i}" for i in range(3)], *[f"f{i}" for i in range(3)]))
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(early)).alias("early"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("early").alias("base_early"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    both = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(bases, "base", "left")
    k = F.least("h", F.coalesce("base_n", F.lit(0)).cast("int"))
    zero = [F.lit(0).cast("long")] * 3

    def at(heads: str, length: str) -> Column:
        """The fingerprint of the first ``length`` turns."""
        last = F.get(heads, F.col(length) - 1)
        return F.struct(*[F.when(F.col(length) == 0, zero[i]).otherwise(last[f"f{i}"]).alias(f"f{i}") for i in range(3)])

    planned = both.withColumn("k", k)
    return planned.select(
        "conv_id", "n", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        F.slice(F.coalesce("base_early", F.array()), F.lit(1), F.col("k")).alias("head"), at("base_early", "k").alias("joint"), at("early", "h").alias("own"),
    )


def members(turns: DataFrame, plan: DataFrame, monoid: Monoid) -> DataFrame:
    """One row per rebuilt conversation and length of its beginnings, the empty one included.

    ``conv_id``, ``depth``, the node's fingerprint, the parent's, ``name`` and ``bytes`` of the last
    turn, and ``ends``: the whole conversation.
    """
    number, nothing = F.lit(0).cast("long"), F.lit(None)
    ends = (F.col("depth") == F.col("length")).alias("ends")
    root = plan.select(
        "conv_id", number.alias("depth"), number.alias("hi"), number.alias("lo"), nothing.cast("long").alias("phi"), nothing.cast("long").alias("plo"),
        nothing.cast("binary").alias("name"), number.alias("bytes"), (F.col("length") == 0).alias("ends"),
    )

    def rows(df: DataFrame, depth: Column, after: list[Column], before: list[Column]) -> DataFrame:
        (hi, lo), (phi, plo) = packed(after), packed(before)
        made = df.withColumn("depth", depth.cast("long"))
        return made.select("conv_id", "depth", hi.alias("hi"), lo.alias("lo"), phi.alias("phi"), plo.alias("plo"), "name", "bytes", ends)

    opened = plan.select("conv_id", "length", F.inline("head"))
    heads = rows(opened, F.col("pos") + 1, [F.col(f"f{i}") for i in range(3)], [F.col(f"e{i}") for i in range(3)])
    frame = plan.where("n > h").select(F.col("conv_id").alias("c"), "h", "k", "length", "joint", "own")
    tail = turns.join(frame, F.col("conv_id") == F.col("c")).where(F.col("pos") >= F.col("h"))

    def moved(side: str) -> list[Column]:
        return [
            (F.col("joint")[f"f{i}"] + F.pmod(F.col(f"{side}{i}") - F.col("own")[f"f{i}"], F.lit(p)) * monoid.back(F.col("h") - F.col("k"), i)) % p
            for i, p in enumerate(PRIMES)
        ]

    tails = rows(tail, F.col("pos") - F.col("h") + F.col("k") + 1, moved("f"), moved("e"))
    return store(root.unionByName(heads).unionByName(tails), "trie_members")


def nodes(found: DataFrame) -> tuple[DataFrame, bool]:
    """The nodes, and whether every one has members with one parent and one last turn only."""
    grouped = found.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        *[f(c).alias(f"{c}_{s}") for c in ("phi", "plo", "name") for f, s in ((F.min, "a"), (F.max, "z"))],
    )
    one = F.lit(True)
    for c in ("phi", "plo", "name"):
        one &= F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_z"))
    made = grouped.select(*NODE, F.col("phi_a").alias("phi"), F.col("plo_a").alias("plo"), "conv_id", "n_convs", "bytes", one.alias("one"))
    kept = store(made, "trie_nodes")
    return kept.drop("one"), kept.where("NOT one").isEmpty()


def ends_digest(found: DataFrame) -> DataFrame:
    """``ends_sha256`` of each node where conversations end: their ids in order, comma-joined.

    Ids are joined in ranges of 1024 numbers first; the ranges of a node then stream through its digest.
    """
    own = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    ranges = found.where("ends").groupBy(*NODE, F.shiftright("conv_id", 10).alias("cell")).agg(own)

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for node, group in groupby(rows, key=itemgetter(0, 1, 2)):
            digest = hashlib.sha256()
            for i, row in enumerate(group):
                digest.update(("," if i else "").encode() + row[4].encode())
            yield *node, digest.hexdigest()

    dealt = ranges.select(*NODE, "cell", "ids").repartition(*NODE).sortWithinPartitions(*NODE, "cell")
    return streamed(dealt, read, "depth long, hi long, lo long, ends_sha256 string")


def owned_before(tree: DataFrame) -> DataFrame:
    """For each node the weight that its owner owns above it: a running sum in ranges of depth."""
    rows = tree.select(*NODE, "conv_id", "weight", F.floor(F.col("depth") / CELL_TURNS).alias("cell"))
    sums = rows.groupBy("conv_id", "cell").agg(F.sum("weight").alias("w"))
    earlier = W.partitionBy("conv_id").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("conv_id", "cell", F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("start"))
    inside = W.partitionBy("conv_id", "cell").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    run = rows.withColumn("here", F.coalesce(F.sum("weight").over(inside), F.lit(0)))
    return run.join(starts, ["conv_id", "cell"]).select(*NODE, (F.col("start") + F.col("here")).alias("above"))


def prefix_trie(turns: DataFrame, seed: int = 0) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    Columns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. Turns go by turn number, null first; turns
    of one number by the digest of role and text, and repeated rows are turns of their own.
    Null roles and texts are empty. Rows with a null ``conv_id`` have no base and no head
    length, and are left out. An empty table gives no rows, not even the root. Other columns
    are not read. Texts are read once and never shuffled, so very long ones weigh no more than
    their digest; a conversation may have 2^32 turns.
    """
    for attempt in range(8):
        monoid = Monoid(seed + attempt)
        stored = stored_turns(turns, monoid)
        found = members(stored, store(rebuild_plan(stored), "rebuild_plan"), monoid)
        plain, equal = nodes(found)
        if equal:
            break
    else:
        raise RuntimeError("fingerprints of different conversations agree under every base")
    kids = plain.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("phi").alias("hi"), F.col("plo").alias("lo"))
    kids = kids.agg(F.count(F.lit(1)).alias("n_children"))
    weight = ((F.col("n_convs") - 1) * F.col("bytes")).alias("weight")
    children = F.coalesce("n_children", F.lit(0)).alias("n_children")
    tree = store(plain.join(kids, NODE, "left").select(*NODE, *PARENT, "conv_id", "n_convs", children, weight), "trie_tree")
    above = plain.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("conv_id").alias("parent_conv_id"))
    named = tree.join(above, ["depth", *PARENT], "left")
    owned = tree.groupBy("conv_id").agg(F.sum("weight").alias("owned"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    through = found.select("conv_id", *NODE).join(owned, "conv_id").groupBy(*NODE).agg(F.sum("owned").alias("all_owned"), F.sum("leaf").alias("n_leaves"))
    whole = named.join(through, NODE).join(owned_before(tree), NODE).join(ends_digest(found), NODE, "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("all_owned") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
