"""Conversation structure repair by generalised LR parsing with weighted edits.

The roles of a conversation should read ``(s?(ua)+)?``: an optional system turn, then user and
assistant in turn. Rows are the input of an LR automaton over that grammar, whose stack tops,
once every reduction is made, are four: nothing yet, system, user, assistant (a whole pair).
A row is kept (if its role can be shifted), given the role that can be shifted, or deleted, and
turns without text can be inserted before any row and at the end. Every choice forks the stack;
equal tops are merged and the one with the least (cost, audit) goes on, so the graph-structured
stack never has more than four tops. The audit is the word of the edits' initials (K, R, D, I).

A conversation may be long, so it is parsed in blocks of rows side by side: each block finds the
best way from each top to each top. The chain over blocks then needs only their costs and the
order of their audits: the audits of two tops after the same row end with that row's letter, so
neither is the beginning of the other, and an order once decided stays. Texts are not part of
any of this; they meet their edits when the repaired lines are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataward.llm.common import placed, store, streamed

BLOCK_ROWS = 512
CELL_TURNS = 4096
MOST = 2**63 - 1
LEGAL = ("su", "ua", "au")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
RENAME, DELETE, INSERT, CUT = 3, 4, 3, 3
# Stack tops after all reductions, and what they shift: role initial -> next top.
START, SYSTEM, USER, PAIR = range(4)
SHIFTS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": PAIR}, {"u": USER})
# What a rerole or an insert shifts at each top, and the turns inserted at the end to be accepted (user, assistant).
NEXT = (USER, USER, PAIR, USER)
ROLE_OF = {USER: "user", PAIR: "assistant"}
ENDINGS = ("", "UA", "A", "")

Best = tuple[int, str]


def _merge(tops: dict[int, Best], top: int, cost: int, audit: str) -> None:
    have = tops.get(top)
    if have is None or (cost, audit) < have:
        tops[top] = (cost, audit)


def _with_inserts(tops: dict[int, Best]) -> dict[int, Best]:
    """The tops that inserted turns lead to as well; each insert costs, so three steps reach all."""
    out = dict(tops)
    for _ in range(3):
        for top, (cost, audit) in list(out.items()):
            _merge(out, NEXT[top], cost + INSERT, audit + "I")
    return out


def parse(tops: dict[int, Best], initials: Sequence[str], faults: Sequence[int]) -> dict[int, Best]:
    """Read rows from the given stack tops; returns the tops after the last row, with no insert behind it."""
    for initial, fault in zip(initials, faults):
        read: dict[int, Best] = {}
        extra = CUT if fault == TRUNCATED else 0
        for top, (cost, audit) in _with_inserts(tops).items():
            if fault not in (BLANK, DUPLICATE):
                if initial in SHIFTS[top]:
                    _merge(read, SHIFTS[top][initial], cost + extra, audit + "K")
                _merge(read, NEXT[top], cost + RENAME + extra, audit + "R")
            _merge(read, top, cost + DELETE, audit + "D")
        tops = read
    return tops


# One character for each edit, with what it writes: a kept row, a row with a new role, an inserted turn, a deleted row.
KEPT, DELETED = "k", "d"
RENAMED = {USER: "u", PAIR: "a"}
INSERTED = {USER: "U", PAIR: "A"}
STEP_AUDIT = str.maketrans("kuaUAd", "KRRIID")
WRITTEN_ROLE = {"u": "user", "U": "user", "a": "assistant", "A": "assistant"}


def steps(top: int, initials: Sequence[str], audit: str) -> str:
    """The audit with the role that each reroled or inserted turn gets; it follows from the tops passed."""
    out, row = [], 0
    for letter in audit:
        if letter == "K":
            top = SHIFTS[top][initials[row]]
            out.append(KEPT)
        elif letter == "D":
            out.append(DELETED)
        else:
            top = NEXT[top]
            out.append((RENAMED if letter == "R" else INSERTED)[top])
        row += letter != "I"
    return "".join(out)


@lru_cache(maxsize=8192)
def ways(initials: tuple[str, ...], faults: tuple[int, ...], first: bool) -> tuple[list[int], list[int], list[int], list[int], list[str]]:
    """Best ways through a block: top before, top after, cost, place among the audits of one top before, steps.

    The first block of a conversation starts from the empty stack only.
    """
    out: list[tuple[int, int, int, int, str]] = []
    for top in (START,) if first else range(4):
        ends = parse({top: (0, "")}, initials, faults)
        for place, (after, (cost, audit)) in enumerate(sorted(ends.items(), key=lambda e: e[1][1])):
            out.append((top, after, cost, place, steps(top, initials, audit)))
    return tuple(list(c) for c in zip(*out))


class Chain:
    """Puts the blocks of one conversation together: best ways, and figures that reach over block borders."""

    def __init__(self) -> None:
        self.tops = {START: (0, 0)}
        self.back: list[dict[int, tuple[int, int]]] = []
        self.sums = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        self.turns = 0
        self.low: int | None = None
        self.high: int | None = None
        self.last: str | None = None

    def add(self, before, after, cost, place, blank, duplicate, truncated, illegal, opens, closes, turns, low, high) -> None:
        best: dict[int, tuple[tuple[int, int, int], int, int]] = {}
        for at, (start, end, more, nth) in enumerate(zip(before, after, cost, place)):
            if start in self.tops:
                spent, rank = self.tops[start]
                key = (spent + more, rank, nth)
                if end not in best or key < best[end][0]:
                    best[end] = (key, at, start)
        ranks = {t: i for i, t in enumerate(sorted(best, key=lambda t: best[t][0][1:]))}
        self.tops = {t: (b[0][0], ranks[t]) for t, b in best.items()}
        self.back.append({t: (b[1], b[2]) for t, b in best.items()})
        for i, n in enumerate((blank, duplicate, truncated, illegal)):
            self.sums[i] += n
        if self.last is not None and self.last + opens not in LEGAL:
            self.sums[3] += 1
        self.last = closes
        if low is not None:
            self.turns += turns - (self.high == low)
            self.low = low if self.low is None else self.low
            self.high = high

    def finish(self) -> tuple[list[int], str, list[int]]:
        """The way of each block, the edits after the last row, and gaps, blank, duplicate, truncated, illegal, cost."""
        cost, _, top = min((c + INSERT * len(ENDINGS[t]), rank, t) for t, (c, rank) in self.tops.items())
        ending = ENDINGS[top]
        picks = []
        for block in reversed(self.back):
            at, top = block[top]
            picks.append(at)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return picks[::-1], ending, [min(gaps, MOST), *self.sums, cost]


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with one of five faults in a quarter of the rows, by a checksum of id and turn.

    Of twenty remainders, 0 drops the row, 1 empties its text, 2 takes out its ``. ! ?``, 3 repeats
    it, 4 makes its role user. A null role or text, and a null id or turn in the checksum, is one
    space. ``tie`` orders rows of one turn: role and text before the damage, then the copy.
    """
    space = F.lit(" ")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("fault"), F.sha2(text, 256).alias("tie"),
    ).where("fault != 0")
    new_text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), new_text.alias("text"),
        F.struct("role", "tie").alias("tie"), F.posexplode(copies).alias("copy", "_"),
    ).drop("_")


def placed_rows(rows: DataFrame) -> DataFrame:
    """Rows with their place in the conversation, role initial, and a digest of role and text; stored once."""
    at = placed(rows, ["conv_id"], F.floor(F.col("turn") / CELL_TURNS), ["turn", "tie", "copy"], "pos")
    end = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    own = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    same = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return store(at.select("conv_id", "pos", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), own.alias("own"), same.alias("same")), "turn_rows")


def with_faults(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``block``, ``pos``, ``turn``, ``initial``, ``fault``: the first fault that a row has."""
    first = rows.groupBy("conv_id", "same").agg(F.min("pos").alias("first_pos"))
    first = first.select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first_pos")
    found = rows.drop("text", "role").join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")))
    again = (F.col("own") != BLANK) & (F.col("pos") > F.col("first_pos"))
    block = F.floor(F.col("pos") / BLOCK_ROWS).alias("block")
    return found.select("conv_id", block, "pos", "turn", "initial", F.when(again, DUPLICATE).otherwise(F.col("own")).alias("fault"))


WAYS = "before array<int>, after array<int>, cost array<long>, place array<int>"
FIGURES = "blank long, duplicate long, truncated long, illegal long, opens string, closes string, turns long, low long, high long"
BLOCK = f"conv_id long, block long, {WAYS}, {FIGURES}, way array<string>"
LINK = "conv_id long, block long, pick int, ending string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def blocks(rows: DataFrame) -> DataFrame:
    """One row per block of rows: its best ways and its figures."""

    def read(found: Iterator[tuple]) -> Iterator[tuple]:
        for (conv, block), group in groupby(found, key=itemgetter(0, 1)):
            _, _, _, turns, initials, faults = zip(*group)
            known = [t for t in turns if t is not None]
            *way, codes = ways(initials, faults, block == 0)
            yield (
                conv, block, *way, *[faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)],
                sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), initials[0], initials[-1],
                len(set(known)), known[0] if known else None, known[-1] if known else None, codes,
            )

    dealt = rows.select("conv_id", "block", "pos", "turn", "initial", "fault").repartition("conv_id", "block")
    return streamed(dealt.sortWithinPartitions("conv_id", "block", "pos"), read, BLOCK)


def chained(parts: DataFrame) -> DataFrame:
    """For each block the way it takes; a conversation's last block also has its figures and the edits after the last row."""

    def read(found: Iterator[tuple]) -> Iterator[tuple]:
        for conv, group in groupby(found, key=itemgetter(0)):
            chain = Chain()
            for row in group:
                chain.add(*row[2:])
            picks, ending, figures = chain.finish()
            for block, at in enumerate(picks[:-1]):
                yield (conv, block, at, "", *[None] * 6)
            yield (conv, len(picks) - 1, picks[-1], ending, *figures)

    return streamed(parts.drop("way").repartition("conv_id").sortWithinPartitions("conv_id", "block"), read, LINK)


def edits(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``conv_id``, ``pos``, ``codes``: for each row the turns inserted before it and its own edit (at the end, those after it as well)."""
    picked = links.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "pick", "ending")
    both = parts.select("conv_id", "block", "way").join(picked, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    codes = F.concat(F.element_at("way", F.col("pick") + 1), "ending")
    by_row = F.regexp_extract_all(codes, F.lit("[UA]*[kuad](?:[UA]+$)?"), F.lit(0))
    return both.select("conv_id", "block", F.posexplode(by_row).alias("at", "codes")).select(
        "conv_id", (F.col("block") * BLOCK_ROWS + F.col("at")).alias("pos"), "codes"
    )


def digests(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """``conv_id``, ``audit``, ``repaired_sha256`` of whole conversations.

    Edits and texts of a conversation pass one task in order and none is kept, since a digest
    is made from the first byte to the last. Texts are shuffled once.
    """
    texts = rows.select("conv_id", "pos", F.lit(None).cast("string").alias("codes"), "role", "text")
    none = F.lit(None).cast("string")
    both = changes.select("conv_id", "pos", "codes", none.alias("role"), none.alias("text")).unionByName(texts)

    def read(found: Iterator[tuple]) -> Iterator[tuple]:
        for conv, group in groupby(found, key=itemgetter(0)):
            digest, audit, codes, begun = hashlib.sha256(), [], "", False
            for _, _, own, role, text in group:
                if own is not None:
                    codes = own
                    continue
                audit.append(codes.translate(STEP_AUDIT))
                for code in codes.replace(DELETED, ""):
                    said = "" if code in "UA" else text
                    digest.update(f"{chr(10) if begun else ''}{role if code == KEPT else WRITTEN_ROLE[code]}:{said}".encode())
                    begun = True
            yield conv, "".join(audit), digest.hexdigest()

    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "pos", F.col("codes").isNull())
    return streamed(dealt, read, "conv_id long, audit string, repaired_sha256 string")


def repair_turns(turns: DataFrame) -> DataFrame:
    """Damage and repair every conversation; one row per ``conv_id`` of ``turns``.

    Columns ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and
    ``repaired_sha256``. Rows go by turn, null turns first; rows of one turn by role, then by a
    digest of the text. A null role or text is one space, and all rows with a null ``conv_id`` are
    one conversation. A conversation without rows after the damage has zeros, an empty audit and
    the digest of nothing; an empty table gives no rows. Repeated rows are duplicates like any
    other. Other columns are not read. ``gaps`` beyond a long is the largest long.

    A conversation of any length is placed and parsed in blocks; only its digest, one number
    over all its bytes, is made in one task, as a stream. The audit is one string, so a
    conversation has fewer than 2^31 edits.
    """
    rows = placed_rows(damaged(turns))
    parts = store(blocks(with_faults(rows)), "turn_blocks")
    links = store(chained(parts), "turn_links")
    whole = digests(rows, edits(parts, links)).withColumnRenamed("conv_id", "d")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    totals = links.where("cost IS NOT NULL").select(F.col("conv_id").alias("c"), *names)
    ids = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = ids.join(totals, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(whole, F.col("conv_id").eqNullSafe(F.col("d")), "left")
    return found.select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
