"""Prefix trie, turn repair and token counts against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from strataward.llm import prefix_trie as trie
from strataward.llm import turn_repair as repair
from strataward.llm.token_counts import TokenCounter, count_tokens, tokenizer_path

SCHEMA = "conv_id long, turn long, role string, text string, pos long, name string, depth long, block long, hi string, cell string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, i, "n", 7, 7, "h", "c") for i, r in enumerate(rows)], SCHEMA)


def as_rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# prefix trie

TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), name, (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    out = []
    for p, convs in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(p))))
        parent = min(nodes[p[:-1]]) if p else None
        out.append((min(convs), len(p), parent, len(convs), kids.get(p, 0), sum(q not in kids for q in below), saved, sha(ends)))
    return sorted(out, key=repr)


def some_turns(seed, convs, length, words):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randint(0, length)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None, "système"]), rng.choice(words)))
    return rows


WORDS = ["", None, "a", "é", "a b", "long " * 40]


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_brute_force(spark, seed):
    rows = some_turns(seed, [*range(-7, 30), 10**15], 12, WORDS[: 3 + seed])
    assert as_rows(trie.prefix_trie(frame(spark, rows)), *TRIE) == brute_trie(rows)


def test_trie_of_repeats_nulls_and_hot_conversations(spark):
    rows = [(0, t, "user", "same") for t in range(40)] + [(c, t, "user", "same") for c in range(1, 12) for t in (1, 1, 2, None)]
    rows += [(None, 1, "user", "x"), (3, None, None, None), (3, None, None, None), (20, 1, "user", "Ω" * 100_000)]
    assert as_rows(trie.prefix_trie(frame(spark, rows)), *TRIE) == brute_trie(rows)


def test_trie_in_short_ranges(spark, monkeypatch):
    monkeypatch.setattr(trie, "CELL_TURNS", 2)
    rows = some_turns(9, range(12), 25, ["a", "b"])
    assert as_rows(trie.prefix_trie(frame(spark, rows)), *TRIE) == brute_trie(rows)


def test_trie_starts_again_when_fingerprints_clash(spark, monkeypatch):
    rows = some_turns(4, range(15), 6, ["a", "b", "c"])
    plain = trie.Monoid.turn
    tried = []

    def weak(self, name, i):
        tried.append(self.seed)
        from pyspark.sql import functions as F

        return F.lit(1).cast("long") if self.seed == 0 else plain(self, name, i)

    monkeypatch.setattr(trie.Monoid, "turn", weak)
    assert as_rows(trie.prefix_trie(frame(spark, rows)), *TRIE) == brute_trie(rows)
    assert max(tried) == 1


def test_empty_trie(spark):
    assert trie.prefix_trie(frame(spark, [])).collect() == []


# turn repair

REPAIR = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SOLID = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        convs[c]
        r, t = " " if role is None else role, " " if text is None else text
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        x = zlib.crc32(key.encode()) % 20
        tie = (r, sha(t))
        new = "" if x == 1 else "".join(ch for ch in t if ch not in ".!?") if x == 2 else t
        for copy in range(0 if x == 0 else 2 if x == 3 else 1):
            convs[c].append(((turn is not None, turn or 0), tie, copy, turn, "user" if x == 4 else r, new))
    return {c: [x[3:] for x in sorted(v, key=lambda x: x[:3])] for c, v in convs.items()}


def brute_repair(rows):
    """All edits of all rows, without merging: (cost, audit, lines) of the best."""
    out = []
    for c, found in brute_damage(rows).items():
        seen, faults = set(), []
        for _, role, text in found:
            end = text.rstrip(SOLID)
            faults.append(1 if not end else 2 if (role, text) in seen else 3 if end[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in found]
        todo = [(0, "", (), 0, 0)]
        import heapq

        done = {}
        while todo:
            cost, audit, lines, at, state = heapq.heappop(todo)
            if (at, state) in done:
                continue
            done[at, state] = (cost, audit, lines)
            shifts = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
            for i, to in shifts.items():
                if i != "s":
                    role = {"u": "user", "a": "assistant"}[i]
                    heapq.heappush(todo, (cost + 3, audit + "I", (*lines, role + ":"), at, to))
            if at < len(found):
                _, role, text = found[at]
                more = 3 if faults[at] == 3 else 0
                heapq.heappush(todo, (cost + 4, audit + "D", lines, at + 1, state))
                if faults[at] not in (1, 2):
                    for i, to in shifts.items():
                        if i == initials[at]:
                            heapq.heappush(todo, (cost + more, audit + "K", (*lines, f"{role}:{text}"), at + 1, to))
                        if i != "s":
                            name = {"u": "user", "a": "assistant"}[i]
                            heapq.heappush(todo, (cost + 3 + more, audit + "R", (*lines, f"{name}:{text}"), at + 1, to))
        cost, audit, lines = min(done[len(found), s] for s in (0, 3) if (len(found), s) in done)
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((c, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, sha("\n".join(lines))))
    return sorted(out, key=repr)


SAID = ["Good.", "no end", "Why? ", " ", "", None, "One.\nTwo!\n", "x" * 30_000 + "."]


def chat(seed, convs, length):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    rows = []
    for c in convs:
        for t in range(rng.randint(1, length)):
            turn = None if rng.random() < 0.05 else t + rng.choice([0, 0, 0, 3])
            rows.append((c, turn, roles[t % 2] if rng.random() < 0.7 else rng.choice(roles), rng.choice(SAID) if rng.random() < 0.5 else f"word {rng.randint(0, 99)}."))
    return rows


@pytest.mark.parametrize("block, cell", [(512, 4096), (1, 1), (3, 2)])
def test_repair_equals_brute_force_in_blocks_of_any_size(spark, monkeypatch, block, cell):
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    monkeypatch.setattr(repair, "CELL_TURNS", cell)
    rows = chat(block, [*range(40), None, -3], 14)
    assert as_rows(repair.repair_turns(frame(spark, rows)), *REPAIR) == brute_repair(rows)


def test_repair_of_one_long_conversation_and_repeated_rows(spark):
    rows = chat(5, [1], 1) + [(7, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(1500)] + [(8, 2, "user", "Same.")] * 5
    assert as_rows(repair.repair_turns(frame(spark, rows)), *REPAIR) == brute_repair(rows)


def test_conversation_that_loses_all_rows(spark):
    lost = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = as_rows(repair.repair_turns(frame(spark, [(lost, 0, "user", "Gone.")])), *REPAIR)
    assert got == [(lost, 0, 0, 0, 0, 0, 0, "", sha(""))]


def test_empty_repair(spark):
    assert repair.repair_turns(frame(spark, [])).collect() == []


# token counts

TEXTS = [
    "", "a", "Don't stop.", "ΑΣ Σ İ ﬁ", "H̱ ẖ é é", "a\x0bb\x1cc\x85d", "<|endoftext|>x<|startoftext|><|ENDOFTEXT|>",
    "日本語のテキスト 12345 !?!... ,.", "x" * 5000, "abcdefghij" * 3000, "🙂‍🙃 é", "...", "a.b,c.,", "﻿​ ",
]


def test_counts_equal_the_tokenizer(spark, docs):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(2)
    pool = "abcXYZéÉßİΣ'.,<|>0̱́\x0b\x85 日🙂"
    texts = TEXTS + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    rows = [*enumerate(texts), (None, "null id"), (3, "again"), (3, "again"), (9999, None)]
    got = count_tokens(docs(rows), tokenizer_path(), limit=10)
    size = lambda t: len(full.encode(t or "", add_special_tokens=False).ids)
    want = [(i, len((t or "").encode()), size(t), size(t) > 10) for i, t in rows]
    assert as_rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_merging_equals_the_plain_rule():
    """The lowest-ranked adjacent pair is merged, the leftmost first, until none is left."""
    counter = TokenCounter(tokenizer_path())
    rng = random.Random(7)
    for _ in range(300):
        data = bytes(rng.choice(b"abcdeghinorst") for _ in range(rng.randint(1, 30)))
        symbols = [counter.inner[b] for b in data[:-1]] + [counter.last[data[-1]]]
        while True:
            ranks = [(counter.rank[p], i) for i in range(len(symbols) - 1) if (p := symbols[i] * counter.width + symbols[i + 1]) in counter.rank]
            if not ranks:
                break
            r, i = min(ranks)
            symbols[i : i + 2] = [counter.made[r]]
        assert counter.unit(data) == len(symbols)


def test_full_cache_changes_no_count(monkeypatch):
    from strataward.llm import token_counts

    texts = [f"Word{i}. {'é' * (i % 9)} x{i}".encode() for i in range(300)]
    whole = TokenCounter(tokenizer_path()).count(texts)
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 20)
    small = TokenCounter(tokenizer_path())
    assert [n for t in texts for n in small.count([t])] == whole


def test_empty_counts(spark, docs):
    assert count_tokens(docs([]), tokenizer_path()).collect() == []
