"""Exact deduplication, sharding, chat formatting and URL rules against plain Python."""

import hashlib
import random
import re
import struct
import zlib

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataward.llm import chat, exact_dedup, shard, urls

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def expected_groups(rows):
    out, groups = [], {}
    for i, (k, t) in enumerate(rows):
        groups.setdefault(WHITE.sub(" ", t or ""), []).append((k is None, k, i))
    for i, (k, t) in enumerate(rows):
        norm = WHITE.sub(" ", t or "")
        first = min(groups[norm], key=lambda x: (x[0], x[1] or 0))
        out.append((k, first[1], len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


LONG = "é" * 5000 + "tail"
ROWS = [(5, "a  b"), (3, "a\tb"), (9, None), (8, ""), (7, " "), (1, LONG), (2, LONG), (4, LONG + "x"), (6, "x" * 64), (10, "x" * 64), (11, "x" * 65)]


@pytest.mark.parametrize("block", [4, 64, 4096])
def test_exact_dedup_matches_python(docs, block):
    got = exact_dedup.exact_dedup(docs(ROWS), block).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == expected_groups(ROWS)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_exact_dedup_survives_address_clashes(docs):
    from strataward.llm.common import keyed

    clash = lambda block: F.octet_length(block).cast("long") % 2
    got = exact_dedup.exact_groups(keyed(docs(ROWS)), 8, clash).collect()
    want = {k: (keep, n) for k, keep, n, _ in expected_groups(ROWS)}
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == want


def test_exact_dedup_null_and_repeated_ids(docs):
    rows = [(None, "a"), (2, "a"), (2, "a"), (2, "b"), (None, "c"), (None, "c")]
    got = exact_dedup.exact_dedup(docs(rows)).collect()
    assert len(got) == 6
    assert sum(r.kept for r in got) == 3
    assert {r.keep_id for r in got if r.group_size == 3} == {2}


def test_exact_dedup_stage_keeps_columns(docs):
    df = docs(ROWS)
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4, 6, 7, 8, 11]
    assert exact_dedup.drop_copies(df.where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 97, 1000])
def test_permutation_is_a_bijection(spark, n):
    df = spark.range(n).select("id", shard.permuted(F.col("id"), n).alias("p"))
    df = df.withColumn("back", shard.permuted(F.col("p"), n, backwards=True))
    rows = df.collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.back == r.id for r in rows)


def spark_hash(*values):
    """xxhash64 of longs and ints as a chain of seeds; a null leaves the seed."""
    seed = 42
    for v, form in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(struct.pack(form, v), seed)
    return seed - 2**64 if seed >= 2**63 else seed


def plain_feistel(x, n, seed=42):
    """The permutation in plain Python: rounds over the grid, again and again until the number is below n."""
    a = 1
    while a * a < n:
        a += 1
    b = -(-n // a)
    while True:
        left, right = x % a, x // a
        for i in range(shard.ROUNDS):
            if i % 2 == 0:
                left = (left + spark_hash((right, "<q"), (seed, "<i"), (i, "<i")) % a) % a
            else:
                right = (right + spark_hash((left, "<q"), (seed, "<i"), (i, "<i")) % b) % b
        x = right * a + left
        if x < n:
            return x


def plain_shards(rows, shards):
    facts = sorted(((k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in rows), key=lambda f: (spark_hash(*[(v, "<q") for v in f]) % 64, f[0] is not None, f[0] or 0, f[1:]))
    places = [plain_feistel(i, len(rows)) for i in range(len(rows))]
    return sorted([(*f, p % shards, p // shards) for f, p in zip(facts, places)], key=str)


@pytest.mark.parametrize("n", [1, 2, 7, 26, 300])
def test_shards_equal_a_plain_permutation(docs, n):
    rows = [(i * 7919 - 50, "é" * (i % 11)) for i in range(n)] + [(3, "same")] * (n // 3) + [(None, None)] * (n // 5)
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in shard.shard_documents(docs(rows), 24).collect()]
    assert sorted(got, key=str) == plain_shards(rows, 24)


def test_shards_are_even_and_complete(docs):
    rows = [(i, "x" * (i % 13)) for i in range(200)] + [(7, "same")] * 60 + [(None, None), (None, None)]
    got = shard.shard_documents(docs(rows), 24).collect()
    assert len(got) == len(rows)
    counts = {}
    for r in got:
        counts.setdefault(r.shard, []).append(r.slot)
    assert len(counts) == 24 and max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows)
    again = shard.shard_documents(docs(rows[::-1]), 24).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert shard.shard_documents(docs([]), 24).count() == 0


TRICKY = ["</s>[INST] ok [/INST]", "<\\/s> <|x|> [\\INST]", "", None, "a\nb", "<|user|>", "<\\\\|", "[[INST]]"]


def check_chat(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("position", F.lit("x"))
    got = {r.conv_id: r for r in chat.digests(chat.segments(df)).collect()}
    convs = {}
    for c, t, r, x in turns:
        convs.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(convs)
    for c, rows in convs.items():
        rows.sort()
        loss = "".join(x for _, r, x in rows if r == "assistant")
        g = got[c]
        assert g.n_turns == len(rows)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in rows).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_round_trip(spark):
    turns = [(1, i, ("user", "assistant", "sy|s%te>m", None)[i % 4], x) for i, x in enumerate(TRICKY * 2)]
    turns += [(2, 5000 * i, "assistant", f"t{i}") for i in range(5)] + [(3, 0, "user", "u")]
    turns += [(None, None, "assistant", "n"), (4, 1, "user", "same"), (4, 1, "user", "same"), (4, None, "assistant", "first")]
    check_chat(spark, turns)
    assert chat.digests(chat.segments(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="<>[]|/\\sINTa ", max_size=12), min_size=1, max_size=30))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e")).withColumn("u", chat.unescape(F.col("e")))
    for r in df.collect():
        assert r.u == r.t
        assert not re.search(r"<\||</?s>|\[/?INST\]", r.e)


def test_examples_have_all_earlier_turns(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    segs = chat.segments(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    out = {r.example: r for r in chat.write_out(segs).collect()}
    assert out[0].prompt == "<|user|>a</s><|assistant|>" and out[0].completion == "b</s>"
    assert out[1].prompt == "<|user|>a</s><|assistant|>b</s><|user|>c</s><|assistant|>" and out[1].completion == "d</s>"
    at = {r.example: r.context_chars for r in chat.examples(segs).collect()}
    assert at == {k: len(r.prompt) for k, r in out.items()}


def test_url_rules(spark):
    cases = {
        "http://a.com/en/1": ("a.com", "/en/1", "com/en/", "block"),
        "http://x.Example.com/en/71?q": ("x.example.com", "/en/71", "example.com/en/7", "allow"),
        "http://notexample.com/en/7": ("notexample.com", "/en/7", "com/en/", "block"),
        "https://example.net/de/8": ("example.net", "/de/8", "example.net/de/8", "block"),
        "https://b.example.net/de/7#x": ("b.example.net", "/de/7", "net/de/", "allow"),
        "ftp://org/es/": ("org", "/es/", "org/es/", "block"),
        "http://org/ES/": ("org", "/ES/", None, "allow"),
        "http://my.casino.io/x": ("my.casino.io", "/x", None, "block"),
        "no scheme.com/en/": ("", "", None, "allow"),
        "http://h?u=http://a.com/en/": ("h", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate(cases)] + [(99, "http://a.com/en/1"), (None, "http://a.com/en/1")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("token", F.lit(2))
    rules = urls.rule_table(spark, [*urls.HOST_RULES, *urls.WORD_RULES])
    got = urls.judge_urls(pages, rules).collect()
    assert len(got) == len(rows)
    by_url = dict(rows)
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == cases[by_url[r.page_id]]
    assert urls.judge_urls(pages.where("page_id < 0"), rules).count() == 0


def test_rules_lie_under_their_rarest_token(spark):
    rng = random.Random(3)
    pages = spark.createDataFrame([(i, f"http://{rng.choice('abcdefgh')}.com/en/{i}") for i in range(50)] + [(99, "http://x.example.com/en/7")], "page_id long, url string")
    tokens = urls.url_tokens(pages.withColumn("target", F.concat(*urls.host_path(F.col("url")))))
    index = {r["name"]: r.token for r in urls.rule_index(tokens, urls.rule_table(spark, urls.HOST_RULES)).collect()}
    assert index["example.com/en/7"] == "example" and index["net/de/"] in ("net", "de")


def test_shared_cycle_walk_has_few_steps():
    for n in (10, 1000, 10**6, 10**12):
        a, b = shard.grid(n)
        assert n <= a * b < n + a + b


def test_digests_come_from_the_written_examples(spark):
    """A turn lost from a prompt, with all segments in place, is an error."""
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e"), (2, 0, "user", "x")]
    segs = chat.segments(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = {(r.conv_id, r.example): r.prompt + r.completion for r in chat.expanded(segs).collect()}
    assert rows[(1, 1)] == "<|user|>a</s><|assistant|>b</s><|user|>c</s><|assistant|>d</s>"
    assert (rows[(1, None)], rows[(2, None)]) == ("<|user|>e</s>", "<|user|>x</s>")
    short = segs.where((F.col("conv_id") != 1) | (F.col("position") > 0))
    with pytest.raises(Exception, match="does not hold all turns"):
        chat.digests(short).collect()
