"""Near copies, repeated passages, packing, languages, toxicity, leaks and the pipeline against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from strataward.llm import contamination, language, minhash, packing, repeats, toxicity
from strataward.llm.components import components


def words(rng, n, stem="w"):
    return [f"{stem}{rng.randrange(400)}" for _ in range(n)]


def edited(rng, said, share):
    return [w if rng.random() >= share else f"e{rng.randrange(10**6)}" for w in said]


# --- near copies


def brute_near(rows):
    sets = []
    for _, t in rows:
        said = (t or "").encode().lower().split()
        sets.append({tuple(said[i : i + 5]) for i in range(len(said) - 4)} if len(said) >= 5 else ({tuple(said)} if said else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), (True, 0)), (k is None, k or 0))
    return Counter((k, len(sets[i]), None if least[find(i)][0] else least[find(i)][1]) for i, (k, _) in enumerate(rows))


def near_rows():
    rng = random.Random(4)
    rows = [(100, None), (101, ""), (102, " \n"), (103, "One two"), (104, "one  TWO"), (105, "one two three"), (7, "É a b c d e"), (8, "é a b c d e")]
    for g in range(8):
        base = words(rng, rng.choice([8, 60, 200, 600]), f"g{g}_")
        for i in range(12):
            rows.append((1000 * g + 200 + i, " ".join(edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.05])))))
    return rows


def test_minhash_groups_match_brute_force(docs):
    rows = near_rows()
    got = minhash.minhash_dedup(docs(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_null_and_repeated_ids(docs):
    text = " ".join(words(random.Random(1), 40))
    got = minhash.minhash_dedup(docs([(None, text), (5, text), (5, text + " tail"), (None, "other words here at last"), (9, None)])).collect()
    assert len(got) == 5 and sum(r.kept for r in got) == 3
    assert Counter(r.component_id for r in got) == Counter({5: 3, None: 1, 9: 1})


def test_minhash_empty_table_and_stage(docs):
    df = docs(near_rows())
    assert minhash.minhash_dedup(df.where("doc_id < 0")).count() == 0
    out = minhash.drop_near_copies(df)
    assert out.columns == df.columns
    assert out.count() == len({c for _, _, c in brute_near(near_rows())})


def test_stage_links_from_80_percent_on(spark, docs):
    import corpus_pipeline

    rows = []
    for g, changed in enumerate([18, 22]):  # of 182 shingles each: 164 of 200 (0.82) and 160 of 204 (below 0.8) in common
        base = [f"g{g}w{i}" for i in range(186)]
        rows += [(10 * g, " ".join(base)), (10 * g + 1, " ".join(base[:-changed] + [f"g{g}x{i}" for i in range(changed)]))]
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs(rows), "").collect()} == {0, 10, 11}
    assert all(r.kept for r in minhash.minhash_dedup(docs(rows)).collect())
    assert (minhash.signature_share(85), minhash.signature_share(80)) == (0.70, 0.63)


def test_signatures_estimate_jaccard():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    sig = minhash.signatures([a, b, a[:0], b])
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.2
    assert (sig[1] == sig[3]).all() and (sig[2] == 2**32 - 1).all()


def test_components_on_chains_hubs_and_repeats(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(60, 55), (55, 60), (70, 70), (2000, 41), (99, 98)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {n: 0 for n in range(41)} | {n: 1000 for n in range(1000, 1060)} | {55: 55, 60: 55, 98: 98, 99: 98, 2000: 41, 41: 41}
    want = {n: (0 if n <= 40 else c) for n, c in want.items()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated passages


def brute_repeats(rows):
    first, out = {}, []
    order = lambda k: (k is None, k or 0)
    said = [(k, (t or "").encode().split()) for k, t in rows]
    for k, w in said:
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            first[key] = min(first.get(key, order(k)), order(k))
    for k, w in said:
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < order(k):
                gone.update(range(i, i + 50))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def repeat_rows():
    rng = random.Random(9)
    passages = [words(rng, n, f"p{n}_") for n in (49, 50, 51, 80, 200)]
    rows = [(0, None), (1, ""), (2, " ".join(passages[1])), (None, " ".join(passages[3]))]
    for k in range(3, 60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts += words(rng, rng.randrange(30), f"d{k}_")
            p = rng.choice(passages)
            a = rng.randrange(0, 20)
            parts += p[a:] if rng.random() < 0.5 else edited(rng, p, 0.01)
        rows.append((k, " ".join(parts)))
    rows += [(100, rows[10][1]), (101, rows[10][1].replace(" ", "\n ")), (101, rows[20][1]), (102, "a b " * 300), (103, "a b " * 200), (None, rows[30][1])]
    return rows


@pytest.mark.parametrize("shard_anchors", [20_000, 7])
def test_substring_dedup_matches_brute_force(docs, monkeypatch, shard_anchors):
    monkeypatch.setattr(repeats, "SHARD_ANCHORS", shard_anchors)
    monkeypatch.setattr(repeats, "GROUP_BYTES", 2000 if shard_anchors == 7 else 16 << 20)
    rows = repeat_rows()
    got = repeats.substring_dedup(docs(rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_repeats(rows)
    for r in got:
        if r.n_removed:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_substring_dedup_empty_table(docs):
    assert repeats.substring_dedup(docs([])).count() == 0
    assert repeats.substring_dedup(docs(["few words", None])).agg({"n_removed": "sum"}).first()[0] == 0


# --- packing


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    rng = random.Random(2)
    letters = "aAzZéÉßİıΑς 'stll.,!?|<>　́\x1c\x85\n\t\x0b09٣漢🎉-_"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += ["", "a<|endoftext|>b c", "It's we'll. don't,. foo.,bar", "word. word, WORD. word"]
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.WordEncoder(packing.tokenizer_path()).ids([t.encode() for t in texts])
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in want]


def test_word_encoder_leaves_special_strings_of_other_case_as_text():
    from tokenizers import Tokenizer

    texts = ["a <|ENDOFTEXT|> b", "<|StartOfText|>", "x<|endOfText|><|endoftext|>Y", "<|ENDOFTEXT |>", "plain WORDS <|"]
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.WordEncoder(packing.tokenizer_path()).ids([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("kind", ["even", "large", "small", "heavy"])
def test_plan_places_every_piece_once(kind):
    rng = random.Random(kind)
    draw = {"even": lambda: rng.randint(1, 100), "large": lambda: rng.randint(34, 100), "small": lambda: rng.randint(1, 33), "heavy": lambda: min(100, int(rng.paretovariate(1) * 4))}[kind]
    counts = Counter(draw() for _ in range(2000))
    bins, ranges = defaultdict(list), defaultdict(list)
    for length, lo, hi, first, per_bin, offset in packing.plan_bins(counts, 100):
        ranges[length].append((lo, hi))
        for k in range(lo, hi):
            bins[first + (k - lo) // per_bin].append((offset + (k - lo) % per_bin * length, length))
    for length, r in ranges.items():
        r.sort()
        assert r[0][0] == 0 and r[-1][1] == counts[length] and all(a[1] == b[0] for a, b in zip(r, r[1:]))
    assert set(ranges) == set(counts)
    for placed in bins.values():
        placed.sort()
        assert [o for o, _ in placed] == np.cumsum([0] + [n for _, n in placed[:-1]]).tolist() and sum(n for _, n in placed) <= 100
        assert sum(3 * n > 100 for _, n in placed) <= 2
    best = -(-sum(n * c for n, c in counts.items()) // 100)
    pairs = sum(c for n, c in counts.items() if 2 * n > 100)
    assert len(bins) <= max(best, pairs) * 1.06 + 1


def test_pack_documents_round_trip(docs):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " ".join(words(rng, 6000)))] + [(k, " ".join(words(rng, rng.randrange(1, 900)))) for k in range(4, 60)]
    rows += [(4, "again"), (None, "no id")]
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack_documents(docs(rows), with_ids=True).collect()
    for k, t in rows:
        if k in (4, None):
            continue
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted((r for r in got if r.doc_id == k), key=lambda r: r.piece)
        assert sum((list(r.ids) for r in own), []) == ids
        assert [r.start for r in own] == list(range(0, len(ids), 4096)) and all(r.length == len(r.ids) for r in own)
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in own)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        p.sort()
        assert p[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(p, p[1:])) and p[-1][0] + p[-1][1] <= 4096
    assert packing.pack_documents(docs([])).count() == 0


# --- languages


def language_rows():
    rng = random.Random(8)
    stems = {"aa": ["thi", "ing", "wha", "ou"], "bb": ["sch", "ung", "ßei", "er"], "cc": ["ção", "nho", "lha", "os"]}
    make = lambda lang: " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(60))
    langs = {i: ("aa", "bb", "cc", "aa", "bb")[i % 5] for i in range(150)}
    return [(i, make(lang)) for i, lang in langs.items()], langs


def test_languages_on_held_out_rows(docs):
    rows, langs = language_rows()
    extra = [(1000, None), (1001, "12 34 .,"), (1002, ""), (None, rows[0][1]), (1003, rows[1][1] * 300), (0, rows[0][1])]
    langs = langs | {k: None for k in (1000, 1001, 1002, 1003, None)}
    got = language.identify(docs(rows + extra, lang=langs)).collect()
    assert len(got) == len(rows) + len(extra)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == langs[i] for i, _ in rows)
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (1000, 1001, 1002))
    assert by_id[1003].lang_pred == langs[1] and by_id[None].held_out
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)


def test_languages_never_learn_from_held_out_rows(docs):
    rows, langs = language_rows()
    swapped = {k: ("zz" if zlib.crc32(str(k).encode()) % 5 == 0 else v) for k, v in langs.items()}
    plain = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language.identify(docs(rows, lang=langs)).collect()}
    other = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language.identify(docs(rows, lang=swapped)).collect()}
    assert plain == other
    assert language.identify(docs([])).count() == 0
    assert {r.lang_pred for r in language.identify(docs(rows[:3], lang={k: None for k in range(3)})).collect()} == {"und"}


# --- toxicity


def toxic_rows():
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        said = words(rng, rng.randrange(20, 60))
        toxic, low = i % 7 == 0, i % 5 == 1
        if toxic:
            said.insert(rng.randrange(len(said)), rng.choice(["badword", "Vile!", "nastyx" + str(i % 3)]))
        if low:
            said += ["spam"] * 3
        rows.append((i, " ".join(said)))
        labels.append((i, int(low), int(toxic)))
    return rows, labels


def test_toxicity_catches_unseen_rows(spark, docs):
    rows, labels = toxic_rows()
    known = spark.createDataFrame(labels[:250] + [labels[0], (9999, None, 1), (None, 1, 1)], "doc_id long, low_quality int, toxic int")
    extra = [(1000, None), (1001, ""), (1002, "clean " * 2000 + "badword"), (None, "badword vile")]
    got = toxicity.score_documents(docs(rows + extra), known).collect()
    assert len(got) == len(rows) + len(extra)
    flags = {r.doc_id: r.toxic for r in got}
    assert [flags[i] for i, _, _ in labels] == [bool(t) for _, _, t in labels]
    assert not flags[1000] and not flags[1001] and flags[1002]
    assert all(r.kept != r.toxic and 0 <= r.p_toxic <= 1 for r in got)
    out = toxicity.drop_toxic(docs(rows + extra), known)
    assert out.columns == docs([]).columns and out.count() == sum(not r.toxic for r in got)


def test_toxicity_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, low_quality int, toxic int")
    assert not any(r.toxic for r in toxicity.score_documents(docs(["a", None]), none).collect())
    rows, labels = toxic_rows()
    some = spark.createDataFrame(labels, "doc_id long, low_quality int, toxic int")
    assert toxicity.score_documents(docs([]), some).count() == 0


def test_chain_feeds_earlier_categories_out_of_fold():
    rng = np.random.default_rng(1)
    y1 = rng.random(600) < 0.4
    y2 = y1 & (rng.random(600) < 0.9)
    sets = [np.array([10 if a else 20, 100 + i % 50], np.uint64) for i, a in enumerate(y1)]
    chain = toxicity.fit_chain(np.arange(600), sets, np.c_[y1, y2], ("first", "second"), toxicity.Training(max_words=64))
    assert len(chain.earlier[0]) == 0 and chain.earlier[1][0] > 0
    z = chain.log_odds(*chain.find(np.array([10, 20], np.uint64), np.array([0, 1, 2])), 2)
    assert z[0, 1] > z[1, 1]


# --- benchmark leaks


def leak_case():
    rng = random.Random(12)
    items = [(i, " ".join(words(rng, n, f"i{i}_"))) for i, n in enumerate([1, 3, 5, 8, 15, 30, 59])] + [(90, None), (91, ""), (4, "other item with the same number here")]
    rows = [(0, None), (1, "")]
    want = set()
    for k in range(2, 40):
        host = words(rng, rng.randrange(40), f"h{k}_")
        if k % 2:
            i, text = items[k % 7]
            said = text.split()
            for _ in range(len(said) * (k % 3) // 12):  # up to a sixth of the words edited
                said[rng.randrange(len(said))] = f"x{rng.randrange(999)}"
            at = rng.randrange(len(host) + 1)
            host[at:at] = [said[0].upper() + ",", *said[1:]] if said else []
            want.add((k, i))
        rows.append((k, " ".join(host)))
    return rows, items, want


def test_leaks_are_found_and_clean_documents_left(spark, docs):
    rows, items, want = leak_case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.decontaminate(docs(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.edits <= r.length // 4 + 1 for r in got)
    out = contamination.drop_leaks(docs(rows), benchmark)
    assert out.columns == docs([]).columns and {r.doc_id for r in out.collect()} == {k for k, _ in rows} - {k for k, _ in want}


def test_leaks_in_blocks_and_without_items(spark, docs, monkeypatch):
    rows, items, want = leak_case()
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 100)
    assert {(r.doc_id, r.item_id) for r in contamination.decontaminate(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()} == want
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.decontaminate(docs(rows), none).count() == 0
    assert contamination.drop_leaks(docs(rows), none).count() == len(rows)
    assert contamination.decontaminate(docs([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_edit_distance_matches_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 9)).astype(np.uint64), rng.integers(0, 4, rng.integers(1, 9)).astype(np.uint64)
        table = [[0] * (len(a) + 1) for _ in range(len(b) + 1)]
        for i in range(len(b) + 1):
            for j in range(len(a) + 1):
                table[i][j] = i + j if not i or not j else min(table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + int(a[j - 1] != b[i - 1]))
        assert contamination.edit_distance(a, b, 99)[0] == min(table[-1])


def test_embedding_recall_at_the_bound():
    rng = random.Random(7)
    from strataward.llm.words import word_hashes

    item = [f"w{i}" for i in range(40)]
    items = contamination.Items([1], [word_hashes([" ".join(item).encode()])[0]])
    hits = 0
    for _ in range(60):
        said = list(item)
        for _ in range(8):
            p = rng.randrange(len(said))
            said[p : p + 1] = rng.choice([[], [f"n{rng.random()}"], [said[p], f"n{rng.random()}"]])
        found = contamination.find_leaks(word_hashes([" ".join(["a", "b"] + said + ["c"] * 5).encode()])[0], items)
        hits += bool(found)
    assert hits >= 54


# --- the pipeline


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    rows, labels = toxic_rows()
    base = words(rng, 120, "near")
    items = [(1, " ".join(words(rng, 30, "bench")))]
    rows = rows[:200] + [(500, " ".join(base)), (501, "  ".join(base)), (502, " ".join(base[:-1] + ["changed"])), (503, f"before {items[0][1]} after"), (504, None)]
    df = docs(rows)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1 - low, tox) for i, low, tox in labels[:200]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    toxic = {i for i, _, t in labels[:200] if t}
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == df.columns, name
        ids.append({r.doc_id for r in kept.select("doc_id").collect()})
    everything = {k for k, _ in rows}
    assert ids[0] == everything - toxic
    assert ids[1] == ids[0] - {501} and ids[2] == ids[1] - {502} and ids[3] == ids[2] - {503}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == ids[3]


def test_no_frame_of_pandas_is_needed_for_empty_groups():
    out = repeats._locate_group(pd.DataFrame(columns=["shard", "first", "slack", "phrase"]), pd.DataFrame([(1, 1, 0, b"a b")], columns=["_row", "ord", "start", "words"]))
    assert len(out) == 0


def passage_at_the_bound(rng, item, kind):
    """The item with all its edits of one kind, at distinct places."""
    k = contamination.bound_of(len(item))
    new = rng.integers(1, 2**63, k, dtype=np.uint64)
    if kind == "replaced":
        said = item.copy()
        said[rng.choice(len(item), k, replace=False)] = new
        return said
    if kind == "inserted":
        return np.insert(item, 1 + rng.choice(len(item) - 1, k, replace=False), new)
    return np.delete(item, rng.choice(len(item), k, replace=False))


@pytest.mark.parametrize("kind", ["replaced", "inserted", "deleted"])
@pytest.mark.parametrize("n, trials", [(5, 100), (15, 100), (40, 100), (59, 100), (150, 25), (300, 12), (600, 3)])
def test_recall_at_the_bound_by_size_and_kind_of_edit(n, trials, kind):
    rng = np.random.default_rng(n)
    hits = 0
    for _ in range(trials):
        item = rng.integers(1, 2**63, n, dtype=np.uint64)
        around = rng.integers(1, 2**63, (2, n), dtype=np.uint64)
        said = np.concatenate((around[0, :20], passage_at_the_bound(rng, item, kind), around[1]))
        hits += bool(contamination.find_leaks(said, contamination.Items([1], [item])))
    assert hits >= 0.95 * trials


def test_hash_plans_follow_the_recall_asked_for(spark, docs):
    for n in (15, 40, 150):
        assert contamination.hash_plan(n, 0.999)[1] != contamination.hash_plan(n, 0.5)[1]
    assert contamination.hash_plan(4)[1] == 1 and contamination.hash_plan(5000) == (0, 0)
    rng = random.Random(3)
    text = words(rng, 15, "r")
    benchmark = spark.createDataFrame([(1, " ".join(text))], "item_id long, text string")
    got = contamination.decontaminate(docs([" ".join(text[:6] + text[9:])]), benchmark, recall=0.9999).collect()
    assert [(r.item_id, r.edits) for r in got] == [(1, 3)]
