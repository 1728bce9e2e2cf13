"""Packing, sharding, mixing, the two near-duplicate joins and the pipeline, against brute force."""

import bisect
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from dugout.llm import embedding_dedup, jaccard_join, mixing, packing, queries, sharding
from dugout.llm.components import by_group, components, forest

WORDS = queries.vocabulary("word_bpe_49k.json")


def shingle_set(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def roots(ids, pairs):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# ------------------------------------------------------------------ packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120), st.integers(1, 20))
def test_plan_places_every_piece_once(lengths, groups):
    histogram = dict(Counter(lengths))
    table = packing.places(packing.plan(histogram, 64, groups))
    seen, inside = Counter(), defaultdict(list)
    for row in table.itertuples():
        assert (row.end - row.first) % row.each == 0
        for k in range(row.end - row.first):
            seen[row.length, row.first + k] += 1
            inside[row.sequence + k // row.each].append((row.offset + k % row.each * row.length, row.length))
    assert seen == Counter({(n, k): 1 for n, c in histogram.items() for k in range(c)})
    for held in inside.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else capacity
        bisect.insort(rooms, room - n)
    return len(rooms)


def test_few_sequences():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(6, 1, 20000).astype(int) + 1, 2048)
    runs = packing.plan(dict(Counter(lengths.tolist())), 2048)
    used = sum(r.count for r in runs)
    assert used <= 1.002 * best_fit(lengths.tolist(), 2048) + 2


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aThé'slı İΣ中😀1!.,<|endoftx> \n\x1ć가", max_size=30))
def test_ids_of_words_are_ids_of_texts(text):
    ids = packing._ids(WORDS)
    assert ids.text(text) == np.array(ids.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing_query(spark, small):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    rows = queries.op1_best_fit_packing(spark, small).collect()
    by_sequence, by_piece = defaultdict(list), {}
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_piece[r["doc_id"], r["piece"]] = r
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    n = 0
    for d in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            r = by_piece[d["doc_id"], k // 2048]
            part = np.array(ids[k : k + 2048], "<u4").tobytes()
            assert (r["start"], r["length"], r["ids_crc32"]) == (k, len(part) // 4, zlib.crc32(part))
            n += 1
    assert n == len(rows)
    assert len(by_sequence) <= best_fit([r["length"] for r in rows], 2048) + 2


def test_packing_odd_rows(spark, odd, none):
    rows = packing.pack(odd, WORDS, 128, with_ids=True).collect()
    assert sum(r["length"] == 1 and r["ids"] == [0] for r in rows) == 3  # NULL, empty, white space
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert sum(r["doc_id"] is None for r in rows) == 1
    assert packing.pack(none, WORDS).count() == 0


READ_AT_ONCE = "spark.sql.parquet.columnarReaderBatchSize"


@pytest.mark.parametrize("before, inside", [(("10000", "4096"), ("512", "512")), (("100", "100"), ("100", "100"))])
def test_packing_reads_few_texts_at_once(spark, odd, monkeypatch, before, inside):
    """With thousands of texts at once, an executor's heap grew until a copy of it, for a moment, passed 3000 MB."""
    keys, seen, write = (ROWS_AT_ONCE, READ_AT_ONCE), [], packing.written
    monkeypatch.setattr(packing, "written", lambda df, label: [seen.append(tuple(map(spark.conf.get, keys))), write(df, label)][1])
    usual = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
        packing.pack(odd, WORDS)
        assert seen == [inside] and tuple(map(spark.conf.get, keys)) == before
    finally:
        for k, v in zip(keys, usual, strict=True):
            spark.conf.set(k, v)


def test_packing_shuffles_and_sorts_pieces_once(spark, odd):
    plan = packing.pack(odd, WORDS)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_numbers_of_pieces_do_not_depend_on_blocks(spark, monkeypatch):
    """A length that most pieces have, keys that repeat or are NULL, and ids over 2^53."""
    ids, found = [None, 7, 2**53 + 1, *range(700)], []
    docs = spark.createDataFrame([(i, t) for i in ids for t in ("the", "the", None)], "doc_id long, text string").repartition(3)
    for counts, blocks in ((packing.COUNTS, 256), (16, 11), (1, 1)):
        monkeypatch.setattr(packing, "COUNTS", counts)
        assert max(packing._blocks({1: len(ids), 2: 2 * len(ids)})["_blocks"].to_pylist(), default=1) == blocks
        found.append(sorted(map(tuple, packing.pack(docs, WORDS, 8).collect()), key=repr))
    assert found[0] == found[1] == found[2]
    assert Counter(r[0] for r in found[0]) == Counter(i for i in ids for _ in range(3))
    held = defaultdict(list)
    for *_, length, _, sequence, offset in found[0]:
        held[sequence].append((offset, length))
    for inside in held.values():
        assert [o for o, _ in sorted(inside)] == [sum(n for _, n in sorted(inside)[:k]) for k in range(len(inside))]
    assert len(held) == -(-sum(r[3] for r in found[0]) // 8)


# ------------------------------------------------------------------ sharding


def jump_by_hand(key, n):
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [0, 1, 2, -1, 256, 2**63 - 1, -(2**63), *random.Random(4).sample(range(2**62), 200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 40, 1000):
        got = df.select("k", sharding.jump(F.col("k"), n).alias("s")).collect()
        assert [(r["k"], r["s"]) for r in got] == [(k, jump_by_hand(k, n)) for k in keys]


def test_sharding_moves_only_into_the_new_shard(spark, small):
    rows = queries.op5_jump_sharding(spark, small).collect()
    assert all(r["grown_shard"] in (r["shard"], 40) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_odd_rows(odd, none):
    wide = sharding.shard(odd, 5, columns=odd.columns)
    assert wide.count() == odd.count() and dict(wide.dtypes)["size"] == "bigint"
    rows = {r["doc_id"]: r for r in sharding.shard(odd, 5).collect()}
    assert rows[3]["size"] == rows[4]["size"] == 16 and rows[3]["text_crc32"] == 0
    assert rows[None]["shard"] == jump_by_hand(0, 5)
    assert sharding.shard(none, 5).count() == 0
    assert {r["shard"] for r in sharding.shard(odd, 1, key="text").collect()} == {0}


# ------------------------------------------------------------------ mixing


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    out, left, total = {}, set(names), share * sum(sizes.values())
    while left:
        level = total / sum(weight[s] for s in left)
        full = {s for s in left if level * weight[s] > cap * sizes[s]}
        for s in full or left:
            out[s] = cap * sizes[s] if full else level * weight[s]
        total -= sum(out[s] for s in full)
        left -= full or left
    return out


def test_mix_query(spark, small):
    rows = queries.op10_pivotal_mix(spark, small).collect()
    docs = {d["doc_id"]: d for d in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        d = docs[r["doc_id"]]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
        sizes[d["source"]] += r["size"]
        taken[d["source"]] += r["taken"]
        largest[d["source"]] = max(largest[d["source"]], r["size"])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    want = targets_by_hand(sizes)
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = queries.op10_pivotal_mix(spark, small).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_mix_keeps_expectations(spark):
    """Over seeds every document is taken as often as its fraction says."""
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "ab"[i % 2]) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = Counter()
    for seed in range(12):
        for r in mixing.decide(df, (1, 3), 1.0, 2.0, seed).collect():
            times[r["source"]] += r["copies"] * r["n_rows"] + r["n_more"]
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    want = targets_by_hand(size, (1, 3, 1), 1.0)
    for s in "ab":
        assert times[s] / 12 / 75 == pytest.approx(want[s] / size[s], abs=0.05)


def test_mix_odd_rows(odd, none):
    report = mixing.mix_report(odd).collect()
    assert len(report) == odd.count()
    assert all(r["taken"] == 0 for r in report if r["size"] == 0)
    mixed = mixing.apply_mix(odd)
    assert mixed.columns == odd.columns
    took = Counter(r["doc_id"] for r in mixed.collect())
    asked = Counter()
    for r in report:
        asked[r["doc_id"]] += r["copies"]
    assert took == +asked
    assert mixing.mix_report(none).count() == 0 and mixing.apply_mix(none).count() == 0


def test_mix_of_repeated_rows_meets_its_target(spark):
    """Equal rows are rounded row by row: a source of one repeated row misses its target by less than one row."""
    rows = [(1, "a", " ".join(["w"] * 20))] * 50 + [(2, "b", "x y z")] * 7 + [(3, "b", f"x y {i}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    report = mixing.mix_report(df).collect()
    assert len(report) == len(rows)
    for source, largest in (("a", 20), ("b", 3)):
        own = [r for r in report if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= largest
        assert all(r["taken"] <= 2 * r["size"] for r in own)
    took = Counter(r["text"] for r in mixing.apply_mix(df).collect())
    assert sum(took.values()) == sum(r["copies"] for r in report)
    assert all(took[t] <= 2 for t in {f"x y {i}" for i in range(9)})


# ------------------------------------------------------------------ near duplicates


def test_large_ids_beside_a_null(spark):
    """Ids over 2**53 stay what they are in a batch with a NULL id, and no link is lost."""
    ids = [2**53 + 1, 2**53 + 3, 2**63 - 1, 2**63 - 3, -(2**63), None]
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(i, text + (" end" if k % 2 else "")) for k, i in enumerate(ids)], "doc_id long, text string").coalesce(1)
    whole = {i for i in ids if i is not None}
    groups = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_groups(docs).collect()}
    assert groups == {i: -(2**63) for i in whole} | {None: None}
    assert {r["doc_id"] for r in packing.pack(docs, WORDS).collect()} == set(ids)
    vectors = spark.createDataFrame([(i, [1.0, 2.0 + k * 1e-3]) for k, i in enumerate(ids)], "vec_id long, embedding array<double>").coalesce(1)
    found = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_duplicates(vectors).collect()}
    assert found == {i: -(2**63) for i in whole} | {None: None}


def test_families_of_a_template_are_quick():
    """Texts with many edits of their own link with nothing, and cost no walk of each against all."""
    rng = random.Random(8)
    template, sets = [f"t{i}" for i in range(340)], []
    for k in range(3000):
        words = list(template)
        for e, at in enumerate(rng.sample(range(340), 12)):
            words[at] = f"own{k}x{e}"
        sets.append(jaccard_join.shingles(" ".join(words), 4))
    start = time.monotonic()
    assert jaccard_join.linked(sets, jaccard_join.Join()) == list(range(3000))
    assert time.monotonic() - start < 30



def near_copies(seed, n_groups=12, words=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdef", k=rng.randint(1, 4))) for _ in range(300)]
    passage = rng.choices(vocabulary, k=55)
    texts = []
    for _ in range(n_groups):
        base = rng.choices(vocabulary, k=rng.randint(3, words)) + (passage if rng.random() < 0.4 else [])
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("seed", range(25))
def test_trie_join_against_all_pairs(seed):
    join = jaccard_join.Join()
    texts = near_copies(seed)
    sets = [jaccard_join.shingles(t, 4) for t in texts]
    got = jaccard_join.linked(sets, join)
    plain = [set(s.tolist()) for s in sets]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(plain[i] & plain[j]) >= 85 * len(plain[i] | plain[j])]
    want = roots(range(len(sets)), pairs)
    assert roots(range(len(sets)), [(i, r) for i, r in enumerate(got)]) == want


def test_jaccard_join_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CLUSTER", 4)  # clusters are cut into slices
    texts = near_copies(99, 40) + near_copies(5, 3, 8)
    df = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.similar_groups(df).collect()}
    sets = {i * 3: shingle_set(t) for i, t in enumerate(texts)}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(sets, pairs)
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}
    assert len(set(want.values())) < len(want)


def test_jaccard_odd_rows(odd, none):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.similar_groups(odd).collect())
    assert got[2, 14, 1] == 2 and got[1, 14, 1] == 1
    assert got[3, 0, 3] == got[4, 0, 4] == got[7, 0, 7] == 1
    assert got[9, 1, 8] == 1 and sum(n for (i, _, c), n in got.items() if i is None and c is None) == 1
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 3, 4, 5, 7, 8, None, 10], key=str)
    assert jaccard_join.similar_groups(none).count() == 0 and jaccard_join.keep_one(none).count() == 0


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BUCKET", 30)  # buckets are cut into slices
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    close = base[0] + 0.12 * rng.standard_normal((120, 16))
    x = np.concatenate([base, close, base[:5], base[5:15] + 0.03 * rng.standard_normal((10, 16)), 3 * base[20:22]])
    rows = [(i * 2, v.tolist()) for i, v in enumerate(x)]
    bad = [(1, None), (3, []), (5, [0.0] * 16), (7, [1.0, None] * 8), (9, [float("nan")] * 16), (11, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(4)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    pairs = [(2 * i, 2 * j) for i, j in zip(*np.nonzero(linked), strict=True) if i < j]
    want = roots([i for i, _ in rows], pairs)
    found = sum(got[i]["n_links"] for i, _ in rows)
    true = int(linked.sum()) - len(x)
    assert 0.98 * true <= found <= true
    assert sum(got[i]["component_id"] == want[i] for i, _ in rows) >= 0.98 * len(rows)
    for i, _ in bad:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert len(got) == len(rows) + len(bad)


def test_vectors_query_and_odd_rows(spark, small):
    rows = queries.op8_embedding_near_dedup(spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/embeddings.parquet").count()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    twice = spark.createDataFrame([(1, [1.0, 2.0], "x"), (1, [1.0, 2.0], "x"), (4, [2.0, 4.0], None)], "vec_id long, embedding array<float>, digest string")
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(twice).collect())
    assert got == {(1, 2, 1): 2, (4, 2, 1): 1}
    assert embedding_dedup.near_duplicates(twice.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, j) for j in range(101, 120)] + [(7, 7), (None, 3)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame([(b, a) for a, b in edges], "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{j: 100 for j in range(100, 120)}}


def test_groups_are_never_cut():
    import pandas as pd

    keys = sorted(random.Random(2).choices(range(9), k=200))
    frame = pd.DataFrame({"k": keys})
    for size in (1, 3, 50, 400):
        parts = list(by_group(iter(frame.iloc[i : i + size] for i in range(0, 200, size)), ["k"]))
        assert pd.concat(parts)["k"].tolist() == keys
        seen = [set(p["k"]) for p in parts]
        assert not any(a & b for i, a in enumerate(seen) for b in seen[:i])


def test_forest():
    pairs = np.array([[1, 2], [2, 3], [5, 4], [0, 3]])
    assert forest(7, pairs).tolist() == [0, 0, 0, 0, 4, 4, 6]


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "near_copies", "mix_sources", "pack_sequences"]
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == before
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        counts.append(docs.count())
    assert counts[1] >= 0.97 * counts[0] and counts[3] <= counts[2] <= counts[1]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert packed.where("piece = 0").count() == counts[-1]
    assert corpus_pipeline.run(spark, small).count() == packed.count()


def test_pipeline_stages_on_odd_rows(spark, odd, none, small):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, small).count() >= 0
        assert stage(spark, none, small).count() == 0


def test_near_copies_stage_against_brute_force(spark, small):
    rng, texts = random.Random(7), []
    for group, (n, block) in enumerate([(200, 13), (200, 15), (200, 17), (200, 18), (200, 22), (1000, 0)]):
        base = [f"w{group}x{i}" for i in range(n)]
        copy = list(base)
        for at in range(60, 60 + block) if block else range(20, 20 + 45 * 21, 45):
            copy[at] = f"new{group}x{rng.random()}"
        texts += [" ".join(base), " ".join(copy)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, df, small).collect()}

    def alike(n, percent):
        sets = [shingle_set(t, n) for t in texts]
        return {(a, b) for b in range(len(texts)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}

    want = roots(range(len(texts)), alike(5, 80))
    assert got == {i for i, root in want.items() if i == root}
    assert len(alike(5, 80) - alike(4, 85)) >= 3 and not alike(4, 85) - alike(5, 80)


def test_ties_need_the_index_part_of_the_smaller_set():
    """Sets that share n-grams late in both prefixes only cannot link; all that may link are connected."""
    join = jaccard_join.Join()
    grams, sizes = np.array([7, 7, 7, 7, 7, 9, 9], np.int64), np.array([100, 104, 108, 110, 200, 100, 104])
    at, to = jaccard_join._runs(grams, sizes, np.array([False, True, False, True, False, False, False]), join)
    assert at.tolist() == list(range(7)) and to.tolist() == [-1, -1, 1, 1, -1, -1, -1]
    none = np.zeros(0, np.int64)
    assert [len(x) for x in jaccard_join._runs(none, none, none.astype(bool), join)] == [0, 0]
    rng = random.Random(3)
    for _ in range(300):
        sets = [frozenset(rng.sample(range(30), rng.randint(1, 25))) for _ in range(2)]
        for join in (jaccard_join.Join(), jaccard_join.Join(5, 80), jaccard_join.Join(5, 40)):
            small, large = sorted(sets, key=len)
            if 100 * len(small & large) >= join.percent * len(small | large):
                first = min(small & large)
                assert sorted(small).index(first) < join.index(len(small)) and sorted(large).index(first) < join.prefix(len(large))


def shared_and_counted(monkeypatch, spark):
    """Rows of the tables that the join writes, by label."""
    rows, whole = {}, jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, label: [t := whole(df, label), rows.update({label: t.count()})][0])
    return rows


def test_sets_that_only_share_an_ngram_form_no_cluster(spark, monkeypatch):
    """Texts in a chain of rare shared n-grams were one cluster, which grew faster than the tables and was walked in slices."""
    texts, rng = [], random.Random(4)
    for i in range(30):
        own = rng.choices([f"w{k}" for k in range(40)], k=60)
        texts.append(" ".join([f"s{i}y{k}" for k in range(4)] + own + [f"s{i + 1}y{k}" for k in range(4)]))
    texts.append(texts[7] + " end")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = shared_and_counted(monkeypatch, spark)
    groups = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_groups(docs).collect()}
    assert groups == {i: i for i in range(30)} | {30: 7}
    assert rows["ties"] >= 20 and rows["clusters"] == 2


def test_bits_part_no_sets_that_may_link():
    rng = random.Random(11)
    for join in (jaccard_join.Join(), jaccard_join.Join(5, 80)):
        parted = 0
        for _ in range(400):
            n = rng.choice([1, 5, 60, 64, 65, 120, 128, 130, 500, 1020, 1030])
            whole = [rng.getrandbits(64) for _ in range(n + n // 2 + 2)]
            small, large = (jaccard_join.distinct(np.array(rng.sample(whole, k), np.uint64)) for k in (n, min(len(whole), n + rng.randint(0, n // 5 + 1))))
            edited = jaccard_join.distinct(np.append(small[: len(small) - rng.randint(0, n // 9)], np.array(whole[: rng.randint(0, n // 9)], np.uint64)))
            for a, b in ((small, large), (small, edited), (edited, large)):
                same = len(np.intersect1d(a, b))
                bits = jaccard_join.parity(a), len(a), jaccard_join.parity(b), len(b)
                if 100 * same >= join.percent * (len(a) + len(b) - same):
                    assert jaccard_join.may_link(*bits, join)
                parted += not jaccard_join.may_link(*bits, join)
        assert parted > 300


def test_runs_travel_packed():
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        g = np.sort(rng.integers(0, 1 << jaccard_join.TIE_BITS, n))
        low, high, s = rng.integers(1, 1 << 24, n), rng.integers(0, 1 << 25, n), rng.integers(-(2**63), 2**63 - 1, n)
        packed = jaccard_join._packed_runs(g, low, high, s)
        assert [x.tolist() for x in jaccard_join._unpacked_runs(packed, n)] == [x.tolist() for x in (g, low, high, s)]
        assert len(packed) < 20 * n + 60


@pytest.mark.parametrize("few", [2, 4, 32])
def test_ties_connect_all_that_may_link(monkeypatch, few):
    """By every two of few sets with an n-gram, or in a row; sets of one run count as connected."""
    monkeypatch.setattr(jaccard_join, "FEW", few)
    rng, join, sure_ones = random.Random(few), jaccard_join.Join(4, 70), 0
    for _ in range(150):
        base = [sorted(rng.sample(range(400), rng.randint(3, 14))) for _ in range(2)]
        sets = []
        for _ in range(rng.randint(2, 14)):
            copy = set(rng.choice(base)) | set(rng.sample(range(400), rng.randint(0, 1)))
            copy.discard(rng.choice(sorted(copy)))
            sets.append(sorted(copy))
        rows = [(g, len(x), k < join.index(len(x)), i) for i, x in enumerate(sets) for k, g in enumerate(x[: join.prefix(len(x))])]
        # Two batches; in the first, n-grams of three sets or more go as runs.
        runs, joined = [], []
        for half in (0, 1):
            own = [r for r in rows if r[3] % 2 == half]
            g, n, index, s = (np.array([r[k] for r in own], t) for k, t in enumerate((np.int64, np.int64, bool, np.int64)))
            at, to = jaccard_join._runs(g, n, index, join)
            times = np.array([(g == x).sum() for x in g[at]], int)
            to = np.where((times > 2) & (half == 0), to, -1)
            starts = [*np.flatnonzero(to < 0), len(at)]
            for a, b in zip(starts, starts[1:], strict=False):
                of = at[a:b]
                runs.append((g[of[0]], n[of[0]], max((n[of] * index[of]).tolist()), len(of) > 1, s[of[0]]))
            joined += [(int(s[at[t]]), int(s[at[k]])) for k, t in enumerate(to) if t >= 0]
        g, low, high, many, s = (np.array([r[k] for r in runs], bool if k == 3 else np.int64) for k in range(5))
        ties = jaccard_join._tied_runs(g, low, high, many, s, join).tolist()
        plain = [set(x) for x in sets]
        alike = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(plain[i] & plain[j]) >= 70 * len(plain[i] | plain[j])]
        kept = joined + [(a, b) for a, b, sure in ties if sure or (b, a) in alike]
        sure_ones += sum(sure for _, _, sure in ties)
        root = roots(range(len(sets)), kept)
        assert all(root[i] == root[j] for i, j in alike)
    assert sure_ones


def test_sketches_of_many_tasks(spark, monkeypatch):
    """Counts of a byte or more; the sums of ``FOLD`` tasks are shuffled, which were those of every ``FOLD``th, nearly all."""
    monkeypatch.setattr(jaccard_join, "FOLD", 2)
    chunks = [(c, t, np.random.default_rng(c + t).integers(0, top, jaccard_join.CHUNK).astype(np.uint32)) for c, t, top in ((0, 0, 9), (0, 1, 255), (0, 5, 70_000), (7, 2, 3), (159, 3, 2))]
    parts = spark.createDataFrame([(c, t, bytearray(jaccard_join._pack(n))) for c, t, n in chunks], "chunk int, task int, counts binary")
    asked, whole = [], jaccard_join.in_groups
    monkeypatch.setattr(jaccard_join, "in_groups", lambda df, *a: [asked.append(df.select("chunk", "fold").distinct().count()), whole(df, *a)][1])
    sketch = jaccard_join._sketch(parts)
    want = np.zeros_like(sketch)
    for c, _, n in chunks:
        want[c * jaccard_join.CHUNK : (c + 1) * jaccard_join.CHUNK] += n
    assert (sketch == want).all() and asked == [4, 3]
    assert len(jaccard_join._pack(chunks[0][2])) < 0.7 * jaccard_join.CHUNK


def test_few_texts_are_shuffled_to_keep_one(spark):
    """All texts were; rows whose id is no copy and comes once stay where they are."""
    docs = spark.createDataFrame([(i, f"t{i}", i) for i in range(1000)] + [(None, "n", 0)], "doc_id int, text string, _bits int")
    asked = spark.createDataFrame([(i,) for i in (3, 500, 999, 4000)], "rep long")
    likely, others = ([tuple(r) for r in df.collect()] for df in jaccard_join._likely(docs, asked))
    assert {3, 500, 999} <= {r[0] for r in likely} and len(likely) < 20
    assert Counter(likely + others) == Counter(tuple(r) for r in docs.collect())
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text, "a"), (2, text + " end", "b"), (3, "x y z", "c"), (3, "x y z", "c"), (3, "other words", "d"), (3, text, "e"), (None, text, "f"), (4, None, "g"), (4, None, "g"), (5, "p q", "h")]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id int, text string, own string"), corpus_pipeline.NEAR)
    assert Counter(r["own"] for r in kept.collect()) == Counter("acdefgh")


ROWS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("before, inside", [("10000", "512"), ("0", "512"), ("100", "100")])
def test_workers_get_few_texts_at_once(spark, odd, small, monkeypatch, before, inside):
    """With whole partitions at once, near_copies took over 3000 MB of an executor."""
    seen, whole = [], jaccard_join.components
    monkeypatch.setattr(jaccard_join, "components", lambda edges: [seen.append(spark.conf.get(ROWS_AT_ONCE)), whole(edges)][1])
    usual = spark.conf.get(ROWS_AT_ONCE)
    try:
        spark.conf.set(ROWS_AT_ONCE, before)
        jaccard_join.similar_groups(odd)
        assert seen == [inside] * 2 and spark.conf.get(ROWS_AT_ONCE) == before
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.set(ROWS_AT_ONCE, before)
            if name in ("language_id", "quality_rules", "pack_sequences"):
                stage(spark, odd, small)
                assert spark.conf.get(ROWS_AT_ONCE) == inside
    finally:
        spark.conf.set(ROWS_AT_ONCE, usual)


def test_stages_read_few_texts_at_once(spark, odd, small, monkeypatch):
    """With 4,096 texts at once, executors' heaps grew until near_copies took over 3000 MB."""
    seen, whole = [], jaccard_join.components
    monkeypatch.setattr(jaccard_join, "components", lambda edges: [seen.append(spark.conf.get(READ_AT_ONCE)), whole(edges)][1])
    keys = (ROWS_AT_ONCE, READ_AT_ONCE)
    usual = [spark.conf.get(k) for k in keys]
    try:
        for before, inside in (("4096", "512"), ("100", "100")):
            seen.clear()
            spark.conf.set(READ_AT_ONCE, before)
            jaccard_join.similar_groups(odd)
            assert seen == [inside] * 2 and spark.conf.get(READ_AT_ONCE) == before
            for _, stage in corpus_pipeline.STAGES:
                spark.conf.set(READ_AT_ONCE, before)
                stage(spark, odd, small)
                assert spark.conf.get(READ_AT_ONCE) == inside
    finally:
        for k, v in zip(keys, usual, strict=True):
            spark.conf.set(k, v)


@pytest.mark.parametrize("own", [0.05, 0.3])
def test_links_hold_little_beside_the_sets(own):
    """Sorting all n-grams of a group at once held 6 to 7 times the sets; two workers of an executor do so."""
    rng = np.random.default_rng(5)
    families = [rng.integers(0, 2**63, 1000, np.uint64) for _ in range(40)]
    sets = []
    for k in range(1600):
        grams = families[k % 40].copy()
        grams[rng.choice(1000, int(1000 * own), replace=False)] = rng.integers(0, 2**63, int(1000 * own), np.uint64)
        sets.append(jaccard_join.distinct(grams))
    tracemalloc.start()
    try:
        got = jaccard_join.linked(sets, jaccard_join.Join(5, 80))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == ([k % 40 for k in range(1600)] if own < 0.1 else list(range(1600)))
    assert peak < 4 * sum(s.nbytes for s in sets)


@given(st.lists(st.frozensets(st.integers(0, 12)), min_size=1, max_size=9), st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_numbers_of_shared_grams(plain, at_once):
    sets = [np.array(sorted(s), np.uint64) for s in plain]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(jaccard_join, "RANGE", at_once)
        tokens, counts = jaccard_join._numbered(sets)
    times = Counter(x for s in plain for x in s)
    common = sorted(x for x, n in times.items() if n > 1)
    assert [[common[t] for t in own] for own in tokens] == [sorted(s & set(common)) for s in plain]
    assert counts.tolist() == [times[x] for x in common]


def test_plan_of_the_mix_holds_no_level_twice(spark, small):
    decided = mixing.decide(queries.documents(spark, small))
    assert "collect_list" not in decided._jdf.queryExecution().optimizedPlan().toString()


def test_texts_travel_compressed(spark):
    texts = ["a text of some words " * 400, "", None, "é 東京 \x00"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in jaccard_join._compressed(docs).collect()}
    codec = jaccard_join.pa.Codec("zstd")
    got = [rows[i]["_text"] and codec.decompress(bytes(rows[i]["_text"]), rows[i]["_size"], asbytes=True).decode() for i in range(4)]
    assert got == texts and len(rows[0]["_text"]) < 200
