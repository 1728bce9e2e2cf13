"""Decontamination, the Merkle manifest and cross-tokenizer alignment, against brute force."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dugout.llm import alignment, decontamination, manifest, queries
from dugout.llm.token_counts import byte_names

A, B = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same_rows(got, expected):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, expected)))


# ------------------------------------------------------------------ decontamination

ITEMS = [
    (1, "one Two three four five six seven eight nine ten eleven twelve"),
    (2, "Short item!"),
    (3, "four five six seven eight nine ten eleven twelve thirteen"),
    (3, "ÄÖ über"),
    (None, "an item without any id"),
    (4, None),
    (5, " -- "),
    (6, "ONE two, three four five six seven eight nine ten"),
]


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(docs, items, window=10):
    grams = defaultdict(set)
    for item, text in items:
        w = cut(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            grams[tuple(w[i : i + k])].add(item)
    out = []
    for doc, text in docs:
        w, hit, met = cut(text), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in grams:
                    hit |= set(range(i, i + k))
                    met |= grams[tuple(w[i : i + k])]
        named = sorted(str(m) for m in met if m is not None)
        out.append((doc, len(w), len(hit), len(named), sha(",".join(named)), bool(hit)))
    return out


def planted(seed=3):
    rng = random.Random(seed)
    words = [w for _, t in ITEMS for w in (t or "").split()] + ["noise", "more", "3rd", "été"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 25))) for _ in range(60)]
    texts += [f"x {t} y, {t}" for _, t in ITEMS if t] + ["", None, "über", "AN item\nwithout; any id", "Über, äö Über"]
    rows = list(enumerate(texts))
    return [*rows, rows[3], rows[65], (None, ITEMS[0][1]), (None, ITEMS[0][1]), (None, None)]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_contamination_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
    docs = planted()
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    same_rows(decontamination.contamination(table, items).collect(), brute_contamination(docs, ITEMS))


def test_contamination_one_size_and_query(spark, small, documents):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    expected = brute_contamination(docs, [tuple(r) for r in items.select("item_id", "text").collect()])
    got = queries.op11_benchmark_decontamination(spark, small)
    same_rows(got.collect(), expected)
    assert any(r[-1] for r in expected)


def test_spans_and_documents_are_removed(spark):
    items = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    texts = [
        (1, f"((Before, {ITEMS[0][1]}. After\nall!"),
        (2, "A short ITEM and a short item"),
        (3, "nothing here"),
        (4, None),
        (5, ITEMS[0][1]),
    ]
    docs = spark.createDataFrame([(*t, "kept") for t in texts], "doc_id long, text string, _row string")
    cleaned = {r["doc_id"]: (r["text"], r["_row"]) for r in decontamination.remove_spans(docs, items).collect()}
    assert cleaned == {1: ("((Before, After\nall!", "kept"), 2: ("A and a ", "kept"), 3: (texts[2][1], "kept"), 4: (None, "kept"), 5: ("", "kept")}
    clean = decontamination.clean_documents(docs, items)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {3, 4}


def test_contamination_odd_rows(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    same_rows(decontamination.contamination(odd, items).collect(), brute_contamination(docs, ITEMS))
    assert decontamination.contamination(none, items).count() == 0
    empty = items.filter("false")
    assert {r["contaminated"] for r in decontamination.contamination(odd, empty).collect()} == {False}
    assert decontamination.remove_spans(odd, items).columns == odd.columns


# ------------------------------------------------------------------ manifest


def grown(level):
    """All levels over a list of digests."""
    levels = [level]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def siblings(levels, at):
    found = []
    for level in levels[:-1]:
        found.append(level[at ^ 1] if at ^ 1 < len(level) else "")
        at //= 2
    return found


def folded(digest, at, path):
    for s in path:
        digest = sha(s + digest if at & 1 else digest + s)
        at //= 2
    return digest


def brute_manifest(rows):
    """``rows`` of (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def order(v):
        return (v is not None, v if v is not None else 0)

    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append((order(row[0]), leaf(row), row))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    for held in trees.values():
        held.sort(key=lambda x: x[:2])
    own = {t: grown([x[1] for x in trees[t]]) for t in names}
    top = grown([own[t][-1][0] for t in names]) if names else []
    out = []
    for place, t in enumerate(names):
        for at, (_, digest, row) in enumerate(trees[t]):
            changed = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                changed = leaf((*row[:3], row[3] + 1, row[4]))
            low, high = siblings(own[t], at), siblings(top, place)
            end = folded(folded(changed, at, low), place, high)
            root = top[-1][0]
            out.append((row[0], digest, own[t][-1][0], root, sha("".join(low + high)), end, end == root))
    return out


def op12(rows):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaves = manifest.document_leaves(rows, tampered, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1})
    return leaves, manifest.manifest(leaves)


def contract(rows):
    return [
        (r["key"], r["leaf"], r["subroot"], r["root"], sha("".join(s["digest"] or "" for s in r["path"])), r["copies"][-1], r["copies"][-1] == r["root"])
        for r in rows.collect()
    ]


@pytest.mark.parametrize(("levels", "counts"), [(8, (40, 1, 3)), (1, (9, 2, 1)), (2, (33, 16, 17, 1, 5)), (3, ())])
def test_manifest_against_brute_force(spark, monkeypatch, levels, counts):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    langs = [None, "", "de", "=", "Ünd"]
    rows = [(k * 7 + n, "s", langs[k], n or None, f"text {n % 5} é") for k, c in enumerate(counts) for n in range(c)]
    rows += rows[:2] + [(None, None, "de", 1, None), (None, "x", "de", 2, ""), (-5, "x", None, 2**63 - 1, "")] if rows else []
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    same_rows(contract(op12(table)[1]), brute_manifest(rows))


def test_versions_share_all_other_nodes(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 2)
    rows = [(n, "s", "de" if n % 3 else "en", n, f"t{n}") for n in range(60)]
    leaves, _ = op12(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    base = {(r["tree"], r["level"], r["idx"]): r["digest"] for r in manifest.nodes(leaves).collect()}
    sizes = Counter((t, level) for t, level, _ in base)
    versions = defaultdict(dict)
    for r in manifest.versions(leaves).collect():
        if r["idx"] is not None:
            versions[r["tree"], r["key"]][r["level"], r["idx"]] = r["digest"]
    assert len(versions) == sum(zlib.crc32(str(n).encode()) % 7 == 0 for n in range(60))
    for (tree, _), copies in versions.items():
        depth = max(level for t, level in sizes if t == tree)
        # One copy a level, and what it is made of: its own copies and the first version's nodes.
        assert sorted(level for level, _ in copies) == list(range(depth + 1))
        for level, at in copies:
            if level:
                below = [copies.get((level - 1, i), base.get((tree, level - 1, i), "")) for i in (2 * at, 2 * at + 1)]
                assert copies[level, at] == sha("".join(below))


def test_manifest_query_and_odd_rows(spark, small, odd, none, documents):
    rows = [tuple(r) for r in documents.select(*manifest.FIELDS).collect()]
    same_rows(queries.op12_merkle_manifest(spark, small).collect(), brute_manifest(rows))
    wide = odd.withColumn("n_chars", F.lit(3))
    same_rows(contract(op12(wide)[1]), brute_manifest([tuple(r) for r in wide.select(*manifest.FIELDS).collect()]))
    assert op12(none.withColumn("n_chars", F.lit(3)))[1].count() == 0


# ------------------------------------------------------------------ alignment


class Whole:
    """Alignments of whole texts, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        named = byte_names()
        with open(A, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.known = {i: bytes(named[c] for c in t) for t, i in vocab.items() if all(c in named for c in t)}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, text):
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_bytes, b_bytes = [self.known[i] for i in a], [self.b_bytes(i) for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
            return None
        owner = [[k for k, x in enumerate(own) for _ in x] for own in (a_bytes, b_bytes)]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(*owner, strict=True)))]
        a_ends, b_ends = ({int(e): k + 1 for k, e in enumerate(np.cumsum([len(x) for x in own]))} for own in (a_bytes, b_bytes))
        groups, i, j = [], 0, 0
        for end in sorted(a_ends.keys() & b_ends.keys()):
            groups.append(",".join(map(str, a[i : a_ends[end]])) + "|" + ",".join(map(str, b[j : b_ends[end]])))
            i, j = a_ends[end], b_ends[end]
        return len(a), len(b), groups, links


def brute_alignment(docs):
    whole = Whole()
    found = [(doc, whole.align(text)) for doc, text in docs]
    counts = Counter(pair for _, own in found if own for pair in set(own[3]))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(n, best.get(a, 0))
    rows = []
    for doc, own in found:
        if own is None:
            rows.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = own
        n_best = sum(counts[p] == best[p[0]] for p in links)
        rows.append((doc, a, b, len(groups), len(links), n_best, sum(counts[p] for p in links), sha(";".join(groups))))
    return rows, counts


PARTS = "a|b| |  |\n|\t|\xa0|▁|é|é|🙂|東京|the| of|\x00|\x1c|'s|<|endoftext|>|<s>|1|23|.|...|　|\x85|ﬁ|퟿".split("|")


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_alignment_against_brute_force(spark, odd, monkeypatch, limit):
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    monkeypatch.setattr(alignment, "KEPT_PAIRS", 300)
    monkeypatch.setattr(alignment, "KEPT_BYTES", 20_000)
    rng = random.Random(5)
    docs = [(n, "".join(rng.choices(PARTS, k=rng.randint(0, 14)))) for n in range(800)]
    docs += [(2**53 + 1, "the cat"), (None, "the cat"), (None, " the cat"), (None, None), (7, "<|endoftext|> is text")]
    docs += [(r["doc_id"], r["text"]) for r in odd.collect()]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    expected, counts = brute_alignment(docs)
    same_rows(alignment.align(table, A, B, limit).collect(), expected)
    held = alignment.pair_counts(alignment.counted(table, A, B)).collect()
    assert len(held) == len(counts) and {(r["a"], r["b"]): r["n_docs"] for r in held} == counts


def test_alignment_query_and_empty_table(spark, small, documents, none):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    same_rows(queries.op13_token_alignment(spark, small).collect(), brute_alignment(docs)[0])
    assert alignment.align(none, A, B).count() == 0
    texts = {r["doc_id"]: sha(r["groups"]) for r in alignment.groups(documents, A, B).collect()}
    assert all(texts[r[0]] == r[-1] for r in brute_alignment(docs)[0])


def test_alignment_of_one_table_after_another(spark):
    """Workers keep pieces between tables; counts are each table's own."""
    for docs in ([(1, "the quick fox"), (2, "zebra xylophone")], [(3, "the fox"), (4, "the the fox")]):
        table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
        same_rows(alignment.align(table, A, B).collect(), brute_alignment(docs)[0])


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_texts_are_aligned_once(documents, limit):
    """The second pass reads what the first has written, not the documents."""
    found = alignment.align(documents, A, B, limit).inputFiles()
    assert found and not set(found) & set(documents.inputFiles())


def test_links_are_packed_whole():
    pairs = np.unique(np.random.default_rng(3).integers(0, 2**63, 500, dtype=np.uint64))
    times = np.arange(500) ** 3
    for n in (0, 1, 500):
        got = alignment._links(alignment._packed_links(pairs[:n], times[:n]))
        assert got[0].tolist() == pairs[:n].tolist() and got[1].tolist() == times[:n].tolist()


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64))
    own = alignment.bucket_of(keys)
    tables = [alignment.PerfectHash.levels(keys[own == k]) for k in range(alignment.BUCKETS)]
    at = alignment.PerfectHash(tables).find(keys, own)
    assert sorted(at.tolist()) == list(range(len(keys)))
    # Numbers of a bucket are one range, in the order of buckets.
    assert (np.sort(own[np.argsort(at)]) == own[np.argsort(at)]).all()
