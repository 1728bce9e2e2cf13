"""Benchmark passages in training text, by a broadcast hash set of normalised n-grams.

1. Items and documents become words by one rule; every window of an item's words, or all its words
   if they are fewer, is an n-gram with a hash.
2. One scan of the documents hashes the windows of every text and looks each up in the set of
   n-gram hashes. What meets a hash is verified word by word, so a hash never decides.
3. Verified windows, merged to spans of words, are counted, or cut out with what stands between them.

Everything is column algebra. The n-grams are broadcast while there are at most ``BROADCAST_ROWS``
of them; a larger benchmark is joined by shuffling hashes, with equal rows. A hot n-gram costs a row
for each of its places, and places of one text meet again by that text only. An n-gram carries
the number of its set of items, not the items, so that one held by many items stays small.

Defined results: NULL texts and items have no words; an item of a NULL id marks words but is not
counted or named; one id with several texts is one item; repeated documents each get their row; a
document with no hit has the digest of ''; an empty table gives no rows; an empty benchmark hits
nothing; other columns play no part (``remove_spans`` and ``clean_documents`` keep them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dugout.llm.common import written

WINDOW = 10
BROADCAST_ROWS = 1 << 20
# Separators before and after lower-casing A-Z: all ASCII but digits and letters.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text in order, in their own case; none for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0)), F.array().cast("array<string>"))


def _lower(text: Column) -> Column:
    """A-Z to a-z, nothing else; pure ASCII takes the fast way of ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _hashes(own: Column) -> Column:
    return F.transform(own, lambda w: F.xxhash64(_lower(w)))


def _key(hashes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*(F.get(hashes, at + k) for k in range(size)))


def _spelt(own: Column, at: Column, size: Column | int) -> Column:
    """The n-gram at a place, as text to compare."""
    return _lower(F.array_join(F.slice(own, at + 1, size), " "))


def ngrams(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct n-grams (key, gram, size, item_set), and the sets (item_set, item)."""
    held = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("_words"))
    n = F.size("_words")
    size = F.least(n, F.lit(window))
    places = F.explode(F.sequence(F.lit(0), n - F.least(n, F.lit(window))))
    own = held.filter(n > 0).select("item", "_words", size.alias("size"), places.alias("_at"))
    grams = own.select("item", "size", _spelt(F.col("_words"), F.col("_at"), F.col("size")).alias("gram"))
    # Sets of items are told apart by their digest. NULL items fall out of the set, not the n-gram.
    lists = grams.groupBy("gram", "size").agg(F.array_sort(F.collect_set("item")).alias("_items"))
    lists = lists.withColumn("item_set", F.sha2(F.to_json("_items"), 256))
    split = F.transform(F.split("gram", " "), lambda w: F.xxhash64(w))
    keys = F.when(F.col("size") == window, _key(F.col("_split"), F.lit(0), window))
    for k in range(1, window):
        keys = keys.when(F.col("size") == k, _key(F.col("_split"), F.lit(0), k))
    grams = written(lists.withColumn("_split", split).select(keys.alias("key"), "gram", "size", "item_set", "_items"), "ngrams")
    sets = grams.select("item_set", "_items").dropDuplicates(["item_set"]).select("item_set", F.explode("_items").alias("item"))
    return grams.drop("_items"), sets


def _of_text(text: Column) -> Column:
    """Tells texts of one id apart; NULL for a NULL text."""
    return F.unhex(F.md5(text))


def _places(docs: DataFrame, grams: DataFrame, window: int) -> DataFrame:
    """Rows (doc_id, _text, n_words, _at, size, item_set): a head row with ``_at`` -1 for each document,
    and a row for each place where an n-gram stands."""
    held = docs.select("doc_id", _of_text(F.col("text")).alias("_text"), words(F.col("text")).alias("_words"))
    hashed = held.withColumn("_hashes", _hashes(F.col("_words")))
    # At most ``window`` different sizes.
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())
    n = F.size("_hashes")
    # From the head row to the last place where the shortest n-gram fits.
    last = F.greatest(n - min(sizes), F.lit(-1)) if sizes else F.lit(-1)
    at = F.explode(F.sequence(F.lit(-1), last))
    each = hashed.select("doc_id", "_text", n.alias("n_words"), "_words", "_hashes", at.alias("_at"))
    held_at = F.col("_at") >= 0
    keys = [F.when(held_at & (F.col("_at") + k <= F.col("n_words")), _key(F.col("_hashes"), F.col("_at"), k)) for k in sizes]
    if len(keys) > 1:
        # One row for each size of n-gram; a head row stays one.
        one = F.array(F.lit(None).cast("long"))
        each = each.withColumn("_key", F.explode(F.when(held_at, F.array(*keys)).otherwise(one)))
    else:
        each = each.withColumn("_key", keys[0] if keys else F.lit(None).cast("long"))
    known = grams.select("key", "gram", "size", "item_set")
    if grams.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    met = each.join(known, F.col("_key") == F.col("key"), "left")
    # Only what met a hash is spelt out.
    same = F.when(F.col("gram").isNotNull(), _spelt(F.col("_words"), F.col("_at"), F.col("size")) == F.col("gram"))
    found = met.filter((F.col("_at") < 0) | F.coalesce(same, F.lit(False)))
    return found.select("doc_id", "_text", "n_words", "_at", "size", "item_set")


OF_DOC = ["doc_id", "_text"]


def _spans(places: DataFrame) -> DataFrame:
    """Merged spans of hit words: (doc_id, _text, start, end), end not included."""
    ends = places.filter("_at >= 0").groupBy(*OF_DOC, "_at").agg(F.max(F.col("_at") + F.col("size")).alias("_end"))
    by_place = Window.partitionBy(*OF_DOC).orderBy("_at")
    before = F.max("_end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("_at") <= F.col("_reached"), 0).otherwise(1)
    run = F.sum("_new").over(by_place)
    runs = ends.withColumn("_reached", before).withColumn("_new", new).withColumn("_run", run)
    return runs.groupBy(*OF_DOC, "_run").agg(F.min("_at").alias("start"), F.max("_end").alias("end")).drop("_run")


def _same_doc(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Joins by (doc_id, _text), NULLs included; the left columns of those names stay."""
    other = right.withColumnsRenamed({"doc_id": "_doc_r", "_text": "_text_r"})
    same = left["doc_id"].eqNullSafe(other["_doc_r"]) & left["_text"].eqNullSafe(other["_text_r"])
    return left.join(other, same, how).drop("_doc_r", "_text_r")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Runs jobs at once. The driver sees the sizes of n-grams and their count only.
    """
    grams, sets = ngrams(items, window)
    places = written(_places(docs, grams, window), "places")
    heads = places.filter("_at < 0").groupBy(*OF_DOC).agg(F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("_rows"))
    hits = _spans(places).groupBy(*OF_DOC).agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"))
    met = places.filter("_at >= 0").select(*OF_DOC, "item_set").distinct().join(sets, "item_set")
    named = met.groupBy(*OF_DOC).agg(F.array_sort(F.collect_set("item")).alias("_items"))
    whole = _same_doc(_same_doc(heads, hits, "left"), named, "left")
    own = F.coalesce("_items", F.array().cast("array<string>"))
    # Equal rows were counted together and come apart here.
    whole = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
    return whole.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(own).cast("long").alias("n_items"),
        F.sha2(F.array_join(own, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _marked(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """``docs`` as one column ``_row``, with the text and the array ``_cut`` of hit spans, NULL without any."""
    grams, _ = ngrams(items, window)
    spans = _spans(written(_places(docs, grams, window), "places"))
    cuts = spans.groupBy(*OF_DOC).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cut"))
    rows = docs.select("doc_id", F.col("text").alias("_whole"), _of_text(F.col("text")).alias("_text"), F.struct("*").alias("_row"))
    return _same_doc(rows, cuts, "left")


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no n-gram of an item, with all their columns."""
    return _marked(docs, items, window).filter("_cut is null").select("_row.*")


def remove_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every hit word cut out of the text, along with what separates it from the next word."""
    marked = _marked(docs, items, window)
    text = F.col("_whole")
    pieces = F.regexp_extract_all(text, F.lit(f"{WORD}+{GAP}*"), F.lit(0))
    starts = F.concat(F.array(F.lit(0)), F.col("_cut.end"))
    ends = F.concat(F.col("_cut.start"), F.array(F.size("_pieces")))
    between = F.zip_with("_starts", "_ends", lambda a, b: F.array_join(F.slice(F.col("_pieces"), a + 1, b - a), ""))
    lead = F.regexp_extract(text, f"^{GAP}*", 0)
    cut = F.when(F.col("_cut").isNull(), text).otherwise(F.concat(lead, F.array_join(between, "")))
    split = marked.withColumn("_pieces", F.when(F.col("_cut").isNotNull(), pieces))
    split = split.withColumns({"_starts": starts, "_ends": ends}).withColumn("_clean", cut)
    own = [F.col("_clean").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns]
    return split.select(*own)
