"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed character n-grams (one to three letters, words padded with a
space), TF-IDF weighted and of length one. Spherical k-means splits each language's training
vectors into a few clusters; the language of the centroid with the highest cosine wins. A
text farther from its centroid than training texts are, by a margin, is rejected.

Fitting takes a bounded sample of labelled rows: at most ``fit_rows`` in all, an equal share
for each language, chosen by a hash of the id. Prediction reads whole texts.

Defined results: NULL texts and texts without a letter are 'und' with score 0 and rejected; so is
everything if there is no labelled row; among equal cosines the first language in code point
order wins; repeated rows get equal results; other columns are kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import PerText

UNKNOWN = "und"
DIMS = 4096
_STEPS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
# Code points hashed at a time: bounds memory for very long texts.
PIECE = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``fit_rows`` bounds the sample (split over the languages, at most 256 of them)."""

    fit_rows: int = 2048
    clusters: int = 4
    rounds: int = 12
    least_share: float = 0.2
    slack: float = 0.12
    seed: int = 5


def in_training(doc_id: Column) -> Column:
    """Documents that may be learned from; the rest are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point itself if a letter or mark, else a space; and whether it is a letter.

    Letters beyond the first plane are one symbol, 65536.
    """
    import unicodedata

    kinds = np.array([unicodedata.category(chr(code))[0] for code in range(0x110000)])
    codes = np.minimum(np.arange(0x110000, dtype=np.uint32), np.uint32(65536))
    return np.where((kinds == "L") | (kinds == "M"), codes, np.uint32(32)), kinds == "L"


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed n-grams of the whole text; None if it has no letter."""
    counts = np.zeros(DIMS, np.float32)
    tail = np.array([32], np.uint32)
    seen = False
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols, letters = _letters()
        kept = np.concatenate([tail, symbols[codes]])
        blank = kept == 32
        seen = seen or bool(letters[codes].any())
        # Runs of spaces are one space.
        keep = ~(blank & np.concatenate([[False], blank[:-1]]))
        keep[0] = True
        kept, blank = kept[keep], blank[keep]
        a = kept * np.uint32(_STEPS[0])
        for n in (1, 2, 3):
            if len(kept) < n:
                break
            mixed = a[: len(a) - n + 1].copy()
            for k in range(1, n):
                mixed ^= (kept[k : len(kept) - n + 1 + k] + np.uint32(n)) * np.uint32(_STEPS[k])
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            mixed ^= mixed >> np.uint32(12)
            inside = ~blank[: len(mixed)] if n == 1 else ~(blank[: len(mixed)] & blank[n - 1 :])
            counts += np.bincount(mixed[inside] % np.uint32(DIMS), minlength=DIMS)
        tail = kept[-2:]
    return counts if seen else None


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    """``centroids``: one row per cluster; ``of``: its language; ``reach``: the lowest accepted cosine."""

    langs: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray
    of: np.ndarray
    reach: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        return [self._nearest(t) for t in texts]

    def _nearest(self, text: str | None) -> tuple[str, float, bool]:
        """One text by itself: its result does not depend on the texts beside it."""
        found = ngram_counts(text) if isinstance(text, str) else None
        if found is None or not self.langs:
            return UNKNOWN, 0.0, True
        cosines = np.round(self.centroids @ self.vectors(found), 9)
        # Among equals the first, and centroids stand in the order of their languages.
        k = int(cosines.argmax())
        score = float(np.clip(cosines[k], 0.0, 1.0))
        # Short texts fill few of the dimensions, so they lie farther from any centroid.
        few = min(1.0, float(found.sum()) / 600)
        return self.langs[self.of[k]], score, bool(score < self.reach[k] * few)


def sample(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id of the rows to fit on: an equal share per language, the smallest hashes of the id."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & in_training(F.col("doc_id")))
    # Two levels, so that Spark can cut each language to its share before the shuffle.
    share = max(settings.fit_rows // 8, 1)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id")
    ranked = known.select("doc_id", "lang").withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= share)
    return ranked.select("doc_id", "lang", "_r")


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(i, lang, ngram_counts(t)) for i, lang, t in zip(batch["doc_id"], batch["lang"], batch["text"], strict=True)]
        rows = [r for r in rows if r[2] is not None]
        yield pd.DataFrame(
            {"doc_id": [r[0] for r in rows], "lang": [r[1] for r in rows], "counts": [r[2].tobytes() for r in rows]}
        )


def _cluster(x: np.ndarray, k: int, rounds: int, least: float, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means over starts drawn by distance. A cluster with less than ``least`` of an even
    share starts again inside the largest one; if it stays small, its members go to the others."""
    k = min(k, len(x))
    few = least * len(x) / k
    start = [int(rng.integers(len(x)))]
    while len(start) < k:
        far = np.maximum(1 - (x @ x[start].T).max(axis=1), 0) + 1e-9
        start.append(int(rng.choice(len(x), p=far / far.sum())))
    centers = x[start]
    for step in range(rounds):
        own = (x @ centers.T).argmax(axis=1)
        sizes = np.bincount(own, minlength=len(centers))
        means = []
        for c, size in enumerate(sizes):
            if size >= few:
                means.append(x[own == c].mean(axis=0))
            elif step < rounds // 2:
                means.append(x[rng.choice(np.flatnonzero(own == sizes.argmax()))])
        centers = _unit(np.stack(means))
    return centers


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Fits the centroids. Runs jobs at once; only the bounded sample's vectors reach the driver."""
    ids = sample(docs, settings).collect()
    langs = sorted({r["lang"] for r in ids})
    if not langs:
        return Model((), np.ones(DIMS), np.zeros((0, DIMS)), np.zeros(0, int), np.zeros(0))
    share = max(settings.fit_rows // len(langs), 1)
    chosen = sorted({r["doc_id"] for r in ids if r["_r"] <= share})
    # The sample's ids are at most fit_rows long, so they are a filter, not a join.
    held = docs.filter(F.col("doc_id").isin(chosen) & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = held.mapInPandas(_features, f"doc_id {kind}, lang string, counts binary").dropDuplicates().collect()
    rows = sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["counts"]))
    counts = np.stack([np.frombuffer(r["counts"], np.float32) for r in rows])
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1
    x = _unit(np.log1p(counts) * idf)
    rng = np.random.default_rng(settings.seed)
    centroids, of, reach = [], [], []
    for k, lang in enumerate(langs):
        own = x[[r["lang"] == lang for r in rows]]
        if not len(own):
            continue
        centers = _cluster(own, settings.clusters, settings.rounds, settings.least_share, rng)
        near = own @ centers.T
        for c in range(len(centers)):
            mine = near[near.argmax(axis=1) == c, c]
            centroids.append(centers[c])
            of.append(k)
            reach.append(max(float(np.median(mine)) - 4 * settings.slack, settings.slack) if len(mine) else settings.slack)
    return Model(tuple(langs), idf, np.stack(centroids), np.array(of), np.array(reach))


RESULTS = {"lang_pred": "string", "score": "double", "rejected": "boolean"}


def _identified(docs: DataFrame, model: Model | None, columns: Sequence[str], settings: Settings) -> PerText:
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, settings))
    return PerText(docs, columns, "text", RESULTS, lambda texts: shared.value.predict(texts))


def identify(
    docs: DataFrame, model: Model | None = None, columns: Sequence[str] = ("doc_id",), settings: Settings = Settings()
) -> DataFrame:
    """``columns`` of ``docs`` with lang_pred, score and rejected; only the text decides."""
    return _identified(docs, model, columns, settings).with_columns()


def keep(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns."""
    return _identified(docs, None, docs.columns, settings).rows_where("rejected", False)
