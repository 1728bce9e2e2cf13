"""Quality rules: word and line counts, and divergence from the documents of each language.

The histograms of a document (character classes; the common words and the rest) are compared with
those of every language by Jensen-Shannon distance. A document whose nearest language is
still farther than the limits is rejected. References are exact counts over all documents,
grouped by ``lang`` (NULL is a group of its own): nothing is sampled.

Short texts give rough histograms, so there are two guards: below ``min_words`` or ``min_chars`` the
verdict is not asked, and above them the limit on the squared distance is widened by what
chance alone gives a sample of that length.

Defined results: a NULL text counts as empty; texts under 10 words fail the base rules; repeated rows
are each judged; with an empty table the result is empty; other columns are kept by ``keep``.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import ROWS, PerText

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
CLASSES = ("lower", "upper", "letter", "digit", "space", "stop", "mark", "symbol")
WINDOW = 5
# Odd multipliers that spread a window's word hashes over 64 bits.
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict; distances run from 0 to 1."""

    common_words: int = 64
    min_words: int = 50
    min_chars: int = 250
    max_class_distance: float = 0.255
    max_word_distance: float = 0.36


@lru_cache(1)
def _class_table() -> np.ndarray:
    """Character class of every code point of the first plane; the last entry is for the rest."""
    table = np.full(65537, CLASSES.index("symbol"), np.uint8)
    for code in range(65536):
        c, kind = chr(code), unicodedata.category(chr(code))
        if kind == "Ll":
            name = "lower"
        elif kind in ("Lu", "Lt"):
            name = "upper"
        elif kind[0] in "LM":
            name = "letter"
        elif kind[0] == "N":
            name = "digit"
        elif kind[0] == "Z" or c in BLANKS:
            name = "space"
        elif c in ".,":
            name = "stop"
        elif kind[0] == "P" and c not in SYMBOLS:
            name = "mark"
        else:
            continue
        table[code] = CLASSES.index(name)
    table[65536] = CLASSES.index("letter")
    return table


def class_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_class_table()[np.minimum(codes, 65536)], minlength=len(CLASSES))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found at least twice.

    Windows equal in a 64-bit hash are few; only those are compared word by word.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = sum(hashes[k : k + n] * _SPREAD[k] for k in range(WINDOW))
    order = np.argsort(windows, kind="stable")
    equal = windows[order][1:] == windows[order][:-1]
    if not equal.any():
        return 0
    likely = np.zeros(n, bool)
    likely[order[1:][equal]] = likely[order[:-1][equal]] = True
    starts = np.flatnonzero(likely)
    texts = [tuple(words[i : i + WINDOW]) for i in starts]
    found = Counter(texts)
    marks = np.zeros(len(words) + 1, np.int64)
    for i, t in zip(starts, texts, strict=True):
        if found[t] > 1:
            marks[i] += 1
            marks[i + WINDOW if i + WINDOW < len(words) else len(words)] -= 1
    return int((np.cumsum(marks[:-1]) > 0).sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


# Different words that a task holds before it hands their counts on.
HELD = 100_000


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of runs of texts: a run ends at ``HELD`` words, and few texts at a time are held as Python text."""
    words: dict[str | None, Counter] = {}
    classes: dict[str | None, np.ndarray] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                text = text or ""
                words.setdefault(lang, Counter()).update(text.lower().encode().split())
                classes[lang] = classes.get(lang, 0) + class_counts(text)
            if sum(map(len, words.values())) >= HELD:
                yield from _handed_on(words, classes)
    yield from _handed_on(words, classes)


def _handed_on(words: dict[str | None, Counter], classes: dict[str | None, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The counts of each language; leaves both empty."""
    while words:
        lang, found = words.popitem()
        items = [*CLASSES, *(w.decode() for w in found), ""]
        kinds = ["class"] * len(CLASSES) + ["word"] * (len(found) + 1)
        numbers = [*classes.pop(lang).tolist(), *found.values(), sum(found.values())]
        columns = [pa.array([lang] * len(items), pa.string()), pa.array(kinds), pa.array(items), pa.array(numbers, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "kind", "item", "n"])


def references(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per language: kind (class, word), item, n. The word '' holds the number of all words.

    Runs of texts are counted in Python, in one pass; the counts are summed by Spark. Only the common words of
    each language leave: a bounded table.
    """
    counts = (
        docs.select("lang", "text")
        .mapInArrow(_count, "lang string, kind string, item string, n long")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n"))
    )
    best = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    # '' is always the first, as it counts all words. All classes stay.
    first = counts.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= max(rules.common_words + 1, len(CLASSES)))
    return first.filter((F.col("kind") == "class") | (F.col("_r") <= rules.common_words + 1)).drop("_r")


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of one distribution from each row of ``q``."""
    m = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0.0).sum(axis=-1)

    return np.sqrt(np.maximum((part(np.broadcast_to(p, q.shape)) + part(q)) / 2, 0))


def by_chance(kinds: int, n: int) -> float:
    """Squared distance that a sample of ``n`` has from its own source on average."""
    return (kinds - 1) / (8 * np.log(2) * max(n, 1))


class Judge:
    """Holds the references as arrays and measures documents."""

    def __init__(self, rows: list[tuple[str | None, str, str, int]], rules: Rules):
        self.rules = rules
        langs = sorted({r[0] for r in rows}, key=lambda x: (x is None, x or ""))
        self.classes = np.zeros((len(langs), len(CLASSES)))
        self.words: list[dict[bytes, int]] = [{} for _ in langs]
        self.shares: list[np.ndarray] = []
        counts: list[dict[str, int]] = [{} for _ in langs]
        for lang, kind, item, n in rows:
            k = langs.index(lang)
            if kind == "class":
                self.classes[k, CLASSES.index(item)] = n
            else:
                counts[k][item] = n
        self.classes /= np.maximum(self.classes.sum(axis=1, keepdims=True), 1)
        for k, found in enumerate(counts):
            total = found.pop("", 0)
            named = sorted(found)
            self.words[k] = {w.encode(): i for i, w in enumerate(named)}
            shares = np.array([found[w] for w in named] + [total - sum(found.values())], float)
            self.shares.append(shares / max(total, 1))

    def distances(self, text: str) -> tuple[float, float, int]:
        """Of the nearest language by both: class distance, word distance, number of words."""
        words = text.lower().encode().split()
        counts = class_counts(text)
        by_class = distance(counts / max(counts.sum(), 1), self.classes)
        found = Counter(words)
        best = (np.inf, 1.0, 1.0)
        for k, index in enumerate(self.words):
            own = np.zeros(len(index) + 1)
            for w, i in index.items():
                own[i] = found.get(w, 0)
            own[-1] = len(words) - own.sum()
            by_word = float(distance(own / max(len(words), 1), self.shares[k][None])[0])
            best = min(best, (float(by_class[k]) + by_word, float(by_class[k]), by_word))
        return best[1], best[2], len(words)

    def accepts(self, class_distance: float, word_distance: float, n_words: int, n_chars: int) -> bool:
        r = self.rules
        if n_words < r.min_words or n_chars < r.min_chars:
            return True
        return (
            class_distance**2 <= r.max_class_distance**2 + by_chance(len(CLASSES), n_chars)
            and word_distance**2 <= r.max_word_distance**2 + by_chance(r.common_words + 1, n_words)
        )


RESULTS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "base_failed": "boolean",
    "class_distance": "double",
    "word_distance": "double",
    "kept": "boolean",
}


def _judged(docs: DataFrame, rules: Rules, columns: Sequence[str]) -> PerText:
    rows = [(r["lang"], r["kind"], r["item"], r["n"]) for r in references(docs, rules).collect()]
    judged = Judge(rows, rules)

    def measure(texts: list[str | None]) -> list[tuple]:
        out = []
        for text in texts:
            text = text or ""
            base = base_counts(text, text.encode().split())
            failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
            near = judged.distances(text)
            out.append((*base, failed, near[0], near[1], not failed and judged.accepts(*near, len(text))))
        return out

    return PerText(docs, columns, "text", RESULTS, measure)


def judge(docs: DataFrame, rules: Rules = Rules(), columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` and the counts, distances and verdict of each row.

    Runs one job at once, for the references; only that bounded table reaches the driver.
    """
    return _judged(docs, rules, columns).with_columns()


def keep(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    return _judged(docs, rules, docs.columns).rows_where("kept", True)
