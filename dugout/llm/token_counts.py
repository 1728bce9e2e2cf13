"""Token counts by a finite-state transducer compiled from a byte-level BPE vocabulary.

A pair of tokens is stable if merging its bytes gives the same two tokens again, and a
tokenization is what the library gives exactly if all its neighbours are stable. So the tokens of
every prefix of a word follow from those of shorter prefixes: the last token is the one that is
stable after the prefix it leaves. Only prefixes that a longer token may still reach back to matter;
they, with their last tokens and their counts against the current one, are a state, and a byte
moves from state to state and emits a change of the token count. States and transitions are compiled on
first use and kept, so the machine is deterministic and grows with what texts contain.

Words are what the vocabulary's split pattern cuts. A text is read in chunks, and each chunk
becomes a state map: the unread head before its first sure cut, the count between the sure cuts,
and the tail after the last. Maps compose associatively (tail and next head are counted
together), so a scan over the chunks, in pairs, gives the count of the text in
bounded memory per step.

Defined results: a NULL text counts as empty with 0 bytes and 0 tokens; special strings inside
texts are single tokens, as in the library's default; repeated rows get equal counts; an empty
table gives no rows; other columns are kept on request.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from dugout.llm.common import PerText

# Fixed value: the split pattern of byte-level BPE vocabularies of this family.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK = 1 << 15
KEPT_WORDS = 200_000
KEPT_MOVES = 2_000_000


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in such a vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """The vocabulary as bytes, and the merge procedure that defines it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        named = byte_names()

        def plain(token: str) -> bytes:
            return bytes(named[c] for c in token)

        self.special = [t["content"] for t in spec["added_tokens"]]
        model = spec["model"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(plain(a), plain(b)): k for k, (a, b) in enumerate(pairs)}
        self.tokens = {plain(t) for t in model["vocab"] if t not in self.special}

    def apply(self, word: bytes) -> list[bytes]:
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(zip(parts, parts[1:], strict=False), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            merged, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    merged.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts


class Transducer:
    """States are tuples of (bytes since a prefix, that prefix's last token, its count against
    now), nearest first; the prefix itself is the entry with no bytes. State 0 is the start."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.tokens = {t for t in merges.tokens if len(t) == 1 or merges.apply(t) == [t]}
        # Beginnings of tokens: a prefix farther back than any of them cannot matter.
        self.beginnings = {t[:k] for t in self.tokens for k in range(1, len(t))}
        self.stable: dict[tuple[bytes, bytes], bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = ((b"", b"", 0),)
        self.states, self.ids = [start], {start: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def _is_stable(self, left: bytes, right: bytes) -> bool:
        if not left:
            return True
        known = self.stable.get((left, right))
        if known is None:
            known = self.stable[left, right] = self.merges.apply(left + right) == [left, right]
        return known

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        at, reached = bytes([byte]), []
        last = None
        for since, token, count in self.states[state]:
            longer = since + at
            if longer in self.tokens and self._is_stable(token, longer):
                # Exactly one prefix fits; see the module docstring.
                last = (longer, count + 1)
            if longer in self.beginnings:
                reached.append((longer, token, count))
        if last is None:
            raise ValueError(f"byte {byte} has no token")
        token, emitted = last
        new = ((b"", token, 0), *((s, t, c - emitted) for s, t, c in reached))
        to = self.ids.setdefault(new, len(self.states))
        if to == len(self.states):
            self.states.append(new)
        self.moves[state << 8 | byte] = (to, emitted)
        return to, emitted

    def count(self, word: bytes) -> int:
        """Tokens of a word: the sum of what its transitions emit."""
        if len(self.moves) > KEPT_MOVES:
            self._reset()
        state, total, moves = 0, 0, self.moves
        for byte in word:
            to = moves.get(state << 8 | byte)
            if to is None:
                to = self._move(state, byte)
            state = to[0]
            total += to[1]
        return total


class _Words(dict):
    """Counts of words seen, computed when missing, forgotten when too many."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        n = self[word] = self.transducer.count(word.encode())
        return n


@dataclass(frozen=True)
class StateMap:
    """Of a run of text: text before the first sure cut, tokens between, text after the last.

    ``tail`` is None while no sure cut was seen; ``head`` then is the whole run.
    """

    head: str
    tokens: int
    tail: str | None


class Counter:
    """Counts the tokens of texts as the library does for the vocabulary file."""

    def __init__(self, path: str):
        merges = Merges(path)
        self.words = _Words(Transducer(merges))
        self.split = regex.compile(SPLIT)
        self.specials = regex.compile("|".join(map(regex.escape, merges.special))) if merges.special else None
        # Between a character that is not white space and a space or line end, the pattern always cuts.
        self.sure = regex.compile(r"(?<=\S)(?= )")

    def plain(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.split.findall(text)))

    def chunk(self, text: str) -> StateMap:
        first = self.sure.search(text)
        if first is None:
            return StateMap(text, 0, None)
        at = first.start()
        end = len(text)
        while True:
            # The last sure cut, looked for from the end.
            end = text.rfind(" ", at + 1, end)
            if end < 0:
                return StateMap(text[:at], 0, text[at:])
            if not text[end - 1].isspace():
                return StateMap(text[:at], self.plain(text[at:end]), text[end:])

    def join(self, a: StateMap, b: StateMap) -> StateMap:
        if a.tail is None:
            # No sure cut in a: at its border there may be one, which b's head then starts with.
            return self._lift(a.head, b)
        if b.tail is None:
            return StateMap(a.head, a.tokens, a.tail + b.head)
        return StateMap(a.head, a.tokens + self.plain(a.tail + b.head) + b.tokens, b.tail)

    def _lift(self, before: str, b: StateMap) -> StateMap:
        return StateMap(before + b.head, b.tokens, b.tail)

    def segment(self, text: str) -> int:
        """Tokens of a text without special strings: a scan over the maps of its chunks."""
        if len(text) <= CHUNK:
            return self.plain(text)
        maps = [self.chunk(text[at : at + CHUNK]) for at in range(0, len(text), CHUNK)]
        while len(maps) > 1:
            maps = [self.join(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        whole = maps[0]
        return self.plain(whole.head) + whole.tokens + self.plain(whole.tail or "")

    def count(self, text: str) -> int:
        if not self.specials or not (found := self.specials.findall(text)):
            return self.segment(text)
        return len(found) + sum(map(self.segment, self.specials.split(text)))


@lru_cache(2)
def counter(path: str) -> Counter:
    """One compiled machine per worker process and vocabulary file."""
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` with n_bytes, n_tokens and over_limit of each whole text.

    ``vocabulary`` is the path of the vocabulary file on the executors, part of their
    Python installation.
    """

    def measure(texts: list[str | None]) -> list[tuple]:
        machine = counter(vocabulary)
        counts = [machine.count(t or "") for t in texts]
        return [(len((t or "").encode()), n, n > limit) for t, n in zip(texts, counts, strict=True)]

    results = {"n_bytes": "long", "n_tokens": "long", "over_limit": "boolean"}
    return PerText(docs, columns, "text", results, measure).with_columns()
