"""Byte-level BPE vocabularies: cutting text into pieces, and counting tokens.

Token count by heap and linked list: the symbols of a piece form a linked
list, all mergeable neighbours sit in a heap by merge rank, the lowest rank is
popped and merged, and the two new neighbours are pushed.  The count is the
number of first symbols less the number of merges; no ids are made up for the
text.  Counts of pieces are kept in a two-generation cache of bounded size.

Defined results: null text counts as empty (0 tokens); the strings of special
tokens inside a text count as one token each, as the library does by default.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the published split pattern of this byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Code points whose classes are the same in every Unicode version in use; a
#: text with any other one is cut by the library's own splitter.
SETTLED = "\x00-ɏΑ-ΡΣ-ωЀ-ӿ‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣"
CACHE_PIECES = 400_000
# The same pattern in explicit letters and digits, for texts of Latin letters and
# common punctuation only, where the standard library's matcher is twice as fast.
_LETTER, _DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
LATIN = "\x00-\x1b\x20-ɏ‐-‧‰-⁞"
LATIN_SPLIT = (rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^\s{_LETTER}{_DIGIT}]+"
               r"|\s+(?!\S)|\s+")


class Recent(dict):
    """Bounded memory of a pure function: a young and an old generation."""

    def __init__(self, make, limit: int = CACHE_PIECES):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Splitter:
    """Pieces of a text as the tokenizers library cuts it: special strings, then the pattern."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        added = self.spec["added_tokens"]
        pre = self.spec["pre_tokenizer"]
        if (self.spec["normalizer"] is not None or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added)):
            raise ValueError("only byte-level BPE without normaliser is supported")
        self.special = {a["content"]: a["id"] for a in added}
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if added else None
        self._split = regex.compile(SPLIT)
        self._odd, self._not_latin = re.compile(f"[^{SETTLED}]"), re.compile(f"[^{LATIN}]")
        self._latin_split = re.compile(LATIN_SPLIT)

    def plain(self, text: str) -> Iterator[str]:
        if not self._not_latin.search(text):
            split = self._latin_split
        elif not self._odd.search(text):
            split = self._split
        else:
            return (text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text))
        return (m.group() for m in split.finditer(text)) if len(text) > 1 << 22 else iter(split.findall(text))

    def segments(self, text: str) -> list[str]:
        """The text cut at special strings; those are at the odd places."""
        if self._special is None or not any(s in text for s in self.special):
            return [text]
        return self._special.split(text)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary (fixed by its published format)."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class HeapCounter:
    """Number of tokens of a piece by heap-driven merging of a linked list."""

    def __init__(self, spec: dict):
        vocab, merges, letter = spec["model"]["vocab"], spec["model"]["merges"], byte_letters()
        self.symbol = [vocab[letter[b]] for b in range(256)]
        self.rank = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))

    def __call__(self, piece: str) -> int:
        symbol = [self.symbol[b] for b in piece.encode()]
        n, rank = len(symbol), self.rank.get
        heap = [(m[0], k, m[1]) for k in range(n - 1) if (m := rank((symbol[k], symbol[k + 1])))]
        heapq.heapify(heap)
        after, before, merged = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            r, at, made = heapq.heappop(heap)
            right = after[at]
            # an entry is stale if its left symbol is gone or either side has changed
            if symbol[at] < 0 or right >= n or rank((symbol[at], symbol[right])) != (r, made):
                continue
            symbol[at], symbol[right] = made, -1
            merged += 1
            after[at] = beyond = after[right]
            if beyond < n:
                before[beyond] = at
                if m := rank((made, symbol[beyond])):
                    heapq.heappush(heap, (m[0], at, m[1]))
            left = before[at]
            if left >= 0 and (m := rank((symbol[left], made))):
                heapq.heappush(heap, (m[0], left, m[1]))
        return n - merged


_loaded: dict = {}


def counter(path: str):
    """text -> number of tokens; the vocabulary is loaded once in each worker."""
    if ("count", path) not in _loaded:
        split = Splitter(path)
        cache = Recent(HeapCounter(split.spec))

        def count(text: str) -> int:
            total = 0
            for k, part in enumerate(split.segments(text)):
                total += 1 if k % 2 else sum(map(cache.__getitem__, split.plain(part)))
            return total

        _loaded["count", path] = count
    return _loaded["count", path]


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text; a map without shuffle."""
    def run(batches):
        count = counter(path)
        for b in batches:
            n = [count(t) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
