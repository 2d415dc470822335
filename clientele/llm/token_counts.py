"""Token counts by heap-and-linked-list pair merging (operator 6).

A word's symbols form a linked list; a heap holds its adjacent pairs by merge
rank.  The lowest-ranked pair is merged until none is left.  A word's count is
its initial symbols minus its merges; no token identifiers are made.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import map_batches

#: White space as the vocabulary file's pattern engine knows it.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"


class PairMerger:
    """Counts tokens as the vocabulary file prescribes.

    Reads a ``tokenizers`` file whose model is byte-level BPE with word-end
    symbols, lower-casing and white space dropped.  Counts of single words are
    kept in a table of at most ``cache_words`` words.
    """

    def __init__(self, path: str, cache_words: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError(f"{path}: not a byte-level BPE with word ends")
        end = model["end_of_word_suffix"]
        byte_char = _byte_chars()
        self.symbol = [vocab[c] for c in byte_char]
        self.last_symbol = [vocab[c + end] for c in byte_char]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merge.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        pattern = splits[0]["pattern"]["Regex"].replace(r"[^\s", f"[^{_SPACE}")
        self.words = regex.compile(pattern)
        specials = [t["content"] for t in spec["added_tokens"]]
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.cache: dict[str, int] = {}
        self.cache_words = cache_words

    def count_word(self, word: str) -> int:
        """Initial symbols minus merges."""
        data = word.encode()
        n = len(data)
        symbols = [self.symbol[b] for b in data]
        symbols[-1] = self.last_symbol[data[-1]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merge = self.merge
        heap = []
        for i in range(n - 1):
            found = merge.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # a neighbour was merged since
            symbols[i], symbols[j] = new, -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merge.get((new, symbols[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, new, symbols[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merge.get((symbols[h], new))
                if found:
                    heapq.heappush(heap, (found[0], h, symbols[h], new, found[1]))
        return n - merges

    def count(self, text: str) -> int:
        total = 0
        parts = self.specials.split(text) if self.specials and self.specials.search(text) else (text,)
        total += len(parts) - 1  # a special string is one token
        cache = self.cache
        for part in parts:
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for word in self.words.findall(part):
                n = cache.get(word)
                if n is None:
                    n = self.count_word(word)
                    if len(cache) >= self.cache_words:
                        cache.clear()
                    cache[word] = n
                total += n
        return total


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself, or the next beyond 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, beyond = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(beyond))
        beyond += b not in plain
    return out


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """One row a document: UTF-8 bytes, tokens, and whether they exceed ``limit``.

    ``vocabulary`` is the path of a ``tokenizers`` file on every executor.  A
    null or empty text has 0 bytes and 0 tokens.  Rows with null or equal
    doc_id are counted each on its own; other columns are ignored.
    """
    merger: list[PairMerger] = []

    def count(columns: list[list]) -> list[list]:
        if not merger:
            merger.append(PairMerger(vocabulary))
        texts = [t or "" for t in columns[1]]
        tokens = [merger[0].count(t) for t in texts]
        return [columns[0], [len(t.encode()) for t in texts], tokens, [n > limit for n in tokens]]

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), count, SCHEMA)
