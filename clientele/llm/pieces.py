"""Piece encoding and decoding with N-best segmentation (operator 5).

The lattice of a text has an edge for every vocabulary piece that matches at a
place.  Forward Viterbi gives the best score up to every place; a backward
A-star search takes these scores as its exact heuristic and so meets complete
segmentations in order of their score.

No piece crosses the start of a word, so a text's lattice is a chain of its
words' lattices.  A word is solved once and kept; the text's N best
segmentations are the N best combinations of its words' segmentations.

The scores of a model of merge ranks are no log probabilities, so its best
segmentation is not what the library encodes with it.  The library's own ids,
those to train on, are therefore given beside the N best, word by word too.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import map_batches

MARK = "▁"  # stands for a blank
#: Base of the polynomial hash of pieces: any odd number of 64 bits; and its mixer.
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93
#: Longer words are solved one by one.
_MANY_LENGTH = 32
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceModel:
    """Pieces and scores of a sentencepiece model file with byte fallback."""

    def __init__(self, path: str, cache_words: int = 300_000):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.vocab_size())
        pieces = [sp.id_to_piece(i) for i in ids]
        self.byte_ids = {int(pieces[i][3:5], 16): i for i in ids if sp.is_byte(i)}
        normal = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if any(MARK in pieces[i].lstrip(MARK) for i in normal):
            raise ValueError(f"{path}: pieces that cross words")
        #: what an id decodes to; control pieces to nothing
        self.spelled = [b""] * len(pieces)
        for b, i in self.byte_ids.items():
            self.spelled[i] = bytes([b])
        for i in normal:
            self.spelled[i] = pieces[i].replace(MARK, " ").encode()
        #: piece -> (score, id); beginnings of longer pieces -> None
        self.trie: dict[str, tuple[float, int] | None] = {}
        for i in normal:
            for n in range(1, len(pieces[i])):
                self.trie.setdefault(pieces[i][:n])
        for i in normal:
            self.trie[pieces[i]] = (sp.get_score(i), i)
        least = min(sp.get_score(i) for i in normal if sp.get_score(i) > -1e8)
        self.fallback = least - 10.0  # a character without a piece, written as its bytes
        self.cache_words = cache_words
        self._forget()
        #: what each id decodes to, end to end
        self.spelled_bytes = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.spelled_length = np.array([len(x) for x in self.spelled])
        self.spelled_start = np.cumsum(self.spelled_length) - self.spelled_length
        # pieces by a 64-bit polynomial hash of their characters, in an open table
        self.longest = max(len(pieces[i]) for i in normal)
        hashes = np.array([self._hash(pieces[i]) for i in normal], np.uint64)
        self.table_bits = 18
        self.table_hash = np.zeros(1 << self.table_bits, np.uint64)
        self.table_row = np.zeros(1 << self.table_bits, np.int32)  # row 0: no piece
        for row, h in enumerate(hashes.tolist(), 1):
            slot = int(self._slot(np.array([h], np.uint64))[0])
            while self.table_row[slot]:
                slot = (slot + 1) % (1 << self.table_bits)
            self.table_hash[slot], self.table_row[slot] = h, row
        self.probes = self._most_probes(hashes)
        self.row_score = np.array([float("-inf")] + [sp.get_score(i) for i in normal])
        self.row_id = np.array([-1, *normal], np.int32)
        self._n_best: dict[tuple[str, int], list[tuple[float, tuple[int, ...]]]] = {}

    def _forget(self) -> None:
        #: word -> row of the arrays: ids from ``start``, ``length`` many; best score; how far the second is behind
        self.rows: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score, self.behind = np.empty(0), np.empty(0)
        #: the same of the library's ids
        self.own_flat = np.empty(0, np.int32)
        self.own_start, self.own_length = np.empty(0, np.int64), np.empty(0, np.int64)

    def _keep(self, words: list[str]) -> None:
        """Forget all words but these, which have been solved."""
        rows = np.array([self.rows[w] for w in words], np.int64)
        self.rows = dict(zip(words, range(len(words)), strict=True))
        self.flat, ends = _gather(self.flat, self.start[rows], self.length[rows])
        self.start, self.length = ends[:-1], self.length[rows]
        self.score, self.behind = self.score[rows], self.behind[rows]
        self.own_flat, ends = _gather(self.own_flat, self.own_start[rows], self.own_length[rows])
        self.own_start, self.own_length = ends[:-1], self.own_length[rows]

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * _BASE + ord(c) + 1) & (2**64 - 1)
        return h

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(_MIX)
        return mixed >> np.uint64(64 - self.table_bits)

    def _most_probes(self, hashes: np.ndarray) -> int:
        slots, left, n = self._slot(hashes), np.ones(len(hashes), bool), 0
        while left.any():
            left &= self.table_hash[slots] != hashes
            slots = (slots + np.uint64(1)) % np.uint64(1 << self.table_bits)
            n += 1
        return n

    def _lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Row of the piece with each hash, 0 where there is none."""
        slots = self._slot(hashes)
        out = np.where(self.table_hash[slots] == hashes, self.table_row[slots], 0)
        open_ = np.flatnonzero((out == 0) & (self.table_row[slots] != 0))  # another piece sits there
        for _ in range(self.probes):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + np.uint64(1)) % np.uint64(1 << self.table_bits)
            at, rows = slots[open_], self.table_row[slots[open_]]
            hit = (rows != 0) & (self.table_hash[at] == hashes[open_])
            out[open_[hit]] = rows[hit]
            open_ = open_[~hit & (rows != 0)]
        return out

    # -- one word ---------------------------------------------------------

    def lattice(self, word: str) -> tuple[list[list[tuple[int, float, int]]], list[float], list[tuple[int, int]]]:
        """Edges by their end as (start, score, id), best score up to each place, and its last edge.

        The id of a character without a piece is -1.
        """
        n = len(word)
        ends: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
        best = [float("-inf")] * (n + 1)
        best[0] = 0.0
        last = [(0, 0)] * (n + 1)
        trie = self.trie
        for i in range(n):
            here, single = best[i], False
            for j in range(i + 1, n + 1):
                found = trie.get(word[i:j], 0)
                if not found:
                    if found == 0:
                        break
                    continue
                single |= j == i + 1
                score = here + found[0]
                ends[j].append((i, found[0], found[1]))
                if score > best[j]:
                    best[j], last[j] = score, (i, found[1])
            if not single:
                ends[i + 1].append((i, self.fallback, -1))
                if here + self.fallback > best[i + 1]:
                    best[i + 1], last[i + 1] = here + self.fallback, (i, -1)
        return ends, best, last

    def _spell(self, word: str, steps: list[tuple[int, int]]) -> tuple[int, ...]:
        """Ids of (start, id) steps, bytes for characters without a piece."""
        out: list[int] = []
        for start, piece in steps:
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.byte_ids[b] for b in word[start].encode()]
        return tuple(out)

    def solve(self, word: str) -> tuple[tuple[int, ...], float, float]:
        """Ids of the best segmentation, its score, and how far the second best is behind.

        Viterbi with the two best scores up to every place.
        """
        n, trie, none = len(word), self.trie, float("-inf")
        best, second = [none] * (n + 1), [none] * (n + 1)
        last = [(0, 0)] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here, here2, single = best[i], second[i], False
            for j in range(i + 1, n + 1):
                found = trie.get(word[i:j], 0)
                if found is None:
                    continue
                if found:
                    piece = found[1]
                    score, score2 = here + found[0], here2 + found[0]
                    if j == i + 1:
                        single = True
                else:
                    break
                if score > best[j]:
                    second[j] = best[j] if best[j] > score2 else score2
                    best[j], last[j] = score, (i, piece)
                elif score > second[j]:
                    second[j] = score
            if not single:
                score, score2, j = here + self.fallback, here2 + self.fallback, i + 1
                if score > best[j]:
                    second[j] = best[j] if best[j] > score2 else score2
                    best[j], last[j] = score, (i, -1)
                elif score > second[j]:
                    second[j] = score
        at, steps = n, []
        while at:
            steps.append(last[at])
            at = last[at][0]
        steps.reverse()
        return self._spell(word, steps), best[n], best[n] - second[n]

    def solve_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``solve`` for words of one length at once: (ids end to end, their numbers, scores, gaps to the second)."""
        n, w = len(words[0]), len(words)
        chars = np.array(words, f"U{n}").view(np.uint32).reshape(w, n).astype(np.uint64) + np.uint64(1)
        best, second = np.full((n + 1, w), -np.inf), np.full((n + 1, w), -np.inf)
        best[0] = 0.0
        last_start, last_id = np.zeros((n + 1, w), np.int16), np.full((n + 1, w), -1, np.int32)
        hashes: list[np.ndarray] = []  # of the characters from i to j, by i
        for j in range(1, n + 1):
            hashes = [h * np.uint64(_BASE) + chars[:, j - 1] for h in hashes] + [chars[:, j - 1].copy()]
            top, low, origin, piece = best[j], second[j], last_start[j], last_id[j]
            for i in range(max(0, j - self.longest), j):
                rows = self._lookup(hashes[i])
                score = self.row_score[rows]
                if i == j - 1:
                    score = np.where(rows == 0, self.fallback, score)
                elif not rows.any():
                    continue
                first, next_ = best[i] + score, second[i] + score
                better = first > top
                low[:] = np.where(better, np.maximum(top, next_), np.maximum(low, first))
                origin[better], piece[better] = i, self.row_id[rows[better]]
                top[better] = first[better]
        at = np.full(w, n, np.int64)
        lanes = np.arange(w)
        out, begin = np.full((w, n), -2, np.int32), np.zeros((w, n), np.int16)
        for k in range(n - 1, -1, -1):
            going = lanes[at[lanes] > 0]
            if not len(going):
                break
            out[going, k] = last_id[at[going], going]
            at[going] = begin[going, k] = last_start[at[going], going]
            lanes = going
        used = out != -2
        counts, flat = used.sum(axis=1), out[used]
        odd = np.flatnonzero((out == -1).any(axis=1))  # words with characters written as bytes
        if len(odd):
            ends, parts, done = np.cumsum(counts).tolist(), [], 0
            for k in odd.tolist():
                steps = zip(begin[k][used[k]].tolist(), out[k][used[k]].tolist(), strict=True)
                parts += [flat[done : ends[k] - counts[k]], np.array(self._spell(words[k], list(steps)), np.int32)]
                done, counts[k] = ends[k], len(parts[-1])
            flat = np.concatenate([*parts, flat[done:]])
        return flat, counts, best[n], best[n] - second[n]

    def learn(self, words: Iterable[str]) -> None:
        """Solve new words and keep them."""
        words = list(words)
        if not words:
            return
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        parts = [(self.flat, self.length, self.score, self.behind)]
        for n, group in by_length.items():
            if n > _MANY_LENGTH:
                for word in group:
                    ids, score, behind = self.solve(word)
                    self.rows[word] = len(self.rows)
                    parts.append((np.array(ids, np.int32), np.array([len(ids)]), np.array([score]), np.array([behind])))
                continue
            for k in range(0, len(group), 8192):
                some = group[k : k + 8192]
                parts.append(self.solve_many(some))
                self.rows.update(zip(some, range(len(self.rows), len(self.rows) + len(some)), strict=True))
        self.flat, self.length, self.score, self.behind = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.start = np.cumsum(self.length) - self.length
        ordered = list(chain.from_iterable(by_length.values()))
        lengths, flats = [self.own_length], [self.own_flat]
        lone = self.trie.get(MARK)  # a last blank: nothing is left to encode
        for k in range(0, len(ordered), 32768):
            some = ordered[k : k + 32768]
            own = self.library.encode([w[1:] for w in some])  # the library puts the first mark in front itself
            own = [x if w != MARK else self._spell(w, [(0, lone[1] if lone else -1)]) for w, x in zip(some, own, strict=True)]
            lengths.append(np.fromiter(map(len, own), np.int64, len(own)))
            flats.append(np.fromiter(chain.from_iterable(own), np.int32, int(lengths[-1].sum())))
        self.own_length, self.own_flat = np.concatenate(lengths), np.concatenate(flats)
        self.own_start = np.cumsum(self.own_length) - self.own_length

    def n_best(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """(score, ids) of the ``n`` best segmentations of one word, by A-star from its end."""
        found = self._n_best.get((word, n))
        if found is not None:
            return found
        ends, best, _ = self.lattice(word)
        found, made = [], 0
        heap: list[tuple] = [(-best[-1], 0, len(word), 0.0, None)]
        while heap and len(found) < n:
            _, _, at, score, steps = heapq.heappop(heap)
            if at == 0:
                path = []
                while steps is not None:
                    path.append(steps[0])
                    steps = steps[1]
                found.append((score, self._spell(word, path)))
                continue
            for i, edge, piece in ends[at]:
                made += 1
                heapq.heappush(heap, (-(best[i] + edge + score), made, i, score + edge, ((i, piece), steps)))
        if len(self._n_best) >= 20_000:
            self._n_best.clear()
        self._n_best[word, n] = found
        return found

    # -- whole texts ------------------------------------------------------

    @staticmethod
    def words(text: str) -> list[str]:
        """The text's words with their blanks as marks in front; the first one gets an extra mark."""
        return _WORDS.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str, n: int = 1) -> tuple[list[int], list[dict]]:
        """Ids of the best segmentation, and the ``n`` best as score, pieces and changed words."""
        ids, _, best, _, _ = self.encode_batch([text], n)
        return ids.tolist(), best[0]

    def encode_batch(
        self, texts: list[str], n: int = 1
    ) -> tuple[np.ndarray, np.ndarray, list[list[dict]], np.ndarray, np.ndarray]:
        """Ids of all texts end to end, where each text's begin (and the end), and each text's ``n`` best;
        the library's ids of all texts, and where each text's begin (and the end).
        """
        self.meet(texts)
        return self.encode_met(texts, n)

    def meet(self, texts: list[str]) -> None:
        """Solve the words of these texts that aren't solved yet; beyond ``cache_words`` only theirs stay."""
        all_words: set[str] = set()
        for text in texts:
            all_words.update(self.words(text))
        new = all_words.difference(self.rows)
        if len(self.rows) + len(new) > self.cache_words:
            self._keep(list(all_words - new))
        self.learn(new)

    def encode_met(
        self, texts: list[str], n: int = 1
    ) -> tuple[np.ndarray, np.ndarray, list[list[dict]], np.ndarray, np.ndarray]:
        """``encode_batch`` of texts, or of some of those, that ``meet`` got last."""
        words = [self.words(t) for t in texts]
        ends = np.cumsum([0, *map(len, words)])
        rows = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(words)), np.int64, int(ends[-1]))
        ids, id_ends = _gather(self.flat, self.start[rows], self.length[rows])
        starts = id_ends[ends]
        best = []
        for k, own in enumerate(words):
            mine = rows[ends[k] : ends[k + 1]]
            total, pieces = float(self.score[mine].sum()), int(starts[k + 1] - starts[k])
            best.append([{"score": total, "n_pieces": pieces, "swaps": []}])
            if n > 1 and own:
                best[k] += self._combine(own, mine, total, pieces, n)
        own_ids, own_ends = _gather(self.own_flat, self.own_start[rows], self.own_length[rows])
        return ids, starts, best, own_ids, own_ends[ends]

    def _combine(self, words: list[str], rows: np.ndarray, total: float, n_ids: int, n: int) -> list[dict]:
        """Segmentations 2 to ``n`` of the text: fewest lost points over combinations of words' own lists.

        Only the n - 1 words with the nearest second segmentations can take part.
        """
        behind, near = self.behind[rows], []
        for _ in range(min(n - 1, len(words))):
            near.append(int(behind.argmin()))
            behind[near[-1]] = np.inf
        lists = {k: self.n_best(words[k], n) for k in sorted(near)}
        loss = {k: [found[0][0] - s for s, _ in found] for k, found in lists.items()}
        order = sorted(k for k in lists if len(loss[k]) > 1)
        heap: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        seen, out = {()}, []
        while heap and len(out) < n:
            lost, chosen = heapq.heappop(heap)
            out.append((lost, chosen))
            picked = dict(chosen)
            for k in order:
                rank = picked.get(k, 0) + 1
                if rank < len(loss[k]):
                    more = tuple(sorted({**picked, k: rank}.items()))
                    if more not in seen:
                        seen.add(more)
                        heapq.heappush(heap, (sum(loss[w][r] for w, r in more), more))
        result = []
        for lost, chosen in out[1:]:
            swaps = [{"word": k, "ids": list(lists[k][r][1])} for k, r in chosen]
            change = sum(len(lists[k][r][1]) - len(lists[k][0][1]) for k, r in chosen)
            result.append({"score": total - lost, "n_pieces": n_ids + change, "swaps": swaps})
        return result

    def decode_batch(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """UTF-8 of each text; marks become blanks and the first one goes."""
        data, ends = _gather(self.spelled_bytes, self.spelled_start[ids], self.spelled_length[ids])
        raw, ends = data.tobytes(), ends[starts].tolist()
        return [raw[a:b].removeprefix(b" ") for a, b in zip(ends, ends[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_batch(np.array(ids, np.int64), np.array([0, len(ids)]))[0].decode("utf-8", "replace")


def _gather(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches pool[start : start + length] end to end, and where each begins (and the end)."""
    ends = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=ends[1:])
    at = np.repeat(start - ends[:-1], length)
    at += np.arange(ends[-1])
    return pool[at], ends


@lru_cache(maxsize=1)
def _model(path: str) -> PieceModel:
    """One model a Python worker: its solved words serve the worker's later tasks too."""
    return PieceModel(path)


#: Texts are put together from their words so many characters at a time, to keep a worker small.
STRETCH = 1 << 19


def _stretches(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of up to ``STRETCH`` characters (one text at least)."""
    some: list[str] = []
    size = 0
    for text in texts:
        if some and size + len(text) > STRETCH:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


SCHEMA = (
    "doc_id long, n_bytes long, n_pieces long, ids array<int>, ids_crc32 long, "
    "best array<struct<score:double,n_pieces:long,swaps:array<struct<word:long,ids:array<int>>>>>, round_trip boolean, "
    "n_library long, library_ids array<int>, library_crc32 long"
)


def encode_pieces(docs: DataFrame, model: str, n: int = 4, with_ids: bool = True) -> DataFrame:
    """One row a document: best ids, and the ``n`` best segmentations.

    ``best`` lists score and pieces of each segmentation in order of score, with
    the words where it differs from the first.  ``round_trip`` says that the
    decoded ids give the text again; it is false only for texts that hold the
    mark U+2581 itself, which decodes to a blank.  ``library_ids`` are the ids
    that the library itself encodes the text to, ``n_library`` many; they differ
    from ``ids`` with models of merge ranks.  A null or empty text has no
    ids and one empty segmentation of score 0.  ``model`` is a path on every
    executor.  ``ids`` and ``library_ids`` are null without ``with_ids``;
    ``ids_crc32`` and ``library_crc32`` are the checksums of the ids as 32-bit
    little-endian integers.  Equal scores keep the
    order in which the search meets them, which the text alone decides.  Rows
    with null or equal doc_id stand for themselves; other columns are ignored.
    """

    def run(columns: list[list]) -> list[list]:
        loaded = _model(model)
        texts = [t or "" for t in columns[1]]
        loaded.meet(texts)
        parts: list[list[list]] = [[columns[0]], *([] for _ in range(9))]
        for some in _stretches(texts):
            ids, starts, best, own_ids, own_starts = loaded.encode_met(some, n)
            raw = [t.encode() for t in some]
            same = [a == b for a, b in zip(loaded.decode_batch(ids, starts), raw, strict=True)]
            row = (
                [len(x) for x in raw], np.diff(starts).tolist(), listed(ids, starts), checksums(ids, starts), best, same,
                np.diff(own_starts).tolist(), listed(own_ids, own_starts), checksums(own_ids, own_starts),
            )
            for part, value in zip(parts[1:], row, strict=True):
                part.append(value)
        return [pa.concat_arrays(x) if isinstance(x[0], pa.Array) else list(chain.from_iterable(x)) for x in parts]

    def listed(ids: np.ndarray, starts: np.ndarray) -> pa.Array | list[None]:
        if not with_ids:
            return [None] * (len(starts) - 1)
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))

    def checksums(ids: np.ndarray, starts: np.ndarray) -> list[int]:
        data, ends = ids.astype("<i4").tobytes(), (starts * 4).tolist()
        return [zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCHEMA)


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """One row a document: doc_id and the text of its ``ids``; null ids give a null text."""

    def run(columns: list[list]) -> list[list]:
        loaded = _model(model)
        return [columns[0], [None if ids is None else loaded.decode(ids) for ids in columns[1]]]

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
