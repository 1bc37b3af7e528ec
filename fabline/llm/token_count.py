"""Token counts of whole texts under a sentencepiece BPE model, by rank-synchronous array merging.

Each batch's new pre-tokens are held as one ragged numpy array of symbols. In every round each sequence
applies its own lowest-rank pair, all sequences at once, and finished sequences leave the array; the
surviving symbols are the tokens. Pre-tokens seen before in the worker come from a bounded cache.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few_rows

SPACE = "▁"
MARKED = (SPACE, "\n")
NO_PAIR = np.iinfo(np.int64).max


class RankMerger:
    """Counts the BPE tokens of pre-tokens with the pieces and scores of a sentencepiece model."""

    def __init__(self, model_file: str, cache_words: int = 600_000):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
        score = {m.id_to_piece(i): m.get_score(i) for i in ids}
        rank_of = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        # Symbols: every piece, then characters that occur only inside pieces.
        symbols = list(score) + sorted({c for p in score for c in p} - score.keys())
        self.symbol = {p: i for i, p in enumerate(symbols)}
        self.width = len(symbols) + 1  # the last symbol stands for any other character
        pairs = {}
        for p, s in score.items():
            for at in range(1, len(p)):
                a, b = self.symbol.get(p[:at]), self.symbol.get(p[at:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = (rank_of[s], self.symbol[p])
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        # Symbol and further UTF-8 bytes of each character, by code point.
        self.of_code = np.full(0x110000, self.width - 1, dtype=np.int64)
        code = np.arange(0x110000)
        self.extra = (code > 0x7F).astype(np.float32) + (code > 0x7FF) + (code > 0xFFFF)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.of_code[ord(c)] = i
                if c in score:
                    self.extra[ord(c)] = 0
        inside = {c for p in score for c in p if len(p) > 1}
        if "\n" in inside or any(SPACE in p.lstrip(SPACE) for p in score):
            raise ValueError("the model joins words or lines; pre-tokens can't be counted apart")
        self.cache: dict[str, int] = {}
        self.cache_words = cache_words

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_PAIR), self.merged[at]

    def count_words(self, words: list[str], block: int = 1 << 18) -> np.ndarray:
        """Tokens of each pre-token (space marks already in place)."""
        out = np.zeros(len(words), dtype=np.int64)
        start = 0
        while start < len(words):  # blocks of bounded total length
            end, size = start, 0
            while end < len(words) and (size < block or end == start):
                size += len(words[end])
                end += 1
            out[start:end] = self._merge(words[start:end])
            start = end
        return out

    def _merge(self, words: list[str]) -> np.ndarray:
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        seq = np.repeat(np.arange(len(words)), lens)
        # Characters outside the vocabulary end as their UTF-8 bytes.
        total = np.bincount(seq, weights=self.extra[code], minlength=len(words)).astype(np.int64)
        sym = self.of_code[code]
        rank, into = np.full(len(sym), NO_PAIR, dtype=np.int64), np.zeros(len(sym), dtype=np.int64)
        look = np.flatnonzero(seq[:-1] == seq[1:])
        while len(sym):
            rank[look], into[look] = self._lookup(sym[look], sym[look + 1])
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(sym)])
            done = low == NO_PAIR
            total[seq[first[done]]] += size[done]
            if done.all():
                break
            best = np.flatnonzero((rank == np.repeat(low, size)) & (rank != NO_PAIR))
            head = best[np.r_[True, seq[best][1:] != seq[best][:-1]]]  # leftmost of each sequence
            if len(head) < 8 and len(sym) > 4096:  # few, very long sequences: finish them one by one
                for i in np.flatnonzero(~done):
                    total[seq[first[i]]] += self._long(sym[first[i]:first[i] + size[i]].tolist())
                break
            sym[head] = into[head]
            stay = ~np.repeat(done, size)
            stay[head + 1] = False
            at = (np.cumsum(stay) - 1)[head]
            sym, seq, rank, into = sym[stay], seq[stay], rank[stay], into[stay]
            # Only the pairs beside a merged symbol are new.
            rank[at] = NO_PAIR
            look = np.concatenate([at, at[at > 0] - 1])
            look = look[look + 1 < len(sym)]
            look = look[seq[look] == seq[look + 1]]
        return total

    def _long(self, sym: list[int]) -> int:
        """The same merges for one long sequence, lowest rank first from a heap over linked symbols."""
        import heapq

        if not hasattr(self, "table"):
            self.table = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < n and (hit := self.table.get(sym[i] * self.width + sym[j])):
                heapq.heappush(heap, (hit[0], i, sym[i], sym[j], hit[1]))

        for i in range(n - 1):
            push(i)
        left = n
        while heap:
            _, i, a, b, into = heapq.heappop(heap)
            j = nxt[i] if sym[i] == a else n
            if j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = into, -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            left -= 1
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return left

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts, with the model's one leading space mark and nothing else added.

        A pre-token is kept without its one space mark; those that begin with a line break have none, and
        those after several blanks keep their marks.
        """
        split, cache = [], self.cache
        for t in texts:
            parts = t.replace("\n", " \n").split(" ") if t and SPACE not in t else [""]
            if "" in parts:
                parts = re.findall(rf"\n[^{SPACE}\n]*|{SPACE}+[^{SPACE}\n]*", SPACE + t.replace(" ", SPACE)) if t else []
            elif parts[0][0] == "\n":
                parts.insert(0, SPACE)
            split.append(parts)
        new = [w for w in set().union(*split) if w not in cache]
        if new:
            if len(cache) + len(new) > self.cache_words:
                cache.clear()
                new = list(set().union(*split))
            cache.update(zip(new, self.count_words([w if w[0] in MARKED else SPACE + w for w in new]).tolist()))
        return [sum(map(cache.__getitem__, ws)) for ws in split]


_MERGERS: dict[str, RankMerger] = {}


def _merger(model_file: str) -> RankMerger:
    if model_file not in _MERGERS:
        _MERGERS[model_file] = RankMerger(model_file)
    return _MERGERS[model_file]


def slices(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Cut 0..len(sizes) into runs whose sizes sum to about ``limit`` (one longer item stays whole)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens. Null ids and repeated rows are kept as they are; other
    columns are not read. ``model_file`` must exist on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        merger = _merger(model_file)
        for batch in few_rows(batches, 2000):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = [len(t.encode()) for t in texts]
            counts = []
            for a, b in slices(sizes, 1 << 22):
                counts += merger.count_texts(texts[a:b])
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), n], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return rows.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
