"""Operator 9: token counts by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens where no piece of the vocabulary can reach
across. The distinct pre-tokens of a batch lie one after another in a flat
array of symbols with an array of starts. In each round every sequence merges
its lowest-rank pair (the leftmost of equals), all sequences at once, until
none has a pair left; what survives are its tokens. A symbol outside the
vocabulary counts as its UTF-8 bytes (byte fallback).

Defined cases: NULL and empty text have 0 tokens and 0 bytes; texts of any
length are counted whole; repeated rows give repeated rows; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sheaf.llm.common import tuned

#: Entries of the per-worker table of counted pre-tokens; a full table is emptied.
CACHE_ENTRIES = 500_000
#: Symbols that are merged at once.
BLOCK_SYMBOLS = 1_000_000
SPACE = "▁"  # fixed value: stands for a space in sentencepiece vocabularies
NO_PAIR = np.iinfo(np.int32).max


class PieceCounter:
    """Counts the tokens of a sentencepiece BPE vocabulary with byte fallback."""

    def __init__(self, pieces: list[tuple[str, float]]):
        """``pieces``: the ordinary pieces with their scores (the highest merges first)."""
        ids = {p: i for i, (p, _) in enumerate(pieces)}
        self.single = {p: i for p, i in ids.items() if len(p) == 1}
        order = {s: r for r, s in enumerate(sorted({s for _, s in pieces}, reverse=True))}
        for text in list(ids):  # a character that stands in no piece by itself can still be merged
            for c in text:
                self.single.setdefault(c, len(pieces) + len(self.single))
        self.bytes_of_single = np.ones(len(pieces) + len(self.single) + 1, np.int32)
        for c, i in self.single.items():
            if c not in ids:
                self.bytes_of_single[i] = len(c.encode())
        known = ids | {c: i for c, i in self.single.items() if c not in ids}
        self.width = len(self.bytes_of_single)
        keys, products, ranks = [], [], []
        for text, score in pieces:
            for cut in range(1, len(text)):
                left, right = known.get(text[:cut]), known.get(text[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.width + right)
                    products.append(ids[text])
                    ranks.append(order[score])
        by = np.argsort(np.asarray(keys, np.int64), kind="stable")
        self.keys = np.append(np.asarray(keys, np.int64)[by], np.iinfo(np.int64).max)
        self.products = np.append(np.asarray(products, np.int32)[by], 0)
        self.ranks = np.append(np.asarray(ranks, np.int32)[by], NO_PAIR)
        # A cut between two characters is safe if no piece has them side by side.
        self.bigrams = {t[i: i + 2] for t, _ in pieces for i in range(len(t) - 1)}
        inner = {c for t, _ in pieces if len(t) > 1 for c in t}
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in inner)
        self.safe = all(SPACE not in t.lstrip(SPACE) for t, _ in pieces)
        rest = f"[^{SPACE}{alone}]+"
        self.pattern = f"[{alone}]|{SPACE}*{rest}|{SPACE}+" if alone else f"{SPACE}*{rest}|{SPACE}+"
        self._reset()

    @classmethod
    def load(cls, path: str) -> PieceCounter:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        return cls([(model.id_to_piece(i), model.get_score(i)) for i in every
                    if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))])

    def _reset(self) -> None:
        self.cut = re.compile(self.pattern)
        self.known: dict[str, int] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("cut", "known")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._reset()

    def pre_tokens(self, text: str | None) -> list[str]:
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        return self.cut.findall(text) if self.safe else [text]

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_PAIR), self.products[at]

    def merge(self, sequences: list[str]) -> np.ndarray:
        """Tokens of each sequence."""
        out = np.zeros(len(sequences), np.int64)
        own = np.arange(len(sequences))
        sizes = np.array([len(s) for s in sequences], np.int64)
        chars = "".join(sequences)
        symbol = np.array([self.single.get(c, self.width - 1) for c in chars], np.int32)
        # Symbols that no piece holds count as their bytes; 1 for all others.
        weight = self.bytes_of_single[symbol].astype(np.int64)
        strange = np.flatnonzero(symbol == self.width - 1)
        weight[strange] = [len(chars[i].encode("utf-8", "replace")) for i in strange]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        keep = sizes > 0
        own, sizes, starts = own[keep], sizes[keep], starts[keep]
        if not len(symbol):
            return out
        rank = np.full(len(symbol), NO_PAIR, np.int32)
        product = np.zeros(len(symbol), np.int32)
        rank[:-1], product[:-1] = self._pair(symbol[:-1], symbol[1:])
        rank[starts + sizes - 1] = NO_PAIR
        while len(own):
            least = np.minimum.reduceat(rank, starts)
            over = least == NO_PAIR
            if over.any():
                totals = np.add.reduceat(weight, starts)
                out[own[over]] = totals[over]
                stay = np.repeat(~over, sizes)
                symbol, weight, rank, product = symbol[stay], weight[stay], rank[stay], product[stay]
                own, sizes, least = own[~over], sizes[~over], least[~over]
                if not len(own):
                    break
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            of = np.searchsorted(starts, hits, "right") - 1
            first = np.ones(len(hits), bool)
            first[1:] = of[1:] != of[:-1]
            at = hits[first]  # one place in each sequence
            symbol[at] = product[at]
            weight[at] = 1
            rank[at] = rank[at + 1]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            last = at + 1 == starts + sizes - 1
            symbol, weight, rank, product = symbol[stay], weight[stay], rank[stay], product[stay]
            sizes = sizes - 1
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            at = at - np.arange(len(at))
            right = at[~last]
            rank[at[last]] = NO_PAIR
            rank[right], product[right] = self._pair(symbol[right], symbol[right + 1])
            left = at[at > starts] - 1
            rank[left], product[left] = self._pair(symbol[left], symbol[left + 1])
        return out

    def _pieces(self, pre_token: str) -> list[str]:
        """A pre-token cut wherever no piece reaches across."""
        out, start = [], 0
        for i in range(1, len(pre_token)):
            if pre_token[i - 1: i + 1] not in self.bigrams:
                out.append(pre_token[start:i])
                start = i
        return [*out, pre_token[start:]]

    def _learn(self, new: list[str], into: dict[str, int]) -> None:
        block: list[str] = []
        owner: list[str] = []
        held = 0

        def flush():
            for name, n in zip(owner, self.merge(block).tolist(), strict=True):
                into[name] = into.get(name, 0) + n

        for pre_token in new:
            for part in self._pieces(pre_token) if len(pre_token) > 24 else [pre_token]:
                block.append(part)
                owner.append(pre_token)
                held += len(part)
                if held > BLOCK_SYMBOLS:
                    flush()
                    block, owner, held = [], [], 0
        flush()

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        cut = [self.pre_tokens(t) for t in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        known = self.known
        new = {p for own in cut for p in own if p not in known}
        counts: dict[str, int] = {}
        self._learn(list(new), counts)
        known.update((p, n) for p, n in counts.items() if len(p) <= 64)
        return [sum([known[p] if p in known else counts[p] for p in own]) for own in cut]


def token_counts(docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each document; one pass, no shuffle.

    The merge table (a few MB, fixed by the vocabulary) is broadcast.
    """
    counter = tuned(docs.sparkSession).sparkContext.broadcast(PieceCounter.load(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(1).to_pylist()
                n = own.count(texts)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(t.encode("utf-8", "replace")) if t else 0 for t in texts], pa.int64()),
                    pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(docs[key].cast("long").alias("doc_id"), docs["text"])
            .mapInArrow(work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
