"""Operator 1: BPE encoding and decoding with a tokenization automaton.

The merges are compiled, in rank order, into a deterministic automaton whose
arcs are labelled with tokens. It starts as one state with an arc for each
byte. The gadget of merge ``(u, v) -> w`` of rank ``r`` does three things:

- the state behind ``w`` becomes a copy of the state behind ``v`` as it stands
  at ``r``;
- wherever an arc ``u`` leaves a state at ``r``, an arc ``w`` now leaves it too;
- the state behind ``u`` loses its arc ``v``.

All arcs with one label lead to one state, so a state is named by the label
that enters it. After the last merge a word has exactly one path, and that
path is its BPE encoding: no merge is applied while encoding. What is compiled
is the table of gadgets (``left``, ``right``, ``rank`` and the cut arcs), as
large as the vocabulary; rows of transitions are not. Whether an arc leaves a
state is worked out from the gadgets when it is first asked, then remembered.
Every prefix of a word has one path, so the new words of a block run through
the automaton together, place by place: an arc that leaves the state behind a
prefix gives the state behind a longer one. Long words run alone, by a
longest-match search with backtracking. Decoding emits the labels' bytes.

Defined cases: NULL or empty text has no tokens and decodes to an empty text;
texts of any length are encoded whole; repeated rows give repeated rows; an
empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sheaf.llm.common import batches_of_text, tuned

# Unicode white space, and the split pattern of byte-level BPE.
SPACE = "\t-\r \x85\xa0  -     　"
END = f"[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|{END}"

#: Entries of a worker's table of words (and eight times as many transitions). It has two halves: a full one becomes
#: the old one, whose entries move on when they are met again.
CACHE_ENTRIES = 240_000
#: Bytes of a word that runs through the automaton with others, and is remembered; words that run together.
WORD_BYTES, WORDS_AT_ONCE = 64, 50_000
#: Text that is encoded before its rows are handed on.
BLOCK_BYTES = 8_000_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def plane_zero(pattern: str) -> str:
    """The characters below 65,536 that ``pattern`` matches, as ranges of a character class."""
    spans: list[list[int]] = []
    for c in regex.findall(pattern, "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))):
        if spans and ord(c) == spans[-1][1] + 1:
            spans[-1][1] += 1
        else:
            spans.append([ord(c), ord(c)])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in spans)


class Automaton:
    """Deterministic automaton over tokens, compiled from a merge list."""

    def __init__(self, alphabet: dict[int, bytes], merges: Iterable[tuple[int, int, int]]):
        self.label = dict(alphabet)            # token -> bytes that its arc emits
        self.left: dict[int, int] = {}         # arc w leaves where arc left[w] left at rank[w]
        self.right: dict[int, int] = {}        # state w copies state right[w] as of rank[w]
        self.rank: dict[int, int] = {}
        self.cut: dict[tuple[int, int], int] = {}  # (state, arc) -> rank at which the arc went
        for r, (u, v, w) in enumerate(merges):
            self._gadget(r, u, v, w)
        self._reset()

    def _gadget(self, r: int, u: int, v: int, w: int) -> None:
        if w in self.label:
            raise ValueError(f"token {w} has two merges; its arcs would not be unique")
        self.label[w] = self.label[u] + self.label[v]
        self.left[w], self.right[w], self.rank[w] = u, v, r
        self.cut.setdefault((u, v), r)

    def _reset(self) -> None:
        self.reader = ahocorasick.Automaton()  # reads labels off a word, a character for each byte
        for token, text in self.label.items():
            self.reader.add_word(text.decode("latin-1"), token)
        self.reader.make_automaton()
        self.size = {token: len(text) for token, text in self.label.items()}
        self.sizes = np.zeros(max(self.size, default=0) + 1, np.int64)
        self.sizes[list(self.size)] = list(self.size.values())
        self.rows: dict[int, bool] = {}  # the transition table, as far as met
        self.met = np.full(1 << 20, -1, np.int64)  # the same for words that run together: twice the arc, plus whether it is there

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("label", "left", "right", "rank", "cut")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._reset()

    def has_arc(self, state: int, arc: int) -> bool:
        """Whether ``arc`` leaves ``state`` once all gadgets are in place."""
        key = state << 32 | arc
        known = self.rows.get(key)
        if known is None:
            if len(self.rows) > 8 * CACHE_ENTRIES:
                self.rows.clear()
            known = self.rows[key] = self._expand(state, arc)
        return known

    def _expand(self, state: int, arc: int) -> bool:
        # A copy shares the cuts made before it was taken; an arc w is missing
        # where the arc it stems from went no later than w's own rank.
        s, until = state, len(self.rank)
        while True:
            a, made = arc, len(self.rank)
            while True:
                gone = self.cut.get((s, a))
                if gone is not None and gone < until and gone <= made:
                    return False
                if a not in self.left:
                    break
                made, a = self.rank[a], self.left[a]
            if s not in self.right:
                return True
            until, s = min(until, self.rank[s]), self.right[s]

    def have_arcs(self, states: np.ndarray, arcs: np.ndarray) -> np.ndarray:
        """:meth:`has_arc` of each pair. A place of ``met`` holds the pair met last of those that share it."""
        key = states << 31 | arcs
        place = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)
        held = self.met[place]
        on = (held & 1).astype(bool)
        new = np.flatnonzero(held >> 1 != key)
        if len(new):
            pairs, back = np.unique(key[new], return_inverse=True)
            found = self._expand_all(pairs >> 31, pairs & 0x7FFFFFFF)
            on[new] = found[back]
            self.met[place[new]] = key[new] << 1 | on[new]
        return on

    def _expand_all(self, states: np.ndarray, arcs: np.ndarray) -> np.ndarray:
        expand = self._expand
        return np.fromiter((expand(s, a) for s, a in zip(states.tolist(), arcs.tolist(), strict=True)), bool, len(states))

    def encode_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The paths of ``words`` (none empty), one after another, and their ends. The words run through the automaton
        together: ``state`` holds what is behind each prefix, which has one path only."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(length + 1) - length - 1
        joined = "\u0100".join([w.decode("latin-1") for w in words])  # no byte stands between words
        found = np.fromiter(chain.from_iterable(self.reader.iter(joined)), np.int64).reshape(-1, 2)
        end, token = found[:, 0] + 1, found[:, 1]
        start = end - self.sizes[token]
        at = start - np.repeat(begin, length + 1)[start]
        order = np.argsort(at.astype(np.uint16) if length.max() < 65_536 else at, kind="stable")
        start, end, token = start[order], end[order], token[order]
        bounds = np.cumsum(np.bincount(at))
        state = np.full(len(joined) + 1, -1, np.int64)
        state[end[:bounds[0]]] = token[:bounds[0]]
        for lo, hi in pairwise(bounds):
            behind = state[start[lo:hi]]
            if (behind < 0).any():
                raise ValueError("the alphabet doesn't cover a word")
            on = self.have_arcs(behind, token[lo:hi])
            state[end[lo:hi][on]] = token[lo:hi][on]
        if (state[begin + length] < 0).any():
            raise ValueError("the alphabet doesn't cover a word")
        # Back from the words' ends: the places that paths go through.
        through = np.zeros(len(state), bool)
        ends, first = begin + length, begin
        while len(ends):
            through[ends] = True
            ends = ends - self.sizes[state[ends]]
            more = ends > first
            ends, first = ends[more], first[more]
        return state[through], np.cumsum(through)[begin + length]

    def encode(self, word: bytes) -> list[int]:
        """Labels of the one path that spells ``word``."""
        if not word:
            return []
        text, rows = word.decode("latin-1"), self.rows
        path = [token for _, token in self.reader.iter_long(text)]
        last = -1
        for token in path:  # the longest labels, if they form a path
            if last >= 0:
                on = rows.get(last << 32 | token)
                if not (self.has_arc(last, token) if on is None else on):
                    return self._search(text)
            last = token
        return path

    def _search(self, text: str) -> list[int]:
        """The path, trying long labels first. A prefix has one path only, so a
        place that was left again is never on the word's path."""
        size, rows, n = self.size, self.rows, len(text)
        options: list[list[int]] = [[] for _ in range(n)]
        for end, token in self.reader.iter(text):  # by rising end: the longest label comes last
            options[end + 1 - size[token]].append(token)
        dead = bytearray(n + 1)
        path: list[int] = []
        at, last = 0, -1
        while at < n:
            arcs = options[at]
            while arcs:
                token = arcs.pop()
                if dead[at + size[token]]:
                    continue
                if last >= 0:
                    on = rows.get(last << 32 | token)
                    if not (self.has_arc(last, token) if on is None else on):
                        continue
                path.append(token)
                at, last = at + size[token], token
                break
            else:
                if not path:
                    raise ValueError("the alphabet doesn't cover the word")
                dead[at] = 1
                at -= size[path.pop()]
                last = path[-1] if path else -1
        return path

    def decode(self, tokens: Iterable[int]) -> bytes:
        """The labels of ``tokens``, in order."""
        label = self.label
        return b"".join([label[t] for t in tokens])


class ByteBPE:
    """Byte-level BPE tokenizer over an :class:`Automaton`."""

    def __init__(self, automaton: Automaton, special: dict[str, int]):
        self.automaton, self.special = automaton, special
        self.special_text = {i: s.encode() for s, i in special.items()}
        self._reset()

    @classmethod
    def load(cls, path: str) -> ByteBPE:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], byte_symbols()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        alphabet = {vocab[c]: bytes([b]) for c, b in symbols.items()}
        merges = ((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs)
        return cls(Automaton(alphabet, merges), {t["content"]: t["id"] for t in spec["added_tokens"]})

    def _reset(self) -> None:
        self.words = regex.compile(WORDS)
        letters, numbers = (plane_zero(p) for p in (r"\p{L}", r"\p{N}"))
        # The same for texts of the first 65,536 characters, whose classes are looked up in one table.
        self.plain = re.compile(f" ?[{letters}]+| ?[{numbers}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{SPACE}{letters}{numbers}]+|{END}")
        names = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        label = self.automaton.label
        self.names = [str(i) for i in range(max(label) + 1)]
        self.labels = [label.get(i, b"") for i in range(max(label) + 1)]
        self.known = {s: (str(i), s.encode()) for s, i in self.special.items()}  # by word: decimal ids, emitted bytes
        self.known_old: dict[str, tuple[str, bytes]] = {}

    def __getstate__(self):
        return {"automaton": self.automaton, "special": self.special, "special_text": self.special_text}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._reset()

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        ids = (",".join([ids for ids, _ in entries]) for entries in self._entries(texts))
        return [np.fromstring(i, np.int32, sep=",") if i else np.zeros(0, np.int32) for i in ids]

    def decode(self, ids: Iterable[int]) -> str:
        label, special = self.automaton.label, self.special_text
        return b"".join([special[i] if i in special else label[i] for i in ids]).decode("utf-8", "replace")

    def _words(self, text: str | None) -> list[str]:
        """The words of ``text``; a special text is one."""
        if not text:
            return []
        words = self.plain if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else self.words
        if self.split is None or not any(s in text for s in self.special):
            return words.findall(text)
        parts = self.split.split(text)
        return [w for part in parts for w in ([part] if part in self.special else words.findall(part))]

    def _entries(self, texts: list[str | None]) -> Iterator[list[tuple[str, bytes]]]:
        """(decimal ids, emitted bytes) of each word, text by text."""
        words = [self._words(t) for t in texts]
        long = self._learn(set(chain.from_iterable(words)))
        known = self.known
        for own in words:
            yield [known[w] for w in own]
        for w in long:
            del known[w]
        if len(known) > CACHE_ENTRIES:
            self.known_old = known
            self.known = {s: known[s] for s in self.special}

    def _learn(self, words: set[str]) -> list[str]:
        """Have all ``words`` in ``known``; those that are too long to stay there."""
        known, old = self.known, self.known_old
        new = [w for w in words if w not in known]
        known.update([(w, old[w]) for w in new if w in old])
        new = [w for w in new if w not in old]
        short, long = [], []
        for w in new:
            spelt = w.encode("utf-8")
            if len(spelt) <= WORD_BYTES:
                short.append((w, spelt))
            else:
                long.append(w)
                known[w] = self._entry(self.automaton.encode(spelt))
        for at in range(0, len(short), WORDS_AT_ONCE):
            some = short[at: at + WORDS_AT_ONCE]
            path, ends = self.automaton.encode_all([spelt for _, spelt in some])
            path, begin = path.tolist(), 0
            for (w, _), end in zip(some, ends.tolist(), strict=True):
                known[w] = self._entry(path[begin:end])
                begin = end
        return long

    def _entry(self, path: list[int]) -> tuple[str, bytes]:
        names, labels = self.names, self.labels
        return ",".join([names[t] for t in path]), b"".join([labels[t] for t in path])

    def digests(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Number of tokens, digest of the ids, digest of the decoded text of each."""
        out = []
        for entries in self._entries(texts):
            ids = ",".join([e[0] for e in entries])
            back = b"".join([e[1] for e in entries]).decode("utf-8", "replace").encode("utf-8")
            out.append((ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back).hexdigest()))
        return out


ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
DIGESTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def _run(docs: DataFrame, path: str, schema: T.StructType, columns) -> DataFrame:
    """One pass over the texts, no shuffle. The automaton (a few MB, fixed by the vocabulary) is broadcast."""
    tokenizer = tuned(docs.sparkSession).sparkContext.broadcast(ByteBPE.load(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer.value
        for batch in batches_of_text(batches, BLOCK_BYTES):
            ids, texts = batch.column(0), batch.column(1)
            yield pa.RecordBatch.from_arrays([ids, *columns(own, texts)], names=schema.fieldNames())

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(work, schema)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` of each document."""
    def columns(own, texts):
        ids = own.encode_all(texts.to_pylist())
        ends = np.cumsum([0, *map(len, ids)])
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))]
    return _run(docs, path, ENCODED, columns)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of each row of :func:`encode`; NULL ids give an empty text."""
    tokenizer = tuned(encoded.sparkSession).sparkContext.broadcast(ByteBPE.load(path))

    def work(batches):
        own = tokenizer.value
        for batch in batches:
            texts = [own.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode each document; counts and digests of both results."""
    def columns(own, texts):
        rows = own.digests(texts.to_pylist())
        n, ids, back = zip(*rows, strict=True) if rows else ((), (), ())
        return [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]
    return _run(docs, path, DIGESTS, columns)
