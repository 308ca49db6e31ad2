"""Operator 5: language-model scores by a gated recurrent network with class-factored output.

Corpus counts of every token are taken over all training documents. The
``HEAD`` most frequent words (a documented bound) are broadcast. The first
``NEURAL`` of them are output words of the network, in classes of ``CLASS``
words of like frequency; every other word belongs to a static class by its
ending, one set for the rest of the head and one for the tail. The probability
of a token is that of its class given the state, times that of the word in its
class: a softmax given the state for output words, the smoothed count's share
for static classes (a static class keeps the smoothed mass of one unknown word,
so every text has a probability). With zero weights this is the smoothed
unigram model, which is where training starts.

Every document is tokenised once. Training is truncated backpropagation in
numpy on all training documents: they are dealt by hash to parts of about
``PART_TOKENS`` tokens, and the parts to rounds, as many of both as the root of
the parts' number, so both grow with the corpus. In a round each part trains
from common weights and Adagrad sums, states carried from window to window;
then weights and sums are averaged by tokens in a tree of tasks. A part holds
the same documents in the same order however the table is split, so scores hang
on the table alone (but for rounding). Scoring carries the state across
windows, so a document's score is the log-likelihood of all its tokens,
whatever its length. Counts of tail words, whose number has no bound, never
reach the driver: they are joined.

Defined cases: NULL and empty texts are one end token; a NULL id counts as an
empty text for the fold; repeated rows give repeated rows; an empty table gives
an empty table; without training documents the unknown word's share is all
there is; other columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import batches_of_text, frequent, materialise, tuned
from sheaf.session import scratch_path

ADD = 0.1  # fixed value: added to every count
HEAD, NEURAL, CLASS, ENDINGS = 65_536, 2_048, 64, 24
EMBED, STATE = 16, 24
WINDOW, LANES, STEPS = 16, 256, 1_000  # a part takes about STEPS steps of learning, or more with all LANES in use
PART_TOKENS = 4_000_000
#: Bytes of text that are cut into words at once (one text at least), tokens that are scored at once in a task, and words a task counts before it hands them on.
BATCH_BYTES, BLOCK_TOKENS, FLUSH_WORDS = 1 << 24, 4_000_000, 1_000_000
#: Rows whose class logits, and weights whose changes, are worked out at once (they stay in the cache); steps of a window in scoring.
BLOCK_ROWS, BLOCK_WEIGHTS, SCORE_WINDOW = 1_024, 16_384, 64
END = b""  # no word is empty
LN10 = math.log(10)


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:] + word[:1]) % ENDINGS


def held_out(key: Column, parts: int = 10) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == 0


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of binary texts between ASCII white space, A-Z lowered, one after another; where each text's start, and their end."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null(b"").view(pa.string())))
    words, starts = found.flatten().view(pa.binary()), found.offsets.to_numpy()
    real = pc.not_equal(pc.binary_length(words), 0)  # white space at an end leaves an empty piece
    return words.filter(real), np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))[starts]


def rows_of(lists: pa.ListArray) -> list[np.ndarray]:
    """Each row's numbers."""
    flat, starts = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    return [flat[lo:hi] for lo, hi in itertools.pairwise((starts - starts[0]).tolist())]


def corpus_counts(texts: DataFrame) -> DataFrame:
    """``word`` (binary), its class of ``ending`` and its count ``n`` over all ``texts``, end tokens included."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held):
            summed = pa.Table.from_batches(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return summed.select(["word", "n_sum"]).rename_columns(["word", "n"]).combine_chunks().to_batches()

        held, size = [], 0
        for batch in batches_of_text(batches, BATCH_BYTES):
            found = words_of(batch.column(0))[0].value_counts()
            for words, n in ((found.field("values"), found.field("counts")), (pa.array([END]), pa.array([batch.num_rows]))):
                held.append(pa.RecordBatch.from_arrays([words, n], names=["word", "n"]))
            size += len(found)
            if size > FLUSH_WORDS:
                yield from rows(held)
                held, size = [], 0
        if held:
            yield from rows(held)

    counted = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(work, "word binary, n long")
    word = F.col("word")
    last = F.crc32(F.concat(F.substring(word, -2, 2), F.substring(word, 1, 1))) % ENDINGS  # as :func:`ending`
    return counted.groupBy("word").agg(F.sum("n").alias("n")).select("word", last.cast("int").alias("ending"), "n")


class Vocabulary:
    """Head words with their symbols and static shares; totals of the whole corpus."""

    def __init__(self, head: list[tuple[bytes, int]], total: int, distinct: int, tail: dict[int, tuple[int, int]]):
        """``head``: words by falling count, the end token among them. ``tail``: per ending, tokens and words."""
        head = sorted(head, key=lambda e: (e[0] != END, -e[1], e[0]))
        self.total, self.distinct = total, distinct
        words = [w for w, _ in head]
        self.words = pa.array(words, pa.binary())
        self.counts = np.array([n for _, n in head], np.float64)
        self.neural = max(1, min(NEURAL, len(head)))
        self.classes = -(-self.neural // CLASS)
        n = len(head)
        # The output class of a word; static classes follow the network's own.
        endings = np.array([ending(w) for w in words], np.int64)
        self.of = np.where(np.arange(n) < self.neural, np.arange(n) // CLASS, self.classes + endings)
        self.width = self.classes + 2 * ENDINGS
        smooth = self.counts + ADD
        mass = np.bincount(self.of, smooth, self.width)
        for e in range(ENDINGS):
            tokens, words = tail.get(e, (0, 0))
            mass[self.classes + ENDINGS + e] = tokens + ADD * (words + 1)
        self.mass = np.maximum(mass, 1e-6)
        self.share = np.log10(smooth) - np.log10(self.mass[self.of])  # of a word in its class
        self.share[:self.neural] = 0.0
        self.base = np.log10(smooth)

    @property
    def symbols(self) -> int:
        """Inputs of the network: its words, then the static classes."""
        return self.neural + 2 * ENDINGS

    def tokens(self, texts: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        """Head ids of the tokens of binary texts, -1 - ending for tail words; the tail words in order."""
        words, starts = words_of(texts)
        found = pc.index_in(words, value_set=self.words)
        strange = found.is_null()
        tail, unknown = words.filter(strange), strange.to_numpy(zero_copy_only=False)
        # What an ending hangs on (see :func:`ending`); a batch has few such.
        coded = pc.binary_join_element_wise(pc.binary_slice(tail, -2), pc.binary_slice(tail, 0, 1), b"").dictionary_encode()
        endings = np.array([zlib.crc32(x) % ENDINGS for x in coded.dictionary.to_pylist()], np.int32)
        # Each text's words, then its end token, which is the first word of the head.
        n = len(texts)
        places = np.arange(len(words)) + np.repeat(np.arange(n), np.diff(starts))
        ids = np.zeros(len(words) + n, np.int32)
        ids[places] = found.fill_null(0).to_numpy()
        ids[places[unknown]] = -1 - endings[coded.indices.to_numpy()]
        return (pa.ListArray.from_arrays((starts + np.arange(n + 1)).astype(np.int32), ids),
                pa.ListArray.from_arrays(np.append(0, np.cumsum(unknown))[starts].astype(np.int32), tail))

    def symbol(self, ids: np.ndarray) -> np.ndarray:
        """Input symbol: a word of the network, or a static class."""
        known = np.maximum(ids, 0)
        static = self.neural - self.classes + self.of[known]
        return np.where(ids < 0, self.neural + ENDINGS - 1 - ids, np.where(known < self.neural, known, static)).astype(np.int32)


def shares(logits: np.ndarray, tame: bool) -> np.ndarray:
    """Exponentials in place (of the distance to the largest, unless ``tame``), and their sums by row."""
    if not tame:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], np.float32)


class Network:
    """Gated recurrent unit with class-factored softmax; all weights in one flat vector."""

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None):
        v = self.v = vocabulary
        self.shapes = {"embed": (v.symbols, EMBED), "inner": (EMBED, 3 * STATE), "loop": (STATE, 3 * STATE), "bias": (3 * STATE,),
                       "cls": (STATE, v.width), "cls_bias": (v.width,), "out": (v.classes, CLASS, STATE), "out_bias": (v.classes, CLASS)}
        size = sum(math.prod(s) for s in self.shapes.values())
        if flat is None:
            rng = np.random.default_rng(0)
            flat = np.zeros(size, np.float32)
            self._views(flat)
            for name, scale in (("embed", 0.3), ("inner", 0.25), ("loop", 0.2)):
                self.p[name][...] = rng.normal(0, scale, self.shapes[name])
            self.p["cls_bias"][...] = np.log(v.mass / v.mass.sum())
            rest = np.full(v.classes * CLASS, -30.0, np.float32)  # places without a word
            rest[:v.neural] = np.log(v.counts[:v.neural] + ADD) if len(v.counts) else 0.0
            self.p["out_bias"][...] = rest.reshape(v.classes, CLASS)
            self.p["out_bias"] -= self.p["out_bias"].max(axis=1, keepdims=True)
        else:
            self._views(flat.copy())

    def _views(self, flat: np.ndarray) -> None:
        self.flat, self.p = flat, self.laid(flat)

    def laid(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """Parts of a flat vector by name."""
        parts, at = {}, 0
        for name, shape in self.shapes.items():
            n = math.prod(shape)
            parts[name] = flat[at: at + n].reshape(shape)
            at += n
        return parts

    def states(self, before: np.ndarray, fresh: np.ndarray, h: np.ndarray, learn: bool = True):
        """A window's states and gates from the state ``h``, step by step; lanes are columns, so that gates are whole
        rows. States and inputs have a last value of one, so that biases are weights. Without ``learn`` states before,
        gates and the loop's shares aren't kept."""
        p, (steps, width) = self.p, before.shape
        # The logistic function is (1 + tanh(x / 2)) / 2: the halves of x go into the weights.
        scale = np.repeat(np.array([0.5, 0.5, 1], np.float32), STATE)[:, None]
        loop = np.ascontiguousarray(p["loop"].T * scale)
        inner = np.concatenate([p["inner"].T, p["bias"][:, None]], axis=1) * scale
        inputs = np.concatenate([p["embed"], np.ones((len(p["embed"]), 1), np.float32)], axis=1).take(before, axis=0, mode="clip")
        gates = np.empty((steps if learn else 1, 3 * STATE, width), np.float32)
        out = np.empty((steps, STATE + 1, width), np.float32)
        out[:, STATE] = 1
        past = carried = None
        if learn:
            past = np.empty((steps, STATE, width), np.float32)
            carried = np.empty((steps, STATE, width), np.float32)  # the loop's share of the new state
        starts = fresh.any(axis=1).tolist()
        for t in range(steps):
            if starts[t]:
                h = np.where(fresh[t], np.float32(0), h)
            a = loop @ h
            own = np.matmul(inner, inputs[t].T, out=gates[t if learn else 0])
            zr, n = own[:2 * STATE], own[2 * STATE:]
            zr += a[:2 * STATE]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            a = a[2 * STATE:]
            if learn:
                past[t], carried[t] = h, a
            a *= zr[STATE:]
            n += a
            np.tanh(n, out=n)
            np.subtract(h, n, out=a)
            a *= zr[:STATE]
            h = np.add(a, n, out=out[t, :STATE])
        return out, past, inputs, gates, carried, starts, h

    def tame(self) -> bool:
        """Whether no logit can leave the range in which exponentials are exact enough (states lie between -1 and 1)."""
        p, ones = self.p, np.ones(STATE, np.float32)
        return all(float((np.abs(w) @ ones + np.abs(np.maximum(b, -30))).max()) < 60
                   for w, b in ((p["cls"].T, p["cls_bias"]), (p["out"].reshape(-1, STATE), p["out_bias"].ravel())))

    def output(self, h: np.ndarray, cls: np.ndarray, symbol: np.ndarray, learn: bool = False):
        """:meth:`outputs` for states as rows."""
        states = np.ones((1, STATE + 1, len(h)), np.float32)
        states[0, :STATE] = h.T
        score, dh, grads = self.outputs(states, cls[None], symbol[None], np.ones((1, len(h)), bool), self.tame(), learn)
        return score[0], dh[0].T if learn else None, grads

    def outputs(self, h: np.ndarray, cls: np.ndarray, symbol: np.ndarray, real: np.ndarray, tame: bool, learn: bool = False):
        """Natural log probability of class and word at each place of a window's states (see :meth:`states`), any number
        where a place isn't ``real``; with ``learn`` also the gradients."""
        p, v, (steps, _, width) = self.p, self.v, h.shape
        whole, own, real = bool(real.all()), cls.ravel(), real.ravel()
        rows = np.ascontiguousarray(h.transpose(0, 2, 1)).reshape(-1, STATE + 1)
        chance, dh, grads = np.empty(len(rows), np.float32), None, None
        weights = np.concatenate([p["cls"], p["cls_bias"][None]])
        if learn:
            turned, d_cls = np.ascontiguousarray(p["cls"].T), np.zeros_like(weights)
            back = np.empty((len(rows), STATE), np.float32)
        # Some rows at a time, whose logits stay in the cache.
        firsts = np.arange(min(len(rows), BLOCK_ROWS)) * v.width
        for lo in range(0, len(rows), BLOCK_ROWS):
            some = rows[lo: lo + BLOCK_ROWS]
            hi = lo + len(some)
            logits, at = some @ weights, firsts[:len(some)] + own[lo:hi]
            total = shares(logits, tame)
            picked = logits.ravel().take(at)
            np.divide(picked, total, out=chance[lo:hi])
            if learn:
                # Shares are the row divided by its sum, less one at its class: the sum goes to the narrower factor.
                logits.ravel()[at] = picked - total
                np.reciprocal(total, out=total)
                if not whole:
                    total *= real[lo:hi]
                total = total[:, None]
                np.multiply(logits @ turned, total, out=back[lo:hi])
                d_cls += (some * total).T @ logits
        # Rows in the order of their classes, so that a class is a slice; static classes and other places come last.
        flat = own if whole else np.where(real, own, v.width)
        order = np.argsort(flat.astype(np.uint8) if v.width < 255 else flat, kind="stable")
        edges = [0, *np.cumsum(np.bincount(flat, minlength=v.classes)[:v.classes]).tolist()]
        weights = np.concatenate([p["out"].transpose(0, 2, 1), p["out_bias"][:, None]], axis=1)
        if learn:
            d_out = np.zeros((v.classes, CLASS, STATE + 1), np.float32)
        c = 0
        while c < v.classes:
            # Classes of together some rows.
            first, c = c, max(c + 1, bisect.bisect_right(edges, edges[c] + BLOCK_ROWS) - 1)
            places = order[edges[first]: edges[c]]
            slices = [(k, slice(edges[k] - edges[first], edges[k + 1] - edges[first])) for k in range(first, c) if edges[k] < edges[k + 1]]
            some, logits = rows.take(places, axis=0, mode="clip"), np.empty((len(places), CLASS), np.float32)
            for k, part in slices:
                np.matmul(some[part], weights[k], out=logits[part])
            at = np.arange(len(places)) * CLASS + symbol.ravel().take(places) % CLASS
            total = shares(logits, tame)
            picked = logits.ravel().take(at)
            chance[places] *= picked / total
            if learn:
                logits.ravel()[at] = picked - total
                total = np.reciprocal(total, out=total)[:, None]
                some *= total
                d_rows = np.empty((len(places), STATE), np.float32)
                for k, part in slices:
                    np.matmul(logits[part], p["out"][k], out=d_rows[part])
                    np.matmul(logits[part].T, some[part], out=d_out[k])
                d_rows *= total
                back[places] += d_rows
        if learn:
            dh = np.ascontiguousarray(back.reshape(steps, width, STATE).transpose(0, 2, 1))
            grads = {"cls": d_cls[:STATE], "cls_bias": d_cls[STATE], "out": d_out[:, :, :STATE], "out_bias": d_out[:, :, STATE]}
        np.maximum(chance, np.float32(1e-37), out=chance)
        return np.log(chance, out=chance).reshape(steps, width), dh, grads

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Log10 probability of each document's classes and output words; states run through whole documents."""
        lanes = Lanes(docs, self.v, LANES)
        out = np.zeros(len(docs))
        h, tame = np.zeros((STATE, lanes.width), np.float32), self.tame()
        for symbol, before, cls, doc, fresh in lanes.windows(SCORE_WINDOW):
            states, *_, h = self.states(before, fresh, h[:, :symbol.shape[1]], learn=False)
            real = doc >= 0
            score, _, _ = self.outputs(states, cls, symbol, real, tame)
            out += np.bincount(doc[real], score[real].astype(np.float64), len(docs))
        return out / LN10

    def history(self) -> np.ndarray:
        """Adagrad's sums before the first step, in the order of the weights."""
        return np.concatenate([np.full(math.prod(s), 1e-2 if k in ("embed", "out", "out_bias") else 1.0, np.float32)
                               for k, s in self.shapes.items()])

    def train(self, docs: list[np.ndarray], history: np.ndarray, rate: float = 0.1) -> int:
        """One pass of truncated backpropagation (Adagrad, whose sums are ``history``); the number of tokens."""
        lanes = Lanes(docs, self.v, max(16, min(LANES, sum(map(len, docs)) // (WINDOW * STEPS))))
        h = np.zeros((STATE, lanes.width), np.float32)
        count, p, step = 0, self.p, np.empty_like(self.flat)
        steps_of = self.laid(step)
        for symbol, before, cls, doc, fresh in lanes.windows(WINDOW):
            states, past, inputs, gates, carried, starts, h = self.states(before, fresh, h[:, :symbol.shape[1]])
            real = doc >= 0
            m = int(np.count_nonzero(real))
            if not m:
                continue
            _, dh, grads = self.outputs(states, cls, symbol, real, self.tame(), learn=True)
            own, new, back = np.empty_like(gates[0]), np.empty_like(past[0]), np.zeros_like(past[0])
            d_loop, d_inner = np.zeros(p["loop"].T.shape, np.float32), np.zeros((3 * STATE, EMBED + 1), np.float32)
            d_inputs, turned = np.empty((*before.shape, EMBED), np.float32), np.ascontiguousarray(p["inner"].T)
            for t in range(len(symbol) - 1, -1, -1):
                zr, n = gates[t, :2 * STATE], gates[t, 2 * STATE:]
                d = dh[t]
                d += back
                rest = d * zr[:STATE]  # goes to the state before; what is left of d to the new state
                slope = 1 - zr
                slope *= zr
                z, r = own[:STATE], own[STATE:2 * STATE]
                np.subtract(past[t], n, out=z)
                z *= d
                z *= slope[:STATE]
                np.multiply(n, n, out=new)
                np.subtract(1, new, out=new)
                d -= rest
                new *= d
                np.multiply(new, carried[t], out=r)
                r *= slope[STATE:]
                np.multiply(new, zr[STATE:], out=own[2 * STATE:])
                back = p["loop"] @ own
                back += rest
                if starts[t]:
                    back[:, fresh[t]] = 0
                d_loop += own @ np.ascontiguousarray(past[t].T)
                own[2 * STATE:] = new  # the loop's share of the new state passes a gate, the input's doesn't
                d_inner += own @ inputs[t]
                np.matmul(own.T, turned, out=d_inputs[t])
            grads |= {"bias": d_inner[:, EMBED], "inner": d_inner[:, :EMBED].T, "loop": d_loop.T}
            places = (before * EMBED)[:, :, None] + np.arange(EMBED)
            steps_of["embed"].ravel()[...] = np.bincount(places.ravel(), d_inputs.ravel(), p["embed"].size)
            for name, g in grads.items():
                steps_of[name][...] = g
            norm = 1 / math.sqrt(m)
            for at in range(0, len(step), BLOCK_WEIGHTS):
                g, total = step[at: at + BLOCK_WEIGHTS], history[at: at + BLOCK_WEIGHTS]
                g *= norm
                np.minimum(g, 5, out=g)
                np.maximum(g, -5, out=g)
                total += g * g
                g /= np.sqrt(total)
                g *= rate
                self.flat[at: at + BLOCK_WEIGHTS] -= g
            count += m
        return count


class Lanes:
    """Documents laid end to end in lanes, the longest lane first, read in windows of equal steps.

    A window holds the lanes that reach into it, so a very long document doesn't drag idle lanes along.
    """

    def __init__(self, docs: list[np.ndarray], vocabulary: Vocabulary, max_lanes: int):
        total = sum(map(len, docs))
        self.width = max(1, min(max_lanes, len(docs), total // WINDOW))
        lanes: list[list[int]] = [[] for _ in range(self.width)]
        heap = [(0, i) for i in range(self.width)]
        for d in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            filled, lane = heapq.heappop(heap)
            lanes[lane].append(d)
            heapq.heappush(heap, (filled + len(docs[d]), lane))
        in_order = sorted(heap, key=lambda e: (-e[0], e[1]))
        self.filled = np.array([n for n, _ in in_order])
        # All lanes one after another; a window is taken out by places.
        order = [d for _, i in in_order for d in lanes[i]]
        self.ids = np.concatenate([*(docs[d] for d in order), np.zeros(1, np.int32)])
        sizes = np.array([len(docs[d]) for d in order], np.int64)
        self.doc = np.append(np.repeat(np.array(order, np.int32), sizes), np.int32(-1))
        self.first = np.zeros(len(self.ids), bool)
        self.first[np.cumsum(sizes) - sizes] = True
        self.start = np.cumsum(self.filled) - self.filled
        # By one lookup: symbols and classes of every id, from the lowest (the last ending's tail) on.
        known = np.arange(-ENDINGS, len(vocabulary.of), dtype=np.int32)
        shifted = self.ids + np.int32(ENDINGS)
        self.symbols = vocabulary.symbol(known).take(shifted)
        self.classes = np.where(known < 0, vocabulary.classes + ENDINGS - 1 - known, vocabulary.of[np.maximum(known, 0)]).astype(np.int32).take(shifted)
        self.before = np.where(self.first, np.int32(0), np.append(np.int32(0), self.symbols[:-1]))  # symbol 0 is the end token

    def windows(self, steps: int):
        """(symbols, symbols before, classes, documents or -1, fresh starts) of each window, lanes as columns."""
        nothing = len(self.ids) - 1
        for at in range(0, int(self.filled[0]) if len(self.filled) else 0, steps):
            width = int(np.count_nonzero(self.filled > at))
            step = at + np.arange(min(steps, int(self.filled[0]) - at))
            place = np.where(step[:, None] < self.filled[None, :width], self.start[None, :width] + step[:, None], nothing)
            yield tuple(x.take(place) for x in (self.symbols, self.before, self.classes, self.doc, self.first))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The head (bounded) and per-ending totals; ``counts`` stays where it is."""
    head = {bytes(r.word): r.n for r in frequent(counts, HEAD - 1).unionByName(counts.where(F.col("word") == F.lit(END))).collect()}
    head = list(head.items())
    sums = {r.ending: (r.tokens, r.words) for r in counts.groupBy("ending").agg(
        F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words")).collect()}
    total, distinct = sum(t for t, _ in sums.values()), sum(w for _, w in sums.values())
    for w, n in head:
        e = ending(w)
        sums[e] = (sums[e][0] - n, sums[e][1] - 1)
    return Vocabulary(head or [(END, 0)], total, distinct, sums)


def tokenised(texts: DataFrame, v: Vocabulary, rounds: int, parts: int, held: Column) -> DataFrame:
    """Every document's tokens once: ``doc_id, round, part, deal, ids, tail``; held-out documents are in round -1."""
    words = tuned(texts.sparkSession).sparkContext.broadcast(v)
    deal = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    part = F.pmod(deal, F.lit(rounds * parts))
    dealt = texts.select("doc_id", F.when(held, -1).otherwise(F.floor(part / parts)).cast("int").alias("round"),
                         (part % parts).cast("int").alias("part"), deal.alias("deal"), F.col("text").cast("binary").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_text(batches, BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *words.value.tokens(batch.column(4))],
                                             names=["doc_id", "round", "part", "deal", "ids", "tail"])

    tokens = dealt.mapInArrow(work, "doc_id long, round int, part int, deal long, ids array<int>, tail array<binary>")
    path = scratch_path(texts.sparkSession, "lm-tokens")
    tokens.repartition("round", "part").write.partitionBy("round").parquet(path)
    return texts.sparkSession.read.schema(tokens.schema).parquet(path)


def plan_of(tokens: int) -> tuple[int, int]:
    """Rounds, and parts of a round."""
    parts = max(1, round(tokens / PART_TOKENS))
    rounds = math.isqrt(parts - 1) + 1
    return rounds, -(-parts // rounds)


def _average(group: pd.DataFrame) -> pd.DataFrame:
    """The mean of weights and sums by tokens, added in the order of the parts."""
    group = group.sort_values("part")
    n = int(group["n"].sum())
    mean = sum(np.frombuffer(w, np.float32) * np.float32(k / n) for k, w in zip(group["n"], group["w"], strict=True))
    return pd.DataFrame({"part": [group["part"].iloc[0]], "n": [n], "w": [mean.tobytes()]})


def train(tokens: DataFrame, v: Vocabulary, rounds: int, parts: int) -> Network:
    """Train on all documents of rounds 0 and later, round by round."""
    spark = tokens.sparkSession
    words = spark.sparkContext.broadcast(v)
    network = Network(v)
    state = np.concatenate([network.flat, network.history()])
    for r in range(rounds):
        start = spark.sparkContext.broadcast(state)

        def learn(batches, start=start):
            held, part = [], None

            def result():
                half = len(start.value) // 2
                own, history = Network(words.value, start.value[:half]), start.value[half:].copy()
                n = own.train(held, history)
                return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64()),
                                                   pa.array([np.concatenate([own.flat, history]).tobytes()], pa.binary())], names=["part", "n", "w"])

            for batch in batches:
                for p, ids in zip(batch.column(0).to_pylist(), rows_of(batch.column(1)), strict=True):
                    if p != part and held:
                        yield result()
                        held = []
                    part = p
                    held.append(ids)
            if held:
                yield result()

        own = tokens.where(F.col("round") == r).repartition(parts, "part").sortWithinPartitions("part", "deal", "doc_id", "ids")
        models = materialise(own.select("part", "ids").mapInArrow(learn, "part int, n long, w binary"), "lm-weights")
        while models.count() > 16:  # a tree of tasks, 16 models each
            models = materialise(models.groupBy(F.floor(F.col("part") / 16).cast("int").alias("g")).applyInPandas(
                lambda g: _average(g.assign(part=g["part"] // 16)), "part int, n long, w binary"), "lm-weights")
        rest = models.toPandas()
        start.unpersist()
        if len(rest):
            state = np.frombuffer(_average(rest)["w"][0], np.float32)
    return Network(v, state[:len(state) // 2])


def log_likelihood(docs: DataFrame, parts: int = 10) -> DataFrame:
    """Base and network scores of each document (see the module's text)."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    held = held_out(F.col("doc_id"), parts)
    counts = materialise(corpus_counts(texts.where(~held)), "lm-counts")
    v = vocabulary(counts)
    plan = plan_of(v.total)
    tokens = tokenised(texts, v, *plan, held)
    network = texts.sparkSession.sparkContext.broadcast(train(tokens, v, *plan))

    def scored(model: Network, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        own, ids = model.v, [x for part in parts for x in rows_of(part.column(1))]
        sizes = np.array([*map(len, ids)], np.int64)
        doc, flat = np.repeat(np.arange(len(ids)), sizes), np.concatenate(ids) + ENDINGS
        # What a token adds, by id from the lowest (the last ending's tail) on.
        none, tail_mass = np.zeros(ENDINGS), np.log10(own.mass[own.classes + ENDINGS:])
        known, base, static = (np.bincount(doc, np.append(tail, head).take(flat), len(ids))
                               for tail, head in ((none, own.counts > 0), (none, own.base), (-tail_mass[::-1], own.share)))
        del doc, flat  # not held while the network runs
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([part.column(0) for part in parts]), pa.array(sizes), pa.array(known.astype(np.int64)), pa.array(base),
             pa.array(model.score(ids) + static), pa.concat_arrays([part.column(2) for part in parts])],
            names=["doc_id", "n_tokens", "head_known", "head_base", "head_score", "tail"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = network.value
        parts, held = [], 0
        for batch in batches:
            start = 0
            for i, size in enumerate(batch.column(1).value_lengths().to_pylist(), 1):
                held += size
                if held > BLOCK_TOKENS:
                    yield scored(model, [*parts, batch.slice(start, i - start)])
                    parts, held, start = [], 0, i
            if start < batch.num_rows:
                parts.append(batch.slice(start))
        if parts:
            yield scored(model, parts)

    own = tokens.select("doc_id", "ids", "tail").mapInArrow(work, "doc_id long, n_tokens long, head_known long, head_base double, head_score double, tail array<binary>")
    own = materialise(own.withColumn("uid", F.monotonically_increasing_id()), "lm-scores")
    tail = own.select("uid", F.explode("tail").alias("word"))
    c = F.coalesce("n", F.lit(0))
    tail = (tail.join(counts.select("word", "n"), "word", "left").groupBy("uid")
            .agg(F.sum(F.log10(c + ADD)).alias("tail_log"), F.count("n").alias("tail_known")))
    all_mass = math.log10(v.total + ADD * (v.distinct + 1))
    more = F.coalesce("tail_log", F.lit(0.0))
    return own.drop("tail").join(tail, "uid", "left").select(
        "doc_id", held_out(F.col("doc_id"), parts).alias("held_out"), "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + more - F.col("n_tokens") * F.lit(all_mass)).alias("base_score"),
        (F.col("head_score") + more).alias("score"))
