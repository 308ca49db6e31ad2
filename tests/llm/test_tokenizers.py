from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sheaf.llm import bpe, token_counts
from sheaf.llm.common import tokenizer_path
from tests.llm.helpers import odd_documents, tuples

BPE, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ß", "12", "<|endoftext|>", "<s>", " ", "　", "日本", "😀", "\x1c",
         "\x85", "the", "aaaa", "​", "▁", "é", "\r\n", "$$$", "Token"]


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBPE.load(BPE)


@pytest.fixture(scope="module")
def theirs():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def pieces():
    return token_counts.PieceCounter.load(PIECES)


def applied(word: bytes, merges: dict) -> list:
    """Plain BPE: the lowest-ranked pair, leftmost first, again and again."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        best = min((merges.get((a, b), len(merges)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if best[0] == len(merges):
            break
        parts[best[1]: best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return parts


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10_000), st.text("abc", max_size=24))
def test_automaton_has_the_paths_of_plain_merging(seed, word):
    rng, tokens, merges = random.Random(seed), [b"a", b"b", b"c"], {}
    for _ in range(rng.randint(0, 12)):
        pair = rng.choice(tokens), rng.choice(tokens)
        # A pair is worth a merge only if plain merging brings it about.
        if b"".join(pair) not in tokens and applied(b"".join(pair), merges) == list(pair):
            merges[pair] = len(merges)
            tokens.append(b"".join(pair))
    ids = {t: i for i, t in enumerate(tokens)}
    automaton = bpe.Automaton({ids[t]: t for t in (b"a", b"b", b"c")}, [(ids[a], ids[b], ids[a + b]) for a, b in merges])
    path = automaton.encode(word.encode())
    assert [automaton.label[t] for t in path] == applied(word.encode(), merges)
    assert automaton.decode(path) == word.encode()


def test_words_of_a_block_run_through_the_automaton_together(theirs, monkeypatch):
    rng, own = random.Random(5), bpe.ByteBPE.load(BPE)
    marks = ["er", "th", "tion", "ça", "ñ", "日", "😀", ",", "###", "'ll", " ", "\n", "7", "<|endoftext|>"]
    texts = [None, "", *("".join(rng.choices(marks, k=300)) for _ in range(200)), "ab" * 300]
    expected = [theirs.encode(t or "", add_special_tokens=False).ids for t in texts]
    words = sorted({w.encode() for t in texts for w in own._words(t)} - {b""})
    path, ends = own.automaton.encode_all(words)
    assert [p.tolist() for p in bpe.np.split(path, ends[:-1])] == [own.automaton.encode(w) for w in words]
    alone, encode = [], bpe.Automaton.encode
    monkeypatch.setattr(bpe.Automaton, "encode", lambda self, word: alone.append(word) or encode(self, word))
    for own in (own, bpe.ByteBPE.load(BPE)):
        # A full table changes no result.
        monkeypatch.setattr(bpe, "CACHE_ENTRIES", 50)
        assert [i.tolist() for i in own.encode_all(texts)] == expected
        assert [d[0] for d in own.digests(texts)] == [*map(len, expected)]
        assert len(own.known) <= 50 + len(own.special)
    assert all(len(w) > bpe.WORD_BYTES for w in alone)
    with pytest.raises(ValueError):
        bpe.Automaton({0: b"a"}, []).encode_all([b"aba"])
    with pytest.raises(ValueError):
        bpe.Automaton({0: b"a"}, []).encode_all([b"a", b"ab"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=30).map("".join))
def test_same_ids_as_the_library(own, theirs, text):
    text = text.encode("utf-8", "ignore").decode()
    expected = theirs.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist() == expected
    assert own.decode(expected) == theirs.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 3_000, " " * 3_000, "ab" * 2_000, "日" * 1_000, "=-" * 2_000])
def test_long_words(own, theirs, pieces, text):
    sentencepiece = pytest.importorskip("sentencepiece")
    assert own.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids
    assert pieces.count([text]) == [len(sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(text))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=30).map("".join))
def test_same_counts_as_the_library(pieces, text):
    sentencepiece = pytest.importorskip("sentencepiece")
    text = text.encode("utf-8", "ignore").decode().replace("\x00", "")
    assert pieces.count([text]) == [len(sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(text))]


def test_odd_rows(spark, theirs):
    docs = odd_documents(spark, PARTS)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for r in docs.collect():
        ids = theirs.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(theirs.decode(ids, skip_special_tokens=False))))
    assert tuples(bpe.round_trip(docs, BPE)) == sorted(expected, key=repr)
    back = bpe.decode(bpe.encode(docs, BPE), BPE)
    assert tuples(back) == sorted([(r.doc_id, r.text or "") for r in docs.collect()], key=repr)


def test_odd_rows_counted(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = odd_documents(spark, PARTS)
    expected = [(r.doc_id, len((r.text or "").encode()), n, n > 4096)
                for r in docs.collect() for n in [len(model.encode(r.text or ""))]]
    assert tuples(token_counts.token_counts(docs, PIECES)) == sorted(expected, key=repr)


def test_empty_tables(spark):
    none = odd_documents(spark).limit(0)
    assert bpe.round_trip(none, BPE).count() == bpe.encode(none, BPE).count() == token_counts.token_counts(none, PIECES).count() == 0
