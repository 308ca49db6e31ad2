"""Operator 13: the parse by a plain version, the order and the edits by brute force, likeness on known cases."""

from __future__ import annotations

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sheaf.llm import fingerprint as fp
from sheaf.llm.queries import op13_fingerprints
from tests.llm.helpers import odd_documents

SF = "/root/testdata/sf0.001"


def plain_level(names: list[int]) -> list[tuple]:
    """One level name by name: runs, four coin tosses, blocks as tuples of names."""
    runs = []
    for name in names:
        if runs and runs[-1][0] == name:
            runs[-1][1] += 1
        else:
            runs.append([name, 1])
    values = [int(fp.mix(np.array([v], np.uint64) + np.array([n], np.uint64) * fp._RUN)[0]) if n > 1 else v for v, n in runs]
    label = values
    for _ in range(fp.ROUNDS):
        tossed = []
        for i, v in enumerate(label):
            differ = v ^ label[i - 1] if i else 1
            k = (differ & -differ).bit_length() - 1
            tossed.append(2 * k + (v >> k & 1))
        label = tossed
    assert max(label) < 6 and all(a != b for a, b in zip(label, label[1:], strict=False))
    starts = [i for i in range(len(values)) if i == 0 or 0 < i < len(values) - 1 and label[i - 1] < label[i] > label[i + 1]]
    return [tuple(values[a:b]) for a, b in zip(starts, [*starts[1:], len(values)], strict=True)]


def levels_of(text: str, n: int) -> list[np.ndarray]:
    names, first = np.array([ord(c) for c in text], np.uint32), np.zeros(len(text), bool)
    first[0] = True
    out = []
    for _ in range(n):
        names, first = fp.level_up(names, first)
        out.append(names)
    return out


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab c\n日", min_size=1, max_size=300))
def test_a_level_equals_the_plain_parse(text):
    blocks = plain_level([ord(c) for c in text])
    names = levels_of(text, 1)[0]
    assert len(names) == len(blocks) and all(1 <= len(b) <= 12 for b in blocks)
    by_name = {}
    for name, block in zip(names.tolist(), blocks, strict=True):
        assert by_name.setdefault(name, block) == block
    assert len(set(by_name.values())) == len(by_name)


def test_equal_substrings_share_their_inner_names_at_any_offset():
    rng = np.random.default_rng(1)
    shared = "".join(rng.choice(list("etaoin shrdlu"), 3000))
    for offset in (1, 2, 7, 50):
        a, b = "".join(rng.choice(list("xyz q"), offset)) + shared, shared + "tail"
        for level, margin in ((0, 12), (1, 14), (2, 16)):
            own = levels_of(shared, 3)[level].tolist()[margin:-margin]
            for other in (a, b):
                there = levels_of(other, 3)[level].tolist()
                at = there.index(own[0])
                assert there[at: at + len(own)] == own


def test_long_texts_in_steps_equal_one_step(monkeypatch):
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("ab "), 5000)) + "a" * 700 + "".join(rng.choice(list("ab "), 3000))
    whole = fp.sketches([text, "", "x", text[:77]])
    monkeypatch.setattr(fp, "CHUNK", 64)
    for a, b in zip(whole, fp.sketches([text, "", "x", text[:77]]), strict=True):
        assert a.tolist() == b.tolist()
    assert fp.sketches([text])[0].tolist() == whole[0].tolist()  # neighbours in a group don't matter


def expected(rows):
    """``(doc_id, n_chars, sha of the edited text, edited text, next text)`` in order, by brute force."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after))
    return out


def check(got, rows):
    want = expected(rows)
    own, changed, after = (fp.sketches([w[i] for w in want]) for i in (3, 4, 5))
    full = [(*w[:3], fp.as_text(a), fp.as_text(b), fp.likeness(a, b), fp.likeness(a, c))
            for w, a, b, c in zip(want, own, changed, after, strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(full, key=repr)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").orderBy("doc_id", ascending=False).collect()]
    got = op13_fingerprints(spark, SF).collect()
    check(got, rows)
    near = np.array([r.near_edited for r in got])
    assert np.median(near) > 0.45 and np.median([r.near_next for r in got]) < 0.1


def test_every_row_is_a_range_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(fp, "SAMPLE", 1000)
    monkeypatch.setattr(fp, "GROUP", 30)
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 5)) for i in range(40)], "doc_id long, text string").repartition(3)
    check(fp.fingerprints(docs, ranges=50).collect(), [(i, f"text number {i} " * (i % 5)) for i in reversed(range(40))])


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = fp.fingerprints(docs)
    assert got.count() == docs.count() and got.where("doc_id is null").count() == 1
    empty = got.where("n_chars = 0").collect()
    assert len(empty) == 2 and all(r.fingerprint == "" for r in empty)
    same = {r.fingerprint for r in got.where("doc_id in (7, 8)").collect()}
    assert len(same) == 1
    one = fp.fingerprints(spark.createDataFrame([(5, "only this")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"only only").hexdigest()
    assert fp.fingerprints(docs.limit(0)).count() == 0


def test_likeness_of_changed_and_other_texts():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9)))) for _ in range(400)]
    text, other = (" ".join(rng.choice(words, 500)) for _ in range(2))
    few = text.split(" ")
    few[100] = few[300] = "changed"
    a, b, c, d = fp.sketches([text, " ".join(few), other, "new start " + text])
    assert fp.likeness(a, a) == 1 and fp.likeness(a, b) > 0.85 and fp.likeness(a, d) > 0.85 and fp.likeness(a, c) < 0.15
