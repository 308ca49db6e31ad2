"""Operator 8: secret scans whose false positives a random forest removes.

Candidates are values assigned to a credential's name, passwords of addresses
(``scheme://user:password@host``), long unbroken runs of key characters, and
private key blocks (PEM and PGP, also those without an end). The search is
linear in a text's length. Each becomes a feature vector: its
length, its transitions between character classes and between letters (against
the letter pairs of all documents), how much of it dictionary words cover (the
dictionary: the ``WORDS`` most frequent words of all documents), the path it
stands in and its document's source, and its neighbouring words. A random forest
trained from labelled findings says how likely it is a secret.

``train`` takes any labelled findings; :func:`labelled_vectors` gives those of
the corpus that rules can label beyond doubt (at most ``FIT_ROWS`` of each
label, chosen by hash) and :func:`drawn_findings` adds seeded ones in published key
formats and common decoys, so that formats the corpus lacks are known too. Only
the fit works on a bounded sample; dictionary and letter pairs are counted over
all documents, and every document is scanned whole.

Findings carry place, length and SHA-256 of a value, never the value itself;
what a fit hands on from the tasks are feature vectors and labels.

Defined cases: NULL and empty texts have no findings; a NULL source is an empty
path; repeated rows give repeated findings; overlapping candidates are joined
to the one that starts first (the longest of these); texts of any length are
read whole; an empty table gives no findings; other columns are ignored
(:func:`redact` returns them as they are).
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import bounded_sample, frequent, materialise, text_bytes, tuned

#: Dictionary size, labelled findings used in the fit, words a task counts before it hands them on.
WORDS, FIT_ROWS, FLUSH_WORDS = 20_000, 8_000, 300_000
TREES, DEPTH, THRESHOLD = 40, 8, 0.5
MARK = "[SECRET]"

NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "accesskey",
         "private_key", "credential", "auth")
NAME = re.compile("(?i)" + "|".join(NAMES))
NAME_END = re.compile(r"[\w-]*")
VALUE = re.compile(r"[\"']?\s*(?::=|=>|[:=])\s*(?:\"([^\"\s]{6,})\"|'([^'\s]{6,})'|([^\s\"',;]{6,}))")
RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
ADDRESS = re.compile(r"[^\s/?#@:]{0,128}:([^\s/?#@]{3,256})@(?=[\w\[])")
KEY_MARK = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]{0,40}?PRIVATE KEY(?: BLOCK)?-----")
#: What follows a BEGIN line that has no END: lines of key material and of headers.
KEY_BODY = re.compile(r"(?:\s+(?:[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z-]{1,30}: [^\n]{0,200}))*(?:\s+[A-Za-z0-9+/]{1,15}={1,2})?")
DECOYS = re.compile(r"(?i)example|sample|dummy|placeholder|change.?me|your[_-]|xxxx|redacted|\*\*\*|<|\$\{|test[_-]?key")
PLAIN = re.compile(r"[0-9._-]*(?:0000|1234567)[0-9._-]*|password|secret")
NEAR = re.compile(r"\w+")
CONTEXT = 48


def is_decoy(value: str) -> bool:
    """A stand-in for a secret: one that says so, or digits in a row and nothing else."""
    return bool(DECOYS.search(value) or PLAIN.fullmatch(value.lower()))


def key_blocks(text: str) -> list[tuple[int, int, str]]:
    """Private key blocks; one without an END reaches as far as lines of key material do."""
    marks = list(KEY_MARK.finditer(text))
    out = []
    for own, after in zip(marks, [*marks[1:], None], strict=True):
        if own[1] == "BEGIN":
            closed = after is not None and after[1] == "END"
            end = after.end() if closed else KEY_BODY.match(text, own.end(), after.start() if after else len(text)).end()
            out.append((own.start(), end, "block"))
    return out


def candidates(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, rule) of each candidate, in order, without overlaps."""
    if not text:
        return []
    found = []
    small = text.lower()
    if any(n in small for n in NAMES):
        name = NAME.search(text)
        while name:
            # The word that holds the name is read to its end once, then a value after it.
            at = NAME_END.match(text, name.end()).end()
            value = VALUE.match(text, at)
            if value:
                found.append((*value.span(value.lastindex), "assigned"))
                at = value.end()
            name = NAME.search(text, at)
    at = text.find("://")
    while at >= 0:
        password = ADDRESS.match(text, at + 3)
        if password:
            found.append((*password.span(1), "url"))
        at = text.find("://", at + 3)
    if "PRIVATE KEY" in text:
        found += key_blocks(text)
    at = 0
    for word in text.split():
        if len(word) >= 16:
            at = text.index(word, at)
            found += [(at + m.start(), at + m.end(), "run") for m in RUN.finditer(word)]
            at += len(word)
    found.sort(key=lambda f: (f[0], -f[1], f[2]))
    out: list[tuple[int, int, str]] = []
    for f in found:
        if not out or f[0] >= out[-1][1]:
            out.append(f)
    return out


def corpus_counts(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The most frequent words (letters only, 4 or more) and the counts of byte pairs, over all documents."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(names, counts):
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["w", "n"])

        words: Counter = Counter()
        pairs = np.zeros(65_536, np.int64)
        for batch in batches:
            for text in batch.column(0):
                raw = text_bytes(text.as_py()).lower()
                codes = np.frombuffer(raw, np.uint8).astype(np.uint16)
                pairs += np.bincount(codes[:-1] * 256 + codes[1:], minlength=65_536) if len(codes) > 1 else 0
                words.update(raw.split())
                if len(words) > FLUSH_WORDS:
                    yield rows(*split(words))
                    words.clear()
        if words:
            yield rows(*split(words))
        there = np.flatnonzero(pairs)
        yield rows([f" {i}" for i in there], pairs[there])

    def split(words):
        plain = [(w, n) for w, n in words.items() if 4 <= len(w) <= 24 and w.isalpha()]
        return [w.decode() for w, _ in plain], [n for _, n in plain]

    counts = docs.select("text").mapInArrow(work, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "secret-counts")
    pair = F.col("w").startswith(" ")
    pairs = np.zeros((256, 256), np.int64)
    for w, n in counts.where(pair).collect():  # 65,536 byte pairs at most
        pairs[divmod(int(w), 256)] = n
    top = frequent(counts.where(~pair), WORDS).collect()
    return [w for w, _ in sorted(top, key=lambda e: (-e[1], e[0]))], pairs


#: Digits, capitals, small letters, other ASCII and all else; hex digits.
KINDS = np.array([0 if chr(c).isdigit() else 1 if chr(c).isupper() else 2 if chr(c).islower() else 3 for c in range(128)] + [4])
HEX = np.array([chr(c) in string.hexdigits for c in range(128)] + [False])


class Features:
    """Turns candidates into vectors, given the corpus counts."""

    names = ("length", "digits", "upper", "lower", "other", "changes", "surprise", "entropy", "covered", "longest_word",
             "distinct", "hex", "assigned", "quoted", "named", "decoy", "path", "source_depth", "before_words", "symbols")

    def __init__(self, words: list[str], pairs: np.ndarray):
        self.words = words
        whole = pairs.sum(axis=1, keepdims=True)
        self.cost = -np.log((pairs + 0.1) / (whole + 25.6))
        self._build()

    def _build(self):
        self.reader = ahocorasick.Automaton()
        for w in self.words:
            self.reader.add_word(w, len(w))
        if self.words:
            self.reader.make_automaton()

    def __getstate__(self):
        return {"words": self.words, "cost": self.cost}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._build()

    def vector(self, value: str, before: str, after: str, rule: str, source: str | None) -> list[float]:
        n = len(value)
        points = np.minimum(np.frombuffer(value.encode("utf-32-le", "surrogatepass"), "<u4"), 128)
        kinds = KINDS[points]
        shares = np.bincount(kinds, minlength=5) / n
        tally = np.unique(np.frombuffer(value.encode("utf-32-le", "surrogatepass"), "<u4"), return_counts=True)[1] / n
        small = value.lower()
        raw = np.frombuffer(small.encode("utf-8", "replace"), np.uint8)
        surprise = float(self.cost[raw[:-1], raw[1:]].mean()) if len(raw) > 1 else 0.0
        known = [size for _, size in self.reader.iter_long(small)] if self.words else []
        near = [w.lower() for w in NEAR.findall(before[-CONTEXT:])][-3:]
        named = any(name in w for w in near for name in NAMES)
        in_path = before[-1:] in ("/", "\\") or after[:1] in ("/", "\\") or value.count("/") > 1 or bool(re.match(r"\.\w{1,5}\b", after))
        return [n, shares[0], shares[1], shares[2], shares[3] + shares[4],
                float(np.count_nonzero(kinds[1:] != kinds[:-1])) / max(1, n - 1), surprise, float(-(tally * np.log2(tally)).sum()),
                sum(known) / n, max(known, default=0), len(tally) / n, float(HEX[points].all()),
                float(rule != "run"), float(before[-1:] in ("'", '"')), float(named or rule == "url"), float(is_decoy(value)),
                float(in_path and rule != "url"), (source or "").count("/"), len(near), shares[3]]

    def rows(self, text: str, source: str | None, found: list[tuple[int, int, str]]) -> list[list[float]]:
        return [self.vector(text[a:b], text[max(0, a - CONTEXT):a], text[b:b + CONTEXT], rule, source) for a, b, rule in found]


class Forest:
    """Random forest of axis splits; leaves hold the share of secrets."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, seed: int = 0):
        self.size, self.depth, self.seed, self.trees = trees, depth, seed, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        for _ in range(self.size if len(x) else 0):
            own = rng.integers(0, len(x), len(x))
            self.trees.append(self._grow(x[own], y[own], self.depth, rng))
        return self

    def _grow(self, x, y, depth, rng):
        share = float(y.mean())
        if depth == 0 or len(y) < 4 or share in (0.0, 1.0):
            return share
        best, cut = share * (1 - share) * len(y) - 1e-9, None
        for f in rng.choice(x.shape[1], max(2, int(math.sqrt(x.shape[1]))), replace=False):
            low, high = x[:, f].min(), x[:, f].max()
            for t in rng.uniform(low, high, 8) if high > low else ():
                inside = x[:, f] <= t
                n, k = inside.sum(), y[inside].sum()
                m, j = len(y) - n, y.sum() - k
                if n and m:
                    impurity = k * (n - k) / n + j * (m - j) / m
                    if impurity < best:
                        best, cut = impurity, (int(f), float(t), inside)
        if cut is None:
            return share
        f, t, inside = cut
        return f, t, self._grow(x[inside], y[inside], depth - 1, rng), self._grow(x[~inside], y[~inside], depth - 1, rng)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Share of secrets, averaged over the trees; 0 without any training data."""
        out = np.zeros(len(x))

        def walk(node, index):
            if not len(index):
                return
            if isinstance(node, float):
                out[index] += node
                return
            inside = x[index, node[0]] <= node[1]
            walk(node[2], index[inside])
            walk(node[3], index[~inside])

        for tree in self.trees:
            walk(tree, np.arange(len(x)))
        return out / max(1, len(self.trees))


def rule_label(value: str, before: str, rule: str) -> int | None:
    """1 or 0 where the finding alone leaves no doubt, else None."""
    if rule == "block":
        return 1
    if is_decoy(value) or len(set(value)) <= 4:
        return 0
    has_digit, letters = any(c.isdigit() for c in value), [c for c in value if c.isalpha()]
    if has_digit and letters and (rule == "assigned" and len(value) >= 16 or rule == "url" and len(value) >= 8):
        return 1
    if rule == "run" and not has_digit and "".join(letters).strip("=") == value.replace("-", ""):
        return 0
    return None


def labelled_vectors(docs: DataFrame, features: Features, rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and labels of corpus findings that rules can label, at most ``rows`` of each label.

    Vectors are made in the tasks: no value leaves them.
    """
    own = tuned(docs.sparkSession).sparkContext.broadcast(features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, picks, vectors = [], [], []
            for source, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                for a, b, rule in candidates(text):
                    before = text[max(0, a - CONTEXT):a]
                    label = rule_label(text[a:b], before, rule)
                    if label is not None:
                        after = text[b:b + CONTEXT]
                        digest = hashlib.sha256(text_bytes("\0".join((text[a:b], before, after, source or "")))).digest()
                        labels.append(label)
                        picks.append(int.from_bytes(digest[:8], "big", signed=True))
                        vectors.append(own.value.vector(text[a:b], before, after, rule, source))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(picks, pa.int64()), pa.array(vectors, pa.list_(pa.float64()))],
                                             names=["label", "pick", "vector"])

    found = materialise(docs.select("source", "text").mapInArrow(work, "label int, pick long, vector array<double>"), "labelled")
    drawn = [r for label in (0, 1) for r in bounded_sample(found.where(F.col("label") == label), F.xxhash64("pick"), rows).collect()]
    drawn.sort(key=lambda r: (r["label"], r["pick"], r["vector"]))
    return (np.array([r["vector"] for r in drawn], float).reshape(-1, len(Features.names)), np.array([r["label"] for r in drawn], float))


def drawn_findings(words: list[str], n: int = 150, seed: int = 0) -> list[tuple]:
    """Seeded findings: keys in published formats (label 1) and common decoys (label 0), among corpus words."""
    rng = random.Random(seed)
    words = words or ["value", "local", "window", "number"]
    pick = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    word = lambda: rng.choice(words[:2000])
    alnum = string.ascii_letters + string.digits
    secrets = [
        lambda: (f'{rng.choice(NAMES)} = "', pick("0123456789abcdef", rng.choice((32, 40, 64))), '"', "assigned"),
        lambda: (f"{rng.choice(NAMES)}: ", pick(alnum + "+/", rng.choice((40, 43))), " ", "assigned"),
        lambda: (f"{word()} ", "AKIA" + pick(string.ascii_uppercase + string.digits, 16), " ", "run"),
        lambda: (f"{word()} ", rng.choice(("ghp_", "gho_")) + pick(alnum, 36), " ", "run"),
        lambda: (f"{word()} ", rng.choice(("sk_live_", "xoxb-")) + pick(alnum, 28), "\n", "run"),
        lambda: ("password=", pick(alnum + "!@#%", rng.randint(10, 18)), " ", "assigned"),
        lambda: (f"{rng.choice(('postgres', 'https', 'amqp', 'mysql'))}://{word()}:", pick(alnum + "!$", rng.randint(6, 20)), f"@{word()}.", "url"),
        lambda: (f"{word()} ", "-----BEGIN PRIVATE KEY-----" + "".join("\n" + pick(alnum + "+/", 64) for _ in range(rng.randint(1, 20))), "\n", "block")]
    decoys = [
        lambda: (f"{word()} ", "".join(word() for _ in range(4))[:30].ljust(16, "e"), " ", "run"),
        lambda: (f"{word()} ", "-".join(word() for _ in range(4)), ".", "run"),
        lambda: (f"/{word()}/", f"{word()}_{word()}_{word()}/{word()}", f".{word()[:3]}", "run"),
        lambda: (f"{rng.choice(NAMES)}: ", rng.choice(("your_api_key_here", "changeme123456", "<token-here>", "xxxxxxxxxxxxxxxx", "${SECRET_KEY}")), " ", "assigned"),
        lambda: (f"{rng.choice(NAMES)} = ", f"{word()}_{word()}", " ", "assigned"),
        lambda: (f"{word()} ", rng.choice("=-_") * rng.randint(16, 60), "\n", "run"),
        lambda: (f"{word()} ", pick(string.digits, rng.randint(16, 20)), " ", "run"),
        lambda: (f"https://{word()}:", rng.choice(("password", "secret", "***", "<password>", "${PASS}", "xxxxxx")), f"@{word()}.", "url")]
    out = []
    for label, makers in ((1, secrets), (0, decoys)):
        for make in makers:
            for _ in range(n):
                before, value, after, rule = make()
                out.append((value, before, after, rule, f"src{rng.randint(0, 30)}", label))
    return out


class Scanner:
    """Features and forest together."""

    def __init__(self, features: Features, forest: Forest, threshold: float = THRESHOLD):
        self.features, self.forest, self.threshold = features, forest, threshold

    def scan(self, text: str | None, source: str | None) -> list[tuple[int, int, str, float]]:
        found = candidates(text)
        if not found:
            return []
        scores = self.forest.predict(np.array(self.features.rows(text, source, found), float))
        return [(a, b, rule, float(s)) for (a, b, rule), s in zip(found, scores, strict=True)]


def vectors_of(findings: list[tuple], features: Features) -> tuple[np.ndarray, np.ndarray]:
    x = [features.vector(v, b, a, r, s) for v, b, a, r, s, _ in findings]
    return np.array(x, float).reshape(-1, len(Features.names)), np.array([f[5] for f in findings], float)


def train(findings: list[tuple], words: list[str], pairs: np.ndarray) -> Scanner:
    """A scanner trained from labelled findings ``(value, before, after, rule, source, label)``."""
    features = Features(words, pairs)
    return Scanner(features, Forest().fit(*vectors_of(findings, features)))


def fit(docs: DataFrame) -> Scanner:
    """A scanner trained from the findings of ``docs`` that rules can label, and drawn ones."""
    words, pairs = corpus_counts(docs)
    features = Features(words, pairs)
    x, y = zip(labelled_vectors(docs, features), vectors_of(drawn_findings(words), features), strict=True)
    return Scanner(features, Forest().fit(np.concatenate(x), np.concatenate(y)))


def findings(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """Every candidate of every document with the forest's score and verdict."""
    own = tuned(docs.sparkSession).sparkContext.broadcast(scanner or fit(docs))
    schema = "doc_id long, start long, length long, rule string, value_sha256 string, score double, is_secret boolean"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_()]
        names = ["doc_id", "start", "length", "rule", "value_sha256", "score", "is_secret"]
        for batch in batches:
            out = []
            for doc, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = text.as_py()
                for a, b, rule, s in own.value.scan(text, source):
                    out.append((doc, a, b - a, rule, hashlib.sha256(text_bytes(text[a:b])).hexdigest(), s, s >= own.value.threshold))
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.select(docs["doc_id"].cast("long"), "source", "text").mapInArrow(work, schema)


def redact(docs: DataFrame, scanner: Scanner | None = None, mark: str = MARK) -> DataFrame:
    """The documents with each found secret replaced by ``mark``; ``n_chars`` follows the text, all else stays."""
    own = tuned(docs.sparkSession).sparkContext.broadcast(scanner or fit(docs))

    def clean(text: str | None, source: str | None) -> str | None:
        if not text:
            return text
        parts, at = [], 0
        for a, b, _, s in own.value.scan(text, source):
            if s >= own.value.threshold:
                parts += [text[at:a], mark]
                at = b
        return "".join([*parts, text[at:]]) if parts else text

    @F.pandas_udf("string")
    def cleaned(texts, sources):
        return texts.combine(sources, clean) if len(texts) else texts

    out = docs.withColumn("text", cleaned("text", "source"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
