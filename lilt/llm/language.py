"""Language identification: averaged hashed subword embeddings with a linear softmax.

A document is the mean of the embeddings of all its subwords (one to four bytes of each word and the word itself, hashed to
a fixed number of buckets); a linear layer and a softmax give a language. Embeddings and layer are trained by stochastic
gradient descent in numpy on a sample of labelled rows, bounded for each language. A part of the sample is held back to set the softmax
temperature and the confidence below which a document is rejected.

Since everything after the hashing is linear, the trained model is one table of logits by bucket, and a word's part of a
document's logits is remembered by the task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lilt.llm.common import append_columns, bounded_batches

#: Predicted for a text without a letter.
UNDETERMINED = "und"
#: Words remembered by a task before its memo is emptied, the longest one remembered, documents looked at together.
MEMO_WORDS, MEMO_CHARS, DOCS = 150_000, 64, 64


def letters_of(word: str) -> bytes:
    """A word's letters in lower case, as UTF-8; empty without a letter."""
    return (word if word.isalpha() else "".join(filter(str.isalpha, word))).lower().encode(errors="replace")


def subwords(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of some words, none empty, and which word each is of.

    Subwords are the runs of one to four bytes of a word between marks, and the whole word.
    """
    text = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    found, owners = [np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets], [np.arange(len(words))]
    code = np.zeros(len(text), np.uint64)
    for n in range(1, 5):
        code = (code[: len(text) - n + 1] << np.uint64(8)) | text[n - 1 :]
        inside = owner[: len(code)] == owner[n - 1 :]
        mixed = (code[inside] + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        found.append((mixed % np.uint64(buckets)).astype(np.int64))
        owners.append(owner[: len(code)][inside])
    return np.concatenate(found), np.concatenate(owners)


@dataclass(frozen=True)
class Model:
    """languages, their logits by bucket, bias, temperature and rejection threshold."""

    languages: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


class WordLogits:
    """word -> row of a growing table of summed logits and subword counts; words with the same letters share a row."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.empty()

    def empty(self) -> None:
        self.memo: dict[str, int] = {}
        self.rows: dict[bytes, int] = {b"": 0}
        self.used = 1
        self.table = np.zeros((4096, len(self.model.languages) + 1))

    def learn(self, words: list[str]) -> None:
        """Adds rows for the letters of new words."""
        letters = list(map(letters_of, words))
        new = list({x for x in letters if x not in self.rows})
        if new:
            first, k = self.used, len(self.model.languages)
            self.used += len(new)
            self.rows.update(zip(new, range(first, self.used), strict=True))
            while len(self.table) < self.used:
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            found, owner = subwords(new, len(self.model.logits))
            part = self.table[first : first + len(new)]
            for c in range(k):
                part[:, c] = np.bincount(owner, self.model.logits[found, c], len(new))
            part[:, k] = np.bincount(owner, minlength=len(new))
        self.memo.update(zip(words, map(self.rows.__getitem__, letters), strict=True))

    def of(self, texts: list[str | None]) -> np.ndarray:
        """Summed logits and subword count of each whole text, in rows."""
        out = np.zeros((len(texts), self.table.shape[1]))
        for at in range(0, len(texts), DOCS):
            split = [t.split() if t else [] for t in texts[at : at + DOCS]]
            new = list(set().union(*split).difference(self.memo))
            self.learn(new)
            for i, words in enumerate(split):
                if words:
                    out[at + i] = self.table[list(map(self.memo.__getitem__, words))].sum(axis=0)
            for w in (w for w in new if len(w) > MEMO_CHARS):
                del self.memo[w]
                self.rows.pop(letters_of(w), None)
            self.rows[b""] = 0
            if self.used > MEMO_WORDS or len(self.memo) > MEMO_WORDS:
                self.empty()
        return out


def _features(buckets: int):
    """Kernel: the distinct buckets of a text (steps from one to the next) and how often each occurs, compressed."""

    def make():
        def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
            packed = []
            for text in batch.column("text").to_pylist():
                counts, words = np.zeros(buckets, np.int64), Counter((text or "").split())
                letters = [(x, n) for w, n in words.items() if (x := letters_of(w))]
                if letters:
                    found, owner = subwords([x for x, _ in letters], buckets)
                    counts += np.bincount(found, np.array([n for _, n in letters])[owner], buckets).astype(np.int64)
                at = np.flatnonzero(counts)
                packed.append(zlib.compress(np.concatenate([np.diff(at, prepend=0), counts[at]]).astype("<i4").tobytes(), 1))
            return [pa.array(packed, pa.binary())]

        return kernel

    return make


class Vectors:
    """Mean subword vectors, kept by their buckets that aren't 0; x[rows] is a dense array of some of them."""

    def __init__(self, packed: list[bytes], buckets: int) -> None:
        self.shape, self.parts, narrow = (len(packed), buckets), [], np.min_scalar_type(buckets)
        for p in packed:
            steps, counts = np.frombuffer(zlib.decompress(p), "<i4").reshape(2, -1)
            self.parts.append((steps.cumsum().astype(narrow), (counts / max(counts.sum(dtype=np.int64), 1)).astype(np.float32)))

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.shape[1]), np.float32)
        for i, r in enumerate(rows):
            at, share = self.parts[r]
            out[i, at] = share
        return out


def sample_features(labelled: DataFrame, max_docs: int, buckets: int) -> tuple[list[str], Vectors]:
    """Labels and mean subword vectors of a sample of at most max_docs rows of each lang of (doc_id, text, lang).

    The sample is bounded by max_docs a lang, and what the driver gets of a row by the number of buckets, whatever its text's
    length. Rows are picked by a hash of their id, so reruns agree. A bound on the hash keeps half as many rows of a lang again
    as are wanted; where that leaves too few (many rows share an id), the lang's rows are taken in order of the hash alone.
    """
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    bounds = [(lang, min(int(1.5 * max_docs / n * 2**63), 2**63 - 1)) for lang, n in sizes.items()]
    below = F.broadcast(labelled.sparkSession.createDataFrame(bounds, "lang string, _bound long"))
    hashed = labelled.withColumn("_pick", F.shiftrightunsigned(F.xxhash64(F.lit("language"), "doc_id"), 1))
    order = ["_pick", "doc_id", F.xxhash64("text")]
    first = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    found = _collect(hashed.join(below, "lang").where("_pick <= _bound").withColumn("_n", first).where(F.col("_n") <= max_docs), buckets)
    got = Counter(r["lang"] for r in found)
    for lang in (x for x, n in sizes.items() if got[x] < min(max_docs, n)):
        found = [r for r in found if r["lang"] != lang] + _collect(hashed.where(F.col("lang") == lang).orderBy(*order).limit(max_docs), buckets)
    found.sort(key=lambda r: (r["doc_id"], r["lang"], r["_packed"]))
    return [r["lang"] for r in found], Vectors([r["_packed"] for r in found], buckets)


def _collect(picked: DataFrame, buckets: int) -> list:
    packed = append_columns(picked.select("doc_id", "lang", "text"), _features(buckets), [T.StructField("_packed", T.BinaryType())])
    return packed.select("doc_id", "lang", "_packed").collect()


def fit(labels: list[str], x: np.ndarray | Vectors, dims: int = 16, epochs: int = 30, rate: float = 40.0, batch: int = 16, calibrate: float = 0.2, reject: float = 0.001, most: float = 0.5, seed: int = 7) -> Model:
    """Trains by stochastic gradient descent and calibrates on a part held back from training.

    The temperature is the one of a fixed grid with the least log loss on that part. The threshold is the confidence that
    a share ``reject`` of the rightly predicted rows there falls short of, at most ``most``. Without labels the model has
    no language; with one it predicts it.
    """
    languages = tuple(sorted(set(labels)))
    buckets, k = x.shape[1], max(len(languages), 1)
    if len(languages) < 2:
        return Model(languages or (UNDETERMINED,), np.zeros((buckets, k)), np.zeros(k))
    rng = np.random.default_rng(seed)
    y = np.searchsorted(np.array(languages), labels)
    order = rng.permutation(len(y))
    held = order[: int(len(y) * calibrate)]
    train = order[len(held) :]
    e = rng.uniform(-0.5, 0.5, (buckets, dims)).astype(np.float32)
    w = rng.uniform(-0.5, 0.5, (dims, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    steps, done = epochs * -(-len(train) // batch), 0
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), batch):
            rows = train[at : at + batch]
            some = x[rows]
            used = np.flatnonzero(some.any(axis=0))
            some = some[:, used]
            h = some @ e[used]
            z = h @ w + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            now = rate * (1 - done / steps)
            grad_h = p @ w.T
            w -= 0.02 * now * (h.T @ p)
            bias -= 0.02 * now * p.sum(axis=0)
            e[used] -= now * (some.T @ grad_h)
            done += 1
    model = Model(languages, (e @ w).astype(np.float64), bias.astype(np.float64))
    if not len(held):
        return model
    sums = np.concatenate([x[held[at : at + DOCS]].astype(np.float64) @ model.logits for at in range(0, len(held), DOCS)])
    z, best = sums + model.bias, (np.inf, 1.0)
    for temperature in np.geomspace(0.25, 8, 41):
        p = z / temperature
        p = p - p.max(axis=1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(p).sum(axis=1)) - p[np.arange(len(held)), y[held]]))
        best = min(best, (loss, float(temperature)))
    model = Model(languages, model.logits, model.bias, best[1])
    p = model.probabilities(sums, np.ones(len(held)))
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y[held]])
    threshold = min(most, float(right[int(reject * len(right))])) if len(right) else 0.0
    return Model(languages, model.logits, model.bias, best[1], threshold)


def train(docs: DataFrame, max_docs: int = 2000, buckets: int = 8192) -> Model:
    """A model from (doc_id, text, lang): labelled rows whose crc32(doc_id as text) mod 4 isn't 2.

    Rows with a null text, lang or id don't take part. max_docs bounds the sample's rows of each lang, buckets their size.
    """
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    return fit(*sample_features(labelled, max_docs, buckets))


def held_out(id_col: str):
    """True for rows that no model learns from; true for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, model: Model, text_col: str = "text", only: list[str] | None = None) -> DataFrame:
    """docs with ``lang_pred`` (string), ``score`` (double, calibrated probability) and ``rejected`` (boolean).

    The whole text counts, and nothing but the text. Null texts and texts without a letter get ``und`` with score 0 and
    are rejected; others get the likeliest language and are rejected if its probability is below the model's threshold.
    Input columns named like the new ones are replaced.
    """
    bounded_batches(docs.sparkSession)

    def make():
        words = WordLogits(model)

        def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
            totals = words.of(batch.column(text_col).to_pylist())
            p = model.probabilities(totals[:, :-1], totals[:, -1])
            known = totals[:, -1] > 0
            top = p.argmax(axis=1)
            score = np.where(known, p.max(axis=1), 0.0)
            names = [model.languages[i] if ok else UNDETERMINED for i, ok in zip(top, known, strict=True)]
            return [pa.array(names), pa.array(score), pa.array(~known | (score < model.threshold))]

        return kernel

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return append_columns(docs, make, fields, only)
