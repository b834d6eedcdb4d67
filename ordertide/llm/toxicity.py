"""Toxicity by subword-bag embeddings under a linear softmax.

A word is the average of the embeddings of its character n-grams and of itself
(hashed), a text the weighted average of all its distinct words, wherever they stand; a
linear softmax stands on top.  Embeddings, softmax and the weights of words (the
exponential of a salience that n-grams share in the same way) are trained jointly in
numpy.  Unseen misspellings share n-grams with words that were seen.

The weights let a few words count in a long text without making length itself count:
texts of every length are learnt from, and in each epoch the clean ones also in
joins of 2 to 256 texts, which stay clean (shorter joins also with a toxic text, and
toxic then).  N-grams that were never seen have no say.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import Memo, forget, prepare, text_bytes

BUCKETS = 1 << 16
DIMS = 8
GRAMS = (3, 4, 5)
PER_CLASS = 2_000         # labelled rows of each class to learn from
EPOCHS, BATCH, RATE = 6, 64, 0.1
BATCH_WORDS = 30_000      # of the texts of a training step
SCALE = 10.0              # of saliences against their steps
JOINED, MIXED = 256, 8    # most clean texts in a join, and beside a toxic one
_EDGE = string.punctuation
_PART = 20_000            # words hashed at a time
_ROWS = 250               # texts whose words are held at a time


def words(text: str) -> list[str]:
    """Distinct lower-cased words without punctuation at their ends, as first met."""
    return [w for w in dict.fromkeys(x.strip(_EDGE) for x in text.lower().split()) if w]


def described(text: str) -> str:
    """What the model learns from a text: its distinct words, a line each."""
    return "\n".join(words(text))


def subwords(ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of the n-grams of ``<word>`` and of the word itself."""
    n = np.fromiter(map(len, ws), np.int64, len(ws)) + 2
    points = np.frombuffer("".join([f"<{w}>" for w in ws]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    of, end = np.repeat(np.arange(len(ws)), n), np.repeat(np.cumsum(n), n)
    owner = [np.arange(len(ws))]
    bucket = [np.fromiter((xxhash.xxh32_intdigest(w) for w in ws), np.uint64, len(ws))]
    for k in GRAMS:
        m = len(points) - k + 1
        if m <= 0:
            continue
        h = np.full(m, k, np.uint64)
        for j in range(k):
            h = (h ^ points[j:m + j]) * np.uint64(0x100000001B3)
        own = np.arange(m) + k <= end[:m]
        owner.append(of[:m][own])
        bucket.append((h ^ (h >> np.uint64(29)))[own])
    return np.concatenate(owner), (np.concatenate(bucket) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    gain: np.ndarray      # logit of each bucket's embedding
    salience: np.ndarray
    seen: np.ndarray      # buckets that were learnt
    bias: float

    def word_values(self, ws: list[str]) -> list[tuple[float, float]]:
        """(logit, salience) of each word; a word without a learnt n-gram has no weight."""
        out = []
        for i in range(0, len(ws), _PART):
            part = ws[i:i + _PART]
            owner, bucket = subwords(part)
            n = np.bincount(owner, self.seen[bucket], len(part))
            logit, salience = (np.bincount(owner, v[bucket], len(part)) / np.maximum(n, 1) for v in (self.gain, self.salience))
            out += zip(logit.tolist(), np.where(n > 0, salience, -np.inf).tolist())
        return out

    def score(self, values: list[tuple[float, float]]) -> float:
        """Probability for the word values of a text."""
        z = self.bias
        if values:
            logit, salience = np.array(values).T
            top = salience.max()
            if top > -np.inf:
                a = np.exp(salience - top)
                z += a @ logit / a.sum()
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)


def _examples(rng, clean: list[np.ndarray], toxic: list[np.ndarray]) -> list[tuple[np.ndarray, int]]:
    """The texts of an epoch (distinct words, label), in random order: all of them, and joins."""
    out = [(d, 0) for d in clean] + [(d, 1) for d in toxic]
    turn, at, k = rng.permutation(len(clean)), 0, 2
    while at < len(turn):
        own = [clean[i] for i in turn[at:at + k]]
        out.append((np.unique(np.concatenate(own)), 0))
        if k <= MIXED:
            out.append((np.unique(np.concatenate([*own, toxic[rng.integers(len(toxic))]])), 1))
        at, k = at + k, k * 2 if k < JOINED else 2
    return [out[i] for i in rng.permutation(len(out))]


def _batches(texts: list[tuple[np.ndarray, int]]):
    """At most ``BATCH`` texts of about ``BATCH_WORDS`` words together (or one longer text)."""
    own, held = [], 0
    for t in texts:
        own.append(t)
        held += len(t[0])
        if len(own) == BATCH or held >= BATCH_WORDS:
            yield own
            own, held = [], 0
    if own:
        yield own


def _tables(vocab: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' n-grams, word by word, and their number."""
    buckets, counts = [], []
    for i in range(0, len(vocab), _PART):
        part = vocab[i:i + _PART]
        owner, bucket = subwords(part)
        buckets.append(bucket[np.argsort(owner, kind="stable")].astype(np.int32))
        counts.append(np.bincount(owner, minlength=len(part)))
    return np.concatenate(buckets), np.concatenate(counts)


def fit(sample: list[tuple[str, int]], seed: int = 1) -> Model:
    """Train on (text or its words, label) pairs; without both labels the model scores all
    texts alike (0.5 without any, else near the only label)."""
    rng = np.random.default_rng(seed)
    index: dict[str, int] = {}
    docs: tuple[list, list] = ([], [])
    for t, y in sample:
        own = [index.setdefault(w, len(index)) for w in words(t)]
        if own:
            docs[y].append(np.array(own, np.int64))
    n_docs = len(docs[0]) + len(docs[1])
    if not (docs[0] and docs[1]):
        none = np.zeros(BUCKETS)
        return Model(none, none, none > 0, 0.0 if not n_docs else (5.0 if docs[1] else -5.0))
    bucket, n_sub = _tables(list(index))
    index.clear()
    first = np.cumsum(n_sub) - n_sub
    emb, soft, bias = rng.uniform(-1 / DIMS, 1 / DIMS, (BUCKETS, DIMS)), rng.uniform(-0.5, 0.5, DIMS), np.zeros(1)
    salience = np.zeros(BUCKETS)
    squares = {k: np.full(v.shape, 1e-8) for k, v in (("emb", emb), ("soft", soft), ("bias", bias), ("salience", salience))}
    weight = np.array([0.5 * n_docs / len(docs[0]), 0.5 * n_docs / len(docs[1])])

    def step(name, value, at, slope):
        seen = squares[name]
        seen[at] += slope * slope
        value[at] -= RATE * slope / np.sqrt(seen[at])

    for _ in range(EPOCHS):
        texts = _examples(rng, *docs)
        for own in _batches(texts):
            m, y = len(own), np.array([v for _, v in own])
            n = np.array([len(d) for d, _ in own])
            row = np.repeat(np.arange(m), n)
            used, word = np.unique(np.concatenate([d for d, _ in own]), return_inverse=True)
            gain, logit, weight_of = emb @ soft, np.empty(len(used)), np.empty(len(used))
            for part in (slice(i, i + _PART) for i in range(0, len(used), _PART)):
                k = n_sub[used[part]]
                col, start = bucket[_ranges(first[used[part]], k)], np.cumsum(k) - k
                logit[part] = np.add.reduceat(gain[col], start) / k
                weight_of[part] = SCALE * np.add.reduceat(salience[col], start) / k
            s = weight_of[word]
            a = np.exp(s - np.maximum.reduceat(s, np.cumsum(n) - n)[row])
            a /= np.bincount(row, a, m)[row]
            mean = np.bincount(row, a * logit[word], m)
            # the softmax of two classes: the slope of its loss by the difference of the logits
            dz = (1 / (1 + np.exp(-np.clip(mean + bias, -500, 500))) - y) * weight[y] / m
            d_logit = np.bincount(word, dz[row] * a, len(used))
            d_weight = SCALE * np.bincount(word, dz[row] * a * (logit[word] - mean[row]), len(used))
            d_gain, d_salience, met = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(BUCKETS, bool)
            for part in (slice(i, i + _PART) for i in range(0, len(used), _PART)):
                k = n_sub[used[part]]
                col = bucket[_ranges(first[used[part]], k)]
                d_gain += np.bincount(col, np.repeat(d_logit[part] / k, k), BUCKETS)
                d_salience += np.bincount(col, np.repeat(d_weight[part] / k, k), BUCKETS)
                met[col] = True
            cols = np.flatnonzero(met)
            d_emb, d_soft = np.outer(d_gain[cols], soft), emb[cols].T @ d_gain[cols]
            step("emb", emb, cols, d_emb)
            step("salience", salience, cols, d_salience[cols])
            step("soft", soft, ..., d_soft)
            step("bias", bias, ..., np.array([dz.sum()]))
    seen = np.zeros(BUCKETS, bool)
    seen[bucket] = True
    return Model(np.where(seen, emb @ soft, 0.0), np.where(seen, SCALE * salience, 0.0), seen, float(bias[0]))


def toxicity_scores(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.5, keep_columns: bool = False) -> DataFrame:
    """(id, score, predicted): one row per input row; with ``keep_columns`` the input's
    columns too, the new ones then named ``toxic_score`` and ``toxic_predicted`` (they
    replace columns of these names).

    ``score`` is from 0 to 1, ``predicted`` 1 from ``threshold`` on.  Null and empty
    texts score as the bias alone; null ids and repeated rows are kept; an empty
    table gives an empty result."""
    memo_size = 100_000

    def logits(texts: list[str], memo: Memo) -> list[float]:
        split = [words(t) for t in texts]
        of = memo.known((w for x in split for w in x), model.word_values)
        return [model.score([of[w] for w in x]) for x in split]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        memo = Memo(memo_size)
        for b in batches:
            out = []
            for at in range(0, len(b), _ROWS):
                out += logits([t.decode("utf-8", "replace") for t in b.slice(at, _ROWS).to_pylist()], memo)
            yield pa.array(out, pa.float64())

    prepare(df.sparkSession)
    # only the text travels to Python, and only the score back
    score = F.arrow_udf(run, returnType="double")(text_bytes(df[f"`{text_col}`"]))
    kept, names = [df[f"`{id_col}`"].alias("id")], ("score", "predicted")
    if keep_columns:
        names = ("toxic_score", "toxic_predicted")
        kept = [df[f"`{c}`"] for c in df.columns if c not in names]
    return df.select(*kept, score.alias(names[0])).withColumn(names[1], (F.col(names[0]) >= threshold).cast("int"))
