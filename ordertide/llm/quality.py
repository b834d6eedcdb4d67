"""Document quality by a factorisation machine.

Features are hashed words, structure statistics and metadata (lengths) of the
text.  Pairwise interactions have rank ``RANK``; with the sum-of-squares identity
a text is scored in time linear in its features:
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import Memo, map_arrow, text_bytes

BUCKETS = 1 << 13
RANK = 6
PER_CLASS = 2_500         # labelled rows of each class to learn from
EPOCHS, BATCH, RATE, DECAY = 15, 64, 0.1, 1e-4
_KINDS = [b"#*$%&|<>", b"!?", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:", b"()[]{}=\"'/\\_-+@"]
_PRIOR = 4                # words added to each ratio's base, so that short texts aren't extreme


def statistics(text: str, ws: list[str]) -> list[float]:
    """Structure and length statistics of a text and its words."""
    n, chars, lines = len(ws), len(text), text.split("\n")
    full = [x.strip() for x in lines if x.strip()]
    base = n + _PRIOR
    raw = text.encode("utf-8", "surrogatepass")
    shares = [(len(raw) - len(raw.translate(None, kind))) / (chars + 5 * _PRIOR) for kind in _KINDS]
    tail = sum([w[-1] in "#*$%&|<>!" for w in ws])
    same = sum([a == b for a, b in zip(ws, ws[1:])])
    distinct = len(set(ws))
    pairs = len(set(zip(ws, ws[1:])))
    return [np.log1p(n), np.log1p(chars), sum(map(len, ws)) / base, *shares, tail / base, same / base,
            (n - distinct) / base, (n - 1 - pairs) / base if n else 0.0, np.log1p(len(full)), (len(full) - len(set(full))) / (len(full) + 1),
            n / (len(full) + 1), max(map(len, full), default=0) / (chars + 1), sum([len(w) > 15 for w in ws]) / base,
            sum([len(w) == 1 for w in ws]) / base, (chars - sum(map(len, ws))) / (chars + 1), float(n < 20), float(n < 50)]


N_STATS = len(statistics("", []))


@dataclass
class Model:
    w0: float
    w: np.ndarray             # BUCKETS hashed words, then the statistics
    v: np.ndarray             # their factors
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, bags: list[list[int]], stats: np.ndarray) -> np.ndarray:
        """Scores of texts given as the buckets of their words and their statistics: one sparse
        product for all of them."""
        m = len(bags)
        z = np.clip((stats - self.mean) / self.scale, -4, 4)
        row = np.repeat(np.arange(m), np.fromiter(map(len, bags), np.int64, m))
        at, n = np.unique(row * BUCKETS + np.array([b for x in bags for b in x], np.int64), return_counts=True)
        row, col = at // BUCKETS, at % BUCKETS
        x = np.sqrt(n / np.bincount(row, n, m)[row])
        v = self.v[col] * x[:, None]
        total = np.stack([np.bincount(row, v[:, f], m) for f in range(RANK)], 1) + z @ self.v[BUCKETS:]
        squares = np.bincount(row, (v ** 2).sum(1), m) + z ** 2 @ (self.v[BUCKETS:] ** 2).sum(1)
        out = self.w0 + np.bincount(row, self.w[col] * x, m) + z @ self.w[BUCKETS:] + 0.5 * ((total ** 2).sum(1) - squares)
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _bucket(w: str) -> int:
    return xxhash.xxh32_intdigest(w.lower()) % BUCKETS


def bag(buckets: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their values: root counts scaled to length one."""
    at, n = np.unique(np.array(buckets, np.int64), return_counts=True)
    x = np.sqrt(n)
    return at, x / np.sqrt((x * x).sum()) if len(x) else x


FEATURES = "struct<at:array<long>,x:array<double>,stats:array<double>>"


def features(text: str) -> tuple[list[int], list[float], list[float]]:
    """What the model learns from a text: at most ``BUCKETS`` buckets with values, and statistics."""
    ws = text.split()
    at, x = bag([_bucket(w) for w in ws])
    return at.tolist(), x.tolist(), [float(v) for v in statistics(text, ws)]


def fit(sample: list[tuple], seed: int = 1) -> Model:
    """Train on (text or its features, label) pairs with equal weight of both classes.  Without both
    labels all texts score alike (0.5 without any, else near the only label)."""
    rng = np.random.default_rng(seed)
    size = BUCKETS + N_STATS
    model = Model(0.0, np.zeros(size), np.zeros((size, RANK)), np.zeros(N_STATS), np.ones(N_STATS))
    ys = np.array([y for _, y in sample], np.float64)
    if len(set(ys.tolist())) < 2:
        model.w0 = 0.0 if not len(ys) else (5.0 if ys[0] else -5.0)
        return model
    known = [features(t) if isinstance(t, str) else t for t, _ in sample]
    stats = np.array([s for _, _, s in known])
    model.mean, model.scale = stats.mean(0), np.maximum(stats.std(0), 1e-9)
    z = np.clip((stats - model.mean) / model.scale, -4, 4)
    bags = [(np.array(at, np.int64), np.array(x, np.float64)) for at, x, _ in known]
    weight = np.where(ys == 1, 0.5 / (ys == 1).mean(), 0.5 / (ys == 0).mean())
    model.v = rng.normal(0, 0.05, (size, RANK))
    g0, gw, gv = 1e-8, np.full(size, 1e-8), np.full((size, RANK), 1e-8)
    for _ in range(EPOCHS):
        turn = rng.permutation(len(sample))
        for s in range(0, len(turn), BATCH):
            own = turn[s:s + BATCH]
            m = len(own)
            n = np.array([len(bags[i][0]) for i in own])
            row = np.concatenate([np.repeat(np.arange(m), n), np.repeat(np.arange(m), N_STATS)])
            col = np.concatenate([*[bags[i][0] for i in own], np.tile(np.arange(BUCKETS, size), m)])
            x = np.concatenate([*[bags[i][1] for i in own], z[own].ravel()])
            vx = model.v[col] * x[:, None]
            total = np.stack([np.bincount(row, vx[:, f], m) for f in range(RANK)], 1)
            squares = np.bincount(row, (vx ** 2).sum(1), m)
            out = model.w0 + np.bincount(row, model.w[col] * x, m) + 0.5 * ((total ** 2).sum(1) - squares)
            err = (1 / (1 + np.exp(-np.clip(out, -50, 50))) - ys[own]) * weight[own] / m
            used, back = np.unique(col, return_inverse=True)
            dw = np.bincount(back, err[row] * x, len(used)) + DECAY * model.w[used]
            dv = np.stack([np.bincount(back, err[row] * x * (total[row, f] - vx[:, f]), len(used)) for f in range(RANK)], 1) + DECAY * model.v[used]
            g0 += err.sum() ** 2
            model.w0 -= RATE * err.sum() / np.sqrt(g0)
            gw[used] += dw * dw
            model.w[used] -= RATE * dw / np.sqrt(gw[used])
            gv[used] += dv * dv
            model.v[used] -= RATE * dv / np.sqrt(gv[used])
    return model


def quality_scores(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.3) -> DataFrame:
    """(id, score, predicted): one row per input row; ``score`` from 0 to 1,
    ``predicted`` 1 from ``threshold`` on.  Null counts as empty text, which has
    statistics only; null ids and repeated rows are kept; an empty table gives an
    empty result."""
    memo_size = 300_000

    def run(batches):
        memo = Memo(memo_size)
        for b in batches:
            for at in range(0, b.num_rows, 250):
                part = b.slice(at, 250)
                texts = [t.decode("utf-8", "replace") for t in part.column(1).to_pylist()]
                split = [t.split() for t in texts]
                of = memo.known((w for x in split for w in x), lambda new: [_bucket(w) for w in new])
                s = model.scores([[of[w] for w in ws] for ws in split], np.array([statistics(t, ws) for t, ws in zip(texts, split)]).reshape(-1, N_STATS))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64()), pa.array(s >= threshold).cast(pa.int32())],
                                                 names=["id", "score", "predicted"])

    src = df.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("text"))
    return map_arrow(src, run, f"id {src.schema['id'].dataType.simpleString()}, score double, predicted int")
