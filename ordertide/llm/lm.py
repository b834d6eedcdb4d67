"""Word bigram model by deleted interpolation.

p(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1), where ``b`` is the
bucket of the context's count c(v) (powers of two).  The weights of each bucket
come from expectation-maximisation: part of the training rows (``tune_rows``) is
deleted from the counts and its tokens are the held-out data.  The final counts
are those of all training rows.

Jobs
1. Rows become blocks of bounded bytes, written to the shared folder.
2. Each block asks for its distinct words and bigrams with its own counts
   (hashes sorted and stored as differences); a shuffle by hash range adds the
   counts up and answers each block.  A frequent bigram is one entry per block.
3. Each block bins the held-out tokens by their estimates; the bins (bounded by
   their resolution, not by the data) are summed and fitted on the driver.
4. Each block scores its rows.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow, text_bytes, work_dir, written

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20        # text per hash range of the counting shuffle
BINS = 8                      # bins per factor of two of an estimate
ROUNDS = 60
_START, _END = (xxhash.xxh64_intdigest(x) for x in (b"start of text", b"end of text"))  # no word holds a space


# ---- blocks --------------------------------------------------------------------

def _blocks(src: DataFrame) -> DataFrame:
    def run(batches):
        import zstandard
        held, size = [], 0

        def pack():
            t = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema) as w:
                w.write_table(t)
            return pa.RecordBatch.from_arrays([
                pa.array([random.SystemRandom().getrandbits(62)]), pa.array([size], pa.int64()),
                pa.array([zstandard.compress(sink.getvalue().to_pybytes(), 3)], pa.binary())], names=["block", "size", "rows"])

        for b in batches:
            start = 0
            for i, k in enumerate(pc.binary_length(b.column(3)).to_pylist()):
                size += k + 1
                if size >= BLOCK_BYTES:
                    held.append(b.slice(start, i + 1 - start))
                    yield pack()
                    held, size, start = [], 0, i + 1
            if start < b.num_rows:
                held.append(b.slice(start))
        if held:
            yield pack()

    return written(map_arrow(src, run, "block long, size long, rows binary"), "lm-blocks")


def _open(rows: bytes) -> pa.Table:
    import zstandard
    return pa.ipc.open_stream(zstandard.decompress(rows)).read_all()


class _Grams:
    """Tokens, distinct words and distinct bigrams of a block."""

    def __init__(self, t: pa.Table):
        words: dict[bytes, int] = {b" s": 0, b" e": 1}
        seq, n = [], []
        for text in t.column("text").to_pylist():
            own = text.lower().split()
            seq.append(np.array([0, *[words.setdefault(w, len(words)) for w in own], 1], np.int32))
            n.append(len(own) + 1)
        self.n = np.array(n, np.int64)                       # tokens of a row, its end included
        seq = np.concatenate(seq)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
        hashes[:2] = _START, _END
        order = np.argsort(hashes)
        self.words, rank = hashes[order], np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        seq = rank[seq]
        last = np.cumsum(self.n + 1) - 1
        is_context = np.ones(len(seq), bool)
        is_context[last] = False
        self.v = seq[:-1][is_context[:-1]]                   # context and word of each token
        self.w = seq[1:][is_context[:-1]]
        key = self.words[self.v] * np.uint64(0x9E3779B97F4A7C15) + self.words[self.w]
        for shift, mul in ((32, 0xD6E8FEB86659FD93), (29, 0x9FB21C651E98DF25)):
            key = (key ^ (key >> np.uint64(shift))) * np.uint64(mul)
        self.pairs, pair = np.unique(key ^ (key >> np.uint64(32)), return_inverse=True)
        self.pair = pair.astype(np.int32)
        self.starts = np.cumsum(self.n) - self.n
        self.start_rank = rank[0]

    def counts(self, flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word and bigram counts over the rows with ``flag``; starts count as context words."""
        of = np.repeat(flag, self.n)
        words = np.bincount(self.w[of], minlength=len(self.words))
        words[self.start_rank] = flag.sum()
        return words, np.bincount(self.pair[of], minlength=len(self.pairs))

    def per_row(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.starts) if len(self.starts) else x


# ---- counting ------------------------------------------------------------------

def _requests(blocks: DataFrame, ranges: int) -> DataFrame:
    shift = np.uint64(64 - ranges.bit_length() + 1)

    def run(batches):
        import zstandard
        for b in batches:
            for block, rows in zip(b.column(0).to_pylist(), b.column(2)):
                t = _open(rows.as_py())
                g, train = _Grams(t), t.column("train").to_numpy()
                tune = t.column("tune").to_numpy()
                for order, keys, all_n, tune_n in zip((1, 2), (g.words, g.pairs), g.counts(train), g.counts(tune)):
                    part = (keys >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(keys), np.int64)
                    cuts = np.searchsorted(part, np.arange(ranges + 1))
                    out = []
                    for r, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                        if s == e:
                            continue
                        gaps = np.diff(keys[s:e], prepend=np.uint64((r << int(shift)) if ranges > 1 else 0))
                        width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
                        packed = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
                        n = np.concatenate([all_n[s:e], tune_n[s:e]]).astype(np.int64)
                        out.append((order, r, block, e - s, width, packed, zstandard.compress(n.tobytes(), 1)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                        names=["order", "range", "block", "n", "width", "gaps", "counts"])

    return map_arrow(blocks, run, "order int, range long, block long, n long, width int, gaps binary, counts binary")


def _answers(requests: DataFrame, ranges: int) -> DataFrame:
    shift = 64 - ranges.bit_length() + 1

    def total(t: pa.Table) -> pa.Table:
        import zstandard
        keys, counts = [], []
        for r, n, width, gaps, c in zip(*(t.column(x).to_pylist() for x in ("range", "n", "width", "gaps", "counts"))):
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :width] = np.frombuffer(gaps, np.uint8).reshape(n, width)
            keys.append(np.cumsum(wide.view(np.uint64).ravel(), dtype=np.uint64) + np.uint64((r << shift) if ranges > 1 else 0))
            counts.append(np.frombuffer(zstandard.decompress(c), np.int64).reshape(2, n))
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        both = np.concatenate(counts, axis=1)
        sums = np.stack([np.bincount(at, weights=x, minlength=len(distinct)).astype(np.int64) for x in both])
        order = t.column("order")[0].as_py()
        word = distinct != np.uint64(_START)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        packed = [zstandard.compress(np.ascontiguousarray(sums[:, a]).tobytes(), 1) for a in np.split(at, cuts)]
        first = np.arange(len(keys)) == 0
        number = lambda x: pa.array(np.where(first & (order == 1), int(x), 0))
        return pa.table({
            "block": t.column("block"), "order": t.column("order"), "range": t.column("range"), "counts": packed,
            "types": number((sums[0][word] > 0).sum()), "tokens": number(sums[0][word].sum()),
            "tuned": number(sums[1][word].sum())})

    return requests.groupBy("order", "range").applyInArrow(
        total, "block long, order int, range long, counts binary, types long, tokens long, tuned long")


class _Answers:
    """Reads a block's answers from the written table: (words, pairs) x (training, tuning)."""

    def __init__(self, path: str):
        self.path = path

    def of(self, block: int):
        import zstandard
        from pyarrow.fs import FileSelector, FileSystem
        fs, root = FileSystem.from_uri(self.path)
        files = [f.path for f in fs.get_file_info(FileSelector(f"{root}/block={block}")) if f.path.endswith(".parquet")]
        t = pa.concat_tables([pq.ParquetFile(fs.open_input_file(f)).read(columns=["order", "range", "counts"]) for f in files])
        t = t.sort_by([("order", "ascending"), ("range", "ascending")])
        got = {1: [], 2: []}
        for o, c in zip(t.column("order").to_pylist(), t.column("counts").to_pylist()):
            got[o].append(np.frombuffer(zstandard.decompress(c), np.int64).reshape(2, -1))
        return np.concatenate(got[1], axis=1), np.concatenate(got[2], axis=1)


# ---- weights -------------------------------------------------------------------

def _bucket(c: np.ndarray) -> np.ndarray:
    return np.frexp(c.astype(np.float64))[1]       # 0 for 0, else the number of binary digits


def _bin(p: np.ndarray) -> np.ndarray:
    """Bin of a probability; -1 stands for zero."""
    out = np.full(len(p), -1, np.int64)
    out[p > 0] = np.rint(-np.log2(p[p > 0]) * BINS)
    return out


def _estimates(g: _Grams, words: np.ndarray, pairs: np.ndarray, n: int):
    """(context bucket, bigram estimate, word estimate) of each token."""
    cv, cw, c2 = words[g.v], words[g.w], pairs[g.pair]
    return _bucket(cv), c2 / np.maximum(cv, 1), cw / max(n, 1)


def fit_weights(bins: list[tuple[int, int, int, int]], types: int) -> np.ndarray:
    """Weights [bucket, (bigram, word, uniform)] from rows (bucket, bigram bin, word bin, tokens).

    Row 64 holds the weights fitted on all buckets together; buckets without
    held-out tokens get them too.  Without any, the weights are 0.5, 0.4 and 0.1
    (0, 0.9 and 0.1 in bucket 0, whose contexts were never seen)."""
    out = np.tile(np.array([0.5, 0.4, 0.1]), (65, 1))
    rows = np.array(bins, np.float64).reshape(-1, 4)
    p = np.stack([np.where(rows[:, k] < 0, 0, 2.0 ** (-rows[:, k] / BINS)) for k in (1, 2)] + [np.full(len(rows), 1 / (types + 1))], 1)

    def em(own):
        lam, n = np.array([0.5, 0.4, 0.1]), rows[own, 3]
        for _ in range(ROUNDS):
            part = p[own] * lam
            lam = (part / part.sum(1, keepdims=True) * n[:, None]).sum(0) / n.sum()
            lam = np.maximum(lam, 1e-6) / np.maximum(lam, 1e-6).sum()
        return lam

    if len(rows):
        out[:] = em(np.ones(len(rows), bool))
        for b in np.unique(rows[:, 0]).astype(int):
            out[b] = em(rows[:, 0] == b)
    out[0] = [0, *(out[0, 1:] / out[0, 1:].sum())]
    return out


# ---- the operator ----------------------------------------------------------------

def lm_scores(df: DataFrame, train_rows, tune_rows, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score): one row per input row.

    ``train_rows`` and ``tune_rows`` are boolean columns of ``df``; tuning rows are
    those training rows whose counts are deleted while the weights are learnt.
    Texts are lower-cased (A-Z), cut at ASCII white space and closed by one end
    token.  ``base_score`` is the add-one unigram score; ``score`` the model's log10
    probability of the text.

    Null and empty texts have only the end token; null ids and repeated rows are
    kept, each counting; null flags count as false.  Without training rows the
    estimates are uniform.  An empty table gives an empty result.  The answer files
    are read by tasks from the shared folder, which pyarrow must be able to open."""
    spark = df.sparkSession
    flag = lambda c: F.coalesce(c, F.lit(False))
    src = df.select(F.col(id_col).alias("id"), flag(train_rows).alias("train"),
                    (flag(train_rows) & flag(tune_rows)).alias("tune"),
                    text_bytes(F.col(text_col)).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    blocks = _blocks(src)
    ranges = 1 << max(2, math.ceil(math.log2(max(1, (blocks.agg(F.sum("size")).first()[0] or 0) / BUCKET_BYTES))))
    path = work_dir(spark, "lm-answers")
    answers = _answers(_requests(blocks, ranges), ranges)
    answers.repartition("block").write.partitionBy("block").parquet(path)
    back = spark.read.schema(answers.schema).parquet(path)
    types, tokens, tuned = (x or 0 for x in back.agg(F.sum("types"), F.sum("tokens"), F.sum("tuned")).first())
    uri = path if "://" in path else f"file://{path}" if path.startswith("/") else path.replace("file:/", "file:///", 1)

    def bins(batches):
        reader = _Answers(uri)
        for b in batches:
            for block, rows in zip(b.column(0).to_pylist(), b.column(2)):
                t = _open(rows.as_py())
                g, (words, pairs) = _Grams(t), reader.of(block)
                own = np.repeat(t.column("tune").to_numpy(), g.n)
                b0, p2, p1 = (x[own] for x in _estimates(g, words[0] - words[1], pairs[0] - pairs[1], tokens - tuned))
                key, n = np.unique(np.stack([b0, _bin(p2), _bin(p1)]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (*key, n)], names=["b", "p2", "p1", "n"])

    binned = map_arrow(blocks, bins, "b long, p2 long, p1 long, n long").groupBy("b", "p2", "p1").agg(F.sum("n").alias("n"))
    weights = fit_weights([tuple(r) for r in binned.collect()], types)

    def score(batches):
        reader = _Answers(uri)
        for b in batches:
            for block, rows in zip(b.column(0).to_pylist(), b.column(2)):
                t = _open(rows.as_py())
                g, (words, pairs) = _Grams(t), reader.of(block)
                b0, p2, p1 = _estimates(g, words[0], pairs[0], tokens)
                p = weights[b0, 0] * p2 + weights[b0, 1] * p1 + weights[b0, 2] / (types + 1)
                cw = words[0][g.w]
                yield pa.RecordBatch.from_arrays([
                    t.column("id").combine_chunks(), pa.array(g.n), pa.array(g.per_row((cw > 0).astype(np.int64))),
                    pa.array(np.full(len(g.n), tokens, np.int64)),
                    pa.array(g.per_row(np.log10((cw + 1) / (tokens + types + 1)))), pa.array(g.per_row(np.log10(p)))],
                    names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return map_arrow(blocks, score, f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
