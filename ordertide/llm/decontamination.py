"""Benchmark decontamination by edit distance.

The CGK embedding is a random walk over a text: at each step it writes the
character it stands on and a random bit, fixed per step and character, decides
whether it moves on.  Walks from texts at a small edit distance soon meet again,
so a small edit distance becomes a small Hamming distance.  Bit-sampling LSH then
keeps ``SAMPLED`` of the written characters as a key.

Windows of an item's size are covered by anchors: at every word of the items, and at
every word or every other word of the documents; items under 24 bytes take every byte
of both.  Each anchor inside a window that holds an item is a chance for each of the
repetitions.  Steps, walks, draws and strides are set for each length class so that at
``MAX_EDITS`` random edits at least 0.9 of the items are found (``CLASSES``; measured in
the tests).  Items under 8 bytes are looked for everywhere.

Equal keys give candidates (document, item, alignment).  The distances of an item's
pieces of 64 bytes to their windows add up to at most the distance of the item, so most
candidates are ruled out by pieces, many at a time; what is left is verified by the exact
edit distance of the item to its best match around the alignment.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow, text_bytes, work_dir, written

STEPS = 64                # padding: no walk is longer
#: (least item length, steps of a walk, walks, keys drawn from each, steps sampled by a key, anchor stride;
#: a stride in words, or 0: every byte).  A walk covers about half as many characters as it has steps.
CLASSES = ((80, 40, 8, 2, 12, 2), (48, 32, 8, 2, 10, 1), (24, 16, 8, 2, 8, 1), (8, 8, 8, 1, 4, 0))
MAX_EDITS = 0.2           # of the item's length
ITEM_BLOCK_BYTES = 8 << 20
_CHUNK = 1 << 13          # anchors embedded at a time
_WAITING = 1 << 15        # candidates gathered before they are compared
_VERIFIED = 1 << 13       # candidates compared at a time
_FEW = 32                 # candidates that are compared faster one by one
_TABLE_BITS = 20          # at most


def normal(text: bytes) -> bytes:
    """Lower-case (A-Z), white space runs as one space, none at the ends."""
    return b" ".join(text.lower().split())


@functools.cache
def _random(walk: int, steps: int, samples: int, sampled: int) -> tuple[np.ndarray, list[list[int]]]:
    """By step and character: the term that the step adds to a key, with the move as its lowest
    bit; and the keys that sample each step."""
    rng = np.random.default_rng(1000 + walk)
    moves = rng.integers(0, 2, (STEPS, 256), dtype=np.int64)
    drawn = [rng.choice(steps, sampled, replace=False) for _ in range(samples)]
    factor = (rng.integers(1, 1 << 62, STEPS) * 2 + 1).astype(np.uint64)
    terms = np.arange(1, 257, dtype=np.uint64) * factor[:, None]
    return (terms << np.uint64(1)).view(np.int64) | moves, [[z for z in range(samples) if j in drawn[z]] for j in range(max(map(max, drawn)) + 1)]


def embed(data: np.ndarray, at: np.ndarray, steps: int, walks: int, samples: int, sampled: int) -> list[np.ndarray]:
    """Keys of the walks that start at the positions ``at`` (ascending); one array per
    repetition.  ``data`` is a byte array that ends with ``STEPS`` zeros."""
    out = []
    if not len(at):
        return [np.zeros(0, np.uint64)] * (walks * samples)
    data, at = data[at[0]:at[-1] + STEPS].astype(np.int64), at - at[0]
    begun = data.take(at)                     # the first step is the same in all walks
    c, both, move = (np.empty(len(at), np.int64) for _ in range(3))
    for walk in range(walks):
        table, own = _random(walk, steps, samples, sampled)
        keys = [np.zeros(len(at), np.int64) for _ in range(samples)]
        pos = at.copy()
        for j, zs in enumerate(own):
            if j:
                data.take(pos, out=c, mode="clip")
            table[j].take(c if j else begun, out=both, mode="clip")
            if j < len(own) - 1:
                np.bitwise_and(both, 1, out=move)
                pos += move
            for z in zs:
                keys[z] += both               # with its move, which the step and the character fix
        keys = [k.view(np.uint64) for k in keys]
        for k in keys:
            k ^= k >> np.uint64(31)
            k *= np.uint64(0x9E3779B97F4A7C15)
            out.append(k)
    return out


def _padded(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The parts joined by single line feeds and padded, and the start of each."""
    n = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    return np.frombuffer(b"\n".join(parts) + bytes(STEPS + 1), np.uint8), np.cumsum(n) - n


def _word_starts(data: np.ndarray) -> np.ndarray:
    space = (data == 32) | (data == 10) | (data == 0)
    return np.nonzero(~space & np.concatenate(([True], space[:-1])))[0]


class ItemIndex:
    """LSH keys of every word (or byte) of a bounded block of items, by size class."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = sorted(((i, t) for i, t in ((i, normal(t)) for i, t in items) if t), key=lambda x: (len(x[1]), x))
        self.size = np.array([len(t) for _, t in self.items], np.int64)
        self.data, self.starts = _padded([t for _, t in self.items])
        self.classes, end = [], len(self.size)
        for least, *shape, stride in CLASSES:
            first = int(np.searchsorted(self.size, least))
            own = [t for _, t in self.items[first:end]]
            if own:
                self.classes.append((shape, min([stride, *(t.count(b" ") + 1 for t in own)]), self._tables(own, first, shape, stride)))
            end = first
        self.tiny = end

    @staticmethod
    def _tables(texts: list[bytes], first: int, shape: list[int], stride: int) -> tuple:
        data, starts = _padded(texts)
        at = _word_starts(data) if stride else np.arange(starts[-1] + len(texts[-1]))
        item = np.searchsorted(starts, at, "right") - 1
        bits, out = min(_TABLE_BITS, max(10, (16 * len(at)).bit_length())), []
        for k in embed(data, at, *shape):
            order = np.argsort(k, kind="stable")
            known = np.zeros(1 << bits, bool)
            known[(k >> np.uint64(64 - bits)).astype(np.int64)] = True
            out.append((known, k[order], item[order] + first, (at - starts[item])[order]))
        return np.uint64(64 - bits), out

    def candidates(self, data: np.ndarray, words: np.ndarray):
        """(anchor position, item, offset in the item) of equal keys; ``words`` are the starts of words."""
        for shape, stride, (shift, tables) in self.classes:
            anchors = words[::stride] if stride else np.arange(len(data) - STEPS)
            for s in range(0, len(anchors), _CHUNK):
                at = anchors[s:s + _CHUNK]
                found = []
                for k, (known, keys, item, offset) in zip(embed(data, at, *shape), tables):
                    hit = np.nonzero(known.take((k >> shift).view(np.int64)))[0]
                    lo, hi = np.searchsorted(keys, k[hit], "left"), np.searchsorted(keys, k[hit], "right")
                    n = hi - lo
                    rows = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    found.append((np.repeat(at[hit], n), item[rows], offset[rows]))
                yield tuple(map(np.concatenate, zip(*found)))


def piece_distances(index: ItemIndex, item: np.ndarray, piece: int, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Smallest edit distance of the 64 bytes ``piece`` of each item (fewer at its end) to
    any part of ``data[lo:hi]``: the programme of ``edit_distance``, for many at a time.
    A piece takes the upper bits; the bits below it match everything and change nothing."""
    kinds, row = np.unique(item, return_inverse=True)
    length = np.minimum(index.size[kinds] - 64 * piece, 64)
    first, one = 64 - length, np.uint64(1)
    below = (one << first.astype(np.uint64)) - one
    peq = np.repeat(below[:, None], 256, 1)
    for j in range(int(length.max(initial=0))):
        r = np.nonzero(j < length)[0]
        peq[r, index.data[index.starts[kinds[r]] + 64 * piece + j]] |= one << (first[r] + j).astype(np.uint64)
    order = np.argsort(lo - hi, kind="stable")
    width, pos, row = np.maximum(hi - lo, 0)[order], lo[order], row[order]
    peq, score, pv, row = peq.ravel(), length[row].astype(np.uint64), ~below[row], row * 256
    best, mv, top = score.copy(), np.zeros(len(row), np.uint64), np.uint64(63)
    live = np.searchsorted(-width, -np.arange(int(width.max(initial=0))), "left")
    for n in live.tolist():
        at, p, m, s = pos[:n], pv[:n], mv[:n], score[:n]
        eq = peq.take(row[:n] + data.take(at))
        at += 1
        d0 = eq & p
        d0 += p
        d0 ^= p
        d0 |= eq
        d0 |= m
        ph = d0 | p
        np.invert(ph, out=ph)
        ph |= m
        p &= d0
        s += ph >> top
        s -= p >> top
        np.minimum(best[:n], s, out=best[:n])
        ph <<= one
        p <<= one
        np.bitwise_and(ph, d0, out=m)
        ph |= d0
        np.invert(ph, out=ph)
        p |= ph
    out = np.empty(len(best), np.int64)
    out[order] = best
    return out


def edit_distance(item: bytes, window: bytes, limit: int) -> int | None:
    """Smallest edit distance of the item to any part of the window, None above
    ``limit`` (bit-parallel dynamic programme: one column of the matrix per integer)."""
    m = len(item)
    peq: dict[int, int] = {}
    for i, c in enumerate(item):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in window:
        eq = peq.get(c, 0)
        d0 = ((((eq & pv) + pv) ^ pv) | eq | mv) & full
        ph, mh = (mv | ~(d0 | pv)) & full, pv & d0
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = (mh | ~(d0 | ph)) & full, ph & d0
        best = min(best, score)
    return best if best <= limit else None


def tiny_distance(item: bytes, text: bytes, limit: int) -> int | None:
    """``edit_distance`` for the shortest items: of ``limit`` + 1 parts of the item one stands
    unchanged in the text, so only windows around the parts are compared."""
    if item in text:
        return 0
    best, m = None, len(item)
    cuts = [m * j // (limit + 1) for j in range(limit + 2)]
    for a, b in zip(cuts, cuts[1:]) if limit else ():
        seen, at = set(), text.find(item[a:b])
        while at >= 0:
            window = text[max(0, at - a - limit):at - a + m + limit]
            if window not in seen:
                seen.add(window)
                n = edit_distance(item, window, limit)
                if n is not None:
                    best = n if best is None else min(best, n)
                    if best == 1:
                        return best           # it isn't in the text unchanged
            at = text.find(item[a:b], at + 1)
    return best


def search(texts: list[bytes], index: ItemIndex, max_edits: float) -> list[tuple[int, int, int]]:
    """(text number, item number, edit distance) of the verified matches, best distance each."""
    texts = [normal(t) for t in texts]
    data, starts = _padded(texts)
    limits = np.floor(max_edits * index.size).astype(np.int64)
    best: dict[tuple[int, int], int] = {}

    def keep(d, i, n):
        if n < best.get((d, i), len(index.items[i][1]) + 1):
            best[d, i] = n

    def verify(doc, item, p):
        """The alignments ``p`` (position of the item's start in the text) by pieces, then whole."""
        size, limit, ends = index.size[item], limits[item], starts[doc] + np.array([len(t) for t in texts])[doc]
        total = np.zeros(len(doc), np.int64)
        for piece in range(int((size.max(initial=0) + 63) // 64)):
            r = np.nonzero((total <= limit) & (64 * piece < size))[0]
            if piece and len(r) < _FEW:
                break
            u, slack = starts[doc[r]] + p[r] + 64 * piece, 2 * limit[r] + 1
            lo, hi = np.maximum(u - slack, starts[doc[r]]), np.minimum(u + np.minimum(size[r] - 64 * piece, 64) + slack, ends[r])
            total[r] += piece_distances(index, item[r], piece, data, lo, hi)
        for d, i, q, n in zip(*(x[total <= limit].tolist() for x in (doc, item, p, total))):
            text, k = index.items[i][1], int(limits[i])
            if len(text) > 64 and best.get((d, i)) != 0:
                n = edit_distance(text, texts[d][max(0, q - 2 * k - 1):max(0, q + len(text) + 2 * k + 1)], k)
            if n is not None:
                keep(d, i, n)

    def flush(doc, item, p):
        near = np.unique(np.stack([doc, item, p // (limits[item] + 1)]), axis=1, return_index=True)[1]
        for s in range(0, len(near), _VERIFIED):
            verify(*(x[near[s:s + _VERIFIED]] for x in (doc, item, p)))

    waiting, n = [], 0
    for at, item, offset in index.candidates(data, _word_starts(data)):
        doc = np.searchsorted(starts, at, "right") - 1
        waiting.append((doc, item, at - starts[doc] - offset))
        n += len(at)
        if n >= _WAITING:
            flush(*map(np.concatenate, zip(*waiting)))
            waiting, n = [], 0
    if n:
        flush(*map(np.concatenate, zip(*waiting)))
    for i in range(index.tiny):
        text, k = index.items[i][1], int(limits[i])
        for d, t in enumerate(texts):
            n = tiny_distance(text, t, k)
            if n is not None:
                keep(d, i, n)
    return [(d, i, n) for (d, i), n in best.items()]


def item_blocks(items: DataFrame, id_col: str, text_col: str):
    """Lists of (id, text) of at most about ``ITEM_BLOCK_BYTES``: stated query sets that
    are searched one after the other, so what a task holds is bounded."""
    src = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), text_bytes(F.col(text_col)).alias("t")).distinct()
    size = src.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, math.ceil(size / ITEM_BLOCK_BYTES))
    for k in range(n):
        rows = sorted(src.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect())
        if rows:
            yield [(r.i, bytes(r.t)) for r in rows]


def find_leaks(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", max_edits: float = MAX_EDITS) -> DataFrame:
    """(id, item_id, edits): the documents that hold an item, up to ``max_edits`` of its
    length in edits (bytes), with the smallest distance found at the alignments met.

    Texts are compared lower-cased (A-Z) with runs of ASCII white space as one space.
    Null and empty texts hold nothing and empty items are held by none; items and
    documents with a null id are left out; repeated rows give one result row.  Short
    items have shorter walks and strides of their own (``CLASSES``).  Items that repeat under other ids match each under its own id.  Empty
    tables give an empty result.  Recall is that of the LSH, at least 0.9 in each length class (see the tests)."""
    src = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), text_bytes(F.col(text_col)).alias("text"))
    schema = "id long, item_id long, edits long"
    spark, path = df.sparkSession, work_dir(df.sparkSession, "leaks")
    spark.createDataFrame([], schema).write.parquet(path)
    # one block of items at a time: the driver and the tasks hold no more than one
    for block in item_blocks(items, item_id_col, item_text_col):
        def run(batches, block=block):
            index = ItemIndex(block)
            for b in batches:
                for s in range(0, b.num_rows if index.items else 0, 1_000):
                    part = b.slice(s, 1_000)
                    ids = part.column(0).to_pylist()
                    found = [(ids[d], index.items[i][0], n) for d, i, n in search(part.column(1).to_pylist(), index, max_edits)]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["id", "item_id", "edits"])

        map_arrow(src, run, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path).groupBy("id", "item_id").agg(F.min("edits").alias("edits"))


def drop_leaks(df: DataFrame, items: DataFrame, text_col: str = "text", item_text_col: str = "text", max_edits: float = MAX_EDITS) -> DataFrame:
    """The rows of ``df`` whose text holds no item, as ``find_leaks`` sees it.  Every row
    is judged by its own text and every item counts, with or without an id."""
    place, schema, done = df.columns.index(text_col), df.schema, 0
    for block in item_blocks(items.select(F.lit(0).alias("i"), F.col(item_text_col).alias("t")), "i", "t"):
        df = written(df, "clean") if done else df          # the block before is done with, and let go
        done += 1

        def run(batches, block=block):
            index = ItemIndex(block)
            for b in batches:
                for s in range(0, b.num_rows, 1_000):
                    part = b.slice(s, 1_000)
                    texts = [(t or "").encode() for t in part.column(place).to_pylist()]
                    held = {d for d, _, _ in search(texts, index, max_edits)} if index.items else ()
                    yield part.filter(pa.array([d not in held for d in range(len(texts))], pa.bool_()))

        df = map_arrow(df, run, schema)
    return df
