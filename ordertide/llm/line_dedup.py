"""Reversible line dedup: sharded cuckoo filters over exact reference tables.

The exact tables are the references (line key, document) and their counts per key
with the largest document.  Each shard of the key space has a cuckoo filter of its
live keys.  Inserted keys are looked up in the filter first: keys it doesn't know
are new and never touch the exact tables; only possible hits are joined with
them.  Deleting documents removes their references, counts their keys anew and
takes keys without references out of the filter, so an index is the same whether
documents were deleted or never inserted.  Each change gives a new index whose
tables are written to the shared folder.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow, ship, text_bytes, written

MIN_DOCS = 3
MIN_CHARS = 20
SHARD_KEYS = 250_000
SALT = 16
MAX_MOVES = 500
BATCHES = 2               # parts in which line_dedup inserts documents
_WHITE = b" \t\n\x0b\x0c\r"


# ---- cuckoo filter -----------------------------------------------------------------

class CuckooTable:
    """16-bit fingerprints in buckets of four; bulk operations in numpy.

    A key has two buckets, each found from the other and the fingerprint, so stored
    fingerprints can move without their keys."""

    def __init__(self, capacity: int):
        self.mask = (1 << max(4, math.ceil(math.log2(max(1, capacity) / 4 / 0.85)))) - 1
        self.slots = np.zeros((self.mask + 1, 4), np.uint16)
        self.free = 4 * (self.mask + 1) * 85 // 100
        self.stash: list[tuple[int, int]] = []     # (lower bucket, fingerprint) of entries that found no slot

    def _where(self, a: np.ndarray, b: np.ndarray):
        return a.view(np.uint64).astype(np.int64) & self.mask, (b.view(np.uint64) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _other(self, at: np.ndarray, fp: np.ndarray) -> np.ndarray:
        return (at ^ (fp.astype(np.int64) * 0x5BD1E995)) & self.mask

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at, fp = self._where(a, b)
        other = self._other(at, fp)
        out = (self.slots[at] == fp[:, None]).any(1) | (self.slots[other] == fp[:, None]).any(1)
        for bucket, f in self.stash:
            out |= (np.minimum(at, other) == bucket) & (fp == f)
        return out

    def _place(self, at: np.ndarray, fp: np.ndarray) -> np.ndarray:
        """Fill free slots; which of the entries found one."""
        order = np.argsort(at, kind="stable")
        rank = np.arange(len(at)) - np.searchsorted(at[order], at[order])
        empty = self.slots[at[order]] == 0
        nth = np.cumsum(empty, 1) * empty == rank[:, None] + 1
        ok = nth.any(1)
        self.slots[at[order][ok], nth[ok].argmax(1)] = fp[order][ok]
        done = np.zeros(len(at), bool)
        done[order[ok]] = True
        return done

    def insert(self, a: np.ndarray, b: np.ndarray, rng: np.random.Generator) -> None:
        """Insert at most ``free`` keys."""
        at, fp = self._where(a, b)
        self.free -= len(at)
        left = ~self._place(at, fp)
        at, fp = self._other(at[left], fp[left]), fp[left]
        for _ in range(MAX_MOVES):
            left = ~self._place(at, fp)
            at, fp = at[left], fp[left]
            if not len(at):
                return
            one = np.unique(at, return_index=True)[1]       # one entry per full bucket takes a slot, the entry there moves
            slot = rng.integers(0, 4, len(one))
            out = self.slots[at[one], slot].copy()
            self.slots[at[one], slot] = fp[one]
            rest = np.ones(len(at), bool)
            rest[one] = False
            at, fp = np.concatenate([self._other(at[one], out), at[rest]]), np.concatenate([out, fp[rest]])
        self.stash += zip(np.minimum(at, self._other(at, fp)).tolist(), fp.tolist())

    def remove(self, a: int, b: int) -> bool:
        at, fp = self._where(np.array([a]), np.array([b]))
        for i in (at[0], self._other(at, fp)[0]):
            s = np.nonzero(self.slots[i] == fp[0])[0]
            if len(s):
                self.slots[i, s[0]] = 0
                self.free += 1
                return True
        entry = (int(min(at[0], self._other(at, fp)[0])), int(fp[0]))
        if entry in self.stash:
            self.stash.remove(entry)
            return True
        return False


class CuckooFilter:
    """A growing list of tables: a new one is added when the last is full."""

    def __init__(self):
        self.tables: list[CuckooTable] = []

    @staticmethod
    def load(blob: bytes | None) -> CuckooFilter:
        return pickle.loads(blob) if blob else CuckooFilter()

    def dump(self) -> bytes:
        return pickle.dumps(self)

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), bool)
        for t in self.tables:
            out |= t.holds(a, b)
        return out

    def insert(self, a: np.ndarray, b: np.ndarray) -> None:
        rng = np.random.default_rng(len(a))
        while len(a):
            if not self.tables or self.tables[-1].free <= 0:
                self.tables.append(CuckooTable(max(len(a), 2 * (self.tables[-1].mask + 1) * 4 if self.tables else 1024)))
            n = min(len(a), self.tables[-1].free)
            self.tables[-1].insert(a[:n], b[:n], rng)
            a, b = a[n:], b[n:]

    def remove(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            if not any(t.remove(x, y) for t in reversed(self.tables)):
                raise KeyError("key was never inserted")


# ---- lines -------------------------------------------------------------------------

def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit key of a line stripped of white space and lower-cased (A-Z); None if too short."""
    s = line.strip(_WHITE).lower()
    if len(s) < min_chars or (len(s) < 4 * min_chars and len(s.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(s)


def references(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Distinct (a, b, doc): line keys of documents with an id."""
    def run(batches):
        for batch in batches:
            ids, keys = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {line_key(x, min_chars) for x in text.split(b"\n")} - {None}
                ids += [i] * len(own)
                keys += own
            ab = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy()), pa.array(ids, pa.int64())], names=["a", "b", "doc"])

    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), text_bytes(F.col(text_col)).alias("text"))
    return map_arrow(src, run, "a long, b long, doc long").distinct()


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))


@dataclass
class LineIndex:
    """References, counts and filters of the documents inserted so far."""

    refs: DataFrame            # a, b, doc
    counts: DataFrame          # a, b, n, keeper
    filters: DataFrame         # shard, blob
    shards: int
    min_chars: int = MIN_CHARS

    @classmethod
    def empty(cls, spark, expected_keys: int, min_chars: int = MIN_CHARS) -> LineIndex:
        """``expected_keys`` only sets the number of shards; filters grow past it."""
        shards = max(1, math.ceil(expected_keys / SHARD_KEYS))
        blank = lambda s: spark.createDataFrame([], s)
        return cls(blank("a long, b long, doc long"), blank("a long, b long, n long, keeper long"), blank("shard int, blob binary"), shards, min_chars)

    def _shard(self):
        return F.pmod("a", F.lit(self.shards)).cast("int").alias("shard")

    def _filtered(self, keys: DataFrame, work, schema: str) -> DataFrame:
        """``work(filter, a, b, shard)`` for the keys of each shard with its filter."""
        def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
            blob = right.column("blob")[0].as_py() if right.num_rows else None
            return work(CuckooFilter.load(blob), left.column("a").to_numpy(), left.column("b").to_numpy(), key[0].as_py(), blob)

        ship(keys.sparkSession)
        return keys.select(self._shard(), "a", "b").groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(run, schema)

    def maybe_known(self, keys: DataFrame) -> DataFrame:
        """(a, b) of the keys that the filters may hold; all others are surely new."""
        def work(f, a, b, shard, _):
            hit = f.holds(a, b)
            return pa.table({"a": a[hit], "b": b[hit]})

        return self._filtered(keys, work, "a long, b long")

    def _changed_filters(self, keys: DataFrame, change: str) -> DataFrame:
        def work(f, a, b, shard, blob):
            if len(a):
                getattr(f, change)(a, b)
            return pa.table({"shard": pa.array([shard], pa.int32()), "blob": pa.array([f.dump() if len(a) else blob], pa.binary())})

        return written(self._filtered(keys, work, "shard int, blob binary"), "line-filters")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index with these documents; references it has already are not counted again."""
        return self.insert_references(written(references(docs, id_col, text_col, self.min_chars), "line-batch"))

    def insert_references(self, batch: DataFrame) -> LineIndex:
        """``insert`` for distinct references (a, b, doc) of a written table.

        Keys that the filters don't know are new: they never meet the exact tables."""
        fresh, known = batch, None
        if not self.filters.isEmpty():
            known = written(self.maybe_known(batch.select("a", "b").distinct()), "line-known")
            fresh = batch.join(known, ["a", "b"], "left_anti").unionByName(
                batch.join(known, ["a", "b"], "left_semi").join(self.refs, ["a", "b", "doc"], "left_anti"))
        delta = written(_count(fresh), "line-delta")
        if known is None:
            counts, new = delta, delta
        else:
            old = self.counts.join(known, ["a", "b"], "left_semi")
            new = delta.join(old, ["a", "b"], "left_anti")
            both = delta.join(old.select("a", "b", F.col("n").alias("n0"), F.col("keeper").alias("k0")), ["a", "b"]).select(
                "a", "b", (F.col("n") + F.col("n0")).alias("n"), F.greatest("keeper", "k0").alias("keeper"))
            counts = written(self.counts.join(both, ["a", "b"], "left_anti").unionByName(both).unionByName(new), "line-counts")
        refs = batch if known is None else written(self.refs.unionByName(fresh), "line-refs")
        return LineIndex(refs, counts, self._changed_filters(new, "insert"), self.shards, self.min_chars)

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """The index without the documents of these ids (unknown ids change nothing)."""
        gone = ids.select(F.col(id_col).cast("long").alias("doc")).distinct()
        touched = written(self.refs.join(gone, "doc", "left_semi").select("a", "b").distinct(), "line-touched")
        refs = written(self.refs.join(gone, "doc", "left_anti"), "line-refs")
        again = written(_count(refs.join(touched, ["a", "b"], "left_semi")), "line-recount")
        counts = written(self.counts.join(touched, ["a", "b"], "left_anti").unionByName(again), "line-counts")
        dead = touched.join(again, ["a", "b"], "left_anti")
        return LineIndex(refs, counts, self._changed_filters(dead, "remove"), self.shards, self.min_chars)

    def dropped(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(doc, keys): the line keys that each document loses, 16 bytes each, joined."""
        often = self.counts.where(F.col("n") >= min_docs).select(
            "a", "b", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
        lost = (self.refs.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALT)).cast("int"))
                .join(often, ["a", "b", "salt"]).where("doc <> keeper"))
        return lost.groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("keys"))


def strip_lines(docs: DataFrame, index: LineIndex, min_docs: int = MIN_DOCS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``text_col`` stripped, and the columns ``n_lines``,
    ``n_dropped`` and ``kept_sha256`` (which replace columns of these names).

    A key that at least ``min_docs`` documents of the index hold loses all its lines
    except in its largest document."""
    min_chars, added = index.min_chars, ["n_lines", "n_dropped", "kept_sha256"]
    names = [c for c in docs.columns if c not in (text_col, *added)]
    at, n = names.index(id_col), len(names)

    def run(batches):
        for b in batches:
            texts, lines, drops, shas = [], [], [], []
            for text, null, keys in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist(), b.column(n + 2).to_pylist()):
                lost = {np.array([k["a"], k["b"]], np.int64).tobytes() for k in keys or []}
                own = text.split(b"\n")
                left = [x for x in own if line_key(x, min_chars) not in lost] if lost else own
                kept = b"\n".join(left)
                texts.append(None if null else kept.decode("utf-8", "replace"))
                lines.append(len(own))
                drops.append(len(own) - len(left))
                shas.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(texts, pa.string()), pa.array(lines, pa.int64()),
                                              pa.array(drops, pa.int64()), pa.array(shas)], names=[f"c{i}" for i in range(n + 4)])

    lost = index.dropped(min_docs).withColumnRenamed("doc", "lost doc").withColumnRenamed("keys", "lost keys")
    src = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], text_bytes(F.col(text_col)).alias("text"),
                      F.col(text_col).isNull().alias("null"))
    # rows without an id can't be matched; a key of their own keeps them apart in the shuffle
    src = src.withColumn("row", F.coalesce(F.col(f"c{at}").cast("long"), -F.abs(F.xxhash64("text")) - 1))
    joined = src.join(lost, (F.col("row") == F.col("lost doc")) & F.col(f"c{at}").isNotNull(), "left").select(
        *[f"c{i}" for i in range(n)], "text", "null", "lost keys")
    schema = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(joined.schema.fields[:n])]
                       + [f"c{n} string, c{n + 1} long, c{n + 2} long, c{n + 3} string"])
    out = map_arrow(joined, run, schema).toDF(*names, text_col, *added)
    return out.select(*[c for c in docs.columns if c not in added], *added)


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Index all documents, then strip them: the input's columns with the text stripped,
    n_lines (before), n_dropped and kept_sha256.

    Documents go into the index in ``BATCHES`` parts by a hash of their id, so that the
    keys of the later part are looked up in the filters and only possible hits meet
    the exact tables.

    Null and empty texts are one empty line (a null text stays null).  Documents are
    distinct ids: repeated rows of an id count once and are stripped alike.  Rows with
    a null id hold no key and stay as they are.  An empty table gives an empty
    result."""
    size = docs.select(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    index = LineIndex.empty(docs.sparkSession, size // 100, min_chars)
    refs = written(references(docs, id_col, text_col, min_chars), "line-batch")
    batch = F.pmod(F.xxhash64("doc", F.lit(7)), F.lit(BATCHES))
    for k in range(BATCHES):
        index = index.insert_references(refs.where(batch == k))
    return strip_lines(docs, index, min_docs, id_col, text_col)


ORACLE_SQL = r"""
WITH ln AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM ln),
often AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, often.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
