"""Ranked lexical search over a length-stratified index.

Documents with an equal length normaliser form a stratum.  A stratum holds its
postings by term and term frequency, so the impact of a term is computed once per
frequency and stratum, not per document.  The highest impacts of a stratum bound the
score that an item can reach there: strata are visited by falling bound until the
bound is below the item's k-th best score.

Building takes two steps.  Tasks turn chunks of texts into postings by (length, term,
frequency); when the corpus totals are known, lengths become normalisers and the
postings are grouped into strata, big ones in several parts of whole documents.  A
row of the index is one part, so that tasks score it without further exchange and keep
only the best ``k`` of each item.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow, text_bytes, work_dir, written

CHUNK_DOCS, CHUNK_BYTES = 4096, 4 << 20   # texts that a task inverts together
PART_POSTINGS = 1 << 18                   # postings from which a stratum is split
WAVE_POSTINGS = 1 << 21                   # postings that a task ranks its strata over,
WAVE_CELLS = 1 << 22                      # and cells of their bounds by term and item
BLOCK_TERMS = 1 << 17                     # item terms that are searched together
KNOWN_TERMS = 1 << 17                     # most terms that restrict an index
KNOWN_NORMALISERS = 1 << 16               # most normalisers that every task is told
_ROWS = "n long, chunk long, term string, tf int, keys array<long>, ids array<long>"
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and characters above ASCII, A-Z lower-cased."""
    return text.translate(_SPLIT).split()


@dataclass
class Index:
    strata: DataFrame     # (m, part, entries of (term, tf, keys, ids)); null terms list the documents
    df: DataFrame         # (term, df)
    n_docs: int           # documents with a term
    n_terms: int


def _lists(lists: list[list]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) for x in lists])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([v for x in lists for v in x], pa.int64()))


def _invert(known: set[bytes] | None):
    """Batches of (id, text) to rows of postings and, with a null term, of documents."""
    def run(batches):
        task = TaskContext.get().partitionId() << 36
        key, docs, post, size = task, defaultdict(list), defaultdict(list), 0

        def flush():
            rows = [(n, None, 0, *zip(*own)) for n, own in docs.items()]
            rows += [(n, term.decode(), tf, keys, ()) for (n, term, tf), keys in post.items()]
            n, term, tf, keys, ids = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(n, pa.int64()), pa.array([task + key] * len(n), pa.int64()), pa.array(term, pa.string()),
                 pa.array(tf, pa.int32()), _lists(keys), _lists(ids)], names=["n", "chunk", "term", "tf", "keys", "ids"])

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                count = Counter(terms_of(text))
                n = count.total()
                size += len(text)
                if n:
                    docs[n].append((key, i))
                    for term, tf in count.items():
                        if known is None or term in known:
                            post[n, term, tf].append(key)
                    key += 1
                if docs and (size >= CHUNK_BYTES or (key - task) % CHUNK_DOCS == 0):
                    yield flush()
                    docs, post, size = defaultdict(list), defaultdict(list), 0
        if docs:
            yield flush()
    return run


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: list[str] | None = None) -> Index:
    """Index every row of ``df``; ``terms`` (a bounded list) keeps only their postings.
    Totals and lengths count all terms in any case.

    Null and empty texts have no terms and aren't documents of the index; a null id
    stays one; each of several rows with one id is a document."""
    known = None if terms is None else {t.encode() for t in terms}
    src = df.select(F.col(id_col).cast("long").alias("id"), text_bytes(F.col(text_col)).alias("text"))
    rows = written(map_arrow(src, _invert(known), _ROWS), "search-postings")
    total = rows.where("term IS NULL").agg(F.sum(F.size("keys")).alias("docs"), F.sum(F.size("keys") * F.col("n")).alias("terms")).first()
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 0
    frequency = rows.where("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("keys")).cast("long").alias("df"))
    # as 64-bit integers would give, in decimals so that no product overflows
    wide = f"cast(90 * n AS decimal(20, 0)) * cast({n_docs} AS decimal(18, 0))"
    rows = rows.withColumn("m", F.expr(f"10 + cast(({wide}) div {max(n_terms, 1)} AS long)"))
    parts = written(rows.groupBy("m").agg(F.ceil(F.sum(F.size("keys")) / PART_POSTINGS).alias("parts")), "search-parts")
    # one row per normaliser: few, and then the postings need no exchange by a frequent one
    parts = F.broadcast(parts) if parts.count() <= KNOWN_NORMALISERS else parts
    rows = rows.join(parts, "m").withColumn("part", F.pmod(F.xxhash64("chunk"), "parts"))
    strata = rows.groupBy("m", "part").agg(F.collect_list(F.struct("term", "tf", "keys", "ids")).alias("entries"))
    return Index(written(strata, "search-strata"), frequency, n_docs, n_terms)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(q, item_id, terms): a number of its own per row, and the distinct terms."""
    def run(batches):
        q = TaskContext.get().partitionId() << 36
        for b in batches:
            terms = [sorted({t.decode() for t in terms_of(x.as_py())}) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(range(q, q + len(terms)), pa.int64()), b.column(0),
                                              pa.array(terms, pa.list_(pa.string()))], names=["q", "item_id", "terms"])
            q += len(terms)

    src = items.select(F.col(id_col).alias("item_id"), text_bytes(F.col(text_col)).alias("text"))
    kind = src.schema["item_id"].dataType.simpleString()
    return written(map_arrow(src, run, f"q long, item_id {kind}, terms array<string>"), "search-items")


class _Stratum:
    """Postings of one index row, restricted to the searched terms."""

    def __init__(self, m: int, entries: pa.StructArray, code: pa.Array, weight: np.ndarray):
        term, keys, ids = entries.field("term"), entries.field("keys"), entries.field("ids")
        docs = term.is_null()
        at = keys.filter(docs).flatten().to_numpy()
        order = np.argsort(at)
        own = ids.filter(docs).flatten()
        self.missing = own.is_null().to_numpy(zero_copy_only=False)[order]
        self.ids = own.fill_null(0).to_numpy()[order]
        found = pc.index_in(term, value_set=code)
        use = found.is_valid()
        found, keys = found.filter(use).to_numpy(), keys.filter(use)
        tf = entries.field("tf").filter(use).to_numpy().astype(np.int64)
        self.impact = weight[found] * (1_000_000_000 * tf // (1000 * tf + 8 * m))    # once per term and frequency
        self.best = np.zeros(len(weight), np.int64)
        np.maximum.at(self.best, found, self.impact)
        length = keys.value_lengths().to_numpy().astype(np.int64)
        by_term = np.argsort(found, kind="stable")
        start = np.concatenate([[0], np.cumsum(length)])[:-1][by_term]
        self.impact, length = self.impact[by_term], length[by_term]
        self.size = int(length.sum())
        flat = np.searchsorted(at[order], keys.flatten().to_numpy())
        self.doc = flat[_ranges(start, length)].astype(np.int32)
        self.impact = np.repeat(self.impact, length)
        ends = np.zeros(len(weight) + 1, np.int64)
        np.add.at(ends, found[by_term] + 1, length)
        self.at = np.cumsum(ends)                                     # postings of term v: at[v] to at[v + 1]

    def scores(self, terms: np.ndarray) -> np.ndarray:
        use = _ranges(self.at[terms], self.at[terms + 1] - self.at[terms])
        out = np.zeros(len(self.ids), np.int64)
        np.add.at(out, self.doc[use], self.impact[use])
        return out


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each range, one after the other."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.arange(total) + np.repeat(start - (np.cumsum(length) - length), length)


class _Best:
    """The best ``k`` of an item so far: score down, id up, null ids last."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.score, self.missing, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score, missing, ids) -> None:
        use = np.nonzero(score >= self.floor)[0]
        if not len(use):
            return
        score = np.concatenate([self.score, score[use]])
        missing = np.concatenate([self.missing, missing[use]])
        ids = np.concatenate([self.ids, ids[use]])
        top = np.lexsort((ids, missing, -score))[:self.k]
        self.score, self.missing, self.ids = score[top], missing[top], ids[top]
        if len(top) == self.k:
            self.floor = int(self.score[-1])      # an equal score may still have a smaller id


def _ranked(code: list[str], weight: list[int], queries: list[tuple[int, list[int]]], k: int):
    """Index rows to the task's best ``k`` (q, id, score) of each item."""
    def run(batches):
        vocabulary, w = pa.array(code, pa.string()), np.array(weight, np.int64)
        own = [np.array(t, np.int64) for _, t in queries]
        every = np.concatenate(own)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in own])])[:-1]
        best = [_Best(k) for _ in queries]
        wave, size = [], 0

        def visit():
            bound = np.stack([np.add.reduceat(s.best[every], starts) for s in wave])
            for i, terms in enumerate(own):
                for j in np.argsort(-bound[:, i], kind="stable"):
                    if bound[j, i] < best[i].floor:
                        break
                    best[i].add(wave[j].scores(terms), wave[j].missing, wave[j].ids)

        for b in batches:
            for r in range(b.num_rows):
                entries = b.column(1).slice(r, 1).flatten()
                s = _Stratum(b.column(0)[r].as_py(), entries, vocabulary, w)
                wave.append(s)
                size += s.size
                if size >= WAVE_POSTINGS or len(wave) * (len(w) + len(own)) >= WAVE_CELLS:
                    visit()
                    wave, size = [], 0
        if wave:
            visit()
        n = [len(x.ids) for x in best]
        q = np.repeat(np.array([q for q, _ in queries], np.int64), n)
        ids = pa.array(np.concatenate([x.ids for x in best]), mask=np.concatenate([x.missing for x in best]))
        yield pa.RecordBatch.from_arrays([pa.array(q), ids, pa.array(np.concatenate([x.score for x in best]))],
                                         names=["q", "doc_id", "score"])
    return run


def search(index: Index, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the best ``k`` documents of each row of ``items``
    (of ``item_terms``) with a score above 0, equal scores by ascending id, null ids
    last.  Items are searched in blocks of bounded size; items without terms, or whose
    terms no document has, give no rows; each of several equal items gives its own."""
    spark = items.sparkSession
    has = items.where(F.size("terms") > 0)
    total = has.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_TERMS))
    path = work_dir(spark, "search-hits")
    for block in range(blocks):
        part = has.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == block)
        known = index.df.join(part.select(F.explode("terms").alias("term")).distinct(), "term")
        weights = {r.term: r.w for r in known.select("term", F.floor(1000 * F.log(
            (F.lit(2.0) * index.n_docs + 2) / (2.0 * F.col("df") + 1))).alias("w")).collect()}
        code = {t: i for i, t in enumerate(sorted(weights))}
        queries = [(r.q, [code[t] for t in r.terms if t in code]) for r in part.select("q", "terms").collect()]
        queries = [(q, t) for q, t in queries if t]
        run = _ranked(list(code), [weights[t] for t in code], queries, k) if queries else lambda batches: iter(())
        hits = map_arrow(index.strata.select("m", "entries"), run, "q long, doc_id long, score long")
        hits.write.mode("append").parquet(path)
    hits = spark.read.schema("q long, doc_id long, score long").parquet(path)
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return hits.join(items.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id",
                  text_col: str = "text") -> DataFrame:
    """Index ``docs`` and search ``items``.  Up to ``KNOWN_TERMS`` distinct terms of the
    items restrict the postings that are kept; with more the whole index is built."""
    asked = item_terms(items, item_col, text_col)
    distinct = asked.select(F.explode("terms").alias("term")).distinct()
    some = [r.term for r in distinct.limit(KNOWN_TERMS + 1).collect()]
    return search(build_index(docs, id_col, text_col, some if len(some) <= KNOWN_TERMS else None), asked, k)


ORACLE_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM t WHERE len(ws) > 0),
p AS (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM t) GROUP BY r, w),
df AS (SELECT w, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS weight
       FROM p, c GROUP BY w),
m AS (SELECT r, doc_id, 10 + (90 * len(ws) * n_docs) // n_terms AS m FROM t, c WHERE len(ws) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ws FROM benchmark),
s AS (SELECT q, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM (SELECT q, item_id, unnest(ws) AS w FROM i) JOIN p USING (w) JOIN df USING (w) JOIN m USING (r) GROUP BY q, item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place FROM s WHERE score > 0)
SELECT item_id, place::INT AS rank, doc_id, score FROM k WHERE place <= 10
"""
