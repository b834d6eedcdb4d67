"""Byte-level BPE by recursive queries, and decoding by ordered aggregation.

Each task runs an in-process DuckDB over its own rows.  A text is split by the
vocabulary's pattern; the bytes of each distinct piece become (piece, position,
token) rows.  One step of a recursive query joins neighbouring tokens with the
merge table, picks each piece's leftmost pair of the lowest rank and contracts
it; the recursion ends when no piece has a pair left.  Decoding joins ids with
the vocabulary and aggregates the byte strings in order of position.

Every token that a contraction makes is a token of the vocabulary that stands in the
text.  Where none of those spans two neighbouring bytes, no contraction can join them:
longer pieces are cut there first, so text without spaces (Chinese, say) falls into
short parts that are met again and again.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow, Memo, release, space_segments, text_bytes, worker_state

BATCH_WORK = 1 << 22      # sum of squared lengths of the pieces contracted by one recursive query
LONG_PIECE = 48           # bytes; longer pieces are cut, and contract all occurrences of their lowest pair per step
LONG_BATCH = 1 << 18      # bytes of long pieces contracted together
DECODE_TOKENS = 1 << 20   # ids decoded by one query
TEXT_BYTES = 1 << 20      # texts encoded together
MEMO = 400_000            # segments a worker remembers, see Memo
MEMO_CHARS = 4 << 20      # of them in each generation; an id takes four bytes

# Keys are piece << 32 | position, so one ordering serves pieces and positions.
_PAIRS = """
p AS (SELECT *, lead(tok) OVER x AS nxt, lead(k) OVER x AS nk FROM {t} WINDOW x AS (ORDER BY k)),
r AS (SELECT p.*, m.merged FROM p LEFT JOIN merges m
      ON m.pair = CASE WHEN p.nk >> 32 = p.k >> 32 THEN p.tok::BIGINT << 20 | p.nxt END)
"""
_ENCODE = """
WITH RECURSIVE t(step, k, tok) AS (
  SELECT 0, k, tok FROM start_rows
  UNION ALL (
    WITH p AS (SELECT *, lead(tok) OVER x AS nxt, lead(k) OVER x AS nk FROM t WINDOW x AS (ORDER BY k)),
    r AS (SELECT k >> 32 AS piece, m.merged::BIGINT << 32 | (k & 4294967295) AS rank_at, nk
          FROM p JOIN merges m ON m.pair = p.tok::BIGINT << 20 | p.nxt WHERE nk >> 32 = k >> 32),
    b AS (SELECT piece, min(rank_at) AS best, arg_min(nk, rank_at) AS gone FROM r GROUP BY piece)
    SELECT t.step + 1, t.k,
           CASE WHEN t.k & 4294967295 = b.best & 4294967295 THEN (b.best >> 32)::INTEGER ELSE t.tok END
    FROM t JOIN b ON b.piece = t.k >> 32 WHERE t.k <> b.gone)
), last AS (SELECT k >> 32 AS piece, max(step) AS step FROM t GROUP BY 1)
SELECT piece, list(tok ORDER BY k) AS ids
FROM t JOIN last ON last.piece = t.k >> 32 AND last.step = t.step GROUP BY piece ORDER BY piece
"""
# A merge never makes a pair of a lower rank available, so contracting all occurrences of a piece's lowest
# pair, from the left and without overlap, equals contracting the leftmost one again and again.
_LONG_STEP = f"""
CREATE OR REPLACE TEMP TABLE long_next AS
WITH {_PAIRS.format(t="long_rows")},
b AS (SELECT k >> 32 AS piece, min(merged) AS best FROM r GROUP BY 1),
h AS (SELECT r.*, b.best, coalesce(r.merged = b.best, FALSE) AS hit FROM r JOIN b ON b.piece = r.k >> 32),
g AS (SELECT *, sum((NOT hit)::INTEGER) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS run FROM h),
c AS (SELECT *, hit AND row_number() OVER (PARTITION BY run, hit ORDER BY k) % 2 = 1 AS take FROM g),
l AS (SELECT *, lag(take) OVER (ORDER BY k) AS gone FROM c)
SELECT k, CASE WHEN take THEN best ELSE tok END AS tok FROM l WHERE NOT coalesce(gone, FALSE)
"""
# One thread aggregates the rows in the order of the subquery: one sort of all rows by their place.
_DECODE = """
SELECT chunk, string_agg(bytes, '') AS bytes
FROM (SELECT chunk, bytes FROM id_rows JOIN vocab USING (tok) ORDER BY pos) GROUP BY chunk ORDER BY chunk
"""


class Bpe:
    """Vocabulary, merge table and DuckDB connection of one worker process."""

    def __init__(self, ranks_path: str, pattern: str):
        import duckdb
        import regex

        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.find = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        # nothing is spilled to a folder of the machine
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        merges = [(self.ranks[t[:i]] << 20 | self.ranks[t[i:]], r) for t, r in self.ranks.items()
                  for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        pair, merged = np.array(merges, np.int64).reshape(-1, 2).T
        self._table("merges", pa.table({"pair": pair, "merged": merged.astype(np.int32)}))
        self._table("vocab", pa.table({"tok": np.array(list(self.ranks.values()), np.int32),
                                       "bytes": [t.decode("latin-1") for t in self.ranks]}))
        self.memo = Memo(MEMO, MEMO_CHARS)
        self.decimal = pa.array([str(i) for i in range(max(self.ranks.values()) + 1)])
        self.spans = None

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("rows_in", rows)
        self._run(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM rows_in")
        self.db.unregister("rows_in")

    def _run(self, sql: str) -> list:
        return self.db.execute(sql).fetchall()

    def _rows(self, pieces: list[bytes]) -> pa.Table:
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        pos = np.arange(len(raw)) - np.repeat(np.cumsum(n) - n, n)
        return pa.table({"k": np.repeat(np.arange(len(pieces), dtype=np.int64), n) << 32 | pos,
                         "tok": self.byte_ids[raw]})

    def _short(self, pieces: list[bytes]) -> list[bytes]:
        self.db.register("start_rows", self._rows(pieces))
        ids = self.db.sql(_ENCODE).to_arrow_table().column("ids").combine_chunks()
        self.db.unregister("start_rows")
        at, flat = ids.offsets.to_numpy() * 4, ids.values.to_numpy(zero_copy_only=False).astype(np.int32).tobytes()
        return [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def _long(self, pieces: list[bytes]) -> list[bytes]:
        """The same contraction for long pieces, step by step, keeping one state only; pieces
        that are done step aside."""
        self._table("long_rows", self._rows(pieces))
        self._run("CREATE OR REPLACE TEMP TABLE long_done AS SELECT * FROM long_rows LIMIT 0")
        while True:
            self._run(f"CREATE OR REPLACE TEMP TABLE long_open AS WITH {_PAIRS.format(t='long_rows')} "
                      "SELECT DISTINCT k >> 32 AS piece FROM r WHERE merged IS NOT NULL")
            self._run("INSERT INTO long_done SELECT * FROM long_rows WHERE k >> 32 NOT IN (SELECT piece FROM long_open)")
            self._run("CREATE OR REPLACE TEMP TABLE long_rows AS SELECT * FROM long_rows WHERE k >> 32 IN (SELECT piece FROM long_open)")
            if not self._run("SELECT count(*) FROM long_rows")[0][0]:
                break
            self._run(_LONG_STEP)
            self._run("CREATE OR REPLACE TEMP TABLE long_rows AS SELECT * FROM long_next")
        got = self.db.sql("SELECT k >> 32 AS piece, tok FROM long_done ORDER BY k").to_arrow_table()
        at = np.searchsorted(got.column("piece").to_numpy(), np.arange(len(pieces) + 1)) * 4
        flat = got.column("tok").to_numpy().astype(np.int32).tobytes()
        return [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def cut(self, piece: bytes) -> list[bytes]:
        """The piece cut between the bytes that no token of the vocabulary spans in it."""
        if self.spans is None:
            import ahocorasick
            self.spans = ahocorasick.Automaton()
            for t in self.ranks:
                if len(t) > 1:
                    self.spans.add_word(t.decode("latin-1"), len(t))
            self.spans.make_automaton()
        covered = np.zeros(len(piece) + 1, np.int64)         # how many tokens span the place before each byte
        found = np.array(list(self.spans.iter(piece.decode("latin-1"))), np.int64).reshape(-1, 2)
        np.add.at(covered, found[:, 0] - found[:, 1] + 2, 1)
        np.add.at(covered, found[:, 0] + 1, -1)
        at = [0, *(np.nonzero(np.cumsum(covered)[1:-1] == 0)[0] + 1).tolist(), len(piece)]
        return [piece[a:b] for a, b in zip(at, at[1:])]

    def contract(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (int32 bytes) of each piece (a piece that is a token of its own stays whole)."""
        out: list = [None] * len(pieces)
        short, long = [], []
        for i, p in enumerate(pieces):
            if p in self.ranks:
                out[i] = np.int32(self.ranks[p]).tobytes()
            else:
                (long if len(p) > LONG_PIECE else short).append(i)
        for own, power, most, run in ((short, 2, BATCH_WORK, self._short), (long, 1, LONG_BATCH, self._long)):
            held, group = 0, []
            for i in own:
                group.append(i)
                held += len(pieces[i]) ** power
                if held >= most or i == own[-1]:
                    for j, ids in zip(group, run([pieces[j] for j in group])):
                        out[j] = ids
                    held, group = 0, []
        return out

    def _learn(self, segments: list[str]) -> list[bytes]:
        split = [self.find(s) for s in segments]
        distinct = list(dict.fromkeys(p for s in split for p in s))
        parts = [[p] if len(p) <= LONG_PIECE or p in self.ranks else self.cut(p) for p in map(str.encode, distinct)]
        met = list(dict.fromkeys(q for x in parts for q in x))
        ids = dict(zip(met, self.contract(met)))
        of = {p: ids[x[0]] if len(x) == 1 else b"".join([ids[q] for q in x]) for p, x in zip(distinct, parts)}
        return [b"".join([of[p] for p in s]) for s in split]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; distinct segments are contracted once.  Texts are taken
        together up to ``TEXT_BYTES``, whose segments take ten times as much."""
        out, group, held = [], [], 0
        for n, t in enumerate(texts, 1):
            group.append(space_segments(t))
            held += len(t)
            if held >= TEXT_BYTES or n == len(texts):
                of = self.memo.known(chain.from_iterable(group), self._learn)
                out += [np.frombuffer(b"".join([of[s] for s in x]), np.int32) for x in group]
                group, held = [], 0
        return out

    def as_text(self, ids: list[np.ndarray]) -> pa.Array:
        """The ids of each text as decimals joined by one space."""
        ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int64())
        flat = self.decimal.take(pa.array(np.concatenate(ids) if ids else [], pa.int32()))
        return pc.binary_join(pa.LargeListArray.from_arrays(ends, flat), " ")

    def decode(self, docs: list[np.ndarray]) -> list[bytes]:
        """Bytes of each id sequence; long sequences are decoded in chunks and joined."""
        out = [[] for _ in docs]
        todo, held = [], 0

        def flush():
            if todo:
                n = np.array([len(t) for _, t in todo])
                self.db.register("id_rows", pa.table({
                    "chunk": np.repeat(np.arange(len(todo), dtype=np.int32), n),
                    "pos": np.arange(n.sum(), dtype=np.int32), "tok": np.concatenate([t for _, t in todo])}))
                got = self.db.sql(_DECODE).to_arrow_table()
                self.db.unregister("id_rows")
                for c, b in zip(got.column("chunk").to_pylist(), got.column("bytes").to_pylist()):
                    out[todo[c][0]].append(b.encode("latin-1"))
            todo.clear()

        for i, ids in enumerate(docs):
            for s in range(0, len(ids), DECODE_TOKENS):
                todo.append((i, ids[s:s + DECODE_TOKENS]))
                held += len(todo[-1][1])
                if held >= DECODE_TOKENS:
                    flush()
                    held = 0
        flush()
        return [b"".join(x) for x in out]


def _bpe(ranks_path: str, pattern: str) -> Bpe:
    return worker_state(("bpe", ranks_path, pattern), lambda: Bpe(ranks_path, pattern))


_ROWS = 2_000  # texts encoded together


def _texts(batches):
    """(ids, texts) of at most ``_ROWS`` rows and, but for a longer text alone, ``TEXT_BYTES``.
    What each part leaves free goes back to the system, as an executor's workers hold it beside the JVM."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
        s = 0
        while s < b.num_rows:
            most = (ends[s - 1] if s else 0) + TEXT_BYTES
            e = max(s + 1, min(s + _ROWS, int(np.searchsorted(ends, most, "right"))))
            part = b.slice(s, e - s)
            yield part.column(0), [t.decode("utf-8", "replace") for t in part.column(1).to_pylist()]
            release()
            s = e


def _source(df: DataFrame, id_col: str, text_col: str):
    src = df.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("text"))
    return src, src.schema["id"].dataType.simpleString()


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): token ids of each row's text, one row per input row.

    ``ranks_path`` is a file of base64 tokens with ranks (tiktoken form) on the
    executors.  Null and empty texts have no ids; null ids and repeated rows are
    kept; an empty table gives an empty result."""
    def run(batches):
        bpe = _bpe(ranks_path, pattern)
        for ids, texts in _texts(batches):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(bpe.encode(texts), pa.list_(pa.int32()))], names=["id", "ids"])

    src, kind = _source(df, id_col, text_col)
    return map_arrow(src, run, f"id {kind}, ids array<int>", keeps=True)


def decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes): the bytes that each row's ids stand for.

    A null or empty list of ids gives no bytes; ids outside the vocabulary (or
    null ones) raise an error; null ids of rows and repeated rows are kept."""
    def run(batches):
        bpe = _bpe(ranks_path, pattern)
        known = set(bpe.ranks.values())
        for b in batches:
            docs = [np.array(x or [], object) for x in b.column(1).to_pylist()]
            for d in docs:
                if not known.issuperset(d.tolist()):
                    raise ValueError("ids outside the vocabulary")
            got = bpe.decode([d.astype(np.int32) for d in docs])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], names=["id", "bytes"])

    src = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return map_arrow(src, run, f"id {src.schema['id'].dataType.simpleString()}, bytes binary", keeps=True)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode each text, decode its ids.

    Digests are of the decimal ids joined by one space and of the decoded bytes.
    Null and empty texts have 0 tokens and the digests of nothing; rows are as in
    ``encode``."""
    def run(batches):
        bpe = _bpe(ranks_path, pattern)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for ids, texts in _texts(batches):
            got = bpe.encode(texts)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(x) for x in got], pa.int64()), pa.array([sha(d.as_buffer()) for d in bpe.as_text(got)]),
                pa.array([sha(d) for d in bpe.decode(got)])],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src, kind = _source(df, id_col, text_col)
    return map_arrow(src, run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", keeps=True)
