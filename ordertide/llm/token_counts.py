"""Token counts by the library tokenizer, without keeping the tokens.

Arrow functions encode batches and return lengths only.  A text is cut at places
where the tokenizer itself always starts a new piece, so the lengths of its pieces
add up and no call holds a very long text.  Distinct pieces are gathered into
batches of about equal bytes, whatever their number, and encoded once.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow, Memo, space_segments, text_bytes, worker_state

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 16
MEMO = 400_000            # pieces a worker remembers, see Memo
#: Further safe places for byte-level BPE: around one line feed, between a letter and a digit of ASCII.
_SAFE = re.compile(r"(?<=\S)(?=\n\S)|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


def pieces(text: str) -> list[str]:
    """Segments of the text, very long ones cut at further safe places (none left: they stay whole)."""
    out = space_segments(text)
    if not out or max(map(len, out)) <= PIECE_CHARS:
        return out
    return [q for p in out for q in _cut(p)]


def _cut(text: str) -> list[str]:
    out, start = [], 0
    while len(text) - start > PIECE_CHARS and (m := _SAFE.search(text, start + PIECE_CHARS)):
        out.append(text[start:m.start()])
        start = m.start()
    return [*out, text[start:]]


def _encoder(path: str):
    """(lengths of a list of texts, whether long texts may be cut)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]), False
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    byte_level = t.normalizer is None and "ByteLevel" in str(t.pre_tokenizer) and "add_prefix_space=False" in str(t.pre_tokenizer)
    return (lambda texts: [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)]), byte_level


_ROWS = 4_000  # texts taken together


class Counter:
    """Encoder and memo of one worker process."""

    def __init__(self, path: str):
        self.encode, self.cut = _encoder(path)
        self.memo = Memo(MEMO)

    def encode_all(self, new: list[str]) -> list[int]:
        out, start, held = [], 0, 0
        for i, p in enumerate(new):
            held += len(p.encode())
            if held >= BATCH_BYTES or i + 1 == len(new):
                out += self.encode(new[start:i + 1])
                start, held = i + 1, 0
        return out

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Token count of each text; pieces not met before are encoded in batches of about ``BATCH_BYTES``."""
        if not self.cut:
            return np.array(self.encode_all(texts), np.int64)
        split = [pieces(t) for t in texts]
        of = self.memo.known((p for x in split for p in x), self.encode_all)
        return np.array([sum([of[p] for p in x]) for x in split], np.int64)


def lengths(texts: list[str], path: str) -> np.ndarray:
    """Token count of each text."""
    return worker_state(("token counts", path), lambda: Counter(path)).lengths(texts)


def token_counts(df: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit): one row per input row.

    ``vocab`` is the path of a tokenizers ``.json`` or sentencepiece ``.model``
    file on the executors.  No begin, end or added special tokens; strings of
    special tokens inside a text count as the library takes them by default.
    Null and empty texts have 0 bytes and 0 tokens; null ids and repeated rows
    are kept; an empty table gives an empty result.  Files whose split rules are
    not byte-level get whole texts (no safe places are known for them)."""
    def run(batches):
        for ids, raw in ((b.column(0).slice(s, _ROWS), b.column(1).slice(s, _ROWS).to_pylist())
                         for b in batches for s in range(0, b.num_rows, _ROWS)):
            n = lengths([r.decode("utf-8", "replace") for r in raw], vocab)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(r) for r in raw], pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    src = df.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return map_arrow(src, run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean", keeps=True)
