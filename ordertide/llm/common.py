"""Shared helpers: table access, shared working folders and written tables.

Operators read only the columns they name, so extra columns of the input (also
ones whose names clash with an operator's own) never matter.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a scratch folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder; it is not created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and
    a lost executor costs no recomputation."""
    path = work_dir(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python
    workers can import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_ordertide_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ordertide-"), "ordertide_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    f = os.path.join(folder, n)
                    z.write(f, os.path.relpath(f, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._ordertide_shipped = True


def prepare(spark: SparkSession) -> None:
    """Before Python functions run: this package on the executors, and Arrow batches
    bounded by bytes too (a session that sets a bound keeps its own)."""
    ship(spark)
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, "16m")


def map_arrow(df: DataFrame, fn, schema: str, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` with this package on the executors and bounded batches; ``keeps``
    says that ``fn`` uses ``worker_state``."""
    def run(batches):
        if not keeps:
            forget()
        yield from fn(batches)

    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


_state: dict = {}


def worker_state(key, make):
    """What a Python worker keeps between tasks (tables, memos): the state of one key
    at a time.  Tasks that keep nothing drop it, so that a worker which Spark uses
    again doesn't carry the memory of an earlier stage."""
    if key not in _state:
        forget()
        _state[key] = make()
    return _state[key]


def forget() -> None:
    """Drop the kept state and give freed memory back to the system."""
    if _state:
        _state.clear()
        gc.collect()
    release()


def release() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # a function of glibc
    if trim:
        trim(0)


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(col: Column) -> Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(col.cast("string"), F.lit("")).cast("binary")


_OTHER_SPACE = re.compile("[\\0\\t\\v\\f\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def space_segments(text: str) -> list[str]:
    """Cut before single spaces that stand between two characters that are not white
    space.  The split patterns of byte-level BPE start a new piece at each of these,
    whatever surrounds it, and no special string holds a space: segments can be
    encoded apart.  An empty text has no segments."""
    if not text:
        return []
    if not ("  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " "
            or _OTHER_SPACE.search(text)):
        return text.replace(" ", "\0 ").split("\0")
    out, open_end = [], True
    for w in text.split(" "):
        if out and (open_end or not w or w[0].isspace()):
            out[-1] += " " + w
        else:
            out.append(" " + w if out else w)
        open_end = not w or w[-1].isspace()
    return out


class Memo:
    """What a worker remembers of the keys it has met: two generations of at most
    ``size`` keys of together ``chars`` characters each, and none longer than ``longest``,
    so memory is bounded and frequent keys stay.  It saves work and never changes a
    result."""

    def __init__(self, size: int, chars: int = 16 << 20, longest: int = 4096):
        self.size, self.chars, self.longest = size, chars, longest
        self.young, self.old, self.held, self.passing = {}, {}, 0, []

    def known(self, keys, learn) -> dict:
        """A dict that holds all ``keys`` until the next call; ``learn`` gives the values of a
        list of new ones."""
        for k in self.passing:
            del self.young[k]
        self.passing = []
        if len(self.young) > self.size or self.held > self.chars:
            self.young, self.old, self.held = {}, self.young, 0
        young, old, new = self.young, self.old, []
        for k in dict.fromkeys(keys):
            if k not in young:
                if k in old:
                    young[k] = old[k]
                    self.held += len(k)
                else:
                    new.append(k)
        if new:
            young.update(zip(new, learn(new)))
            self.passing = [k for k in new if len(k) > self.longest]
            self.held += sum(map(len, new))
        return young
