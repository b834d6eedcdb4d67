"""SimHash near-duplicates, found by the generalised pigeonhole principle.

A 64-bit fingerprint is taken over word shingles.  Fingerprints within ``bits``
differing bits are linked and documents get the smallest id of their component.

Linking never compares all pairs.  The 64 bits are grouped into partitions that
keep correlated bits together.  Give each partition ``u`` of ``bits + 1`` units:
if two fingerprints differ in at most ``bits`` bits, some partition differs in
fewer bits than its units (a partition without units is not probed).  Each
fingerprint gets its own allocation: a dynamic programme over the partitions
minimises the estimated work, from candidate counts in a bounded sample.  It then
probes every signature inside the radius; hits are verified on all 64 bits.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow, prepare, text_bytes, written
from ordertide.llm.graph import components

SEED = 42
SAMPLE = 2048            # distinct fingerprints used to plan partitions and estimate candidates
SIGNATURE_COST = 1.0     # one probe row against ...
CANDIDATE_COST = 0.02    # ... one candidate to verify (about 30 ns against 1.5 us)
_HASH_BLOCK = 1 << 16    # shingles hashed at a time


def simhash(text: bytes, shingle: int = 4) -> int:
    """Unsigned 64-bit fingerprint; 0 for a text without words."""
    words = text.lower().split()            # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    digest, count = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, n, _HASH_BLOCK):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[i:i + _HASH_BLOCK], ends[i:i + _HASH_BLOCK])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64)
        count += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): one row per input row; ``fp`` is the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.fromiter((simhash(t, shingle) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    src = df.select(F.col(id_col).cast("long").alias("id"), text_bytes(F.col(text_col)).alias("text"))
    return map_arrow(src, run, "id long, fp long")


# ---- plan ------------------------------------------------------------------

def _bit_matrix(fps: np.ndarray) -> np.ndarray:
    return ((fps[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)


def group_bits(fps: np.ndarray, parts: int) -> list[list[int]]:
    """Partition the 64 bits greedily: each partition starts from the strongest pair
    left and takes the bit most correlated with it until it is full."""
    x = _bit_matrix(fps)
    x = x - x.mean(0) if len(x) else x
    norm = np.sqrt((x * x).sum(0))
    norm[norm == 0] = 1
    corr = np.abs((x / norm).T @ (x / norm))
    np.fill_diagonal(corr, 0)
    free, out = list(range(64)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        sub = corr[np.ix_(free, free)]
        own = [free[int(sub.max(1).argmax())]]
        free.remove(own[0])
        while len(own) < size:
            best = max(free, key=lambda b: (corr[b, own].mean(), -b))
            own.append(best)
            free.remove(best)
        out.append(sorted(own))
    return out


def masks_of(groups: list[list[int]]) -> list[int]:
    return [sum(1 << b for b in g) for g in groups]


def work_table(queries: np.ndarray, sample: np.ndarray, total: int, masks: list[int], bits: int) -> np.ndarray:
    """[query, partition, units]: estimated work of probing within ``units - 1`` bits."""
    out = np.zeros((len(queries), len(masks), bits + 2))
    scale = CANDIDATE_COST * total / max(1, len(sample))
    for i, m in enumerate(masks):
        width = bin(m).count("1")
        d = np.bitwise_count((queries[:, None] ^ sample[None, :]) & np.uint64(m))
        for u in range(1, bits + 2):
            probes = sum(comb(width, r) for r in range(u))
            out[:, i, u] = SIGNATURE_COST * probes + scale * (d < u).sum(1)
    return out


def allocate(work: np.ndarray, bits: int) -> np.ndarray:
    """Units per [query, partition], summing to ``bits + 1`` with the least total work."""
    n, parts, _ = work.shape
    best = np.full((n, bits + 2), np.inf)
    best[:, 0] = 0
    choice = np.zeros((parts, n, bits + 2), np.int8)
    for i in range(parts):
        nxt = np.full_like(best, np.inf)
        for s in range(bits + 2):
            options = np.stack([best[:, s - u] + work[:, i, u] for u in range(s + 1)])
            choice[i, :, s] = options.argmin(0)
            nxt[:, s] = options.min(0)
        best = nxt
    left, units = np.full(n, bits + 1), np.zeros((n, parts), np.int8)
    for i in reversed(range(parts)):
        units[:, i] = choice[i, np.arange(n), left]
        left = left - units[:, i]
    return units


def choose_masks(sample: np.ndarray, total: int, bits: int) -> list[int]:
    """Masks of the number of partitions whose best allocations need the least work."""
    best = None
    queries = sample[:256]
    for parts in range(1, bits + 2):
        masks = masks_of(group_bits(sample, parts))
        work = work_table(queries, sample, total, masks, bits)
        units = allocate(work, bits)
        cost = np.take_along_axis(work, units[:, :, None].astype(int), 2).sum()
        if best is None or cost < best[0]:
            best = (cost, masks)
    return best[1]


# ---- probe and verify --------------------------------------------------------

def _flips(mask: int, units: int) -> np.ndarray:
    own = [1 << b for b in range(64) if mask >> b & 1]
    return np.array([sum(c) for r in range(units) for c in combinations(own, r)], np.uint64)


def links(fps: DataFrame, bits: int) -> DataFrame:
    """(a, b): all pairs of different fingerprints at most ``bits`` bits apart.

    ``fps`` has one column ``fp`` of distinct values.  Only a bounded sample of
    them (``SAMPLE``, smallest hashes) reaches the driver.  Both join sides are
    plain shuffled rows, so adaptive execution splits a frequent signature."""
    total = fps.count()
    picked = fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    sample = np.array([r.fp for r in picked], np.int64).view(np.uint64)
    masks = choose_masks(sample, total, bits)

    def probes(batches):
        flips = {}
        for b in batches:
            all_fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(all_fps), 512):
                q = all_fps[k:k + 512]
                units = allocate(work_table(q, sample, total, masks, bits), bits)
                for i, m in enumerate(masks):
                    for u in range(1, bits + 2):
                        own = q[units[:, i] == u]
                        if not len(own):
                            continue
                        if (i, u) not in flips:
                            flips[i, u] = _flips(m, u)
                        f, step = flips[i, u], max(1, 200_000 // len(flips[i, u]))
                        for j in range(0, len(own), step):
                            part = own[j:j + step]
                            sig = ((part & np.uint64(m))[:, None] ^ f[None, :]).ravel()
                            yield pa.RecordBatch.from_arrays([
                                pa.array(np.full(len(sig), i, np.int32)), pa.array(sig.view(np.int64)),
                                pa.array(np.repeat(part, len(f)).view(np.int64))], names=["part", "sig", "a"])

    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    probe = map_arrow(fps.select("fp"), probes, "part int, sig long, a long")
    data = fps.select(F.col("fp").alias("b"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("sig"))
        for i, m in enumerate(signed)])).alias("s")).select("b", "s.part", "s.sig")
    near = (probe["part"] == data["part"]) & (probe["sig"] == data["sig"]) & (
        probe["a"] != data["b"]) & (F.bit_count(probe["a"].bitwiseXOR(data["b"])) <= bits)
    return probe.join(data, near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, bits: int = 4) -> DataFrame:
    """(id, fingerprint, component_id, component): one row per input row.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest id reachable
    over links of at most ``bits`` differing bits, the row's own id included;
    ``component`` names the group by one of its fingerprints, also where texts of
    several groups share an id.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other.  Repeated rows are kept, each with its component.  A row whose id is
    null keeps its fingerprint, never names a component and gets the component of
    its fingerprint if another row gives it one, else null.  An empty table gives
    an empty result."""
    docs = written(fingerprints(df, id_col, text_col, shingle), "simhash-fp")
    nodes = written(docs.groupBy("fp").agg(F.min("id").alias("first")), "simhash-nodes")
    near = components(links(nodes.select("fp"), bits), "a", "b")
    rooted = nodes.join(near, nodes["fp"] == near["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = rooted.join(least, "root").select(F.col("fp").alias("node_fp"), "component_id", "root")
    return docs.join(of_fp, docs["fp"] == of_fp["node_fp"], "left").select(
        "id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id", hexadecimal(F.col("root")).alias("component"))


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """The fingerprint of a text column as 16 hex digits, beside other columns."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([f"{simhash(t, shingle):016x}" for t in texts.to_pylist()], pa.string())

    return F.arrow_udf(run, returnType="string")(text_bytes(text))


def one_of_each_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, bits: int = 4) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each group the row of the smallest id
    stays (of its rows that of the smallest fingerprint, then the least text).  Rows are
    judged by their own text: others under the same id aren't touched.  Rows with a null
    id belong to no group and stay."""
    prepare(df.sparkSession)
    kinds = written(near_duplicates(df, id_col, text_col, shingle, bits).where("id IS NOT NULL"), "simhash-kinds")
    first = kinds.groupBy("component").agg(F.min(F.struct("id", "fingerprint")).alias("k")).select("k.*")
    key = ["id", "fingerprint"]
    gone = kinds.join(first, key, "left_anti").select(F.col("id").alias("gone")).distinct()
    several = kinds.groupBy("id").count().where("count > 1").select(F.col("id").alias("several"))
    once = df.join(several, df[id_col] == several["several"], "left_anti")
    once = once.join(gone, once[id_col] == gone["gone"], "left_anti")
    # ids with several rows: each row by its own fingerprint
    rows = df.join(several, df[id_col] == several["several"], "left_semi")
    rows = rows.withColumn("__fp", fingerprint(F.col(text_col), shingle))
    first = first.select(F.col("id").alias("__id"), F.col("fingerprint").alias("__keep"))
    rows = rows.join(first, (rows[id_col] == first["__id"]) & (rows["__fp"] == first["__keep"]), "left_semi")
    least = Window.partitionBy(id_col, "__fp").orderBy(F.coalesce(F.col(text_col), F.lit("None")), *[c for c in df.columns if c not in (id_col, text_col)])
    rows = rows.withColumn("__n", F.row_number().over(least)).where("__n = 1")
    return once.unionByName(rows.select(*df.columns))
