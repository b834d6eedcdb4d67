"""Merkle manifest of a dataset, level by level, by lag and lead windows.

Rows are leaves of a tree per group (a source), the group roots are leaves of one
tree above them.  A level is a table of nodes with their place in the group: fixed
lag and lead offsets, masked by the node's slot and the length of its run of
``FAN`` nodes, supply its siblings, and the first row of each run hashes the parent.
Windows are cut into blocks of ``BLOCK`` places, so a hot group spreads over many
tasks; places come from a range partitioning and a count per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import written

FAN = 16
BLOCK = FAN ** 3          # places of a group that one window sorts
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes of the texts, one after the other."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: byte count, colon and text, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def placed(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` (with a column ``g``) plus ``pos``, the place from 0 within ``g`` by
    ``order``, and ``n``, the number of rows of ``g``."""
    rows = written(df.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
                   .withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    task = F.shiftright("at", 33).alias("task")
    tasks = rows.groupBy("g", task).agg(F.min("at").alias("first"), F.count("*").alias("m"))
    of = Window.partitionBy("g")      # one row per task and group
    tasks = tasks.withColumn("n", F.sum("m").over(of)).withColumn(
        "before", F.sum("m").over(of.orderBy("task").rowsBetween(Window.unboundedPreceding, 0)) - F.col("m"))
    return (rows.withColumn("task", task).join(tasks.drop("m"), ["g", "task"])
            .withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("at", "task", "first", "before"))


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes of a level plus ``slot``, the joined digests of the siblings ``left`` and
    ``right`` of them, and ``parent`` on the first row of each run."""
    slot = F.pmod("pos", F.lit(FAN))
    run = F.least(F.lit(FAN), F.col("n") - F.col("pos") + slot)
    w = Window.partitionBy("g", F.expr(f"pos div {BLOCK}")).orderBy("pos")
    before = [F.when(slot >= j, F.lag("h", j).over(w)) for j in range(FAN - 1, 0, -1)]
    after = [F.when(slot + j < run, F.lead("h", j).over(w)) for j in range(1, FAN)]
    out = nodes.select("*", slot.alias("slot"), F.concat_ws("", *before).alias("left"), F.concat_ws("", *after).alias("right"))
    return out.withColumn("parent", F.when(F.col("slot") == 0, digest(F.col("h"), F.col("right"))))


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Level tables from the leaves up, and the roots (g, h, height)."""
    levels, roots = [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(nodes.where("n = 1").select("g", "h", F.lit(len(levels)).alias("height")))
        if most <= 1:
            break
        level = written(with_siblings(nodes.where("n > 1")), "merkle-level")
        levels.append(level)
        nodes = level.where("slot = 0").select("g", F.expr(f"pos div {FAN}").alias("pos"),
                                               F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), F.col("parent").alias("h"))
        most = -(-most // FAN)
    return levels, written(reduce(DataFrame.unionByName, roots), "merkle-roots")


def paths(levels: list[DataFrame], roots: DataFrame, single: DataFrame, carry: list[str]) -> DataFrame:
    """The leaves with ``path``, the siblings of every level up, and the columns
    ``carry`` of the root of their group.

    ``roots`` has g, height, path (from the root up) and ``carry``; ``single`` are the
    leaves that are a group of their own.  A parent is looked up by group and place,
    at most ``FAN`` nodes a key."""
    up = None
    for k in range(len(levels) - 1, -1, -1):
        own = F.col("height") == k + 1
        parents = roots.where(own).select("g", F.lit(0).cast("long").alias("above"), F.col("path").alias("rest"), *carry)
        if up is not None:
            parents = parents.unionByName(up.select("g", F.col("pos").alias("above"), F.col("path").alias("rest"), *carry))
        step = F.array(F.struct("left", "right"))
        up = (levels[k].withColumn("above", F.expr(f"pos div {FAN}")).join(parents, ["g", "above"])
              .withColumn("path", F.concat(step, "rest")).drop("above", "rest", "slot", "left", "right", "parent"))
    alone = single.join(roots.where("height = 0").drop("height"), "g")
    return alone if up is None else up.unionByName(alone)


def folded(own: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, own, lambda h, s: digest(s["left"], h, s["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(df: DataFrame, leaf_columns: list[str], id_col: str = "doc_id", group_col: str = "source",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, subroot, root, path) and the ``carry`` expressions: one row per input row.

    Each row is a leaf, the digest of ``leaf_columns``.  The leaves of a group ascend
    by id, equal ids by leaf; null ids come first, and null groups are one group, the
    first.  Repeated rows are leaves of their own.  Groups ascend bytewise.  An empty
    table gives an empty result.  ``path`` has the joined digests of the siblings to
    the left and right per level, through the group root to the root."""
    group = F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group_col).cast("string")))
    carry = carry or {}
    leaves = written(df.select(group.alias("g"), F.col(id_col).alias("id"), leaf(*[F.col(c) for c in leaf_columns]).alias("h"),
                               *[e.alias(c) for c, e in carry.items()]), "merkle-leaves")
    nodes = placed(leaves, ["id", "h"])
    levels, roots = climb(nodes)

    tops = placed(roots.select(F.lit("").alias("g"), F.col("g").alias("own"), F.col("h"), F.col("height").alias("own_height")), ["own"])
    top_levels, top = climb(tops)
    found = top.first()
    none = F.array().cast(_PATH)
    top_paths = paths(top_levels, top.select("g", "height", none.alias("path")), tops.where("n = 1"), [])
    known = written(top_paths.select(F.col("own").alias("g"), F.col("h").alias("subroot"), F.col("own_height").alias("height"), "path"),
                    "merkle-subroots")
    out = paths(levels, known, nodes.where("n = 1"), ["subroot"])
    return out.select("id", F.col("h").alias("leaf"), "subroot", F.lit(found["h"] if found else None).cast("string").alias("root"),
                      "path", *carry)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, n_chars, lang, row_number() OVER () AS r,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
               FOR c IN regexp_extract_all(coalesce(doc_id::VARCHAR, ''), '.')])),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END),
             4294967295) % 5 = 0 AS forge
  FROM documents),
f AS (SELECT r, doc_id, source, forge,
             coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
             coalesce(strlen(text) || ':' || text, '-') AS body,
             coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low
      FROM d),
l AS (SELECT r, doc_id, source, sha256(head || body) AS leaf, sha256(head || CASE WHEN forge THEN low ELSE body END) AS given FROM f),
tree AS (
  SELECT source, 0 AS lvl, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h, r,
         count(*) OVER (PARTITION BY source) AS n
  FROM l
  UNION ALL
  SELECT source, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), NULL, (n + 15) // 16
  FROM tree WHERE n > 1 GROUP BY source, lvl, pos // 16, n),
top AS (
  SELECT 0 AS lvl, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, h, source, count(*) OVER () AS n
  FROM tree WHERE n = 1
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), NULL, (n + 15) // 16
  FROM top WHERE n > 1 GROUP BY lvl, pos // 16, n),
sib AS (
  SELECT a.source, a.lvl, a.pos, a.n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi
  FROM tree a JOIN tree b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.pos // 16 = b.pos // 16
  GROUP BY a.source, a.lvl, a.pos, a.n),
topsib AS (
  SELECT a.lvl, a.pos, a.n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi
  FROM top a JOIN top b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 GROUP BY a.lvl, a.pos, a.n),
up AS (
  SELECT t.r, t.source, 0 AS lvl, t.pos, t.n, l.given AS cur, '' AS proof FROM tree t JOIN l ON l.r = t.r WHERE t.lvl = 0
  UNION ALL
  SELECT u.r, u.source, u.lvl + 1, u.pos // 16, (u.n + 15) // 16, sha256(s.lo || u.cur || s.hi), u.proof || s.lo || s.hi
  FROM up u JOIN sib s ON s.source IS NOT DISTINCT FROM u.source AND s.lvl = u.lvl AND s.pos = u.pos WHERE u.n > 1),
over AS (
  SELECT u.r, 0 AS lvl, t.pos, t.n, u.cur, u.proof
  FROM up u JOIN top t ON t.lvl = 0 AND t.source IS NOT DISTINCT FROM u.source WHERE u.n = 1
  UNION ALL
  SELECT o.r, o.lvl + 1, o.pos // 16, (o.n + 15) // 16, sha256(s.lo || o.cur || s.hi), o.proof || s.lo || s.hi
  FROM over o JOIN topsib s ON s.lvl = o.lvl AND s.pos = o.pos WHERE o.n > 1)
SELECT l.doc_id, l.leaf, t.h AS subroot, root.h AS root, sha256(o.proof) AS proof_sha256, o.cur AS folded_root, o.cur = root.h AS verified
FROM l JOIN over o ON o.r = l.r AND o.n = 1
JOIN tree t ON t.n = 1 AND t.source IS NOT DISTINCT FROM l.source
JOIN top root ON root.n = 1
"""
