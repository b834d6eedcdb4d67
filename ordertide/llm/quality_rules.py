"""Quality rules over documents and lines, in DataFrame functions only.

Per-document rules use array functions and need no shuffle.  Across documents,
lines are normalised and hashed, distinct documents are counted per host and line,
lines found in too many are removed, and documents left with too little text are
rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_WORDS = 50
MAX_REPEAT = 50           # per cent of words in repeated windows
MAX_DOCS = 25             # a line may be in so many documents of a host
MIN_LEFT = 0.3            # share of its words that a document must keep
SALT = 16
FEW = 8                   # repeated windows of a text that are looked up one by one


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def repeated_window_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the array ``w``.

    The windows' hashes are sorted to find those that repeat.  Few of them are then
    looked up window by window; of many, the windows are sorted with their places."""
    none = F.array().cast("array<bigint>")
    hashes = F.coalesce(F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(
        F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))), none)

    def repeats(h: Column) -> Column:
        again = _let(F.sort_array(h), lambda s: F.filter(s, lambda x, j: (j > 0) & (F.get(s, j - 1) == x)))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(F.array_distinct(again))

    def places(h: Column) -> Column:
        windows = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        found = _let(F.sort_array(windows), lambda s: F.filter(s, lambda x, j: F.coalesce(
            (F.get(s, j - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))))
        return F.transform(found, lambda x: x["i"])

    def covered(at: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    return _let(hashes, lambda h: _let(repeats(h), lambda r: F.when(F.size(r) == 0, 0)
                .when(F.size(r) <= FEW, covered(F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(r, x), i)), lambda i: i.isNotNull())))
                .otherwise(covered(places(h))))).cast("long")


def _lower(text: Column) -> Column:
    """A-Z in lower case (``lower`` is that for ASCII alone, and faster)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def document_facts(text: Column, host: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and ``lines``.

    ``lines`` is an array of (a, b, words, first): 128-bit key of host and normalised
    line, words in the line, and whether it is the key's first entry of the document."""
    full = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def key(line: Column) -> Column:
        return _let(_lower(F.array_join(line, " ")), lambda norm: F.struct(
            F.xxhash64(F.lit(1), host, norm).alias("a"), F.xxhash64(F.lit(2), host, norm).alias("b"), F.size(line).alias("words")))

    def marked(keys: Column) -> Column:
        return _let(F.sort_array(keys), lambda s: F.transform(s, lambda k, j: F.struct(
            k["a"].alias("a"), k["b"].alias("b"), k["words"].alias("words"),
            F.when((F.get(s, j - 1)["a"] == k["a"]) & (F.get(s, j - 1)["b"] == k["b"]), 0).otherwise(1).alias("first"))))

    # the words of a text are those of its lines: one split serves both
    return _let(F.transform(full, words), lambda by_line: _let(F.flatten(by_line), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        _let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_window_words(w).alias("n_repeat_words"),
        marked(F.transform(by_line, key)).alias("lines"))))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_removed_words, kept): one row per input row.

    ``base_failed``: fewer than 50 words, or over half of them in repeated windows.
    ``n_removed_words`` are the words of lines that more than ``max_docs`` documents of
    the host hold; ``kept`` is false if ``base_failed`` or less than ``min_left`` of
    the words is left.

    Null texts count as empty (no words, hence failed); null hosts are one host of
    their own; rows with the same id, host and text are one document, and each gets
    its result.  An empty table gives an empty result.  Lines are compared by 128-bit
    hashes of host and words, windows by 64-bit hashes within a document.  A line that
    very many documents hold is pre-aggregated for the count and salted in the join.
    Texts are read once; what is kept of them, counts and line keys, is a written table."""
    host = F.coalesce(F.col("host"), F.lit("\0"))
    src = df.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    same = [F.xxhash64(F.lit(k), "id", "host", "text").alias(f"r{k}") for k in (1, 2)]
    docs = src.select("id", *same, document_facts(F.col("text"), host).alias("s"))
    docs = written(docs.select("id", "r1", "r2", "s.*", F.monotonically_increasing_id().alias("r")), "quality-facts")

    again = docs.groupBy("r1", "r2").agg(F.min("r").alias("one"), F.count("*").alias("copies")).where("copies > 1")
    copies = docs.join(again, ["r1", "r2"]).where("r <> one").select("r")
    lines = docs.select("r", F.explode("lines").alias("k")).select("r", "k.*")
    common = docs.join(copies, "r", "left_anti").select(F.explode("lines").alias("k")).select("k.*")
    common = common.groupBy("a", "b").agg(F.sum("first").alias("docs")).where(F.col("docs") > max_docs).select(
        F.col("a").alias("ca"), F.col("b").alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("cs"))
    removed = (lines.withColumn("salt", F.pmod("r", F.lit(SALT)))
               .join(common, (F.col("a") == F.col("ca")) & (F.col("b") == F.col("cb")) & (F.col("salt") == F.col("cs")))
               .groupBy(F.col("r").alias("q")).agg(F.sum("words").alias("gone")))
    out = docs.drop("lines").join(removed, F.col("r") == F.col("q"), "left").withColumn(
        "n_removed_words", F.coalesce(F.col("gone"), F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words") >= min_left * F.col("n_words")
    return (out.withColumn("base_failed", failed).withColumn("kept", ~failed & left)
            .select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "n_removed_words", "kept"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text,
                  row_number() OVER (ORDER BY doc_id) AS r FROM documents),
w AS (SELECT r, doc_id, text, [x FOR x IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM d),
win AS (SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
ln AS (SELECT r, host, unnest(string_split(text, chr(10))) AS line FROM d),
full_line AS (SELECT r, host, line, [x FOR x IN regexp_split_to_array(translate(line,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS key FROM ln),
lined AS (SELECT * FROM full_line WHERE len(key) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lined GROUP BY r),
freq AS (SELECT host, key FROM lined GROUP BY host, key HAVING count(DISTINCT r) > 25),
gone AS (SELECT r, sum(len(key)) AS n FROM lined JOIN freq USING (host, key) GROUP BY r),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(w.text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             coalesce(gone.n, 0)::BIGINT AS n_removed_words
      FROM w LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_removed_words,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words >= 0.3 * n_words AS kept
FROM m
"""
