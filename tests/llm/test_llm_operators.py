"""Training-data operators against brute force, on edge cases and on the small tables."""

import base64
import hashlib
import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordertide.llm.common import Memo, forget
from ordertide.llm import (bpe, decontamination, line_dedup, lm, quality, quality_rules, queries, simhash,
                           token_counts, toxicity, warc)

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
P = pytest.importorskip("public_tokenizers")
LONG_LINE = "This line of text is held by several documents."


def edge_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty, blank, copies, ties, repeated ids, long texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    long = " ".join(word() for _ in range(30_000))
    base = " ".join(word() for _ in range(120))
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "no id at all\n" + LONG_LINE), (4, base), (5, base), (6, base + " tail"),
            (6, base + " tail"), (7, long), (8, "x" * 50_000), (9, "The  The \r\n" + LONG_LINE + "\n" + LONG_LINE.upper()),
            (10, LONG_LINE + "\nown line number ten"), (11, "\n" + LONG_LINE + "  "), (12, "É漢字 <|endoftext|> don't 12ab's"),
            (None, None), (13, "a b c"), (13, "a b d")]
    return [(i, t, "en", None if k % 5 == 0 else "host", None) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    # columns whose names clash with those of the operators
    return df.repartition(3).withColumns({c: F.lit("clash") for c in ("id", "fp", "part", "sig", "host", "n_lines", "score", "h", "a", "b", "keys", "row")})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words(t):
    return (t or "").encode().lower().split()


def rows_of(df, *cols):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)


def expected(fn):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted((fn(r) for r in edge_rows()), key=key)


# ---- SimHash ---------------------------------------------------------------------

def brute_fp(t):
    import xxhash
    w = words(t)
    sh = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute_components(fps, bits):
    """fps: list of (id, fp); smallest id reachable per row."""
    label = list(range(len(fps)))
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= bits:
                label[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return [low.get(root(i)) for i in range(len(fps))]


def test_spark_hash_is_the_contracts(spark):
    import xxhash
    got = spark.range(1).select(F.hex(F.xxhash64(F.lit("so it ends")))).first()[0]
    assert int(got, 16) == xxhash.xxh64_intdigest(b"so it ends", 42)


def test_simhash_edges(docs, empty):
    fps = [(r[0], brute_fp(r[1])) for r in edge_rows()]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(fps, brute_components(fps, 4))), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows_of(simhash.near_duplicates(docs), "id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_links_are_complete(spark):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 63, 40)
    fps = set(seeds.tolist())
    for s in seeds.tolist():                       # chains, dense groups and far values
        for _ in range(20):
            for b in rng.integers(0, 63, rng.integers(1, 5)).tolist():
                s ^= 1 << b
            fps.add(s)
    fps = sorted(fps)
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 4).collect()}
    assert got == {(x, y) for i, x in enumerate(fps) for y in fps[i + 1:] if bin(x ^ y).count("1") <= 4}


@pytest.mark.parametrize("total", [1_000, 10_000_000])
def test_simhash_allocation(total):
    rng = np.random.default_rng(2)
    sample = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    masks = simhash.choose_masks(sample, total, 4)
    assert sum(bin(m).count("1") for m in masks) == 64 and sum(masks) == (1 << 64) - 1
    work = simhash.work_table(sample[:20], sample, total, masks, 4)
    units = simhash.allocate(work, 4)
    assert (units.sum(1) == 5).all()
    from itertools import product
    for q in range(20):                            # the dynamic programme finds the least work
        best = min(sum(work[q, i, u] for i, u in enumerate(us)) for us in product(range(6), repeat=len(masks)) if sum(us) == 5)
        assert math.isclose(best, sum(work[q, i, u] for i, u in enumerate(units[q])))


# ---- tokens ----------------------------------------------------------------------

def reference_bpe():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts():
    rng = random.Random(1)
    parts = list("ab c  \n\t'1é　sS.!\x1c漢😀\0") + ["<|endoftext|>", "'ve", "  ", "aaaa", "\r\n", " a", "zz zz"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(800)] + [
        "a" * 3000, " " * 700, "".join(rng.choice("abcdefghij") for _ in range(700))]


def test_token_counts(spark, docs, empty):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    n = lambda x: len(t.encode(x or "", add_special_tokens=False).ids)
    want = expected(lambda r: (r[0], len((r[1] or "").encode()), n(r[1]), n(r[1]) > 1024))
    assert rows_of(token_counts.token_counts(docs, path), "id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.token_counts(empty, path).count() == 0
    texts = random_texts()
    assert token_counts.lengths(texts, path).tolist() == [n(x) for x in texts]


def test_memo_is_bounded_by_characters():
    memo = Memo(1000, chars=100, longest=20)
    for i in range(50):
        keys = [f"{i}-{j}" + "x" * 10 for j in range(3)] + [str(i) * 30]
        assert [memo.known(keys, lambda new: [k.upper() for k in new])[k] for k in keys] == [k.upper() for k in keys]
        assert sum(map(len, memo.young)) <= 100 + sum(map(len, keys)) and sum(map(len, memo.old)) <= 300
    assert not any(len(k) > 20 for k in memo.old)


def test_token_counts_cut_long_texts(monkeypatch):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 50)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 200)
    forget()
    texts = ["ab12" * 300 + "\ncd\nef" * 80, "x" * 400]
    assert max(map(len, token_counts.pieces(texts[0]))) < 60
    assert token_counts.lengths(texts, path).tolist() == [len(t.encode(x).ids) for x in texts]


def test_piece_model_counts():
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [x.replace("\0", "") for x in random_texts()[:100]]
    assert token_counts.lengths(texts, path).tolist() == [len(sp.encode(x)) for x in texts]


def test_bpe(spark, docs, empty):
    enc, path = reference_bpe(), P.path("byte_bpe_50k.tiktoken")
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def want(r):
        ids = enc.encode_ordinary(r[1] or "")
        return (r[0], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r[1] or "").encode()))

    got = rows_of(bpe.round_trip(docs, path, P.PATTERN), "id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == expected(want)
    assert bpe.round_trip(empty, path, P.PATTERN).count() == 0
    rng = random.Random(6)
    draw = lambda points, n: "".join(chr(rng.choice(points)) for _ in range(n))
    texts = random_texts() + ["x" * 5000, draw(range(97, 123), 3000), "，".join(draw(range(0x4E00, 0x5200), 120) for _ in range(40)),
                              draw(range(0x0E01, 0x0E3A), 2000), " ".join(draw(range(97, 123), 240) for _ in range(60))]
    own = bpe.Bpe(path, P.PATTERN)
    ids = own.encode(texts)
    assert [x.tolist() for x in ids] == [enc.encode_ordinary(t) for t in texts]
    assert own.decode(ids) == [t.encode() for t in texts]
    coded = bpe.encode(spark.createDataFrame([(1, "so be it"), (2, None)], "doc_id long, text string"), path, P.PATTERN)
    assert {r.id: bytes(r.bytes) for r in bpe.decode(coded, path, P.PATTERN).collect()} == {1: b"so be it", 2: b""}


def test_bpe_parts_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "TEXT_BYTES", 1000)
    monkeypatch.setattr(bpe, "_ROWS", 40)
    texts = ["é" * 200] * 7 + ["b" * 5000] + [""] * 90 + ["c" * 1000, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.encode() for t in texts], pa.binary())], names=["id", "text"])
    parts = [(ids.to_pylist(), own) for ids, own in bpe._texts([batch.slice(0, 0), batch, batch.slice(3, 2)])]
    assert [i for ids, _ in parts for i in ids] == [*range(len(texts)), 3, 4]
    assert [t for _, own in parts for t in own] == texts + texts[3:5]
    assert all(len(own) <= 40 and (len(own) == 1 or sum(len(t.encode()) for t in own) <= 1000) for _, own in parts)


def test_bpe_worker_memory():
    """What a worker takes beyond its vocabulary, over batches of long texts of many words."""
    code = f"""
import random, resource, sys
sys.path.insert(0, {ROOT!r})
import pyarrow as pa, public_tokenizers as P
from ordertide.llm import bpe
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
rng, own = random.Random(3), bpe.Bpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
words = ["".join(rng.choices("abcdefghijklmnoprstu", k=rng.randint(3, 8))) for _ in range(60_000)]
base = peak()
for _ in range(2):
    rows = [" ".join(rng.choices(words, k=700)).encode() for _ in range(1_500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.binary())], names=["id", "text"])
    for _, texts in bpe._texts([batch]):
        ids = own.encode(texts)
        own.as_text(ids)
        assert own.decode(ids) == [t.encode() for t in texts]
print(round(peak() - base))
"""
    took = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, check=True).stdout
    assert int(took) < 165


# ---- classifiers -----------------------------------------------------------------

def test_toxicity(spark, docs, empty):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["ba", "lo", "mi", "re", "su"]) for _ in range(rng.randint(1, 4)))
    text = lambda bad: " ".join([word() for _ in range(60)] + bad + [word() for _ in range(60)])
    sample = [(text([rng.choice(["scumbag", "moronic", "idiotic"])]), 1) for _ in range(60)] + [(text([]), 0) for _ in range(60)]
    m = toxicity.fit(sample)
    score = lambda t: m.score(m.word_values(toxicity.words(t)))
    t = text(["scumbag"])
    assert math.isclose(score(t), brute_toxicity(m, t), rel_tol=1e-9)
    assert np.mean([score(text(["moronik"])) > score(text([])) for _ in range(40)]) > 0.9     # an unseen misspelling
    out = toxicity.toxicity_scores(docs, m)
    assert out.count() == len(edge_rows()) and out.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert toxicity.toxicity_scores(empty, m).count() == 0
    kept = toxicity.toxicity_scores(docs, m, keep_columns=True)
    assert kept.columns == [*docs.columns, "toxic_score", "toxic_predicted"]
    assert toxicity.fit([]).score([]) == 0.5
    assert m.score(m.word_values([])) == m.score(m.word_values(["漢字"]))          # no learnt n-gram: the bias alone


def brute_toxicity(m, text):
    """The weighted average over all distinct words, word by word."""
    total = weights = 0.0
    for w in toxicity.words(text):
        buckets = [int(b) for b in toxicity.subwords([w])[1] if m.seen[b]]
        if buckets:
            a = math.exp(np.mean([m.salience[b] for b in buckets]))
            total, weights = total + a * np.mean([m.gain[b] for b in buckets]), weights + a
    return 1 / (1 + math.exp(-(total / weights if weights else 0.0) - m.bias))


def held_out(spark, sf, label):
    rows = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    return [(r.text, r[label]) for r in rows.where("text IS NOT NULL").orderBy("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]


def test_toxicity_misses_and_false_alarms_by_length(spark):
    """On held-out rows; clean texts stay clean however many of them are joined, toxic ones stay toxic among a few."""
    sf = "/root/testdata/sf0.1"
    m = queries.fit_toxicity(spark, sf)
    score = lambda t: m.score(m.word_values(toxicity.words(t)))
    rows = held_out(spark, sf, "toxic")
    toxic, clean = [t for t, y in rows if y], [t for t, y in rows if not y]
    for long in (False, True):
        own = [t for t in toxic if (len(t) > 1500) == long]
        assert len(own) > 20 and sum(score(t) < 0.5 for t in own) <= 0.15 * len(own)
        own = [t for t in clean if (len(t) > 1500) == long]
        assert len(own) > 100 and sum(score(t) >= 0.5 for t in own) <= 0.03 * len(own)
    rng = random.Random(1)
    found, fine = [t for t in toxic if score(t) >= 0.5], [t for t in clean if score(t) < 0.5]
    for k in (5, 20, 100):
        assert sum(score("\n".join(rng.sample(fine, k))) >= 0.5 for _ in range(30)) <= 1
    assert sum(score("\n".join([*rng.sample(fine, 4), rng.choice(found)])) >= 0.5 for _ in range(40)) >= 34


def test_factorisation_machine(docs, empty):
    rng = random.Random(3)
    good = [(" ".join(rng.choice(["of", "the", "reed", "and", "stone."]) for _ in range(80)), 1) for _ in range(60)]
    bad = [(" | ".join(["Home%%%", "menu&&&", "buy***"] * 20), 0) for _ in range(20)]
    m = quality.fit(good + bad)
    t = good[0][0]
    at, x = quality.bag([quality._bucket(w) for w in t.split()])
    stats = np.array(quality.statistics(t, t.split()))
    z = np.clip((stats - m.mean) / m.scale, -4, 4)
    ix, xs = np.concatenate([at, np.arange(quality.BUCKETS, len(m.w))]), np.concatenate([x, z])
    pairs = sum(m.v[i] @ m.v[j] * a * b for k, (i, a) in enumerate(zip(ix, xs)) for j, b in zip(ix[:k], xs[:k]))
    out = m.w0 + m.w[ix] @ xs + pairs                       # all pairs, against the identity
    one, nothing = m.scores([[quality._bucket(w) for w in t.split()], []], np.array([stats, quality.statistics("", [])]))
    assert math.isclose(one, 1 / (1 + math.exp(-out)), rel_tol=1e-6) and 0 <= nothing <= 1
    got = quality.quality_scores(docs, m)
    assert got.count() == len(edge_rows()) and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert quality.quality_scores(empty, m).count() == 0


@pytest.mark.parametrize("name,label,at,least", [("op4_toxicity", "toxic", 0.5, 0.9), ("op9_quality_classifier", "quality", 0.3, 0.9)])
def test_held_out_accuracy(spark, name, label, at, least):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert ((out.score >= at) == (out[label] == 1)).mean() >= least
    assert set(out.predicted) <= {0, 1}


# ---- language model ---------------------------------------------------------------

def test_lm(spark, docs, empty):
    keep = lambda c: F.coalesce(F.col("doc_id") % 7 != 2, F.lit(False))
    out = lm.lm_scores(docs, keep("doc_id"), F.col("doc_id") % 7 == 5).toPandas()
    texts = [words(r[1]) + [b" e"] for r in edge_rows() if r[0] is not None and r[0] % 7 != 2]
    c = Counter(w for t in texts for w in t)
    n, v = sum(c.values()), len(c)
    base = {}
    for i, t, *_ in edge_rows():
        w = words(t) + [b" e"]
        base.setdefault(i, []).append((len(w), sum(c[x] > 0 for x in w), round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)))
    for i, own in out.groupby(out.id.fillna(-1)):
        got = sorted(zip(own.n_tokens, own.n_known, own.base_score.round(6)))
        assert np.allclose(got, sorted(base[None if i == -1 else int(i)]), rtol=1e-9)
    assert set(out.train_tokens) == {n} and (out.score < 0).all()
    assert lm.lm_scores(empty, F.lit(True), F.lit(False)).count() == 0


def test_lm_is_a_distribution(spark):
    """Weights are distributions, seen bigrams are likelier (probabilities: test_lm_scores_by_brute_force)."""
    train = [(i, t) for i, t in enumerate(["a b a b c", "a c b", "b b a", "c a b"] * 6)]
    probe = [(100 + k, f"a {w}".strip()) for k, w in enumerate(["", "a", "b", "c", "unseen"])]
    df = spark.createDataFrame(train + probe, "doc_id long, text string")
    out = lm.lm_scores(df, F.col("doc_id") < 100, F.col("doc_id") % 4 == 3).toPandas().set_index("id").score
    one = lm.lm_scores(spark.createDataFrame(train + [(100, "a")], "doc_id long, text string"), F.col("doc_id") < 100, F.col("doc_id") % 4 == 3)
    assert len(one.collect()) == 25
    w = lm.fit_weights([(3, 0, 8, 10), (3, -1, 8, 5), (0, -1, 16, 4)], 4)
    assert np.allclose(w.sum(1), 1) and w[0, 0] == 0 and (w >= 0).all()
    assert out[102] > out[104]                                  # "a b" was seen, "a unseen" not


def test_lm_scores_by_brute_force(spark):
    """Counts, bins, weights and interpolation, word by word; and the next words' probabilities sum to one."""
    rng = random.Random(12)
    texts = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 9)))) for i in range(140)]
    probe = [(1000 + k, f"b {w}".strip()) for k, w in enumerate(["a", "b", "c", "d", "e", "", "zzz"])]
    train, tune = lambda i: i < 1000 and i % 7 != 2, lambda i: i % 7 == 5
    df = spark.createDataFrame(texts + probe, "doc_id long, text string")
    out = {r.id: r.score for r in lm.lm_scores(df, (F.col("doc_id") < 1000) & (F.col("doc_id") % 7 != 2), F.col("doc_id") % 7 == 5).collect()}

    seq = {i: [" s", *t.split(), " e"] for i, t in texts + probe}
    def counted(keep):
        word, pair, context = Counter(), Counter(), Counter()
        for i, s in seq.items():
            if keep(i):
                word.update(s[1:])
                pair.update(zip(s, s[1:]))
                context[" s"] += 1
        return word, pair, lambda v: context[" s"] if v == " s" else word[v]
    word, pair, context = counted(train)
    n, types = sum(word.values()), len(word)
    left = counted(lambda i: train(i) and not tune(i))
    bins = Counter()
    for i, s in seq.items():
        if train(i) and tune(i):
            for v, w in zip(s, s[1:]):
                c = left[2](v)
                level = lambda p: -1 if p == 0 else int(np.rint(-math.log2(p) * lm.BINS))
                bins[int(np.frexp(float(c))[1]), level(left[1][v, w] / max(c, 1)), level(left[0][w] / sum(left[0].values()))] += 1
    weights = lm.fit_weights([(*k, m) for k, m in bins.items()], types)
    def p(v, w):
        c = context(v)
        l2, l1, l0 = weights[int(np.frexp(float(c))[1])]
        return l2 * pair[v, w] / max(c, 1) + l1 * word[w] / n + l0 / (types + 1)
    for i, s in seq.items():
        assert math.isclose(out[i], sum(math.log10(p(v, w)) for v, w in zip(s, s[1:])), rel_tol=1e-9)
    assert math.isclose(sum(p("b", w) for w in word) + p("b", "zzz"), 1, rel_tol=1e-9)


def test_lm_beats_its_base_on_held_out_texts(spark):
    out = queries.op5_lm_scores(spark, SF).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


# ---- rules, lines ------------------------------------------------------------------

def test_quality_rules_edges(docs, empty):
    def want(r):
        t = r[1] or ""
        w = words(t)
        win = Counter(zip(w_ := [x for x in (t.encode().split())], w_[1:], w_[2:]))
        cov = {i + k for i in range(len(w_) - 2) if win[tuple(w_[i:i + 3])] > 1 for k in range(3)}
        full = [x for x in t.split("\n") if x.encode().split()]
        return (r[0], len(w), sum(len(x.decode()) for x in w_), sum(t.count(s) for s in "#*$%&|<>"), len(full) - len(set(full)), len(cov),
                len(w) < 50 or 100 * len(cov) > 50 * len(w))
    got = rows_of(quality_rules.quality_rules(docs), "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == expected(want)
    assert quality_rules.quality_rules(empty).count() == 0


def test_quality_rules_reject_depleted(spark):
    line = " ".join(f"word{i}" for i in range(60))
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(60))
    rows = [(i, line if i % 2 else line + "\n" + own(i), "h") for i in range(30)] + [(99, line, "other")]
    out = {r.id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out == {i: i % 2 == 0 for i in range(30)} | {99: True}


def brute_lines(rows, min_docs=3):
    norm = lambda x: x.strip(b" \t\n\x0b\x0c\r").lower()
    holds = {}
    for i, t, *_ in rows:
        for x in (t or "").encode().split(b"\n") if i is not None else []:
            if len(norm(x).decode()) >= 20:
                holds.setdefault(norm(x), set()).add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").encode().split(b"\n")
        left = [x for x in lines if i is None or len(holds.get(norm(x), ())) < min_docs or max(holds[norm(x)]) == i]
        out.append((i, len(lines), len(lines) - len(left), hashlib.sha256(b"\n".join(left)).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


COLS = ("doc_id", "n_lines", "n_dropped", "kept_sha256")


def test_line_dedup_edges(docs, empty):
    out = line_dedup.line_dedup(docs)
    assert rows_of(out, *COLS) == brute_lines(edge_rows())
    assert out.where("text IS NULL").count() == 2 and out.where("n_dropped > 0").count() > 0
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_index_is_reversible(spark, docs):
    rows = edge_rows()
    some = lambda keep: docs.where(F.col("doc_id").isin([i for i in range(20) if keep(i)]))
    index = line_dedup.LineIndex.empty(spark, 10).insert(some(lambda i: i % 2)).insert(docs)       # odd ids twice
    assert rows_of(line_dedup.strip_lines(docs, index), *COLS) == brute_lines(rows)
    index = index.delete(spark.createDataFrame([(11,), (77,)], "doc_id long"))
    left = [r for r in rows if r[0] != 11]
    assert rows_of(line_dedup.strip_lines(docs.where("doc_id IS NULL OR doc_id <> 11"), index), *COLS) == brute_lines(left)
    assert rows_of(line_dedup.strip_lines(docs, index.insert(docs)), *COLS) == brute_lines(rows)


def test_line_dedup_probes_its_filters(spark, monkeypatch):
    """Of the second part's keys only those that the filters may know meet the exact tables; few are false hits."""
    rng = random.Random(8)
    line = lambda k: f"line number {k} of the corpus, long enough to count"
    rows = [(i, "\n".join(line(rng.randrange(40_000)) for _ in range(12))) for i in range(3000)]
    asked = []
    probe = line_dedup.LineIndex.maybe_known

    def watched(self, keys):
        out = probe(self, keys)
        exact = self.counts.select("a", "b")
        asked.append((keys.count(), out.count(), out.join(exact, ["a", "b"], "left_semi").count(), keys.join(exact, ["a", "b"], "left_semi").count()))
        return out

    monkeypatch.setattr(line_dedup.LineIndex, "maybe_known", watched)
    out = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert rows_of(out, *COLS) == brute_lines(rows)
    (keys, maybe, hits, known), = asked
    assert hits == known > 1000 and maybe - hits < 0.01 * (keys - known) and keys - known > 1000


def test_tiny_items_by_their_parts():
    rng = random.Random(3)
    for _ in range(3000):
        p = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7)))
        t = bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, 25)))
        k = math.floor(decontamination.MAX_EDITS * len(p))
        assert decontamination.tiny_distance(p, t, k) == decontamination.edit_distance(p, t, k)


@pytest.mark.parametrize("n", [1, 700, 40_000])
def test_cuckoo_filter(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(-1 << 62, 1 << 62, (2, 2 * n))
    f = line_dedup.CuckooFilter()
    f.insert(a[:n // 2], b[:n // 2])
    f.insert(a[n // 2:n], b[n // 2:n])
    assert f.holds(a[:n], b[:n]).all() and f.holds(a[n:], b[n:]).mean() < 0.01
    f.remove(a[:n // 2], b[:n // 2])
    assert f.holds(a[n // 2:n], b[n // 2:n]).all() and f.holds(a[:n // 2], b[:n // 2]).sum() <= max(1, n // 100)


# ---- decontamination, WARC ------------------------------------------------------------

def test_edit_distance():
    rng = random.Random(4)

    def brute(p, t):
        col = list(range(len(p) + 1))
        best = col[-1]
        for c in t:
            new = [0]
            for i, x in enumerate(p):
                new.append(min(col[i] + (x != c), col[i + 1] + 1, new[i] + 1))
            col = new
            best = min(best, col[-1])
        return best
    for _ in range(200):
        p, t = (bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12))), bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 30))))
        assert decontamination.edit_distance(p, t, 99) == brute(p, t)


def test_decontamination(spark, docs, empty):
    items = [r for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    rng = random.Random(6)
    clean = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 500").limit(40).collect()]
    rows, want = [], set()
    for k, it in enumerate(items):
        s = list(it.text.upper() if k % 2 else it.text)
        for _ in range(len(s) // 20):
            s[rng.randrange(len(s))] = rng.choice("abcdefgh")
        host = clean[k].split(" ") if k < len(clean) else ["a"]
        cut = rng.randrange(len(host))
        rows.append((k, " ".join(host[:cut]) + " " + "".join(s).replace(" ", " \n ") + " " + " ".join(host[cut:])))
        want.add((k, it.item_id))
    df = spark.createDataFrame(rows + [(1000, None), (1001, ""), (None, items[0].text)], "doc_id long, text string")
    bench = spark.createDataFrame([(r.item_id, r.text) for r in items] + [(900, None), (901, ""), (None, "a b")], "item_id long, text string")
    got = {(r.id, r.item_id) for r in decontamination.find_leaks(df, bench).collect()}
    assert len(want & got) >= 0.95 * len(want)
    assert {i for i, _ in got} <= set(range(len(items)))
    assert decontamination.find_leaks(docs, bench).count() == 0
    assert decontamination.find_leaks(empty, bench).count() == 0 and decontamination.find_leaks(df, bench.limit(0)).count() == 0
    short = spark.createDataFrame([(1, "two words")], "item_id long, text string")
    found = decontamination.find_leaks(spark.createDataFrame([(5, "here are  TWO\nwords in a text")], "doc_id long, text string"), short)
    assert [tuple(r) for r in found.collect()] == [(5, 1, 0)]


@pytest.mark.parametrize("least,most,count", [(8, 15, 40), (16, 23, 40), (24, 30, 100), (48, 60, 100), (80, 90, 200), (81, 149, 200), (150, 394, 100)])
def test_decontamination_recall(spark, least, most, count):
    """Items with random insertions, deletions and substitutions inside other texts."""
    rng = random.Random(least)
    source = [decontamination.normal(r.text.encode()) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").orderBy("item_id").collect()]
    clean = [decontamination.normal(r.text.encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 500").orderBy("doc_id").limit(40).collect()]
    items = []
    while len(items) < count:
        t, size = rng.choice(source), rng.randint(least, most)
        at = 1 + t.rfind(b" ", 0, rng.randrange(max(1, len(t) - size + 1)))
        if least <= len(t[at:at + size].strip()):
            items.append(t[at:at + size].strip())
    index = decontamination.ItemIndex(list(enumerate(items)))
    for rate in (0.1, 0.15, 0.2):
        texts = []
        for t in items:
            s = list(t)
            for _ in range(math.floor(rate * len(t))):
                at, kind = rng.randrange(len(s)), rng.randrange(3)
                s[at:at + (kind > 0)] = [rng.choice(b"abcdefghijklmnopqrstuvwxyz ")] * (kind < 2)
            host = rng.choice(clean)[:400]
            cut = rng.randrange(len(host))
            texts.append(host[:cut] + b" " + bytes(s) + b" " + host[cut:])
        found = decontamination.search(texts, index, decontamination.MAX_EDITS)
        recall = len({d for d, i, _ in found if index.items[i][0] == d}) / count
        print(f"{least}-{most} bytes, {rate:.0%} edits: recall {recall:.2f}")
        assert recall >= 0.9


def test_piece_distances():
    rng = random.Random(7)
    text = lambda n: bytes(rng.choice(b"abc") for _ in range(n))
    index = decontamination.ItemIndex([(k, text(rng.randint(1, 150))) for k in range(60)])
    windows = [text(rng.randint(0, 200)) for _ in range(60)]
    data, lo = decontamination._padded(windows)
    item = np.array([rng.randrange(60) for _ in windows])
    for piece in range(3):
        use = np.nonzero(index.size[item] > 64 * piece)[0]
        got = decontamination.piece_distances(index, item[use], piece, data, lo[use], lo[use] + np.array([len(w) for w in windows])[use])
        assert got.tolist() == [decontamination.edit_distance(index.items[i][1][64 * piece:64 * piece + 64], windows[k], 64) for i, k in zip(item[use], use)]


def test_warc(spark):
    big = "<p>" + "x" * 200
    rows = [(5, "http://b.example.com/1", big), (3, "http://b.example.com/1", big), (9, None, big), (4, "http://[bad", None), (6, "https://a.example.org:8443/q?x=1 2", "é"),
            (None, "http://n.example/", big), (7, "http://b.example.com/1", "tiny"), (8, "x\r\ny", "tiny"), (3, "http://b.example.com/1", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    archive = warc.write_archive(pages)
    got = warc.lookup(archive, pages).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(i, len((t or "").encode()), sha(t), "revisit" if i and i > 3 and t == big else "response", 3 if i and i > 3 and t == big else None) for i, _, t in rows]
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {big.encode(), b"", "é".encode(), b"tiny"}
    one = warc.lookup(archive, spark.createDataFrame([("HTTP://B.example.com/1",), ("http://not.there/",)], "url string"))
    assert sorted(r.page for r in one.collect()) == [3, 3, 5, 7]
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_capture_blocks_hold_every_key(spark, monkeypatch, tmp_path):
    """Binary search over the directory, keys that span blocks and keys that are missing."""
    import json
    part = warc._Part.__new__(warc._Part)
    rows = sorted(random.Random(8).choices("abcdefghijk", k=200))
    blocks = [rows[i:i + 7] for i in range(0, 200, 7)]
    part.first, part.place = [b[0] for b in blocks], list(range(len(blocks)))
    for k in "abcdefghijklm":
        assert {i for i, b in enumerate(blocks) if k in b} <= set(part.blocks(k))
        assert len(part.blocks(k)) <= sum(k in b for b in blocks) + 1
    assert json.loads(json.dumps(["a,b)/", "f", 1, 2])) == ["a,b)/", "f", 1, 2]


def test_url_key():
    assert warc.url_key("HTTP://www.Example.com:80/a?b=c") == "com,example,www)/a?b=c"
    assert warc.url_key(None) == "" and warc.url_key("no host") == "no host"


# ---- queries and pipeline ----------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    res = duck.execute(queries.ORACLES[name])
    cols = [d[0] for d in res.description]
    key = lambda rows, names: sorted(tuple(str(r[names.index(c)]).lower() for c in sorted(names)) for r in rows)
    assert sorted(df.columns) == sorted(cols)
    assert key(df.collect(), df.columns) == key(res.fetchall(), cols)


def test_pipeline_stages(spark):
    """Each stage against brute force on what the one before it kept."""
    import corpus_pipeline as pipe
    read = lambda: spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(pipe.STAGES)
    docs = read()
    model = queries.fit_toxicity(spark, SF)
    scored = {r.doc_id: model.score(model.word_values(toxicity.words(r.text))) for r in docs.collect()}
    kept = steps["toxicity"](spark, docs, SF).cache()
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in scored.items() if s < 0.5}
    lines = steps["line_dedup"](spark, kept, SF).cache()
    assert sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in lines.collect()) == [
        (x[0], x[3]) for x in sorted(brute_lines([(r.doc_id, r.text) for r in kept.collect()]), key=lambda x: x[0])]
    once = steps["simhash"](spark, lines, SF).cache()
    rows = sorted((r.doc_id, brute_fp(r.text)) for r in lines.collect())
    assert {r.doc_id for r in once.collect()} == {i for (i, _), c in zip(rows, brute_components(rows, 4)) if i == c}
    clean = steps["decontamination"](spark, once, SF).cache()
    items = [decontamination.normal(r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    limit = lambda x: math.floor(decontamination.MAX_EDITS * len(x))
    holds = lambda t: any(decontamination.edit_distance(x, decontamination.normal(t.encode()), limit(x)) is not None for x in items)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in once.collect() if not holds(r.text)}
    enc = reference_bpe()
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in steps["byte_bpe"](spark, clean, SF).collect()}
    assert got == {r.doc_id: (len(enc.encode_ordinary(r.text)), hashlib.sha256(r.text.encode()).hexdigest()) for r in clean.collect()}
    assert pipe.run(spark, SF).count() == len(got)


def test_pipeline_keeps_clean_edge_rows(spark, docs):
    import corpus_pipeline as pipe
    steps = dict(pipe.STAGES)
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert steps["line_dedup"](spark, own, SF).count() == len(edge_rows())
    # each row is judged by its own text: of a group the row of the least id stays, texts under one id are kept apart
    rows = [(i, t, brute_fp(t)) for i, t, *_ in edge_rows() if i is not None]
    groups = brute_components([(k, fp) for k, (_, _, fp) in enumerate(rows)], 4)
    want = set()
    for g in set(groups):
        i, fp = min((rows[k][0], f"{rows[k][2]:016x}") for k in range(len(rows)) if groups[k] == g)
        want.add((i, min((str(t) for j, t, f in rows if j == i and f"{f:016x}" == fp))))
    out = steps["simhash"](spark, own, SF).collect()
    assert sorted((r.doc_id, str(r.text)) for r in out if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in out) == 2 and {(13, "a b c"), (13, "a b d")} <= want


def test_pipeline_decontaminates_rows_and_items_without_id(spark, docs, tmp_path):
    import corpus_pipeline as pipe
    first, second = "the first item has an id and some more words to it", "another item without any id and with words of its own"
    spark.createDataFrame([(1, first), (None, second), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    dirty = [(None, "so " + first.upper()), (70, "so  " + second), (None, second), (71, first), (71, "a clean text under the id of another")]
    more = own.unionByName(spark.createDataFrame([(i, t, "en", None, None) for i, t in dirty], own.schema))
    out = dict(pipe.STAGES)["decontamination"](spark, more, str(tmp_path))
    assert out.columns == own.columns
    assert rows_of(out, "doc_id", "text") == rows_of(own.unionByName(spark.createDataFrame([(*dirty[-1], "en", None, None)], own.schema)), "doc_id", "text")
