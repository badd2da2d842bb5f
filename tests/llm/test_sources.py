"""Divergence audit, language identification and importance resampling."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordermill.llm import divergence, langid, queries, radix, resample, terms, textkit
from ordermill.llm.store import written
from tests_path import SF01

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FEATURE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


# Divergence audit.

def audit_by_hand(rows, min_documents, top):
    """rows: lang, source, text."""
    rows = [(a or "", b or "", TERM.findall((t or "").translate(FOLD))) for a, b, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        docs, total = Counter(), Counter()
        group = defaultdict(Counter)
        for _, source, words in own:
            group[source].update(words)
            docs.update(set(words))
            total.update(words)
        kept = {t for t, n in docs.items() if n >= min_documents}

        def price(count):
            size = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // size for t in kept}

        p = {source: price(count) for source, count in group.items()}
        q = price(total)
        for source in group:
            pairs = [(-sum((p[source][t] - p[other][t]) ** 2 // p[other][t] for t in kept), other) for other in group if other != source]
            single = [(-((p[source][t] - q[t]) ** 2 // q[t]), t) for t in kept if group[source][t] and p[source][t] > q[t]]
            for part, got, last in (("pair", pairs, None), ("term", single, top)):
                for k, (value, item) in enumerate(sorted(got, key=lambda x: (x[0], x[1].encode()))[:last]):
                    out.append((lang, source, part, item, -value, k + 1))
    return sorted(out)


def audited(docs, **kw):
    return sorted(tuple(r) for r in divergence.audit(docs, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


def test_audit_matches_brute_force(spark, docs, doc_rows, monkeypatch):
    rng = np.random.default_rng(5)
    extra = [("x" if i % 2 else None, "s%d" % (i % 9), " ".join("t%s" % "abcdefgh"[j] + "é" * int(j % 3) for j in rng.integers(0, 8, rng.integers(0, 60)))) for i in range(90)]
    extra += [("lone", "only", "A b"), ("lone", "only", "a B"), ("lone", "only", "ab a"), ("empty", "p", None), ("empty", "q", "12 34"), ("empty", None, ""), ("rare", "p", "once"), ("rare", "q", "twice twice")]
    table = docs.select("lang", "source", "text", "key", "n").union(spark.createDataFrame([(*r, "k", "n") for r in extra], "lang string, source string, text string, key string, n string"))
    rows = [(r[2], r[3], r[1]) for r in doc_rows] + extra
    want = audit_by_hand(rows, 3, 200)
    assert audited(table) == want
    # many blocks, several tiles and small slices give the same
    monkeypatch.setattr(divergence, "BLOCK_COUNTS", 40)
    monkeypatch.setattr(divergence, "TILE_SOURCES", 2)
    monkeypatch.setattr(divergence, "COUNT_BYTES", 2000)
    assert audited(table) == want
    assert audited(table, min_documents=1, top=3) == audit_by_hand(rows, 1, 3)


def test_audit_of_nothing(no_docs):
    assert divergence.audit(no_docs).collect() == []


def test_audit_arithmetic_is_exact(spark):
    # counts whose product with the scale passes 2**63
    n = np.array([0, 9_300_000_000, 123_456_789_012_345, 5], np.int64)
    total = int(n.sum()) + 4
    assert divergence.prices(n, total).tolist() == [1 + 10**9 * (int(x) + 1) // total for x in n]
    row = spark.createDataFrame([(int(x), total) for x in n], "n long, total long").select(divergence.price(F.col("n"), F.col("total")).alias("p")).collect()
    assert [r.p for r in row] == [1 + 10**9 * (int(x) + 1) // total for x in n]
    a = (np.array([1, 4, 9]), np.array([10, 999_999_999, 7]), 3)
    b = (np.array([4]), np.array([1]), 2)
    there = 8 * 8 // 2 + (999_999_998 ** 2) // 1 + 5 * 5 // 2
    back = 8 * 8 // 10 + (999_999_998 ** 2) // 999_999_999 + 5 * 5 // 7
    assert divergence._merge(a, b) == (there, back, 3) and divergence._merge(b, a) == (back, there, 3)


def test_words_of_a_slice_are_exact():
    texts = ["Ab c1-É日x", "", None, "  ", "zZ" * 5 + "\x00q"]
    for inside, pattern in ((terms.LETTERS, TERM), (terms.LETTERS_DIGITS, FEATURE)):
        got = [(int(t) + s.lo, w) for s in textkit.slices(pa.array(texts, pa.string()), 6) for t, w in zip(*(x.tolist() for x in terms.words(s, inside)), strict=True)]
        assert got == [(i, w) for i, t in enumerate(texts) for w in pattern.findall((t or "").translate(FOLD))]


# Importance resampling.

def resampled_by_hand(rows, target, percent, min_words, runs, seed):
    def features(text):
        w = FEATURE.findall((text or "").translate(FOLD))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in range(1, runs + 1) for i in range(len(w) - k + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    size, wanted = float(sum(s.values())), float(sum(t.values()))
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (size + 10000) / ((s[b] + 1.0) * (wanted + 10000)))) for b in range(10000)]
    out = []
    for doc_id, text in rows:
        n, got = features(text)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in got)
        out.append((doc_id, len(got), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(able) * percent // 100
    ranked = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)] + [(*r[:4], None) for r in out if not r[4]]
    return sorted(map(str, ranked))


@pytest.mark.parametrize("runs,percent", [(1, 10), (2, 100)])
def test_resampling_matches_brute_force(spark, docs, doc_rows, no_docs, runs, percent):
    target = ["w001a w002b", "NEW words 123 é", None, "", doc_rows[0][1]]
    there = spark.createDataFrame([(t, 1) for t in target], "text string, score int")
    got = resample.resample(docs.withColumn("rank", F.lit("x")).withColumn("place", F.lit(1)), there, percent=percent, runs=runs)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)) for r in got.collect()) == resampled_by_hand([r[:2] for r in doc_rows], target, percent, 20, runs, 2024)
    assert resample.resample(no_docs, there).collect() == []
    assert resample.resample(docs, there.limit(0)).count() == len(doc_rows)


def test_radix_sort_is_the_order_of_the_keys(spark):
    rng = np.random.default_rng(8)
    edge = [-(1 << 63), (1 << 63) - 1, 0, -1, 1, None]
    rows = [(int(a), int(b), i) for i, (a, b) in enumerate(zip(rng.integers(-9, 9, 400), rng.integers(-10**12, 10**12, 400), strict=True))]
    rows += [(0, 7, 1000 + i) for i in range(300)]  # one key with a third of all rows
    rows += [(a, b, 2000 + 10 * i + j) for i, a in enumerate(edge) for j, b in enumerate(edge)]
    table = written(spark.createDataFrame(rows, "a long, b long, c long").repartition(7), "sort")
    for down in (False, True):
        got = sorted((r.place, r.a, r.b) for r in radix.radix_sort(table, [("a", down), ("b", not down)]).collect())
        sign = -1 if down else 1
        want = sorted(((a, b) for a, b, _ in rows), key=lambda r: (r[0] is None, sign * (r[0] or 0), r[1] is None, -sign * (r[1] or 0)))
        assert [r[0] for r in got] == list(range(len(rows)))
        assert [r[1:] for r in got] == want


def test_a_pass_is_stable(spark):
    table = spark.createDataFrame([(i, i % 3, i // 40) for i in range(100)], "place long, d int, block long")
    got = sorted((r.place, r.c) for r in radix.counting_pass(table.withColumn("c", F.col("place")), F.col("d"), 30).collect())
    assert [c for _, c in got] == sorted(range(100), key=lambda i: i % 3) and [p for p, _ in got] == list(range(100))


# Language identification.

def test_languages_of_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.op12_language_id(spark, SF01).collect()}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    assert len(got) == len(docs) and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    held = [d for d in docs if got[d.doc_id].held_out and d.lang and any(c.isalpha() for c in d.text or "")]
    assert len(held) > 150 and sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)


def folded_grams(text, length=langid.LENGTH):
    """The n-grams of a text as sets of symbol tuples."""
    symbols = [0]
    for b in (text or "").encode():
        x = b - 64 if 65 <= b <= 90 else b - 96 if 97 <= b <= 122 else b - 101 if b > 127 else 0
        if x or symbols[-1]:
            symbols.append(x)
    return {tuple(symbols[i:i + k]) for k in range(1, length + 1) for i in range(len(symbols) - k + 1)}


def number(gram):
    base = sum(langid.SYMBOLS ** k for k in range(1, len(gram)))
    code = 0
    for x in gram:
        code = code * langid.SYMBOLS + x
    return base + code


def test_presence_rows_are_the_blended_spectrum():
    texts = ["Ab, ab.  Zé", "", "12 34", None, "ab" * 50, "日本語 x", " y"]
    column = np.arange(langid.code_count(), dtype=np.int32)
    got = [set() for _ in texts]
    for s in textkit.slices(pa.array(texts, pa.string()), 30):
        for text, code in langid.grams(s):
            for t, c in zip(text.tolist(), code.tolist(), strict=True):
                got[s.lo + t].add(int(column[c]))
    assert got == [{number(g) for g in folded_grams(t)} for t in texts]


def test_outputs_are_kernel_ridge_regressions(spark):
    """The matrix product against kernels, whitening and ridge computed from sets."""
    rng = np.random.default_rng(3)
    syllables = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ung", "ei"], "cc": ["ção", "lh", "os"]}
    rows = [(i, lang, " ".join("".join(rng.choice(syllables[lang], 2)) for _ in range(rng.integers(2, 30)))) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.fit(docs, limit=60, landmarks=9)
    train = [(lang, t) for i, lang, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    langs, table = langid.training_texts(docs, 60)
    chosen = table.collect()
    assert langs == ["aa", "bb", "cc"] and {(r.lang, r.text) for r in chosen} <= set(train)
    marks = [folded_grams(r.text) for r in chosen if r.turn <= 3]
    known = set().union(*marks)

    def kernel(x, y):
        return len(x & y) / math.sqrt(len(x) * len(y)) if x and y else 0

    value, vector = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    good = value > langid.CUT * value[-1]
    whiten = vector[:, good] / np.sqrt(value[good])

    def mapped(text):
        own = folded_grams(text) & known
        return np.concatenate([[1], np.array([kernel(own, m) for m in marks]) @ whiten])

    z = np.array([mapped(r.text) for r in chosen])
    y = np.array([[r.lang == x for x in langs] for r in chosen], float)
    penalty = langid.RIDGE * np.diag([0] + [1] * int(good.sum()))
    dual = np.linalg.solve(z.T @ z / len(z) + penalty, z.T @ y / len(z))
    texts = [t for _, _, t in rows] + ["", "kato schung", "日本"]
    got = np.concatenate([model.outputs(s) for s in textkit.slices(pa.array(texts), 200)])
    assert np.allclose(got, [mapped(t) @ dual for t in texts], atol=2e-3)


def test_languages_of_odd_rows(spark, docs, doc_rows, no_docs):
    extra = [(1000 + i, lang, t) for i, (lang, t) in enumerate([("xx", "ñañu ñoño")] * 30 + [(None, "ñoño ñañu"), ("xx", None), ("xx", "12 % 3"), ("yy", "日本"), ("zz", "")])]
    table = docs.select("doc_id", "lang", "text", F.lit("a").alias("lang_pred"), F.lit(1).alias("score"), F.lit(2).alias("turn")).union(
        spark.createDataFrame([(*r, "a", 1, 2) for r in extra], "doc_id long, lang string, text string, lang_pred string, score int, turn int"))
    got = langid.identify_languages(table).collect()
    assert len(got) == len(doc_rows) + len(extra)
    texts = Counter((r[0], r[1]) for r in doc_rows) + Counter((r[0], r[2]) for r in extra)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred in ("en", "xx", "yy", "und") and 0 <= by_id[i].score <= 1 for i, _ in texts)
    assert [by_id[i].lang_pred for i in (300, 301, 302, 1031, 1032, 1034)] == ["und"] * 6 and by_id[1030].lang_pred == "xx" and by_id[0].lang_pred == "en"
    assert by_id[None].held_out is False
    assert langid.identify_languages(no_docs).collect() == []
    unlabelled = langid.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
