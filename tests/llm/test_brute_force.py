"""Classifier, compression rules and the composed pipeline against plain recomputations."""

import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordermill.llm import quality, queries, rules
from test_dedup import FOLD, SPACE, similar, union_find
from tests_path import SF01

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The limits of the rules, stated again: least bytes of a text, lowest and highest ratio.
LIMITS = [(16000, 0.20, 0.70), (4000, 0.22, 0.72), (1000, 0.25, 0.75), (200, 0.30, 1.00)]


def packed_size(raw):
    return len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(raw))


def test_compression_verdicts_match_brute_force(spark, docs, doc_rows):
    rng = np.random.default_rng(5)
    extra = [(800, "".join(" " if k % 9 == 8 else chr(33 + c) for k, c in enumerate(rng.integers(0, 94, 9000)))), (801, "ab cd " * 3000),
             (802, " ".join("w%d" % x for x in rng.integers(0, 900, 5000))), (803, " ".join("é%d" % x for x in rng.integers(0, 10**7, 1200)))]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    want = []
    for i, t in [(r[0], r[1]) for r in doc_rows] + extra:
        raw = (t or "").encode()
        ratio = packed_size(raw) / len(raw) if raw else 1.0
        starts = [*range(0, len(raw) - 4095, 4096)] if len(raw) >= 4096 else []
        if starts and len(raw) % 4096:
            starts.append(len(raw) - 4096)
        bad = sum(not 0.20 <= packed_size(raw[a:a + 4096]) / 4096 <= 0.75 for a in starts)
        limit = next(((low, high) for least, low, high in LIMITS if len(raw) >= least), (0, 99))
        want.append((str(i), round(ratio, 12), len(starts), bad, limit[0] <= ratio <= limit[1] and bad <= 0.34 * len(starts)))
    got = rules.quality_rules(table).collect()
    assert sorted((str(r.doc_id), round(r.ratio, 12), r.n_chunks, r.n_bad_chunks) for r in got) == sorted(x[:4] for x in want)
    good = {(x[0], x[1]): x[4] for x in want}
    assert all(r.kept == (not r.base_failed and good[str(r.doc_id), round(r.ratio, 12)]) for r in got)
    assert {r.kept for r in got if not r.base_failed} == {True, False}


def step_levels(y, n):
    """The non-decreasing fit of means y/n by the max-min formula."""
    k = len(n)
    return [max(min(sum(y[a:b + 1]) / sum(n[a:b + 1]) for b in range(i, k)) for a in range(i + 1)) for i in range(k)]


def test_classifier_matches_a_fit_in_one_place(spark):
    """Random features, ridge by least squares on stacked rows and max-min calibration, without Spark's sums."""
    stats = quality.document_statistics(spark.read.parquet(f"{SF01}/documents.parquet")).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(4))).toPandas()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect() if r.quality is not None}
    ids = stats["doc_id"].tolist()
    x = np.array(stats["x"].tolist())
    held = np.array([zlib.crc32(str(i).encode()) % 3 == 1 for i in ids])
    known = np.array([i in label for i in ids]) & ~held
    y = np.array([label.get(i, 0) for i in ids], float)
    calibrates = known & (stats["fold"].to_numpy() == 0)
    fits = known & ~calibrates
    d = x.shape[1]
    rng = np.random.default_rng(quality.SEED)
    direction, phase = rng.normal(size=(d, quality.WIDTH)) / (quality.KERNEL * np.sqrt(d)), rng.uniform(0, 2 * np.pi, quality.WIDTH)
    scale = x[known].std(axis=0)
    z = np.clip((x - x[known].mean(axis=0)) / np.where(scale > 1e-9, scale, 1.0), -8, 8) @ direction + phase
    z = np.column_stack([np.ones(len(x)), np.sqrt(2 / quality.WIDTH) * np.cos(z)])
    n = fits.sum()
    # min |Zw - y|^2 / n + RIDGE |w|^2, as one least-squares problem
    weight = np.linalg.lstsq(np.vstack([z[fits] / np.sqrt(n), np.sqrt(quality.RIDGE) * np.eye(z.shape[1])]),
                             np.concatenate([y[fits] / np.sqrt(n), np.zeros(z.shape[1])]), rcond=None)[0]
    raw = z @ weight
    got = {r.doc_id: r for r in queries.op1_quality_score(spark, SF01).collect()}
    assert set(got) == set(ids) and all(got[i].held_out == h for i, h in zip(ids, held.tolist(), strict=True))
    step = np.clip(np.floor((raw + 0.5) / 2 * quality.STEPS), 0, quality.STEPS - 1).astype(int)
    used = sorted(set(step[calibrates].tolist()))
    ys = [y[calibrates & (step == s)].sum() for s in used]
    ns = [int((calibrates & (step == s)).sum()) for s in used]
    level = np.array(step_levels(ys, ns))
    # Knots lie at the mean place of a block of equal level.
    place = (np.array(used) + 0.5) / quality.STEPS * 2 - 0.5
    tops = sorted(set(level.tolist()))
    knots = [np.average(place[level == t], weights=np.array(ns)[level == t]) for t in tops]
    want = 0.999 * np.interp(raw, knots, tops) + 0.001 * np.clip((raw + 0.5) / 2, 0, 1)
    score = np.array([got[i].score for i in ids])
    # A row at the edge of a step may fall to its neighbour by rounding of the sums; that moves few scores a little.
    assert np.mean(np.abs(score - want) < 1e-3) >= 0.99 and np.abs(score - want).max() < 0.1
    assert np.mean((score >= 0.5) == (want >= 0.5)) >= 0.999


def line_survivors(rows):
    """rows: doc_id, text, source. Lines of 10 characters or more stay once per group of similar ones, the first by document and place."""
    places = [(i, k, x.strip(SPACE)) for i, t, _ in sorted(rows, key=lambda r: r[0]) for k, x in enumerate((t or "").split("\n")) if len(x.strip(SPACE)) >= 10]
    distinct = sorted({x for _, _, x in places})
    sets = [{x[j:j + 8] for j in range(len(x) - 7)} for x in distinct]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if 3 * len(sets[a]) <= 4 * len(sets[b]) <= 6 * len(sets[a]) and similar(sets[a], sets[b])]
    top = dict(zip(distinct, union_find(len(sets), near), strict=True))
    seen, gone = set(), {}
    for i, k, x in places:
        if top[x] in seen:
            gone.setdefault(i, set()).add(k)
        seen.add(top[x])
    out = []
    for i, t, s in rows:
        if i in gone:
            t = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
            if not WORD.search(t):
                continue
        out.append((i, t, s))
    return out


def one_of_each(rows):
    """The smallest doc_id of every group of documents with similar sets of 5-word shingles."""
    rows = sorted(rows, key=lambda r: r[0])
    sets = []
    for _, t, _ in rows:
        w = WORD.findall((t or "").translate(FOLD))
        sets.append({tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    top = union_find(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if similar(sets[a], sets[b])])
    return [r for k, r in enumerate(rows) if top[k] == k]


def test_pipeline_matches_a_chain_of_brute_force_stages(spark, tmp_path):
    """Every stage's decisions take effect on what the stage before kept: encoded rows equal those of a plain chain."""
    import corpus_pipeline as P

    rng = random.Random(12)
    given = spark.read.parquet(f"{SF01}/documents.parquet")
    short = given.filter("length(text) < 4000").join(spark.read.parquet(f"{SF01}/labels.parquet").filter("quality is not null").select("doc_id", "quality"), "doc_id")
    rows = [r.asDict() for q in (0, 1) for r in short.filter(F.col("quality") == q).orderBy("doc_id").limit(45 + 30 * q).drop("quality").collect()]
    shared = "A passage that many of the documents share, with a number of its own: %d."
    for k, r in enumerate(rows):
        if k % 6 == 0:
            r["text"] = (r["text"] or "") + "\n" + shared % (7 if k % 12 else 8)
    for k in range(25):  # near copies
        r = dict(rng.choice(rows[:120]))
        w = (r["text"] or "").split(" ")
        w[rng.randrange(len(w))] = "changed%d" % k
        rows.append(r | {"doc_id": 10**7 + k, "text": " ".join(w)})
    rows.append(rows[0] | {"doc_id": 2 * 10**7, "text": None})
    spark.createDataFrame(rows, given.schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF01}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs, labels = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")

    accepted = {r.doc_id for r in quality.score_documents(docs, labels).collect() if r.predicted == 1}
    assert 0 < len(accepted) < len(rows)
    after = [line_survivors([(r["doc_id"], r["text"], r["source"]) for r in rows if r["doc_id"] in accepted])]
    after.append(one_of_each(after[0]))
    assert len(after[1]) < len(after[0]) <= len(accepted)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", after[1])
    mixed = con.sql(queries.OP6_SQL)
    taken = [dict(zip(mixed.columns, r, strict=True)) for r in mixed.fetchall()]
    text = {i: t for i, t, _ in after[1]}
    encode = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json"))).encode
    want = sorted((r["doc_id"], encode(text[r["doc_id"]], add_special_tokens=False).ids) for r in taken if r["size"] for _ in range(r["taken"] // r["size"]))
    got = P.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, list(r.token_ids)) for r in got if r.token_ids) == want
    assert len({i for i, _ in want}) > 10
