"""Steps of line deduplication: packed lines, signatures and rebuilt texts against plain recomputations."""

import random

import numpy as np
import pyarrow as pa

from ordermill.llm import linedup, textkit


def texts_of(rng, n):
    return [None if i % 17 == 0 else "\n".join(rng.choice(["", "a", "éé x", "日本", "  long line of text"]) for _ in range(rng.randrange(7))) for i in range(n)]


def test_texts_without_lines_match_split_and_join(monkeypatch):
    monkeypatch.setattr(linedup, "SLICE_BYTES", 64)
    rng = random.Random(1)
    texts = texts_of(rng, 2000)
    drops = [None if t is None or rng.random() < 0.3 else sorted(rng.sample(range(t.count("\n") + 1), rng.randrange(1, t.count("\n") + 2))) for t in texts]
    whole = pa.RecordBatch.from_arrays([pa.array(drops, pa.list_(pa.int64())), pa.array(texts, pa.string())], ["dropped_lines", "text"])
    for batch in (whole, whole.slice(100, 900), whole.slice(0, 0)):
        got = next(linedup._rebuild(iter([batch]))).column("text")
        assert got.type == pa.string()
        assert got.to_pylist() == [t if d is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in d)
                                   for t, d in zip(batch.column("text").to_pylist(), batch.column("dropped_lines").to_pylist(), strict=True)]


def test_signatures_are_minima_over_the_shingles_of_a_line():
    """Neighbours in a slice, other characters and repeats do not change a line's signature."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdé日\U0001f600 ") for _ in range(rng.randrange(12, 90))).strip().ljust(12, "z") for _ in range(200)]

    def signed(lines):
        own = linedup.Lines(next(textkit.slices(pa.array(lines), 1 << 20)))
        return own.signatures(np.arange(len(own.text)))

    together = signed(["\n".join(texts[:120]), *texts[120:]])
    assert together.shape == (200, linedup.BANDS * linedup.ROWS)
    assert all((signed([t])[0] == together[i]).all() for i, t in enumerate(texts))
    assert (signed([texts[0] + texts[0]])[0] <= together[0]).all()


def test_near_lines_share_a_band():
    """Of planted pairs with a similarity of 0.75 to 0.8 nearly all become candidates, long lines or short ones."""
    rng = random.Random(3)
    for length in (16, 60, 250):
        left, right = [], []
        for _ in range(3000):
            a = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz_") for _ in range(length))
            b = a[rng.randrange((length - 7) * 22 // 100, (length - 7) // 4) + 1:]
            x, y = ({t[i:i + 8] for i in range(len(t) - 7)} for t in (a, b))
            if 75 * len(x | y) <= 100 * len(x & y) <= 80 * len(x | y):
                left.append(a)
                right.append(b)
        assert len(left) > 1000

        def keys(lines):
            own = linedup.Lines(next(textkit.slices(pa.array(["\n".join(lines)]), 1 << 20)))
            return linedup.band_keys(own.signatures(np.arange(len(lines))))

        found = (keys(left) == keys(right)).any(axis=1)
        assert found.mean() >= 0.995, (length, found.mean())
        assert not (keys(left)[1:] == keys(right)[:-1]).any()


def test_a_line_is_no_row_of_its_own(spark):
    """Lines move packed, a row per batch and group; names may be texts, rows may be copies, ids null."""
    rng = random.Random(4)
    long = ["line %d of the text with number %d and word %d" % (i, rng.randrange(10**9), rng.randrange(10**9)) for i in range(300)]
    rows = [(None if i == 40 else "d%02d" % i, "\n".join(rng.choice(long) for _ in range(100))) for i in range(80)]
    rows += [rows[3], rows[40], ("d05", rows[7][1]), ("x", None), ("y", "")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    stars = linedup.candidate_stars(docs, 1)
    nodes = stars.selectExpr("explode(array(a, b)) AS key").distinct()
    found = linedup.read_lines(docs.selectExpr("doc_id", "text", "xxhash64(text) AS version"), nodes, 8).cache()
    packed = found.filter("packed is not null").selectExpr("length(packed) AS n", "size(ids) AS ids").collect()
    assert len(packed) <= 3 * 8
    assert all(r.n == 32 * r.ids for r in packed)
    version = {r.text: r.v for r in docs.selectExpr("text", "xxhash64(text) AS v").collect()}
    first, gone = {}, {}
    for row in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or "", version[r[1]])):
        lines = (row[1] or "").split("\n")
        gone[row] = [k for k, x in enumerate(lines) if len(x) >= 10 and first.setdefault(x, (row, k)) != (row, k)]
    want = [(i, t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, t]), gone[i, t] or None) for i, t in rows]
    got = [(r.doc_id, r.text, r.dropped_lines) for r in linedup.deduplicate_lines(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
