"""Near-duplicates, line dedup, components and embeddings against brute force."""

import random
import re

import numpy as np
import pyarrow as pa

from ordermill.llm import embeds, linedup, neardup
from ordermill.llm import components as C

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def union_find(n, pairs):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def similar(a, b, percent=75):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= percent * (len(a) + len(b) - both)


def test_near_duplicates_match_brute_force(docs, doc_rows):
    got = sorted((r.doc_id is not None, r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect())
    sets = []
    for row in doc_rows:
        w = WORD.findall((row[1] or "").translate(FOLD))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    top = union_find(len(sets), [(a, b) for a in range(len(sets)) for b in range(a) if similar(sets[a], sets[b])])
    smallest = {}
    for row, t in zip(doc_rows, top, strict=True):
        smallest[t] = min([x for x in (smallest.get(t), row[0]) if x is not None], default=None)
    want = sorted((r[0] is not None, r[0], len(s), smallest[t], smallest[t] == r[0]) for r, s, t in zip(doc_rows, sets, top, strict=True))
    assert got == want


def test_keep_one_keeps_columns_and_one_row_per_component(docs, no_docs):
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 0 in ids and 100 not in ids and ids.count(307) == 0 and {300, 301, 302, 303} <= set(ids) and 304 not in ids
    assert neardup.keep_one(no_docs).collect() == []


def test_keep_one_decides_by_row(spark):
    """Null ids and shared ids do not make one document of different texts."""
    rng = random.Random(12)
    text = [" ".join("k%d" % rng.randrange(10**6) for _ in range(40)) for _ in range(6)]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (None, text[2] + " end"), (None, ""), (None, None), (None, " "), (7, text[3]), (7, text[4]), (7, text[4]),
            (1, text[2]), (2, text[4] + " end"), (9, text[5]), (8, text[5].upper()), (3, ""), (3, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(5)
    want = [(None, text[0]), (None, text[1]), (None, ""), (None, None), (None, " "), (7, text[3]), (1, text[2]), (2, text[4] + " end"), (8, text[5].upper()), (3, ""), (3, "")]
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, want))


def test_tiles_find_links_that_no_hub_has(spark, monkeypatch):
    """Chains of near copies: neighbours are linked, ends are not; small chunks make many tiles."""
    monkeypatch.setattr(neardup, "CHUNK_SETS", 4)
    rng = random.Random(1)
    words = ["t%d" % rng.randrange(10**6) for _ in range(80)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[2 * i] = "n%d" % rng.randrange(10**6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [{tuple(t.split()[i:i + 5]) for i in range(76)} for _, t in rows]
    top = union_find(40, [(a, b) for a in range(40) for b in range(a) if similar(sets[a], sets[b])])
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()} == dict(enumerate(top))


def test_components_of_a_chain_over_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(C, "LAST_EDGES", 20)
    edges = [(i, i + 1) for i in range(1, 200) if i % 50] + [(7, 7), (None, 3), (300, 250), (250, 300)]
    got = {r.node: r.root for r in C.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    groups = {}
    for node, root in got.items():
        groups.setdefault(root, set()).add(node)
    want = [set(range(1 + 50 * k, 51 + 50 * k)) for k in range(4)] + [{250, 300}]
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want))
    assert C.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def line_rows(doc_rows):
    rng = random.Random(8)
    long = ["line %d of the text with number %d and word %d" % (i, rng.randrange(10**9), rng.randrange(10**9)) for i in range(60)]
    rows = []
    for i in range(25):
        own = rng.sample(long, 4) + ["only here %d %d" % (rng.randrange(10**9), rng.randrange(10**9)), "short", "short", "", "  " + long[0] + "\t"]
        near = long[1].replace("text", "t%xt" % rng.randrange(9))
        rows.append((i, "\n".join([*own, near]) + ("\n" if i % 2 else "")))
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, rows[0][1]), (54, "\n".join(long[k % 60] for k in range(5000))), (None, long[5]), (56, long[0])]
    return rows


def test_line_dedup_matches_brute_force(spark, doc_rows):
    rows = line_rows(doc_rows)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, line string, key string").repartition(3)
    got = {r.doc_id: (r.text, r.dropped_lines) for r in linedup.deduplicate_lines(docs).collect()}
    places = [(i, k, x.strip(SPACE)) for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for k, x in enumerate((t or "").split("\n")) if len(x.strip(SPACE)) >= 10]
    distinct = sorted({x for _, _, x in places})
    sets = [{x[j:j + 8] for j in range(len(x) - 7)} for x in distinct]
    top = dict(zip(distinct, union_find(len(sets), [(a, b) for a in range(len(sets)) for b in range(a) if similar(sets[a], sets[b])]), strict=True))
    seen, gone = set(), {}
    for i, k, x in places:
        if top[x] in seen:
            gone.setdefault(i, []).append(k)
        seen.add(top[x])
    for i, t in rows:
        left = t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone.get(i, [])))
        assert got[i] == (left, gone.get(i)), i
    kept = linedup.without_copied_lines(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {50, 51, 52, 0} <= ids and 56 not in ids
    assert linedup.deduplicate_lines(docs.limit(0)).collect() == []


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 16))
    x = np.concatenate([x, x[:20] + 0.25 * rng.normal(size=(20, 16)), np.repeat(x[3:4], 30, axis=0), 5 * x[4:5], x[5] + 0.28 * rng.normal(size=(80, 16)), [x[6] * 1e300, x[7] * 1e-300]])
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] + [0.0] * 14, [float("inf")] + [0.0] * 15, [1.0, 2.0]]
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)] + [(1000 + i, v, "b") for i, v in enumerate(bad)] + [(None, x[8].tolist(), "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, copies string")
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    unit = np.concatenate([unit, unit[8:9]])
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    top = union_find(len(unit), np.argwhere(near).tolist())
    ids = [*range(len(x)), None]
    want = {ids[i]: (int(near[i].sum()), top[i], top[i] == ids[i]) for i in range(len(unit))}
    want |= {1000 + i: (0, 1000 + i, True) for i in range(len(bad))}
    for tile in (16_384, 20):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeds.near_vectors(table, tile=tile).collect()}
        assert got == want
    assert embeds.near_vectors(table.limit(0)).collect() == []


def test_vectors_of_many_lengths(spark):
    """A batch of over a thousand lengths gives every row; lengths up to 41 are compared to the end (rotations of long vectors take long)."""
    rows = []
    for n in range(2, 1052):
        v = [1.0] + [0.0] * (n - 1)
        rows += [(10 * n, v), (10 * n + 1, [1.0, 0.1] + [0.0] * (n - 2)), (10 * n + 2, [0.0] * (n - 1) + [1.0])]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([v for _, v in rows])], ["rep", "v"])
    parts = list(embeds._by_length(batch))
    assert len(parts) == 1050 and all(p.num_rows == 3 and len({len(v) for v in p.column("v").to_pylist()}) == 1 for p in parts)
    assert sorted(i for p in parts for i in p.column("rep").to_pylist()) == sorted(i for i, _ in rows)
    keep = [r for r in rows if r[0] < 420]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeds.near_vectors(spark.createDataFrame(keep, "vec_id long, embedding array<double>").repartition(2)).collect()}
    assert got == {i: (1, i - i % 10) if i % 10 < 2 else (0, i) for i, _ in keep}


def test_pairs_at_the_edge_of_a_block_count_once(spark):
    """Pairs whose distance in the first block lies at its budget, where the block is the whole grid."""
    turn = embeds.rotation(8)
    rows = []
    for i, extra in enumerate(np.linspace(-2e-4, 2e-4, 201)):
        angle = 2 * np.pi * i / 201
        base = np.array([np.cos(angle), np.sin(angle), 0, 0, 0, 0, 0, 0]) * 0.6 + np.array([0, 0, 0, 0, 0, 0, 0.8 * np.cos(7 * angle), 0.8 * np.sin(7 * angle)])
        near = base + np.array([-np.sin(angle), np.cos(angle), 0, 0, 0, 0, 0, 0]) * np.sqrt(0.05 + extra)
        rows += [base @ turn.T, near @ turn.T]
    x = np.array(rows)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeds.near_vectors(table).collect()}
    assert got == {i: int(n) for i, n in enumerate(near.sum(axis=1))}
