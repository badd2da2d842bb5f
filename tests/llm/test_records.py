"""WARC, chat formatting, secrets, and the pipeline."""

import base64
import hashlib
import io
import random

from pyspark.sql import functions as F

from ordermill.llm import chat, secrets, warc
from tests_path import SMOKE


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (9, "u", "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "x" * 300000 + "\r\n\r\n"), (None, "u", "<p>é</p>"), (6, "u", "same"), (6, "u", "same"), (7, "u", "alone")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, archive string").repartition(3)
    got = warc.round_trip(spark, pages, archive_bytes=500).collect()
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        again = i != last[h or ""]
        want.append((f"urn:page:{'none' if i is None else i}", len(body), b32(body), "revisit" if again else "response", f"urn:page:{last[h or '']}" if again else None, None if again else body, None))
    seen = [(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload), r.error) for r in got]
    assert sorted(map(str, seen)) == sorted(map(str, want))
    assert "http://a/%0D%0Ax" in {r.target_uri for r in got}
    small = warc.with_revisits(pages, least_bytes=5).collect()
    assert {r.record_type for r in small if r.html in (None, "", "same")} == {"response"}
    assert warc.round_trip(spark, pages.limit(0)).collect() == []


def test_warc_reader_tells_of_damage():
    one, two = warc.record("urn:page:1", "response", b"hello " * 50000), warc.record("urn:page:2", "response", b"two")
    both = list(warc.read_archive(io.BytesIO(one + two)))
    assert [r["error"] for r in both] == [None, None] and [r["position"] for r in both] == [0, len(one)]
    cut = list(warc.read_archive(io.BytesIO(one + two[:-9])))
    assert len(cut) == 2 and "truncated" in cut[1]["error"]
    assert "damaged" in list(warc.read_archive(io.BytesIO(b"no gzip at all")))[0]["error"]
    forged = warc.record("urn:page:3", "response", b"payload")
    import zlib

    text = zlib.decompress(forged, 31).replace(b"payload", b"pay1oad", 1)
    if b"pay1oad" not in text.split(b"\r\n\r\n")[-2]:
        text = zlib.decompress(forged, 31)
        text = text[:-11] + b"pay1oad" + text[-4:]
    bad = zlib.compressobj(6, zlib.DEFLATED, 31)
    got = list(warc.read_archive(io.BytesIO(bad.compress(text) + bad.flush())))
    assert "digest differs" in got[0]["error"]


def test_warc_headers_of_any_length(spark):
    long = "http://a/" + "x" * (2 << 20)
    rows = [(1, "u", "one"), (2, long, "two"), (3, "u", "three"), (4, long + "é", "four"), (5, None, "five")]
    got = warc.round_trip(spark, spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()
    assert sorted((r.record_id, r.target_uri or "", bytes(r.payload), r.error) for r in got) == [(f"urn:page:{i}", u or "", h.encode(), None) for i, u, h in rows]
    # The header's end on every side of the bounds of the pieces that are read.
    for n in range(65536 - 300, 65536 - 220):
        both = list(warc.read_archive(io.BytesIO(warc.record("urn:page:1", "response", b"a", "u" * n) + warc.record("urn:page:2", "response", b"b"))))
        assert [r["error"] for r in both] == [None, None] and both[0]["target_uri"] == "u" * n
    import gzip

    assert "no WARC record" in list(warc.read_archive(io.BytesIO(gzip.compress(b"W" * (3 << 20)))))[0]["error"]
    assert "no end" in list(warc.read_archive(io.BytesIO(gzip.compress(b"WARC/1.1" * (1 << 18)))))[0]["error"]


def snapshots():
    rng = random.Random(4)
    turns = []
    for c in range(30):
        n = rng.randrange(2, 9)
        talk = [(k, "user" if k % 2 == 0 else "assistant", f"talk {c} turn {k}" if k or c % 3 else "hello") for k in range(n)]
        for copy, upto in enumerate([n, *rng.sample(range(1, n + 1), min(2, n))]):
            turns += [(1000 * copy + c, *t) for t in talk[:upto]]
    turns += [(9000, k, "user", f"long {k}") for k in range(700)] + [(9001, k, "user", f"long {k}") for k in range(600)]
    turns += [(9002, 0, None, None), (9003, 0, None, ""), (9004, None, "user", "x"), (9004, 1, "user", "y"), (None, 0, "user", "nobody"), (9004, 1, "user", "y"), (9005, 5, "user", "tie b"), (9005, 5, "user", "tie a")]
    return turns


def test_chats_keep_maximal_conversations(spark):
    turns = snapshots()
    table = spark.createDataFrame([(*t, "a") for t in turns], "conv_id long, turn long, role string, text string, h string").repartition(4)
    got = chat.format_chats(table).collect()
    talks = {}
    for c, k, r, t in dict.fromkeys(turns):
        talks.setdefault(c, []).append((k is not None, k, r, t))
    ties = {9005}
    talks = {c: tuple((r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1] or 0))) for c, v in talks.items()}
    groups = {}
    for c, v in talks.items():
        groups.setdefault(v, []).append(c)
    keep = {min(c, key=lambda x: (x is None, x)): len(c) for v, c in groups.items() if not any(len(w) > len(v) and w[:len(v)] == v for w in groups)}
    assert {r.conv_id: r.copies for r in got} == keep
    text = {}
    for r in sorted(got, key=lambda r: r.piece):
        text[r.conv_id] = text.get(r.conv_id, "") + r.text
    for c in keep:
        if c not in ties:
            assert text[c] == "".join(f"<|{r or 'unknown'}|>\n{t or ''}<|end|>\n" for r, t in talks[c])
    assert max(r.piece for r in got) == 700 // 64
    assert chat.format_chats(table.limit(0)).collect() == []


def test_secret_scan(spark):
    rng = random.Random(6)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))
    plain = lambda: "".join(rng.choice(["ther", "ing", "ation", "ness", "over", "ally"]) for _ in range(5))
    docs, truth = [], {}
    for i in range(300):
        value = [key(), hexes(40), plain()][i % 3]
        body = [f"as of {value} the end", f"the token = \"{value}\" is", f"over the {value} hill"][i % 3]
        docs.append((i, f"some words and more words {body} and the rest", "src", "x"))
        truth[i] = i % 3 < 2
    docs += [(400, None, "src", "x"), (401, "", None, "x"), (None, "password=" + hexes(18) + " ok", None, "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string, length string")
    got = secrets.scan(table).collect()
    assert {r.doc_id for r in got} == {*range(300), None}
    assert all(r.secret == truth.get(r.doc_id, True) for r in got)
    assert secrets.scan(table.limit(0)).collect() == []
    # trained on given findings: the same forms, other labels
    rows = secrets.features(secrets.candidates(table), ["the", "and"]).withColumn("label", F.when(F.col("value").startswith("AKIA"), 1).otherwise(0))
    other = secrets.scan(table, labelled=rows).collect()
    assert {r.doc_id for r in other if r.secret} == {i for i in range(300) if i % 3 == 0}


def test_secret_scan_takes_every_match_of_a_word(spark):
    rng = random.Random(7)
    value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    access = "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))
    token = [f"eyJ{i}" + "".join(rng.choice("abcXYZ019_-") for _ in range(30)) for i in range(3)]
    many = ",".join(f'"number_{i:012d}":"{i:040x}"' for i in range(2000))  # one word
    texts = [f"export AWS_SECRET_ACCESS_KEY={value} now", f"so aws_secret_access_key='{value}'", f'{{"access_key_id":"{access}","secret_access_key":"{value}"}}',
             f"Bearer {'.'.join(token)}", many, f"{value}:{value} x"]
    table = spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = secrets.known_findings(secrets.features(secrets.candidates(table), ["the"])).orderBy("doc_id", "place", "part").collect()
    found = lambda i: [r for r in rows if r.doc_id == i]
    assert [r.value for r in found(0)] == ["AWS_SECRET_ACCESS_KEY=", value] and [r.value for r in found(1)] == ["aws_secret_access_key=", value]
    assert [r.value for r in found(2)] == [access, "secret_access_key", value] and [r.value for r in found(3)] == token
    assert [r.value for r in found(4)] == [x for i in range(2000) for x in (f"number_{i:012d}", f"{i:040x}")]
    assert [r.value for r in found(5)] == [value, value] and [r.lead for r in found(5)] == ["", f"{value}:"]
    assert len({(r.doc_id, r.place, r.part) for r in rows}) == len(rows)
    for i, lead in ((0, "AWS_SECRET_ACCESS_KEY="), (1, "aws_secret_access_key='"), (2, 'secret_access_key":"')):
        last = found(i)[-1]
        assert (last.lead, last.hint_inside, last.assigned, last.label) == (lead, 1, 1, 1)
    assert all(r.hint_before == 1 and r.whole_word == 0 for r in found(3))
    assert secrets.scan(table).count() == len(rows)


def test_secret_scan_runs_natively(spark):
    plan = secrets.features(secrets.candidates(spark.read.parquet(f"{SMOKE}/documents.parquet")), ["the"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from ordermill.llm.store import table, written

    docs = table(spark, SMOKE, "documents")
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = written(stage(spark, docs, SMOKE), "stage-test")
        assert docs.columns == columns, name
        assert docs.join(before, "doc_id", "left_anti").count() == 0
    encoded = P.STAGES[-1][1](spark, docs, SMOKE)
    assert encoded.count() == docs.count() and encoded.columns == ["doc_id", "token_ids"]
    empty = table(spark, SMOKE, "documents").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SMOKE).count() == 0


def test_queries_match_their_sql(spark):
    import duckdb

    from ordermill.llm import queries

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name, sql in queries.ORACLE.items():
        df = queries.QUERIES[name](spark, SMOKE)
        rel = con.sql(sql)
        columns = sorted(df.columns)
        assert sorted(rel.columns) == columns, name
        mine = sorted(str([r[c] for c in columns]) for r in df.collect())
        assert mine == sorted(str([r[rel.columns.index(c)] for c in columns]) for r in rel.fetchall()), name


def test_stages_pass_columns_of_any_name(spark):
    """Dotted names, names that the operators use themselves, null and repeated rows: values unchanged."""
    import corpus_pipeline as P
    from ordermill.llm.store import column, table, written

    odd = ["a.b", "row", "name", "given", "near_row_name", "quality_row_name", "dropped_lines", "drop_doc_id", "drop_version", "mix_copy", "mix_doc_id", "mix_n",
           "copy", "shard", "place", "id", "src", "size", "words", "rows", "key", "x", "score", "line", "version", "copies", "b`c", "component_id", "kept"]
    docs = table(spark, SMOKE, "documents").filter("doc_id < 60")
    docs = docs.union(docs.limit(1).select(F.lit(None).cast("long"), F.lit(None).cast("string"), "lang", F.lit(None).cast("string"), F.lit(0).cast("long")))
    docs = docs.select("*", *[F.concat(F.lit(f"{i}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for i, c in enumerate(odd)])
    docs = written(docs, "odd")
    for name, stage in P.STAGES:
        got = stage(spark, docs, SMOKE)
        if name == P.STAGES[-1][0]:
            assert got.columns == ["doc_id", "token_ids"] and got.count() == docs.count()
            continue
        assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema], name
        rows = got.select("doc_id", *[column(c).alias(f"c{i}") for i, c in enumerate(odd)]).collect()
        assert rows, name
        for r in rows:
            assert list(r)[1:] == [f"{i}/{'-' if r.doc_id is None else r.doc_id}" for i in range(len(odd))], name


def test_secret_scan_grows_with_the_text(spark):
    """Every word of a text of megabytes matches: rows carry their own words only."""
    text = " ".join(f"word_{i:036x}" for i in range(60000))
    table = spark.createDataFrame([(1, text, "src")], "doc_id long, text string, source string")
    got = secrets.candidates(table)
    assert got.count() == 60000
    assert "w#" not in got._jdf.queryExecution().optimizedPlan().toString().split("Generate inline")[0]
    some = got.filter("place = 777").first()
    assert (some.value, some.before, some.after) == (f"word_{777:036x}", f"word_{775:036x} word_{776:036x}", f"word_{778:036x}")


def test_mix_is_dealt_by_shard_and_shuffled(spark):
    """The written mix holds whole shards in the order of their places; the tree says which."""
    from ordermill.llm import mixing

    docs = spark.createDataFrame([(i, "w " * (5 + i % 40), f"s{i % 3}") for i in range(400)], "doc_id long, text string, source string")
    sizes = mixing.measured(docs)
    want = mixing.mix(sizes, shards=4, block_words=50).filter("copy is not null")
    order = {}
    for r in want.collect():
        order.setdefault(r.shard, []).append((r.place, r.doc_id))
    order = {k: [i for _, i in sorted(v)] for k, v in order.items()}
    assert sorted(order) == [0, 1, 2, 3] and all(v != sorted(v) for v in order.values())
    parts = mixing.mix_documents(docs, shards=4, block_words=50).select("doc_id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m")).collect()
    got = {}
    for r in sorted(parts, key=lambda r: r.m):
        got.setdefault(r.p, []).append(r.doc_id)
    # a partition is a run of whole shards, each in its order
    pieces = sorted(sum((v for v in order.values()), []))
    assert sorted(sum(got.values(), [])) == pieces
    for ids in got.values():
        while ids:
            shard = next(v for v in order.values() if ids[:len(v)] == v)
            ids = ids[len(shard):]
