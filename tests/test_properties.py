"""Property tests with seeded random frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ordermill.operators import shape, tables

keys = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), min_size=0, max_size=12)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(t=keys, s=keys)
def test_upsert_properties(spark, t, s):
    target = spark.createDataFrame(sorted(dict(t).items()) or [], "k int, v int")
    staged = spark.createDataFrame(sorted(dict(s).items()) or [], "k int, v int")
    once = tables.upsert(target, staged, ["k"])
    twice = tables.upsert(once, staged, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    c = tables.upsert_counts(target, staged, ["k"]).first()
    assert c.inserted + c.updated == c.affected == len(dict(s))
    assert once.count() == len(set(dict(t)) | set(dict(s)))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50), st.integers(0, 10**6)), max_size=40,
                     unique_by=lambda r: r[2]))
def test_latest_per_key_properties(spark, rows):
    df = spark.createDataFrame(rows or [], "k int, ts int, id int")
    a = shape.latest_per_key(df, ["k"], ["ts"], tie_break=["id"])
    b = shape.latest_per_key(df.repartition(5), ["k"], ["ts"], tie_break=["id"])
    assert a.count() == len({r[0] for r in rows})
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
