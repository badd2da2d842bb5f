"""Composed catalog migration with validation and all-or-nothing publish."""

import datetime as dt

import pytest

from ordermill.operators.tables import KeyCollision, insert_rows, upsert
from ordermill.plans import migration
from ordermill.plans.migration import publish_seed, run_migration
from ordermill.sources import snapshots

AT = "2025-05-01 00:00:00"
STAMP = dt.datetime(2025, 1, 1)


def _seed(spark, root):
    products = spark.createDataFrame(
        [("S1", "p1", "Sling", "Red", STAMP, STAMP), ("S2", "p2", "Pouch", "Blue", STAMP, STAMP),
         ("S3", "p3", "Bag", "Green", STAMP, STAMP)],
        "product_sku string, product_id string, product_name string, product_color string, "
        "created_at timestamp, modified_at timestamp")
    bom = spark.createDataFrame(
        [("S1", "panel", "Canvas", 2, STAMP), ("S2", "strap", "Black", 1, STAMP), ("S3", "pocket", "Olive", 1, STAMP)],
        "product_sku string, material_piece string, material_color string, material_quantity smallint, "
        "modified_at timestamp")
    publish_seed(spark, root, products, bom)


def _read(spark, root, name):
    return snapshots.current(spark, root).read(spark, name)


def _inputs(spark):
    new = spark.createDataFrame([("S9", "n9", "Sling", None), ("S8", "n8", "Pouch", "Teal")],
                                "product_sku string, product_id string, product_name string, product_color string")
    mapping = spark.createDataFrame([("S1", "S9", None), ("S2", "S8", "moved"), ("S3", "S3", None)],
                                    "old_sku string, new_sku string, migration_reason string")
    return new, mapping


def test_migration_publishes_when_counts_match(spark, tmp_dir):
    _seed(spark, tmp_dir)
    new, mapping = _inputs(spark)
    got = run_migration(tmp_dir, ["S1", "S2", "S3"], new, mapping,
                        {"Legacy products": 3, "New products": 2, "Migration entries": 3}, "m1", at=AT)
    assert got == {"Legacy products": 3, "New products": 2, "Migration entries": 3}
    prods = {r.product_sku: (r.product_name, r.product_color) for r in
             _read(spark, tmp_dir, "products").collect()}
    assert prods["S1"] == ("Sling - V1", "Red") and prods["S9"] == ("Sling", "Default Color")
    bom = {r.material_piece: r.product_sku for r in _read(spark, tmp_dir, "bom").collect()}
    assert bom == {"panel": "S9", "strap": "S8", "pocket": "S3"}
    log = {r.old_sku: (r.migration_id, r.migration_reason) for r in _read(spark, tmp_dir, "log").collect()}
    assert log["S1"] == (1, "E-commerce migration") and log["S2"] == (2, "moved")


def test_migration_rejected_keeps_previous_version(spark, tmp_dir):
    _seed(spark, tmp_dir)
    new, mapping = _inputs(spark)
    with pytest.raises(snapshots.PublishRejected):
        run_migration(tmp_dir, ["S1"], new, mapping, {"Legacy products": 3}, "m1", at=AT)
    names = sorted(r.product_name for r in _read(spark, tmp_dir, "products").collect())
    assert names == ["Bag", "Pouch", "Sling"]


def test_migration_collision_policy(spark, tmp_dir):
    _seed(spark, tmp_dir)
    _, mapping = _inputs(spark)
    clash = spark.createDataFrame([("S1", "n1", "Sling", "Teal")],
                                  "product_sku string, product_id string, product_name string, product_color string")
    with pytest.raises(KeyCollision):
        run_migration(tmp_dir, ["S1"], clash, mapping, None, "m1", at=AT)


def test_rejected_run_is_corrected_under_the_same_id(spark, tmp_dir):
    _seed(spark, tmp_dir)
    new, mapping = _inputs(spark)
    wrong = spark.createDataFrame([("S1", "S8", None)], "old_sku string, new_sku string, migration_reason string")
    with pytest.raises(snapshots.PublishRejected):
        run_migration(tmp_dir, ["S1"], new, wrong, {"Migration entries": 3}, "m1", at=AT)
    assert _read(spark, tmp_dir, "log") is None
    want = {"Legacy products": 3, "New products": 2, "Migration entries": 3}
    assert run_migration(tmp_dir, ["S1", "S2", "S3"], new, mapping, want, "m1", at=AT) == want
    assert run_migration(tmp_dir, ["S1", "S2", "S3"], new, mapping, want, "m1", at=AT) == want  # done: changes nothing
    assert {r.material_piece: r.product_sku for r in _read(spark, tmp_dir, "bom").collect()}["panel"] == "S9"
    assert _read(spark, tmp_dir, "log").count() == 3


def test_run_that_crashed_before_the_commit_is_run_again(spark, tmp_dir, monkeypatch):
    _seed(spark, tmp_dir)
    new, mapping = _inputs(spark)

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(migration.tables, "remap_keys", crash)
        with pytest.raises(RuntimeError):
            run_migration(tmp_dir, ["S1"], new, mapping, None, "m1", at=AT)
    assert _read(spark, tmp_dir, "products").count() == 3
    run_migration(tmp_dir, ["S1"], new, mapping, None, "m1", at=AT)
    assert _read(spark, tmp_dir, "products").count() == 5 and _read(spark, tmp_dir, "log").count() == 3


def test_repeated_keys_among_new_rows_raise(spark):
    old = spark.createDataFrame([("A", 1)], "k string, v int")
    twice = spark.createDataFrame([("B", 1), ("B", 2)], "k string, v int")
    for policy in ("error", "ignore", "replace"):
        with pytest.raises(KeyCollision):
            insert_rows(old, twice, ["k"], on_conflict=policy)
    with pytest.raises(KeyCollision):
        upsert(old, twice, ["k"])
