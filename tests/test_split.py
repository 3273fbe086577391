from __future__ import annotations

import math
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskmill.functions.hashing import BUCKET, ORDER, leading_bucket, shuffle_key
from riskmill.operators import split
from riskmill.sources.splits import load_or_create_split, read_split_positions


def test_published_stratum_sizes():
    """Class counts 1,420 and 3,003 give 994 + 426 and 2,102 + 901 rows."""
    assert split.train_quotas({1: 1420, 0: 3003}) == {1: 994, 0: 2102}


@given(st.dictionaries(st.integers(0, 5), st.integers(1, 200), min_size=1), st.integers(2, 7))
def test_quotas(sizes, folds):
    total = sum(sizes.values())
    train = split.train_quotas(sizes)
    assert sum(train.values()) == total - math.ceil(0.3 * total)
    assert all(abs(train[c] - n * sum(train.values()) / total) < 1 for c, n in sizes.items())
    dealt = split.fold_quotas(sizes, folds)
    assert all(sum(dealt[c]) == n for c, n in sizes.items())
    per_fold = [sum(dealt[c][f] for c in sizes) for f in range(folds)]
    assert max(per_fold) - min(per_fold) <= 1
    assert all(max(q) - min(q) <= 1 for q in dealt.values())


@pytest.fixture(scope="module")
def rows(spark):
    """A rare class, a large class and rows without a label."""
    label = F.when(F.col("id") % 50 == 0, "rare").when(F.col("id") % 41 == 0, None).otherwise("big")
    return spark.range(2000).select(F.col("id").alias("row_id"), label.alias("y"))


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_split_is_disjoint_complete_and_exact(rows, method):
    got = split.stratified_split(rows, "y", "row_id", method=method).collect()
    assert len(got) == 2000 and len({r["row_id"] for r in got}) == 2000
    sizes = Counter((r["y"], r["part"]) for r in got)
    labelled = Counter(r["y"] for r in got if r["y"])
    quotas = split.train_quotas(labelled)
    for label, n in labelled.items():
        assert sizes[label, "train"] == quotas[label]
        assert sizes[label, "test"] == n - quotas[label]
    assert all(r["part"] is None for r in got if r["y"] is None)


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_folds_equal_a_global_ranking(rows, method):
    """The cut keys give what ranking every row would give."""
    got = split.stratified_folds(rows, "y", "row_id", method=method).withColumn(
        "k", shuffle_key(F.col("row_id"), 42, method)
    ).collect()
    for label in ("rare", "big"):
        members = sorted(((r["k"], r["row_id"], r["fold"]) for r in got if r["y"] == label))
        sizes = Counter(r["y"] for r in got if r["y"])
        quota = split.fold_quotas(sizes)[label]
        expected = [f for f, n in enumerate(quota) for _ in range(n)]
        assert [fold for _, _, fold in members] == expected


def test_tiny_classes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c")], "row_id int, y string")
    folds = split.stratified_folds(rows, "y", "row_id", folds=3).collect()
    assert Counter(Counter(r["fold"] for r in folds).values()) == Counter([2, 1, 1])
    parts = split.stratified_split(rows, "y", "row_id").collect()
    assert Counter(r["part"] for r in parts) == {"train": 2, "test": 2}


def test_split_is_stable_under_partitioning(rows):
    one = split.stratified_split(rows.repartition(7), "y", "row_id").collect()
    two = split.stratified_split(rows.coalesce(1), "y", "row_id").collect()
    assert {(r["row_id"], r["part"]) for r in one} == {(r["row_id"], r["part"]) for r in two}


def test_assignment_shuffles_nothing(rows):
    plan = split.stratified_split(rows, "y", "row_id")._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_buckets_follow_the_key_order(spark, method):
    key = shuffle_key(F.col("id"), 1, method).alias(ORDER)
    rows = spark.range(500).select(key).withColumn(BUCKET, leading_bucket(F.col(ORDER), method))
    buckets = [r[BUCKET] for r in rows.orderBy(ORDER).collect()]
    assert buckets == sorted(buckets)


def test_training_prefixes(rows):
    folds = split.stratified_folds(rows.where("y is not null"), "y", "row_id", folds=3).persist()
    cuts = split.training_prefixes(folds, "fold", "row_id", (0.1, 0.5, 1.0), folds=3)
    local = folds.collect()
    for (fold, size), cut in cuts.items():
        ids = sorted(r["row_id"] for r in local if r["fold"] != fold)
        assert cut == ids[min(size, len(ids)) - 1]
    assert len(cuts) == 9
    marked = folds.withColumn("rare", (F.col("y") == "rare").cast("int"))
    counted = split.prefix_counts(marked, "fold", "row_id", "rare", cuts).collect()
    assert len(counted) == 9
    for row in counted:
        members = sorted((r["row_id"], r["y"]) for r in local if r["fold"] != row["fold"])
        members = members[: row["train_size"]]
        assert row["n"] == len(members) and row["last_id"] == members[-1][0]
        assert row["positives"] == sum(y == "rare" for _, y in members)


def test_saved_split_is_reused_only_if_it_fits(rows, tmp_path):
    folder = str(tmp_path)
    first = load_or_create_split(rows, folder, "y", "row_id")
    again = load_or_create_split(rows, folder, "y", "row_id")
    assert not first.reused and again.reused
    assert sorted(first.ids.collect()) == sorted(again.ids.collect())
    assert again.info["n_train"] + again.info["n_test"] == rows.where("y is not null").count()
    other = load_or_create_split(rows, folder, "y", "row_id", seed=7)
    assert not other.reused
    assert not load_or_create_split(rows.limit(100), folder, "y", "row_id").reused


def test_positions_from_json(spark, tmp_path):
    path = tmp_path / "split.json"
    path.write_text(
        '{"n_rows": 4, "test_size": 0.3, "random_state": 42, "stratify_column": "target",'
        ' "n_train": 3, "n_test": 1, "train_index": [0, 1, 3], "test_index": [2]}'
    )
    ids, info = read_split_positions(spark, str(path))
    assert info["n_rows"] == 4 and info["stratify_column"] == "target"
    assert sorted((r["row_id"], r["part"]) for r in ids.collect()) == [
        (0, "train"), (1, "train"), (2, "test"), (3, "train")]


def test_labelled_part(rows, table):
    ids = split.stratified_split(rows, "y", "row_id").select("row_id", "part")
    train = split.labelled_part(rows, ids, "row_id", "y", "train")
    assert train.count() == ids.where("part = 'train'").count()


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_buckets_are_narrowed_until_they_are_small(spark, monkeypatch, method):
    """Ranking whole buckets and narrowing to the last bit give the same split."""
    from riskmill.operators import split as module

    df = spark.range(900).select((F.col("id") * 7).alias("unit_id"), (F.col("id") % 3).cast("int").alias("y"))
    key = module.shuffle_key
    # All keys share their leading 16 bits, so the first bucket of a class holds all of it.
    crowded = {"xxhash64": lambda c, seed, m: F.shiftrightunsigned(key(c, seed, m), 16),
               "md5": lambda c, seed, m: F.concat(F.lit("0000"), key(c, seed, m))}[method]
    for keys in (key, crowded):
        monkeypatch.setattr(module, "shuffle_key", keys)
        tables = []
        for small in (10**6, 5):
            monkeypatch.setattr(module, "SMALL_BUCKET", small)
            tables.append(sorted(map(tuple, module.stratified_folds(df, "y", "unit_id", method=method).collect())))
        assert tables[0] == tables[1]
        assert Counter((y, fold) for _, y, fold in tables[0]) == {(y, fold): 60 for y in range(3) for fold in range(5)}
