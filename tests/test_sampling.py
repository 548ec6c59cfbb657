from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tripline.functions.keys import content_key
from tripline.operators import sampling
from tripline.operators.sampling import first_by_hash, split, train_test_split
from tripline.sources.session import settle


def ids(df):
    return {r.id for r in df.collect()}


def lowest_hashes(n, total, seed):
    return set(sorted(range(total), key=lambda i: hashlib.md5(f"{seed}{i}".encode()).hexdigest())[:n])


@pytest.mark.parametrize("n", [1, 499, 5000])
def test_sample_is_exact_and_equals_plain_top_n(spark, n):
    df = spark.range(5000)
    assert ids(first_by_hash(df, "id", n, seed="7")) == lowest_hashes(n, 5000, "7")


def test_sample_does_not_depend_on_partitions(spark):
    a, b = (ids(first_by_hash(spark.range(0, 3000, 1, p), "id", 100, "x")) for p in (1, 13))
    assert a == b and len(a) == 100


def test_seed_changes_the_sample(spark):
    assert ids(first_by_hash(spark.range(3000), "id", 50, "a")) != ids(
        first_by_hash(spark.range(3000), "id", 50, "b"))


def test_too_few_rows(spark):
    with pytest.raises(Exception, match="fewer than 11 rows"):
        first_by_hash(spark.range(10), "id", 11).collect()
    assert ids(first_by_hash(spark.range(10), "id", 11, too_few="take")) == set(range(10))
    assert ids(first_by_hash(spark.range(0), "id", 11, too_few="take")) == set()
    with pytest.raises(ValueError):
        first_by_hash(spark.range(10), "id", 1, too_few="maybe")


def test_copies_of_one_key(spark):
    """A third of the rows share a key; the count stays exact."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"))
    assert first_by_hash(df, "id", 500).count() == 500
    assert first_by_hash(df, "id", 2999).count() == 2999


def test_split_is_disjoint_complete_and_independent_of_partitions(spark):
    sides = []
    for p in (1, 3, 7):
        train, test = train_test_split(spark.range(0, 5000, 1, p), "id")
        train, test = ids(train), ids(test)
        assert not train & test and train | test == set(range(5000))
        assert 0.77 < len(train) / 5000 < 0.83
        sides.append(train)
    assert sides[0] == sides[1] == sides[2]


def test_rows_without_a_key_count(spark):
    df = spark.range(100).select(F.when(F.col("id") > 4, F.col("id")).alias("id"), "id")
    df = df.toDF("id", "n")
    assert first_by_hash(df, "id", 100).count() == 100
    assert len({r.n for r in first_by_hash(df, "id", 97).collect()}) == 97


def test_split_percent_and_seed(spark):
    df = spark.range(2000)
    assert split(df, "id", 100).filter("side = 'test'").count() == 0
    assert split(df, "id", 0).filter("side = 'train'").count() == 0
    a, b = ({r.id for r in split(df, "id", 50, s).filter("side='train'").collect()} for s in "ab")
    assert a != b


def test_content_key_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    keys = [r.k for r in df.select(content_key("x", "y").alias("k")).collect()]
    assert keys[0] == keys[2] != keys[1]


@pytest.fixture
def written(monkeypatch):
    """The candidate tables that a sample writes."""
    seen = []

    def record(df, name, *rest):
        seen.append(settle(df, name, *rest))
        return seen[-1]

    monkeypatch.setattr(sampling, "settle", record)
    return seen


def test_input_is_read_once(spark, written, tmp_path):
    """All but one reading is of the candidates, a few times n rows."""
    path = str(tmp_path / "rows")
    spark.range(0, 200_000, 1, 8).write.parquet(path)
    df = spark.read.parquet(path)
    sample = first_by_hash(df, "id", 1000, "s")
    assert ids(sample) == lowest_hashes(1000, 200_000, "s")
    assert len(written) == 1
    assert 1000 <= written[0].count() < 20 * 1000
    assert not any(path in name for name in sample.inputFiles())


def test_uneven_tasks_take_a_second_reading(spark, written):
    """One task has all rows: the bound it comes to is too low, the next is not."""
    rows = F.when(F.col("id") == 0, F.sequence(F.lit(0), F.lit(99_999))).otherwise(F.array().cast("array<int>"))
    df = spark.range(0, 32, 1, 32).select(F.explode(rows).alias("id"))
    assert ids(first_by_hash(df, "id", 2000, "u")) == lowest_hashes(2000, 100_000, "u")
    assert len(written) == 2 and written[1].count() < 3 * 2000
