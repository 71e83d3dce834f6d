"""Reading some keys of a collection: the same documents as from a full read, out of few files."""

import pytest
from pyspark.sql import functions as F

from docsink import Collection
from docsink.operators.effects import fold_bulks

RANGES = [
    {"keys": ["17"]},
    {"keys": ["17", "905", "nothing", "17"]},
    {"keys": []},
    {"low": "3", "high": "31"},
    {"low": "98"},
    {"high": "102"},
    {"low": "5", "high": "4"},
    {"keys": ["17", "50", "é", "ü"], "low": "4"},
]


@pytest.fixture
def files_of_ranges(spark):
    """Small tables would be written as one file."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def filled(spark, path, **more):
    collection = Collection(spark, str(path), **more)
    base = spark.range(1000).selectExpr("cast(id as string) as _key", "id as v")
    collection.create(base.unionAll(spark.sql("select 'é', -1L union all select 'z', -2L")))
    return collection


def changed(spark, collection, condition, doc="struct(id * 10 as v)"):
    changes = spark.range(1100).where(condition).selectExpr(
        "cast(id as string) as _key", "id as seq", "0L as bulk_id", "if(id % 5 = 0, '-D', if(id < 1000, '+U', '+I')) as op",
        f"{doc} as doc",
    )
    collection.append(fold_bulks(changes), changes.schema["doc"].dataType)


def expected(collection, keys=None, low=None, high=None):
    """The same out of a full read, comparing keys as bytes."""

    def wanted(key):
        inside = (low is None or low.encode() <= key.encode()) and (high is None or key.encode() <= high.encode())
        return inside and (keys is None or key in keys)

    return sorted((tuple(r) for r in collection.read().collect() if wanted(r["_key"])), key=str)


def read(collection, **asked):
    return sorted(map(tuple, collection.read(**asked).collect()), key=str)


@pytest.mark.parametrize("more", [{}, {"broadcast_limit": 0}, {"buckets": 4}, {"buckets": 4, "broadcast_limit": 0}])
def test_equals_the_full_read(spark, tmp_path, files_of_ranges, more):
    collection = filled(spark, tmp_path, **more)
    for asked in RANGES[:3]:
        assert read(collection, **asked) == expected(collection, **asked)
    changed(spark, collection, "id % 7 = 0")
    changed(spark, collection, "id between 900 and 1050")
    changed(spark, collection, "id = 17", doc="struct(id as v, 'x' as w)")
    for asked in RANGES:
        assert collection.read(**asked).columns == collection.read().columns
        assert read(collection, **asked) == expected(collection, **asked)


def test_only_matching_files_are_read(spark, tmp_path, files_of_ranges):
    collection = filled(spark, tmp_path)
    everything = [f for f in collection.read().inputFiles() if "/base/" in f]
    assert len(everything) == 8
    changed(spark, collection, "id between 200 and 299")

    def files(folder, **asked):
        return [f for f in collection.read(**asked).inputFiles() if f"/{folder}/" in f]

    assert len(files("base", keys=["17"])) == 1
    assert len(files("base", keys=["17", "950"])) == 2
    assert len(files("base", low="3", high="31")) <= 2
    assert len(files("base", keys=["!"])) == 0
    # The second entry has nothing to say about other keys.
    changed(spark, collection, "id between 300 and 310")
    assert all("commit=2" in f for f in files("log", keys=["250"]))
    assert all("commit=3" in f for f in files("log", low="301", high="303"))


def test_key_ranges_of_files_are_disjoint(spark, tmp_path, files_of_ranges):
    collection = filled(spark, tmp_path)
    changed(spark, collection, "id % 3 = 0")
    collection.compact()
    version = collection.manifest().base_version
    index = spark.read.parquet(f"{tmp_path}/index/version={version}").orderBy("low").collect()
    assert len(index) == 8
    assert all(one.high.encode() < two.low.encode() for one, two in zip(index, index[1:], strict=False))
    assert sum(r.rows for r in index) == collection.read().count()
    collection.vacuum(keep=1)
    assert read(collection, keys=["17"]) == expected(collection, keys=["17"])


def test_a_plain_condition_reaches_the_scan(spark, tmp_path, files_of_ranges):
    """With a log that is broadcast."""
    collection = filled(spark, tmp_path)
    changed(spark, collection, "id % 7 = 0")
    found = collection.read().where(F.col("_key") == "14")
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "commit#" not in line]
    assert len(scans) == 2 and all("EqualTo(_key,14)" in line for line in scans)
    assert [tuple(r) for r in found.collect()] == [("14", 140)]
