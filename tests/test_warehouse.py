import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from shelfwatch.sources.warehouse import Warehouse, part_of, time_of
from shelfwatch.tables import TABLES


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def named(spark, ts, *entries):
    return spark.createDataFrame([(ts, k, n) for k, n in entries], TABLES["warehouses"].staging)


def stock(spark, *entries):
    return spark.createDataFrame([(t, k, "M", 1, q) for t, k, q in entries], TABLES["stocks"].staging)


def test_part_labels():
    assert part_of(at(1, 3)) == "20240301/030000" and time_of("20240301/030000") == at(1, 3)


def test_dictionary_upsert(spark, warehouse):
    assert warehouse.read("warehouses").isEmpty()
    warehouse.upsert_dictionary("warehouses", named(spark, at(1), (1, "A"), (2, "B"), (2, None)))
    warehouse.upsert_dictionary("warehouses", named(spark, at(2), (2, None), (3, None), (3, "C")))
    found = warehouse.read("warehouses").select("wb_id", "name", F.date_format("last_timestamp", "dd"))
    # Known key refreshed (by null too), new key inserted, the other one as it was.
    assert rows(found) == [(1, "A", "01"), (2, None, "02"), (3, "C", "02")]
    warehouse.upsert_dictionary("warehouses", named(spark, at(2), (2, None), (3, None), (3, "C")))
    assert rows(warehouse.read("warehouses").select("wb_id", "name", F.date_format("last_timestamp", "dd"))) == rows(found)


def test_history_upsert_touches_its_snapshots_only(spark, warehouse):
    warehouse.upsert_history("stocks", stock(spark, (at(1), 1, 5), (at(1), 2, 6)), [at(1)])
    warehouse.upsert_history("stocks", stock(spark, (at(1, 3), 1, 4)), [at(1, 3)])
    first = warehouse.at("stocks", at(1, 3)).inputFiles()
    warehouse.upsert_history("stocks", stock(spark, (at(1), 2, 9), (at(1), 3, 1)), [at(1)])
    assert rows(warehouse.at("stocks", at(1)), "product_sku", "quantity") == [(1, 5), (2, 9), (3, 1)]
    assert warehouse.at("stocks", at(1, 3)).inputFiles() == first
    assert warehouse.snapshot_times("stocks") == [at(1), at(1, 3)]
    with pytest.raises(ValueError, match="unexpected"):
        warehouse.upsert_history("stocks", stock(spark, (at(2), 1, 1)), [at(1)])
    assert warehouse.snapshot_times("stocks") == [at(1), at(1, 3)]


def test_replace_reads_what_it_replaces(spark, warehouse):
    warehouse.upsert_history("stocks", stock(spark, (at(1), 1, 5), (at(1, 3), 1, 6)), [at(1), at(1, 3)])
    doubled = warehouse.read("stocks").withColumn("quantity", F.col("quantity") * 2).where("quantity = 10")
    warehouse.replace_history("stocks", doubled, [at(1), at(1, 3)])
    assert rows(warehouse.read("stocks"), "quantity") == [(10,)]
    assert warehouse.snapshot_times("stocks") == [at(1)]


def test_readers_keep_their_version_until_vacuum(spark, warehouse):
    warehouse.upsert_history("stocks", stock(spark, (at(1), 1, 5), (at(1, 3), 1, 6)), [at(1), at(1, 3)])
    before = warehouse.read("stocks")
    warehouse.drop_history("stocks", lambda t: t == at(1))
    warehouse.vacuum()
    assert rows(before, "quantity") == [(5,), (6,)]
    warehouse.vacuum(keep_hours=0)
    assert rows(warehouse.read("stocks"), "quantity") == [(6,)]
    day = f"{warehouse.root}/stocks/data/rev=1/day=20240301"
    assert warehouse.files.names(day) == ["point=030000"]


def test_second_writer_fails(spark, warehouse):
    warehouse.upsert_dictionary("warehouses", named(spark, at(1), (1, "A")))
    with pytest.raises(RuntimeError, match="another job"):
        warehouse._switch("warehouses", 1, {})
    assert rows(warehouse.read("warehouses"), "name") == [("A",)]


def test_pair_scan_reads_two_snapshots(spark, warehouse):
    times = [at(1, h) for h in (0, 3, 6, 9)]
    warehouse.upsert_history("stocks", stock(spark, *[(t, 1, i) for i, t in enumerate(times)]), times)
    files = warehouse.at("stocks", times[1], times[2]).inputFiles()
    assert {f.split("point=")[1][:6] for f in files} == {"030000", "060000"}
