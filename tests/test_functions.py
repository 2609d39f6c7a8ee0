import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfwatch.functions import urls
from shelfwatch.functions.calendar import day_start, next_point, partition_label, point_floor
from shelfwatch.functions.scalars import (
    exact_int, first_non_empty, integer_like, minor_to_major, normalise_text, repair_double_encoding,
    sku_bucket, sku_part, sku_volume,
)


@pytest.fixture
def c(spark):
    return F.col("x")


def one(spark, values, *columns, kind="string"):
    """Results in the order of the values."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    found = frame.orderBy("i").select(*columns).collect()
    return [tuple(r) if len(columns) > 1 else r[0] for r in found]


def test_grid(spark, c):
    times = ["2024-03-01 00:00:00", "2024-03-01 02:59:59", "2024-03-01 03:00:00", "2024-03-01 21:00:00", "2024-03-01 23:59:00"]
    x = c.cast("timestamp")
    text = lambda col: F.date_format(col, "ddHH")
    assert one(spark, times, text(point_floor(x)), text(next_point(x))) == [
        ("0100", "0103"), ("0100", "0103"), ("0103", "0106"), ("0121", "0200"), ("0121", "0200"),
    ]
    assert one(spark, times[1:2], text(day_start(x)), text(day_start(x, -1)), partition_label(x)) == [
        ("0100", "2900", "20240301")
    ]


def test_grid_in_another_zone(spark, c):
    """21:30 UTC is 00:30 of the next day in Moscow; a day of clock change still has its own midnight."""
    x = c.cast("timestamp")
    show = lambda col: F.date_format(col, "yyyy-MM-dd HH:mm")
    assert one(spark, ["2024-03-01 21:30:00"], show(point_floor(x, "Europe/Moscow")), show(next_point(x, "Europe/Moscow")),
               partition_label(x, "Europe/Moscow")) == [("2024-03-01 21:00", "2024-03-02 00:00", "20240302")]
    # Berlin, 31 March 2024: 01:00 UTC is 03:00 summer time, grid point 3; midnight was 23:00 UTC.
    assert one(spark, ["2024-03-31 01:10:00"], show(point_floor(x, "Europe/Berlin")), show(day_start(x, 0, "Europe/Berlin"))) == [
        ("2024-03-31 01:00", "2024-03-30 23:00")
    ]


def test_integer_like(spark, c):
    texts = ["", "12", "+5", "-7", " 12 ", "1.5", "99999999999", "2147483648", "red hat", "12\n"]
    assert one(spark, texts, integer_like(c)) == [False, True, True, True, False, False, False, False, False, False]


def test_exact_int(spark, c):
    assert one(spark, [12.0, 12.5, 3e9, -2147483648.0, 1000.0, None], exact_int(c), kind="double") == [
        12, None, None, -2147483648, 1000, None,
    ]
    assert one(spark, [32767.0, 32768.0], exact_int(c, "short"), kind="double") == [32767, None]


def test_minor_to_major(spark, c):
    assert one(spark, [199, 99, 0, -199], minor_to_major(c), kind="int") == [1, 0, 0, -1]


def test_sku_hosts(spark, c):
    bounds = [14399999, 14400000, 28800000, 43200000, 72000000, 100800000, 106200000, 111600000, 117000000, 131400000, 160199999, 160200000]
    assert one(spark, bounds, sku_bucket(c), kind="int") == [
        "01", "02", "03", "04", "05", "06", "07", "08", "09", "10", "10", "11",
    ]
    assert one(spark, [14400123], sku_volume(c), sku_part(c), kind="int") == [(144, 14400)]


def test_names(spark, c):
    frame = spark.createDataFrame([("", "X"), (None, "X"), ("T", "X"), ("", ""), (None, None)], "t string, s string")
    assert [r[0] for r in frame.select(first_non_empty(F.col("t"), F.col("s"))).collect()] == ["X", "X", "T", None, None]


def brute_repair(text):
    if "Ð" not in text:
        return text
    return bytes(ord(ch) & 0xFF for ch in text).decode("utf-8", "replace")


def test_repair(spark, c):
    good = "Склад Коледино №2"
    texts = [good.encode().decode("latin-1"), "Подольск".encode().decode("latin-1"), "North é", "plain", "Ð", "aÐ\x90Ð漢", "ÐÐ°"]
    assert one(spark, texts, repair_double_encoding(c)) == [brute_repair(t) for t in texts]
    assert brute_repair(texts[1]) == "Подольск"


def test_normalise(spark, c):
    assert one(spark, ["a\tb\nc\r\\d", None], normalise_text(c)) == ["abc\\d", None]


def test_urls(spark, c):
    assert one(spark, ["a *~ б"], urls.catalog_url(c)) == [
        "https://search.wb.ru/exactmatch/ru/common/v4/search?resultset=dummy&query=a+*%7E+%D0%B1"
    ]
    shards = ["presets/a", "brands/b", "merger7", "home"]
    found = one(spark, shards, urls.page_url(c, F.lit("cat=1"), F.lit(3)))
    assert [u.split("/")[2] for u in found] == ["search.wb.ru"] * 3 + ["catalog.wb.ru"]
    assert found[3] == "https://catalog.wb.ru/catalog/home/catalog?locale=ru&limit=300&cat=1&page=3"
    assert one(spark, [15000001], urls.product_image_url(c), urls.brand_image_url(c), urls.seller_image_url(c), kind="int") == [
        ("https://basket-02.wb.ru/vol150/part15000/15000001/images/big/1.jpg",
         "https://images.wbstatic.net/brands/small/15000001.jpg", "https://images.wbstatic.net/shops/15000001_logo.jpg")
    ]
    assert one(spark, [1], urls.stocks_url(F.array(c, c + 1)), kind="int")[0].endswith("&nm=1;2")
    kinds = spark.createDataFrame([("category", "t", "/catalog/x"), ("query", "a b", None)], "k string, t string, u string")
    assert rows(kinds.select(urls.queries_url(F.col("k"), F.col("t"), F.col("u")).substr(1, 80))) == [
        ("https://similar-queries.wildberries.ru/api/v2/search/query?query=a+b&regions=68,",),
        ("https://similar-queries.wildberries.ru/catalog?url=/catalog/x",),
    ]
