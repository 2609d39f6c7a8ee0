"""Request and image urls of the marketplace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.functions.scalars import sku_bucket, sku_part, sku_volume

# Url templates of the marketplace.
CATEGORIES_URL = "https://www.wildberries.ru/webapi/menu/main-menu-ru-ru.json"
CATALOG_URL = "https://search.wb.ru/exactmatch/ru/common/v4/search?resultset=dummy&query=%query%"
CATEGORY_PAGE_URL = "https://catalog.wb.ru/catalog/%shard%/catalog?locale=ru&limit=300&%query%&page=%page%"
QUERY_PAGE_URL = "https://search.wb.ru/%shard%/catalog?dest=-1029256,-2095259,-369838,-1784077&locale=ru&limit=300&%query%&page=%page%"
CATEGORY_QUERIES_URL = "https://similar-queries.wildberries.ru/catalog?url=%url%"
SIMILAR_QUERIES_URL = "https://similar-queries.wildberries.ru/api/v2/search/query?query=%query%&regions=68,64,83,4,38,80,33,70,82,86,30,69,1,48,22,66,31,40&locale=ru&lang=ru&dest=-1029256,-2095259,-369838,-1784077"
SELLER_URL = "https://basket-%basket%.wb.ru/vol%vol%/part%part%/%sku%/info/sellers.json"
STOCKS_URL = "https://card.wb.ru/cards/detail?spp=26&regions=80,64,83,4,38,33,70,82,69,68,86,30,40,48,1,22,66,31&pricemarginCoeff=1.0&reg=1&appType=1&emp=0&locale=ru&lang=ru&curr=rub&couponsGeo=12,7,3,18,21&sppFixGeo=4&dest=-1029256,-2095259,-369838,-1784077&nm=%skus%"
PRODUCT_IMAGE_URL = "https://basket-%basket%.wb.ru/vol%vol%/part%part%/%sku%/images/big/1.jpg"
BRAND_IMAGE_URL = "https://images.wbstatic.net/brands/small/%id%.jpg"
SELLER_IMAGE_URL = "https://images.wbstatic.net/shops/%id%_logo.jpg"
# Shard prefixes that are served by the search host.
SEARCH_SHARD_PREFIXES = ("presets/", "brands/", "merger")


def _fill(template: str, **parts: Column) -> Column:
    """Concatenate the literal pieces of a template with its parts; each part occurs once."""
    pieces: list[Column] = []
    for i, piece in enumerate(template.split("%")):
        if i % 2:
            pieces.append(parts[piece].cast("string"))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def catalog_url(text: Column) -> Column:
    return _fill(CATALOG_URL, query=F.url_encode(text))


def page_url(shard: Column, query: Column, page: Column) -> Column:
    searched = F.lit(False)
    for prefix in SEARCH_SHARD_PREFIXES:
        searched = searched | shard.startswith(prefix)
    return F.when(searched, _fill(QUERY_PAGE_URL, shard=shard, query=query, page=page)).otherwise(
        _fill(CATEGORY_PAGE_URL, shard=shard, query=query, page=page)
    )


def queries_url(kind: Column, text: Column, category_url: Column) -> Column:
    return F.when(kind == "category", _fill(CATEGORY_QUERIES_URL, url=category_url)).otherwise(
        _fill(SIMILAR_QUERIES_URL, query=F.url_encode(text))
    )


def _by_sku(template: str, sku: Column) -> Column:
    return _fill(template, basket=sku_bucket(sku), vol=sku_volume(sku), part=sku_part(sku), sku=sku)


def seller_url(sku: Column) -> Column:
    return _by_sku(SELLER_URL, sku)


def product_image_url(sku: Column) -> Column:
    return _by_sku(PRODUCT_IMAGE_URL, sku)


def brand_image_url(brand_id: Column) -> Column:
    return _fill(BRAND_IMAGE_URL, id=brand_id)


def seller_image_url(seller_id: Column) -> Column:
    return _fill(SELLER_IMAGE_URL, id=seller_id)


def stocks_url(skus: Column) -> Column:
    """``skus`` is an array; the request takes them joined with a semicolon."""
    return _fill(STOCKS_URL, skus=F.array_join(skus.cast("array<string>"), ";"))
