"""Top products per area from click actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.functions.columns import sorted_join
from clicklens.operators.joins import broadcast_bounded


def _mapping(column: str, mapping: dict[str, str] | None) -> Column:
    if not mapping:
        return F.lit(None).cast("string")
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, F.col(column))


def area_city_join(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks ``(city_id, product_id)`` with their city name and area (inner:
    clicks from unknown cities are dropped). The planner broadcasts the city
    dimension when its measured size allows."""
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id", "inner")


def area_product_clicks(area_clicks: DataFrame) -> DataFrame:
    """Per (area, product): click count and the sorted distinct
    ``city_id:city_name`` list of the cities the clicks came from. A
    ``click_count`` column in the input counts for that many clicks."""
    clicks = F.sum("click_count") if "click_count" in area_clicks.columns else F.count(F.lit(1))
    city = F.concat(F.col("city_id").cast("string"), F.lit(":"), F.col("city_name"))
    return area_clicks.groupBy("area", "product_id").agg(
        clicks.cast("bigint").alias("click_count"),
        sorted_join(F.collect_set(city)).alias("city_infos"),
    )


def top_products_per_area(per_product: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked products per area (ties by product id); the
    literal bound plans as a WindowGroupLimit before the shuffle."""
    w = Window.partitionBy("area").orderBy(F.desc("click_count"), F.asc("product_id"))
    return per_product.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")


def top_clicked(clicks: DataFrame, cities: DataFrame, n: int = 3) -> DataFrame:
    """Top products per area from raw clicks. They are counted per (city,
    product) before the city join and the city lists, so whoever reads the
    result twice shares that one shuffle of the log."""
    per_city = clicks.groupBy("city_id", "product_id").agg(F.count(F.lit(1)).alias("click_count"))
    return top_products_per_area(area_product_clicks(area_city_join(per_city, cities)), n)


def area_product_join(top: DataFrame, products: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Top rows with product name and status (left: unknown products keep
    NULLs).

    The product dimension is first cut to the top rows' ids with a semi join;
    with ``max_rows`` (a proven bound on the top rows) the ids are broadcast,
    else AQE decides by their measured size. The final join is between two
    small tables.
    """
    ids = broadcast_bounded(top.select("product_id"), max_rows)
    prods = products.select("product_id", "product_name", "product_status").join(ids, "product_id", "left_semi")
    return top.join(prods, "product_id", "left")


def area_top3_product(clicks: DataFrame, cities: DataFrame, products: DataFrame, task_id: int, n: int = 3,
                      area_levels: dict[str, str] | None = None,
                      status_text: dict[str, str] | None = None) -> DataFrame:
    """The ``area_top3_product`` rows: task, area, area level, product,
    city list, clicks, product name and status.

    ``area_levels`` maps an area to its level text (NULL when not given);
    ``status_text`` maps the raw status to a text (raw when not given).
    """
    joined = area_product_join(top_clicked(clicks, cities, n), products)
    status = F.col("product_status")
    if status_text:
        status = F.coalesce(_mapping("product_status", status_text), status)
    return joined.select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        "area",
        _mapping("area", area_levels).alias("area_level"),
        "product_id",
        "city_infos",
        "click_count",
        "product_name",
        status.alias("product_status"),
    )
