"""Area top-3 on hand rows: ties, unknown city, unknown product."""

from clicklens.operators import areas


def test_area_top3_ties_and_missing_dimensions(spark):
    clicks = spark.createDataFrame(
        [(1, 10), (1, 10), (2, 10), (1, 11), (2, 11), (1, 12), (2, 12), (1, 13), (1, 14), (2, 15), (99, 10)],
        "city_id long, product_id long",
    )
    cities = spark.createDataFrame([(1, "C1", "A"), (2, "C2", "A")], "city_id long, city_name string, area string")
    products = spark.createDataFrame([(10, "p10", "0"), (11, "p11", "1")],
                                     "product_id long, product_name string, product_status string")
    got = sorted(tuple(r) for r in areas.area_top3_product(clicks, cities, products, 5,
                                                           area_levels={"A": "first"}).collect())
    # 10 has 3 clicks (city 99 is unknown and dropped); 11 and 12 tie at 2, 13/14/15 at 1
    assert got == [
        (5, "A", "first", 10, "1:C1,2:C2", 3, "p10", "0"),
        (5, "A", "first", 11, "1:C1,2:C2", 2, "p11", "1"),
        (5, "A", "first", 12, "1:C1,2:C2", 2, None, None),
    ]
