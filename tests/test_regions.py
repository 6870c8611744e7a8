import pytest

from footfall.operators import regions
from footfall.schemas import CITY_INFO, PRODUCT_INFO
from footfall.sources.tables import literal_table

CITIES = [(0, "North", "A"), (1, "South", "A"), (2, "West", "B")]


@pytest.fixture(scope="module")
def dims(spark):
    products = literal_table(spark, [(p, f"product{p}", "0") for p in range(1, 9)], PRODUCT_INFO)
    return products, literal_table(spark, CITIES, CITY_INFO)


def click(city, product, n):
    return [("s", i, {"city_id": city, "click_product_id": str(product)}) for i in range(n)]


def test_counts_and_city_list(actions, dims, rows):
    df = actions(click(0, 1, 2) + click(1, 1, 3) + click(2, 1, 1) + click(0, 99, 4) + click(7, 1, 5)
                 + [("s", 0, {"click_product_id": ""}), ("s", 0, {"click_product_id": None})])
    assert rows(regions.city_product_clicks(df)) == [(0, 1, 2), (0, 99, 4), (1, 1, 3), (2, 1, 1), (7, 1, 5)]
    assert rows(regions.area_product_counts(df, *dims)) == [("A", 1, 5, "|North:2|South:3"), ("B", 1, 1, "|West:1")]


def test_four_tied_first_are_all_kept(actions, dims, rows):
    df = actions([r for p in (1, 2, 3, 4) for r in click(0, p, 2)] + click(0, 5, 1) + click(2, 5, 1))
    top = rows(regions.area_top_products(df, *dims, task_id="t"))
    assert [r[1:4] for r in top] == [("A", p, 2) for p in (1, 2, 3, 4)] + [("B", 5, 1)]


def test_rank_then_gap(actions, dims, rows):
    df = actions(click(0, 1, 5) + click(0, 2, 4) + click(0, 3, 4) + click(0, 4, 3))
    assert [r[1] for r in rows(regions.area_top_products(df, *dims))] == [1, 2, 3]


def test_clicks_are_counted_before_the_joins(actions, dims):
    plan = regions.area_top_products(actions(click(0, 1, 1)), *dims)._jdf.queryExecution().optimizedPlan().toString()
    depth = {key: next(i for i, line in enumerate(plan.splitlines()) if key in line) for key in (
        "Join Inner", "Aggregate [city_id")}
    assert depth["Aggregate [city_id"] > depth["Join Inner"]   # below the join
