"""The lines meet two numbers per part, of a size known before the join."""

import datetime

from helpers import rows
from rebasket.plans import retail


def test_part_names_are_stored_before_the_lines_join_them(spark, monkeypatch):
    kept = {}

    def noted(frame, name):
        kept[name] = stored(frame, name)
        return kept[name]

    stored = retail.stored
    monkeypatch.setattr(retail, "stored", noted)
    part = spark.createDataFrame([(1, "red nut"), (2, "blue nut"), (3, "red nut"), (None, "blue nut"), (4, None)], "p_partkey long, p_name string")
    lines = spark.createDataFrame([(1, 1, 1), (1, 3, 2), (1, 2, 3), (2, 1, 1), (2, 4, 2), (2, None, 3)], "l_orderkey long, l_partkey long, l_linenumber int")
    day = datetime.datetime(2024, 1, 1)
    raw = spark.createDataFrame([(1, 7, day), (2, 7, day + datetime.timedelta(1))], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    products = retail.derive_products(part)
    number = {r.product_name: r.product_id for r in products.collect()}
    found = retail.derive_order_products(lines, part, products, retail.derive_orders(raw))
    red, blue = number["red nut"], number["blue nut"]
    assert rows(found, "order_id", "product_id", "add_to_cart_order", "reordered") == [(1, *x) for x in sorted([(red, 1, 0), (blue, 2, 0)])] + [(2, red, 1, 1)]
    assert kept["part-names"].columns == ["p_partkey", "product_id"]
