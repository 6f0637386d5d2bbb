"""Every answer with the tables it reads, under the name of its result folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from salesloom.plans import customers, pairs, products, regions, suppliers
from salesloom.plans.sold import sold_offers

# What the ``sold`` base is made from.
SOLD_FROM = ("partsupp", "lineitem")


@dataclass(frozen=True)
class Answer:
    """``build`` takes the named tables; ``sold`` stands for the base made of two of them.

    An answer whose ``build`` also takes ``per_part`` has here how that is made,
    and from which tables.
    """

    build: Callable[..., DataFrame]
    tables: tuple[str, ...]
    per_part: Callable[..., DataFrame] | None = None
    per_part_from: tuple[str, ...] = ()

    @property
    def reads(self) -> tuple[str, ...]:
        """The staged tables behind it."""
        named = [name for name in self.tables if name != "sold"]
        return tuple({*named, *SOLD_FROM} if "sold" in self.tables else named)

    @property
    def meets_orders(self) -> bool:
        """Whether lines meet their orders, which takes a shuffle as large as the lines."""
        return {"lineitem", "orders"} <= set(self.tables)

    def __call__(self, tables: Mapping[str, DataFrame], **options) -> DataFrame:
        """The answer over tables by name; a ``sold`` base given as option is used as it is."""
        named = {name: tables[name] for name in self.tables if name not in (*options, "sold")}
        if "sold" in self.tables and "sold" not in options:
            named["sold"] = sold_offers(*[tables[name] for name in SOLD_FROM])
        return self.build(**named, **options)


ANSWERS: dict[str, Answer] = {
    "q01_most_profit_prods": Answer(products.most_profit_prods, ("part", "sold")),
    "q02_sales_per_by_region": Answer(
        regions.sales_per_by_region, ("region", "nation", "customer", "orders", "lineitem")
    ),
    "q03_delay_ords_pct_by_cust": Answer(
        customers.delay_ords_pct_by_cust, ("customer", "orders", "lineitem")
    ),
    "q04_top_supp_by_prod_cat": Answer(
        suppliers.top_supp_by_prod_cat, ("part", "supplier", "sold")
    ),
    "q05_disc_on_sales": Answer(products.disc_on_sales, ("part", "sold")),
    "q06_cust_behavior": Answer(customers.cust_behavior, ("customer", "orders")),
    "q07_effect_mkt_campaigns": Answer(
        products.effect_mkt_campaigns,
        ("part", "partsupp", "lineitem", "orders", "customer"),
        products.campaign_revenue,
        ("partsupp", "lineitem", "orders", "customer"),
    ),
    "q08_most_profit_pairs": Answer(pairs.most_profit_pairs, ("lineitem", "part")),
    "q09_sale_lead_time": Answer(suppliers.sale_lead_time, ("supplier", "lineitem", "orders")),
    "q10_chg_supp_perf": Answer(suppliers.chg_supp_perf, ("supplier", "lineitem")),
}
