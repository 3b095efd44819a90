"""Raw tables to clean tables, rejects and audits."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillsight.operators import cleaning as c
from tillsight.operators import routing as r
from tillsight.sources.files import write_clean, write_rejects
from tillsight.session import cut_lineage


@dataclass
class CleanResult:
    clean: dict[str, DataFrame]
    tagged: dict[str, DataFrame]
    audits: dict[str, DataFrame]

    def write(self, folder: str, fmt: str = "parquet") -> None:
        write_clean(self.clean, folder, fmt)
        write_rejects({**self.tagged, **self.audits}, folder, fmt)


def clean_all(raw: Mapping[str, DataFrame], materialise: bool = False) -> CleanResult:
    """The whole cleaning job as lazy plans.

    Order matters twice: accepted headers decide which lines are orphans, and
    clean product prices fill missing line amounts. ``materialise`` writes
    down the two tagged sales tables, which feed both the clean and the reject output.
    """
    keep = cut_lineage if materialise else (lambda df: df)
    products = c.clean_products(raw["products"])
    header = keep(r.tag_header(raw["store_sales_header"]))
    accepted = r.accepted_header(header)
    lines = keep(r.tag_lines(raw["store_sales_line_items"], accepted))
    clean = {
        "stores": c.clean_stores(raw["stores"]),
        "products": products,
        "customer_details": c.clean_customers(raw["customer_details"]),
        "promotion_details": c.clean_promotions(raw["promotion_details"]),
        "loyalty_rules": c.clean_rules(raw["loyalty_rules"]),
        "store_sales_header": c.flag_header_outliers(accepted),
        "store_sales_line_items": c.impute_line_amount(r.accepted_lines(lines), products),
    }
    audits = {
        "products": c.audit_products(raw["products"]),
        "promotions": c.audit_promotions(raw["promotion_details"]),
    }
    return CleanResult(clean, {"store_sales_header": header, "store_sales_line_items": lines}, audits)
