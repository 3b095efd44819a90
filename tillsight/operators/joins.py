"""Row-level lookups of the sales tables.

No side is forced to broadcast: product, store and customer tables can grow.
Spark broadcasts them when their measured size is below the session's limit and
otherwise shuffles, where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lines_with_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    return lines.join(products.select("product_id", "product_category"), "product_id", "left")


def header_with_lines(header: DataFrame, lines: DataFrame) -> DataFrame:
    """Left join: transactions without lines stay, with null line columns.

    Written as an inner join plus the headers without lines. Adaptive execution
    can split a skewed partition of lines in an inner join, but not on the optional
    side of an outer join. The line ids are folded to distinct ones for the second
    part, so a transaction with very many lines is one row there.

    Headers and line ids, of which there are fewer, are hashed and the other side streams past
    them: sorts of both sides took a task several times the memory.
    """
    with_lines = header.hint("shuffle_hash").join(lines, "transaction_id")
    ids = lines.select("transaction_id").distinct()
    without = header.join(ids.hint("shuffle_hash"), "transaction_id", "left_anti")
    return with_lines.unionByName(without, allowMissingColumns=True)


def lines_of_header(lines: DataFrame, header: DataFrame) -> DataFrame:
    """Inner join: only lines of the given headers, with their customer."""
    return lines.join(header.select("transaction_id", "customer_id"), "transaction_id")


def header_with_region(header: DataFrame, stores: DataFrame) -> DataFrame:
    return header.join(stores.select("store_id", "store_region"), "store_id", "left")


def sales_with_tier(header: DataFrame, customers: DataFrame, columns: tuple[str, ...] = ("loyalty_status",)) -> DataFrame:
    return header.join(customers.select("customer_id", *columns), "customer_id")


def with_attributes(features: DataFrame, attributes: DataFrame) -> DataFrame:
    return features.join(attributes, "customer_id", "left")


def with_target(features: DataFrame, target: DataFrame, columns: tuple[str, ...] = ("future_spend_30d",)) -> DataFrame:
    """Left join of the target; customers without future sales get 0."""
    out = features.join(target.select("customer_id", *columns), "customer_id", "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out
