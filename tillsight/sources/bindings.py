"""The test tables seen as the canonical retail tables.

Money is DECIMAL(18,2): sums do not depend on the order in which tasks finish,
so a task that is run again after a failure gives the same result.

The test tables are clean. The ``raw_*`` frames put known defects into them, by
fixed expressions of the row's own key, over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONEY = "decimal(18,2)"
ORDER_CUTOFF = "2001-01-01"
EVENT_CUTOFF = "2024-01-21"
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


class Tables:
    """Lazily bound canonical tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str, money: str = MONEY):
        """``money='double'`` roughly halves the time of wide sums, but their last
        digits then depend on the order in which tasks finish."""
        self.spark, self.folder, self.money = spark, folder, money

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- clean ----------------------------------------------------------------------
    @property
    def header(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderkey") % 25).cast("int").alias("store_id"),
            F.col("o_orderdate").alias("transaction_date"),
            F.col("o_totalprice").cast(self.money).alias("total_amount"),
        )

    @property
    def purchases(self) -> DataFrame:
        """Events of type purchase as sales headers with a time of day."""
        return self.read("events").filter("event_type = 'purchase'").select(
            F.col("event_id").alias("transaction_id"),
            F.col("user_id").alias("customer_id"),
            (F.col("event_id") % 25).cast("int").alias("store_id"),
            F.col("ts").alias("transaction_date"),
            F.col("value").cast(self.money).alias("total_amount"),
        )

    @property
    def lines(self) -> DataFrame:
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_item_id"),
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_returnflag").alias("promotion_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").cast(self.money).alias("line_item_amount"),
        )

    @property
    def products(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_category"),
            F.col("p_retailprice").alias("unit_price"),
            F.col("p_size").alias("current_stock_level"),
        )

    @property
    def stores(self) -> DataFrame:
        region = self.read("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("store_region"))
        return self.read("nation").join(region, "n_regionkey").select(
            F.col("n_nationkey").alias("store_id"), F.col("n_name").alias("store_name"), "store_region"
        )

    @property
    def customers(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            loyalty(F.col("c_nationkey")).alias("loyalty_status"),
            F.col("c_acctbal").alias("total_loyalty_points"),
            F.col("c_mktsegment").alias("segment_id"),
            F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 3000).cast("int")).alias("customer_since"),
        )

    # -- with defects ------------------------------------------------------------------
    @property
    def raw_header(self) -> DataFrame:
        k, ts = F.col("o_orderkey"), F.col("o_orderdate")
        amount = F.col("o_totalprice")
        date = (
            F.when(k % 50 == 7, F.lit(None).cast("string"))
            .when(k % 50 == 11, "garbage")
            .when(k % 50 == 13, F.date_format(ts, "dd-MM-yyyy HH:mm"))
            .when(k % 50 == 17, F.date_format(ts, "yyyy/MM/dd"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        )
        return self.read("orders").select(
            k.alias("transaction_id"),
            F.when(k % 20 != 0, F.col("o_custkey")).alias("customer_id"),
            F.when(k % 33 != 1, (k % 25).cast("string")).alias("store_id"),
            date.alias("transaction_date"),
            F.when(k % 97 == 5, -amount).when(k % 41 != 3, amount).cast(self.money).alias("total_amount"),
        )

    @property
    def raw_lines(self) -> DataFrame:
        k, n, p, q = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity")
        mix = k + n
        return self.read("lineitem").select(
            (k * 10 + n).alias("line_item_id"),
            F.when(p % 83 == 0, F.lit(None).cast("bigint")).when(mix % 71 == 0, k + 1_000_000_000).otherwise(k).alias("transaction_id"),
            F.when(mix % 47 != 2, p).alias("product_id"),
            F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("promotion_id"),
            F.when(mix % 61 == 3, F.lit(0.0)).when(mix % 37 == 4, -q).when(mix % 53 != 5, q).alias("quantity"),
            F.when(mix % 43 != 6, F.col("l_extendedprice").cast(self.money)).alias("line_item_amount"),
        )

    @property
    def raw_products(self) -> DataFrame:
        k, price = F.col("p_partkey"), F.col("p_retailprice")
        category = (
            F.when(k % 50 == 3, F.lit(None).cast("string"))
            .when(k % 30 == 4, F.lower("p_type"))
            .when(k % 40 == 5, F.concat(F.col("p_type"), F.lit(" & co-op ")))
            .otherwise(F.col("p_type"))
        )
        return self.read("part").select(
            k.alias("product_id"),
            F.when(k % 20 != 6, F.col("p_name")).alias("product_name"),
            category.alias("product_category"),
            F.when(k % 33 == 7, F.lit(None).cast("double")).when(k % 50 == 8, -price).when(k % 70 == 9, price * 100).otherwise(price / 10).alias("unit_price"),
            F.when(k % 19 == 2, F.lit(None).cast("int")).when(k % 23 == 1, -F.col("p_size")).otherwise(F.col("p_size")).alias("current_stock_level"),
        )

    @property
    def raw_customers(self) -> DataFrame:
        k = F.col("c_custkey")
        name = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
        email = (
            F.when(k % 30 == 1, F.concat(name, F.lit("mail.com")))
            .when(k % 50 == 2, "N/A")
            .when(k % 20 == 3, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit(" "), name, F.lit("@mail.com")))
        )
        digits = F.lpad(k.cast("string"), 10, "5")
        phone = (
            F.when(k % 33 == 1, "12345")
            .when(k % 50 == 4, "unknown")
            .when(k % 12 == 5, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("("), F.substring(digits, 1, 3), F.lit(") "), F.substring(digits, 4, 7)))
        )
        since = F.date_add(F.lit("1994-01-01").cast("date"), (k % 3000).cast("int"))
        text = (
            F.when(k % 20 == 6, F.date_format(since, "dd/MM/yyyy"))
            .when(k % 20 == 7, F.date_format(since, "MM-dd-yyyy"))
            .when(k % 33 == 8, F.lit(None).cast("string"))
            .otherwise(F.date_format(since, "yyyy-MM-dd"))
        )
        tier = loyalty(F.col("c_nationkey"))
        return self.read("customer").select(
            k.alias("customer_id"),
            F.when(k % 25 != 9, F.col("c_name")).alias("first_name"),
            email.alias("email"),
            F.when(k % 15 == 2, F.lit(None).cast("string")).when(k % 15 == 3, F.concat(F.lower(tier), F.lit(" "))).otherwise(tier).alias("loyalty_status"),
            F.when(k % 18 != 4, F.col("c_acctbal")).alias("total_loyalty_points"),
            text.alias("last_purchase_date"),
            F.when(k % 22 != 5, F.col("c_mktsegment")).alias("segment_id"),
            phone.alias("customer_phone"),
            text.alias("customer_since"),
        )

    @property
    def raw_stores(self) -> DataFrame:
        """Suppliers as stores; the nation is the city."""
        k = F.col("s_suppkey")
        opened = F.date_add(F.lit("2001-01-01").cast("date"), (k % 5000).cast("int"))
        nation = self.read("nation").select("n_nationkey", "n_name", "n_regionkey")
        region = self.read("region")
        named = (
            self.read("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )
        text = (
            F.when(k % 20 == 1, F.date_format(opened, "yyyy/MM/dd"))
            .when(k % 20 == 2, "soon")
            .otherwise(F.date_format(opened, "yyyy-MM-dd"))
        )
        return named.select(
            k.alias("store_id"),
            F.when(k % 10 != 3, F.concat(F.col("n_name"), F.lit(" Store"))).alias("store_name"),
            F.when((k % 30 != 4) & (k % 30 != 13), F.col("n_name")).alias("store_city"),
            F.col("r_name").alias("store_region"),
            text.alias("opening_date"),
        )

    @property
    def raw_promotions(self) -> DataFrame:
        k = F.col("s_suppkey")
        start = F.date_add(F.lit("2000-01-01").cast("date"), (k % 700).cast("int"))
        discount = (
            F.when(k % 30 == 1, F.lit(1.295)).when(k % 40 == 2, F.lit(-0.1))
            .when(k % 25 == 3, F.lit(None).cast("double")).otherwise((k % 50) / 100)
        )
        return self.read("supplier").select(
            k.alias("promotion_id"),
            F.when(k % 20 != 4, F.col("s_name")).alias("promotion_name"),
            F.date_format(start, "yyyy-MM-dd").alias("start_date"),
            F.when(k % 15 != 5, F.date_format(F.date_add(start, 14), "dd/MM/yyyy")).alias("end_date"),
            discount.alias("discount_percentage"),
            F.when(k % 33 != 6, F.concat(F.lit("C"), F.col("s_nationkey").cast("string"))).alias("applicable_category"),
        )

    @property
    def raw_rules(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.read("supplier").select(
            k.alias("rule_id"),
            F.when(k % 6 != 5, F.col("s_name")).alias("rule_name"),
            F.when(k % 7 != 3, (k % 100).cast("int")).alias("bonus_points"),
        )


def loyalty(nation: Column) -> Column:
    tiers = F.array(*[F.lit(t) for t in ("Bronze", "Silver", "Gold", "Platinum")])
    return F.get(tiers, (nation % 4).cast("int"))
