"""Accept or reject sales rows: one pass, first failing rule wins.

The router only adds a nullable ``rejection_reason`` column. Splitting is two
filters on that column, so every input row ends up in exactly one output, and
the rejects keep their raw values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.columns import parse_date, timestamp_text
from tillsight.operators.cleaning import UNKNOWN_STORE

REASON = "rejection_reason"

# Reject reasons, in the order the rules are tried ---------------------
HEADER_REASONS = {
    "no_customer": "Missing customer_id - cannot attribute transaction",
    "bad_date": "Invalid transaction date",
    "negative": "Negative total amount",
    "no_amount": "Missing total amount",
}
LINE_REASONS = {
    "no_transaction": "Missing transaction_id",
    "orphan": "Transaction was rejected",
    "zero": "Zero quantity",
    "negative": "Negative quantity (possible return)",
    "no_quantity": "Missing quantity",
    "no_product": "Missing product_id",
}
# End of fixed values ------------------------------------------------------------------


def first_reason(rules: list[tuple[Column, str]]) -> Column:
    """Reason of the first rule that holds, null if none does."""
    out = None
    for failed, reason in rules:
        out = F.when(failed, reason) if out is None else out.when(failed, reason)
    return out


def tag_header(header: DataFrame) -> DataFrame:
    """Raw header plus ``parsed_date`` and ``rejection_reason``."""
    out = header.withColumn("parsed_date", parse_date("transaction_date"))
    rules = [
        (F.col("customer_id").isNull(), HEADER_REASONS["no_customer"]),
        (F.col("parsed_date").isNull(), HEADER_REASONS["bad_date"]),
        (F.col("total_amount") < 0, HEADER_REASONS["negative"]),
        (F.col("total_amount").isNull(), HEADER_REASONS["no_amount"]),
    ]
    return out.withColumn(REASON, first_reason(rules))


def accepted_header(tagged: DataFrame, as_text: bool = False) -> DataFrame:
    """Accepted rows with typed (or formatted) date and a default store."""
    date = timestamp_text("parsed_date") if as_text else F.col("parsed_date")
    return (
        tagged.filter(F.col(REASON).isNull())
        .withColumn("transaction_date", date)
        .withColumn("store_id", F.coalesce(F.col("store_id").cast("string"), F.lit(UNKNOWN_STORE)))
        .drop("parsed_date", REASON)
    )


def rejected(tagged: DataFrame) -> DataFrame:
    """Rejected rows with their raw values and the reason."""
    return tagged.filter(F.col(REASON).isNotNull()).drop("parsed_date", "_accepted")


def tag_lines(lines: DataFrame, accepted: DataFrame) -> DataFrame:
    """Raw lines plus ``rejection_reason``; a line of a rejected or unknown
    transaction is an orphan.

    Lines without a transaction id are kept out of the join: as one hot null key
    they would all be hashed to one task.
    """
    known = accepted.select("transaction_id", F.lit(True).alias("_accepted")).distinct()
    with_id = lines.filter(F.col("transaction_id").isNotNull()).join(known, "transaction_id", "left")
    without = lines.filter(F.col("transaction_id").isNull()).withColumn("_accepted", F.lit(None).cast("boolean"))
    return tag_matched(with_id.select(*lines.columns, "_accepted").unionByName(without))


def tag_matched(lines: DataFrame) -> DataFrame:
    """The reasons of lines whose ``_accepted`` tells whether their transaction was accepted (else null)."""
    rules = [
        (F.col("transaction_id").isNull(), LINE_REASONS["no_transaction"]),
        (F.col("_accepted").isNull(), LINE_REASONS["orphan"]),
        (F.col("quantity") == 0, LINE_REASONS["zero"]),
        (F.col("quantity") < 0, LINE_REASONS["negative"]),
        (F.col("quantity").isNull(), LINE_REASONS["no_quantity"]),
        (F.col("product_id").isNull(), LINE_REASONS["no_product"]),
    ]
    return lines.withColumn(REASON, first_reason(rules))


def accepted_lines(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON, "_accepted")


def orphan_lines(lines: DataFrame, accepted: DataFrame) -> DataFrame:
    """Lines with a transaction id that the accepted header does not have."""
    has_id = lines.filter(F.col("transaction_id").isNotNull())
    return has_id.join(accepted.select("transaction_id"), "transaction_id", "left_anti")


def matched_lines(lines: DataFrame, accepted: DataFrame) -> DataFrame:
    return lines.join(accepted.select("transaction_id"), "transaction_id", "left_semi")
