"""Tax documents and manual adjustments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.numbers import round_half_even
from ..functions.text import split_document, strip_float_tail
from ..functions.sem import safe_cast
from ..operators.aggregates import threshold_groups
from ..operators.joins import attach
from ..operators.keys import latest_per_key
from ..operators.quality import sequence_gaps
from ..operators.rules import classify, classify_by_prefix
from ..operators.windows import natural_block, with_sequence
from ..sources.sinks import fixed_width, money_digits


def numbered_documents(docs: DataFrame, folio: str = "folio", series: Sequence[str] = ("F001",)) -> DataFrame:
    """Series and number of stamped documents of the listed series."""
    s, n = split_document(folio)
    stamped = docs.where(F.col(folio).isNotNull() & ~F.col(folio).rlike("^0120"))
    return stamped.withColumns({"series": s, "number": safe_cast(strip_float_tail(n), "bigint")}).where(F.col("series").isin(list(series)))


def sequence_gap_audit(docs: DataFrame, ledger: DataFrame, folio: str = "folio", series: Sequence[str] = ("F001",), width: int = 1_000_000) -> DataFrame:
    """Missing documents of each series, filled in from a second ledger.

    ledger: the folio column and whatever describes a document.
    """
    gaps = sequence_gaps(numbered_documents(docs, folio, series), ["series"], "number", width)
    rows = gaps.withColumn(folio, F.concat_ws("-", "series", F.col("number").cast("string")))
    others = [F.asc(c) for c in ledger.columns if c != folio]
    return attach(rows, latest_per_key(ledger, [folio], others), [folio])


def withholding(docs: DataFrame, concepts: DataFrame, minimum: float = vocab.WITHHOLDING_MINIMUM, first_party: Sequence[str] = ()) -> DataFrame:
    """Withholding per document of payers who reach the minimum in a period.

    docs: period, payer, doc, description, total; concepts: concept, code, rate.
    The highest rate of a document applies to its largest total, rounded to
    whole units; of codes with that rate the smallest is named.  Payers in
    ``first_party`` are left out.
    """
    kind = classify_by_prefix("payer", {"1P": list(first_party)}, default="3P") if first_party else F.lit("3P")
    rows = docs.where(kind == "3P").withColumn("concept", classify(F.lower("description"), vocab.WITHHOLDING_CONCEPTS, vocab.WITHHOLDING_OTHER))
    # the smallest code that comes with the highest rate of the document
    first = F.struct((-F.col("rate")).alias("lowered"), F.col("code").isNull().alias("bare"), "code")
    # rows name a handful of concepts, so they read theirs from a map: a join would deal all rows by those few names
    named = [label for _, label in vocab.WITHHOLDING_CONCEPTS] + [vocab.WITHHOLDING_OTHER]
    known = concepts.where(F.col("concept").isin(named) & F.col("rate").isNotNull()).groupBy("concept").agg(F.min(first).alias("_f"))
    codes = known.agg(F.map_from_entries(F.collect_list(F.struct("concept", "_f")))).scalar()
    # one pass over the rows gives what the payers' totals, the largest amounts and the codes are made of
    parts = rows.groupBy("period", "payer", "doc").agg(F.max("total").alias("total"), F.min(F.try_element_at(codes, F.col("concept"))).alias("_b"))
    liable = threshold_groups(parts.drop("_b"), ["period", "payer"], "total", minimum)
    best = parts.groupBy("doc").agg(F.min("_b").alias("_b"))
    out = attach(liable, best.select("doc", "_b.code", (-F.col("_b.lowered")).alias("rate")), ["doc"])
    return out.withColumn("withheld", round_half_even(F.col("total") * F.col("rate"), 0))


def validate_adjustments(requests: DataFrame, transactions: DataFrame, compat_id_check: bool = False) -> DataFrame:
    """Checks of an adjustment file, one 'Si'/'No' column each ('Si' is good).

    requests: request_id, order_id, sku, item_id, group, seller_id, amount;
    transactions: order_id, sku, line_id, seller_id, kind, amount, returned,
    adjusted.  ``check_pair``: the item has exactly one debit and one credit;
    ``check_return`` and ``check_adjustment``: no earlier return or adjustment;
    ``check_share`` and ``check_amount``: under 75 % of the commission and under
    1000; ``check_seller`` and ``check_seller_id``: the seller sold the order and
    the id is well formed (``compat_id_check`` accepts any id, as the old check
    did).
    """
    c = F.col
    yes = lambda cond: F.when(cond, "Si").otherwise("No")
    debit, credit = "Commission Adjustment", "Commission Credit Adjustment"
    pairs = requests.groupBy("order_id", "item_id").agg(
        F.count(F.when(c("group") == debit, 1)).alias("_debit"), F.count(F.when(c("group") == credit, 1)).alias("_credit")
    )
    history = transactions.groupBy("order_id").agg(
        F.count(F.when((c("returned") == "Si") & c("kind").isin("COMMISSION", "COMMISSION_CREDIT"), 1)).alias("_returned"),
        F.count_distinct(F.when(c("adjusted") == "Si", c("line_id"))).alias("_adjusted"),
        F.min("seller_id").alias("_seller"),
    )
    # k-th request of an order, sku and group takes the k-th order line
    lines = transactions.select("order_id", "sku", "line_id").distinct()
    asked = with_line(requests, lines)
    fees = transactions.where(c("kind") == "COMMISSION").groupBy("line_id").agg(F.max("amount").alias("_fee"))
    out = attach(asked, pairs, ["order_id", "item_id"])
    out = attach(attach(out, history, ["order_id"]), fees, ["line_id"])
    formed = c("seller_id").isNotNull() if compat_id_check else c("seller_id").rlike("^SC") & (F.length("seller_id") == 7)
    return out.withColumns(
        {
            "check_pair": yes((c("_debit") == 1) & (c("_credit") == 1)),
            "check_return": F.when(c("_returned") > 0, "No").otherwise("Si"),
            "check_adjustment": F.when(c("_adjusted") > 0, "No").otherwise("Si"),
            "check_seller_id": yes(formed),
            "check_seller": yes(c("seller_id") == F.coalesce("_seller", "seller_id")),
            "check_share": yes(F.try_divide(c("amount"), c("_fee")) < 0.75),
            "check_amount": yes(c("amount") < 1000),
        }
    ).drop("_debit", "_credit", "_returned", "_adjusted", "_seller", "_fee")


def with_line(requests: DataFrame, lines: DataFrame) -> DataFrame:
    """Order line of each request by position within (order, sku)."""
    ask, offer = natural_block(requests, "request_id"), natural_block(lines, "line_id")
    asked = with_sequence(requests, ["order_id", "sku", "group"], ["request_id"], "position", ask)
    offered = with_sequence(lines, ["order_id", "sku"], ["line_id"], "position", offer)
    return asked.join(offered, ["order_id", "sku", "position"], "left")


def withholding_lines(payments: DataFrame, company: str, batch: str, account: str) -> tuple[DataFrame, DataFrame]:
    """Header and detail records of the deposit file.

    payments: ordinal, doc_type, doc_number, proforma, service, amount,
    operation, period, voucher_type, series, number.  Fixed widths, zero padded.
    """
    details = payments.select(
        fixed_width(
            ("doc_type", None), ("doc_number", 11), (F.lit("0000000"), None), ("proforma", None), ("service", None), (F.lit(account), None),
            (money_digits("amount", 15), None), ("operation", None), ("period", None), ("voucher_type", None), ("series", None), ("number", 8),
        ).alias("line"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )
    total = payments.agg(F.sum(F.col("amount").cast("decimal(20,2)")).alias("amount"))
    header = total.select(F.concat(F.lit("P" + company + batch), money_digits("amount", 15)).alias("line"))
    return header, details
