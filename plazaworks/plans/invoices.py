"""Invoices due to customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, period_label
from ..operators.joins import attach
from ..operators.rules import classify_by_prefix

TAXPAYER_PREFIXES = {"RUC10": "^10", "RUC20": "^20"}  # fixed values


def taxpayer_type(c: str) -> Column:
    return classify_by_prefix(c, patterns=TAXPAYER_PREFIXES)


def requests_per_order(requests: DataFrame) -> DataFrame:
    """Number, span and newest case of the invoice requests of an order."""
    return requests.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.count_distinct("case_id").alias("n_requests"),
        F.max("case_id").alias("request_case"),
        F.min("created_at").cast("date").alias("request_from"),
        F.max("closed_at").cast("date").alias("request_to"),
    )


def invoice_compliance(orders: DataFrame, invoices: DataFrame, requests: DataFrame, as_of: str) -> DataFrame:
    """State and age of the invoice of each order, with its periods.

    orders: order_id, created_at, promised_at, company; invoices: order_id,
    invoiced_at; requests: order_id, case_id, created_at, closed_at.
    """
    c, today = F.col, as_date(as_of)
    sent = invoices.groupBy("order_id").agg(F.max("invoiced_at").cast("date").alias("invoice_date"))
    out = attach(attach(orders, sent, ["order_id"]), requests_per_order(requests), ["order_id"])
    end = F.coalesce(c("invoice_date"), c("request_to"), today)
    out = out.withColumns(
        {
            "document": F.when(c("company").isNull(), "Boleta").otherwise("Factura"),
            "invoice_state": F.when(c("invoice_date").isNull(), "Pendiente").otherwise("Enviado"),
            "invoice_days": F.datediff(end, c("promised_at")),
            "request_days": F.datediff(F.coalesce(c("request_to"), today), c("request_from")),
            "period_created": period_label("created_at"),
            "period_invoice": period_label("invoice_date"),
        }
    )
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    return out.withColumns(
        {
            "sent": flag(c("invoice_state") == "Enviado"),
            "pending": flag(c("invoice_state") == "Pendiente"),
            "receipt": flag(c("document") == "Boleta"),
            "invoice": flag(c("document") == "Factura"),
        }
    )


def invoice_alerts(report: DataFrame, as_of: str, max_age: int = 15) -> DataFrame:
    """Recent unsent invoices that are overdue, and open requests without an invoice."""
    c = F.col
    recent = c("invoice_date").isNull() & (F.datediff(as_date(as_of), c("created_at")) <= max_age) & (c("invoice_days") > 0)
    asked = c("request_case").isNotNull() & c("request_to").isNull() & (c("invoice_state") != "Enviado")
    return report.where(recent | asked)


def document_payload(docs: DataFrame, pairs: Sequence[tuple[str, str]], kind: str = "document", receipt: str = "Boleta") -> DataFrame:
    """Receipts take the customer's own data where invoices take the company's.

    ``pairs`` are (company column, customer column).
    """
    is_receipt = F.col(kind) == receipt
    return docs.withColumns({a: F.when(is_receipt, F.col(b)).otherwise(F.col(a)) for a, b in pairs})
