"""Accounting balance of an order line: charged and returned against paid and discounted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.dates import as_date
from ..functions.numbers import cap, cap_outflow, money_from_cents, whole_units
from ..operators.aggregates import ledger_columns, sum_when
from ..operators.joins import attach
from ..operators.rules import case_first

LINE = ["seller_id", "order_id", "sku"]


def collected(events: DataFrame, refunds: DataFrame | None = None) -> DataFrame:
    """Income and outflow per order line.

    events: seller_id, order_id, sku, event, event_status, event_date, total;
    refunds (order_id, sku, refund_amount, refund_date) stand in where no
    outflow was booked.  Income is at least the outflow.
    """
    c = F.col
    paid = c("event").isin(*vocab.INCOME_EVENTS[0]) & c("event_status").isin(*vocab.INCOME_EVENTS[1])
    undone = c("event").isin(*vocab.OUTFLOW_EVENTS[0]) & c("event_status").isin(*vocab.OUTFLOW_EVENTS[1])
    out = events.groupBy(*LINE).agg(
        sum_when(paid, "total").alias("ingreso"),
        F.sum(F.when(undone, c("total"))).alias("egreso"),
        F.max(F.when(paid, c("event_date"))).cast("date").alias("fecha_ingreso"),
        F.max(F.when(undone, c("event_date"))).cast("date").alias("fecha_egreso"),
    )
    if refunds is not None:
        side = refunds.groupBy("order_id", "sku").agg(F.max("refund_amount").alias("_ra"), F.max("refund_date").alias("_rd"))
        out = attach(out, side, ["order_id", "sku"]).withColumns(
            {
                "egreso": F.when(c("egreso").isNull() | (c("egreso") == 0), c("_ra")).otherwise(c("egreso")),
                "fecha_egreso": F.coalesce("fecha_egreso", "_rd"),
            }
        ).drop("_ra", "_rd")
    out = out.withColumn("egreso", F.coalesce(-F.abs("egreso"), F.lit(0)))
    return out.withColumn("ingreso", F.greatest(c("ingreso"), -c("egreso")))


def settlement_amount(settlements: DataFrame) -> DataFrame:
    """``total`` from integer cents and their fraction."""
    return settlements.withColumn("total", money_from_cents("net_amount_cent", "net_amount_fraction"))


def settled(settlements: DataFrame, outside: DataFrame | None = None, charges=vocab.LEDGER_CHARGES) -> DataFrame:
    """Payment, discount, adjustment and every charge per order line, in one pass.

    settlements: LINE, transaction_type, event_date, total, commission;
    outside (order_id, sku, discount) overrides the booked discount.
    """
    kind = F.col("transaction_type")
    # the flexible delivery's charge has the marketplace's name before it
    plain = F.regexp_replace(kind, "^[A-Z]+_(FLEX(?:_CREDIT)?)$", "$1").alias("transaction_type")
    rows = settlements.select(*LINE, plain, "event_date", "total", "commission").distinct()
    at = lambda kinds: F.max(F.when(kind.isin(*kinds), F.col("event_date"))).cast("date")
    core = rows.groupBy(*LINE).agg(
        F.max("commission").alias("comision"),
        sum_when(kind.isin(*vocab.LEDGER_PAYMENT), "total").alias("pago"),
        F.sum(F.when(kind.isin(*vocab.LEDGER_DISCOUNT), F.col("total"))).alias("descuento"),
        sum_when(kind.isin(*vocab.LEDGER_ADJUSTMENT), "total").alias("ajuste"),
        at(vocab.LEDGER_PAYMENT).alias("fecha_pago"),
        at(vocab.LEDGER_DISCOUNT).alias("fecha_descuento"),
        at(("APPEALED_RETURN_CREDIT", "LOST_OR_DAMAGED_ORDER_ITEM_LEVEL_CREDIT")).alias("fecha_ajuste"),
        *ledger_columns("transaction_type", "total", charges or {}),
    ).withColumn("descuento", -F.col("descuento"))
    if outside is not None:
        side = outside.groupBy("order_id", "sku").agg(F.max("discount").alias("_d"))
        core = attach(core, side, ["order_id", "sku"]).withColumn("descuento", F.coalesce("_d", "descuento")).drop("_d")
    return core.withColumn("descuento", F.coalesce("descuento", F.lit(0)))


def order_values(items: DataFrame, mode: str = "sum") -> DataFrame:
    """Items and value per (order, sku).

    ``mode='sum'`` adds the paid prices; ``'items_times_sum'`` multiplies that
    by the item count, as two older reports do (it overstates).
    """
    rows = items.select("order_id", "item_id", "sku", "paid_price").distinct()
    out = rows.groupBy("order_id", "sku").agg(F.count("sku").alias("items"), F.sum("paid_price").alias("value"))
    return out.withColumn("value", F.col("items") * F.col("value")) if mode == "items_times_sum" else out


def order_balance(events: DataFrame, settlements: DataFrame, items: DataFrame, refunds=None, outside=None, value_mode="sum", charges=vocab.LEDGER_CHARGES) -> DataFrame:
    """Debit, credit, balance and type ('CxP' owed, 'CxC' due) per order line."""
    c = F.col
    joined = attach(collected(events, refunds), settled(settlements, outside, charges), LINE)
    joined = attach(joined, order_values(items, value_mode), ["order_id", "sku"])
    zero = lambda n: F.round(F.coalesce(c(n), F.lit(0)), 2)
    out = joined.withColumns({"pago": zero("pago"), "descuento": zero("descuento"), "ajuste": zero("ajuste")})
    out = out.withColumns({"ingreso": F.round(cap("ingreso", "value"), 2), "egreso": F.round(cap_outflow("egreso", "value"), 2)})
    out = out.withColumn("pago", F.when((c("descuento") < 0) & (c("pago") == 0), c("ingreso")).otherwise(c("pago")))
    out = out.withColumns(
        {
            "pago": cap("pago", "ingreso"),
            "descuento": F.when(F.abs("descuento") > F.abs("egreso"), c("egreso")).otherwise(c("descuento")),
        }
    )
    out = out.withColumn("unit_price", F.try_divide("value", "items"))
    out = out.withColumn("egreso", whole_units("egreso", "unit_price"))
    return saldo(out)


def saldo(df: DataFrame) -> DataFrame:
    """Debit (income + outflow), credit (payment + discount) and what is left."""
    debe, haber = F.col("ingreso") + F.col("egreso"), F.col("pago") + F.col("descuento")
    return df.withColumns({"debe": debe, "haber": haber, "saldo": debe - haber, "tipo": F.when(debe - haber >= 0, "CxP").otherwise("CxC")})


def recommended_action(as_of: str, states=vocab.CLOSED_STATES) -> Column:
    """What to do about a balance, by its type and the final state of the order."""
    c, today = F.col, as_date(as_of)
    owed, due = (c("tipo") == "CxP") & (c("saldo") > 0.1), (c("tipo") == "CxC") & (c("saldo") < -0.1)
    known = lambda name, words: c(name).isin(*words)
    rules = [(owed & known(n, undone), "Reembolsar a cliente") for n, (_, undone) in states.items()]
    rules += [(owed & known(n, done), "Pagar a seller") for n, (done, _) in states.items()]
    rules.append((owed & (F.datediff(today, "fecha_ingreso") >= 30), "Escalera"))
    rules += [(due & known(n, states[n][1]), "Descontar a seller") for n in ("status_order", "status_platform") if n in states]
    rules.append((due & (F.datediff(today, "fecha_egreso") >= 30), "Escalera"))
    return case_first(rules, "No aplica")


def is_final(states=vocab.CLOSED_STATES) -> Column:
    """'Si' when any source calls the order finished."""
    hits = [F.col(n).isin(*done, *undone) for n, (done, undone) in states.items()]
    return case_first([(h, "Si") for h in hits], "No")
