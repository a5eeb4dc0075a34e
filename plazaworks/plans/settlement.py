"""Weekly settlement with sellers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, settlement_week
from ..functions.numbers import commission_split, nearest_units, sign_type
from ..operators.aggregates import control_totals, sum_when
from ..operators import joins
from ..operators.joins import attach, cascade_join, first_unique_match, key_conflict_flag, longest_prefix_match
from ..operators.keys import drop_duplicates_ordered, priority_dedup
from ..operators.rules import case_first, dated_tariff
from ..operators.setops import new_rows, reconcile
from ..session import in_slices

LINE = ["order_no", "folio", "sku"]
# Shape of each id.
ORDER_SHAPE = ("^5", 10, 10)
FOLIO_SHAPE = ("^1", 11, 12)
SKU_SHAPE = ("^1", 8, 8)


def has_shape(c: str | Column, shape: tuple[str, int, int]) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    pattern, lo, hi = shape
    return F.coalesce(c.rlike(pattern) & F.length(c).between(lo, hi), F.lit(False))


def by_shape(shape, *cols: str) -> Column:
    """First of several columns whose text has the shape of an id."""
    return F.coalesce(*[F.when(has_shape(c, shape), F.col(c)) for c in cols])


#: Parts of an order number by which a mistyped one is still recognised, as (first character, length); from the end if negative.
ORDER_PARTS = ((3, 6), (1, 7), (5, 6), (-6, 6))


def repair_refunds(refunds: DataFrame, sales: DataFrame, rows: int | None = None) -> DataFrame:
    """Refunds with the (order, folio, sku) of the sale they undo.

    Rules, the first that finds one sale line, and no other, wins:

    1. the ids match a sale as they stand
    2. the till transaction held a single sale line
    3. ids typed into each other's column, sorted out by their shape
    4. order and refunded amount fit one sale line (line total, then unit price)
    5. folio and refunded amount fit one sale line (line total, then unit price)
    6. the order, then the folio, holds a single sku
    7. a part of the order number (characters 3 to 8, 1 to 7, 5 to 10, the last six) and the sku

    refunds: refund_id, order_no, folio, sku, store, till, trx, sold_on,
    amount (negative); sales: the same ids with unit_price and total.  Amounts
    are compared to the cent.  All rules meet in one join
    (:func:`first_unique_match`), so the refund count stays as it is.  rows:
    about how many sales there are, where that is known; many sales, and the
    refunds, should be stored tables, as they are read once a rule.
    """
    c = F.col
    cents = lambda x: x.cast("decimal(18,2)")
    # shapes are looked at once, not once a rule
    shaped = {
        "_order": F.coalesce(by_shape(ORDER_SHAPE, "order_no", "folio"), F.when(F.length("sku") == 9, F.concat(F.lit("5"), "sku"))),
        "_sku": by_shape(SKU_SHAPE, "order_no", "folio", "sku"),
        "_folio": by_shape(FOLIO_SHAPE, "order_no", "folio", "sku"),
    }
    order, sku, folio = c("_order"), c("_sku"), c("_folio")
    back, total, price = cents(-c("amount")), cents(c("total")), cents(c("unit_price"))
    line, till = [c(x) for x in LINE], [c(x) for x in ("sold_on", "store", "till", "trx")]
    rules = [
        (line, line),
        (till, till),
        ([order, sku], [c("order_no"), c("sku")]),
        ([order, back], [c("order_no"), total]),
        ([order, back], [c("order_no"), price]),
        ([folio, back], [c("folio"), total]),
        ([folio, back], [c("folio"), price]),
        ([order], [c("order_no")]),
        ([folio], [c("folio")]),
    ]
    for start, length in ORDER_PARTS:
        part = F.substring("order_no", start, length)
        part = F.when(F.length(part) == length, part)
        rules.append(([part, F.coalesce(sku, c("sku"))], [part, c("sku")]))
    told = [*LINE, "sold_on", "store", "till", "trx", "amount"]
    out = first_unique_match(refunds, sales.withColumn("_line", F.struct(*LINE)), rules, "_line", made=shaped, told=told, rows=rows)
    return out.withColumns({x: F.coalesce(c("_line")[x], c(x)) for x in LINE}).drop("_line")


def held_refunds(repaired: DataFrame, sales: DataFrame, rows: int | None = None) -> DataFrame:
    """Repaired refunds with the sale's amounts, held within the sale, one of each (line, amount).

    ``amount_rule`` is 1 where the refund is the unit price, 2 where it is the
    line total, 3 where it is less and 4 where it was more and became the total;
    null without a sale.  repaired: as :func:`repair_refunds` returns them;
    rows: as there.  All goes by line, so many sales are gone through by slices
    of the lines.
    """
    c = F.col

    def held(repaired: DataFrame, sales: DataFrame) -> DataFrame:
        side = sales.groupBy(*LINE).agg(F.max("total").alias("sale_total"), F.max("unit_price").alias("sale_price"), F.min("sold_on").alias("bought_on"))
        out = attach(repaired, side, LINE)
        back = -c("amount")
        out = out.withColumn("amount_rule", F.when(c("sale_price") == back, 1).when(c("sale_total") == back, 2).when(c("sale_total") >= back, 3).when(c("sale_total").isNotNull(), 4))
        out = out.withColumn("amount", F.when(c("amount_rule") == 4, -c("sale_total")).otherwise(c("amount")))
        return drop_duplicates_ordered(out, [*LINE, "amount"], [F.asc("rule"), F.asc("refund_id")])

    if (rows or 0) < joins.ROWS_AT_ONCE:
        return held(repaired, sales)
    return in_slices(lambda mine: held(repaired.where(mine(*LINE)), sales.where(mine(*LINE))))


def commission_period(sold_on: str, second: str, third: str) -> Column:
    """'A', 'B' or 'C' by the sale date."""
    d = F.col(sold_on)
    return F.when(d < F.lit(second).cast("date"), "A").when(d < F.lit(third).cast("date"), "B").when(d >= F.lit(third).cast("date"), "C")


def commission(df: DataFrame, rates: DataFrame, default: float = 0.15) -> DataFrame:
    """Commission rate by six rules, each within the row's period.

    Seller; seller with 7-digit class; any seller with 7; seller with 5; seller
    with 3; any seller with 5.  df: seller, class_code, period; rates: period,
    rule (1..6), seller, rate_key, rate.
    """
    seller, period = F.col("seller"), F.col("period")
    prefix = lambda n: F.substring("class_code", 1, n)
    key = lambda who, n: F.concat(who, F.lit(" - "), prefix(n))
    zero = F.lit("0")
    left = [[period, seller]] + [[period, key(w, n)] for w, n in ((seller, 7), (zero, 7), (seller, 5), (seller, 3), (zero, 5))]
    rules = []
    for i, exprs in enumerate(left, 1):
        side = rates.where(F.col("rule") == str(i))
        rules.append((exprs, side, ["period", "seller" if i == 1 else "rate_key"], "rate"))
    return cascade_join(df, rules, "rate", default)


def settle(sales: DataFrame, rates: DataFrame, managers: DataFrame, sizes: DataFrame, settled_before: DataFrame, week_start: str, tariffs, exempt: Column | None = None) -> DataFrame:
    """Payable sale lines of a week, with commission, shipping share and net.

    sales: order_no, folio, sku, seller, class_code, period, sold_on, total,
    unit_price, delivery_state; managers: category, manager; sizes: sku, size;
    settled_before: order_no, sku, total.  A line is payable 14 days after the
    sale, or once fully delivered, and belongs to the week of the run.
    """
    c = F.col
    fresh = new_rows(sales, settled_before, ["order_no", "sku", "total"])
    rated = commission(fresh, rates)
    rated = longest_prefix_match(rated, "class_code", managers, "category", (7, 5, 3), "category")
    rated = attach(rated, managers.groupBy("category").agg(F.min("manager").alias("manager")), ["category"])
    rated = attach(rated, sizes.groupBy("sku").agg(F.max("size").alias("size")), ["sku"])
    rated = rated.withColumn("size", F.coalesce("size", F.lit("S")))
    old = c("sold_on") < F.date_sub(as_date(week_start), 14)
    out = rated.withColumns(
        {
            **commission_split("total", "rate"),
            "pays": F.when(old | (c("delivery_state") == "Entrega Total"), "SI").otherwise("NO"),
            "shipping": dated_tariff("sold_on", "total", "size", tariffs, exempt),
            "week": settlement_week(as_date(week_start)),
            "quantity": nearest_units(F.try_divide(c("total"), c("unit_price"))),
        }
    )
    return out.where(c("pays") == "SI").withColumn("payable", c("total") - c("commission") - c("shipping"))


def one_per_direction(new: DataFrame, history: DataFrame, order: Sequence[Column]) -> DataFrame:
    """New lines without those the history already holds: one income and one outflow per (order, sku)."""
    tag = lambda df: df.withColumn("type", sign_type("total"))
    kept = priority_dedup([tag(history), tag(new)], ["order_no", "sku", "type"], order, "_prio")
    return kept.where(F.col("_prio") == 2).drop("_prio")


def refund_lines(refunds: DataFrame, sold: DataFrame, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The refunds of a week, held within their sale in whole units, one per line, with the day of purchase.

    refunds: LINE, seller, sold_on (the day of the refund), amount (negative);
    sold: LINE, sold_on, total, unit_price.  Refunds without a sale have no day
    of purchase.  Of several refunds of a line the earliest stays.
    """
    c = F.col
    week = refunds
    if first_day is not None:
        week = week.where(c("sold_on") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        week = week.where(c("sold_on") <= F.lit(last_day).cast("date"))
    one = drop_duplicates_ordered(week, LINE, [F.asc("sold_on"), F.asc("seller"), F.asc("amount")])
    return cap_refund(one, sold, bought_on=F.min("sold_on"))


def collected_lines(income: DataFrame, outflow: DataFrame, history: DataFrame) -> DataFrame:
    """Lines of a week's collection file: sales and refunds that earlier files do not hold.

    income: LINE, seller, sold_on, bought_on, total (of the week's sales);
    outflow: the same of the week's refunds, with negative totals; history:
    order_no, sku, total of earlier files.  Lines without a folio and refunds
    without a known sale are left out; one income and one outflow stay per
    (order, sku), the earliest.
    """
    rows = income.unionByName(outflow.where(F.col("bought_on").isNotNull())).where(F.col("folio").isNotNull())
    order = [F.asc("sold_on"), F.asc("folio"), F.asc("total"), F.asc("seller")]
    # What is known of a direction is known of each of its amounts, and its first line is the first of its repeats: the
    # step that leaves least goes first, and deals the rows so that the repeats of a line need not be dealt again.
    kept = one_per_direction(rows, history, order)
    kept = drop_duplicates_ordered(kept, [*LINE, "type", "total"], order)
    return new_rows(kept, history, ["order_no", "sku", "total"])


def discounts(collected: DataFrame, commissions: DataFrame, sizes: DataFrame, tariffs, exempt: Column | None = None) -> DataFrame:
    """Outflow lines of a collection with the commission and shipping that go back with them.

    commissions: LINE, rate of the settled sale; sizes: sku, size.  The shipping
    share is that of a sale of the refunded amount, by the date of purchase, with
    its sign turned.  A line without a settled sale has no commission.
    """
    c = F.col
    out = collected.where(c("total") < 0)
    out = attach(out, sizes.groupBy("sku").agg(F.max("size").alias("size")), ["sku"]).withColumn("size", F.coalesce("size", F.lit("S")))
    out = attach(out, commissions.groupBy(*LINE).agg(F.min("rate").alias("rate")), LINE).withColumn("_back", -c("total"))
    out = out.withColumns({"commission": c("total") * c("rate"), "shipping": -dated_tariff("bought_on", "_back", "size", tariffs, exempt)})
    return out.drop("_back")


def settled_lines(payments: DataFrame, refunded: DataFrame) -> DataFrame:
    """A week's settlement: payable sales and discounts, one of each direction per (order, sku), with what is paid.

    Both: LINE, seller, sold_on, total, commission, shipping.  Payments come
    before discounts where they claim the same place, then the earlier line.
    """
    c = F.col
    cols = [*LINE, "seller", "sold_on", "total", "commission", "shipping"]
    order = [F.asc("sold_on"), F.asc("folio"), F.asc("total"), F.asc("seller")]
    # rows of an amount have one direction: once dealt by it, the repeats of an amount need not be dealt again
    sources = [df.select(*cols).withColumn("type", sign_type("total")) for df in (payments, refunded)]
    kept = priority_dedup(sources, ["order_no", "sku", "type"], order, "_prio")
    kept = drop_duplicates_ordered(kept, ["order_no", "sku", "type", "total"], [F.asc("_prio"), *order]).drop("_prio")
    return kept.withColumn("payable", c("total") - F.coalesce("commission", F.lit(0)) - c("shipping"))


def settlement_totals(payments: DataFrame, collected: DataFrame, settled: DataFrame) -> DataFrame:
    """Control totals by side: what was payable, collected and settled, in and out."""
    total, side = F.col("total"), lambda sign: F.sum(F.when(F.col("total") > 0 if sign else F.col("total") < 0, F.col("total")))
    return control_totals({
        "payable": (payments, F.sum(total)),
        "settled_in": (settled, side(True)),
        "collected_in": (collected, side(True)),
        "collected_out": (collected, side(False)),
        "settled_out": (settled, side(False)),
    })


def classify_losses(rejects: DataFrame, kind: str = "type") -> DataFrame:
    """'Rechazo' and 'Siniestro' by keyword; other types stay."""
    k = F.col(kind)
    return rejects.withColumn(kind, case_first([(k.contains("Rechazo"), "Rechazo"), (k.contains("Siniestro"), "Siniestro")], k))


def delivered_returns(refunds: DataFrame, since: str, state: str = "refund_state") -> DataFrame:
    """Returns that reached the seller, the store, or wait for delivery."""
    return refunds.where(
        F.col(state).isin("ENTREGADO", "EN TIENDA", "PENDIENTE DE ENTREGA")
        & (F.col("sold_on") >= F.lit(since).cast("date")) & F.col("seller").isNotNull()
    )


def seller_statement(lines: DataFrame, payments: DataFrame) -> DataFrame:
    """Weekly statement per seller with running settlement and payment and a comment.

    lines: week, seller, concept, amount; payments: week, seller, document,
    paid.  The weekly amount stays on the first document of a week and is zero
    on the others.  Running totals are taken over one row per (seller, week),
    before the documents are joined.
    """
    c = F.col
    weekly = lines.groupBy("week", "seller").agg(
        sum_when(c("concept") == "Pago", "amount").alias("payment"),
        sum_when(c("concept") == "Descuento", "amount").alias("discount"),
        sum_when(c("concept") == "Regularización", "amount").alias("regularisation"),
    )
    weekly = weekly.withColumn("settlement", c("payment") + c("discount") + c("regularisation"))
    paid = payments.groupBy("week", "seller").agg(F.sum(F.coalesce("paid", F.lit(0))).alias("_p"), F.min("document").alias("_d"))
    w = Window.partitionBy("seller").orderBy("week").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = attach(weekly, paid, ["week", "seller"]).withColumns(
        {"settled_total": F.sum("settlement").over(w), "paid_total": F.coalesce(F.sum("_p").over(w), F.lit(0))}
    )
    diff = c("settled_total") - c("paid_total")
    comment = case_first(
        [
            (c("_d").isNull() & (diff < 0), "NO CORRESPONDE PAGO - SALDOS PENDIENTES POR COBRAR"),
            (c("_d").isNull() & (diff >= 0) & (c("settlement") > 0), "ERROR DE PAGO - COMUNICAR AL SELLER"),
        ],
        "PAGO REALIZADO",
    )
    told = run.withColumns({"difference": diff, "comment": comment})
    # the documents, which may be many for one seller and week, stand on a side that AQE can split
    documents = payments.join(told.where(c("_p").isNotNull()), ["week", "seller"])
    docs = documents.unionByName(told.where(c("_p").isNull()), allowMissingColumns=True).drop("_p")
    first = c("document").eqNullSafe(c("_d"))
    amounts = ["payment", "discount", "regularisation", "settlement"]
    return docs.withColumns({a: F.when(first, c(a)).otherwise(F.lit(0)) for a in amounts}).drop("_d")


def statement_rollforward(settled: DataFrame, invoices: DataFrame) -> DataFrame:
    """Opening balance, orders, charges, refunds, closing balance and payments per seller and week.

    settled: seller, week, type ('Ingreso', 'Egreso'), total, commission,
    shipping; invoices: seller, week, concept ('LIQUIDACIÓN', 'COMISIÓN',
    'DEVOLUCIONES', 'AJUSTES'), settled, paid, commission, regularisation,
    refund, adjustment.  The opening balance is what earlier weeks settled less
    what they paid, carried only below -1.
    """
    c = F.col
    inc, out_ = c("type") == "Ingreso", c("type") == "Egreso"
    a = settled.groupBy("seller", "week").agg(
        sum_when(inc, "total").alias("sales"),
        (-sum_when(out_, "commission")).alias("commission_refund"),
        (-sum_when(out_, "shipping")).alias("shipping_refund"),
        sum_when(out_, "total").alias("returned_orders"),
        (-sum_when(inc, "shipping")).alias("shipping_charge"),
    )
    k = lambda word: c("concept") == word
    b = invoices.groupBy("seller", "week").agg(
        (-sum_when(k("COMISIÓN"), "commission")).alias("commission_charge"),
        sum_when(k("LIQUIDACIÓN"), "regularisation").alias("other_charges"),
        sum_when(k("DEVOLUCIONES"), "refund").alias("refunds"),
        sum_when(k("AJUSTES"), "adjustment").alias("adjustments"),
        sum_when(k("LIQUIDACIÓN"), "settled").alias("_settled"),
        sum_when(k("LIQUIDACIÓN"), "paid").alias("paid_settlement"),
    )
    wide = a.join(b, ["seller", "week"], "full").na.fill(0)
    w = Window.partitionBy("seller").orderBy("week").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(c("_settled") - c("paid_settlement")).over(w), F.lit(0))
    wide = wide.withColumns(
        {
            "opening": F.when(before < -1, before).otherwise(F.lit(0)),
            "orders_subtotal": c("sales") + c("commission_refund") + c("shipping_refund"),
            "charges_subtotal": c("returned_orders") + c("commission_charge") + c("shipping_charge") + c("other_charges"),
            "refunds_subtotal": c("refunds") + c("adjustments"),
        }
    )
    closing = c("opening") + c("orders_subtotal") + c("charges_subtotal") + c("refunds_subtotal")
    return wide.withColumns({"closing": closing, "paid_total": c("paid_settlement") + c("refunds")}).drop("_settled")


def transaction_balance(collected: DataFrame, settled: DataFrame) -> DataFrame:
    """Owed, due and balance per transaction, with conflicting owners marked.

    Both: seller and LINE with type ('Ingreso', 'Egreso') and total.
    """
    c = F.col
    keys = ["seller", *LINE]

    def both(df, income, outflow):
        return df.groupBy(*keys).agg(
            sum_when(c("type") == "Ingreso", "total").alias(income), sum_when(c("type") == "Egreso", "total").alias(outflow)
        )

    rows = attach(both(collected, "ingreso", "egreso"), both(settled, "pago", "descuento"), keys).na.fill(0)
    rows = rows.withColumns({"net": c("ingreso") + c("egreso"), "settlement": c("pago") + c("descuento")})
    owed = case_first(
        [(c("net") < 0, -c("net")), (c("settlement") < 0, -c("settlement")), (c("net") != c("settlement"), c("net") - c("settlement"))], F.lit(0)
    )
    rows = rows.withColumns({"cxp": owed, "cxc": c("descuento") - c("egreso")}).withColumn("saldo", c("cxc") - c("cxp"))
    return key_conflict_flag(rows, LINE, "seller")


def unjustified_discounts(balance: DataFrame, already: DataFrame) -> DataFrame:
    """Collected and returned lines that were discounted but never paid: pay them once.

    Lines the history already holds as income are left out, so that nothing is
    discounted or paid twice.
    """
    c = F.col
    open_ = balance.where((c("ingreso") > 0) & (c("egreso") < 0) & (c("pago") == 0) & (c("descuento") < 0) & (c("cxp") > 0))
    paid = already.where(c("total") >= 0).select("order_no", "sku").distinct()
    return new_rows(open_, paid, ["order_no", "sku"]).withColumn("total", c("ingreso"))


def reconcile_sources(a: DataFrame, b: DataFrame, keys: Sequence[str], amount: str = "amount", tolerance: float = 0.005) -> DataFrame:
    """Point-of-sale amounts against settled amounts per till transaction."""
    return reconcile(a, b, keys, amount, tolerance)


def cap_refund(refunds: DataFrame, sold: DataFrame, **also: Column) -> DataFrame:
    """Refund held within the sale and rounded to whole units.

    refunds: LINE, amount (negative); sold: LINE, total, unit_price.  ``also``
    names aggregates of the line's sales that come with it.
    """
    c = F.col
    side = sold.groupBy(*LINE).agg(F.max("total").alias("_t"), F.max("unit_price").alias("_u"), *[a.alias(n) for n, a in also.items()])
    out = attach(refunds, side, LINE)
    amount = F.when(-c("amount") > c("_t"), -c("_t")).otherwise(c("amount"))
    out = out.withColumn("amount", amount).withColumn("_u", F.abs(F.coalesce("_u", "amount")))
    out = out.withColumn("amount", F.when(c("_u") > -c("amount"), -c("_u")).otherwise(c("amount")))
    out = out.withColumn("quantity", nearest_units(F.try_divide(-c("amount"), c("_u")))).where(c("quantity").isNotNull())
    return out.withColumn("amount", -c("quantity") * c("_u")).drop("_t", "_u")
