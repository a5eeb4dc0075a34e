"""Report jobs on hand-made rows."""

from datetime import date, datetime

from pyspark.sql import functions as F

from plazaworks import vocab
from plazaworks.ml import features as X
from plazaworks.ml import models as M
from plazaworks.plans import appeals, audits, backlog, balance, catalog, orders, settlement, sizes, transport
from plazaworks.plans.landing import clean_landed


def test_balance_by_hand(spark):
    d = datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [("s", "o", "k", "PAYMENT", "CHARGED", d, 100.0), ("s", "o", "k", "RETURN", "RECEIVED", d, -40.0), ("s", "p", "k", "PAYMENT", "REFUSED", d, 9.0)],
        "seller_id string, order_id string, sku string, event string, event_status string, event_date timestamp, total double")
    booked = spark.createDataFrame(
        [("s", "o", "k", "ITEM_PRICE_CREDIT", d, 100.0, 0.1), ("s", "o", "k", "COMMISSION", d, 10.0, 0.1), ("s", "o", "k", "COMMISSION_CREDIT", d, 4.0, 0.1)],
        "seller_id string, order_id string, sku string, transaction_type string, event_date timestamp, total double, commission double")
    items = spark.createDataFrame([("o", 1, "k", 50.0), ("o", 2, "k", 50.0)], "order_id string, item_id int, sku string, paid_price double")
    row = {r["order_id"]: r for r in balance.order_balance(events, booked, items).collect()}["o"]
    # the refund of 40 does not fill a unit of 50: it is rounded up towards zero
    assert (row["ingreso"], row["egreso"], row["pago"], row["descuento"]) == (100.0, 0.0, 100.0, 0.0)
    assert (row["saldo"], row["tipo"], row["cobro_comision"]) == (0.0, "CxP", 6.0)


def test_items_times_sum_overstates(spark):
    items = spark.createDataFrame([("o", 1, "k", 50.0), ("o", 2, "k", 50.0)], "order_id string, item_id int, sku string, paid_price double")
    assert balance.order_values(items).collect()[0]["value"] == 100.0
    assert balance.order_values(items, "items_times_sum").collect()[0]["value"] == 200.0


def test_refunds_are_taken_where_nothing_was_booked(spark):
    d = datetime(2024, 1, 1)
    events = spark.createDataFrame([("s", "o", "k", "PAYMENT", "CHARGED", d, 10.0)],
                                   "seller_id string, order_id string, sku string, event string, event_status string, event_date timestamp, total double")
    refunds = spark.createDataFrame([("o", "k", 25.0, date(2024, 1, 3))], "order_id string, sku string, refund_amount double, refund_date date")
    row = balance.collected(events, refunds).collect()[0]
    assert (row["ingreso"], row["egreso"], row["fecha_egreso"]) == (25.0, -25.0, date(2024, 1, 3))


def test_milestones_take_the_first_known_time(spark):
    df = spark.createDataFrame([(1, None, "b", "c")], "k int, time_delivered string, time_canceled string, time_failed string")
    assert orders.milestones(df).collect()[0]["terminated_at"] == "b"


def test_steps_equal_first_matching_range(spark):
    from plazaworks import vocab

    for measure, table in vocab.SIZE_RANGES.items():
        edges = sorted({e for r in table.values() for e in r})
        probes = [-1.0] + [e + d for e in edges for d in (-0.001, 0.0, 0.001)]
        df = spark.createDataFrame([(p,) for p in probes], "v double")
        got = {r["v"]: r["p"] for r in df.withColumn("p", sizes.size_by(measure, "v")).collect()}
        for p in probes:
            want = next((i for i, (lo, hi) in enumerate(table.values()) if lo <= p < hi), 0)
            assert got[p] == want, (measure, p)


def test_declared_size_holds_the_class_down(spark):
    row = (0.1, 0.2, 0.1, 40.0, "S", "G1", 0.0, None)
    df = spark.createDataFrame([row, row[:4] + ("EO",) + row[5:]], "width double, length double, height double, weight double, size string, category_code string, dimension_quantity double, new_item_size string")
    assert [(r["max_size"], r["size"]) for r in sizes.assign_size(df).collect()] == [("XL", "S"), ("XL", "XL")]


def test_category_levels(spark):
    df = spark.createDataFrame([("G0102030405",), ("G01",), ("G1",)], "c string")
    assert [tuple(r) for r in df.select(*[e.alias(n) for n, e in catalog.category_levels("c").items()]).collect()] == [
        ("G01", "G0102", "G010203", "G01020304"), ("G01", "G01", "G01", "G01"), ("G1", "G1", "G1", "G1")]


def test_commission_rules_in_order(spark):
    sales = spark.createDataFrame([("s1", "K010203", "A"), ("s2", "K010203", "A"), ("s3", "K990000", "A"), ("s1", "K010203", "B")], "seller string, class_code string, period string")
    rates = spark.createDataFrame(
        [("A", "1", "s1", "", 0.10), ("A", "3", "0", "0 - K010203", 0.20), ("A", "6", "0", "0 - K9900", 0.30)], "period string, rule string, seller string, rate_key string, rate double")
    assert [r["rate"] for r in settlement.commission(sales, rates).orderBy("period", "seller").collect()] == [0.10, 0.20, 0.30, 0.15]


def test_opening_balance_only_carries_debts(spark):
    settled = spark.createDataFrame([("s", "1", "Ingreso", 0.0, 0.0, 0.0)], "seller string, week string, type string, total double, commission double, shipping double")
    inv = [("s", "1", "LIQUIDACIÓN", -50.0, 0.0), ("s", "2", "LIQUIDACIÓN", 80.0, 0.0), ("s", "3", "LIQUIDACIÓN", 0.0, 0.0)]
    invoices = spark.createDataFrame([r + (0.0, 0.0, 0.0, 0.0) for r in inv], "seller string, week string, concept string, settled double, paid double, commission double, regularisation double, refund double, adjustment double")
    out = {r["week"]: r["opening"] for r in settlement.statement_rollforward(settled, invoices).collect()}
    assert out == {"1": 0.0, "2": -50.0, "3": 0.0}


def test_withholding_needs_the_minimum(spark):
    docs = spark.createDataFrame([("p", "a", "d1", "Commission", 400.0), ("p", "a", "d1", "mktg", 400.0), ("p", "a", "d2", "odd", 300.0), ("p", "b", "d3", "commission", 600.0)],
                                 "period string, payer string, doc string, description string, total double")
    concepts = spark.createDataFrame([("Commission", "c1", 0.12), ("Mktg", "c2", 0.10)], "concept string, code string, rate double")
    out = {r["doc"]: (r["code"], r["withheld"]) for r in audits.withholding(docs, concepts).collect()}
    assert out == {"d1": ("c1", 48.0), "d2": (None, None)}


def test_pending_amounts_give_way_to_accepted_ones(spark):
    df = spark.createDataFrame([("o", "Aceptado", 60.0), ("o", "Por validar", 40.0), ("p", "Por validar", 9.0)], "order_id string, state string, value double")
    df = df.withColumns({"income": F.lit(100.0), "paid": F.lit(30.0)})
    out = sorted((r["order_id"], r["state"], r["value"], r["acceptance"]) for r in appeals.share_payment(df, "order_id", "state", "value", "income", "paid").collect())
    assert out == [("o", "Aceptado", 60.0, 0.6), ("o", "Por validar", None, 0.3), ("p", "Por validar", 9.0, 0.09)]


def test_landed_rows(spark):
    df = spark.createDataFrame([("1.0", "31/01/2024", "x"), ("2", "bad", "y")], "id string, d string, junk string")
    out = clean_landed(df, ["junk"], {"d": "d/M/yyyy"}, ["id"], "d").orderBy("id").collect()
    assert [tuple(r) for r in out] == [("1", date(2024, 1, 31), "2024-01"), ("2", None, None)]


def test_split_depends_on_the_id_only(spark):
    df = spark.range(1000)
    a = [sorted(r["id"] for r in p.collect()) for p in M.split(df, [0.8, 0.1, 0.1], 1, ["id"])]
    b = [sorted(r["id"] for r in p.collect()) for p in M.split(df.repartition(5), [0.8, 0.1, 0.1], 1, ["id"])]
    assert a == b and sorted(sum(a, [])) == list(range(1000))


def test_tree_learns_a_rule(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") % 10).cast("double").alias("x"), F.when(F.col("id") % 10 < 5, "lo").otherwise("hi").alias("y"))
    model = M.tree_classifier(["x"], "y", 3).fit(df)
    out = M.score(model, df)
    assert out.where(F.col("y") != F.col("predicted")).count() == 0
    assert {"p_lo", "p_hi"} <= set(out.columns)


def test_word_ids_are_cut_in_front_and_padded_behind(spark):
    df = spark.createDataFrame([(1, ["a", "b", "z", "a"]), (2, ["b", "a", "b", "a", "b", "a"])], "id int, w array<string>")
    out = X.word_sequences(df, "w", ["a", "b"], length=5).orderBy("id").collect()
    assert [r["sequence"] for r in out] == [[1, 2, 1, 0, 0], [1, 2, 1, 2, 1]]
    assert X.common_words(df, "w", 3) == ["a", "b"]


def test_withholding_names_the_smallest_code_of_a_tie(spark):
    from plazaworks import vocab
    from plazaworks.plans.audits import withholding

    concept = vocab.WITHHOLDING_OTHER
    docs = spark.createDataFrame([("2024-01", "p", "d", "no known words", 5000.0)], "period string, payer string, doc string, description string, total double")
    # two concepts of one document with one rate
    concepts = spark.createDataFrame([(concept, "037", 0.12), (concept, "022", 0.12)], "concept string, code string, rate double")
    assert {r["code"] for r in withholding(docs, concepts).collect()} == {"022"}


def test_message_pages_hold_their_bound(spark):
    rows = spark.range(5000).select(F.lit("c").alias("campaign"), F.lit("s").alias("seller"), F.col("id").alias("order_no"))
    audience = spark.createDataFrame([("c", "s", 5000, 5000)], "campaign string, seller string, orders long, lines long")
    pages = backlog.alert_payload(rows, audience, "seller", ["order_no"]).select(F.size("rows").alias("n"), "rows").collect()
    assert sorted(r["n"] for r in pages) == [500] * 10
    assert sorted(x["order_no"] for r in pages for x in r["rows"]) == list(range(5000))


def test_old_sale_settles_in_the_week_of_the_run(spark):
    sales = spark.createDataFrame(
        [("o", "f", "k", "x", "A", "P", date(2024, 1, 2), 50.0, 50.0, "Entrega Total")],
        "order_no string, folio string, sku string, seller string, class_code string, period string, sold_on date, total double, unit_price double, delivery_state string")
    rates = spark.createDataFrame([("P", "1", "x", "", 0.1)], "period string, rule string, seller string, rate_key string, rate double")
    managers = spark.createDataFrame([("A", "m")], "category string, manager string")
    parts = spark.createDataFrame([("k", "S")], "sku string, size string")
    none = sales.select("order_no", "sku", "total").limit(0)
    row = settlement.settle(sales, rates, managers, parts, none, "2024-03-06", [("2023-01-01", None, vocab.TARIFF_1)]).collect()[0]
    assert row["week"] == "20240304-20240310"


def test_every_width_key_is_read(spark):
    keys = "48 55 60 72 344 375 514 548 730 762 938 962 1082 1210 1295 1314 1333 1405 1431 1495 1719 10794".split()
    rows = spark.createDataFrame([(k, f'{{"{k}": "7,5"}}') for k in keys], "name string, attributes string")
    assert {r["width"] for r in catalog.product_dimensions(rows).select("width").collect()} == {7.5}


def test_flexible_delivery_is_charged_whatever_the_name_before_it(spark):
    rows = [("s", "o", "k", kind, None, total, 0.0) for kind, total in (("ANY_FLEX", 5.0), ("ANY_FLEX_CREDIT", 2.0), ("FLEX", 1.0), ("NO_FLEXIBLE", 9.0))]
    settlements = spark.createDataFrame(rows, "seller_id string, order_id string, sku string, transaction_type string, event_date date, total double, commission double")
    assert balance.settled(settlements).collect()[0]["cobro_flex"] == 4.0


def test_repeated_keys_on_the_side_keep_the_rows(spark):
    from plazaworks.operators.joins import attach_one
    from plazaworks.plans.orders import merge_tracking

    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    side = spark.createDataFrame([("a", 9, "x"), ("a", 8, "y"), (None, 1, "z")], "k string, w int, n string")
    assert sorted((r["k"] or "", r["v"], r["w"], r["n"]) for r in attach_one(rows, side, ["k"]).collect()) == [("", 4, None, None), ("a", 1, 8, "y"), ("a", 2, 8, "y"), ("b", 3, None, None)]
    feed = spark.createDataFrame([("t", "open", 1), ("t", "sent", 2)], "tracking string, state string, ts int")
    twice = spark.createDataFrame([("t", "lost"), ("t", "late")], "tracking string, state string")
    assert [(r["tracking"], r["state"]) for r in merge_tracking([feed], overrides=twice).collect()] == [("t", "late")]


def test_a_statement_keeps_every_document_and_every_week(spark):
    lines = spark.createDataFrame([("w1", "s", "Pago", 10.0), ("w2", "s", "Pago", 5.0), ("w3", None, "Pago", 1.0)], "week string, seller string, concept string, amount double")
    paid = spark.createDataFrame([("w1", "s", i, 1.0) for i in range(3)] + [("w9", "s", 7, 1.0)], "week string, seller string, document int, paid double")
    out = settlement.seller_statement(lines, paid)
    got = sorted(((r["week"], r["document"], r["settlement"], r["settled_total"], r["paid_total"]) for r in out.collect()), key=str)
    assert got == [("w1", 0, 10.0, 10.0, 3.0), ("w1", 1, 0.0, 10.0, 3.0), ("w1", 2, 0.0, 10.0, 3.0), ("w2", None, 5.0, 15.0, 3.0), ("w3", None, 1.0, 1.0, 0.0)]


def test_withholding_does_not_deal_rows_by_concept(spark):
    """Few concepts stand on all rows: rows find theirs without being dealt by it, also where concepts repeat or have no rate."""
    docs = spark.createDataFrame([("p", "a", f"d{i}", w, 1000.0) for i, w in enumerate(("shipping fee", "commission", "odd", None))], "period string, payer string, doc string, description string, total double")
    concepts = spark.createDataFrame([("Shipping Fee", "z", 0.1), ("Shipping Fee", "y", 0.1), ("Shipping Fee", "x", 0.05), ("Commission", "c", None), (None, "n", 0.5), ("Other", "o", 0.5)], "concept string, code string, rate double")
    out = audits.withholding(docs, concepts, 1)
    assert sorted((r["doc"], r["code"], r["rate"]) for r in out.collect()) == [("d0", "y", 0.1), ("d1", None, None), ("d2", None, None), ("d3", None, None)]
    # documents meet their payers and their codes, rows meet no concepts
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    none = audits.withholding(docs, concepts.limit(0), 1)
    assert sorted((r["doc"], r["code"], r["total"]) for r in none.collect()) == [(f"d{i}", None, 1000.0) for i in range(4)]


def unions(df):
    """Unions left in the plan of a frame that has run."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Union")


def test_requests_take_lines_without_block_summaries(spark):
    """Ids far apart, each a block of its own: no summaries of them beside the requests."""
    asked = [(i * 10**9, o, "s", g) for i, (o, g) in enumerate([(1, "g"), (1, "g"), (1, "h"), (2, "g"), (3, "g"), (None, "g")])]
    lines = [(1, "s", 5), (1, "s", 4 * 10**9), (2, "s", 6), (None, "s", 7)]
    out = audits.with_line(spark.createDataFrame(asked, "request_id long, order_id long, sku string, group string"), spark.createDataFrame(lines, "order_id long, sku string, line_id long"))
    assert sorted((r["request_id"] // 10**9, r["position"], r["line_id"]) for r in out.collect()) == [(0, 1, 5), (1, 2, 4 * 10**9), (2, 1, 5), (3, 1, 6), (4, 1, None), (5, 1, None)]
    assert unions(out) == 0


def test_tickets_of_short_orders_need_no_block_summaries(spark):
    """Only the plan and the unplanned arrivals are stacked; their months are not."""
    at = [datetime(2024, m, 1) for m in (1, 2, 3)]
    planned = spark.createDataFrame([(1, "DEV1", "st", "r", "-", at[0]), (1, "2", "st", "r", "-", at[1]), (2, "3", "st", "r", "-", None)], "order_id long, guide string, state string, reason string, condition string, planned_at timestamp")
    unplanned = spark.createDataFrame([(1, "RET4", at[2])], "order_id long, guide string, registered_at timestamp")
    tickets = spark.createDataFrame([(1, 12, at[2], None), (1, 11, at[0], None), (2, 13, None, None)], "order_id long, case_id long, ticket_at timestamp, closed_at timestamp")
    out = transport.transport_plan(planned, unplanned, tickets, spark.createDataFrame([(1, 9)], "order_id long, seller_id long"))
    got = sorted((r["guide"], r["position"], r["case_id"], r["seller_id"], r["flow"]) for r in out.collect())
    assert got == [("2", 2, 12, 9, "Recoleccion"), ("3", 1, 13, None, "Recoleccion"), ("DEV1", 1, 11, 9, "IL"), ("RET4", 1, 11, 9, "IL")]
    assert unions(out) == 1
