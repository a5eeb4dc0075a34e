"""Refunds led back to their sale, and the refund side of a settlement, on hand-written rows."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from plazaworks import vocab
from plazaworks.operators.joins import first_unique_match
from plazaworks.operators.keys import drop_duplicates_ordered, priority_dedup
from plazaworks.operators.setops import new_rows
from plazaworks.plans import settlement as S

DAY = dt.date(1997, 5, 6)
SALES = "order_no string, folio string, sku string, sold_on date, store string, till string, trx string, total decimal(18,2), unit_price decimal(18,2)"
REFUNDS = "refund_id string, order_no string, folio string, sku string, store string, till string, trx string, sold_on date, amount decimal(18,2)"


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        ("5000000001", "10000000011", "10000001", DAY, "1", "1", "1", D(100), D(50)),
        ("5000000001", "10000000011", "10000002", DAY, "1", "1", "2", D(80), D(80)),
        ("5000000002", "10000000021", "10000003", DAY, "1", "1", "3", D(70), D(70)),
        ("5123456789", "10000000031", "10000004", DAY, "2", "1", "4", D(60), D(30)),
        ("5993456799", "10000000041", "10000004", DAY, "2", "1", "4", D(60), D(30)),
    ]
    return spark.createDataFrame(rows, SALES)


@pytest.mark.parametrize(
    ("refund", "rule", "line"),
    [
        (("5000000001", "10000000011", "10000001", None, None, None, None, D(-100)), 1, "10000001"),
        (("x", "x", "x", "1", "1", "3", DAY, D(-1)), 2, "10000003"),
        (("10000002", "5000000001", "?", None, None, None, None, D(-1)), 3, "10000002"),
        (("5000000001", "?", "?", None, None, None, None, D(-100)), 4, "10000001"),
        (("5000000001", "?", "?", None, None, None, None, D(-50)), 5, "10000001"),
        (("?", "10000000011", "?", None, None, None, None, D(-80)), 6, "10000002"),
        (("?", "10000000011", "?", None, None, None, None, D(-50)), 7, "10000001"),
        (("5000000002", "?", "?", None, None, None, None, D(-1)), 8, "10000003"),
        (("?", "10000000021", "?", None, None, None, None, D(-1)), 9, "10000003"),
        (("x912345678", "?", "10000004", None, None, None, None, D(-1)), 0, "10000004"),  # no part of it is right
        (("??23456700", "?", "10000004", None, None, None, None, D(-1)), 10, "10000004"),  # characters 3 to 8
        (("5123456xxx", "?", "10000004", None, None, None, None, D(-1)), 11, "10000004"),  # characters 1 to 7
        (("xxxx456799", "?", "10000004", None, None, None, None, D(-1)), 12, "10000004"),  # characters 5 to 10
        (("456789", "?", "10000004", None, None, None, None, D(-1)), 13, "10000004"),  # the last six
        (("??456799??", "?", "10000004", None, None, None, None, D(-1)), 0, "10000004"),
        ((None, None, None, None, None, None, None, None), 0, None),
    ],
)
def test_each_rule(spark, sales, refund, rule, line):
    got = S.repair_refunds(spark.createDataFrame([("r", *refund)], REFUNDS), sales).collect()
    assert [(r["rule"], r["sku"]) for r in got] == [(rule, line)]


def test_a_part_shared_by_two_sales_is_not_trusted(spark, sales):
    more = sales.union(spark.createDataFrame([("5023456790", "1", "10000004", DAY, "9", "9", "9", D(1), D(1))], SALES))
    refund = ("r", "??23456700", "?", "10000004", None, None, None, None, D(-1))
    got = S.repair_refunds(spark.createDataFrame([refund], REFUNDS), more).collect()[0]
    assert got["rule"] == 0 and got["order_no"] == "??23456700"


def test_refunds_keep_their_number(spark, sales):
    """Repeated refunds, a hot key and no sales at all: one row out for each row in."""
    rows = [("r", "5000000001", "?", "?", None, None, None, None, D(-100))] * 300 + [(str(i), None, None, None, "1", "1", "3", DAY, None) for i in range(300)]
    refunds = spark.createDataFrame(rows, REFUNDS)
    assert {r["rule"]: r["count"] for r in S.repair_refunds(refunds, sales).groupBy("rule").count().collect()} == {4: 300, 2: 300}
    assert {r["rule"]: r["count"] for r in S.repair_refunds(refunds, sales.limit(0)).groupBy("rule").count().collect()} == {0: 600}


def test_one_join_whatever_the_rules(spark, sales):
    """The refunds are dealt three times: to the candidates, to their smallest rule, and back."""
    refunds = spark.createDataFrame([], REFUNDS)
    plan = S.repair_refunds(refunds, sales)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3


def test_empty_and_null_keys_differ(spark):
    left = spark.createDataFrame([("", None), (None, ""), (None, None), ("", "")], "a string, b string")
    right = spark.createDataFrame([("", "", 1)], "a string, b string, v int")
    out = first_unique_match(left, right, [([F.col("a"), F.col("b")], [F.col("a"), F.col("b")]), ([F.col("b")], [F.col("b")])], "v")
    assert sorted((r["a"] or ("-" if r["a"] is None else ""), r["b"] or ("-" if r["b"] is None else ""), r["rule"], r["v"]) for r in out.collect()) == [
        ("", "", 1, 1), ("", "-", 0, None), ("-", "", 2, 1), ("-", "-", 0, None)
    ]


def test_amounts_are_held_within_the_sale(spark, sales):
    rows = [(i, "5000000001", "10000000011", "10000001", None, None, None, None, D(a)) for i, a in (("a", -50), ("b", -100), ("c", -70), ("d", -170), ("e", -150))]
    held = S.held_refunds(S.repair_refunds(spark.createDataFrame(rows, REFUNDS), sales), sales)
    # d and e both become the whole line, which b has already
    assert {r["refund_id"]: (r["amount_rule"], r["amount"]) for r in held.collect()} == {"a": (1, D(-50)), "b": (2, D(-100)), "c": (3, D(-70))}


LINE = "order_no string, folio string, sku string, seller string, sold_on date, bought_on date, total double"


def test_refund_side_of_a_week(spark):
    sold = spark.createDataFrame([("o1", "f", "s1", DAY, 100.0, 50.0), ("o2", "f", "s2", DAY, 100.0, 100.0)], "order_no string, folio string, sku string, sold_on date, total double, unit_price double")
    refunds = spark.createDataFrame(
        [("o1", "f", "s1", "x", dt.date(1997, 6, 1), -170.0), ("o1", "f", "s1", "x", dt.date(1997, 6, 2), -50.0), ("o2", "f", "s2", "x", dt.date(1997, 6, 9), -100.0), ("o3", "f", "s3", "x", dt.date(1997, 6, 3), -10.0)],
        "order_no string, folio string, sku string, seller string, sold_on date, amount double",
    )
    week = {r["order_no"]: (r["amount"], r["quantity"], r["bought_on"]) for r in S.refund_lines(refunds, sold, "1997-06-01", "1997-06-07").collect()}
    assert week == {"o1": (-100.0, 2, DAY), "o3": (-10.0, 1, None)}  # the larger refund is cut to the sale; o2 is later


def test_collection_and_settlement(spark):
    income = spark.createDataFrame([("o1", "f", "s1", "x", DAY, DAY, 100.0), ("o2", None, "s2", "x", DAY, DAY, 90.0), ("o4", "f", "s4", "x", DAY, DAY, 20.0)], LINE)
    outflow = spark.createDataFrame([("o1", "f", "s1", "x", DAY, DAY, -100.0), ("o3", "f", "s3", "x", DAY, None, -10.0)], LINE)
    history = spark.createDataFrame([("o4", "s4", 15.0)], "order_no string, sku string, total double")
    collected = S.collected_lines(income, outflow, history)
    # o2 has no folio, o3 no sale, o4 was collected before under another amount
    assert sorted((r["order_no"], r["total"], r["type"]) for r in collected.collect()) == [("o1", -100.0, "Egreso"), ("o1", 100.0, "Ingreso")]

    rates = spark.createDataFrame([("o1", "f", "s1", 0.1)], "order_no string, folio string, sku string, rate double")
    sizes = spark.createDataFrame([("s1", "M")], "sku string, size string")
    tariffs = [("1997-01-01", "1998-01-01", vocab.TARIFF_1)]
    back = S.discounts(collected, rates, sizes, tariffs)
    row = back.collect()[0]
    assert (row["commission"], row["shipping"]) == (-10.0, -8.9)  # what a sale of 100 in size M would pay, turned

    payments = spark.createDataFrame([("o1", "f", "s1", "x", DAY, 100.0, 10.0, 8.9)], "order_no string, folio string, sku string, seller string, sold_on date, total double, commission double, shipping double")
    settled = S.settled_lines(payments, back)
    assert sorted((r["type"], round(r["payable"], 6)) for r in settled.collect()) == [("Egreso", -81.1), ("Ingreso", 81.1)]
    totals = {r["label"]: r["total"] for r in S.settlement_totals(payments, collected, settled).collect()}
    assert totals == {"payable": 100.0, "settled_in": 100.0, "collected_in": 100.0, "collected_out": -100.0, "settled_out": -100.0}


def test_rules_looked_up_a_few_at_a_time(spark, sales, monkeypatch):
    """On a large table the rules meet in joins of their own; what comes out is the same, and nothing shuffled for them stays."""
    from plazaworks.operators import joins

    rows = [("a", "5000000001", "10000000011", "10000001", None, None, None, None, D(-100)), ("b", "x", "x", "x", "1", "1", "3", DAY, D(-1)), ("c", "5000000001", "?", "?", None, None, None, None, D(-50))]
    rows += [("d", "5123456xxx", "?", "10000004", None, None, None, None, D(-1)), ("e", None, None, None, None, None, None, None, None), ("e", None, None, None, None, None, None, None, None)]
    refunds = spark.createDataFrame(rows, REFUNDS)
    once = sorted(map(str, S.repair_refunds(refunds, sales).collect()))
    stored, store = [], joins.store
    monkeypatch.setattr(joins, "ROWS_AT_ONCE", 1)
    monkeypatch.setattr(joins, "store", lambda df: stored.append(store(df)) or stored[-1])
    assert sorted(map(str, S.repair_refunds(refunds, sales).collect())) == once
    assert len(stored) == 3


def test_totals_of_one_table_take_one_pass(spark):
    from plazaworks.operators.aggregates import control_totals

    a, b = spark.createDataFrame([(1,), (-2,), (None,)], "v int"), spark.createDataFrame([], "v int")
    c = F.col("v")
    out = control_totals({"all": (a, F.sum(c)), "none": (b, F.sum(c)), "in": (a, F.sum(F.when(c > 0, c))), "rows": (a, F.count(F.lit(1)))})
    assert {r["label"]: r["total"] for r in out.collect()} == {"all": -1.0, "none": None, "in": 1.0, "rows": 3.0}
    assert out.schema.simpleString() == "struct<label:string,total:double>"
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def odd_lines(spark, seed):
    """Lines whose parts repeat or are missing, some twice."""
    rng = random.Random(seed)
    pick = lambda *some: rng.choice(some)
    rows = [(pick("a", "b", None), pick("1", "2", None), pick("s", "t", None), pick("x", "y", None), pick(DAY, dt.date(1998, 1, 1), None), pick(D(5), D(-5), D(3), D(-1), D(0), None)) for _ in range(60)]
    rows = [(*r[:5], r[4], r[5]) for r in rows + rows[:9]]
    return spark.createDataFrame(rows, LINE.replace("total double", "total decimal(18,2)"))


def counted(df, cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("seed", range(4))
def test_order_of_the_steps_of_a_settlement(spark, seed):
    """The strictest step may go first: what stays is what stays when the lines' repeats are dropped first."""
    income, outflow, kept = (odd_lines(spark, 10 * seed + i) for i in range(3))
    history = kept.where("folio = '1' and seller = 'x'").select("order_no", "sku", "total")
    order = [F.asc("sold_on"), F.asc("folio"), F.asc("total"), F.asc("seller")]
    cols = ["order_no", "folio", "sku", "seller", "sold_on", "bought_on", "total", "type"]
    rows = income.unionByName(outflow.where("bought_on is not null")).where("folio is not null")
    fresh = new_rows(drop_duplicates_ordered(rows, [*S.LINE, "total"], order), history, ["order_no", "sku", "total"])
    collected = S.collected_lines(income, outflow, history)
    assert counted(collected, cols) == counted(S.one_per_direction(fresh, history, order), cols) and collected.count()
    payments, refunded = (df.withColumns({"commission": F.length("seller") * 0.5, "shipping": F.lit(float(n))}) for n, df in enumerate((income, outflow)))
    taken = [*S.LINE, "seller", "sold_on", "total", "commission", "shipping"]
    one = priority_dedup([payments.select(*taken), refunded.select(*taken)], ["order_no", "sku", "total"], order, "_prio").withColumn("type", S.sign_type("total"))
    want = drop_duplicates_ordered(one, ["order_no", "sku", "type"], [F.asc("_prio"), *order])
    settled = S.settled_lines(payments, refunded)
    assert counted(settled, [*taken, "type"]) == counted(want, [*taken, "type"])
    assert exchanges(settled) == 1 and exchanges(collected) == 3


def test_sales_are_summed_up_once_for_their_refunds(spark):
    """Amounts and day of purchase come from one aggregate of the sales."""
    sold = spark.createDataFrame([("o", "f", "s", dt.date(1998, 1, 2), 9.0, 9.0), ("o", "f", "s", DAY, 8.0, 4.0)], "order_no string, folio string, sku string, sold_on date, total double, unit_price double")
    out = S.refund_lines(spark.createDataFrame([("o", "f", "s", "x", DAY, -20.0)], "order_no string, folio string, sku string, seller string, sold_on date, amount double"), sold)
    assert [(r["bought_on"], r["amount"], r["quantity"]) for r in out.collect()] == [(DAY, -9.0, 1)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1


def test_large_tables_go_by_rules_and_slices(spark, sales, monkeypatch, tmp_path):
    """One rule's rows are shuffled at a time, refunds are held by slices of their lines, and of the stored steps only the result stays; rows are as in one piece."""
    from plazaworks import session
    from plazaworks.operators import joins

    rows = [(str(i), "5000000001", "10000000011", "10000001", None, None, None, None, D(a)) for i, a in enumerate((-50, -100, -100, -70, -170, -150))]
    rows += [(f"x{i}", "x", "x", "x", "1", "1", "3", DAY, D(-1)) for i in range(3)] + [("p", "5123456xxx", "?", "10000004", None, None, None, None, D(-1))]
    rows += [("n", None, None, None, None, None, None, None, None)] * 2 + [("e", "", None, "10000001", None, None, None, None, D(-9)), ("e", None, "", "10000001", None, None, None, None, D(-9))]
    rows += [("w", "w", "w", "w", None, None, None, None, D(-i % 3 - 1)) for i in range(6)]
    refunds = spark.createDataFrame(rows, REFUNDS)
    repaired = sorted(map(str, S.repair_refunds(refunds, sales).collect()))
    held = sorted(map(str, S.held_refunds(S.repair_refunds(refunds, sales), sales).collect()))
    monkeypatch.setattr(joins, "ROWS_AT_ONCE", 1)
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / str(len(list(tmp_path.iterdir())) + random.random())))
    pieces, store = [], joins.store
    monkeypatch.setattr(joins, "store", lambda some: pieces.append(some := list(some)) or store(some))
    large = S.repair_refunds(refunds, sales, rows=5)
    assert [len(p) for p in pieces] == [5, 5, 3]  # thirteen rules, each made and stored by itself
    assert len(list(tmp_path.iterdir())) == session.SLICES
    assert sorted(map(str, large.collect())) == repaired
    assert sorted(map(str, S.held_refunds(large, sales, rows=5).collect())) == held
    assert len(list(tmp_path.iterdir())) == 2 * session.SLICES


def test_keys_of_any_columns_on_large_tables(spark, monkeypatch):
    """Without a list of the columns that keys follow from, rows are told apart by their keys, nulls from empty texts."""
    from plazaworks.operators import joins

    left = spark.createDataFrame([("", None, 1), (None, "", 2), (None, None, 3), ("", "", 4), ("", "", 4), ("k", "q", 5)], "a string, b string, n int")
    right = spark.createDataFrame([("", "", 1), ("k", "r", 2), ("k", "r", 2), ("k", "s", 3), ("m", "q", 4)], "a string, b string, v int")
    rules = [([F.col("a"), F.col("b")], [F.col("a"), F.col("b")]), ([F.col("a2")], [F.col("a")]), ([F.col("b")], [F.col("b")])]
    find = lambda: sorted(map(str, first_unique_match(left, right, rules, "v", made={"a2": F.col("a")}).collect()))
    small = find()
    assert "Row(a='k', b='q', n=5, rule=3, v=4)" in small or "Row(a='k', b='q', n=5, v=4, rule=3)" in small
    monkeypatch.setattr(joins, "ROWS_AT_ONCE", 1)
    monkeypatch.setattr(joins, "RULES_AT_ONCE", 2)
    assert find() == small


def test_filters_stay_above_the_keys(spark, sales, monkeypatch):
    """No filter of the large joins works the keys or row marks out once more."""
    from plazaworks.operators import joins

    plans, store = [], joins.store

    def keep(some):
        some = list(some)
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in some)
        return store(some)

    monkeypatch.setattr(joins, "ROWS_AT_ONCE", 1)
    monkeypatch.setattr(joins, "store", keep)
    S.repair_refunds(spark.createDataFrame([("r", "x", "y", "z", None, None, None, None, D(-1))], REFUNDS), sales, rows=5)
    assert len(plans) == 13
    assert not any("xxhash64" in line for p in plans for line in p.splitlines() if line.lstrip(" +-:").startswith("Filter"))
