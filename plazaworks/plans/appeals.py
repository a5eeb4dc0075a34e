"""Appeals of rejected returns, from several channels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..operators.joins import anti_join, attach_group, attach_one
from ..operators.rules import bands, case_first
from ..operators.windows import blocked_window, natural_block


def merge_channels(channels: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """Channels in order of trust; a later one only adds keys not seen before."""
    name, out = channels[0]
    out = out.withColumn("channel", F.lit(name))
    for name, rows in channels[1:]:
        fresh = anti_join(rows, out.select(*keys).distinct(), keys)
        out = out.unionByName(fresh.withColumn("channel", F.lit(name)), allowMissingColumns=True)
    return out


def appeal_state(subject: str, text: str, reject_text: str) -> Column:
    """Outcome by the words of the answer; no answer counts as rejected."""
    t = F.col(text)
    return case_first(
        [
            (t.rlike(reject_text), "Rechazado"),
            (F.col(subject).rlike(vocab.APPEAL_REJECT_SUBJECT), "Rechazado"),
            (t.isNull(), "Rechazado"),
            (t.rlike(vocab.APPEAL_ACCEPT_TEXT), "Aceptado"),
        ],
        "Por validar",
    )


def drop_superseded(df: DataFrame, key: str, state: str, cols: Sequence[str], accepted: str = "Aceptado") -> DataFrame:
    """Clear amounts of undecided rows whose order also has an accepted one."""
    s = F.col(state)
    out = attach_group(df, [key], F.count_distinct(s).alias("_n"), F.max((s == accepted).cast("int")).alias("_ok"))
    gone = (s != accepted) & (F.col("_n") > 1) & (F.col("_ok") == 1)
    return out.withColumns({c: F.when(~gone, F.col(c)) for c in cols}).drop("_n", "_ok")


def share_payment(df: DataFrame, key: str, state: str, amount: str, income: str, paid: str, accepted: str = "Aceptado") -> DataFrame:
    """Clear superseded amounts, split the rest over the rows that carry one, relate it to the income.

    Everything about the order comes from one aggregate: whether it has an
    accepted row beside others, and how many rows carry an amount among all and
    among the accepted ones.
    """
    s, v = F.col(state), F.col(amount)
    ok = s == accepted
    out = attach_group(
        df, [key], F.count_distinct(s).alias("_n"), F.max(ok.cast("int")).alias("_ok"),
        F.count(F.when(v != 0, 1)).alias("_rows"), F.count(F.when(ok & (v != 0), 1)).alias("_ok_rows"),
    )
    mixed = (F.col("_n") > 1) & (F.col("_ok") == 1)
    kept, rows = F.when(~(mixed & (s != accepted)), v), F.when(mixed, F.col("_ok_rows")).otherwise(F.col("_rows"))
    share = F.round(F.try_divide(F.coalesce(kept, F.col(paid)), F.col(income)), 2)
    out = out.withColumns({"acceptance": share, amount: F.try_divide(kept, rows)})
    return out.drop("_n", "_ok", "_rows", "_ok_rows")


def acceptance_band(c: str) -> Column:
    return bands(c, vocab.ACCEPTANCE_BANDS)


def return_motive(reason: str) -> Column:
    """Broad motive of a return reason."""
    r = F.col(reason)
    return case_first([(r.isin(*words), label) for label, words in vocab.RETURN_MOTIVES.items()], vocab.RETURN_MOTIVE_OTHER)


def business_unit(store: str, chains: Sequence[str], counters: str = vocab.COUNTER) -> Column:
    """Business unit of the store that took a return: the first chain named in it, home pickup, or a counter (a pattern)."""
    s = F.col(store)
    named = [(F.contains(s, F.lit(n)), n) for n in (*chains, vocab.HOME_PICKUP)]
    return case_first(named + [(s.rlike(counters), vocab.COUNTER), (s == "NA", "NA")], "Otro")


def return_flow(store: str, reason_category: str, chains: Sequence[str]) -> Column:
    """The way a return came in: picked up at home, brought to a store of a chain, or never delivered."""
    s = F.col(store)
    return case_first(
        [
            (s == vocab.HOME_PICKUP, "Devoluciones - Home Pickup"),
            *[(F.contains(s, F.lit(n)), "Devoluciones - Tienda") for n in chains],
            (F.col(reason_category).rlike("NON_SHOW"), "Fallo de entrega"),
        ],
        "Otro",
    )


def mark_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column | None = None) -> DataFrame:
    """Appeal number per line, the last number, and whether the line was appealed again."""
    block = natural_block(df, order[0]) if block is None else block
    out = blocked_window(df, keys, order, block, row_number="n_appeal", group_count="max_appeal")
    return out.withColumn("re_appeal", F.when(F.col("max_appeal") > 1, "Si").otherwise("No"))


def appeals(channels: Sequence[tuple[str, DataFrame]], orders: DataFrame, block: Column | None = None, chains: Sequence[str] = (), counters: str = vocab.COUNTER) -> DataFrame:
    """Appeals with state clean-up, payment share, motive, repeats and lead time.

    channels: appeal_id, order_id, sku, requested_at, resolved_at, state, value,
    reason, store, reason_category; orders: order_id, sku, paid_price, income;
    chains: names of the store chains; counters: pattern of the counters' names.
    """
    rows = merge_channels(channels, ["order_id", "sku"])
    rows = attach_one(rows, orders, ["order_id", "sku"])
    rows = share_payment(rows, "order_id", "state", "value", "income", "paid_price")
    rows = rows.withColumns(
        {
            "acceptance_band": acceptance_band("acceptance"),
            "motive": return_motive("reason"),
            "business_unit": business_unit("store", chains, counters),
            "flow": return_flow("store", "reason_category", chains),
            "lead_days": F.datediff("resolved_at", "requested_at"),
        }
    )
    return mark_repeats(rows, ["order_id", "sku"], ["requested_at", "appeal_id"], block)
