"""Support cases: claims, enrichment, task logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.dates import as_date, days_between, hours_crossed, work_time
from ..operators.joins import attach, effective_lookup, explode_matches
from ..operators.keys import dominant_label, latest_per_key
from ..operators.reshape import single_or_list
from ..operators.rules import case_first, classify
from ..operators.windows import blocked_window, natural_block


def claim_outcomes(claims: DataFrame) -> DataFrame:
    """Outcome of each team's comment and the first decisive one.

    claims: comment_support, comment_aftersales, comment_sx, closing_comment
    (already folded and lower case).
    """
    c = F.col
    out = claims.withColumns(
        {
            "outcome_support": classify("comment_support", vocab.CLAIM_RULES_SUPPORT),
            "outcome_aftersales": classify("comment_aftersales", vocab.CLAIM_RULES_AFTERSALES),
            "outcome_sx": classify("comment_sx", vocab.CLAIM_RULES_SELLER_TEAM),
            "outcome_case": classify("closing_comment", vocab.CLAIM_RULES_CLOSING),
        }
    )
    decisive = lambda n, word: F.when(c(n) != word, c(n))
    return out.withColumn(
        "outcome",
        F.coalesce(
            decisive("outcome_sx", vocab.CLAIM_NOT_DECISIVE["sx"]),
            decisive("outcome_aftersales", vocab.CLAIM_NOT_DECISIVE["aftersales"]),
            "outcome_support",
            "outcome_case",
        ),
    )


def age_outcome(df: DataFrame, as_of: str) -> DataFrame:
    """Late refunds, system errors, and silent sellers after their grace period.

    df: outcome, comment_support, segment, fecha_ingreso, fecha_egreso,
    status_platform, status_tms, status_store.
    """
    c = F.col
    late = c("comment_support").isNull() & (days_between("fecha_egreso", "fecha_ingreso") > 30)
    open_ = c("outcome").isNull()
    rules = [
        (late, vocab.CLAIM_LATE_REFUND),
        (open_ & (c("status_platform") == "CANCELLED") & (c("status_tms") == "Entregado"), vocab.CLAIM_SYSTEM_ERROR),
        (open_ & (c("status_platform") == "CANCELLED") & (c("status_store") == "DELIVERED"), vocab.CLAIM_SYSTEM_ERROR),
    ]
    for segments, days in vocab.CLAIM_AGEING:
        rules.append((open_ & c("segment").isin(*segments) & (F.datediff(as_date(as_of), c("fecha_egreso")) >= days), vocab.CLAIM_SILENT_SELLER))
    return df.withColumn("outcome", case_first(rules, c("outcome")))


def balance_bearer(outcome: str, return_state: str) -> Column:
    """Who bears a balance: the seller where the goods are on their way back, else by the outcome of the claim.

    Null while neither says so.
    """
    state, (seller, back) = F.col(return_state), vocab.BEARER_BY_RETURN
    rules = [(state.isin(*back), seller)]
    return case_first(rules + [(F.col(outcome).isin(*words), who) for who, words in vocab.BEARER_BY_OUTCOME.items()])


def resolve_claims(claims: DataFrame, comments: DataFrame) -> DataFrame:
    """Claims with the newest comment of each team and their outcome.

    claims: case_id, order_id, closing_comment; comments: case_id, team
    ('support', 'aftersales', 'sx'), comment, created_at, comment_id.
    """
    newest = latest_per_key(comments, ["case_id", "team"], [F.desc("created_at"), F.desc("comment_id")])
    wide = newest.groupBy("case_id").agg(
        *[F.max(F.when(F.col("team") == t, F.col("comment"))).alias(f"comment_{t}") for t in ("support", "aftersales", "sx")]
    )
    return claim_outcomes(attach(claims, wide, ["case_id"]))


def mentioned_orders(cases: DataFrame, patterns: Sequence[tuple[str, str]] = vocab.ORDER_MENTIONS) -> DataFrame:
    """(case_id, order_id) for every order number a case mentions."""
    return explode_matches(cases, ["case_id"], patterns, "order_id").distinct()


def stakeholder(document: str, seller: str) -> Column:
    d, s = F.col(document), F.col(seller)
    return case_first([(d.isNull() & s.isNotNull(), "Seller"), (d.isNotNull(), "Customer")], "Other")


def case_times(cases: DataFrame, as_of: str) -> DataFrame:
    """Hours to complete, hours against the due date, working time, and lateness.

    cases: created_at, due_at, closed_at; open cases are measured up to
    ``as_of``.
    """
    end = F.coalesce(F.col("closed_at"), F.lit(as_of).cast("timestamp_ntz"))
    return cases.withColumns(
        {
            "due_hours": hours_crossed("due_at", "created_at"),
            "completion_hours": hours_crossed(end, "created_at"),
            "diff_due_hours": hours_crossed(end, "due_at"),
            "work": work_time(end, "created_at"),
            "late": F.when(end > F.col("due_at"), 1).otherwise(0),
        }
    )


def case_report(
    cases: DataFrame, orders: DataFrame, as_of: str, sla_rules: DataFrame | None = None, owner_rules: DataFrame | None = None, patterns=vocab.ORDER_MENTIONS
) -> DataFrame:
    """Cases with the orders they mention, the sellers behind them, times and SLA.

    cases: case_id, type, owner, created_at, due_at, closed_at and the text
    columns of ``patterns``; orders: order_id, seller_id, customer, sku, value;
    sla_rules: type, sla_hours, valid_from, valid_to; owner_rules: owner,
    department, valid_from, valid_to.
    """
    details = mentioned_orders(cases, patterns).join(orders, "order_id", "left")
    sums = [
        F.max("seller_id").alias("seller_id"), F.sum("value").alias("value"), F.count_distinct("order_id").alias("orders"), F.count_distinct("sku").alias("skus")
    ]
    out = attach(cases, single_or_list(details, ["case_id"], ["customer", "order_id", "sku"], more=sums), ["case_id"])
    out = case_times(out, as_of)
    if sla_rules is not None:
        out = effective_lookup(out, sla_rules, ["type"], "created_at", "valid_from", "valid_to")
        out = out.withColumn("sla_met", F.when(F.col("completion_hours") <= F.col("sla_hours"), "Si").when(F.col("sla_hours").isNotNull(), "No"))
    if owner_rules is not None:
        out = effective_lookup(out, owner_rules, ["owner"], "created_at", "valid_from", "valid_to", {"department": "Other"})
    return out


def team_of_owner(tasks: DataFrame) -> DataFrame:
    """Team each task owner works for most."""
    return dominant_label(tasks, "owner", "team", "task_id", "tasks").select("owner", F.col("team").alias("dominant_team"))


def task_log(tasks: DataFrame, as_of: str, block: Column | None = None) -> DataFrame:
    """Tasks of a case in order, with their hours and the running total.

    tasks: case_id, task_id, owner, team, created_at, completed_at.  Tasks
    created at the same time share the running total.
    """
    end = F.coalesce(F.col("completed_at"), F.lit(as_of).cast("timestamp_ntz"))
    block = natural_block(tasks, "created_at") if block is None else block
    timed = tasks.withColumn("task_hours", hours_crossed(end, "created_at"))
    numbered = blocked_window(
        timed, ["case_id"], ["created_at", "task_id"], block, row_number="task_number",
        sums={"cumulative_hours": F.col("task_hours")}, range_frame=True, range_order=["created_at"],
    )
    return attach(numbered, team_of_owner(tasks), ["owner"])
