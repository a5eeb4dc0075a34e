"""Backlog ageing and the audiences that are told about it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.dates import as_date, cutoff
from ..operators.joins import attach, exclude_keys, flag_by_group
from ..operators.rules import case_first, ranges
from ..operators.windows import with_sequence


def age(df: DataFrame, target: str, as_of: str) -> DataFrame:
    """Days late, the general state and the action that is due."""
    late = F.datediff(as_date(as_of), target)
    general = case_first([(late >= 30, "Cambio de estado"), (late > 0, "En retraso")], "Orden en tiempo")
    return df.withColumns({"days_late": late, "general_state": general, "action": F.coalesce(ranges(late, vocab.BACKLOG_ACTIONS), F.lit("NA"))})


def speech(df: DataFrame, seller: str, status: str) -> DataFrame:
    """Text segment of a seller by the mix of states among its open orders.

    One aggregate per seller joined back, instead of three sub-queries.
    """
    s = F.col(status)
    flags = {
        "_two": F.count_distinct(s) == 2,
        "_ready": (F.count_distinct(s) == 1) & (F.count(F.when(s == "ready_to_ship", 1)) > 0),
        "_pending": F.count(F.lit(1)) == F.count(F.when(s == "pending", 1)),
    }
    out = flag_by_group(df, seller, flags)
    text = case_first([(F.col("_two"), "Speech_2"), (F.col("_ready"), "Speech_3"), (F.col("_pending"), "Speech_4")], "Otro caso")
    return out.withColumn("speech", text).drop(*flags)


def afternoon_speech(df: DataFrame, seller: str, status: str, segment: str) -> DataFrame:
    """The afternoon's text segment: by the seller's segment first, then by the mix of states."""
    seg, s = F.col(segment), F.col(status)
    flags = {
        "_other": F.count(F.when(seg != "AAA", 1)) > 0,
        "_mixed": (F.count_distinct(seg) == 1) & (F.count_distinct(s) > 1),
        "_pending": F.count(F.lit(1)) == F.count(F.when(s == "pending", 1)),
    }
    out = flag_by_group(df, seller, flags)
    text = case_first([(F.col("_other"), "Speech_3"), (F.col("_mixed"), "Speech_2"), (F.col("_pending"), "Speech_4")], "Otro caso")
    return out.withColumn("speech", text).drop(*flags)


def backlog_report(
    orders: DataFrame,
    tracking: DataFrame,
    sellers: DataFrame,
    test_sellers: DataFrame,
    as_of: str,
    carriers: Sequence[str] = ("ibis", "urbano"),
    links: Mapping[str, str] | None = None,
    slot: str = "am",
) -> DataFrame:
    """Orders to act on, with action, seller contact and the text segment of the slot.

    orders: order_id, seller_id, tracking_code, src_status, status, carrier,
    shipment_type, target_to_ship, updated_at; tracking: tracking_code, state;
    sellers: seller_id, segment, email, phone, dropoff; test_sellers: seller_id.
    """
    c = F.col
    open_ = orders.where(
        c("src_status").isin(*vocab.BACKLOG_OPEN_STATES)
        & c("carrier").isin(list(carriers))
        & (c("shipment_type") != 1)
        & ~c("status").isin("delivered", "canceled", "failed")
        & (c("updated_at") <= F.lit(cutoff(as_of)).cast("timestamp_ntz"))
    )
    # a state is required below, so this is an inner join with the allowed states
    moving = tracking.where(~c("state").isin("Anulado", "Retorno a seller")).select("tracking_code", c("state").alias("tracking_state"))
    known = exclude_keys(open_, "seller_id", test_sellers).join(moving, "tracking_code")
    aged = age(known, "target_to_ship", as_of).where(~c("action").isin(*vocab.BACKLOG_SILENT))
    known = attach(aged, sellers, ["seller_id"])
    out = speech(known, "seller_id", "status") if slot == "am" else afternoon_speech(known, "seller_id", "status", "segment")
    out = out.withColumns(
        {
            "delay_text": case_first([(c("action") == k, v) for k, v in vocab.BACKLOG_DELAY_TEXT.items()]),
            "carrier": F.when(c("dropoff").isNotNull(), "dropoff").otherwise(c("carrier")),
        }
    )
    if links:
        out = out.withColumn("link", case_first([(c("phone") == k, v) for k, v in links.items()]))
    return out


def campaign_rules(segment="segment", speech="speech", carrier="carrier", delay="delay_text", status="status") -> list[tuple[str, Column]]:
    """(campaign, condition) pairs; a row may belong to several campaigns."""
    seg, sp, car, late, st = (F.col(x) for x in (segment, speech, carrier, delay, status))
    top, known_delay = seg == "AAA", late.isin("A tiempo", "1 dia de retraso", "2 dias de retraso", "3 dias de retraso")
    drop = car == "dropoff"
    return [
        ("mail_top", top & ~drop),
        ("mail_route_delay_pending", ~top & (sp == "Speech_2") & ~drop),
        ("mail_route_delay", ~top & (sp == "Speech_3") & ~drop),
        ("mail_pending", ~top & (sp == "Speech_4")),
        ("mail_dropoff", ~top & drop & known_delay),
        ("mail_top_dropoff", top & drop & (st != "pending") & known_delay),
        ("chat_top_delay", top & ~drop & late.isin("1 dia de retraso", "2 dias de retraso", "3 dias de retraso")),
    ]


def afternoon_rules(status: str = "status") -> list[tuple[str, Column]]:
    """The afternoon only writes about pending orders."""
    return [("mail_pending", F.col(status) == "pending")]


def alert_rows(backlog: DataFrame, campaigns: Sequence[tuple[str, Column]], email: str = "email", action: str = "action") -> DataFrame:
    """Backlog rows with a usable address, once per campaign they belong to."""
    usable = backlog.where(F.col(email).contains("@") & ~F.col(action).isin(*vocab.BACKLOG_SILENT))
    names = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in campaigns]))
    return usable.withColumn("campaign", F.explode(names))


def alert_audiences(rows: DataFrame, seller: str, order: str, min_orders: int = 1) -> DataFrame:
    """Size of each seller's message per campaign; small ones are left out."""
    sizes = rows.groupBy("campaign", seller).agg(F.count_distinct(order).alias("orders"), F.count(F.lit(1)).alias("lines"))
    return sizes.where(F.col("orders") >= min_orders)


def alert_payload(rows: DataFrame, audience: DataFrame, seller: str, line: Sequence[str], page: int = 500) -> DataFrame:
    """Messages as pages of at most ``page`` lines per (campaign, seller).

    A seller with very many orders gets several pages, so no task ever holds all
    lines of one seller: lines are numbered block by block of their hash.
    """
    kept = rows.join(audience.select("campaign", seller, "orders", "lines"), ["campaign", seller])
    kept = kept.withColumn("_part", F.pmod(F.xxhash64(*line), F.ceil(F.col("lines") / page)))
    numbered = with_sequence(kept, ["campaign", seller], ["_part", *line], "_n", F.col("_part"))
    paged = numbered.withColumn("page", F.floor((F.col("_n") - 1) / page))
    return paged.groupBy("campaign", seller, "page").agg(F.sort_array(F.collect_list(F.struct(*line))).alias("rows"))


def amount_alerts(orders: DataFrame, seller: str, amount: str, above: float = 10_000) -> DataFrame:
    """Sellers whose order amount exceeds a limit."""
    return orders.groupBy(seller).agg(F.sum(amount).alias("total")).where(F.col("total") > above)
