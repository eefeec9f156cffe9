"""Batches of business requests in the usual mix, as input of the transaction jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.draws import Draw, last_name, nurand
from ordermill.functions.expr import ts
from ordermill.synth.tables import Scale

c = F.col

# Shares of a hundred, and the other shares of the parameter rules.
SHARES = [("stock_level", 4), ("delivery", 4), ("order_status", 4), ("payment", 43), ("new_order", 45)]
BY_NAME = 60
OWN_WAREHOUSE = 85
REMOTE_ITEM = 1


def request_mix(spark: SparkSession, n: int, scale: Scale, seed: int = 0, at: str = "2021-01-01 00:00:00") -> DataFrame:
    """``n`` numbered requests with the parameters of every kind; ``requests_of`` picks a kind."""
    seq = c("seq")
    draw = Draw(seed, "request", seq)
    constant = Draw(seed, "request.constant")

    percent = draw.number("kind", 1, 100)
    kind, reached = None, 0
    for name, share in SHARES:
        reached += share
        kind = F.when(percent <= reached, name) if kind is None else kind.when(percent <= reached, name)

    def skewed(tag: str, a: int, low: int, high: int, d: Draw) -> Column:
        return nurand(d.below(f"{tag}|", a + 1), d.number(tag, low, high), constant.below(tag, a + 1), low, high)

    def other_warehouse(d: Draw, own: Column) -> Column:
        """Any warehouse but ``own``, each as likely."""
        if scale.warehouses == 1:
            return own
        step = 1 + d.below("other", scale.warehouses - 1)
        return scale.first_warehouse + (own - scale.first_warehouse + step) % scale.warehouses

    w = scale.first_warehouse + draw.below("w", scale.warehouses)
    customer = skewed("c", 1023, 1, scale.customers, draw)
    highest = min(999, scale.customers - 1)
    name = last_name(skewed("last", 255, 0, highest, draw))
    named = (draw.number("by_name", 1, 100) <= BY_NAME) & kind.isin("payment", "order_status")
    remote = draw.number("remote", 1, 100) > OWN_WAREHOUSE

    def line(i: Column) -> Column:
        d = draw.at(i)
        far = d.number("far", 1, 100) <= REMOTE_ITEM
        return F.struct(
            skewed("item", 8191, 1, scale.items, d).alias("i_id"),
            F.when(far, other_warehouse(d, c("w_id"))).otherwise(c("w_id")).alias("w_id"),
            d.number("qty", 1, 50).alias("qty"),
        )

    first = spark.range(1, n + 1).select(c("id").alias("seq")).select(
        seq, kind.alias("txn"), w.alias("w_id"), draw.number("d", 1, scale.districts).alias("d_id"),
        F.when(~named, customer).alias("c_id"), F.when(named, name).alias("c_last"), remote.alias("_remote"),
    )
    lines = F.transform(F.sequence(F.lit(1), draw.number("lines", 5, 15).cast("int")), line)
    return first.select(
        "seq", "txn", "w_id", "d_id",
        F.when(c("_remote"), other_warehouse(draw, c("w_id"))).otherwise(c("w_id")).alias("c_w_id"),
        F.when(c("_remote"), draw.number("c_d", 1, scale.districts)).otherwise(c("d_id")).alias("c_d_id"),
        "c_id", "c_last", draw.fixed("amount", 2, 1.0, 5000.0).alias("h_amount"),
        draw.number("carrier", 1, 10).alias("o_carrier_id"), draw.number("threshold", 10, 20).alias("threshold"),
        F.timestamp_add("SECOND", seq, ts(at)).alias("at"), F.when(c("txn") == "new_order", lines).alias("lines"),
    )


_COLUMNS = {
    "stock_level": ["w_id", "d_id", "threshold"],
    "delivery": ["w_id", "o_carrier_id", "at AS ol_delivery_d"],
    "order_status": ["w_id", "d_id", "c_id", "c_last"],
    "payment": ["w_id", "d_id", "c_w_id", "c_d_id", "c_id", "c_last", "h_amount", "at AS h_date"],
    "new_order": ["w_id", "d_id", "c_id", "at AS o_entry_d", "lines"],
}


def requests_of(mix: DataFrame, kind: str) -> DataFrame:
    """Requests of one kind with the parameters that kind takes."""
    return mix.where(c("txn") == kind).selectExpr("seq", *_COLUMNS[kind])
