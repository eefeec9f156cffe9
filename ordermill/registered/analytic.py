"""The analytical queries on every layout, and with drawn parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import twin_sql as twin
from ordermill.plans.catalog import ANALYTIC
from ordermill.plans.fixture_params import FIXTURE_DOMAINS, FIXTURE_PARAMS
from ordermill.plans.layouts import LAYOUTS
from ordermill.plans.parameters import draw
from ordermill.registered import Entries, Query
from ordermill.sources.store import loaded_store

# Queries that read customer fields and so differ on the top-level layout.
TOPLEVEL_QUERIES = ("q03", "q05", "q07", "q08", "q10", "q18", "q22")
DRAW_SEED = 3


def _plain_address(df: DataFrame) -> DataFrame:
    """Struct addresses as one text, so that results compare by value."""
    if dict(df.dtypes).get("su_address", "").startswith("struct"):
        return df.withColumn("su_address", F.concat_ws(", ", "su_address.*"))
    return df


def _analytic(name: str, layout: str, params: dict) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_address(ANALYTIC[name](LAYOUTS[layout](loaded_store(spark, sf_dir)), **params))

    return run


def entries() -> Entries:
    found: Entries = {}
    for name in ANALYTIC:
        params = FIXTURE_PARAMS[name]
        sql = twin.analytic_sql(name, params)
        found[name] = (_analytic(name, "nested", params), sql)
        found[f"{name}_flat"] = (_analytic(name, "flat", params), sql)
        if name in TOPLEVEL_QUERIES:
            found[f"{name}_toplevel"] = (_analytic(name, "toplevel", params), sql)
    for name in ANALYTIC:
        if name == "q21":
            continue  # the drawn form of q21 counts lines
        drawn = draw(name, FIXTURE_DOMAINS, DRAW_SEED)
        label = "params_q21" if name == "q21_lines" else f"params_{name}"
        found[label] = (_analytic(name, "nested", drawn), twin.analytic_sql(name, drawn))
    return found
