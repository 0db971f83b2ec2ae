"""Shared, materialized stages every registered query starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, ShortType

from caseload.config import DEFAULT_CALENDAR, PanelConfig
from caseload.operators.cadence import build_cadence_panel
from caseload.plans import panel as P
from caseload.plans.stages import materialized, remembered


def active_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months with orders, with their history and the customer's peer cells: the one written table of the panels, whose
    rows are made from it where they are read. Customers with several rows of peer cells get none here (see ``scored``)."""
    def build():
        states = P.history_states(P.active_months(spark, sf_dir))
        peers = P.customer_peers(spark, sf_dir)
        return states.join(peers, "o_custkey", "left") if P.peers_are_unique(peers) else states
    return materialized(spark, "active_months", sf_dir, build)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_quiet_months(active_months(spark, sf_dir))


def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.engineered_panel(facts(spark, sf_dir))


def cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months with orders are dealt by customer and put in order before the quiet ones are added, so no panel row is shuffled."""
    def build():
        months = active_months(spark, sf_dir).repartition("customer_public_id").sortWithinPartitions("customer_public_id", "transaction_month")
        return build_cadence_panel(P.engineered_panel(P.with_quiet_months(months)), DEFAULT_CALENDAR)
    return materialized(spark, "cadence", sf_dir, build)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored panel: a projection of the written months and the written peer cells, so it is not written itself.
    If customers have several rows of peer cells, their months repeat and the history is that of the repeated rows, written."""
    def history():
        return P.history_panel(facts(spark, sf_dir), P.customer_peers(spark, sf_dir), PanelConfig()).select(*P.HISTORY_COLUMNS)

    def build():
        months = active_months(spark, sf_dir)
        one = "channel_peer" in months.columns
        return P.scored_panel(P.history_from_states(months) if one else materialized(spark, "history", sf_dir, history), PanelConfig())
    return remembered(spark, "scored", sf_dir, build)


def finalize(df: DataFrame) -> DataFrame:
    """Output normalization shared with the oracle: doubles rounded to 6 places, ints as bigint."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType, DecimalType)):
            out.append(F.round(c.cast("double"), 6).alias(f.name))
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            out.append(c.cast("bigint").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
