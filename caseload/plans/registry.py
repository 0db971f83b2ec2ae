"""Query registry: name -> (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from caseload.plans.inputs import finalize


@dataclass
class Registered:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    proof: str  # "O" oracle, "R" rows-only + invariant tests


REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
            return finalize(_fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Registered(name, run, sql, "O" if sql else "R")
        return fn
    return deco


def R(expr: str, alias: str | None = None) -> str:
    """SQL: rounded double column (matches ``finalize``)."""
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0) AS {alias or expr}"


def B(expr: str, alias: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias or expr}"


def load_all():
    # import for side effects: each module registers its queries
    from caseload.plans import q_panel, q_s2, q_hurdle, q_ops, q_eval, q_audit, q_outcomes, q_models, q_explore, q_contracts, q_sidecars  # noqa: F401
    return REGISTRY
