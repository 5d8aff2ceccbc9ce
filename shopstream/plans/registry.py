"""Name -> query callable, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alerting, feeds, joined, queries, streamed
from .oracle import ORACLE


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for mod in (queries, joined, alerting, feeds, streamed):
        for name in dir(mod):
            if name.startswith("q_"):
                out[name[2:]] = getattr(mod, name)
    return dict(sorted(out.items()))


def oracles() -> dict[str, str]:
    names = registered()
    return {k: v for k, v in ORACLE.items() if k in names}
