"""EXPLAIN: the relations, the text a source could run, what stays local, and Spark's own plan. Also logging of the text."""

from __future__ import annotations

import contextlib
import io
import logging

from pyspark.sql import DataFrame, SparkSession

from ..catalog import Catalog
from ..settings import Settings
from .spec import QuerySpec

log = logging.getLogger("sparkfed")


def explain(spark: SparkSession, catalog: Catalog, query: QuerySpec, settings: Settings | None = None, verbose: bool = True) -> str:
    text = query.report(catalog, settings, explain=True).text(verbose)
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        query.dataframe(spark, catalog, settings).explain("formatted" if verbose else "simple")
    return f"{text}\n{plan.getvalue()}"


def run(spark: SparkSession, catalog: Catalog, query: QuerySpec, settings: Settings | None = None) -> DataFrame:
    """The query's rows; its remote text is logged where a server asks for that. Passwords are in no text."""
    if any(catalog.resolve(t.name)["log_remote_sql"] for t in query.source.tables()):
        for x in query.report(catalog, settings).remote:
            log.info("Remote SQL: %s", x)
    return query.dataframe(spark, catalog, settings)


def strip_row_locks(sql: str) -> str:
    """SQL text without FOR UPDATE or FOR SHARE, which lock nothing here."""
    import re

    return re.sub(r"\s+FOR\s+(NO\s+KEY\s+UPDATE|UPDATE|KEY\s+SHARE|SHARE)(\s+OF\s+[\w, ]+)?(\s+(NOWAIT|SKIP\s+LOCKED))?\s*;?\s*$", "", sql, flags=re.I)


def rewrite_quantified(sql: str) -> str:
    """`= ANY (SELECT` and `<> ALL (SELECT` as IN and NOT IN."""
    import re

    sql = re.sub(r"=\s*(ANY|SOME)\s*\(\s*SELECT", "IN (SELECT", sql, flags=re.I)
    return re.sub(r"(<>|!=)\s*ALL\s*\(\s*SELECT", "NOT IN (SELECT", sql, flags=re.I)
