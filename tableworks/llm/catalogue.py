"""Hands out the queries of this subpackage, the pipeline among them."""

from __future__ import annotations

import corpus_pipeline

from . import queries as catalog


def queries():
    return {**catalog.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql():
    pipeline = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {**catalog.ORACLES, **pipeline}
