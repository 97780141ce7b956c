"""Every query of the engine by name, with its SQL where SQL can say it."""

from __future__ import annotations

from acequia.plans import corpus_queries, model_queries, score_sql, shape_queries, source_queries, text_queries

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _part in (text_queries, corpus_queries, model_queries, shape_queries, source_queries, score_sql):
    QUERIES.update(_part.QUERIES)
    ORACLES.update(_part.ORACLES)
