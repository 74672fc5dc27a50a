"""Every registered query and its twin."""

from __future__ import annotations

from verification.oracle_base import with_ctes
from verification.oracle_models import MODELS
from verification.oracle_quality import QUALITY
from verification.oracle_sources import SOURCES
from verification.oracle_streaming import STREAMS
from verification.queries_models import MODEL_QUERIES
from verification.queries_quality import QUALITY_QUERIES
from verification.queries_sources import SOURCE_QUERIES
from verification.queries_streaming import STREAM_QUERIES

QUERIES = {**SOURCE_QUERIES, **MODEL_QUERIES, **QUALITY_QUERIES, **STREAM_QUERIES}
ORACLE = {
    key: with_ctes(sql) for key, sql in {**SOURCES, **MODELS, **QUALITY, **STREAMS}.items()
}
