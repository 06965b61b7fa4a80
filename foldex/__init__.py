"""Keyed, searchable index tables from nested documents and ordered change feeds, on Spark."""

from foldex.functions.analysis import STANDARD, Analyzer, stop_words
from foldex.model import (
    EMBEDDED,
    FULL_REPLACE,
    PARTIAL_UPDATE,
    ApplyPolicy,
    ExtenderContext,
    FieldRule,
    IndexConfig,
    MappingError,
)
from foldex.operators.fold import allow_collections, apply_changes, clear_collections, fold, fold_keys
from foldex.operators.project import index_documents, project
from foldex.operators.read import IndexView, all_of, match_all
from foldex.plans.store import IndexStore
from foldex.streaming.service import IndexService

__all__ = [
    "EMBEDDED", "FULL_REPLACE", "PARTIAL_UPDATE", "STANDARD", "Analyzer", "ApplyPolicy",
    "ExtenderContext", "FieldRule", "IndexConfig", "IndexService", "IndexStore", "IndexView",
    "MappingError", "all_of", "allow_collections", "apply_changes", "clear_collections", "fold",
    "fold_keys", "index_documents", "match_all", "project", "stop_words",
]
