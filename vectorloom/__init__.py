"""vectorloom: text embedding, vector storage and vector search as Spark jobs."""

from vectorloom.operators.embed import register_provider
from vectorloom.operators.prepare import PrepareSettings
from vectorloom.operators.store import VectorStore
from vectorloom.plans.pipeline import build_index, get_embedding, ingest, search_index, search_similar
from vectorloom.session import build_session

__all__ = [
    "PrepareSettings",
    "VectorStore",
    "build_index",
    "build_session",
    "get_embedding",
    "ingest",
    "register_provider",
    "search_index",
    "search_similar",
]
