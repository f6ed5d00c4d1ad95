"""Ingestion, quality and analytics of product reviews on Spark DataFrames."""

from tidemark.plans.ingest import IngestConfig, IngestResult, ingest
from tidemark.session import build_session

__all__ = ["IngestConfig", "IngestResult", "build_session", "ingest"]
