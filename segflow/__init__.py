"""Segmented-message and document analytics on Spark DataFrames."""

from segflow.config import PipelineConfig
from segflow.plans.document_text import documents_to_text
from segflow.plans.documents import DocumentPipeline
from segflow.plans.messages import MessagePipeline
from segflow.streaming.refresh import refresh

__all__ = ["DocumentPipeline", "MessagePipeline", "PipelineConfig", "documents_to_text", "refresh"]
