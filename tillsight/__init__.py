"""Retail spend analytics expressed as Spark DataFrame plans."""

from tillsight.session import build_session

__all__ = ["build_session"]
