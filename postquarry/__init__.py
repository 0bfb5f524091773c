"""Spark operators for archived post streams and the annotation work built on them."""

from postquarry.session import build_session

__all__ = ["build_session"]
