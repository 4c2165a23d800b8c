"""Tidemark: analytics operators written on the public PySpark APIs."""

from tidemark.session import build_session, pin_session, scratch_path, stored

__all__ = ["build_session", "pin_session", "scratch_path", "stored"]
