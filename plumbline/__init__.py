"""plumbline: data-quality measurement and repair as Spark DataFrame operators."""

from plumbline.session import build_session, checkpoint

__all__ = ["build_session", "checkpoint"]
