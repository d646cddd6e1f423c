"""Web-analytics engine on Spark tables: landed reports -> bronze -> silver -> gold views, measures and weekly KPIs."""

from .config import Settings

__all__ = ["Settings"]
