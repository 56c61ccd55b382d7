"""Column expressions: calendar/clock parts and delivery metrics."""

from parcelflow.functions import calendar, metrics

__all__ = ["calendar", "metrics"]
