"""Structured Streaming entry points."""

from .hourly_feed import settled_hours, start_hourly_feed, streamed_hours
from .monthly_feed import start_monthly_feed

__all__ = ["settled_hours", "start_hourly_feed", "start_monthly_feed", "streamed_hours"]
