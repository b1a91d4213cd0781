"""Structured Streaming variants of the batch reports (incremental L1)."""

from .daily_revenue import (daily_purchase_revenue, daily_purchase_revenue_stream,  # noqa: F401
                            run_available_now)
from .folder_profile import folder_profile_stream  # noqa: F401,E402
