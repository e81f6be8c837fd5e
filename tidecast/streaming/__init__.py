"""Event-time windows, idempotent batch sinks and the streaming jobs that connect them."""
