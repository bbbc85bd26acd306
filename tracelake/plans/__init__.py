"""The tables and reports: structlog, structlog_agg, transaction, progress queries, resource gas."""
