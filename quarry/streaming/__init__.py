"""Streaming.

The studied workloads are all batch jobs: no watermark, window, state or late-data
handling appears in them, so this package deliberately holds no operators.
"""
