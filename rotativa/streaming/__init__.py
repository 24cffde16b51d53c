"""Structured Streaming: arriving files, incremental loading, a running summary.

Every stream keeps its progress in a checkpoint in the shared folder, so a run
that is started again goes on where the last committed one ended.
"""
