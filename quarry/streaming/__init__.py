"""Structured Streaming jobs: incremental export, streaming QC and the
stateful pair builder / follow windows."""
