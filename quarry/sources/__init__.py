"""Readers (JSONL logs and chats, source files, exported commits/diffs) and
JSONL writers."""
