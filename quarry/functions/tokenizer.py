"""Real token counts (P15) and token clipping (P16) with a user-supplied
``tokenizer.json`` (Hugging Face ``tokenizers`` format).

Both are iterator Pandas UDFs: the tokenizer is loaded once per Python
worker and whole Arrow batches are encoded with ``encode_batch``.  They
are the only Python on the data path, so put them after every cheap
filter (the QC cascade applies its counter only to rows that survive the
dedupe).  Without a tokenizer file, use the char/4 estimate in
``text.token_estimate`` - there is no silent fallback.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf


def _load(path: str):
    from tokenizers import Tokenizer  # optional dependency, imported on executors
    return Tokenizer.from_file(path)


def token_count(tokenizer_path: str, special: bool = False):
    """UDF: number of tokens of a string column (``add_special_tokens``
    follows ``special``)."""
    @pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = _load(tokenizer_path)
        for s in batches:
            texts = s.fillna("").tolist()
            enc = tok.encode_batch(texts, add_special_tokens=special)
            yield pd.Series([len(e.ids) for e in enc])
    return count


def token_clip(tokenizer_path: str, cap: int):
    """UDF: keep the first ``cap`` tokens and decode them back to text."""
    @pandas_udf("string")
    def clip(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = _load(tokenizer_path)
        for s in batches:
            texts = s.fillna("").tolist()
            enc = tok.encode_batch(texts, add_special_tokens=False)
            out = [t if len(e.ids) <= cap else tok.decode(e.ids[:cap], skip_special_tokens=False)
                   for t, e in zip(texts, enc)]
            yield pd.Series(out)
    return clip


def messages_counter(tokenizer_path: str, render=None):
    """A ``counter`` for ``quality.qc``: tokens of the rendered chat."""
    from .text import render_chat
    udf = token_count(tokenizer_path, special=True)
    r = render or render_chat

    def counter(messages: Column) -> Column:
        return udf(r(messages))
    return counter


__all__ = ["token_count", "token_clip", "messages_counter"]
