"""Token counts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from logweft.config import WindowConfig
from logweft.fixed_values import SIMPLE_CHARS_PER_TOKEN


def simple_tokens(text: Column) -> Column:
    """One token per four characters, at least one."""
    return F.greatest(F.lit(1).cast("long"), F.call_function("div", F.length(text), F.lit(SIMPLE_CHARS_PER_TOKEN)))


def bpe_available(encoding: str) -> bool:
    try:
        import tiktoken

        tiktoken.get_encoding(encoding)
        return True
    except Exception:
        return False


def bpe_counter(encoding: str):
    """Function from a text to its byte-pair token count."""
    import tiktoken

    encoder = tiktoken.get_encoding(encoding)

    def count(text: str) -> int:
        try:
            return len(encoder.encode(text))
        except ValueError:  # the encoder refuses texts that spell out its control marks
            return max(1, len(text) // SIMPLE_CHARS_PER_TOKEN)

    return count


def bpe_tokens(text: Column, encoding: str) -> Column:
    """Byte-pair token count; needs the vocabulary on every executor."""

    @F.pandas_udf("long")
    def count(values: pd.Series) -> pd.Series:
        return values.map(bpe_counter(encoding), na_action="ignore")

    return count(text)


def count_tokens(text: Column, config: WindowConfig | None = None) -> Column:
    """Token count under ``config``: byte pairs, which need the vocabulary, or the simple estimate."""
    config = config or WindowConfig()
    if config.tokenizer != "bpe":
        return simple_tokens(text)
    if not bpe_available(config.encoding):
        raise ValueError(f"no vocabulary for {config.encoding}; install it, or choose tokenizer='simple'")
    return bpe_tokens(text, config.encoding)
