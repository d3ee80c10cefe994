"""Column-level building blocks (built-in Spark expressions only)."""

from reelscope.functions.text import (normalize_text, padded, parse_channels, strip_quotes,
                                      title_key, tokens, word_tokens)
from reelscope.functions.casts import (epoch_to_timestamp, parse_added_date, safe_int,
                                       safe_long, to_id)
from reelscope.functions.synthetic import (bounded, comment_hex, digest, hash60, hash_int,
                                           instant_from, letters_from_hex)

__all__ = [
    "normalize_text", "padded", "parse_channels", "strip_quotes", "title_key", "tokens",
    "word_tokens",
    "epoch_to_timestamp", "parse_added_date", "safe_int", "safe_long", "to_id",
    "bounded", "comment_hex", "digest", "hash60", "hash_int", "instant_from",
    "letters_from_hex",
]
