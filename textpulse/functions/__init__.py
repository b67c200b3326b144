from textpulse.functions.buckets import md5_bucket
from textpulse.functions.decode import (
    binary_sentiment,
    decode_class,
    iso_timestamp,
    request_sentiment,
    stream_sentiment,
)
from textpulse.functions.text import (
    clean_text,
    is_lexical_word,
    lexicon_pos,
    lower_words,
    name_heads,
    ngrams,
    surface_tokens,
    word_count,
)
from textpulse.functions.tokens import contraction_tokens

__all__ = [
    "binary_sentiment",
    "clean_text",
    "contraction_tokens",
    "decode_class",
    "is_lexical_word",
    "iso_timestamp",
    "lexicon_pos",
    "lower_words",
    "md5_bucket",
    "name_heads",
    "ngrams",
    "request_sentiment",
    "stream_sentiment",
    "surface_tokens",
    "word_count",
]
