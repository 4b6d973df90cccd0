"""Column expressions shared by all operators (JVM-side, codegen friendly)."""

from corpusmill.functions.text import (  # noqa: F401
    TOKEN_SPLIT,
    char_grams,
    normalise_text,
    round_score,
    stable_hash,
    tokens,
    word_ngrams,
)
