"""Column expressions: ``expr(col) -> Column``."""

from textloom.functions.scores import (
    argmax, keep_flag, length_bin, length_bin_ord, row_cross_entropy, softmax,
)
from textloom.functions.text import (
    basic_tokens, first_label, first_label_ascii, null_if_token, strip_accents,
    strip_text, text_preview, to_text, token_length, token_preview, truncation_excess,
)

__all__ = [
    "argmax", "basic_tokens", "first_label", "first_label_ascii", "keep_flag",
    "length_bin", "length_bin_ord", "null_if_token", "row_cross_entropy", "softmax",
    "strip_accents", "strip_text", "text_preview", "to_text", "token_length",
    "token_preview", "truncation_excess",
]
