"""Column expressions for labels and text.

Everything here is a native Catalyst expression, so it runs inside
whole-stage codegen; no Python worker is involved.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Label separators: the full-width comma takes precedence over the ASCII comma.
FULLWIDTH_COMMA = "，"
ASCII_COMMA = ","
# Python str.strip() whitespace: \t \n \x0b \x0c \r, \x1c-\x1f, space, \x85,
# \xa0, \u1680, \u2000-\u200a, \u2028, \u2029, \u202f, \u205f, \u3000.
PY_WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# The same set as explicit characters, for ``btrim``.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                 "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# pandas.read_csv default null tokens.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Basic (pre-WordPiece) tokenizer classes: CJK ideograph blocks, punctuation
# (Unicode P* plus the ASCII symbols $ + < = > ^ ` | ~), and white space.
CJK_CLASS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
PUNCT_CLASS = r"\p{P}$+<=>^`|~"
SPACE_CLASS = r"\t\n\x{0B}\f\r \p{Z}"
TOKEN_PATTERN = (
    f"[{CJK_CLASS}]|[{PUNCT_CLASS}]|[^{SPACE_CLASS}{CJK_CLASS}{PUNCT_CLASS}]+"
)
# The same tokens of a text of printable ASCII, tabs and line breaks only: what
# is neither a letter nor a digit there is punctuation. Its few ranges are
# several times faster to match.
PLAIN_TOKEN_PATTERN = "[0-9A-Za-z]+|[!-~]"
SPECIAL_PATTERN = r"[^\t\n\r -~]"
# Special tokens added around every sequence.
N_SPECIAL_TOKENS = 2
PREVIEW_CHARS = 100
PREVIEW_TOKENS = 20
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_text(col) -> Column:
    """Unicode-wide strip with Python ``str.strip()`` semantics."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE))


def has_visible_text(col) -> Column:
    """True when the stripped text would be non-empty: one search for a
    character outside the strip set (usually found at position 0), instead
    of stripping the whole text."""
    return _c(col).rlike("[^" + PY_WHITESPACE_CLASS[1:])


def to_text(col, null_label: str = "drop") -> Column:
    """String cast; ``literal_nan`` turns null into the text ``nan``."""
    s = _c(col).cast("string")
    if null_label == "literal_nan":
        return F.coalesce(s, F.lit("nan"))
    if null_label != "drop":
        raise ValueError("null_label must be 'drop' or 'literal_nan'")
    return s


def first_label(col, null_label: str = "drop") -> Column:
    """First label; the full-width comma wins over the ASCII comma.

    Stripping before the split (as the reference does) and stripping the
    piece after it give the same text, because a comma is never white
    space; so every branch runs exactly one strip.
    """
    s = to_text(col, null_label)
    return (
        F.when(F.instr(s, FULLWIDTH_COMMA) > 0, strip_text(F.substring_index(s, FULLWIDTH_COMMA, 1)))
        .when(F.instr(s, ASCII_COMMA) > 0, strip_text(F.substring_index(s, ASCII_COMMA, 1)))
        .otherwise(strip_text(s))
    )


def first_label_ascii(col, null_label: str = "drop") -> Column:
    """Text before the first ASCII comma, stripped (old stage-1 rule)."""
    return strip_text(F.substring_index(to_text(col, null_label), ASCII_COMMA, 1))


def null_if_token(col, tokens=PANDAS_NA_TOKENS) -> Column:
    """Null for the CSV null words pandas recognises."""
    c = _c(col)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def text_preview(col, n: int = PREVIEW_CHARS, ellipsis: bool = False) -> Column:
    """First ``n`` characters, optionally followed by ``...``."""
    head = F.substring(_c(col), 1, n)
    return F.concat(head, F.lit("...")) if ellipsis else head


def token_preview(tokens, n: int = PREVIEW_TOKENS) -> Column:
    """First ``n`` tokens."""
    return F.slice(_c(tokens), 1, n)


def clean_controls(col, marks: bool = False) -> Column:
    """Drop control and format characters (and U+FFFD), except tab and line
    breaks, which separate tokens; with ``marks`` also combining marks."""
    mark = r"\p{Mn}" if marks else ""
    return F.regexp_replace(_c(col), rf"[\x{{FFFD}}\p{{Cc}}\p{{Cf}}{mark}&&[^\t\n\r]]+", "")


def _if_special(col, cleaned: Column, plain: Column) -> Column:
    """``cleaned`` for texts that hold anything beyond printable ASCII, tabs and
    line breaks (one search); others have nothing to clean."""
    return F.when(_c(col).rlike(SPECIAL_PATTERN), cleaned).otherwise(plain)


def _matches(text: Column) -> Column:
    """All tokens of a cleaned text, which is evaluated once: most texts are
    plain once their accents are off."""
    found = F.transform(F.array(text), lambda t: _if_special(
        t, F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 0), F.regexp_extract_all(t, F.lit(PLAIN_TOKEN_PATTERN), 0)))
    return F.get(found, F.lit(0))


def basic_tokens(col, accents: bool = False) -> Column:
    """Control characters dropped, lower-case, accents stripped (P16),
    one token per CJK character or punctuation mark, otherwise runs of the
    remaining non-space characters. ``accents=True`` keeps accents."""
    text = F.lower(clean_controls(col))
    if not accents:
        text = strip_accents(text)
    return _matches(_if_special(col, text, F.lower(_c(col))))


def token_length(tokens) -> Column:
    """Tokens plus the two special tokens."""
    return F.size(_c(tokens)) + F.lit(N_SPECIAL_TOKENS)


def token_count(col) -> Column:
    """Number of basic tokens of a text. Lower-casing and stripping accents
    off letters never move a token boundary, so the count only drops control
    characters and combining marks, puts one letter for each run of accented
    Latin letters (so most texts are plain) and matches the pattern."""
    plain = F.regexp_replace(clean_controls(col, marks=True), r"[\x{C0}-\x{24F}]+", "a")
    return F.size(_matches(_if_special(col, plain, _c(col))))


def truncation_excess(length, limit: int) -> Column:
    """Tokens lost at ``limit``."""
    return F.greatest(_c(length) - F.lit(limit), F.lit(0))


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Letters whose canonical decomposition is one base letter plus
    combining marks, built by rule from the Unicode database."""
    src, dst = [], []
    for cp in list(range(0x00C0, 0x3100)):
        ch = chr(cp)
        base = "".join(c for c in unicodedata.normalize("NFD", ch)
                       if unicodedata.category(c) != "Mn")
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_accents(col) -> Column:
    """Remove accents from letters, and combining marks."""
    src, dst = _accent_table()
    return F.regexp_replace(F.translate(_c(col), src, dst), r"\p{Mn}+", "")
