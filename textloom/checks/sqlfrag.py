"""SQL fragments shared by the DuckDB oracles, written apart from
textloom.functions so that a wrong character class there shows."""

from __future__ import annotations

# Code points that Python's str.strip() removes.
STRIP_POINTS = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
# CJK blocks (first, last code point).
CJK_BLOCKS = ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2A6DF), (0x2A700, 0x2CEAF), (0x2F800, 0x2FA1F))
_CJK = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in CJK_BLOCKS)
_PUNCT = "\\pP$+<=>^`|~"
TOKEN_PATTERN = f"[{_CJK}]|[{_PUNCT}]|[^\\s\\x0b\\pZ{_CJK}{_PUNCT}]+"
CONTROL_PATTERN = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f\\p{Cf}\\x{fffd}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {' || '.join(f'chr({p})' for p in STRIP_POINTS)})"


def first_label(x: str, literal_nan: bool = False) -> str:
    s = strip(f"coalesce(CAST({x} AS VARCHAR), 'nan')" if literal_nan else f"CAST({x} AS VARCHAR)")
    return (f"(CASE WHEN strpos({s}, '，') > 0 THEN {strip(f'split_part({s}, chr(65292), 1)')} "
            f"WHEN strpos({s}, ',') > 0 THEN {strip(f'split_part({s}, chr(44), 1)')} "
            f"ELSE {s} END)")


def first_label_ascii(x: str, literal_nan: bool = False) -> str:
    s = f"coalesce(CAST({x} AS VARCHAR), 'nan')" if literal_nan else f"CAST({x} AS VARCHAR)"
    return strip(f"split_part({s}, ',', 1)")


def tokens(x: str) -> str:
    clean = f"regexp_replace({x}, {q(CONTROL_PATTERN)}, '', 'g')"
    return f"regexp_extract_all(strip_accents(lower({clean})), {q(TOKEN_PATTERN)})"


def token_len(x: str) -> str:
    return f"CAST(len({tokens(x)}) + 2 AS INTEGER)"


CORPUS = """corpus AS (
  SELECT doc_id AS row_id,
         CASE WHEN doc_id % 50 = 7 THEN NULL ELSE text END AS summary,
         CASE WHEN doc_id % 41 = 5 THEN NULL
              WHEN doc_id % 3 = 0 THEN concat(' ', lang, '，', source)
              WHEN doc_id % 3 = 1 THEN concat(lang, ',', source, ' ')
              ELSE lang END AS label,
         source
  FROM documents)"""

THRESHOLD = "(SELECT (count(*) * 12) // 100 FROM documents)"

LENGTHS = f"""lens AS (
  SELECT doc_id AS row_id, text, {token_len('text')} AS len FROM documents)"""
