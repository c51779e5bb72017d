"""Document text: OCR lines, blank test, truncation and prompt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Truncation marker and the two halves of the classification prompt.
TRUNCATION_MARKER = "\n[TEXT TRUNCATED]"
USER_PREFIX = "Extract all PII:\n\n"
SYSTEM_PROMPT = (
    "You are a PII extraction engine. "
    "Respond only with a valid JSON object. "
    "No markdown fences. No explanation. "
    "JSON keys: names, emails, phones, ssns, addresses, dates_of_birth, "
    "other_pii (array of objects with type and value fields)."
)

# White space as Unicode defines it, plus the four ASCII separators.
SPACE = r"[\s\x1c-\x1f]"


def assemble_lines(blocks: Column) -> Column:
    """Texts of the non-empty LINE blocks of one document, in order, one per line."""
    lines = F.filter(
        blocks, lambda b: (b["BlockType"] == "LINE") & (F.length(b["Text"]) > 0)
    )
    return F.coalesce(F.array_join(F.transform(lines, lambda b: b["Text"]), "\n"), F.lit(""))


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{SPACE}+|{SPACE}+\\z", "")


def truncate_text(text: Column, max_chars: int | None) -> Column:
    if max_chars is None:
        return text
    cut = F.concat(F.substring(text, 1, max_chars), F.lit(TRUNCATION_MARKER))
    return F.when(F.length(text) > max_chars, cut).otherwise(text)


def text_pieces(text: Column, size: int, overlap: int) -> Column:
    """A text as overlapping pieces of at most `size` characters; a null text is one null piece."""
    step = size - overlap
    last = F.greatest(F.ceil((F.length(text) - overlap) / step) - 1, F.lit(0)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(text, i * step + 1, F.lit(size)))
    return F.when(F.length(text) > size, pieces).otherwise(F.array(text))


def build_prompt(text: Column) -> Column:
    """User message only; the system text is a constant the document cannot reach."""
    return F.concat(F.lit(USER_PREFIX), text)
