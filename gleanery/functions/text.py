"""Text columns: chunk windows, word counts, blank tests, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Window size and overlap in characters.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50

# A run of non-blank characters. The class adds U+001C..U+001F, which Unicode White_Space leaves out
# but which Python's str.split() and str.strip() treat as blank.
WORD = r"(?U)[^\s\x1c-\x1f]+"


def chunk_windows(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """All windows of ``size`` characters, each starting ``size - overlap`` after the one before.

    The look-ahead captures a whole window while the match itself consumes one step, so a text is
    walked once whatever its length. Null gives null and empty text an empty array.
    """
    if size < 1 or not 0 <= overlap < size:
        raise ValueError(f"overlap must be at least 0 and below the size, got {overlap} and {size}")
    pattern = f"(?s)(?=(.{{1,{size}}})).{{1,{size - overlap}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def is_blank(text: Column) -> Column:
    """True where the text has no visible character; null stays null."""
    return ~text.rlike(WORD)


def chunk_key(file_path: Column, chunk_pos: Column, chunk_text: Column) -> Column:
    """Content key of a chunk: the same on every re-run, distinct per file, position and text."""
    return F.md5(F.concat_ws("|", file_path, chunk_pos.cast("string"), F.md5(chunk_text)))
