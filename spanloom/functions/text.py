"""Text expressions shared by all operators.  Offsets are code points, from 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without white space at both ends, in the sense of Unicode."""
    return F.regexp_replace(col(x), r"(?U)^\s+|\s+$", "")


def strip_quick(name: str) -> Column:
    """strip of a short column, whose first and last character are looked at first: most need no regular expression,
    which takes ten times as long.  It names its column four times, so a filter on it makes long code (``has_text``)."""
    text = F.col(name).cast("string")
    solid = lambda c: c.between("!", "~") | c.between("\u00a1", "\u167f") | (c > "\u3000")
    return F.when(solid(F.substring(text, 1, 1)) & solid(F.substring(text, -1, 1)), text).otherwise(strip(text))


def has_text(x: Column | str) -> Column:
    """Whether anything is left of it after ``strip``."""
    return F.rlike(col(x), F.lit(r"(?U)\S"))


def fold(x: Column | str) -> Column:
    """Case-insensitive key: lower case, with sharp s and final sigma unfolded (an approximation of full
    case folding)."""
    return F.replace(F.replace(F.lower(col(x)), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(strip(x), F.lit(""))


def document_text(title: Column | str, abstract: Column | str, full_text: Column | str | None = None, prefer_full_text: bool = True, include_title: bool = True) -> Column:
    """Canonical text: title, an empty line, then full text or abstract; empty parts are dropped."""
    body = col(abstract)
    if full_text is not None and prefer_full_text:
        body = F.coalesce(F.nullif(col(full_text), F.lit("")), body)
    parts = [blank_to_null(title)] if include_title else []
    return F.concat_ws("\n\n", *parts, blank_to_null(body))


def slice_text(text: Column | str, start: Column | str, end: Column | str) -> Column:
    return F.substr(col(text), col(start) + 1, F.greatest(col(end) - col(start), F.lit(0)))


#: Code points of a piece of a text.
PIECE = 256


def pieces(text: Column | str) -> Column:
    """A text as the list of its pieces, in one pass."""
    return F.regexp_extract_all(col(text), F.lit(f"(?s)(.{{1,{PIECE}}})"), F.lit(1))


def slice_pieces(parts: Column | str, text: Column | str, start: Column | str, end: Column | str) -> Column:
    """slice_text, out of the pieces of the text: it costs the span's length, and its position only beyond a piece."""
    start, end = col(start), col(end)
    k = F.floor(start / PIECE).cast("int")
    two = F.concat(F.coalesce(F.get(col(parts), k), F.lit("")), F.coalesce(F.get(col(parts), k + 1), F.lit("")))
    short = (start >= 0) & (end - start <= PIECE)
    return F.when(short & col(parts).isNotNull(), F.substr(two, start % PIECE + 1, F.greatest(end - start, F.lit(0)))).otherwise(slice_text(text, start, end))


#: Characters that a span loses at both ends, besides white space.
BOUNDARY = r"\s.,;:!?()\[\]{}\"'"


def trim_boundary(span: Column, start: Column) -> tuple[Column, Column, Column]:
    """Span without boundary characters, and its start and end."""
    inner = F.regexp_replace(span, rf"^[{BOUNDARY}]+|[{BOUNDARY}]+$", "")
    lead = F.length(F.regexp_extract(span, rf"^[{BOUNDARY}]*", 0))
    begin = start + F.when(inner == "", 0).otherwise(lead)
    return inner, begin, begin + F.length(inner)


#: Leading words that the clinical and the pipeline taggers drop.
ARTICLES, DETERMINERS = ("the", "an", "a"), ("these", "those", "this", "the", "an", "a")


def strip_determiner(span: Column, start: Column, words: tuple[str, ...] = DETERMINERS) -> tuple[Column, Column]:
    """Span without one leading determiner and the blanks after it, and its start."""
    rest = F.regexp_replace(span, rf"(?i)^({'|'.join(words)}) +", "")
    return rest, start + F.length(span) - F.length(rest)


def is_noise(span: Column) -> Column:
    """Too short after stripping dashes, slashes and blanks, without a letter or digit, or a bare determiner."""
    bare = F.regexp_replace(span, r"^[-/ \t]+|[-/ \t]+$", "")
    return (F.length(bare) < 2) | ~F.rlike(bare, F.lit(r"[\p{L}\p{N}]")) | F.lower(bare).isin(*DETERMINERS)


#: Labels by which token taggers say that a token lies outside all entities.
OUTSIDE = ("O", "0", "")


def is_outside(label: Column | str) -> Column:
    return F.upper(strip(F.coalesce(col(label), F.lit("")))).isin(*OUTSIDE)
