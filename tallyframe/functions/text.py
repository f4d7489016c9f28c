"""Tokenizers as column expressions.

Both work on the whole text of a row, so a document costs one regular
expression pass and one split instead of several per token.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed from a legal word.
REMOVED_CHARACTERS = "\"'()[],!.`:?&*=¡ª;{}"
# What a legal word may not start with, besides a digit.
REFUSED_STARTS = "-¿"
# Delimiters of the line tokenizer (no vertical tab).
LINE_DELIMITERS = " \\t\\n\\r\\f"

_REMOVED = "[" + REMOVED_CHARACTERS.replace("[", "\\[").replace("]", "\\]") + "]"
_WITHIN = f"[^{LINE_DELIMITERS}]"
# A digit is one UTF-16 unit in this rule, so supplementary digits do not count.
_DIGIT = "\\p{Nd}&&[^\\x{10000}-\\x{10FFFF}]"
# Either a whole token whose first surviving character is refused, or a run of
# removed characters. A token that starts with a digit before cleaning also
# starts with it afterwards, so one alternative covers both digit rules.
_ILLEGAL = (
    f"(?<!{_WITHIN}){_REMOVED}*+(?:[{_DIGIT}]|[\\-¿]){_WITHIN}*+"
    f"|{_REMOVED}++"
)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def legal_tokens(text: Column | str) -> Column:
    """Cleaned, filtered and lower-cased words of a text, in order."""
    kept = F.lower(F.regexp_replace(_column(text), F.lit(_ILLEGAL), F.lit("")))
    return F.array_remove(F.split(kept, f"[{LINE_DELIMITERS}]+"), "")


def raw_tokens(text: Column | str, keep_leading_empty: bool = False) -> Column:
    """Whitespace-separated tokens, unchanged.

    With ``keep_leading_empty`` a text that starts with whitespace yields an
    empty first token, an empty text yields one empty token, and a text of
    whitespace only yields none.
    """
    text = _column(text)
    if not keep_leading_empty:
        return F.array_remove(F.split(text, "\\s+"), "")
    stripped = F.regexp_replace(text, F.lit("\\s++\\z"), F.lit(""))
    blank = (text != "") & (stripped == "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(stripped, "\\s+"))


def tokens(text: Column | str, mode: str = "legal", keep_leading_empty: bool = False) -> Column:
    if mode == "legal":
        return legal_tokens(text)
    if mode == "raw":
        return raw_tokens(text, keep_leading_empty)
    raise ValueError(f"mode must be 'legal' or 'raw', not {mode!r}")


def score_line(doc: Column | str, word: Column | str, score: Column | str, decimals: int = 16) -> Column:
    """``document@word<TAB>score`` with a fixed number of decimals."""
    return F.format_string(f"%s@%s\t%.{decimals}f", _column(doc), _column(word), _column(score))


def score_line_fields(line: Column | str) -> tuple[Column, Column, Column]:
    """Document, word and score of a line as text; a document holds no ``@`` and a score no tab."""
    line = _column(line)
    doc, score = F.substring_index(line, "@", 1), F.substring_index(line, "\t", -1)
    word = F.substring(line, F.length(doc) + 2, F.length(line) - F.length(doc) - F.length(score) - 2)
    return doc, word, score
