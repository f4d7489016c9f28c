"""Rows that every operator must take."""

#: Null id, null text, empty, blank, repeated row, one id with two texts, ties, a long text.
ODD_ROWS = [
    (None, "a text without an id"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "the same row twice"),
    (4, "the same row twice"),
    (5, "one id with this text"),
    (5, "one id with another text"),
    (6, "  two  blanks and odd   space, 日本 語 <|endoftext|> don't"),
    (7, "word " * 30_000 + "end"),
]
