"""Rows that every operator of documents has to take."""

#: Ids and texts that every operator has to take: NULLs, empty, blank, repeated, beyond ASCII, very long.
ODD = [
    (1, "One two three four five six."),
    (2, None),
    (3, ""),
    (4, " \t\n\r\x0b\x0c"),
    (1, "One two three four five six."),
    (None, "One two three four five six."),
    (None, None),
    (5, "Ünïcode ſtrange İ 😀 日本語   words here"),
    (6, "long " * 30_000),
    (7, "x" * 70_000),
    (8, "\n\n\n"),
]
