"""Rows that every operator has to handle."""

# Fixed small texts: nulls, blanks, long and repeated rows, copies and near copies.
BASE = " ".join(f"w{i * i % 101}x{i}" for i in range(200))
NEAR = BASE.replace("w4x2 ", "changed ", 1)
ROWS = [
    (1, BASE, "en", "a", 1),
    (2, NEAR, "en", "a", 1),
    (3, BASE.upper(), "en", None, 1),
    (4, "", "de", "b", 0),
    (5, None, None, None, None),
    (6, "  \n\t ", "de", "b", 5),
    (7, "one", "de", "b", 3),
    (8, "one two", "de", "b", 7),
    (9, "the same line\nthe same line\nown line here", "fr", "c", 10),
    (10, "the same line\nlast 12 of it", "fr", "c", 10),
    (11, "é😀 " * 3000, "fr", "c", 9000),
    (11, "é😀 " * 3000, "fr", "c", 9000),
    (None, "no id at all", None, "a", 12),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
