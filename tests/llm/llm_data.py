"""Rows and schema shared by the tests of this folder."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size int, open boolean"

#: Nulls, empty and one-word texts, repeated rows, white space only, a very long text.
EDGES = [(1, None, None), (2, "", "a"), (3, " \t\n", "a"), (4, "word", None), (5, "a b", "b"), (5, "a b", "b"),
         (None, "no id here", "c"), (6, "é ü ß \x1c x\n\nx", "b"), (7, "long text of words " * 20000, "a")]
EMPTY = []
