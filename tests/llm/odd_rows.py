"""Awkward rows of documents, for all training-data operators."""

#: Columns named like those the operators make themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, kept string, slot string, n_tokens string, part int, root string, before string"


def frame(spark, rows):
    """Rows of (doc_id, text[, source]) as documents with clashing extra columns."""
    full = [(i, t, None, s, None if t is None else len(t), "k", "no", "s", "9", 3, "r", "b") for i, t, s in ((*r, None)[:3] if len(r) < 3 else r for r in rows)]
    return spark.createDataFrame(full, SCHEMA)


LONG = " ".join(f"word{i % 9000} and more{i % 77}" for i in range(30_000))
AWKWARD = [
    (1, None, "a"), (2, "", "a"), (3, "   \n\t ", None), (4, "one two", "b"), (4, "one two", "b"), (5, "One TWO three four five six seven.", "b"),
    (6, "one two three four five six seven.", None), (7, LONG, "a"), (8, LONG + " end", "a"), (9, "é" * 50 + " x y", "c"), (None, "no id here", "a"),
    (None, None, None), (10, "<|endoftext|> It's 123 <|STARTOFTEXT|>a.b,c!! \x1f end.̇ İ. x́, ...", "c"), (11, "!!! ??? ...", "c"), (5, "another text of id five", "b"),
]
