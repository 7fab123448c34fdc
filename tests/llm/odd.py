"""Constants and rows that the tests of this folder share."""

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = ("The sea was calm and the sun was out for all of the day, and we were in the water from the morning on. "
         "It was a day that nobody in the group will forget, for the wind came only after the last boat was back. "
         "Then they sat by the fire with bread and fish, and the old man told of the years when the harbour was full.")


def odd_rows():
    """Nulls in every column, empty and wordless texts, ties, repeated rows
    and one very long text."""
    long = " ".join(f"word{i % 977}x{i // 977}" for i in range(120_000))
    return [
        (1, PROSE, "en", "a", 1), (1, PROSE, "en", "a", 1), (2, PROSE.replace(" ", "  "), "en", None, 2),
        (3, None, None, "a", None), (4, "", "en", "b", 0), (5, " \t\n\x0b\x0c\r ", "en", "b", 7),
        (None, "one two", None, None, None), (None, "one two", None, None, None), (6, PROSE.lower(), "en", "b", 3),
        (7, long, "en", "a", len(long)), (8, "é ü ﬁ 中文 \U0001F600 <|endoftext|> x", "de", "c", 9), (9, "\x00 \x1c\x85 x", "de", "c", 1),
    ]
