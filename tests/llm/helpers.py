"""Small tables with the awkward rows every operator has to take."""

LONG = "lorem ipsum dolor " * 30_000

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (5, "The quick brown fox jumps over the lazy dog"),
    (6, "the quick  brown fox\njumps over the lazy dog"),
    (7, "one"),
    (7, "one"),
    (8, "Ünïcödé é̀ 漢字 🙂 \x1c\xa0x　y 's it's <|endoftext|> a  b"),
    (9, LONG),
    (10, LONG + "end"),
    (None, "no id"),
    (None, None),
    (11, "The quick brown fox jumps over the lazy dog" + " "),
]


def documents(spark, rows=AWKWARD, extra=True):
    """The rows as documents; further columns clash with names that operators use inside."""
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    if extra:
        frame = frame.selectExpr(
            "doc_id", "text", "'en' as lang", "cast(null as string) as source",
            "cast(length(text) as bigint) as n_chars", "1 as text_key", "2 as kept",
            "'x' as component_id", "3 as repeats", "4 as row", "5 as block", "6 as `group`",
            "7 as score", "8 as print", "9 as ids")
    return frame


def rows_of(frame):
    return [tuple(row) for row in frame.collect()]
