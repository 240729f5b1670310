"""Small tables with the cases that every operator has to take."""

LONG = "word " * 3000 + "x" * 20000

TEXTS = [
    (1, "The quick brown fox\njumps over\nthe lazy dog again\nand again today\nwith all of its friends\nin the evening sun"),
    (2, None),
    (3, ""),
    (4, "The quick brown fox\njumps over\nthe lazy dog again\nand again today\nwith all of its friends\nin the evening sun"),
    (5, "  \t\n 12345 !!! ... "),
    (6, LONG),
    (None, "a row without an id has a text"),
    (7, "Größe ñandú été 日本語 🙂 <|im_end|> done"),
    (7, "Größe ñandú été 日本語 🙂 <|im_end|> done"),
    (8, "a a a a a a a a a a a a a a a a a a a a a a a a a"),
]


def documents(spark, rows=TEXTS):
    """Documents with extra columns whose names clash with those of results."""
    rows = [(i, t, "en", "s", len(t or ""), "x", 1.5, 9) for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, score double, _gone int")


def written(spark, path, **tables):
    """A folder of tables, for queries."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)
