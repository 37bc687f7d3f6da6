"""Tables with everything that may be odd in one."""

LONG = " ".join(f"verylong{i % 977} piece{i % 31}" for i in range(60_000))
TEXT = "A plain sentence that holds some thirty words or so, which is enough for every operator here to find something in it when the very same thing stands somewhere else in the table too. "


def documents(spark, extra="key string, node long, place int, removed string, toxic int, u long, text_md5 string"):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and
    columns whose names clash with those that operators make."""
    x = ("k", 1, 2, "r", 3, 4, "m")
    n = (None,) * len(x)
    rows = [
        (None, None, *n), (None, TEXT, *x), (1, None, *x), (2, "", *x), (3, " \n\t ", *n), (4, TEXT, *x), (4, TEXT, *x), (4, TEXT, *n), (4, "another text of the same id", *x),
        (5, TEXT, *x), (6, LONG, *x), (7, LONG, *n), (8, "ß İ ǅ ​ \x00 ퟿ 日本語 🙂 é", *x), (-9, "word", *x), (10, "word word", *n),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, " + extra)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def clashing(spark):
    """Documents with columns of the names that the stages make, each row with a
    value of its own in each of them."""
    names = "removed toxic tox_score tox_hits key row_key runs node group_id keep input_toxic input_removed many n_rows n_words".split()
    made = [(i, TEXT if i % 4 == 0 else f"{TEXT[: 20 + i]} words of its own {i} {i * 7919} and {i * 104729} more", *(f"{n}-{i}" for n in names)) for i in range(40)]
    made[7] = (7, "stupid idiot moron you stupid idiot moron", *made[7][2:])
    return spark.createDataFrame(made, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)), names
