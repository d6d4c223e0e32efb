"""Small document tables that hold the odd cases: nulls, empty and long texts, ties, repeats, clashing columns."""

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, band int, kept string, score string"


def rows():
    base = " ".join(WORDS[:120])
    near = " ".join([*WORDS[:60], "changed", *WORDS[61:120]])
    other = " ".join(f"x{i}" for i in range(70))
    texts = [
        (1, base), (2, base), (3, near), (4, other), (5, ""), (6, None), (7, "   \n\t "), (8, "one two"), (9, "One TWO"), (10, LONG * 3),
        (11, "tail " + other), (12, "é ü ñ " * 40), (4, other), (4, other), (None, base), (None, "no id here at all, none"), (13, "a a a a " * 40), (14, "a a a a " * 41),
    ]
    return [(i, t, None if i == 8 else "en", None if i == 9 else "src0", None if t is None else len(t), "n", 1, "k", "s") for i, t in texts]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
