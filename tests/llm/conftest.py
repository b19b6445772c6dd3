import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Nulls in any column, empty and white texts, repeated rows, rows with one id, signs beyond ASCII, a long text.
ROWS = [
    (1, "The cat sat on the mat. The dog sat on the log, and then the cat left.", "en", "a"),
    (2, "The cat sat on the mat. The dog sat on the log, and then the cat left.", "en", "b"),
    (2, "The cat sat on the mat. The dog sat on the log, and then the cat left.", "en", "b"),
    (3, "the CAT sat on the mat. the dog sat on the log, and then the cat left", "en", None),
    (4, "Der Hund schläft über dem Fluß, und die Katze läuft zur Tür. ÄÖÜ äöü ß", "de", "a"),
    (5, "Le chien dort près de la forêt; ça ne l'empêche pas d'être gêné.", "fr", "a"),
    (6, "", "en", "c"),
    (7, None, None, "c"),
    (8, " \t\n\x0b\x0c\r ", "en", None),
    (None, "no id here, but words all the same", None, None),
    (None, None, None, None),
    (9, "one", "en", "d"),
    (9, "two words", "en", "d"),
    (10, "!!! ??? 123", "en", "d"),
    (11, "漢字 かな \U0001f600 é  x \x1f\x00y", None, "a"),
    (12, "again and again " * 3000, "en", "a"),
    (-5, "x" * 50_000, "en", "e"),
    (13, "Die Katze und der Hund laufen über die Straße zum Fluß, und die Tür ist zu.", "de", "b"),
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], DOCS)


@pytest.fixture(scope="session")
def clashing(documents):
    """The same with columns named as the operators name theirs."""
    names = "size source_size target taken start block words fp root least kept keep_id held_out score rows row ids part"
    out = documents
    for i, name in enumerate(names.split()):
        out = out.selectExpr("*", f"{i} AS {name}")
    return out


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def rows():
    return rows_of
