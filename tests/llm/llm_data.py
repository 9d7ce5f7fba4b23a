"""Documents with nulls, empty, long and repeated texts, and with extra columns that clash with the operators' own."""

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASHES = ["fp", "marks", "leak", "keep", "perplexity", "bound", "batch", "_k1", "_digest_of_text", "words", "key"]


def make_docs(spark, rows, clashes=True):
    """Documents from (doc_id, text, lang) rows, with extra columns that clash with the operators' own names."""
    full = [(i, t, x, "s", None if t is None else len(t)) for i, t, x in rows]
    df = spark.createDataFrame(full, COLUMNS)
    return df.selectExpr("*", *[f"'{c}' AS {c}" for c in CLASHES]) if clashes else df


LONG = " ".join(f"w{i % 97}x{i % 31}" for i in range(30_000))
EDGES = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho.", "en"),
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho.", "en"),
    (2, None, "en"), (3, "", None), (None, "null id text here", "fr"), (4, "   \t\n ", "de"),
    (5, "été à la plage, größe ß 漢字 😀", "fr"), (6, LONG, None), (7, "one", "en"), (None, None, None),
]
