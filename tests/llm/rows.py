"""Small tables with the odd cases: nulls, empty and long texts, ties, repeats, clashing column names."""

SF = "/root/testdata/sf0.001"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu\n" * 3000

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here", "en", "a"),
    (2, None, "en", "a"),
    (3, "", "en", "b"),
    (4, "   \n\t ", None, "b"),
    (5, LONG, "en", None),
    (6, "The quick brown fox jumps over the lazy dog and runs far away from here", "en", "b"),
    (6, "The quick brown fox jumps over the lazy dog and runs far away from here", "en", "b"),
    (None, "una casa blanca en la montaña\ny un río de agua clara", "es", None),
    (None, "una casa blanca en la montaña\ny un río de agua clara", "es", None),
    (7, "word", "en", "c"),
    (8, "12345 !!! 67890", None, "c"),
    (9, "Ünïcödé ßtraße naïve Ωmega", "de", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that operators use for themselves inside.
CLASHES = ("id", "same", "fp", "t", "h", "n", "node", "segment", "term", "place", "shard", "removed", "n_lines", "target", "copies", "__x",
           "__id", "__same", "__cut", "__gone", "__row", "__key", "__text", "__score", "__lang_pred", "__hit", "__copy", "__d", "__t", "__s", "__source", "__copies")


def documents(spark, rows=TEXTS):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    return df.select("*", *[F.lit(f"c-{c}").alias(c) for c in CLASHES])


def values(df, *order):
    return sorted((tuple(r) for r in df.select(*order).collect()), key=repr)
