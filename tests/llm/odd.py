"""A table of documents with everything that may go wrong in it."""

SCHEMA = "doc_id long, text string, id string, carry int, k1 string, lang string"


def documents(spark, texts=()):
    rows = [(None, "null key words"), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (5, "same key"), (5, "other text")]
    rows += [(100 + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(k, t, "x", 1, None, "en") for k, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
