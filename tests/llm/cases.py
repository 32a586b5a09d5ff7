"""Rows with every oddity the operators must stand, and small helpers."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

#: Extra columns whose names the operators use inside.
CLASHING = [
    "score", "copy", "fp", "row", "key", "words", "label_id", "toxic_", "owner", "text_hash", "name",
    "component_id", "found", "rate_source", "mix_key", "bad_id", "copy_id", "instances", "base", "file",
]
SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        *[StructField(name, StringType()) for name in CLASHING],
    ]
)
LONG = "".join(f"w{i % 977} " for i in range(40_000)) + "x" * 50_000
TEXTS = [
    (0, "", "en", "a"),
    (1, None, "en", "a"),
    (2, "one", "en", "b"),
    (3, LONG, "de", "a"),
    (4, "Same words here, twice over", "en", None),
    (4, "Same words here, twice over", "en", None),
    (5, "same WORDS here, twice over", None, "b"),
    (None, "no id at all", "en", "a"),
    (None, None, None, None),
    (6, " \t\n ", "en", "c"),
    (7, "tail 4111 1111 1111 1111, mail a.b@c.de; pwd = Xq7#vT9$zKw2", "en", "c"),
    (2, "another text with the id of two", "en", "b"),
]


def odd_documents(spark, rows=None):
    rows = TEXTS if rows is None else rows
    filled = [(i, t, lang, s, None if t is None else len(t), *["z"] * len(CLASHING)) for i, t, lang, s in rows]
    return spark.createDataFrame(filled, SCHEMA).repartition(3)


def labels_of(spark, rows):
    schema = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("quality", IntegerType()),
            StructField("toxic", IntegerType()),
            StructField("label_id", StringType()),
        ]
    )
    return spark.createDataFrame([(i, q, t, "z") for i, q, t in rows], schema)


def documents(spark, texts, **more):
    rows = [(i, text, "en", more.get("source", "s"), len(text)) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
