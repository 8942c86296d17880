"""Record schemas, declared once. JSON/XML are always read with these (never
inferred), so a missing key reads as NULL and ``.get(key, default)`` becomes a
``coalesce``."""

from pyspark.sql import types as Ty

S, A, L, D, B = Ty.StringType(), Ty.ArrayType(Ty.StringType()), Ty.LongType(), Ty.DoubleType(), Ty.BooleanType()


def _struct(*fields):
    return Ty.StructType([Ty.StructField(n, t) for n, t in fields])


RSS_ENTRY = _struct(
    ("title", S), ("link", S), ("summary", S), ("published", S),
    ("content", Ty.ArrayType(_struct(("value", S)))), ("description", S),
    ("summary_detail", _struct(("value", S))),
    ("tags", Ty.ArrayType(_struct(("term", S), ("label", S)))),
    ("category", A), ("author", S), ("author_detail", _struct(("name", S))),
)

RAW_ARTICLE = _struct(
    ("id", S), ("title", S), ("url", S), ("link", S), ("summary", S), ("content", S), ("date", S),
    ("published", S), ("author", S), ("slug", S), ("categories", A), ("tags", A), ("source_feed", S),
    ("source_url", S), ("source_name", S), ("category", S), ("fetched_at", S),
)

PROCESSED_ARTICLE = _struct(
    ("id", S), ("title", S), ("content", S), ("url", S), ("date", S), ("author", S), ("slug", S),
    ("categories", A), ("tags", A), ("source_feed", S), ("ai_summary", S),
)

VECTOR_METADATA = _struct(
    ("title", S), ("link", S), ("summary", S), ("published", S), ("source_name", S), ("category", S),
    ("tags", A), ("ai_enhanced", B), ("added_to_db", S), ("content_preview", S),
)

VECTOR = _struct(("namespace", S), ("id", S), ("values", Ty.ArrayType(Ty.FloatType())), ("metadata", VECTOR_METADATA))

MATCH = _struct(
    ("id", S), ("title", S), ("link", S), ("summary", S), ("published", S), ("source_name", S), ("category", S),
    ("tags", A), ("similarity_score", D), ("content_preview", S), ("rerank_score", D),
)

API_ARTICLE = _struct(
    ("id", S), ("title", S), ("content", S), ("date", S), ("url", S), ("source", S), ("categories", A),
    ("tags", A), ("summary", S), ("author", S), ("slug", S), ("similarity_score", D),
)

# A snapshot file may hold PROCESSED or API rows: the union of both shapes.
SNAPSHOT_ARTICLE = _struct(
    ("id", S), ("title", S), ("content", S), ("url", S), ("date", S), ("author", S), ("slug", S),
    ("categories", A), ("tags", A), ("source_feed", S), ("ai_summary", S), ("source", S), ("summary", S),
    ("similarity_score", D),
)

TOPIC = _struct(("topic", S), ("description", S), ("reason", S), ("article_count", L), ("mention_count", L))

BATCH_RESPONSE = _struct(("batch_id", L), ("expected_count", Ty.IntegerType()), ("response", S))
