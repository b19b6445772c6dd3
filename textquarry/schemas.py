"""Row types exchanged between the stages."""

from pyspark.sql import types as T

METADATA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
    ]
)

CHUNK = T.StructType(
    [
        T.StructField("document_id", T.StringType()),
        T.StructField("chunk_id", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)

# A chunk from elsewhere: `metadata` is any object, kept as JSON text.
FREE_CHUNK = T.StructType([*CHUNK.fields[:3], T.StructField("metadata", T.StringType())])

EMBEDDED_CHUNK = T.StructType([*CHUNK.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])

# Stored form of a chunk; `metadata` is JSON text.
VECTOR_ROW = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("document_id", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("metadata", T.StringType()),
        T.StructField("last_modified", T.TimestampType()),
    ]
)

PDF_WORD = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("x0", T.DoubleType()),
        T.StructField("x1", T.DoubleType()),
        T.StructField("top", T.DoubleType()),
        T.StructField("bottom", T.DoubleType()),
        T.StructField("size", T.DoubleType()),
        T.StructField("fontname", T.StringType()),
    ]
)

PDF_PAGE = T.StructType(
    [
        T.StructField("page_no", T.IntegerType()),
        T.StructField("page_width", T.DoubleType()),
        T.StructField("page_height", T.DoubleType()),
        T.StructField("fallback_text", T.StringType()),
        T.StructField("words", T.ArrayType(PDF_WORD)),
    ]
)

# Answers of the remote services, as far as they are read.
EMBEDDING_RESPONSE = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(T.StructType([T.StructField("embedding", T.ArrayType(T.DoubleType()))])),
        )
    ]
)

CHAT_RESPONSE = T.StructType(
    [
        T.StructField(
            "choices",
            T.ArrayType(
                T.StructType(
                    [T.StructField("message", T.StructType([T.StructField("content", T.StringType())]))]
                )
            ),
        )
    ]
)
