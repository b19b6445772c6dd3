"""Batches of chunks, section titles and embeddings.

A batch of up to sixteen chunks of one document is the unit of a service call and
of failure. It travels as one row with an array, so batching a chunked document
and embedding a batch are both narrow.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.providers import EmbeddingProvider, ProviderError, TitleProvider
from ..functions.text import strip
from ..schemas import CHAT_RESPONSE, EMBEDDING_RESPONSE
from .chunk import BATCH_SIZE, CHUNK_SIZE, OVERLAP, chunk_array

ANSWER = T.StructType(
    [
        T.StructField("vectors", T.ArrayType(T.ArrayType(T.FloatType()))),
        T.StructField("error", T.StringType()),
    ]
)
_ARROW_ANSWER = pa.struct([("vectors", pa.list_(pa.list_(pa.float32()))), ("error", pa.string())])


def check_batch_size(batch_size: int) -> None:
    if batch_size <= 0:
        raise ValueError("batch size must be positive")


def slices(items: Column, length: int) -> Column:
    """Consecutive slices of an array; an empty array has none."""
    last = F.ceil(F.size(items) / F.lit(length)).cast("int") - 1
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(items, i * length + 1, length))


def document_batches(
    documents: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """`(document_id, title, clean_text)` to rows `(document_id, batch_id, chunks)`, no shuffle.

    Each chunk still carries the section it inherits, if any, and its fallback.
    """
    check_batch_size(batch_size)
    numbered = F.transform(
        chunk_array(F.col("clean_text"), size, overlap),
        lambda c, i: F.struct(
            F.concat_ws("-", "document_id", i).alias("chunk_id"),
            c["content"].alias("content"),
            F.coalesce("title", F.lit("")).alias("title"),
            c["inherited"].alias("inherited"),
            c["fallback"].alias("fallback"),
            i.cast("int").alias("chunk_index"),
        ),
    )
    # no filter on emptiness: it would be pushed down and chunk every text a second time
    chunked = documents.select("document_id", numbered.alias("all"))
    return chunked.select(
        "document_id", F.posexplode(slices(F.col("all"), batch_size)).alias("batch_id", "chunks")
    )


def _provider_titles(provider: TitleProvider) -> Callable[[Column], Column]:
    def name(texts: pa.Array) -> pa.Array:
        def one(text: str | None) -> str | None:
            if text is None:
                return None
            try:
                return provider.title(text).strip()
            except ProviderError:
                return None

        named = [None if b is None else [one(t) for t in b] for b in texts.to_pylist()]
        return pa.array(named, type=pa.list_(pa.string()))

    return F.arrow_udf(name, T.ArrayType(T.StringType())).asNondeterministic()


def titled(batches: DataFrame, provider: TitleProvider) -> DataFrame:
    """Add `titles`, the provider's answer per chunk; null where it was not asked or failed.

    It is asked only about chunks without a heading of their own.
    """
    asked = F.transform("chunks", lambda c: F.when(c["inherited"].isNull(), c["content"]))
    return batches.withColumn("titles", _provider_titles(provider)(asked))


def _settled(c: Column, title: Column) -> Column:
    section = F.coalesce(c["inherited"], F.nullif(title, F.lit("")), c["fallback"])
    metadata = F.struct(
        c["title"].alias("title"), section.alias("section"), c["chunk_index"].alias("chunk_index")
    )
    return F.struct(c["chunk_id"].alias("chunk_id"), c["content"].alias("content"), metadata.alias("metadata"))


def with_sections(batches: DataFrame, provider: TitleProvider | None = None) -> DataFrame:
    """Settle each chunk's section: inherited heading, else the service's title, else fallback.

    Batches may bring `titles` along; otherwise the provider, if any, is asked.
    """
    if provider is not None:
        batches = titled(batches, provider)
    if "titles" not in batches.columns:
        no_title = F.lit(None).cast("string")
        return batches.withColumn("chunks", F.transform("chunks", lambda c: _settled(c, no_title)))
    return batches.withColumn("chunks", F.zip_with("chunks", "titles", _settled)).drop("titles")


def title_log(titled_batches: DataFrame, model: str = "") -> DataFrame:
    """Request and response records of the title calls, one call per chunk."""
    calls = titled_batches.select(F.explode(F.arrays_zip("chunks", "titles")).alias("z")).where(
        F.col("z.chunks.inherited").isNull()
    )
    request = F.struct(F.lit(model).alias("model"), F.col("z.chunks.content").alias("input"))
    records = F.array(
        F.struct(F.lit("request").alias("kind"), F.to_json(F.struct(request.alias("payload"))).alias("body")),
        F.struct(
            F.when(F.col("z.titles").isNull(), "error").otherwise("response").alias("kind"),
            F.to_json(F.struct(F.coalesce("z.titles", F.lit("no title")).alias("title"))).alias("body"),
        ),
    )
    return calls.select(F.concat(F.lit("section-"), "z.chunks.chunk_id").alias("call_id"), F.inline(records))


def batches_to_chunks(batches: DataFrame) -> DataFrame:
    """Back to one row per chunk, in the chunk schema."""
    return batches.select("document_id", F.inline("chunks")).select(
        "document_id", "chunk_id", "content", "metadata"
    )


def batch_id_of(chunks: DataFrame, batch_size: int = BATCH_SIZE) -> Column:
    """Batch number of a stored chunk, from its running index or the number its id ends in.

    A chunk with neither goes into a batch of its own, with a negative number, so that no
    batch grows with its document.
    """
    check_batch_size(batch_size)
    index = F.regexp_extract("chunk_id", r"-(\d+)\z", 1).try_cast("int")
    metadata = chunks.schema["metadata"].dataType if "metadata" in chunks.columns else None
    if isinstance(metadata, T.StructType) and "chunk_index" in metadata.names:
        index = F.coalesce("metadata.chunk_index", index)
    elif isinstance(metadata, T.StringType):
        index = F.coalesce(F.get_json_object("metadata", "$.chunk_index").try_cast("int"), index)
    alone = -1 - F.pmod(F.xxhash64("chunk_id"), F.lit(2**31 - 1))
    return F.coalesce(F.floor(index / batch_size), alone).cast("int")


def stored_batches(chunks: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Batches of chunks that were read back as rows.

    Groups hold one batch each, so a document of any length spreads over many of them.
    """
    chunk = F.struct(
        F.length("chunk_id").alias("digits"), "chunk_id", "content", "metadata"
    )
    grouped = chunks.groupBy("document_id", batch_id_of(chunks, batch_size).alias("batch_id")).agg(
        F.array_sort(F.collect_list(chunk), _by_id).alias("chunks")
    )
    return grouped.withColumn(
        "chunks",
        F.transform(
            "chunks",
            lambda c: F.struct(
                c["chunk_id"].alias("chunk_id"), c["content"].alias("content"), c["metadata"].alias("metadata")
            ),
        ),
    )


def _by_id(a: Column, b: Column) -> Column:
    # ids of a document differ in a trailing number, so shorter ids come first
    less = (a["digits"] < b["digits"]) | ((a["digits"] == b["digits"]) & (a["chunk_id"] < b["chunk_id"]))
    return F.when(less, -1).when(a["chunk_id"] == b["chunk_id"], 0).otherwise(1)


def _provider_vectors(provider: EmbeddingProvider) -> Callable[[Column], Column]:
    def answer(texts: list[str]) -> dict:
        try:
            vectors = provider.embed(texts)
            if len(vectors) != len(texts):
                raise ProviderError(f"expected {len(texts)} embeddings, got {len(vectors)}")
            return {"vectors": vectors, "error": None}
        except ProviderError as exc:
            return {"vectors": exc.done, "error": str(exc)}

    def embed(batches: pa.Array) -> pa.Array:
        return pa.array([answer(b) for b in batches.to_pylist()], type=_ARROW_ANSWER)

    return F.arrow_udf(embed, ANSWER).asNondeterministic()


def dealt_out(batches: DataFrame, calls_at_once: int | None = None) -> DataFrame:
    """Hash batches over the tasks that will call a service.

    Calls dominate the cost, and the batches of one huge document would otherwise queue up
    behind each other. `calls_at_once` fixes the number of tasks, and so of parallel calls.
    """
    keys = ["document_id", "batch_id"]
    return batches.repartition(calls_at_once, *keys) if calls_at_once else batches.repartition(*keys)


def embed_batches(
    batches: DataFrame, provider: EmbeddingProvider, calls_at_once: int | None = None
) -> DataFrame:
    """Add `answer`, the vectors of a batch in order; with the error that lost it, those of the calls before."""
    texts = F.transform("chunks", lambda c: c["content"])
    return dealt_out(batches, calls_at_once).withColumn("answer", _provider_vectors(provider)(texts))


def embedded_chunks(answered: DataFrame) -> DataFrame:
    """Chunk rows with `embedding`, or with the `error` of their batch."""
    pairs = F.transform(
        "chunks",
        lambda c, i: F.struct(
            c["chunk_id"].alias("chunk_id"),
            c["content"].alias("content"),
            c["metadata"].alias("metadata"),
            F.when(F.col("answer.error").isNull(), F.get("answer.vectors", i)).alias("embedding"),
        ),
    )
    return answered.select(
        "document_id", "batch_id", F.inline(pairs), F.col("answer.error").alias("error")
    ).select("document_id", "batch_id", "chunk_id", "content", "metadata", "embedding", "error")


def succeeded(embedded: DataFrame) -> DataFrame:
    return embedded.where(F.col("error").isNull()).drop("error", "batch_id")


def dead_letters(embedded: DataFrame) -> DataFrame:
    return embedded.where(F.col("error").isNotNull()).select(
        "document_id", "batch_id", F.col("error").alias("reason"), "chunk_id", "content"
    )


def dead_letter_texts(answered: DataFrame) -> DataFrame:
    """The text report of each lost batch."""
    lines = F.array_join(
        F.transform(
            "chunks", lambda c: F.concat(F.lit("["), c["chunk_id"], F.lit("] "), c["content"], F.lit("\n"))
        ),
        "",
    )
    return answered.where(F.col("answer.error").isNotNull()).select(
        "document_id",
        "batch_id",
        F.concat(F.lit("# Failure: "), "answer.error", F.lit("\n"), lines, F.lit("\n")).alias("value"),
    )


def load_counts(embedded: DataFrame, *keys: str) -> DataFrame:
    """Chunks in total, embedded, and lost."""
    return embedded.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def call_log(answered: DataFrame, model: str, dimension: int, call_size: int) -> DataFrame:
    """Request and response records of the embedding calls, with unique ids.

    A batch is sent in calls of `call_size` texts; the first that fails has the error, and none is made after it.
    """
    texts = F.transform("chunks", lambda c: c["content"])
    calls = answered.select(
        "document_id", "batch_id", F.posexplode(slices(texts, call_size)).alias("call_no", "input"), "answer"
    ).withColumn("call_id", F.concat_ws("-", "document_id", "batch_id", "call_no"))
    answers = F.col("call_no") * call_size < F.size("answer.vectors")
    is_ok = F.col("answer.error").isNull() | answers
    last = F.floor(F.size("answer.vectors") / call_size)
    calls = calls.where(is_ok | (F.col("call_no") == last))
    request = F.struct(
        F.lit(model).alias("model"),
        "input",
        F.lit("float").alias("encoding_format"),
        F.lit(dimension).alias("dimensions"),
    )
    vectors = F.slice("answer.vectors", F.col("call_no") * call_size + 1, call_size)
    data = F.transform(vectors, lambda v, i: F.struct(v.alias("embedding"), i.alias("index")))
    ok = F.to_json(F.struct(F.struct(data.alias("data")).alias("response")))
    failed = F.to_json(F.struct(F.col("answer.error").alias("error")))
    records = F.array(
        F.struct(F.lit("request").alias("kind"), F.to_json(F.struct(request.alias("payload"))).alias("body")),
        F.struct(
            F.when(is_ok, "response").otherwise("error").alias("kind"),
            F.when(is_ok, ok).otherwise(failed).alias("body"),
        ),
    )
    return calls.select("call_id", F.inline(records))


def parse_embedding_response(body: Column) -> Column:
    """Vectors of a response body in order, null where the body has another shape."""
    data = F.from_json(body, EMBEDDING_RESPONSE)["data"]
    vectors = F.transform(data, lambda item: item["embedding"])
    return F.when(~F.exists(vectors, lambda v: v.isNull()), vectors)


def parse_title_response(body: Column) -> Column:
    """Title in a chat response, null where the body has another shape."""
    message = F.get(F.from_json(body, CHAT_RESPONSE)["choices"], F.lit(0))["message"]
    return F.when(message.isNotNull(), strip(F.coalesce(message["content"], F.lit(""))))
