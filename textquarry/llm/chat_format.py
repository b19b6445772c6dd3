"""Chat formatting: records of many layouts to canonical turns, turns to a marked and masked text, and back.

A record is a JSON string. Its schema, the nested field paths with all types left out, is hashed; the fingerprint selects a
declarative mapping, which names the paths of the turns, their roles and texts. All of it is column expressions on
variant values; records that no mapping knows are given back with their fingerprint, and `formatted_conversations` fails on them.
The variant parser knows no string of over 20,000,000 characters; rows with a column per field are mapped by their names and
not parsed, so their texts may be as long as a cell.

A turn is written as `[INST]role[/INST]text</s>`. Control strings in roles and texts are broken by a backslash after
their first character, and backslashes are doubled, so the format is reversible and no text can end a turn.
The loss mask is a span of code points: the texts of assistants.

A conversation may hold any part of all rows: turns are formatted row by row, and digests are taken from a stream of
sorted turns, so no task holds a conversation.

Defined cases: a null text or role is empty; turns are ordered by turn (null first), then role, then text; a null conversation id
is a conversation; repeated rows are repeated turns; an empty table gives an empty result; further columns of turn rows
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.sources.staging import staging_path

# The control strings of the template.
ROLE_OPENS, ROLE_CLOSES, TURN_CLOSES = "[INST]", "[/INST]", "</s>"

TURNS = "conv_id bigint, turn bigint, role string, text string"
FORMATTED = "conv_id bigint, turn bigint, formatted string, loss_start int, loss_end int"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns.

    examples: records whose schema has this mapping. conversation: path of the id. turns: path of the list of turns,
    with role and text below an element, or None for a record that is one turn, with `turn` its number. fixed: instead of a list, the (role,
    paths of its text, joined by blank lines where not empty) of each turn. roles: other names of roles.
    """

    name: str
    examples: tuple[dict, ...]
    conversation: str
    turns: str | None = None
    role: str = "$.role"
    text: str = "$.text"
    turn: str | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


_HUMAN = {"human": "user", "gpt": "assistant", "bot": "assistant"}
MAPPINGS: tuple[Mapping, ...] = (
    Mapping("turn rows", ({"conv_id": 1, "role": "", "text": "", "turn": 0},), "$.conv_id", turn="$.turn"),
    Mapping(
        "messages",
        ({"conv_id": 1, "messages": [{"role": "", "content": ""}]}, {"conv_id": 1, "messages": []}),
        "$.conv_id",
        turns="$.messages",
        text="$.content",
    ),
    Mapping(
        "from and value",
        ({"conversations": [{"from": "", "value": ""}], "id": 1},),
        "$.id",
        turns="$.conversations",
        role="$.from",
        text="$.value",
        roles=_HUMAN,
    ),
    Mapping(
        "prompt",
        ({"id": 1, "prompt": "", "response": ""},),
        "$.id",
        fixed=(("user", ("$.prompt",)), ("assistant", ("$.response",))),
    ),
    Mapping(
        "instruction",
        ({"id": 1, "instruction": "", "input": "", "output": ""}, {"id": 1, "instruction": "", "output": ""}),
        "$.id",
        fixed=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",))),
    ),
)


def schema_fingerprint(record: Column) -> Column:
    """A hash of the nested field paths of a variant. Keys are in order there; types do not count."""
    types = r": (?!OBJECT|ARRAY)[A-Z]+(\(\d+, ?\d+\))?|(?<=ARRAY<)(?!OBJECT|ARRAY)[A-Z]+(\(\d+, ?\d+\))?"
    return F.when(record.isNotNull(), F.xxhash64(F.regexp_replace(F.schema_of_variant(record), types, "")))


def fingerprints_of(spark: SparkSession, mappings: Sequence[Mapping] = MAPPINGS) -> dict[int, int]:
    """Fingerprint to the number of its mapping."""
    rows = [(i, json.dumps(x)) for i, m in enumerate(mappings) for x in m.examples]
    found = spark.createDataFrame(rows, "at int, record string").select(
        "at", schema_fingerprint(F.parse_json("record")).alias("fp")
    )
    out: dict[int, int] = {}
    for row in found.collect():  # one row per declared example
        if out.setdefault(row["fp"], row["at"]) != row["at"]:
            raise ValueError(f"two mappings have the schema of {mappings[row['at']].name}")
    return out


def _string(value: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(value, path, "string"), F.lit(""))


def _turns_of(record: Column, m: Mapping) -> Column:
    """An array of (turn, role, text)."""

    def role(value: Column) -> Column:
        return _renamed(_string(value, m.role), m)

    def one(turn: Column, role_: Column, text: Column) -> Column:
        return F.struct(turn.cast("long").alias("turn"), role_.alias("role"), text.alias("text"))

    if m.fixed:
        rows = []
        for i, (name, paths) in enumerate(m.fixed):
            texts = F.filter(F.array(*(_string(record, p) for p in paths)), lambda x: x != "")
            rows.append(one(F.lit(i), F.lit(name), F.array_join(texts, "\n\n")))
        return F.array(*rows)
    if m.turns is None:
        turn = F.try_variant_get(record, m.turn, "bigint") if m.turn else F.lit(0)
        return F.array(one(turn, role(record), _string(record, m.text)))
    listed = F.try_variant_get(record, m.turns, "array<variant>")
    return F.transform(listed, lambda value, i: one(i, role(value), _string(value, m.text)))


def _mapped(records: DataFrame, mappings: Sequence[Mapping]) -> DataFrame:
    known = fingerprints_of(records.sparkSession, mappings)
    record = F.try_parse_json("record")
    typed = records.select("record", record.alias("value")).withColumn("fingerprint", schema_fingerprint(F.col("value")))
    at = F.lit(None).cast("int")
    for fp, i in known.items():
        at = F.when(F.col("fingerprint") == fp, i).otherwise(at)
    return typed.withColumn("mapping", at)


def _renamed(name: Column, m: Mapping) -> Column:
    out = name
    for other, canonical in m.roles.items():
        out = F.when(name == other, canonical).otherwise(out)
    return out


def typed_turns(rows: DataFrame, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """conv_id, turn, role and text of rows with a column per field; the column names are the schema that selects the mapping."""
    spark = rows.sparkSession
    record = F.parse_json(F.lit(json.dumps(dict.fromkeys(rows.columns, 0))))
    at = fingerprints_of(spark, mappings).get(spark.range(1).select(schema_fingerprint(record)).first()[0])
    if at is None or mappings[at].turns or mappings[at].fixed:
        raise ValueError(f"no mapping of single turns has the columns {', '.join(rows.columns)}")
    m = mappings[at]

    def column(path: str) -> Column:
        return F.col(f"`{path.removeprefix('$.')}`")

    def string(path: str) -> Column:
        return F.coalesce(column(path).cast("string"), F.lit(""))

    turn = column(m.turn) if m.turn else F.lit(0)
    return rows.select(
        column(m.conversation).cast("long").alias("conv_id"),
        turn.cast("long").alias("turn"),
        _renamed(string(m.role), m).alias("role"),
        string(m.text).alias("text"),
    )


def canonical_turns(records: DataFrame, mappings: Sequence[Mapping] = MAPPINGS, strict: bool = False) -> DataFrame:
    """conv_id, turn, role and text of all records (column record, JSON strings) that a mapping knows. strict: others are an error."""
    turns, conversation = F.lit(None), F.lit(None)
    for i, m in enumerate(mappings):
        here = F.col("mapping") == i
        turns = F.when(here, _turns_of(F.col("value"), m)).otherwise(turns)
        conversation = F.when(here, F.try_variant_get(F.col("value"), m.conversation, "bigint")).otherwise(conversation)
    rows = _mapped(records, mappings)
    if strict:
        said = F.concat(F.lit("no mapping knows the record "), F.coalesce(F.substring("record", 1, 200), F.lit("null")))
        rows = rows.withColumn("mapping", F.when(F.col("mapping").isNull(), F.raise_error(said)).otherwise(F.col("mapping")))
    rows = rows.filter("mapping IS NOT NULL")
    return rows.select(conversation.cast("long").alias("conv_id"), F.explode(turns).alias("t")).select(
        "conv_id", F.col("t.turn").alias("turn"), F.col("t.role").alias("role"), F.col("t.text").alias("text")
    )


def unmapped(records: DataFrame, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """record and fingerprint of those that no mapping knows; the fingerprint is null where it is no JSON."""
    return _mapped(records, mappings).filter("mapping IS NULL").select("record", "fingerprint")


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    once = F.regexp_replace(doubled, r"(<)(?=/?s>|</?SYS>>)", r"$1\\")
    return F.regexp_replace(once, r"(\[)(?=/?INST\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, turn, formatted and the loss span, in code points, of an assistant's turn."""
    role = F.concat(F.lit(ROLE_OPENS), escaped(F.coalesce("role", F.lit(""))), F.lit(ROLE_CLOSES))
    rows = turns.select(
        "conv_id", "turn", "role", role.alias("head"), escaped(F.coalesce("text", F.lit(""))).alias("body")
    )
    under_loss = F.col("role") == "assistant"
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.concat("head", "body", F.lit(TURN_CLOSES)).alias("formatted"),
        F.when(under_loss, F.char_length("head")).alias("loss_start"),
        F.when(under_loss, F.char_length("head") + F.char_length("body")).alias("loss_end"),
    )


def parsed(rows: DataFrame) -> DataFrame:
    """Turns from formatted ones: role, text and loss_text, null without loss."""
    text = F.col("formatted")
    close = F.locate(ROLE_CLOSES, text)
    role = F.substring(text, F.lit(len(ROLE_OPENS) + 1), close - len(ROLE_OPENS) - 1)
    begin = close + len(ROLE_CLOSES)
    body = F.substring(text, begin, F.char_length(text) - begin - len(TURN_CLOSES) + 1)
    loss = F.substring(text, F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    return rows.select(
        "conv_id",
        "turn",
        unescaped(role).alias("role"),
        unescaped(body).alias("text"),
        unescaped(loss).alias("loss_text"),
        F.char_length(text).alias("chars"),
    )


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations that follow each other whole."""
    done: list[tuple] = []
    open_, conv, n, loss_chars, chars = False, None, 0, 0, 0
    turns, loss = hashlib.sha256(), hashlib.sha256()

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        columns = zip(zip(*done, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=names)

    for rows in batches:
        columns = (rows.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss_text", "chars"))
        for conv_id, role, text, loss_text, size in zip(*columns, strict=True):
            if not open_ or conv_id != conv:
                if open_:
                    done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                open_, conv, n, loss_chars, chars = True, conv_id, 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            n, chars = n + 1, chars + size
            turns.update(f"{role}\n{text}\n".encode())
            if loss_text is not None:
                loss.update(loss_text.encode())
                loss_chars += len(loss_text)
        if len(done) >= 10_000:
            yield batch()
            done = []
    if open_:
        done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        yield batch()


def write_conversations(turns: DataFrame, folder: str) -> None:
    """Write formatted turns, sorted within conversations, as Parquet below `folder`, which must not exist."""
    ordered = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    formatted(ordered).write.parquet(folder)


def conversation_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per conversation, read back from the files: turns, digests of turns and of the text under loss, size."""
    turns = parsed(spark.read.schema(FORMATTED).parquet(folder))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text", "loss_text", "chars").mapInArrow(_digest_batches, DIGESTS)


def turn_records(turns: DataFrame) -> DataFrame:
    """Rows of turns as records of the layout `turn rows`."""
    columns = F.struct("conv_id", "role", "text", "turn")
    return turns.select(F.to_json(columns, {"ignoreNullFields": "false"}).alias("record"))


def formatted_conversations(records: DataFrame, folder: str | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Map, format and write records and rows of turns, to the shared folder unless told otherwise, and read them back.

    A record that no mapping knows is an error; `unmapped` lists them all.
    """
    spark = records.sparkSession
    folder = folder or staging_path(spark, "conversations")
    turns = canonical_turns(records, strict=True)
    write_conversations(turns if rows is None else typed_turns(rows).union(turns), folder)
    return conversation_digests(spark, folder)
