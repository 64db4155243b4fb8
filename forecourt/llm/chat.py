"""Chat formatting with typed content parts.

A turn's content is a list of parts (text, image, audio, document).  A visitor
walks them in order and flattens each: text is escaped, any other part becomes
its placeholder, and its reference and expanded token count are recorded.  The
template puts every turn between control strings:

    <s>[TURN]role\\n content [/TURN] ... </s>

Control strings start with `<` or `[`.  In roles and texts each `<`, `[` and
backslash is followed by one backslash, so none of them can spell a control
string, and taking those backslashes away gives the text back.  A line break in
a role becomes `[n`.

The loss mask is a list of character ranges of the formatted text: the content
of each turn of the trained role.

Rows are gathered by conversation (ordered by turn, then role and text, nulls
first) inside Spark; a conversation is one output row and as large as itself,
whatever else is in the table.

Defined cases: a null role or text is empty, a null turn comes first; rows of a
null conversation number form one conversation; repeated rows are turns of their
own; a null part is nothing, a part without a kind is text; a part of an unknown
kind is an error; very long texts stay whole; an empty table gives no rows; columns
that are not named in the call are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm import staging

OPEN, CLOSE, BEGIN, END = "<s>", "</s>", "[TURN]", "[/TURN]"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
_SPECIAL = re.compile(r"[<\[\\]")
_ESCAPED = re.compile(r"([<\[\\])\\")

PART = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("reference", T.StringType()), T.StructField("tokens", T.LongType()),
])
_ATTACHMENT = T.StructType([
    T.StructField("turn", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("reference", T.StringType()), T.StructField("at", T.LongType()),
    T.StructField("tokens", T.LongType()),
])
_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("formatted", T.StringType()),
    T.StructField("loss", T.ArrayType(_SPAN)), T.StructField("attachments", T.ArrayType(_ATTACHMENT)),
    T.StructField("expanded_tokens", T.LongType()),
])


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Visitor:
    """Flattens the parts of one conversation, turn by turn."""

    trained: str
    pieces: list[str] = field(default_factory=list)
    length: int = 0
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def turn(self, number: int, role: str, parts: list[dict]) -> None:
        self.put(BEGIN + escape(role).replace("\n", "[n") + "\n")
        start = self.length
        for part in parts:
            if part is not None:
                getattr(self, f"visit_{part['kind'] or 'text'}")(number, part)
        if role == self.trained:
            self.loss.append({"start": start, "end": self.length})
        self.put(END)

    def visit_text(self, number: int, part: dict) -> None:
        self.put(escape(part["text"] or ""))

    def _attach(self, number: int, part: dict) -> None:
        self.attachments.append({
            "turn": number, "kind": part["kind"], "reference": part["reference"], "at": self.length,
            "tokens": part["tokens"] or 0})
        self.put(PLACEHOLDERS[part["kind"]])

    visit_image = visit_audio = visit_document = _attach


def format_conversations(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str | None = "text", parts: str | None = None, trained: str = "assistant",
) -> DataFrame:
    """One row a conversation: conv_id, formatted, loss, attachments, expanded_tokens (of all attachments).

    Content is the column `parts` (an array of PART) where given, else one text part of `text`.
    """
    none = F.lit(None).cast("string")
    content = staging.quoted(parts).cast(T.ArrayType(PART)) if parts else F.array(F.struct(
        F.lit("text").alias("kind"), staging.quoted(text).cast("string").alias("text"), none.alias("reference"),
        F.lit(None).cast("long").alias("tokens")))
    turns = rows.select(
        staging.quoted(key).cast("long").alias("conv_id"),
        F.struct(
            staging.quoted(turn).cast("long").alias("turn"),
            F.coalesce(staging.quoted(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(content, F.array().cast(T.ArrayType(PART))).alias("parts")).alias("t"))
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(FORMATTED)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                visitor = Visitor(trained)
                visitor.put(OPEN)
                for t in row["turns"]:
                    visitor.turn(t["turn"], t["role"], t["parts"])
                visitor.put(CLOSE)
                out.append({
                    "conv_id": row["conv_id"], "formatted": "".join(visitor.pieces), "loss": visitor.loss,
                    "attachments": visitor.attachments,
                    "expanded_tokens": sum(a["tokens"] for a in visitor.attachments)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return gathered.mapInArrow(write, FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, content) of each turn.  Content keeps placeholders; a text alone is given back as it was."""
    at, turns = len(OPEN), []
    while at < len(formatted) - len(CLOSE):
        end = formatted.index(END, at)
        role, _, content = formatted[at + len(BEGIN): end].partition("\n")
        at = end + len(END)
        turns.append((unescape(role.replace("[n", "\n")), unescape(content)))
    return turns


def query(spark, sf_dir: str) -> DataFrame:
    """Every conversation of the table and the one of control strings, read back from the written output."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], table.schema)
    written = staging.stage(format_conversations(table.unionByName(more)), "chat")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                turns = parse(row["formatted"])
                trained = "".join(unescape(row["formatted"][s["start"]: s["end"]]) for s in row["loss"])
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append({
                    "conv_id": row["conv_id"], "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256(said.encode()).hexdigest(),
                    "loss_chars": len(trained), "loss_sha256": hashlib.sha256(trained.encode()).hexdigest(),
                    "formatted_chars": len(row["formatted"])})
            if out:
                yield pa.RecordBatch.from_pylist(out)

    return written.select("conv_id", "formatted", "loss").mapInArrow(
        digest, "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, "
        "formatted_chars BIGINT")


ORACLE_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
long AS (SELECT *, length(regexp_replace(role || text, '[^<\[\\]', '', 'g'))
         + length(role) - length(replace(role, chr(10), '')) AS specials FROM said)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(7 + sum(6 + 1 + 7 + length(role) + length(text) + specials) AS BIGINT) AS formatted_chars
FROM long GROUP BY conv_id
"""
