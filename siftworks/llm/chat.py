"""Chat formatting: records of any known layout become canonical turns, one template string and a loss mask."""

from __future__ import annotations

import hashlib
import json
import re
from itertools import combinations
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How the template marks a turn, and how control characters inside
# roles and texts are written, so that no marker can occur there.
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"}
TEXT_ESCAPES = str.maketrans({c: ESCAPES[c] for c in "\\#<"})
ROLE_ESCAPES = str.maketrans(ESCAPES)
UNESCAPE = {v[1]: k for k, v in ESCAPES.items()}
ESCAPED = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"### (.*?): (.*?)</turn>\n", re.S)

LEARNED = "assistant"


class Mapping(NamedTuple):
    """Where a layout keeps its turns.

    ``parts`` lists (role, path) of single fields in the order of their turns;
    fields of equal role that follow each other are joined by an empty line. ``turns``
    is the path of a list, with the names of its role and text fields.
    """

    name: str
    parts: tuple[tuple[str, str], ...] = ()
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        if self.turns is None:
            return [p for _, p in self.parts]
        return [f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"]


# The known layouts.
MAPPINGS = (
    Mapping("messages", turns="messages"),
    Mapping("messages_text", turns="messages", text="text"),
    Mapping("share", turns="conversations", role="from", text="value", roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt_completion", parts=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Mapping("prompt_response", parts=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping(
        "instruction",
        parts=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=("system", "input"),
    ),
    Mapping("question_answer", parts=(("user", "question"), ("assistant", "answer"))),
    Mapping("nested_prompt", parts=(("system", "prompt.system"), ("user", "prompt.user"), ("assistant", "response.text")), optional=("prompt.system",)),
)


def field_paths(value, at: str = "") -> set[str]:
    """Paths of all leaves; list positions are ``[]``. An empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{at}[]") for v in value))
    return {f"{at}[]" if value == [] else at}


def schema_fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _known() -> dict[str, Mapping]:
    """Every fingerprint that a mapping covers: its paths, with any of the optional ones left out."""
    table = {}
    for m in MAPPINGS:
        for n in range(len(m.optional) + 1):
            for gone in combinations(m.optional, n):
                table.setdefault(schema_fingerprint(p for p in m.paths() if p not in gone), m)
        if m.turns is not None:
            table.setdefault(schema_fingerprint([f"{m.turns}[]"]), m)
    return table


KNOWN = _known()


def _at(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _string(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(record, mapping: Mapping) -> list[tuple[str, str]]:
    if mapping.turns is not None:
        names = dict(mapping.roles)
        read = [(_string(_at(t, mapping.role)), _string(_at(t, mapping.text))) for t in _at(record, mapping.turns) or []]
        return [(names.get(role, role), text) for role, text in read]
    turns: list[tuple[str, str]] = []
    for role, path in mapping.parts:
        value = _at(record, path)
        if value is None:
            continue
        if turns and turns[-1][0] == role:
            turns[-1] = (role, "\n\n".join(x for x in (turns[-1][1], _string(value)) if x))
        else:
            turns.append((role, _string(value)))
    return turns


def render(turns: list[tuple[str, str]], learned: str = LEARNED) -> tuple[str, list[tuple[int, int]]]:
    """The template string and the spans, in code points, of the texts that the loss covers."""
    pieces, at, spans = [], 0, []
    for role, text in turns:
        head, body = OPEN + role.translate(ROLE_ESCAPES) + AFTER_ROLE, text.translate(TEXT_ESCAPES)
        if role == learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        pieces += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(pieces), spans


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: UNESCAPE[m[1]], text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a template string."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def format_record(raw: str | None) -> dict:
    """One JSON record: fingerprint, mapping, template string and loss spans.

    NULL, broken JSON and layouts without a mapping give no text, and a NULL mapping.
    """
    try:
        record = json.loads(raw) if raw is not None else None
    except ValueError:
        return {"fingerprint": None, "mapping": None, "formatted": None, "loss": []}
    key = schema_fingerprint(field_paths(record))
    mapping = KNOWN.get(key)
    if mapping is None:
        return {"fingerprint": key, "mapping": None, "formatted": None, "loss": []}
    formatted, spans = render(canonical_turns(record, mapping))
    return {"fingerprint": key, "mapping": mapping.name, "formatted": formatted, "loss": spans}


FORMAT = "struct<fingerprint:string,mapping:string,formatted:string,loss:array<struct<start:long,end:long>>>"


def format_records(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with fingerprint, mapping, formatted and loss read from their JSON column.

    Rows are independent; none is dropped. Columns of these names are replaced.
    """

    @F.pandas_udf(FORMAT)
    def formatted(raw: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([format_record(x) for x in raw], columns=["fingerprint", "mapping", "formatted", "loss"])

    names = ["fingerprint", "mapping", "formatted", "loss"]
    return records.drop(*names).withColumn("_f", formatted(F.col(record))).select("*", "_f.*").drop("_f")


def turn_rows_to_records(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, record): tables of one row per turn as JSON records of the ``messages`` layout.

    Rows are ordered by turn (NULL first), equal turns by role and text; a NULL
    role or text is ''. Rows with a NULL conversation are one conversation. A record is
    one string: for conversations of any length use ``turn_records``.
    """
    message = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("content"),
    )
    return (
        rows.groupBy(F.col(conv_id).alias("conv_id"))
        .agg(F.sort_array(F.collect_list(message)).alias("m"))
        .select("conv_id", F.to_json(F.struct(F.transform("m", lambda x: F.struct(x["role"], x["content"])).alias("messages"))).alias("record"))
    )


def turn_records(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, record): the same turns, each as a ``messages`` record of its own, with a conversation's rows next to each other.

    The template strings of a conversation's records, one after the other, are that of the whole. The order within
    a partition is that of the conversations, then of their turns, as in ``turn_rows_to_records``; sorting spills, and
    no conversation is held in memory.
    """
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    return (
        rows.select(
            F.col(conv_id).alias("conv_id"),
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", F.to_json(F.struct(F.array(message).alias("messages"))).alias("record"))
    )


class _Reading:
    """What has been read of one conversation so far: counts and open hashes, whatever its length."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[dict]) -> None:
        for role, text in read_back(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for span in spans:
            learned = unescape(formatted[span["start"] : span["end"]])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        self.formatted_chars += len(formatted)

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """The ``digests`` of whole conversations from the formatted rows of ``turn_records``, read as they stream by.

    One row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches):
        open_, kinds = None, None
        for batch in batches:
            kinds = pa.schema(
                [("conv_id", batch.schema.field("conv_id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string())]
                + [("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
            )
            done = []
            for conv_id, text, spans in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")]):
                if open_ is None or open_.conv_id != conv_id:
                    if open_ is not None:
                        done.append(open_.row())
                    open_ = _Reading(conv_id)
                open_.add(text, spans)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in done], schema=kinds)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, open_.row()))], schema=kinds)

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(read, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What the template strings and loss masks hold when read back: counts and hashes.

    Keeps all columns but formatted and loss. Without a text all values are NULL.
    """
    kind = "struct<n_turns:long,turns_sha256:string,loss_chars:long,loss_sha256:string,formatted_chars:long>"

    @F.pandas_udf(kind)
    def read(texts: pd.Series, loss: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(texts, loss):
            if text is None:
                out.append((None,) * 5)
                continue
            turns = read_back(text)
            learned = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
            all_turns = "".join(f"{role}\n{body}\n" for role, body in turns)
            out.append((len(turns), _sha(all_turns), len(learned), _sha(learned), len(text)))
        return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.withColumn("_d", read("formatted", "loss")).select("*", "_d.*").drop("_d", "formatted", "loss")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
