"""Chat formatting: a finite-state machine over roles and a declarative template.

Rows of a conversation are read in order of turn, one after another: the machine checks the order of
roles and each turn becomes segments (mark, text, mark) with a loss flag. Control strings inside
roles and texts are escaped so that ``read_turn`` gets both back exactly. A conversation is streamed with a
state of one role and running digests, so its length bounds no task's memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Template:
    """How a turn is written, and which roles may follow which.

    ``transitions`` maps a state (the last role; "" at the start) to the roles allowed next; ``final`` are
    the states a conversation may end in; the texts of ``loss_roles`` are under the loss mask.
    """

    mark: str = "###"
    role_end: str = ": "
    close: str = "</turn>"
    after: str = "\n"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def escaped(self, text: str, role: bool = False) -> str:
        """``text`` with an escape before escapes and wherever a control string begins."""
        text = text.replace(self.escape, self.escape * 2)
        for control in (self.mark, self.close, self.role_end[0] if role else ""):
            if control:  # a look-ahead, as control strings may overlap themselves
                text = re.sub(f"(?={re.escape(control)})", lambda _: self.escape, text)
        return text

    def unescaped(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.S)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        return [(f"{self.mark} {self.escaped(role, True)}{self.role_end}", False), (self.escaped(text), role in self.loss_roles), (self.close + self.after, False)]

    def read_turn(self, formatted: str) -> tuple[str, str]:
        """(role, text) of one formatted turn; anything else than exactly one turn is an error."""
        e = re.escape(self.escape)
        body = rf"((?:{e}.|(?!{re.escape(self.mark)})(?!{re.escape(self.close)})[^{e}])*?)"
        m = re.fullmatch(f"{re.escape(self.mark)} {body}{re.escape(self.role_end)}{body}{re.escape(self.close)}{re.escape(self.after)}", formatted, re.S)
        if not m:
            raise ValueError("not a formatted turn")
        return self.unescaped(m[1]), self.unescaped(m[2])


class RoleMachine:
    """Counts turns that the template doesn't allow where they stand; it goes on from the role it met."""

    def __init__(self, template: Template) -> None:
        self.template, self.state, self.violations = template, "", 0

    def turn(self, role: str) -> bool:
        allowed = role in self.template.transitions.get(self.state, ())
        self.violations += not allowed
        self.state = role
        return allowed

    def end(self) -> int:
        return self.violations + (self.state not in self.template.final)


_TURN = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("allowed", pa.bool_()), ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])))])
_TURN_DDL = "conv_id long, turn_no long, allowed boolean, segments array<struct<text: string, loss: boolean>>"
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("violations", pa.int64())])
_DIGEST_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, violations long"


def format_turns(conversations: DataFrame, template: Template) -> DataFrame:
    """One row per turn, in order within its partition: conv_id, turn_no (from 0), allowed, segments (text, loss).

    Turns are ordered by turn, then role, then text (null turns first). Null roles and texts are empty. Rows
    with a null conv_id are one conversation. Repeated rows are turns of their own. Roles out of order are
    flagged, never dropped. Other columns are not read; an empty table gives no rows.
    """
    common.tune(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, machine, number = object(), RoleMachine(template), 0
        for ids, roles, texts in common.columns_of(batches, "conv_id", "role", "text"):
            numbers, allowed, segments = [], [], []
            for conv_id, role, text in zip(ids, roles, texts, strict=True):
                if conv_id != last:
                    last, machine, number = conv_id, RoleMachine(template), 0
                numbers.append(number)
                allowed.append(machine.turn(role))
                segments.append([{"text": t, "loss": f} for t, f in template.segments(role, text)])
                number += 1
            yield common.batch_of(_TURN, ids, numbers, allowed, segments)

    return ordered.mapInArrow(run, _TURN_DDL)


def read_back(turns: DataFrame, template: Template) -> DataFrame:
    """One row per conversation from the output of ``format_turns``: digests of what its text says.

    Roles and texts are parsed from the formatted text, the loss text from the flagged segments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Digests | None = None
        for ids, segments in common.columns_of(batches, "conv_id", "segments"):
            out = []
            for conv_id, parts in zip(ids, segments, strict=True):
                if state is None or state.conv_id != conv_id:
                    if state is not None:
                        out.append(state.row())
                    state = _Digests(conv_id, template)
                state.add(parts)
            if out:
                yield common.batch_of(_DIGEST, *zip(*out, strict=True))
        if state is not None:
            yield common.batch_of(_DIGEST, *zip(state.row(), strict=True))

    return turns.mapInArrow(run, _DIGEST_DDL)


class _Digests:
    def __init__(self, conv_id: int | None, template: Template) -> None:
        self.conv_id, self.template, self.machine = conv_id, template, RoleMachine(template)
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, parts: list[dict]) -> None:
        formatted = "".join(p["text"] for p in parts)
        role, text = self.template.read_turn(formatted)
        self.machine.turn(role)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
        self.n, self.chars = self.n + 1, self.chars + len(formatted)
        for p in parts:
            if p["loss"]:
                plain = self.template.unescaped(p["text"])
                self.loss_chars += len(plain)
                self.loss.update(plain.encode("utf-8", "replace"))

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.machine.end()


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and number -7, whose texts hold control strings."""
    held = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(held).alias("text"))
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return read_back(format_turns(rows.unionByName(extra), Template()), Template())


OP8_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, lag(role, 1, '') OVER w AS prev, lead(role) OVER w IS NULL AS is_last,
    length(text) + length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '</turn>', ''))) // 7
      + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
      + length(role) + length(role) - length(replace(role, '\', '')) + length(role) - length(replace(role, ':', '')) + (length(role) - length(replace(role, '</turn>', ''))) // 7
      + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{3,}'), lambda x: length(x) - 2)), 0) + 14 AS chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  sum((prev || '>' || role NOT IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user'))::INT + (is_last AND role <> 'assistant')::INT)::BIGINT AS violations
FROM e GROUP BY conv_id
"""
