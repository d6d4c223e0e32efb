"""Chat records of many layouts as canonical turns, and turns as training text. DataFrame functions only.

A record's nested field paths, without the types of their values, are its shape; the hash of the shape selects a
mapping that declares where turns, roles and texts are. The template marks turns, and escapes in texts every
string that could be read as a mark, by a backslash after the first character; an escaped string that the
text already had gets one more, so that unescaping is exact. The loss mask is kept as runs: for each turn
the characters before the assistant's text, and that text's length.

Defined results: null role and null text are empty; turns with equal numbers come in the order of role, then text; repeated
rows are turns of their own; a null conv_id is one conversation; a record of unknown shape has null turns and its
fingerprint; an empty table gives the rows added beside it, if any; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.common import read

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """Where a layout has its turns. turns: path of a list with fields role and text; else parts: (role, path, ...)
    for one turn each, whose non-empty values are joined by a blank line."""

    shape: str
    turns: str | None = None
    role: str = "role"
    text: str = "text"
    renamed: dict[str, str] = field(default_factory=dict)
    parts: tuple[tuple[str, ...], ...] = ()

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.shape.encode()).hexdigest()

    def apply(self, record: Column) -> Column:
        if self.turns:
            rows = F.variant_get(record, self.turns, f"array<struct<{self.role}:string,{self.text}:string>>")

            def turn(t: Column) -> Column:
                role = F.coalesce(t[self.role], F.lit(""))
                for a, b in self.renamed.items():
                    role = F.when(role == a, b).otherwise(role)
                return F.struct(role.alias("role"), F.coalesce(t[self.text], F.lit("")).alias("text"))

            return F.transform(rows, turn)
        out = []
        for role, *paths in self.parts:
            values = [F.coalesce(F.variant_get(record, p, "string"), F.lit("")) for p in paths]
            text = values[0] if len(values) == 1 else F.array_join(F.filter(F.array(*values), lambda v: v != ""), "\n\n")
            out.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
        return F.array(*out)


MAPPINGS = (
    Mapping("OBJECT<messages: ARRAY<OBJECT<role: *, text: *>>>", "$.messages"),
    Mapping("OBJECT<messages: ARRAY<OBJECT<content: *, role: *>>>", "$.messages", text="content"),
    Mapping("OBJECT<conversations: ARRAY<OBJECT<from: *, value: *>>>", "$.conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    Mapping("OBJECT<messages: ARRAY<*>>", "$.messages"),
    Mapping("OBJECT<conversations: ARRAY<*>>", "$.conversations"),
    Mapping("OBJECT<prompt: *, response: *>", parts=(("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("OBJECT<completion: *, prompt: *>", parts=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("OBJECT<prompt: *, response: *, system: *>", parts=(("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("OBJECT<instruction: *, output: *>", parts=(("user", "$.instruction"), ("assistant", "$.output"))),
    Mapping("OBJECT<input: *, instruction: *, output: *>", parts=(("user", "$.instruction", "$.input"), ("assistant", "$.output"))),
    Mapping("OBJECT<answer: *, question: *>", parts=(("user", "$.question"), ("assistant", "$.answer"))),
)


def shape(record: Column) -> Column:
    """The nested field paths of a variant, in order, with * for values."""
    kinds = r"(STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|VARIANT)(?=[,>]|$)"
    return F.regexp_replace(F.schema_of_variant(record), kinds, "*")


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, fingerprint, turns) of (conv_id, record), record a variant."""
    marked = records.select("conv_id", "record", F.sha2(shape(F.col("record")), 256).alias("fingerprint"))
    turns = None
    for m in mappings:
        turns = (F if turns is None else turns).when(F.col("fingerprint") == m.fingerprint, m.apply(F.col("record")))
    return marked.select("conv_id", "fingerprint", turns.alias("turns"))


def records_of_rows(rows: DataFrame) -> DataFrame:
    """Conversations kept as one row a turn, as records with a list of messages."""
    own = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    messages = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return own.groupBy("conv_id").agg(messages.alias("messages")).select("conv_id", F.to_variant_object(F.struct("messages")).alias("record"))


# --- the template ---------------------------------------------------------------------------------------------

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_CONTROL = r"(\||/?s>|</?SYS>>|/?INST\])"
_ESCAPE = r"([<\[])(\\*)" + _CONTROL
_UNESCAPE = r"([<\[])\\(\\*)" + _CONTROL


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def _escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_runs) of (conv_id, turns); loss_runs has (skip, keep) for each turn."""
    safe = F.transform("turns", lambda t: F.struct(_escaped_role(t["role"]).alias("role"), escaped(t["text"]).alias("text"), (t["role"] == "assistant").alias("learn")))
    whole = F.array_join(F.transform("safe", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE))), "")
    keep = lambda t: F.when(t["learn"], F.char_length(t["text"])).otherwise(0)
    runs = F.transform("safe", lambda t: F.struct((F.lit(len(OPEN) + 1) + F.char_length(t["role"])).cast("long").alias("skip"), keep(t).cast("long").alias("keep")))
    return turns.select("conv_id", safe.alias("safe")).select("conv_id", whole.alias("formatted"), runs.alias("loss_runs"))


def read_back(texts: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars) from formatted texts and their masks."""
    parts = F.split("formatted", r"<\|im_end\|>\n")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(p: Column) -> Column:
        role = F.substring_index(p.substr(F.lit(len(OPEN) + 1), F.length(p)), "\n", 1)
        return F.struct(_unescaped_role(role).alias("role"), unescaped(p.substr(F.lit(len(OPEN) + 2) + F.length(role), F.length(p))).alias("text"))

    loss = F.zip_with("parts", "loss_runs", lambda p, r: unescaped(p.substr((r["skip"] + 1).cast("int"), r["keep"].cast("int"))))
    return texts.select("conv_id", "formatted", "loss_runs", parts.alias("parts")).select("conv_id", F.transform("parts", turn).alias("turns"), F.array_join(loss, "").alias("loss_text"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def digest(back: DataFrame) -> DataFrame:
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
    )


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = records_of_rows(read(spark, sf_dir, "conversations"))
    odd = "</s>[INST] ok [/INST]"
    added = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.to_variant_object(F.struct(F.lit(odd).alias("prompt"), F.lit(odd).alias("response"))).alias("record"))
    return digest(read_back(formatted(canonical_turns(records.unionByName(added)))))


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), safe AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])', '\1\\\2\3', 'g') AS escaped FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(escaped) + 24) AS BIGINT) AS formatted_chars
FROM safe GROUP BY conv_id
"""
