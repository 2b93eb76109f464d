"""Chat formatting with schema fingerprints, in DataFrame functions only.

Records of any layout arrive as JSON. The nested field paths of a record, with their kinds, are
hashed; the hash selects a declarative mapping that turns the record into canonical turns (role,
text). Turns are written in one template whose marks never occur in a text: control strings inside
roles and texts are escaped, and the escape can be undone. Assistant texts carry the loss mask.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

TURNS = "array<struct<role:string,text:string>>"
OPEN, HEAD_END, CLOSE = "<|turn:", "|>\n", "<|/turn|>\n"
#: Control strings of this and other templates, and what stands for each in a text. Fixed values.
ESCAPES = [
    ("\\", "\\\\"),
    ("<|", "\\l|"),
    ("|>", "\\p>"),
    ("</s>", "\\l/s>"),
    ("<s>", "\\ls>"),
    ("<<SYS>>", "\\l<SYS>>"),
    ("<</SYS>>", "\\l</SYS>>"),
    ("[INST]", "\\bINST]"),
    ("[/INST]", "\\b/INST]"),
]


#: A JSON string and what stands in it.
BODY = r'(?:[^"\\\x00-\x1F]++|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*+'
STRING = f'"{BODY}"'
#: The parser takes texts of any length; by default one of more than 20,000,000 characters would become null.
ANY_LENGTH = {"maxStringLen": str((1 << 31) - 1)}


class Layout(NamedTuple):
    """A record layout: its paths, its schema, and which of its fields make the turns.

    fixed: (role, fields joined by a blank line) for each turn in order; listed: (array, role field, text field), after them.
    """

    paths: str
    schema: str
    fixed: tuple = ()
    listed: tuple = ()


LAYOUTS = [
    Layout("OBJECT<messages: ARRAY<OBJECT<content: STRING, role: STRING>>>", "messages array<struct<role:string,content:string>>", listed=("messages", "role", "content")),
    Layout("OBJECT<completion: STRING, prompt: STRING>", "prompt string, completion string", (("user", "prompt"), ("assistant", "completion"))),
    Layout("OBJECT<instruction: STRING, output: STRING>", "instruction string, output string", (("user", "instruction"), ("assistant", "output"))),
    Layout("OBJECT<input: STRING, instruction: STRING, output: STRING>", "instruction string, input string, output string", (("user", "instruction", "input"), ("assistant", "output"))),
    Layout("OBJECT<conversations: ARRAY<OBJECT<from: STRING, value: STRING>>>", "conversations array<struct<`from`:string,value:string>>", listed=("conversations", "from", "value")),
    Layout("OBJECT<conversations: ARRAY<OBJECT<from: STRING, value: STRING>>, system: STRING>", "system string, conversations array<struct<`from`:string,value:string>>", (("system", "system"),), ("conversations", "from", "value")),
]
#: Other names of roles in listed layouts.
ROLES = {"human": "user", "gpt": "assistant"}


def _mapped(layout: Layout, r: Column) -> Column:
    turn = lambda role, text: F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    fixed = [turn(F.lit(role), F.array_join(F.filter(F.array(*(r[f] for f in fields)), lambda x: x != ""), "\n\n")) for role, *fields in layout.fixed]
    out = F.array(*fixed) if fixed else F.array().cast(TURNS)
    if layout.listed:
        name, role, text = layout.listed

        def named(m: Column) -> Column:
            own = m[role]
            for other, usual in ROLES.items() if role == "from" else ():
                own = F.when(m[role] == other, usual).otherwise(own)
            return turn(own, m[text])

        out = F.concat(out, F.transform(r[name], named))
    return out


def _mapping(layout: Layout):
    return lambda r: _mapped(layout, r)


def outline(record: Column) -> Column:
    """The JSON record with its string values empty and equal flat objects in a row as one: same paths, and small for any texts.

    Strings that are no valid JSON stay, so a broken record stays broken.
    """
    empty = F.regexp_replace(record, rf'({STRING}[ \t\r\n]*+:)|("){BODY}(")', "$1$2$3")
    return F.regexp_replace(empty, r"(\{[^{}\[\]]*+\})(?:,\1)++", "$1")


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a JSON record; null fields count as text, broken JSON has none."""
    paths = F.schema_of_variant(F.try_parse_json(outline(record)))
    return F.sha2(F.regexp_replace(paths, "VOID", "STRING"), 256)


def canonical_turns(record: Column) -> Column:
    """Turns of a JSON record by the mapping of its fingerprint; null where no mapping fits."""
    shape, out = fingerprint(record), F.lit(None).cast(TURNS)
    for layout in LAYOUTS:
        fits = shape == hashlib.sha256(layout.paths.encode()).hexdigest()
        out = F.when(fits, F.transform(F.array(F.from_json(record, layout.schema, ANY_LENGTH)), _mapping(layout))[0]).otherwise(out)
    return out


def escaped(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    """The text that escaped() was given: pairs of backslashes first, then the marks between them."""
    plain = lambda p: F.replace(F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\p"), F.lit("|")), F.lit("\\b"), F.lit("["))
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def segments(turns: Column) -> Column:
    """The formatted conversation in pieces, each with its loss mask."""
    piece = lambda text, loss: F.struct(text.alias("piece"), loss.alias("loss"))
    per_turn = lambda t: F.array(
        piece(F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(HEAD_END)), F.lit(False)),
        piece(escaped(t["text"]), t["role"] == "assistant"),
        piece(F.lit(CLOSE), F.lit(False)),
    )
    return F.flatten(F.transform(turns, per_turn))


def format_records(records: DataFrame, record: str = "record") -> DataFrame:
    """Format JSON records in the column named record: all columns, then turns, unread, loss_mask, formatted.

    Records of an unknown layout or broken JSON give null turns and an empty text, and unread says why
    (NO_RECORD, BROKEN_JSON, UNKNOWN_LAYOUT; null for those that were read); null roles and texts are
    empty; repeated rows give repeated rows; an empty table gives an empty result.
    loss_mask is the formatted text in pieces, each marked.
    """
    why = F.when(F.col(record).isNull(), "NO_RECORD").when(fingerprint(F.col(record)).isNull(), "BROKEN_JSON").otherwise("UNKNOWN_LAYOUT")
    rows = records.withColumn("turns", canonical_turns(F.col(record)))
    rows = rows.withColumn("unread", F.when(F.col("turns").isNull(), why))
    rows = rows.withColumn("loss_mask", segments(F.coalesce("turns", F.array().cast(TURNS))))
    return rows.withColumn("formatted", F.array_join(F.transform("loss_mask", lambda s: s["piece"]), ""))


def read_back(formatted: Column) -> Column:
    """Turns of a formatted conversation."""
    whole = F.filter(F.split(formatted, r"<\|/turn\|>\n", -1), lambda p: p != "")
    head = F.lit(len(OPEN) + 1)
    role = lambda p: F.substring_index(F.substring(p, head, F.length(p)), HEAD_END, 1)
    text = lambda p: F.substring(p, F.locate(HEAD_END, p) + len(HEAD_END), F.length(p))
    return F.transform(whole, lambda p: F.struct(unescaped(role(p)).alias("role"), unescaped(text(p)).alias("text")))


def packed(turn_rows: DataFrame) -> DataFrame:
    """conv_id, record: the turns of each conversation as one JSON record, in the layout that fits its roles.

    turn_rows: conv_id, turn, role, text. Rows of one conversation go by turn, equal turns by role and text.
    """
    rows = turn_rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    roles = F.transform("t", lambda x: x["role"])
    pair = F.to_json(F.struct(F.col("t")[0]["text"].alias("prompt"), F.get("t", F.lit(1))["text"].alias("completion")))
    tail = F.transform(F.slice("t", F.lit(2), F.size("t")), lambda x: F.struct(x["role"].alias("from"), x["text"].alias("value")))
    led = F.to_json(F.struct(F.col("t")[0]["text"].alias("system"), tail.alias("conversations")))
    plain = F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"], x["text"].alias("content"))).alias("messages")))
    safe = ~F.exists(roles, lambda r: r.isin("human", "gpt"))
    record = F.when(roles == F.array(F.lit("user"), F.lit("assistant")), pair).when((roles[0] == "system") & (F.size("t") > 1) & safe, led).otherwise(plain)
    return convs.select("conv_id", record.alias("record"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(told).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = format_records(packed(rows))
    # a packed conversation always fits a layout: one that does not was not read, and must not pass as an empty one
    read = F.when(F.col("turns").isNotNull(), F.col("formatted")).otherwise(F.raise_error(F.concat(F.lit("unread conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    out = out.select("conv_id", read.alias("formatted"), "loss_mask").withColumn("turns", read_back(F.col("formatted")))
    told_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("loss_mask", lambda s: s["loss"]), lambda s: unescaped(s["piece"])), "")
    out = out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told_turns, 256).alias("turns_sha256"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


ORACLE_OP5 = """
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(role, '\\', '\\\\'), '<|', '\\l|'), '|>', '\\p>'), '</s>', '\\l/s>'), '<s>', '\\ls>'), '<<SYS>>', '\\l<SYS>>'), '<</SYS>>', '\\l</SYS>>'), '[INST]', '\\bINST]'), '[/INST]', '\\b/INST]') AS er,
            replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\\', '\\\\'), '<|', '\\l|'), '|>', '\\p>'), '</s>', '\\l/s>'), '<s>', '\\ls>'), '<<SYS>>', '\\l<SYS>>'), '<</SYS>>', '\\l</SYS>>'), '[INST]', '\\bINST]'), '[/INST]', '\\b/INST]') AS et FROM r),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(er) + length(et) + 20)::BIGINT AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
