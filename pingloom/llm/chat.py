"""Chat formatting: schema fingerprints choose declarative mappings into canonical turns; a template marks the turns.

A record is a JSON string.  Its fingerprint is the hash of its nested field paths, to any depth (types don't count, elements of an
array share their paths).  LAYOUTS names, for each known set of paths, where roles and texts are, so records of unlike layouts
can stand in one column.  A record of unknown layout, or that isn't JSON, gives a row with null turns: callers see what isn't
mapped.  The query puts each conversation into one of three layouts by its turns and id, and reads it back by fingerprint.

A formatted conversation is START role MIDDLE text END for each turn.  A control string inside a role or text (of this
template or of other common ones) gets a backslash after its first character, one more if it has some, so that undoing
it is exact.  The loss mask is a list of (start, length) in code points, one for each assistant text.

Nulls and empty texts: a null role or text is empty; an empty text is an empty turn.  A null conv_id is a conversation of its
own.  Ties in turn go by role, then text; repeated rows are repeated turns.  A record of over 128 MB is not mapped.  Empty
table: no conversations (but for rows that the query adds).  Extra columns of records are kept, those of conversations not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings: the first character, and what follows it.
_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|/?<?/?SYS>>)"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|/?<?/?SYS>>)"

#: Layouts: the paths of a record's fields, and its turns as (path of roles or 'role, path of texts) in order.  A path into an
#: array ("messages[].role") gives one turn for each element.
LAYOUTS = {
    "messages": (("messages[].content", "messages[].role"), (("messages[].role", "messages[].content"),)),
    "chat": (("chat.turns[].speaker.role", "chat.turns[].text"), (("chat.turns[].speaker.role", "chat.turns[].text"),)),
    "conversations": (("conversations[].from", "conversations[].value"), (("conversations[].from", "conversations[].value"),)),
    "instruction": (("input", "instruction", "output"), (("'user", "instruction+input"), ("'assistant", "output"))),
    "instruction_only": (("instruction", "output"), (("'user", "instruction"), ("'assistant", "output"))),
    "prompt": (("completion", "prompt"), (("'user", "prompt"), ("'assistant", "completion"))),
    "question": (("answer", "question"), (("'user", "question"), ("'assistant", "answer"))),
    "system": (("response", "system", "user"), (("'system", "system"), ("'user", "user"), ("'assistant", "response"))),
}
#: Layouts whose roles have other names.
RENAMED = {"conversations"}
#: Other names of the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant"}


def _tree(paths) -> dict:
    """Nested fields of paths; an array's elements are under "[]"."""
    tree: dict = {}
    for path in paths:
        at = tree
        for name in path.replace("[]", ".[]").split("."):
            at = at.setdefault(name, {})
    return tree


def _shape(tree: dict) -> str:
    """A tree of fields as fingerprint() sees it."""
    if "[]" in tree:
        return f"ARRAY<{_shape(tree['[]'])}>"
    return f"OBJECT<{', '.join(f'{k}: {_shape(v)}' for k, v in sorted(tree.items()))}>" if tree else ""


def fingerprint(record: Column) -> Column:
    """The hash of the nested field paths of a parsed record (a variant)."""
    kind = r"(?<=[<:] ?)(?:BIGINT|STRING|VOID|BOOLEAN|DOUBLE|FLOAT|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|VARIANT|DECIMAL\(\d+,\s?\d+\))(?=[,>]|$)"
    return F.substring(F.sha2(F.regexp_replace(F.schema_of_variant(record), F.lit(kind), F.lit("")), 256), 1, 16)


def fingerprints() -> dict[str, str]:
    return {name: hashlib.sha256(_shape(_tree(paths)).encode()).hexdigest()[:16] for name, (paths, _) in LAYOUTS.items()}


def _type(tree: dict) -> str:
    return f"struct<{', '.join(f'`{k}`: {_type(v)}' for k, v in tree.items())}>" if tree else "string"


def _field(record: Column, path: str) -> Column:
    parts = [F.coalesce(F.try_variant_get(record, "$." + p, "string"), F.lit("")) for p in path.split("+")]
    return reduce(lambda a, b: F.concat(a, F.when((a != "") & (b != ""), "\n").otherwise(""), b), parts)


def _element(role: str, text: str):
    def at(e: Column, path: str) -> Column:
        return F.coalesce(reduce(lambda a, k: a[k], path.split("."), e), F.lit(""))

    return lambda e: F.struct(at(e, role).alias("role"), at(e, text).alias("text"))


def _turns(record: Column, mapping, renamed: bool) -> Column:
    """The canonical turns of a parsed record of one layout: array<struct<role, text>>."""
    out = []
    for role, text in mapping:
        if "[]." in text:
            top, below = text.split("[].")[0], [x.split("[].")[1] for x in (role, text)]
            elements = F.try_variant_get(record, "$." + top, f"array<{_type(_tree(below))}>")
            out.append(F.transform(elements, _element(*below)))
        else:
            out.append(F.array(F.struct((F.lit(role[1:]) if role[0] == "'" else _field(record, role)).alias("role"), _field(record, text).alias("text"))))
    turns = F.concat(*out) if len(out) > 1 else out[0]
    if not renamed:
        return turns
    known = F.create_map(*(F.lit(x) for kv in ROLES.items() for x in kv))
    return F.transform(turns, lambda x: F.struct(F.coalesce(known[F.lower(x["role"])], x["role"]).alias("role"), x["text"].alias("text")))


def canonical_records(records: DataFrame, json: str = "record") -> DataFrame:
    """Adds fingerprint, layout and turns to a column of JSON records (columns of these names are replaced)."""
    found = records.withColumn("__v", F.try_parse_json(json))
    found = found.withColumn("fingerprint", fingerprint(F.col("__v")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for name, mark in fingerprints().items():
        here = F.col("fingerprint") == mark
        layout = F.when(here, name).otherwise(layout)
        turns = F.when(here, _turns(F.col("__v"), LAYOUTS[name][1], name in RENAMED)).otherwise(turns)
    return found.withColumns({"layout": layout, "turns": turns}).drop("__v")


def as_records(rows: DataFrame) -> DataFrame:
    """conv_id and record (JSON) of rows by turn: a user's and an assistant's turn as prompt and completion, other conversations as
    messages or nested turns."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    t = F.col("t")
    pair = (F.size(t) == 2) & (F.get(t, 0)["role"] == "user") & (F.get(t, 1)["role"] == "assistant")
    prompt = F.to_json(F.struct(F.get(t, 0)["text"].alias("prompt"), F.get(t, 1)["text"].alias("completion")))
    messages = F.to_json(F.struct(F.transform(t, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))
    nested = F.transform(t, lambda x: F.struct(F.struct(x["role"].alias("role")).alias("speaker"), x["text"].alias("text")))
    chat = F.to_json(F.struct(F.struct(nested.alias("turns")).alias("chat")))
    return found.select("conv_id", F.when(pair, prompt).when(F.pmod(F.hash("conv_id"), F.lit(2)) == 0, messages).otherwise(chat).alias("record"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_CONTROL), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2$3"))


def render(turns: Column) -> Column:
    """struct<formatted, mask>: the formatted conversation and the loss mask."""
    empty = F.array().cast("array<struct<start:int,length:int>>")
    pieces = F.transform(turns, lambda x: F.struct(F.concat(F.lit(START), escape(x["role"]), F.lit(MIDDLE)).alias("head"), escape(x["text"]).alias("body"), (x["role"] == "assistant").alias("learn")))
    formatted = F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    spans = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), empty.alias("mask")),
        lambda a, p: F.struct(
            (a["at"] + F.char_length(p["head"]) + F.char_length(p["body"]) + len(END)).alias("at"),
            F.when(p["learn"], F.array_append(a["mask"], F.struct((a["at"] + F.char_length(p["head"])).alias("start"), F.char_length(p["body"]).alias("length")))).otherwise(a["mask"]).alias("mask"),
        ),
    )["mask"]
    return F.struct(formatted.alias("formatted"), spans.alias("mask"))


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, formatted and mask from conv_id and turns."""
    return turns.withColumn("__r", render(F.col("turns"))).select("conv_id", F.col("__r.formatted").alias("formatted"), F.col("__r.mask").alias("mask"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation."""
    parts = F.filter(F.split(formatted, "<\\|im_start\\|>"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(unescape(F.substring_index(p, MIDDLE, 1)).alias("role"), unescape(F.regexp_replace(F.substring_index(p, MIDDLE, -1), F.lit("<\\|im_end\\|>$"), F.lit(""))).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """The digests of formatted conversations, from formatted and mask alone."""
    turns = parse(F.col("formatted"))
    learnt = F.array_join(F.transform("mask", lambda m: unescape(F.substring(F.col("formatted"), m["start"] + 1, m["length"]))), "")
    read = formatted.select("conv_id", "formatted", turns.alias("turns"), learnt.alias("learnt"))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


PROBE = "</s>[INST] ok [/INST]"


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return read_back(format_turns(canonical_records(as_records(rows.unionByName(probe)))))


CHAT_SQL = rf"""WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '{PROBE}' FROM range(2) t(i)),
marked AS (SELECT *, length(regexp_replace(role, '{_CONTROL}', '\1\\\2\3', 'g')) + length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g')) + {len(START + MIDDLE + END)} AS size FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(size)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id"""
