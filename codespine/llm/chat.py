"""Chat formatting of typed content parts, in DataFrame functions only.

A message is a role and an array of parts; a part has a ``kind``: text, or image, audio or document with a reference and a
size. A visitor flattens the parts in order: text is escaped, every other part becomes a placeholder, its reference is
recorded with the placeholder's ordinal, and its expanded token count is added: an image takes a token for each ``PATCH`` x
``PATCH`` pixels begun, audio ``AUDIO_TOKENS`` a second begun, a document ``PAGE_TOKENS`` a page; unknown kinds count none.

A turn is rendered as ``<|im_start|>role``, line feed, content, ``<|im_end|>``, line feed. In contents each ``<``,
backslashes, ``|`` gets one backslash more, so that no control string can come from a text; reading back takes it away again. Neighbouring
text parts are escaped as the one text that they become, so that none can come from their joints either. Roles
are written with ``%``, ``<`` and line feeds as percent codes.

The loss mask is an array of spans, one for each turn, in code points of the formatted text; it covers the contents of
assistant turns and is empty elsewhere.

Defined results: a null text, role or part is empty; turns go by turn number (null first), then role and content, so
repeated rows stay and ties have one order; a conversation is one row, so its whole text has to fit a row. An empty
table gives no rows. Other columns of the input are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, STOP = "<|im_start|>", "<|im_end|>"
PATCH, AUDIO_TOKENS, PAGE_TOKENS = 28, 25, 512
KINDS = ("image", "audio", "document")
PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def role_written(role: Column) -> Column:
    for plain, code in (("%", "%25"), ("<", "%3C"), ("\n", "%0A")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def role_read(role: Column) -> Column:
    for plain, code in (("\n", "%0A"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def text_part(text: Column) -> Column:
    """The parts of a message of one text."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"))).cast("array<struct<kind: string, text: string>>")


def _field(part: Column, fields: set[str], name: str, kind: str) -> Column:
    return part[name].cast(kind) if name in fields else F.lit(None).cast(kind)


def visited(part: Column, fields: set[str]) -> Column:
    """What a part contributes: a plain text, or a placeholder and an attachment with its tokens."""
    get = lambda name, kind: _field(part, fields, name, kind)
    kind = F.coalesce(get("kind", "string"), F.lit("text"))
    is_text = kind == "text"
    side = lambda name: F.ceil(F.coalesce(get(name, "int"), F.lit(0)) / PATCH)
    tokens = (
        F.when(kind == "image", side("width") * side("height"))
        .when(kind == "audio", F.ceil(F.coalesce(get("seconds", "double"), F.lit(0.0))) * AUDIO_TOKENS)
        .when(kind == "document", F.coalesce(get("pages", "int"), F.lit(0)) * PAGE_TOKENS)
        .otherwise(0)
    )
    placeholder = F.concat(F.lit("<|"), F.when(kind.isin(*KINDS), kind).otherwise("part"), F.lit("|>"))
    return F.struct(
        F.when(is_text, F.coalesce(get("text", "string"), F.lit(""))).alias("plain"), F.when(~is_text, placeholder).alias("placeholder"),
        F.when(~is_text, F.struct(kind.alias("kind"), F.coalesce(get("ref", "string"), F.lit("")).alias("ref"), tokens.cast("long").alias("tokens"))).alias("attachment"),
    )


def content(seen: Column) -> Column:
    """Placeholders as they are, each run of texts between them escaped as one."""
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("open"))
    return F.aggregate(
        seen, start,
        lambda x, s: F.when(s["placeholder"].isNull(), F.struct(x["done"].alias("done"), F.concat(x["open"], s["plain"]).alias("open"))).otherwise(F.struct(F.concat(x["done"], escaped(x["open"]), s["placeholder"]).alias("done"), F.lit("").alias("open"))),
        lambda x: F.concat(x["done"], escaped(x["open"])),
    )


def formatted(messages: DataFrame, *, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each conversation of ``conv_id``, ``turn``, ``role``, ``parts``.

    ``conv_id``, ``n_turns`` long, ``formatted`` string, ``loss_spans`` (by turn: where its segment begins, where its loss begins and
    ends), ``attachments`` (ordinal, kind, ref, tokens), ``expanded_tokens`` long.
    """
    fields = set(messages.schema["parts"].dataType.elementType.fieldNames())
    seen = F.transform(F.coalesce("parts", F.array().cast(messages.schema["parts"].dataType)), lambda p: visited(p, fields))
    turns = messages.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), seen.alias("seen"))
    turns = turns.select(
        "conv_id", "turn", "role", content(F.col("seen")).alias("content"),
        F.filter(F.transform("seen", lambda s: s["attachment"]), lambda a: a.isNotNull()).alias("attachments"),
    )
    head = F.concat(F.lit(START), role_written(F.col("role")), F.lit("\n"))
    turns = turns.withColumns({"segment": F.concat(head, "content", F.lit(STOP + "\n")), "head": F.length(head), "size": F.length("content")})
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "content")
    before = F.coalesce(F.sum(F.length("segment").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = turns.select("conv_id", F.row_number().over(order).alias("k"), before.alias("at"), "segment", "head", "size", "role", "attachments")
    first = F.col("at") + F.col("head")
    span = F.struct(F.col("at").alias("turn_start"), first.alias("start"), (first + F.when(F.col("role").isin(*trained), F.col("size")).otherwise(0)).alias("end"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("k", "segment", span.alias("span"), "attachments"))).alias("t"))
    listed = F.flatten(F.transform("t", lambda t: t["attachments"]))
    return whole.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda t: t["segment"]), "").alias("formatted"),
        F.transform("t", lambda t: t["span"]).alias("loss_spans"),
        F.transform(listed, lambda a, i: F.struct((i + 1).alias("ordinal"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate(listed, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_back(rows: DataFrame) -> DataFrame:
    """Adds ``turns`` (role and text of each turn) and ``loss_text``, both read from ``formatted`` and ``loss_spans``.

    The formatted text is cut at its control strings once, and each span is taken from its own segment, so the work is
    linear in the text.
    """
    parts = F.split("formatted", r"<\|im_start\|>")
    segments = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    turn = lambda s: F.struct(
        role_read(F.substring_index(s, "\n", 1)).alias("role"),
        unescaped(F.regexp_replace(s, r"(?s)\A[^\n]*\n|<\|im_end\|>\n\z", "")).alias("text"),
    )
    with_segments = rows.withColumn("_segments", segments)
    each = F.arrays_zip("_segments", "loss_spans")
    masked = F.transform(each, lambda z: unescaped(F.substr(F.concat(F.lit(START), z["_segments"]), (z["loss_spans"]["start"] - z["loss_spans"]["turn_start"] + 1).cast("int"), (z["loss_spans"]["end"] - z["loss_spans"]["start"]).cast("int"))))
    return with_segments.withColumns({"turns": F.transform("_segments", turn), "loss_text": F.array_join(masked, "")}).drop("_segments")


def oracle() -> str:
    """The contract's columns as DuckDB SQL over ``conversations`` with the added conversation -1."""
    return r"""
    WITH rows AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
      UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
    turns AS (
      SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS size,
        length(replace(replace(replace(role, '%', '%25'), '<', '%3C'), chr(10), '%0A')) AS head FROM rows),
    whole AS (
      SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS listed,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
        sum(12 + head + 1 + size + 11)::BIGINT AS formatted_chars
      FROM turns GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(listed) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole"""
