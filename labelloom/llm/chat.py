"""Chat formatting of conversations whose turns hold typed content parts, in DataFrame functions only.

A turn is a list of parts: text, image, audio or document. A visitor flattens them in order: text is
escaped, any other part becomes a numbered placeholder, and its reference, position and expanded token
count go into the list of attachments. Assistant turns are marked as what a model learns, other turns as
instructions:

    [INST]user\\nHello<|image:1|>[/INST]<s>assistant\\nHi</s>

Control strings inside texts are escaped reversibly: a backslash is doubled, and the first character of a
control string becomes ``\\l`` or ``\\b``. So no text can end its turn, forge another, or name an
attachment, and ``read_back`` recovers every role and text as it was.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,units:bigint>"
KINDS = ("image", "audio", "document")
# Tokens that a unit of each kind takes in the model's input: image tiles, seconds of sound, pages.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 600}
LEARNED = "assistant"
# What stands for itself in the output. A text that holds one of these is escaped there.
CONTROL = r"(?:/?s>|/?INST\]|\|(?:part\||(?:image|audio|document):))"
PART_MARK = "<|part|>"
_ROLE_END = "\n"


def _escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(doubled, f"<(?={CONTROL})", r"\\l"), f"\\[(?={CONTROL})", r"\\b")


def _escaped_role(role: Column) -> Column:
    """Roles end at a line break, so theirs are escaped too."""
    return F.replace(_escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped(text: Column) -> Column:
    """Between doubled backslashes, every single one begins an escape."""
    plain = F.transform(
        F.split(text, r"\\\\", -1),
        lambda s: F.replace(F.replace(F.replace(s, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")), F.lit("\\n"), F.lit("\n")),
    )
    return F.array_join(plain, "\\")


def text_parts(text: Column) -> Column:
    """The parts of a turn that is one text."""
    nothing = F.lit(None).cast("string")
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.alias("text"), nothing.alias("ref"), F.lit(None).cast("bigint").alias("units")
    ))


def _is_attachment(kind: Column) -> Column:
    return F.coalesce(kind.isin(*KINDS), F.lit(False))


def _expanded_tokens(part: Column) -> Column:
    tokens = F.lit(0).cast("bigint")
    for kind, each in TOKENS_PER_UNIT.items():
        tokens = F.when(part["kind"] == kind, F.coalesce(part["units"], F.lit(1)) * each).otherwise(tokens)
    return tokens


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (``conv_id``, ``turn``, ``role``, ``parts``):
    ``conv_id``, ``formatted``, ``loss_spans`` and ``attachments``.

    Turns come in the order of ``turn``, nulls first; equal turn numbers go by role, then content, so
    repeated rows are repeated turns. Null roles, texts and part lists count as empty; a part of an
    unknown kind is text. Rows without a conversation id form one conversation without an id.
    ``loss_spans`` are the places in ``formatted`` (start, end in code points) of what assistant turns
    say. A conversation is one output value, so its turns meet in one task.
    """
    parts = F.transform(
        F.coalesce(turns["parts"], F.array().cast(f"array<{PART}>")),
        lambda p: F.struct(*[p[c].alias(c) for c in ("kind", "text", "ref", "units")]),
    )
    rows = turns.select(
        turns["conv_id"].alias("conv_id"), turns["turn"].alias("turn"),
        F.coalesce(turns["role"], F.lit("")).alias("role"), parts.alias("parts"),
    ).withColumn("attached", F.filter("parts", lambda p: _is_attachment(p["kind"])))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumns({
        "seq": F.row_number().over(order),
        "before": F.coalesce(F.sum(F.size("attached")).over(earlier), F.lit(0)),
    })
    learned = F.col("role") == LEARNED
    marked = numbered.select(
        "conv_id", "turn", "role", "parts", "seq", learned.alias("learned"),
        F.concat(F.when(learned, "<s>").otherwise("[INST]"), _escaped_role(F.col("role")), F.lit(_ROLE_END)).alias("open"),
        _flattened(F.col("parts"), F.col("before")).alias("body"),
        F.when(learned, "</s>").otherwise("[/INST]").alias("close"),
        F.transform("attached", lambda p, i: F.struct(
            (F.col("before") + i + 1).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"),
            _expanded_tokens(p).alias("tokens"),
        )).alias("attachments"),
    )
    length = F.length("open") + F.length("body") + F.length("close")
    start = F.coalesce(F.sum(length).over(earlier), F.lit(0)) + F.length("open")
    laid = marked.withColumn("start", start).select("conv_id", F.struct(
        "seq", F.concat("open", "body", "close").alias("said"), "learned", "start",
        (F.col("start") + F.length("body")).alias("end"), "attachments",
    ).alias("t"))
    whole = laid.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["said"]), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))
        ).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    )


def _flattened(parts: Column, before: Column) -> Column:
    """The parts in order; attachments are numbered on from those of earlier turns."""
    bodies = F.transform(parts, lambda p, i: F.when(
        _is_attachment(p["kind"]),
        F.concat(
            F.lit("<|"), p["kind"], F.lit(":"),
            (before + F.size(F.filter(F.slice(parts, F.lit(1), i + 1), lambda q: _is_attachment(q["kind"])))).cast("string"),
            F.lit("|>"),
        ),
    ).otherwise(_escaped(F.coalesce(p["text"], F.lit("")))))
    return F.array_join(bodies, PART_MARK)


def read_back(formatted: Column) -> Column:
    """Role and text of every turn, from the output alone: texts of several parts are joined, placeholders
    stand as written."""
    turns = F.regexp_extract_all(formatted, F.lit(r"(?s)(?:\[INST\]|<s>).*?(?:\[/INST\]|</s>)"), F.lit(0))
    inner = F.transform(turns, lambda t: F.regexp_replace(t, r"\A(?:\[INST\]|<s>)|(?:\[/INST\]|</s>)\z", ""))
    return F.transform(inner, lambda t: F.struct(
        _unescaped(F.substring_index(t, _ROLE_END, 1)).alias("role"),
        _text_of(F.substring(t, F.instr(t, _ROLE_END) + 1, F.length(t))).alias("text"),
    ))


def _text_of(body: Column) -> Column:
    return _unescaped(F.replace(body, F.lit(PART_MARK), F.lit("")))


def learned_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    said = F.transform(loss_spans, lambda s: _text_of(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return F.array_join(said, "")
