"""Conversations as text with a loss mask, with DataFrame functions only.

A turn's content is a list of typed parts. A visitor over the parts turns each into text: text is
escaped, anything else becomes an ordered placeholder whose attachment and token count are recorded.
Control strings mark turns; the escaping keeps them from ever occurring inside a text and can be
undone, so the formatted text can be read back.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
# What opens a control string of this template or of a usual one, up to its second character. Every
# run of backslashes in that place grows by one, so a text never holds such a string itself.
_OPEN, _REST = r"(<|\[)", r"(?=\||/?s>|/?INST\]|/?SYS>)"
READ_BLOCK = 256
PARTS = "array<struct<type:string,text:string,ref:string,tokens:bigint>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_OPEN}(\\*){_REST}", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_OPEN}\\(\\*){_REST}", r"$1$2")


def text_parts(text: Column) -> Column:
    """A plain text as content; null is an empty text."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("bigint").alias("tokens"),
    )
    return F.array(part).cast(PARTS)


def flatten_parts(parts: Column, first: Column | None = None, tokens: dict[str, int] | None = None) -> Column:
    """``struct(text, attachments, expanded_tokens)`` for a list of typed parts.

    Parts are ``struct(type, text, ref, tokens)``. Text parts are escaped and joined as they are.
    Every other part becomes ``<|type:n|>`` with n counted from ``first`` (0), in order over all
    types, and an attachment ``struct(n, type, ref, tokens)``. Its token count is the part's own, else
    what ``tokens`` gives for its type, else 1; ``expanded_tokens`` is their sum. A null list is
    empty; a null part or type is an empty text; a null ref stays null.
    """
    defaults = {"image": 256, "audio": 128, "document": 512} | (tokens or {})
    known = F.create_map(*[F.lit(x) for pair in defaults.items() for x in pair])
    # Text parts are escaped together up to the next placeholder, else a control string could be put
    # together from two of them.
    empty = F.struct(
        F.lit("").alias("text"),
        F.lit("").alias("open"),
        F.array().cast("array<struct<n:bigint,type:string,ref:string,tokens:bigint>>").alias("attachments"),
        F.lit(0).cast("bigint").alias("expanded_tokens"),
    )
    start = (F.lit(0) if first is None else first).cast("bigint")

    def visit(a: Column, part: Column) -> Column:
        kind = F.coalesce(part["type"], F.lit("text"))
        is_text = kind == "text"
        n = start + F.size(a["attachments"])
        count = F.coalesce(part["tokens"], F.try_element_at(known, kind).cast("bigint"), F.lit(1).cast("bigint"))
        mark = F.concat(F.lit("<|"), F.regexp_replace(kind, r"[^A-Za-z0-9_]", "_"), F.lit(":"), n.cast("string"), F.lit("|>"))
        found = F.struct(n.alias("n"), kind.alias("type"), part["ref"].alias("ref"), count.alias("tokens"))
        return F.struct(
            F.when(is_text, a["text"]).otherwise(F.concat(a["text"], escape(a["open"]), mark)).alias("text"),
            F.when(is_text, F.concat(a["open"], F.coalesce(part["text"], F.lit("")))).otherwise("").alias("open"),
            F.when(is_text, a["attachments"]).otherwise(F.concat(a["attachments"], F.array(found))).alias("attachments"),
            (a["expanded_tokens"] + F.when(is_text, F.lit(0)).otherwise(count)).alias("expanded_tokens"),
        )

    def finish(a: Column) -> Column:
        return F.struct(
            F.concat(a["text"], escape(a["open"])).alias("text"), a["attachments"], a["expanded_tokens"]
        )

    return F.aggregate(F.coalesce(parts, F.array().cast(PARTS)), empty, visit, finish)


def format_conversations(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    learn_role: str = "assistant",
    tokens: dict[str, int] | None = None,
) -> DataFrame:
    """One row per conversation: ``id_col``, ``formatted``, ``loss_spans``, ``attachments``,
    ``expanded_tokens``.

    Turns are ordered by ``turn_col``, then role and text; a null turn comes first, repeated turns
    stay. Null roles are empty. Rows with a null id are one conversation. ``loss_spans`` are the
    ``(start, length)`` of the learnt role's texts in ``formatted``, in code points from 0.
    Attachments are numbered within their turn and carry it. Other columns are left out. A
    conversation is one text in the end, so its turns meet in one task.
    """
    flat = rows.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        flatten_parts(F.col(parts_col), tokens=tokens).alias("f"),
    )
    # Starts come from one running sum over the turns in order, not from growing arrays.
    parts = flat.select("id", "turn", "role", "f.text", "f.attachments", F.col("f.expanded_tokens").alias("n"))
    order = ["turn", "role", "text", "attachments", "n"]
    head = F.length(escape(F.col("role"))) + len(TURN) + len(BODY)
    so_far = Window.partitionBy("id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = F.sum(head + F.length("text") + len(END)).over(so_far)
    placed = parts.withColumn("start", (done - len(END) - F.length("text")).cast("int"))
    turn = F.struct(*order, "start")
    turns = placed.groupBy("id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def shown(t: Column) -> Column:
        return F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY), t["text"], F.lit(END))

    def span(t: Column) -> Column:
        return F.struct(t["start"].alias("start"), F.length(t["text"]).alias("length"))

    learnt = F.filter("turns", lambda t: t["role"] == learn_role)
    held = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["attachments"],
                lambda x: F.struct(t["turn"].alias("turn"), x["n"].alias("n"), x["type"].alias("type"), x["ref"].alias("ref"), x["tokens"].alias("tokens")),
            ),
        )
    )
    return turns.select(
        F.col("id").alias(id_col),
        F.array_join(F.transform("turns", shown), "").alias("formatted"),
        F.transform(learnt, span).alias("loss_spans"),
        held.alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda a, t: a + t["n"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as ``array<struct(role, text)>``, unescaped."""
    pieces = F.split(formatted, r"<\|turn\|>")
    return F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.struct(
            unescape(F.substring_index(p, BODY, 1)).alias("role"),
            unescape(F.regexp_replace(F.regexp_replace(p, r"^(?s).*?<\|body\|>", ""), r"<\|end\|>$", "")).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, one span after the other."""
    # A substring counts from the text's start, so the text is cut into blocks once. The outer list of
    # one binds the blocks, which would else be cut for each span.
    blocks = F.regexp_extract_all(formatted, F.lit(rf"(?s).{{1,{READ_BLOCK}}}"), F.lit(0))

    def texts(b: Column) -> Column:
        def cut(s: Column) -> Column:
            first = F.floor(s["start"] / READ_BLOCK).cast("int")
            skip = s["start"] - first * READ_BLOCK
            count = F.floor((skip + s["length"]) / READ_BLOCK).cast("int") + 1
            return unescape(F.substring(F.array_join(F.slice(b, first + 1, count), ""), skip + 1, s["length"]))

        return F.array_join(F.transform(spans, cut), "")

    return F.transform(F.array(blocks), texts)[0]
