"""Chat formatting with typed content parts.

A visitor goes through the parts of every turn in order: text parts give their escaped text, image, audio
and document parts give a placeholder ``<kind k>`` with a running number k, for which the attachment's
reference and its expanded token count are recorded. A turn is written as

    ###role:body</turn>\\n

In roles and texts ``\\`` becomes ``\\\\``, ``#`` becomes ``\\h``, ``<`` becomes ``\\l`` and in roles ``:``
becomes ``\\c``, so no text can hold a control string or placeholder, and reading back is exact. The loss
mask lists, in code points, where the bodies of assistant turns stand.

Rows of a conversation are put in order of turn, then role and parts; a null turn comes first, repeated
rows are repeated turns, a null role or text counts as empty, null parts as none. A null conversation id is a
conversation of its own. An empty table gives an empty table; other columns are not read. A conversation
is one row of the result, so it must fit a row; there is no other limit. Placeholders and places are running sums over a
conversation's turns, so work is linear in turns; the parts of one turn are folded one by one onto its body. Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "###", "</turn>\n"
#: Tokens that a placeholder stands for, per unit: an image tile, a second of audio, a page.
TOKENS_PER_UNIT = {"image": 256.0, "audio": 25.0, "document": 700.0}

#: Pieces in which formatted text is read back.
PIECE_CHARS = 4096

PART = "struct<kind: string, text: string, ref: string, units: double>"


def text_part(text: Column) -> Column:
    """A list of one text part."""
    none = F.lit(None)
    part = F.struct(
        F.lit("text").alias("kind"),
        text.cast("string").alias("text"),
        none.cast("string").alias("ref"),
        none.cast("double").alias("units"),
    )
    return F.array(part).cast(f"array<{PART}>")


def _replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


ESCAPES = [("#", "\\h"), ("<", "\\l")]


def escape(text: Column, role: bool = False) -> Column:
    pairs = [("\\", "\\\\"), *ESCAPES, *[(":", "\\c")] * role]
    return _replace(F.coalesce(text, F.lit("")), pairs)


def unescape(text: Column) -> Column:
    """Escapes are pairs of a backslash and a sign; cutting at the doubled ones leaves only the others."""
    back = [(new, old) for old, new in [*ESCAPES, (":", "\\c")]]
    return F.array_join(F.transform(F.split(text, r"\\\\"), lambda p: _replace(p, back)), "\\")


def _visited(parts: Column, before: Column) -> Column:
    """``(body, items)`` of a turn's parts: the flattened body, and what it says of each part; ``before`` is
    the number of placeholders of earlier turns."""
    tokens = F.create_map(*[F.lit(x) for pair in TOKENS_PER_UNIT.items() for x in pair])
    start = F.struct(
        F.lit("").alias("body"),
        before.alias("n"),
        F.array().cast("array<struct<n: int, kind: string, ref: string, tokens: bigint>>").alias("items"),
    )

    def visit(state: Column, part: Column) -> Column:
        is_text = F.coalesce(part["kind"], F.lit("text")) == "text"
        number = state["n"] + F.lit(1)
        item = F.struct(
            number.alias("n"),
            part["kind"].alias("kind"),
            part["ref"].alias("ref"),
            F.ceil(F.coalesce(part["units"], F.lit(1.0)) * F.coalesce(tokens[part["kind"]], F.lit(1.0))).alias("tokens"),
        )
        mark = F.concat(F.lit("<"), escape(part["kind"]), F.lit(" "), number.cast("string"), F.lit(">"))
        return F.struct(
            F.concat(state["body"], F.when(is_text, escape(part["text"])).otherwise(mark)).alias("body"),
            F.when(is_text, state["n"]).otherwise(number).alias("n"),
            F.when(is_text, state["items"]).otherwise(F.concat(state["items"], F.array(item))).alias("items"),
        )

    return F.aggregate(F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull()), start, visit)


def format_chat(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, parts)``.

    ``(conv_id, formatted, loss_mask array<struct<start, length>>, attachments, n_expanded bigint)``; starts
    count code points of ``formatted`` from 0; ``n_expanded`` is the words of the bodies, a placeholder counted as
    the tokens it stands for.
    """
    none = F.array().cast(f"array<{PART}>")
    own = turns.select(
        turns["conv_id"].alias("conv_id"),
        turns["turn"].alias("turn"),
        F.coalesce(turns["role"], F.lit("")).alias("role"),
        F.coalesce(turns["parts"].cast(f"array<{PART}>"), none).alias("parts"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    attached = F.size(F.filter("parts", lambda p: p.isNotNull() & (F.coalesce(p["kind"], F.lit("text")) != "text")))
    counted = own.withColumns(
        {"place": F.row_number().over(order), "before": F.coalesce(F.sum(attached).over(earlier), F.lit(0)).cast("int")}
    )
    visited = counted.select(
        "conv_id",
        "place",
        "role",
        F.concat(F.lit(OPEN), escape(F.col("role"), role=True), F.lit(":")).alias("head"),
        _visited(F.col("parts"), F.col("before")).alias("seen"),
    )
    body, head = F.col("seen.body"), F.col("head")
    by_place = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum(F.length(head) + F.length(body) + len(CLOSE)).over(by_place), F.lit(0))
    placed = visited.select(
        "conv_id",
        "place",
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        F.when(
            F.col("role") == "assistant",
            F.struct((ahead + F.length(head)).cast("int").alias("start"), F.length(body).alias("length")),
        ).alias("span"),
        F.col("seen.items").alias("items"),
        F.size(F.array_remove(F.split(body, r"<[^>]*>|\s+"), "")).alias("words"),
    )
    expanded = F.sum(F.col("words") + F.aggregate("items", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]))
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "piece", "span", "items"))).alias("turns"), expanded.alias("n_expanded")
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.array_compact(F.transform("turns", lambda t: t["span"])).alias("loss_mask"),
        F.flatten(F.transform("turns", lambda t: t["items"])).alias("attachments"),
        "n_expanded",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>, unescaped; placeholders stay."""
    blocks = F.slice(F.split(formatted, OPEN), F.lit(2), F.greatest(F.size(F.split(formatted, OPEN)) - 1, F.lit(0)))

    def one(block: Column) -> Column:
        head = F.substring_index(block, ":", 1)
        body = F.substring(block, F.length(head) + F.lit(2), F.length(block) - F.length(head) - F.lit(1 + len(CLOSE)))
        return F.struct(unescape(head).alias("role"), unescape(body).alias("text"))

    return F.transform(blocks, one)


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between.

    The text is cut once into pieces of equal length, so that a span is found without counting from the start.
    """
    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))

    def under(state: Column) -> Column:
        def one(m: Column) -> Column:
            first = F.floor(m["start"] / PIECE_CHARS).cast("int")
            last = F.floor((m["start"] + m["length"]) / PIECE_CHARS).cast("int")
            near = F.array_join(F.slice(state, first + 1, last - first + 1), "")
            return unescape(F.substring(near, m["start"] - first * PIECE_CHARS + 1, m["length"]))

        return F.array_join(F.transform(loss_mask, one), "")

    # A fold over the one list of pieces binds it, so it is made once and not again for every span.
    return F.aggregate(F.array(pieces), F.lit(""), lambda _, state: under(state))
