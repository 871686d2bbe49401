"""Chat formatting of typed content parts, in DataFrame expressions only, with a reversible escape of control strings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed strings that mark turns and parts in the output, or that chat models read as marks.
TURN, END, BODY = "<|turn|>", "<|end|>", "<|body|>"
CONTROL = [r"<\|", r"\|>", "<s>", "</s>", r"\[INST\]", r"\[/INST\]", "<<SYS>>", "<</SYS>>"]
_FIRST = {"<": r"\l", "[": r"\b", "|": r"\p"}  # what the first character of a control string becomes
PART = "type string, text string, ref string, width int, height int, seconds double, pages int"


def escaped(text: Column) -> Column:
    """Text in which no control string is left: a backslash is doubled, a control string's first character is spelled out."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for first, spelled in _FIRST.items():
        own = [c for c in CONTROL if c.lstrip("\\").startswith(first)]
        rest = "|".join(c[2:] if c.startswith("\\") else c[1:] for c in own)
        out = F.regexp_replace(out, f"{re.escape(first)}(?=(?:{rest}))", spelled.replace("\\", "\\\\"))
    return out


def unescaped(text: Column) -> Column:
    """The text that `escaped` was given. Doubled backslashes are taken out from left to right before the spellings are read."""
    def plain(piece: Column) -> Column:
        for first, spelled in _FIRST.items():
            piece = F.replace(piece, F.lit(spelled), F.lit(first))
        return piece

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def text_part(text: Column) -> Column:
    """The typed parts of a plain text: one."""
    values = {"type": F.lit("text"), "text": F.coalesce(text.cast("string"), F.lit("")), "ref": F.lit(None), "width": F.lit(None),
              "height": F.lit(None), "seconds": F.lit(None), "pages": F.lit(None)}
    return F.array(F.struct(*[v.alias(k) for k, v in values.items()]).cast(f"struct<{PART.replace(' ', ':').replace(',:', ',')}>"))


def expanded_tokens(part: Column, patch: int = 14, per_second: int = 25, per_page: int = 256) -> Column:
    """How many tokens a placeholder stands for: image patches, audio frames, pages of a document; none for text."""
    side = lambda name: F.ceil(F.coalesce(part[name], F.lit(0)) / patch)
    return (
        F.when(part["type"] == "image", side("width") * side("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0)) * per_second))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * per_page)
        .otherwise(0).cast("long")
    )


def visited(parts: Column) -> Column:
    """A turn's parts flattened: struct(content, attachments). Text is escaped in place; the n-th attachment of the turn is `<|type:n|>`.

    attachments: (n, type, ref, tokens). A part of an unknown or null type counts as text; null texts are empty.
    """
    others = ["image", "audio", "document"]
    start = F.struct(F.lit("").alias("content"), F.lit(None).cast("array<struct<n:int,type:string,ref:string,tokens:bigint>>").alias("attachments"))
    start = F.struct(start["content"].alias("content"), F.coalesce(start["attachments"], F.expr("cast(array() as array<struct<n:int,type:string,ref:string,tokens:bigint>>)")).alias("attachments"))

    def visit(seen: Column, part: Column) -> Column:
        other = F.coalesce(part["type"].isin(others), F.lit(False))
        n = F.size(seen["attachments"])
        mark = F.concat(F.lit("<|"), part["type"], F.lit(":"), n.cast("string"), F.lit("|>"))
        own = F.struct(n.alias("n"), part["type"].alias("type"), part["ref"].alias("ref"), expanded_tokens(part).alias("tokens"))
        return F.struct(
            F.concat(seen["content"], F.when(other, mark).otherwise(escaped(F.coalesce(part["text"], F.lit(""))))).alias("content"),
            F.when(other, F.concat(seen["attachments"], F.array(own))).otherwise(seen["attachments"]).alias("attachments"))

    return F.aggregate(parts, start, visit)


def formatted(rows: DataFrame, parts: Column | None = None, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Per conversation: conv_id, formatted, loss (array of begin, length in code points), attachments, attachment_tokens.

    rows: conv_id, turn, role and text, or `parts`, an array of PART structs. A turn is written as
    `<|turn|>role<|body|>content<|end|>` and turns follow by (turn, role, content). The loss mask covers the content of the
    `learned` roles without its marks. Control strings in texts and roles are escaped reversibly. Null texts are empty, a null role
    is an empty role, null turns come first, rows without conv_id are one conversation; repeated rows are turns of their own.
    An empty table gives no rows; other columns are ignored. A conversation is one output row and so must fit one.
    """
    content = visited(parts if parts is not None else text_part(F.col("text")))
    turns = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), content.alias("seen"))
    turns = turns.select("conv_id", F.struct(
        "turn", "role", F.col("seen.content").alias("content"), F.col("seen.attachments").alias("attachments"),
        F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY)).alias("head")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    sized = F.transform("turns", lambda t: F.concat(t["head"], t["content"], F.lit(END)))
    lengths = F.transform("turns", lambda t: F.length(t["head"]) + F.length(t["content"]) + len(END))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("begins"))
    begins = F.aggregate("lengths", start, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["begins"], F.array(s["at"])).alias("begins")))["begins"]
    grouped = grouped.withColumns({"formatted": F.array_join(sized, ""), "lengths": lengths}).withColumn("begins", begins)
    spans = F.transform(F.arrays_zip("turns", "begins"), lambda z: F.struct(
        z["turns"]["role"].alias("role"), (z["begins"] + F.length(z["turns"]["head"])).alias("begin"), F.length(z["turns"]["content"]).alias("length")))
    loss = F.transform(F.filter(spans, lambda s: s["role"].isin(list(learned))), lambda s: F.struct(s["begin"], s["length"]))
    attachments = F.flatten(F.transform("turns", lambda t: F.transform(t["attachments"], lambda a: F.struct(
        t["turn"].alias("turn"), a["n"].alias("n"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return grouped.select("conv_id", "formatted", loss.alias("loss"), attachments.alias("attachments")).withColumn(
        "attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read_back(done: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and loss_text, parsed from the formatted strings and masks alone. Placeholders stay in texts."""
    pieces = F.slice(F.split("formatted", r"<\|turn\|>", -1), 2, 1 << 30)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, BODY, 1)
        body = piece.substr(F.length(role) + F.lit(len(BODY) + 1), F.length(piece) - F.length(role) - F.lit(len(BODY) + len(END)))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    learned = F.transform("loss", lambda s: unescaped(F.col("formatted").substr(s["begin"] + 1, s["length"])))
    return done.select("conv_id", F.transform(pieces, turn).alias("turns"), F.array_join(learned, "").alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation what the formatted output says, read back: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    back = read_back(formatted(rows))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
