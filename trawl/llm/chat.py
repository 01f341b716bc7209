"""Chat formatting with Spark expressions only: turn structs are collected and
sorted, adjacent turns of one role become one block, blocks are concatenated.

Template: a block is `<turn ROLE>` TEXT (`<turn+>` TEXT)* `</turn>` newline, with
one TEXT per turn, so the turns can be read back out of a merged block. In texts
`\\` becomes `\\\\` and the control strings `<turn` and `</turn` get a `\\` after
their `<`; roles are URL-encoded. No text can then hold a mark.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"
NEXT = "<turn+>"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    opened = F.replace(doubled, F.lit("<turn"), F.lit("<\\turn"))
    return F.replace(opened, F.lit("</turn"), F.lit("<\\/turn"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chat(rows: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, segments array<struct<text, loss>>.

    The formatted text is the segments' texts in order (`render`); loss marks
    the segments a model is trained on: the texts of `loss_roles`, without marks.

    Nulls: a null text or role is empty, a null turn comes first, rows with a
    null conv_id form one conversation. Equal turn numbers are put in the order
    of role and text; repeated rows stay repeated turns. No rows give no rows;
    other columns are ignored. A conversation becomes one row, so one task holds
    one conversation at a time (never more than one)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")
    at = lambda i: F.element_at("turns", i.cast("int"))
    first = F.filter(F.sequence(F.lit(1), n),
                     lambda i: (i == 1) | (at(i)["role"] != at(F.greatest(i - 1, F.lit(1)))["role"]))
    t = t.withColumn("first", first)
    until = lambda j: F.coalesce(F.get("first", j + 1), n + 1)
    t = t.select("conv_id", F.transform("first", lambda i, j: F.struct(
        at(i)["role"].alias("role"), F.slice("turns", i, until(j) - i)["text"].alias("texts"))).alias("blocks"))

    def seg(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)

    def block(b: Column) -> Column:
        loss = b["role"].isin(*loss_roles)
        texts = F.flatten(F.transform(b["texts"], lambda x, k: F.when(
            k == 0, F.array(seg(escape(x), loss))).otherwise(F.array(seg(F.lit(NEXT), no), seg(escape(x), loss)))))
        head = F.array(seg(F.concat(F.lit("<turn "), F.url_encode(b["role"]), F.lit(">")), no))
        return F.concat(head, texts, F.array(seg(F.lit(END), no)))

    return t.select("conv_id", F.flatten(F.transform("blocks", block)).alias("segments"))


def render(segments: Column) -> Column:
    return F.array_join(segments["text"], "")


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: array<struct<role, text>>."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")
    texts = lambda b: F.split(F.substr(b, F.locate(">", b) + 1), r"<turn\+>", -1)
    role = lambda b: F.url_decode(F.substr(b, F.lit(7), F.locate(">", b) - 7))
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        texts(b), lambda x: F.struct(role(b).alias("role"), unescape(x).alias("text")))))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What is read back from `format_chat`'s output, one row per conversation."""
    t = formatted.withColumn("formatted", render(F.col("segments")))
    t = t.withColumn("back", parse(F.col("formatted")))
    under = F.filter("segments", lambda s: s["loss"])
    t = t.withColumn("loss_text", F.array_join(F.transform(under, lambda s: unescape(s["text"])), ""))
    lines = F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return t.select("conv_id", F.size("back").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                    F.length("loss_text").cast("long").alias("loss_chars"),
                    F.sha2("loss_text", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))
