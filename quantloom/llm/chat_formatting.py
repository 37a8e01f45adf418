"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation (one string)::

    conversation := turn*
    turn         := open role "\\n" text "</s>"
    open         := "<s>"   content as it is
                  | "<e>"   content escaped: % as %25, < as %3C, [ as %5B and, in a role, newline as %0A

Rendering starts with plain turns. Each turn is parsed again by the deterministic grammar and compared with its source;
a turn that does not come back identical, or whose content holds a control string, is rendered escaped and parsed once
more. The parser reads the whole string: it splits at ``</s>``, which cannot occur inside a turn that passed. All of it
is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, ESCAPED, CLOSE = "<s>", "<e>", "</s>"
#: Strings that must not stand in a formatted text as content.
CONTROL = (OPEN, ESCAPED, CLOSE, "[INST]", "[/INST]")


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<"), F.lit("%3C")), F.lit("["), F.lit("%5B"))


def unescape(text: Column) -> Column:
    for code, char in (("%0A", "\n"), ("%5B", "["), ("%3C", "<"), ("%25", "%")):  # % last: the escaped form has no other %
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def render_turn(role: Column, text: Column, escaped: bool) -> Column:
    if escaped:
        return F.concat(F.lit(ESCAPED), F.replace(escape(role), F.lit("\n"), F.lit("%0A")), F.lit("\n"), escape(text), F.lit(CLOSE))
    return F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """The turns of a formatted string: array of (escaped, raw_role, raw_text, role, text), in order."""
    pieces = F.filter(F.split(formatted, CLOSE), lambda p: p != "")

    def turn(p):
        escaped = F.startswith(p, F.lit(ESCAPED))
        at = F.instr(p, "\n")
        role, text = F.substring(p, F.lit(4), at - 4), F.substring(p, at + 1, F.length(p))
        return F.struct(
            escaped.alias("escaped"),
            role.alias("raw_role"),
            text.alias("raw_text"),
            F.when(escaped, unescape(role)).otherwise(role).alias("role"),
            F.when(escaped, unescape(text)).otherwise(text).alias("text"),
        )

    return F.transform(pieces, turn)


def safe_turn(role: Column, text: Column) -> Column:
    """A turn rendered so that the grammar gives back exactly this role and text.

    The escaped form always does: it has no ``<``, and each ``%`` in it begins one of the four codes.
    """

    def same(rendered):
        back = parse(rendered)
        return (F.size(back) == 1) & (F.get(back, F.lit(0))["role"] == role) & (F.get(back, F.lit(0))["text"] == text)

    clean = F.lit(True)
    for c in CONTROL:
        clean = clean & ~F.contains(role, F.lit(c)) & ~F.contains(text, F.lit(c))
    plain, escaped = render_turn(role, text, False), render_turn(role, text, True)
    return F.when(clean & same(plain), plain).otherwise(escaped)


def format_chats(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans, identical): one string per conversation, the code points under the loss mask, and
    whether the whole string, parsed again, gave back the source's turns.

    A span has its first code point (from 1), its length and whether its turn is escaped.

    Rows are ordered by turn (null first), then role, then text; null role and text count as empty. Rows with a null
    conv_id form one conversation of their own. Repeated rows stay repeated. An empty table gives no rows. Other columns
    aren't read. One conversation is one string by definition, so it must fit a row; turns are rendered before the
    shuffle.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("__role"), text.alias("__text"))
    turns = turns.select("conv_id", F.struct("turn", "__role", "__text", safe_turn(F.col("__role"), F.col("__text")).alias("out")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    spans = F.aggregate(
        "ts",
        F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint,escaped:boolean>>").alias("s")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["out"])).alias("at"),
            F.when(
                t["__role"] == loss_role,
                F.concat(
                    a["s"],
                    F.array(
                        F.struct(
                            (a["at"] + F.instr(t["out"], "\n")).cast("long").alias("start"),
                            (F.length(t["out"]) - F.instr(t["out"], "\n") - len(CLOSE)).cast("long").alias("length"),
                            F.startswith(t["out"], F.lit(ESCAPED)).alias("escaped"),
                        )
                    ),
                ),
            ).otherwise(a["s"]).alias("s"),
        ),
        lambda a: a["s"],
    )
    done = whole.select("conv_id", F.array_join(F.transform("ts", lambda t: t["out"]), "").alias("formatted"), spans.alias("loss_spans"), "ts")
    back = F.transform(parse(F.col("formatted")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    source = F.transform("ts", lambda t: F.struct(t["__role"].alias("role"), t["__text"].alias("text")))
    return done.select("conv_id", "formatted", "loss_spans", (back == source).alias("identical"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """The rows of ``formatted`` with turns and loss_texts, recovered by the grammar and the spans alone.

    Empty roles and texts come back empty (null ones were written as empty), repeated turns repeated; an empty table gives
    no rows.
    """
    parsed = parse(F.col("formatted"))
    span = lambda s: F.substring(F.col("formatted"), s["start"].cast("int"), s["length"].cast("int"))
    return formatted.select(
        "*",
        parsed.alias("turns"),
        F.transform("loss_spans", lambda s: F.when(s["escaped"], unescape(span(s))).otherwise(span(s))).alias("loss_texts"),
    )
