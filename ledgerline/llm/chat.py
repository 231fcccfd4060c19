"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation::

    conversation = { turn }
    turn         = "### " role ": " text "</turn>" LF

Header and terminator strings never occur inside a role or text: they are written as
``\\h`` and ``\\t`` there, and reading turns ``\\h``, ``\\t``, ``\\c`` (a colon in a role) and
``\\\\`` back.  Content is escaped only as far as needed: a text is rendered as it is,
reparsed, and compared with its source; if it differs, control strings are escaped
and the result is reparsed again; if that still differs (the source itself holds a
backslash sequence), backslashes are doubled as well, which always reads back.
Formatting, parsing and comparing are Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, SEPARATOR, END = "### ", ": ", "</turn>"
#: Turns whose text is joined at once; longer conversations are joined block by block.
BLOCK_TURNS = 256


def _control(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(HEAD), F.lit("\\h")), F.lit(END), F.lit("\\t"))


def unescape(text: Column) -> Column:
    """What an escaped role or text stands for.  Pairs of backslashes are taken first, from the left."""
    def plain(part: Column) -> Column:
        for code, stands in (("\\h", HEAD), ("\\t", END), ("\\c", ":")):
            part = F.replace(part, F.lit(code), F.lit(stands))
        return part
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def escape_role(role: Column) -> Column:
    """Roles are always escaped in full, colons too."""
    return F.replace(_control(F.replace(role, F.lit("\\"), F.lit("\\\\"))), F.lit(":"), F.lit("\\c"))


def render(role: Column, text: Column) -> Column:
    """A turn, with the least escaped of three renderings of its text that holds no control string
    and that the grammar reads back: the rendered turn is parsed, and must be one turn of the
    same role and text.  An error is raised if none is, which no text can cause."""
    def turn(escaped: Column) -> Column:
        return F.concat(F.lit(HEAD), escape_role(role), F.lit(SEPARATOR), escaped, F.lit(END + "\n"))

    def reads_back(rendered: Column) -> Column:
        turns = parse(rendered)
        return (F.size(turns) == 1) & (F.get(turns, 0)["role"] == role) & (F.get(turns, 0)["text"] == text)

    plain = ~F.contains(text, F.lit(HEAD)) & ~F.contains(text, F.lit(END))
    raw, marked = turn(text), turn(_control(text))
    full = turn(_control(F.replace(text, F.lit("\\"), F.lit("\\\\"))))
    return (F.when(plain & reads_back(raw), raw).when(reads_back(marked), marked).when(reads_back(full), full)
            .otherwise(F.raise_error(F.lit("a turn does not read back"))))


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """(conv_id, formatted), one row per conversation.

    Turns are in order of turn number, nulls first; turns that share a number in order of role
    and text.  Null texts and roles are empty; rows of a null conversation id form one
    conversation; an empty table gives an empty result; repeated rows are turns of their own.
    Turns are joined in blocks of ``BLOCK_TURNS`` turn numbers before they meet by conversation.
    Other columns are ignored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    rendered = render(F.col("role"), F.col("text"))
    block = F.floor(F.col("turn") / BLOCK_TURNS)
    parts = rows.select("conv_id", block.alias("block"), "turn", "role", "text", rendered.alias("r")).groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "r"))).alias("turns"))
    joined = parts.select("conv_id", F.struct("block", F.array_join(F.col("turns")["r"], "").alias("r")).alias("part"))
    whole = joined.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return whole.select("conv_id", F.array_join(F.col("parts")["r"], "").alias("formatted"))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.filter(F.split(formatted, END + "\n", -1), lambda p: p.startswith(HEAD))

    def turn(piece: Column) -> Column:
        at = F.instr(piece, SEPARATOR)
        return F.struct(unescape(F.substring(piece, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"),
                        unescape(F.substring(piece, at + len(SEPARATOR), F.length(piece))).alias("text"))
    return F.transform(pieces, turn)


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """The loss mask: (start, end) code-point spans of the formatted text that hold the
    texts of ``role``, in order."""
    def step(acc: Column, piece: Column) -> Column:
        at = F.instr(piece, SEPARATOR)
        own = F.substring(piece, F.lit(len(HEAD) + 1), at - len(HEAD) - 1) == F.lit(role)
        span = F.struct((acc["at"] + at + len(SEPARATOR) - 1).alias("start"), (acc["at"] + F.length(piece)).alias("end"))
        return F.struct((acc["at"] + F.length(piece) + len(END) + 1).alias("at"),
                        F.when(own, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))
    pieces = F.filter(F.split(formatted, END + "\n", -1), lambda p: p.startswith(HEAD))
    return F.aggregate(pieces, start, step, lambda acc: acc["spans"])


def read_back(formatted: DataFrame, role: str = "assistant") -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the formatted
    texts alone: turns as the parser finds them, the loss text cut out by the loss mask."""
    parsed = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"),
                              loss_spans(F.col("formatted"), role).alias("mask"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.transform("mask", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])))
    digests = parsed.select("conv_id", "turns", told.alias("told"), F.array_join(masked, "").alias("masked"), "formatted")
    return digests.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2("told", 256).alias("turns_sha256"),
                          F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
                          F.length("formatted").cast("long").alias("formatted_chars"))
