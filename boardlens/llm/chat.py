"""Chat formatting from a declarative template, with a state machine over roles and loss flags per segment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Markers around each turn, which roles are learnt, and which role may follow which ("" is the start).

    ``control`` lists every string that must not appear inside a text as it stands; the markers belong to it.
    """

    begin: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>\n"
    loss: dict[str, bool] = field(default_factory=lambda: {"system": False, "user": False, "assistant": True})
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    control: tuple[str, ...] = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")

    def codes(self) -> list[tuple[str, str]]:
        """Each control string with its replacement: a backslash and a letter; a backslash itself is doubled."""
        return [("\\", "\\\\")] + [(c, "\\" + chr(ord("a") + i)) for i, c in enumerate(self.control)]


DEFAULT = Template()


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """Replace the control strings; ``unescape`` gives the text back."""
    for plain, code in template.codes():
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    """The inverse of ``escape``: every backslash stands before the letter of its control string or before another one."""
    parts = F.split(text, r"\\\\", -1)  # doubled backslashes stand apart before the letters are read

    def one(part: Column) -> Column:
        for plain, code in template.codes()[1:]:
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    return F.array_join(F.transform(parts, one), "\\")


def _is_loss(role: Column, template: Template) -> Column:
    return F.coalesce(role.isin(*[r for r, on in template.loss.items() if on]), F.lit(False))


def _allowed(before: Column, role: Column, template: Template) -> Column:
    out = F.lit(False)
    for state, nexts in template.follows.items():
        out = out | ((before == state) & role.isin(*nexts))
    return F.coalesce(out, F.lit(False))


def format_turns(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per turn with its segments: (conv_id, place, role, text, allowed, segments, start, length).

    ``place`` counts the turns of a conversation from 0 by turn, role and text (nulls first); a null role or text is empty.
    ``allowed`` is the state machine's verdict on this turn: its state is the role of the turn before. ``segments`` are
    (text, loss) pairs; ``start`` and ``length`` are those of the turn in the formatted text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = lambda s: F.struct(F.lit(s).alias("text"), F.lit(False).alias("loss"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn(
        "segments",
        F.array(
            mark(template.begin), F.struct(escape(F.col("role"), template).alias("text"), F.lit(False).alias("loss")), mark(template.middle),
            F.struct(escape(F.col("text"), template).alias("text"), _is_loss(F.col("role"), template).alias("loss")), mark(template.end),
        ),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("length", F.length(F.array_join("segments.text", "")).cast("bigint"))
    return rows.select(
        "conv_id", (F.row_number().over(order) - 1).alias("place"), "role", "text",
        _allowed(F.lag("role", 1, "").over(order), F.col("role"), template).alias("allowed"), "segments",
        (F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("start"), "length",
    )


def format_conversations(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """(conv_id, valid, first_bad_turn, formatted, loss_spans): one formatted text per conversation.

    ``loss_spans`` are (start, length) in characters of the formatted text, in order. Conversations in a wrong order
    of roles are formatted like others and have ``valid`` false. Rows without conv_id form one conversation. A
    conversation becomes one value and so has to fit in one; equal rows are separate turns. No rows give no rows.
    """
    rows = format_turns(turns, template)
    head = F.length(F.concat(F.col("segments")[0]["text"], F.col("segments")[1]["text"], F.col("segments")[2]["text"]))
    span = F.when(F.col("segments")[3]["loss"], F.struct((F.col("start") + head).alias("start"), F.length(F.col("segments")[3]["text"]).cast("bigint").alias("length")))
    turn = F.struct("place", F.array_join("segments.text", "").alias("text"), span.alias("span"))
    per = rows.groupBy("conv_id").agg(
        F.min(F.when(~F.col("allowed"), F.col("place"))).alias("first_bad_turn"), F.array_sort(F.collect_list(turn)).alias("_t")
    )
    return per.select(
        "conv_id", F.col("first_bad_turn").isNull().alias("valid"), "first_bad_turn",
        F.array_join("_t.text", "").alias("formatted"), F.filter("_t.span", lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_turns(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Parse the formatted texts: (conv_id, turns, loss_text, formatted_chars), turns being (role, text), all unescaped."""
    pieces = F.split("formatted", F.concat(F.lit("\\Q"), F.lit(template.end), F.lit("\\E")), -1)
    body = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing follows the last end marker

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(template.begin) + 1), F.length(piece))
        return F.struct(
            unescape(F.substring_index(inner, template.middle, 1), template).alias("role"),
            unescape(F.substring(inner, F.instr(inner, template.middle) + len(template.middle), F.length(inner)), template).alias("text"),
        )

    def learnt(span: Column) -> Column:
        return unescape(F.substring(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int")), template)

    return formatted.select(
        "conv_id", F.transform(body, turn).alias("turns"), F.array_join(F.transform("loss_spans", learnt), "").alias("loss_text"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
