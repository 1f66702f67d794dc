"""Operator 2, chat formatting with typed content parts. DataFrame functions only.

A turn's content is an ordered list of parts (``PART``): text, image, audio or
document. A visitor, one handler per kind, flattens the parts: text is
escaped, any other kind becomes an ordered placeholder ``<|image:3|>`` whose
attachment reference and expanded token count are recorded beside the string.
The template marks turns with strings that all begin with ``<|``; inside texts
and roles a backslash doubles and ``<|`` becomes ``<\\|``, so no mark can occur
in them and the change is undone exactly.

Output per conversation: ``formatted``, ``turn_starts`` and ``loss_spans``
(code point offsets of the trained text), ``attachments`` and ``n_tokens``.
Offsets are running sums over the rows, so nothing is quadratic in the length
of a conversation; one conversation is one string, hence one row's work.

Defined cases: rows are ordered by (turn, role, content), NULLs first, and
repeated rows all stay; a NULL text is empty, a NULL role is empty and not
trained; a NULL conv_id is a conversation of its own; a NULL or empty part list
is an empty turn; an unknown kind becomes a placeholder of that kind with no
tokens; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, text_or_empty, words_of

PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"


@dataclass(frozen=True)
class Template:
    """Marks; each begins with ``guard``, which never occurs in escaped text."""
    guard: str = "<|"
    turn: str = "<|turn|>"
    says: str = "<|says|>"
    end: str = "<|end|>\n"
    trained_role: str = "assistant"


@dataclass(frozen=True)
class TokenRates:
    """Tokens that an attachment expands to."""
    image_patch: int = 14
    audio_per_second: int = 25
    document_per_page: int = 512


TEMPLATE, RATES = Template(), TokenRates()


def escape(c: Column, t: Template = TEMPLATE) -> Column:
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit(t.guard), F.lit(t.guard[0] + "\\" + t.guard[1:]))


def unescape(c: Column, t: Template = TEMPLATE) -> Column:
    opened = F.replace(c, F.lit(t.guard[0] + "\\" + t.guard[1:]), F.lit(t.guard))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def visitor(rates: TokenRates) -> dict[str, Callable[[Column], Column]]:
    """Expanded token count of a part, by kind."""
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    patches = lambda c: F.ceil(F.coalesce(c, F.lit(0)) / rates.image_patch)
    return {
        "text": lambda p: F.size(words_of(p["text"])).cast("bigint"),
        "image": lambda p: (patches(p["width"]) * patches(p["height"])).cast("bigint"),
        "audio": lambda p: F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * rates.audio_per_second).cast("bigint"),
        "document": lambda p: whole(p["pages"]) * rates.document_per_page,
    }


def _visit(part: Column, handlers: dict[str, Callable[[Column], Column]]) -> Column:
    tokens = F.lit(0).cast("bigint")
    for kind, handler in handlers.items():
        tokens = F.when(part["kind"] == kind, handler(part)).otherwise(tokens)
    return tokens


def format_chats(turns: DataFrame, template: Template = TEMPLATE, rates: TokenRates = RATES) -> DataFrame:
    """``turns`` (conv_id, turn, role, parts) as one row per conversation."""
    t, handlers = template, visitor(rates)
    parts = F.coalesce("parts", F.array().cast(f"array<{PART}>"))
    by_turn = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("parts").asc_nulls_first())
    before = by_turn.rowsBetween(Window.unboundedPreceding, -1)
    is_text = lambda p: F.coalesce(p["kind"] == "text", F.lit(False))
    rows = turns.select("conv_id", "turn", "role", parts.alias("parts"))
    rows = (rows.withColumn("pos", F.row_number().over(by_turn) - 1)
            .withColumn("__n", F.size(F.filter("parts", lambda p: ~is_text(p))))
            .withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))))
    number = lambda i: F.col("__base") + F.size(F.filter(F.slice("parts", 1, i + 1), lambda q: ~is_text(q)))
    flat = F.transform("parts", lambda p, i: F.struct(
        F.when(is_text(p), escape(text_or_empty(p["text"]), t)).otherwise(
            F.concat(F.lit(t.guard), escape(text_or_empty(p["kind"]), t), F.lit(":"),
                     number(i).cast("string"), F.lit("|>"))).alias("shown"),
        F.when(~is_text(p), F.struct(number(i).cast("bigint").alias("number"), F.col("pos").alias("turn_pos"),
                                     p["kind"].alias("kind"), p["uri"].alias("uri"),
                                     _visit(p, handlers).alias("n_tokens"))).alias("attachment"),
        _visit(p, handlers).alias("n_tokens")))
    rows = rows.withColumn("flat", flat)
    head = F.concat(F.lit(t.turn), escape(text_or_empty(F.col("role")), t), F.lit(t.says))
    rows = (rows.withColumn("head", head)
            .withColumn("body", F.array_join(F.transform("flat", lambda x: x["shown"]), ""))
            .withColumn("tokens", F.aggregate("flat", F.lit(0).cast("bigint"), lambda a, x: a + x["n_tokens"]))
            .withColumn("attached", F.filter(F.transform("flat", lambda x: x["attachment"]),
                                             lambda x: x.isNotNull())))
    rows = (rows.withColumn("segment", F.concat("head", "body", F.lit(t.end)))
            .withColumn("start", F.coalesce(F.sum(F.length("segment").cast("bigint")).over(before), F.lit(0))))
    span = F.when(F.col("role") == t.trained_role, F.struct(
        F.col("pos").alias("turn_pos"), (F.col("start") + F.length("head")).alias("start"),
        F.length("body").cast("bigint").alias("length")))
    grouped = rows.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sum("tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("pos", "segment", "start", "attached", span.alias("span")))).alias("s"))
    return grouped.select(
        "conv_id", "n_turns", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("formatted"),
        F.transform("s", lambda x: x["start"]).alias("turn_starts"),
        F.filter(F.transform("s", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss_spans"),
        F.flatten(F.transform("s", lambda x: x["attached"])).alias("attachments"), "n_tokens")


def text_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with each text as the only part of its turn."""
    part = F.struct(F.lit("text").alias("kind"), text_or_empty(F.col("text")).alias("text"),
                    *[F.lit(None).cast(ty).alias(n) for n, ty in (
                        ("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"),
                        ("pages", "int"))])
    return rows.select("conv_id", "turn", "role", F.array(part.cast(PART)).alias("parts"))


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, ``turns`` (role, text) and ``loss_text`` parsed from the formatted string alone
    and the text under its loss spans."""
    t = template
    segments = F.slice(F.split("formatted", rf"\Q{t.turn}\E", -1), 2, F.greatest(F.col("n_turns"), F.lit(1)).cast("int"))

    def turn(s: Column) -> Column:
        body = F.substring_index(F.substring_index(s, t.says, -1), t.end, 1)
        return F.struct(unescape(F.substring_index(s, t.says, 1), t).alias("role"), unescape(body, t).alias("text"))

    def trained(s: Column) -> Column:
        at = lambda x: x["start"] - F.get(F.col("turn_starts"), x["turn_pos"]) - len(t.turn) + 1
        return F.array_join(F.transform("loss_spans", lambda x: unescape(
            F.substring(F.get(s, x["turn_pos"]), at(x).cast("int"), x["length"].cast("int")), t)), "")

    return formatted.select("conv_id", "formatted", "n_turns", let(segments, lambda s: F.struct(
        F.transform(s, turn).alias("turns"), trained(s).alias("loss_text"))).alias("r")
    ).select("conv_id", "formatted", "n_turns", "r.turns", "r.loss_text")


def digest(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """The contract's columns, read back from the output."""
    back = read_back(formatted, template)
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
