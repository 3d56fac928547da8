"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted, runs of the same role merged, and the
conversation concatenated to::

    ### <role>: <text></part><text of the same role></turn>\\n

Inside texts and roles the escape character and the control strings are rewritten reversibly:
``\\`` -> ``\\b``, ``### `` -> ``\\h## ``, ``</turn>`` -> ``\\l/turn>``, ``</part>`` -> ``\\l/part>`` (and ``:``
-> ``\\c`` in roles), so a text can neither end its turn nor open another one, and ``parse`` returns the
turns exactly. The loss mask is the list of segments of the formatted string, each flagged.

Defined cases: a null text or role is the empty string; a null ``conv_id`` is one conversation of its
own; turns with the same number are ordered by role, then text; repeated rows are repeated turns; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER, ROLE_END, PART, TURN = "### ", ": ", "</part>", "</turn>\n"
LOSS_ROLES = ("assistant",)

_ESCAPES = (("\\", "\\b"), ("### ", "\\h## "), ("</turn>", "\\l/turn>"), ("</part>", "\\l/part>"))
_CODES = (("\\c", ":"), ("\\l", "<"), ("\\h", "#"), ("\\b", "\\"))


def escape(text: Column) -> Column:
    for raw, code in _ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape(text: Column) -> Column:
    for code, raw in _CODES:
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """``(conv_id, turn, role, text)`` -> one row per conversation: ``conv_id``, ``formatted`` and
    ``segments`` (``array<struct<loss: boolean, text: string>>``, whose texts concatenate to ``formatted``)."""
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    n = F.size("turns")
    role_at = lambda i: F.element_at("turns", i)["role"]
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (role_at(i) != role_at(F.greatest(i - 1, F.lit(1)))))
    merged = sorted_turns.withColumn("starts", starts).withColumn(
        "runs",
        F.transform(
            "starts",
            lambda s, k: F.struct(
                role_at(s).alias("role"),
                F.slice("turns", s, F.coalesce(F.get("starts", k + 1), n + 1) - s).alias("parts"),
            ),
        ),
    )

    def segments_of(run: Column) -> Column:
        scored = run["role"].isin(*loss_roles)
        piece = lambda loss, text: F.struct(loss.alias("loss"), text.alias("text"))
        glue = lambda i: F.when(i < F.size(run["parts"]) - 1, F.lit(PART)).otherwise(F.lit(TURN))
        header = piece(F.lit(False), F.concat(F.lit(HEADER), escape_role(run["role"]), F.lit(ROLE_END)))
        body = F.transform(run["parts"], lambda t, i: F.array(piece(scored, escape(t["text"])), piece(F.lit(False), glue(i))))
        return F.concat(F.array(header), F.flatten(body))

    segments = merged.select("conv_id", F.flatten(F.transform("runs", segments_of)).alias("segments"))
    return segments.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: ``array<struct<role, text>>``, unescaped."""
    runs = F.filter(F.split(formatted, TURN, -1), lambda r: r != "")

    def turns_of(run: Column) -> Column:
        after = F.substr(run, F.lit(len(HEADER) + 1))
        role = F.substring_index(after, ROLE_END, 1)
        body = F.substr(after, F.length(role) + len(ROLE_END) + 1)
        return F.transform(F.split(body, PART, -1), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(runs, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Read ``format_conversations`` output back: turns parsed from ``formatted``, loss text from the mask."""
    turn_bytes = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turn_bytes, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
