"""Conversations as training windows within a token budget, in column expressions.

Prefix sums of the turns' tokens cut a conversation into spans that begin and end with a turn. A window is the system
turn, a limited history of the turns before its span, and the span; only the span's assistant texts are under the loss
mask, so every assistant text is trained on once however often it is repeated.

A turn is written as ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line break. Control strings inside roles and
texts get a backslash after their first character, and backslashes are doubled, so that the marks stand only where the
template puts them and taking away one backslash before each character gives the text back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: What no role or text may hold as it is: the beginning of every mark, and the marks of other templates.
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]")
BUDGET = 1024
HISTORY = 192


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), CONTROL, doubled)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def estimated_tokens(role: Column, text: Column) -> Column:
    """A token for each four bytes begun, and four for the marks."""
    return F.floor((F.octet_length(role) + F.octet_length(text) + 3) / 4) + 4


def windows(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    tokens: Callable[[Column, Column], Column] = estimated_tokens,
) -> DataFrame:
    """One row per window: the conversation, ``window`` (increasing, with gaps), ``formatted``, ``fresh`` (characters
    before the first turn that is not repeated), ``loss`` (start and length of assistant texts, in characters).

    The first turn is retained in every window if it is the system's. A span has the turns that begin in one stride of
    the prefix sums: what budget, system turn and history leave. Where its last turn would pass the budget, that turn is
    a span of its own; where a span needs the history's room, the history is cut. So no window passes the budget, but for
    one of a single turn that does so with the system turn; no turn is cut or dropped.

    NULL roles and texts count as empty, NULL turns come first, equal turn numbers go by role and text; repeated rows
    are turns of their own; extra columns play no part; a NULL conversation is one conversation. A conversation is one
    task's rows while its prefix sums are made (streamed in order, spilling); windows are bounded by the budget.
    """
    rows = turns.select(
        F.col(conversation).alias("conversation"),
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    shown_role, shown_text = escaped(F.col("role")), escaped(F.col("text"))
    sized = rows.select(
        "*",
        tokens(shown_role, shown_text).cast("long").alias("tokens"),
        F.concat(F.lit(START), shown_role, F.lit(MIDDLE), shown_text, F.lit(END)).alias("piece"),
        F.length(F.concat(F.lit(START), shown_role, F.lit(MIDDLE))).alias("head"),
    )
    order = Window.partitionBy("conversation").orderBy("turn", "role", "text")
    begun = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    # Of the first turn alone: NULL, and so no system turn, where another role begins.
    system = F.first(F.when(F.col("role") == "system", F.struct("piece", "tokens"))).over(begun)
    numbered = sized.select(
        "conversation",
        F.row_number().over(order).alias("nth"),
        "role",
        "piece",
        "head",
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("sum"),
        system.alias("system"),
        "tokens",
    )
    kept = F.coalesce(F.col("system.tokens"), F.lit(0).cast("long"))
    retained = F.col("system").isNotNull() & (F.col("nth") == 1)
    # Half of the room at most is history, so that a turn is in the history of the next stride alone.
    measured = (
        numbered.withColumn("room", F.greatest(budget - kept, F.lit(0).cast("long")))
        .withColumn("near", F.least(F.lit(history).cast("long"), F.floor(F.col("room") / 2)))
        .select(
            "*",
            retained.alias("retained"),
            F.greatest(F.col("room") - F.col("near"), F.lit(1).cast("long")).alias("stride"),
            F.when(retained, 0).otherwise(F.col("sum") - kept).alias("before"),
            F.when(retained, 0).otherwise(F.col("sum") - kept + F.col("tokens")).alias("after"),
        )
    )
    cell = F.floor(F.col("before") / F.col("stride"))
    ends_near = ~F.col("retained") & (F.col("before") + F.col("near") >= (cell + 1) * F.col("stride"))
    own = F.struct(cell.alias("cell"), F.lit(True).alias("own"))
    next_one = F.struct((cell + 1).alias("cell"), F.lit(False).alias("own"))
    placed = measured.withColumn("place", F.explode(F.when(ends_near, F.array(own, next_one)).otherwise(F.array(own))))
    member = F.struct("nth", F.col("place.own").alias("own"), "retained", "role", "piece", "head", "before", "after")
    grouped = placed.groupBy("conversation", F.col("place.cell").alias("cell")).agg(
        F.array_sort(F.collect_list(member)).alias("members"),
        *[F.first(F.col(c)).alias(name) for c, name in (("system.piece", "system"), ("room", "room"), ("near", "near"))],
    )

    def length(turns):
        return F.element_at(turns, -1)["after"] - turns[0]["before"]

    spans = grouped.withColumn("turns", F.filter("members", lambda m: m["own"])).where(F.size("turns") > 0)
    n = F.size("turns")
    parted = (length(F.col("turns")) > F.col("room")) & (n > F.when(F.col("turns")[0]["retained"], 2).otherwise(1))
    whole = F.struct((2 * F.col("cell")).alias("window"), F.col("turns"))
    rest = F.struct((2 * F.col("cell")).alias("window"), F.slice("turns", F.lit(1), F.greatest(n - 1, F.lit(0))).alias("turns"))
    last = F.struct((2 * F.col("cell") + 1).alias("window"), F.slice("turns", n, F.lit(1)).alias("turns"))
    each = spans.select(
        "conversation",
        "members",
        "system",
        "near",
        "room",
        F.explode(F.when(parted, F.array(rest, last)).otherwise(F.array(whole))).alias("span"),
    )
    turns_of = F.col("span.turns")
    begin = turns_of[0]
    reach = F.least("near", F.greatest(F.col("room") - length(turns_of), F.lit(0).cast("long")))
    there = each.select(
        "conversation",
        F.col("span.window").alias("window"),
        turns_of.alias("turns"),
        F.concat(
            F.when(begin["retained"], "").otherwise(F.coalesce("system", F.lit(""))),
            F.array_join(
                F.transform(
                    F.filter(
                        "members",
                        lambda m: (m["nth"] < begin["nth"]) & ~m["retained"] & (m["before"] >= begin["before"] - reach),
                    ),
                    lambda m: m["piece"],
                ),
                "",
            ),
        ).alias("repeated"),
    )

    def masked(state, m):
        size = F.length(m["piece"])
        text = F.array(
            F.struct(
                (state["at"] + m["head"]).alias("start"), (size - m["head"] - len(END)).alias("length")
            )
        )
        spans = F.when(m["role"] == "assistant", F.concat(state["spans"], text)).otherwise(state["spans"])
        return F.struct((state["at"] + size).alias("at"), spans.alias("spans"))

    none = F.array().cast("array<struct<start: int, length: int>>")
    start = F.struct(F.length("repeated").alias("at"), none.alias("spans"))
    return there.select(
        F.col("conversation").alias(conversation),
        "window",
        F.concat("repeated", F.array_join(F.transform("turns", lambda m: m["piece"]), "")).alias("formatted"),
        F.length("repeated").alias("fresh"),
        F.aggregate("turns", start, masked, lambda state: state["spans"]).alias("loss"),
    )


def read_back(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row per conversation, from the windows alone: ``turns`` (role and text as they were), ``trained`` (the texts
    under the loss mask) and ``formatted_chars``."""
    parts = formatted.groupBy(conversation).agg(
        F.array_sort(F.collect_list(F.struct("window", "formatted", "fresh", "loss"))).alias("windows")
    )
    fresh = F.array_join(
        F.transform("windows", lambda w: F.substr(w["formatted"], w["fresh"] + 1, F.length(w["formatted"]))), ""
    )
    pieces = F.filter(F.split(fresh, "<\\|im_end\\|>\n"), lambda p: p != "")

    def turn(piece):
        halves = F.split(F.substr(piece, F.lit(len(START) + 1), F.length(piece)), "<\\|im_sep\\|>")
        return F.struct(unescaped(halves[0]).alias("role"), unescaped(halves[1]).alias("text"))

    trained = F.transform(
        "windows",
        lambda w: F.transform(
            w["loss"], lambda span: unescaped(F.substr(w["formatted"], span["start"] + 1, span["length"]))
        ),
    )
    return parts.select(
        conversation,
        F.transform(pieces, turn).alias("turns"),
        F.flatten(trained).alias("trained"),
        F.aggregate("windows", F.lit(0).cast("long"), lambda n, w: n + F.length(w["formatted"])).alias("formatted_chars"),
        F.size("windows").cast("long").alias("n_windows"),
    )
