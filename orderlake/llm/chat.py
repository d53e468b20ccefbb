"""Chat formatting in budgeted windows (DataFrame operations only).

Prefix sums of the turns' token counts choose turn-aligned windows: with a
stride of half of what the budget leaves after history and system turn, a turn
belongs to the window in which its prefix sum falls, and a turn longer than the
stride gets a window of its own.  Every window but the first opens with the
conversation's system turn and the last turns before it that fit the history
budget, or what a long turn leaves of it; both are repeated there with their
loss mask off, so each target is learned once.

Template: ``<turn ROLE>TEXT</turn>`` and a line feed.  Inside roles and texts
``\\`` is written ``\\b``, ``<`` is written ``\\l`` and ``>`` is written ``\\g``,
so no text can hold a control string, and the writing is reversible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
OPEN, CLOSE = "<turn ", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\g"), F.lit(">")), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def turn_tokens(text: Column) -> Column:
    """Words and single marks, and two for the template."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long") + 2


def budgeted_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, first_turn, new_turns, tokens, text, spans.

    ``spans`` has a row per turn of the window: its place in ``text`` (start,
    length, in code points, without the template), whether it repeats an
    earlier window's turn, and whether it is under the loss mask (assistant
    turns that are not repeated).

    Turns are ordered by (turn, role, text), nulls first.  Null roles and
    texts count as empty; a null conv_id is a conversation of its own; rows
    that repeat are turns that repeat; an empty table gives no windows.  A
    turn longer than the budget is kept whole in its own window.  Extra
    columns are ignored.
    """
    stride = (budget - history) // 2
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = Window.partitionBy("conv_id").orderBy("at")
    rows = turns.select(
        F.col("conv_id"), F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).withColumn("tokens", turn_tokens(F.col("text")))
    rows = rows.select("*", F.row_number().over(order).alias("n"), (F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")).alias("at"))
    rows = rows.select(
        "conv_id", "n", "at", "tokens", "role",
        escape(F.col("text")).alias("body"),
        F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(">")).alias("head"),
    )
    piece = F.struct("head", "body", "role", "tokens")
    # The system turn opens the conversation, so it is the first row or there is none.
    is_system = (F.col("n") == 1) & (F.col("role") == "system")
    rows = rows.select("*", F.first(F.when(is_system, piece)).over(before.rowsBetween(Window.unboundedPreceding, 0)).alias("system"))
    room = F.lit(budget) - F.coalesce(F.col("system.tokens"), F.lit(0))  # of history and new turns
    stride = F.greatest(F.floor((room - history) / 2), F.lit(1))
    rows = rows.select("*", (F.floor(F.col("at") / stride) * 2 + (F.col("tokens") > stride).cast("long")).alias("span"))
    past = F.collect_list(F.when(~is_system, F.struct("at", piece.alias("p")))).over(before.rangeBetween(-history, -1))
    rows = rows.select("*", F.lag("span").over(before).alias("span_before"), past.alias("past_near"))
    past_all = F.transform(F.filter("past_near", lambda x: x["at"] >= F.col("at") - (room - F.col("tokens"))), lambda x: x["p"])
    rows = rows.select("*", past_all.alias("past_all"))
    opens = F.col("span_before").isNull() | (F.col("span_before") != F.col("span"))
    none = F.array().cast("array<struct<head:string,body:string,role:string,tokens:bigint>>")
    kept = F.when(opens & (F.col("n") > 1), F.concat(F.when(F.col("system").isNotNull(), F.array("system")).otherwise(none), F.col("past_all"))).otherwise(none)
    rows = rows.select("conv_id", "span", "n", piece.alias("own"), kept.alias("kept"))
    grouped = rows.groupBy("conv_id", "span").agg(
        F.min("n").alias("first_turn"),
        F.array_sort(F.collect_list(F.struct("n", "own", "kept"))).alias("rows"),
    )
    old = F.col("rows")[0]["kept"]
    new = F.transform("rows", lambda r: r["own"])
    pieces = F.concat(F.transform(old, lambda p: F.struct(p.alias("p"), F.lit(True).alias("repeated"))), F.transform(new, lambda p: F.struct(p.alias("p"), F.lit(False).alias("repeated"))))
    grouped = grouped.select("conv_id", "span", "first_turn", F.size("rows").cast("long").alias("new_turns"), pieces.alias("pieces"))
    first = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint,repeated:boolean,loss:boolean>>").alias("out"),
    )

    def step(acc, x):
        start = acc["at"] + F.char_length(x["p"]["head"])
        length = F.char_length(x["p"]["body"]).cast("long")
        loss = ~x["repeated"] & (x["p"]["role"] == "assistant")
        span = F.struct(start.cast("long").alias("start"), length.alias("length"), x["repeated"].alias("repeated"), loss.alias("loss"))
        return F.struct((start + length + len(CLOSE)).cast("long").alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return grouped.select(
        "conv_id",
        F.col("span").alias("window"),
        "first_turn",
        "new_turns",
        F.aggregate("pieces", F.lit(0).cast("long"), lambda a, x: a + x["p"]["tokens"]).alias("tokens"),
        F.array_join(F.transform("pieces", lambda x: F.concat(x["p"]["head"], x["p"]["body"], F.lit(CLOSE))), "").alias("text"),
        F.aggregate("pieces", first, step, lambda acc: acc["out"]).alias("spans"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Turns and loss text of each conversation, parsed from the formatted windows.

    A conversation is one row of the result, so its text must fit in one value.
    """
    parsed = F.filter(F.split("text", "</turn>\n"), lambda x: x != "")
    rows = windows.select("conv_id", "first_turn", "text", "spans", parsed.alias("turns"))
    fresh = F.filter(F.arrays_zip("turns", "spans"), lambda x: ~x["spans"]["repeated"])

    def role(t):
        return unescape(F.substring_index(F.substr(t, F.lit(len(OPEN) + 1)), ">", 1))

    def body(t):
        return unescape(F.substr(t, F.instr(t, ">") + 1))

    rows = rows.select(
        "conv_id",
        "first_turn",
        F.char_length("text").cast("long").alias("formatted"),
        F.size(fresh).cast("long").alias("n"),
        F.array_join(F.transform(fresh, lambda x: F.concat(role(x["turns"]), F.lit("\n"), body(x["turns"]), F.lit("\n"))), "").alias("said"),
        F.array_join(
            F.transform(
                F.filter("spans", lambda s: s["loss"]),
                lambda s: unescape(F.substr("text", (s["start"] + 1).cast("int"), s["length"].cast("int"))),
            ),
            "",
        ).alias("loss"),
    )
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_turn", c))), lambda x: x[c]), "")
    rows = rows.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), joined("said").alias("said"), joined("loss").alias("loss"), F.sum("formatted").alias("formatted_chars")
    )
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return rows.select(
        "conv_id", "n_turns", sha("said").alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
        sha("loss").alias("loss_sha256"), "formatted_chars",
    )
