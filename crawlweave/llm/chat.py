"""Chat formatting in budgeted windows: turn-aligned spans, repeated context, loss masks; Columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.llm.common import stored

END = "</turn>\n"
HEAD = "### "
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"), ("\n", "\\n"))
IN_TEXT = ESCAPES[:3]


def escape(text: Column, pairs: tuple[tuple[str, str], ...] = IN_TEXT) -> Column:
    """Text without ``#`` and ``<``, the first characters of all control strings; ``unescape`` reverses it."""
    for plain, safe in pairs:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column, pairs: tuple[tuple[str, str], ...] = IN_TEXT) -> Column:
    for plain, safe in reversed(pairs):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def turn_tokens(text: Column) -> Column:
    """Words and punctuation marks, plus 4 for the marks of a turn: the unit of the budget."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]")) + F.lit(4)


def chat_windows(turns: DataFrame, budget: int = 1024, history: int = 256) -> DataFrame:
    """Format conversations (conv_id, turn, role, text) into windows: one row per window.

    Columns: conv_id, window (from 0), n_repeated (turns at its start that an earlier window holds), n_turns, n_tokens,
    text, and loss_spans, an array of (start, length) in code points of ``text``: the assistant turns that are not
    repeated. A window is the system turn (the first turn, if its role says so), up to ``history`` tokens of the turns
    before its span, and its span of new turns. Spans are cut by prefix sums of turn tokens: a new span begins where the
    sum passes a multiple of half the room that system turn and history leave; a turn above that half stands alone. So
    no window is above the budget unless one turn alone, with the system turn, is; turns are never cut.

    Null text and role are empty. Turns sort by turn (null first), role, text; equal rows are turns of their own. A null
    conv_id is a conversation. Other columns are ignored. An empty table gives no windows. A conversation is held by
    one task as one sorted run (its digest needs it in order), a window as one row.
    """
    conv = Window.partitionBy("conv_id")
    by_turn = conv.orderBy("turn", "role", "text")
    before = conv.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("rank", F.row_number().over(by_turn)).withColumn("tokens", turn_tokens(F.col("text")))
    is_system = (F.col("rank") == 1) & (F.col("role") == "system")
    rows = (rows.withColumn("is_system", is_system)
            .withColumn("system_tokens", F.max(F.when(is_system, F.col("tokens")).otherwise(0)).over(conv))
            .withColumn("half", F.greatest(F.lit(1), F.floor((budget - history - F.col("system_tokens")) / 2)))
            .withColumn("counted", F.when(is_system, 0).otherwise(F.col("tokens")))
            .withColumn("start", F.coalesce(F.sum("counted").over(before), F.lit(0)))
            .withColumn("big", F.col("counted") > F.col("half"))
            .withColumn("cell", F.floor(F.col("start") / F.col("half"))))
    in_order = conv.orderBy("rank")
    breaks = (F.col("big") | F.lag("big").over(in_order) | (F.col("cell") != F.lag("cell").over(in_order)))
    opens = F.when((F.col("rank") == 1) | F.lag("is_system").over(in_order), 0).otherwise(breaks.cast("int"))
    rows = rows.withColumn("window", F.sum(F.coalesce(opens, F.lit(0))).over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    spans = rows.groupBy("conv_id", "window").agg(
        F.min("start").alias("span_start"), F.sum("counted").alias("span_tokens"),
        F.max("system_tokens").alias("system_tokens")).where("window > 0")
    room = F.greatest(F.lit(0), F.least(
        F.lit(history), F.lit(budget) - F.col("system_tokens") - F.col("span_tokens")))
    spans = spans.withColumn("from", F.col("span_start") - room)
    # a turn can only be repeated by spans that start in its own or the next stretch of ``history`` tokens
    stretch = max(1, history)
    wanted = spans.select(F.col("conv_id").alias("c"), F.col("window").alias("w"), "span_start", "from", F.explode(
        F.array_distinct(F.array(F.floor(F.col("from") / stretch), F.floor(F.col("span_start") / stretch)))).alias("s"))
    past = rows.where(~F.col("is_system")).withColumn("s", F.floor(F.col("start") / stretch))
    shape = ["conv_id", "window", "rank", "role", "text", "tokens", "repeated"]
    repeated = past.join(wanted, past["conv_id"].eqNullSafe(F.col("c")) & (past["s"] == wanted["s"])
                         & (F.col("start") >= F.col("from")) & (F.col("start") < F.col("span_start"))).select(
        "conv_id", F.col("w").alias("window"), "rank", "role", "text", "tokens", F.lit(True).alias("repeated"))
    system = rows.where("is_system")
    others = spans.select(F.col("conv_id").alias("c"), F.col("window").alias("w"))
    kept = system.join(others, system["conv_id"].eqNullSafe(F.col("c"))).select(
        "conv_id", F.col("w").alias("window"), "rank", "role", "text", "tokens", F.lit(True).alias("repeated"))
    new = rows.withColumn("repeated", F.lit(False)).select(*shape)

    head = F.concat(F.lit(HEAD), escape(F.col("role"), ESCAPES), F.lit(": "))
    body = escape(F.col("text"))
    parts = new.union(repeated).union(kept).select(
        "conv_id", "window", "tokens", F.struct(
            "rank", "repeated", (F.col("role") == "assistant").alias("learns"), head.alias("head"),
            body.alias("body")).alias("part"))
    windows = parts.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list("part")).alias("parts"), F.sum("tokens").alias("n_tokens"))
    pieces = F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def walk(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["head"])
        span = F.struct(begin.alias("start"), F.length(p["body"]).alias("length"))
        spans = F.when(p["learns"] & ~p["repeated"], F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct((begin + F.length(p["body"]) + F.lit(len(END))).alias("at"), spans.alias("spans"))

    return windows.select(
        "conv_id", "window", F.size(F.filter("parts", lambda p: p["repeated"])).alias("n_repeated"),
        F.size("parts").alias("n_turns"), "n_tokens", F.array_join(pieces, "").alias("text"),
        F.aggregate("parts", start, walk)["spans"].alias("loss_spans"))


def stored_windows(turns: DataFrame, budget: int = 1024, history: int = 256) -> DataFrame:
    """The windows of ``chat_windows``, written below the shared folder and read from there."""
    return stored(chat_windows(turns, budget, history), "chat-windows")


def read_windows(windows: DataFrame) -> DataFrame:
    """The turns that a table of windows holds, each once: conv_id, window, position, role, text.

    The reverse of ``chat_windows``, from ``text`` and ``n_repeated`` alone.
    """
    found = F.slice(F.split("text", END), F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    rows = windows.select("conv_id", "window", F.posexplode(found).alias("position", "_turn"))
    head = F.substring_index("_turn", ":", 1)
    return rows.select("conv_id", "window", "position",
                       unescape(F.expr(f"substring(substring_index(_turn, ':', 1), {len(HEAD) + 1})"),
                                ESCAPES).alias("role"),
                       unescape(F.substring(F.col("_turn"), F.length(head) + 3, F.length("_turn"))).alias("text"))


def read_loss(windows: DataFrame) -> DataFrame:
    """The text under the loss masks, unescaped, in order: conv_id, window, position, text."""
    cut = F.transform("loss_spans", lambda s: F.substring(F.col("text"), s["start"] + 1, s["length"]))
    rows = windows.select("conv_id", "window", F.posexplode(cut).alias("position", "_text"))
    return rows.select("conv_id", "window", "position", unescape(F.col("_text")).alias("text"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: turns, their digest, learned text, formatted length."""
    order = ["window", "position"]

    def joined(rows: DataFrame, text: Column, name: str) -> DataFrame:
        listed = F.sort_array(F.collect_list(F.struct(*order, text.alias("t"))))
        return rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.array_join(
            F.transform(listed, lambda r: r["t"]), "").alias(name)).withColumnRenamed("conv_id", "c_" + name)

    turn = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    turns = joined(read_windows(windows), turn, "turns").withColumnRenamed("n", "n_turns")
    loss = joined(read_loss(windows), F.col("text"), "loss").drop("n")
    sizes = windows.groupBy("conv_id").agg(F.sum(F.length("text")).cast("long").alias("formatted_chars"),
                                           F.count("*").alias("n_windows"))
    learned = F.coalesce("loss", F.lit(""))
    return (sizes.join(turns, sizes["conv_id"].eqNullSafe(F.col("c_turns")))
            .join(loss, sizes["conv_id"].eqNullSafe(F.col("c_loss")), "left")
            .select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
                    F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                    "formatted_chars", "n_windows"))
