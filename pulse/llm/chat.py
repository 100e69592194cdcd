"""Chat conversations formatted as token-budgeted windows with a loss mask.

A window holds the conversation's system turn (a first turn of that role), some history
and new turns, all in the template ``<|im_start|>role\\ntext<|im_end|>\\n``. Prefix sums of
the turns' tokens choose the spans: with T tokens left for new turns in a window, turns that
lie between two multiples of T form one window, and a turn that crosses a multiple has one
for itself, so a window never cuts a turn and keeps its budget unless a single turn is
beyond it. History is the run of turns before the first new one of at most
``history_tokens``. System turn and history are repeated without loss; every assistant
text is under the loss mask exactly once, in the window where its turn is new.

Control strings in texts are escaped reversibly: ``<``, any number of backslashes and ``|``
gets one backslash more.

Prefix sums go over runs of turns first and over the runs of a conversation then, so a
conversation of any length is summed, cut and formatted by many tasks. Only DataFrame
functions are used.

Defined cases: a null text or role is empty; turns are ordered by turn (null first), role
and text, so equal rows follow each other and all count; rows with a null conversation id form
one conversation; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET_TOKENS = 2048
HISTORY_TOKENS = 256
#: New turns get at least this many tokens, however long the system turn is.
LEAST_NEW_TOKENS = 128
#: Turn numbers that one task sums at once.
RUN_TURNS = 64
START, END = "<|im_start|>", "<|im_end|>\n"
TEMPLATE_TOKENS = 5


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def count_tokens(text: Column) -> Column:
    """Runs of letters or digits, and each other character that is not blank."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"))


def _ordered_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str, tokens) -> DataFrame:
    """Turns with their place and the tokens of the non-retained turns before them."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(conv).alias("conv"),
        F.when(F.col(conv).isNull(), "none").otherwise(F.concat(F.lit("is "), F.col(conv).cast("string"))).alias("key"),
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        value.alias("text"), (tokens(value) + TEMPLATE_TOKENS).cast("long").alias("tokens"),
    ).withColumn("run", F.coalesce(F.floor(F.col("turn") / RUN_TURNS), F.lit(-(2**62))))
    in_run = Window.partitionBy("key", "run").orderBy(F.asc_nulls_first("turn"), "role", "text")
    local = rows.withColumns({
        "rank": F.row_number().over(in_run),
        "local": F.coalesce(F.sum("tokens").over(in_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    first_system = F.max(F.when((F.col("rank") == 1) & (F.col("role") == "system"), F.col("tokens")))
    runs = local.groupBy("key", "run").agg(
        F.sum("tokens").alias("run_tokens"), F.count(F.lit(1)).alias("run_turns"), first_system.alias("run_system")
    )
    by_run = Window.partitionBy("key").orderBy("run")
    earlier = by_run.rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.select(
        "key", "run", F.coalesce(F.sum("run_tokens").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.sum("run_turns").over(earlier), F.lit(0)).alias("turns_before"),
        F.coalesce(F.first("run_system").over(by_run), F.lit(0)).alias("system_tokens"),
    )
    placed = local.join(sums, ["key", "run"]).withColumn("place", F.col("turns_before") + F.col("rank"))
    retained = (F.col("place") == 1) & (F.col("system_tokens") > 0)
    begin = F.when(retained, 0).otherwise(F.col("before") + F.col("local") - F.col("system_tokens"))
    return placed.select(
        "conv", "key", "role", "text", "place", "system_tokens", retained.alias("retained"), begin.alias("begin"),
        (begin + F.when(retained, 0).otherwise(F.col("tokens"))).alias("end"), "tokens",
    )


def format_conversations(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    budget: int = BUDGET_TOKENS, history_tokens: int = HISTORY_TOKENS, tokens=count_tokens,
) -> DataFrame:
    """``conv, key, window, formatted, n_turns, n_repeated, n_tokens, loss``, a row per window.

    ``window`` orders a conversation's windows; the first ``n_repeated`` turns of
    ``formatted`` are repeats; ``loss`` has ``(start, length)`` in code points from 0.
    """
    room = F.greatest(F.lit(budget - history_tokens) - F.col("system_tokens"), F.lit(LEAST_NEW_TOKENS))
    turns = _ordered_turns(conversations, conv, turn, role, text, tokens).withColumn("room", room)
    step = F.floor(F.col("begin") / F.col("room"))
    crosses = ~F.col("retained") & (F.floor((F.col("end") - 1) / F.col("room")) > step)
    new = turns.withColumn("window", step * 2 + crosses.cast("long")).withColumn("repeated", F.lit(False))
    windows = new.groupBy("key", "window").agg(
        F.min("begin").alias("window_begin"), F.min("place").alias("window_place"))

    # A turn can be history only of windows that begin at most history_tokens after its own begin.
    last = F.floor((F.col("begin") + history_tokens) / F.col("room")) * 2 + 1
    reach = new.filter(~F.col("retained") & (F.col("tokens") <= history_tokens)).withColumn(
        "window", F.explode(F.sequence(F.col("window") + 1, F.greatest(last, F.col("window") + 1))))
    history = reach.join(windows, ["key", "window"]).filter(
        (F.col("window_begin") >= F.col("end")) & (F.col("window_begin") <= F.col("begin") + history_tokens))
    systems = turns.filter("retained").drop("window").join(windows, "key").filter("window_place > 1")
    parts = new
    for repeats in (history, systems):
        parts = parts.unionByName(repeats.withColumn("repeated", F.lit(True)).select(*new.columns))

    content = escape(F.col("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    pieces = parts.select(
        "conv", "key", "window", "place", "repeated", "tokens", "role",
        F.char_length(head).alias("head_chars"), F.char_length(content).alias("chars"),
        F.concat(head, content, F.lit(END)).alias("piece"),
    )
    in_window = Window.partitionBy("key", "window").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("piece")).over(in_window), F.lit(0)) + F.col("head_chars")
    target = ~F.col("repeated") & (F.col("role") == "assistant") & (F.col("chars") > 0)
    span = F.when(target, F.struct(start.cast("int").alias("start"), F.col("chars").alias("length")))
    spans = pieces.withColumn("span", span)
    return spans.groupBy("key", "window").agg(
        F.first("conv").alias("conv"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda p: p["piece"]), "")
        .alias("formatted"),
        F.count(F.lit(1)).alias("n_turns"), F.sum(F.col("repeated").cast("int")).alias("n_repeated"),
        F.sum("tokens").alias("n_tokens"), F.array_sort(F.collect_list("span")).alias("loss"),
    )


def read_turns(formatted: Column, n_repeated: Column) -> Column:
    """The new turns of a window as an array of ``(role, text)``, unescaped."""
    blocks = F.split(formatted, r"<\|im_end\|>\n")
    count = F.size(blocks) - 1
    own = F.slice(blocks, n_repeated.cast("int") + 1, F.greatest(count - n_repeated.cast("int"), F.lit(0)))

    def turn(block: Column) -> Column:
        body = F.substr(block, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        text = F.substr(body, F.char_length(role) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(own, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """What stands under the loss mask of a window, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")
