"""Funnel over events; anomaly scores and alerts over metric rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.config import JobConfig

# A deviation below this share of the mean is rounding noise of a constant history and gives no score.
LEAST_DEVIATION = 1e-9
SERIES = ("metric_name", "dimension_key", "dimension_value")


#: The steps of the funnel in order.
FUNNEL = ("page_view", "add_to_cart", "order_created")
#: Slices of time that a window's events are dealt over, so that a very active user is not one task.
FUNNEL_SLICES = 24


def funnel(events: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Users per window who viewed, then added to cart, then ordered; batch or stream.

    The steps are taken in turn: a view, a cart addition at or after it, an order at or after that. In a batch,
    events are read once and dealt by window, user and slice of the window. One sort gives the ways through
    a slice (view, view to cart, cart to order and so on) as running maxima, and a user's slices are then
    put together in order. On a stream, a user's steps are kept until the watermark closes the window.
    """
    step = F.array_position(F.array(*map(F.lit, FUNNEL)), F.col("event_type")).cast("int") - 1
    window = F.window("event_ts", config.window_duration, config.slide_duration).alias("window")
    moves = events.filter(F.col("event_type").isin(*FUNNEL) & F.col("user_id").isNotNull()).select(
        window, "user_id", "event_ts", step.alias("step"))
    reached = _steps_on_stream(moves) if events.isStreaming else _steps_by_slice(moves)
    users = [F.count_if(F.col("reached") > i).alias(name) for i, name in enumerate(("viewers", "carters", "buyers"))]
    return reached.groupBy("window").agg(*users).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "viewers",
        "carters",
        "buyers",
        F.try_divide("carters", "viewers").alias("view_to_cart"),
        F.try_divide("buyers", "carters").alias("cart_to_order"),
    )


def _steps_by_slice(moves: DataFrame) -> DataFrame:
    """``window, user_id, reached``: how many steps in turn."""
    micros = {end: F.unix_micros(f"window.{end}") for end in ("start", "end")}
    part = F.floor((F.unix_micros("event_ts") - micros["start"]) * FUNNEL_SLICES / (micros["end"] - micros["start"]))
    key = ["window", "user_id", "slice"]
    # Of equal times the earlier step comes first, as "at or after" asks.
    so_far = Window.partitionBy(*key).orderBy("event_ts", "step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    view, cart, order = (F.col("step") == i for i in range(3))
    ways = (
        moves.withColumn("slice", part)
        .withColumns({"viewed": F.max(view).over(so_far), "carted": F.max(cart).over(so_far)})
        .withColumn("view_cart", F.max(cart & F.col("viewed")).over(so_far))
        .groupBy(*key)
        .agg(
            F.max(view).alias("view"), F.max(cart).alias("cart"), F.max(order).alias("order"),
            F.max("view_cart").alias("view_cart"), F.max(order & F.col("carted")).alias("cart_order"),
            F.max(order & F.col("view_cart")).alias("view_order"),
        )
    )

    def onward(reached: Column, way: Column) -> Column:
        longest = [[("view_order", 3), ("view_cart", 2), ("view", 1)], [("cart_order", 3), ("cart", 2)], [("order", 3)]]
        found = reached
        for start, ends in enumerate(longest):
            onto = F.lit(start)
            for name, end in reversed(ends):
                onto = F.when(way[name], end).otherwise(onto)
            found = F.when(reached == start, onto).otherwise(found)
        return found

    names = ("view", "cart", "order", "view_cart", "cart_order", "view_order")
    slices = ways.groupBy("window", "user_id").agg(F.array_sort(F.collect_list(F.struct("slice", *names))).alias("slices"))
    return slices.select("window", "user_id", F.aggregate("slices", F.lit(0), onward).alias("reached"))


def _steps_on_stream(moves: DataFrame) -> DataFrame:
    taken = moves.groupBy("window", "user_id").agg(F.array_sort(F.collect_list(F.struct("event_ts", "step"))).alias("steps"))
    # The next step in turn is always the number of steps reached so far.
    onward = lambda reached, move: F.when(move["step"] == reached, reached + 1).otherwise(reached)
    return taken.select("window", "user_id", F.aggregate("steps", F.lit(0), onward).alias("reached"))


def anomaly_scores(metrics: DataFrame, history: str = "30 minutes", slice_length: str = "1 day") -> DataFrame:
    """z-score of every metric value against the mean and deviation of its series' recent history.

    The history is the given time before the window, itself excluded. A series is
    cut into slices of time; a row near the end of a slice is also sent to the next
    one as history only, so slices are independent and a long series is not one task.
    """
    seconds = F.unix_seconds("window_start")
    reach = seconds_of(history)
    length = seconds_of(slice_length)
    if reach > length:
        raise ValueError("history must not be longer than slice_length")
    own = F.floor(seconds / length)
    later = F.floor((seconds + reach) / length)
    placed = metrics.withColumn("slice", F.explode(F.array_distinct(F.array(own, later))))
    recent = (
        Window.partitionBy(*SERIES, "slice").orderBy(F.unix_seconds("window_start")).rangeBetween(-reach, -1)
    )
    scored = placed.withColumns(
        {
            "n_history": F.count("metric_value").over(recent),
            "mean": F.avg("metric_value").over(recent),
            "deviation": F.stddev_samp("metric_value").over(recent),
        }
    ).filter(F.col("slice") == own)
    spread = F.when(F.col("deviation") > LEAST_DEVIATION * F.abs("mean"), F.col("deviation"))
    return scored.drop("slice").withColumn("z_score", (F.col("metric_value") - F.col("mean")) / spread)


def seconds_of(interval: str) -> int:
    """Length of an interval of fixed size such as '30 minutes'."""
    amount, unit = interval.split()
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(amount) * units[unit.rstrip("s")]


def thresholds(spark: SparkSession, rules: Iterable[tuple[str, float | None, float | None, str]]) -> DataFrame:
    """Alert rules (metric_name, low, high, severity) as a table; either bound may be None."""
    return spark.createDataFrame(list(rules), "metric_name string, low double, high double, severity string")


def alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Metric rows outside the bounds of a rule.

    ``rules`` is a table like that of `thresholds`; how it is joined follows from its size.
    """
    breach = F.when(F.col("metric_value") < F.col("low"), "below").when(
        F.col("metric_value") > F.col("high"), "above"
    )
    return (
        metrics.join(rules, "metric_name")
        .withColumn("breach", breach)
        .filter(F.col("breach").isNotNull())
    )


def alert_episodes(breaches: DataFrame, gap: str = "90 seconds") -> DataFrame:
    """Runs of breaching windows as one row each: opened, closed, how many windows, the worst value.

    ``breaches`` are rows of `alerts`, in a batch or, with a watermark on ``window_start``, on a stream. A breach at most
    ``gap`` after the last one of its series, rule and direction goes on with the episode; the default joins neighbouring
    minutes only, a longer one also forgives windows in between. On a stream an episode comes out
    when the watermark has passed its last breach by the gap. Only breaches are shuffled and sorted, not the metric table.
    """
    span = F.session_window("window_start", gap).alias("span")
    episodes = breaches.groupBy(span, *SERIES, "severity", "breach").agg(
        F.min("window_start").alias("opened"), F.max("window_end").alias("closed"), F.count(F.lit(1)).alias("n_windows"),
        F.min("metric_value").alias("lowest"), F.max("metric_value").alias("highest"),
    )
    worst = F.when(F.col("breach") == "below", F.col("lowest")).otherwise(F.col("highest"))
    return episodes.select(*SERIES, "severity", "breach", "opened", "closed", "n_windows", worst.alias("worst_value"))
