"""Window metrics per source address.

Windows are event-time, epoch-aligned and half-open: a row exactly at a window's end
belongs to the next window.

Sliding windows come in three formulations with equal results. `window()` copies what it
is given into each window holding it: panes of rows, on streams. Panes, on batch frames,
reduce the rows to one per (slide-long pane, source, port) and copy only those; they give
every metric of every window. Stretches serve rules with a threshold: one row per source
and stretch of time holds the counts of all windows ending there, side by side, and only
the windows reaching the threshold ever become rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowengine import schema
from flowengine.functions.scalars import is_auth_port, source_or_unknown

# Windows that a stretch keeps side by side, at most: a mask then fits into 63 bits.
SIDE_BY_SIDE = 32

# Ports of a block, as a power of two: a number has a bit for each. Blocks kept side by side by a
# window, as a power of two.
PORT_BITS, BLOCK_BITS = 6, 2

# Panes a group of `windows_from_panes` may span: 1024 slides of 5 s are 85 minutes.
STRETCH_PANES = 1024


def flood_windows(flows: DataFrame, size: int = schema.FLOOD_SECONDS) -> DataFrame:
    """Requests and bytes per source and tumbling window of `size` seconds.

    On a stream the caller sets the watermark. Partial aggregation reduces a flooding
    source to one row per task before the shuffle.
    """
    return (
        flows.groupBy(F.window("event_ts", f"{size} seconds"), source_or_unknown().alias("src_ip"))
        .agg(
            F.count("*").alias("request_count"),
            F.sum(F.coalesce(F.col("byte_count"), F.lit(0))).alias("byte_total"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "src_ip",
            "request_count",
            "byte_total",
        )
    )


def sliding_windows(
    flows: DataFrame,
    size: int = schema.SLIDING_SECONDS,
    slide: int = schema.SLIDE_SECONDS,
    auth_ports: Iterable[int] = schema.AUTH_PORTS,
) -> DataFrame:
    """Requests, distinct ports and auth attempts of every source and window.

    From panes where that is possible, else through `window()`.
    """
    if not flows.isStreaming and size % slide == 0:
        panes = port_panes(flows, slide)
        return as_instants(windows_from_panes(panes, size, slide, auth_ports), size)
    return sliding_windows_by_row(flows, size, slide, auth_ports)


def sliding_windows_by_row(
    flows: DataFrame,
    size: int = schema.SLIDING_SECONDS,
    slide: int = schema.SLIDE_SECONDS,
    auth_ports: Iterable[int] = schema.AUTH_PORTS,
) -> DataFrame:
    """The same through `window()`: for streams, and for sizes the slide does not divide.

    Three chained aggregations: per block of ports and pane, the longest stretch of time that is in
    a window as a whole; per four blocks and window, of closed panes only; and per source. Which
    ports of a block were seen are the bits of a number. No task ever holds a source's port set:
    state and shuffle rows are plain numbers, a scanning source spreads over the cluster by blocks
    of ports, and what is copied into each window is a block's pane.
    """
    panes = _panes(
        flows, size, slide, source_or_unknown().alias("src_ip"),
        F.shiftright("dst_port", PORT_BITS).alias("block"),
        ports=F.bit_or(F.expr(f"shiftleft(1L, int(dst_port & {(1 << PORT_BITS) - 1}))")),
        attempts=F.count(F.when(is_auth_port(auth_ports), 1)),
    )
    blocks = F.shiftright("block", BLOCK_BITS)
    seen = [f"ports_{k}" for k in range(1 << BLOCK_BITS)]
    per_blocks = _together(panes, size, slide, blocks).groupBy(
        _window_of_panes(size, slide), "src_ip", blocks.alias("blocks")
    ).agg(
        F.sum("flows").alias("flows"), F.sum("attempts").alias("attempts"),
        *[
            F.bit_or(F.expr(f"CASE WHEN block & {len(seen) - 1} = {k} THEN ports END")).alias(c)
            for k, c in enumerate(seen)
        ],
    )
    distinct = reduce(add, [F.coalesce(F.bit_count(c), F.lit(0)) for c in seen])
    return (
        per_blocks.groupBy("window", "src_ip")
        .agg(
            F.sum("flows").alias("request_count"),
            F.sum(distinct).alias("distinct_ports"),
            F.sum("attempts").alias("auth_attempts"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "src_ip",
            "request_count",
            "distinct_ports",
            "auth_attempts",
        )
    )


def _panes(flows: DataFrame, size: int, slide: int, *keys: Column, **sums: Column) -> DataFrame:
    """Rows per key and pane, and further sums; a pane's event time is its last instant."""
    pane = F.window("event_ts", f"{math.gcd(size, slide)} seconds")
    counted = flows.groupBy(pane, *keys).agg(
        F.count("*").alias("flows"), *[of.alias(name) for name, of in sums.items()]
    )
    return counted.withColumn("pane_ts", F.window_time("window")).drop("window")


def _together(panes: DataFrame, size: int, slide: int, blocks: Column) -> DataFrame:
    """Panes with what shares their windows, so that copies are summed before the next shuffle and
    a task holds windows, not copies. Long times are dealt apart; windows over their borders
    are summed after the shuffle, like all. On a stream, where closed panes are few at a time, a
    further shuffle takes longer than it saves."""
    if panes.isStreaming:
        return panes
    seconds = F.unix_seconds("pane_ts")
    stretch = pane_of(seconds, math.gcd(size, slide) * STRETCH_PANES)
    return panes.repartition("src_ip", blocks, stretch)


def _window_of_panes(size: int, slide: int) -> Column:
    return F.window("pane_ts", f"{size} seconds", f"{slide} seconds")


def port_windows(
    flows: DataFrame,
    size: int = schema.SLIDING_SECONDS,
    slide: int = schema.SLIDE_SECONDS,
    threshold: int = schema.SCAN_THRESHOLD,
) -> DataFrame:
    """T3 alone: windows in which a source reached `threshold` distinct ports."""
    if flows.isStreaming or size % slide:
        windows = sliding_windows_by_row(flows, size, slide)
        return windows.filter(F.col("distinct_ports") >= threshold)
    windows = distinct_port_counts(positions(flows, "dst_port"), size, slide, threshold)
    return as_instants(windows, size)


def auth_windows(
    flows: DataFrame,
    size: int = schema.SLIDING_SECONDS,
    slide: int = schema.SLIDE_SECONDS,
    threshold: int = schema.BRUTE_FORCE_THRESHOLD,
    auth_ports: Iterable[int] = schema.AUTH_PORTS,
) -> DataFrame:
    """T4 alone: windows in which a source reached `threshold` flows to login ports.

    The port filter reaches the scan, and no port has to be shuffled.
    """
    attempts = flows.filter(is_auth_port(auth_ports))
    if flows.isStreaming or size % slide:
        panes = _panes(attempts, size, slide, source_or_unknown().alias("src_ip"))
        windows = (
            panes.groupBy(_window_of_panes(size, slide), "src_ip")
            .agg(F.sum("flows").alias("auth_attempts"))
            .filter(F.col("auth_attempts") >= threshold)
        )
        return windows.select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "src_ip",
            "auth_attempts",
        )
    windows = row_counts(positions(attempts), size, slide, threshold)
    return as_instants(windows.withColumnRenamed("rows", "auth_attempts"), size)


def positions(flows: DataFrame, *columns: str) -> DataFrame:
    """(position, src_ip, ...): the seconds of each row, and its source or `UNKNOWN`."""
    return flows.select(
        F.unix_seconds("event_ts").alias("position"), source_or_unknown().alias("src_ip"), *columns
    )


def distinct_port_counts(rows: DataFrame, size: int, slide: int, threshold: int) -> DataFrame:
    """Windows over (position, src_ip, dst_port) with at least `threshold` distinct ports.

    Per (source, port, stretch) the panes with such a row are a bit mask, an aggregate of
    eight bytes that combines before the shuffle; a window is a run of bits. Positions may
    be seconds or event numbers.
    """
    masks = (
        _in_stretches(rows.filter(F.col("dst_port").isNotNull()), size, slide, "dst_port")
        .groupBy("src_ip", "dst_port", "stretch")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    )
    run = (1 << _run(size, slide)) - 1
    return _windows_of_stretches(
        masks,
        lambda window: f"(mask & {run << window}L) != 0",
        size,
        slide,
        threshold,
        "distinct_ports",
    )


def row_counts(rows: DataFrame, size: int, slide: int, threshold: int) -> DataFrame:
    """Windows over (position, src_ip) with at least `threshold` rows."""
    run = _run(size, slide)
    return _windows_of_stretches(
        _in_stretches(rows, size, slide),
        lambda window: f"bit >= {window} AND bit < {window + run}",
        size,
        slide,
        threshold,
        "rows",
    )


def _stretch(size: int, slide: int) -> int:
    # two window lengths where they fit: rows near the end of a stretch, which belong to
    # the next as well, are then fewer than half, and the counts side by side still few
    return slide * min(2 * (size // slide), SIDE_BY_SIDE)


def _run(size: int, slide: int, stretch: int | None = None) -> int:
    # bits of a window: panes that all windows of a stretch hold share one bit
    return min(size // slide, (stretch or _stretch(size, slide)) // slide)


def _in_stretches(
    rows: DataFrame, size: int, slide: int, *columns: str, stretch: int | None = None
) -> DataFrame:
    """Rows with each stretch that has windows holding them, and their pane's bit there.

    A stretch has the windows whose last pane it contains. Bit 0 is the first pane of its
    first window, so window number n is a run of bits from n on. In windows longer than a
    stretch, the panes between the first window's start and its end that every other window
    holds too are one bit.
    """
    pane = F.col("pane")
    stretch = stretch or _stretch(size, slide)
    reach, run = size - slide, _run(size, slide, stretch)
    nth = F.expr(f"int((pane - stretch + {reach}) div {slide})")
    bit = F.greatest(F.least(nth, F.lit(run - 1)), nth - (size // slide - run))
    stretches = F.sequence(
        pane_of(pane, stretch), pane_of(pane + reach, stretch), F.lit(stretch).cast("bigint")
    )
    return (
        rows.filter(F.col("position").isNotNull())
        .select(pane_of(F.col("position"), slide).alias("pane"), "src_ip", *columns)
        .select("pane", "src_ip", *columns, F.explode(stretches).alias("stretch"))
        .select(
            "src_ip",
            *columns,
            "stretch",
            bit.alias("bit"),
        )
    )


def _windows_of_stretches(
    rows: DataFrame,
    held: Callable[[int], str],
    size: int,
    slide: int,
    threshold: int,
    name: str,
) -> DataFrame:
    """Count the rows held by each window of a stretch; keep windows at the threshold.

    Plain CASE and comparisons: count_if and BETWEEN are rewritten with common expressions,
    whose planning time multiplies with every further one in the same aggregate.
    """
    numbers = range(_stretch(size, slide) // slide)
    counts = rows.groupBy("src_ip", "stretch").agg(
        *[F.expr(f"count(CASE WHEN {held(n)} THEN 1 END) AS {name}_{n}") for n in numbers]
    )
    return _reached(counts, numbers, slide, {name: threshold})


def _reached(
    counts: DataFrame, numbers: range, slide: int, thresholds: dict[str, int]
) -> DataFrame:
    """Windows of stretches, with their side by side counts, that reach any of the thresholds."""
    most = " OR ".join(
        f"greatest({', '.join(f'{name}_{n}' for n in numbers)}) >= {least}"
        if len(numbers) > 1 else f"{name}_0 >= {least}"
        for name, least in thresholds.items()
    )
    windows = ", ".join(
        f"struct(stretch + {(n + 1) * slide} AS window_end, "
        + ", ".join(f"{name}_{n} AS {name}" for name in thresholds) + ")"
        for n in numbers
    )
    reached = " OR ".join(f"{name} >= {least}" for name, least in thresholds.items())
    return (
        counts.filter(F.expr(most))
        .select("src_ip", F.expr(f"inline(array({windows}))"))
        .filter(F.expr(reached))
        .select("window_end", "src_ip", *thresholds)
    )


def all_windows(
    rows: DataFrame,
    bucket: int | None,
    size: int,
    slide: int,
    min_bucket: int | None,
    min_ports: int,
    min_rows: int,
    counted_ports: Iterable[int] | None = None,
) -> tuple[DataFrame, Column]:
    """Tumbling windows of `bucket` (none without one) and sliding ones over (position, src_ip,
    dst_port), in one pass: those with at least `min_bucket` rows, and those with at least
    `min_ports` distinct ports or `min_rows` rows, of which only the ones to `counted_ports`
    count if given.

    Returns (tumbling, window_end, src_ip, distinct_ports, rows, last), where `last` is one of the
    positions in or before the window's stretch, and the last position of all.
    A port's rows are first summed per stretch: a mask of its panes, and its rows in each window;
    then a source's ports are. Stretches are whole buckets long, which is possible where
    `fits_in_a_stretch` says so. The last position comes from the sums, too, and so from the same
    shuffle.
    """
    if bucket is None:
        stretch, buckets = _stretch(size, slide), range(0)
    else:
        stretch = _common_stretch(bucket, size, slide)
        if stretch is None:
            raise ValueError(f"no stretch of {SIDE_BY_SIDE} slides or fewer holds whole buckets")
        buckets = range(stretch // bucket)
        rows = rows.withColumn("bucket", pane_of(F.col("position"), bucket))
    numbers, run = range(stretch // slide), _run(size, slide, stretch)
    carried = ["dst_port", "position", *(["bucket"] if bucket else [])]
    of_ports = (
        _in_stretches(rows, size, slide, *carried, stretch=stretch)
        .groupBy("src_ip", "dst_port", "stretch")
        .agg(
            F.max("position").alias("last"),
            F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"),
            *[
                F.expr(f"count(CASE WHEN bit >= {n} AND bit < {n + run} THEN 1 END) AS rows_{n}")
                for n in numbers
            ],
            # rows from before a stretch are in buckets before it
            *[
                F.expr(f"count(CASE WHEN bucket = stretch + {k * bucket} THEN 1 END) AS bucket_{k}")
                for k in buckets
            ],
        )
    )
    seen = "dst_port IS NOT NULL AND (mask & {mask}L) != 0"
    counts_port = F.lit(True) if counted_ports is None else is_auth_port(counted_ports)
    counts = of_ports.groupBy("src_ip", "stretch").agg(
        F.max("last").alias("last"),
        *[
            F.expr(f"count(CASE WHEN {seen.format(mask=((1 << run) - 1) << n)} THEN 1 END)")
            .alias(f"distinct_ports_{n}")
            for n in numbers
        ],
        *[
            F.sum(F.when(counts_port, F.col(f"rows_{n}")).otherwise(0)).alias(f"rows_{n}")
            for n in numbers
        ],
        *[F.sum(f"bucket_{k}").alias(f"bucket_{k}") for k in buckets],
    )
    # asked for with all sums, as the windows with their last position are, so that one shuffle
    # serves both
    everything = F.struct(F.col("last").alias("through"), *counts.columns)
    last = counts.select(F.max(everything)).scalar()["through"]
    least = {"bucket": (buckets, min_bucket), "distinct_ports": (numbers, min_ports),
             "rows": (numbers, min_rows)}
    most = " OR ".join(
        f"greatest(0, {', '.join(f'{name}_{n}' for n in those)}) >= {at_least}"
        for name, (those, at_least) in least.items() if those
    )
    found = [
        f"struct(true AS tumbling, stretch + {(k + 1) * bucket} AS window_end,"
        f" CAST(NULL AS bigint) AS distinct_ports, bucket_{k} AS rows)"
        for k in buckets
    ] + [
        f"struct(false AS tumbling, stretch + {(n + 1) * slide} AS window_end,"
        f" distinct_ports_{n} AS distinct_ports, rows_{n} AS rows)"
        for n in numbers
    ]
    reached = f"distinct_ports >= {min_ports} OR rows >= {min_rows}"
    if bucket:
        reached = f"CASE WHEN tumbling THEN rows >= {min_bucket} ELSE {reached} END"
    windows = (
        counts.filter(F.expr(most))
        .select("src_ip", "last", F.expr(f"inline(array({', '.join(found)}))"))
        .filter(F.expr(reached))
        .select("tumbling", "window_end", "src_ip", "distinct_ports", "rows", "last")
    )
    return windows, last


def fits_in_a_stretch(bucket: int, size: int, slide: int) -> bool:
    """Whether `all_windows` can serve tumbling windows of `bucket` next to these sliding ones."""
    return size % slide == 0 and _common_stretch(bucket, size, slide) is not None


def _common_stretch(bucket: int, size: int, slide: int) -> int | None:
    """About two window lengths, in whole buckets and slides; None if that is too many slides."""
    common = math.lcm(bucket, slide)
    if common // slide > SIDE_BY_SIDE:
        return None
    wanted = -(-_stretch(size, slide) // common) * common
    return min(wanted, slide * SIDE_BY_SIDE // common * common)


def pane_of(position: Column, slide: int) -> Column:
    """First position of the slide-long pane holding `position`."""
    return position - F.pmod(position, F.lit(slide))


def port_panes(flows: DataFrame, slide: int) -> DataFrame:
    """Rows per (pane, source, port)."""
    return (
        flows.filter(F.col("event_ts").isNotNull())
        .groupBy(
            pane_of(F.unix_seconds("event_ts"), slide).alias("pane"),
            source_or_unknown().alias("src_ip"),
            "dst_port",
        )
        .agg(F.count("*").alias("flows"))
    )


def windows_from_panes(
    panes: DataFrame,
    size: int,
    slide: int,
    auth_ports: Iterable[int] = schema.AUTH_PORTS,
) -> DataFrame:
    """Merge panes (pane, src_ip, dst_port, flows) into the windows that hold them.

    Positions may be seconds or event numbers. A port's pane is in the `size / slide`
    windows ending after it; those up to `previous pane + size` already know the port,
    so it is new to the later ones only and distinct ports become a plain sum.

    The previous pane is looked up within stretches of the position axis, so that even a
    source and port seen all the time never form one long group. A pane also goes, as
    context, to the next stretch if that starts less than a window later; a previous
    pane farther back has no window in common with this one.
    """
    stretch = slide * max(STRETCH_PANES, size // slide)
    pane, own = F.col("pane"), pane_of(F.col("pane"), stretch)
    stretches = F.sequence(own, pane_of(pane + size - slide, stretch), F.lit(stretch).cast("bigint"))
    history = Window.partitionBy("src_ip", "dst_port", "stretch").orderBy("pane")
    known_until = F.coalesce(F.lag("pane").over(history) + size, pane)
    in_windows = (
        panes.withColumn("stretch", F.explode(stretches))
        .withColumn("known_until", known_until)
        .filter(F.col("stretch") == own)
        .select(
            _window_ends(size, slide).alias("window_end"), "src_ip", "dst_port", "flows", "known_until"
        )
    )
    new_port = F.col("dst_port").isNotNull() & (F.col("window_end") > F.col("known_until"))
    return in_windows.groupBy("window_end", "src_ip").agg(
        F.sum("flows").alias("request_count"),
        F.count_if(new_port).alias("distinct_ports"),
        F.sum(F.when(is_auth_port(auth_ports), F.col("flows")).otherwise(0)).alias("auth_attempts"),
    )


def _window_ends(size: int, slide: int) -> Column:
    pane = F.col("pane")
    return F.explode(F.sequence(pane + slide, pane + size, F.lit(slide).cast("bigint")))


def as_instants(windows: DataFrame, size: int) -> DataFrame:
    """Window ends in epoch seconds as `window_start` and `window_end` timestamps."""
    metrics = [c for c in windows.columns if c != "window_end"]
    return windows.select(
        F.timestamp_seconds(F.col("window_end") - size).alias("window_start"),
        F.timestamp_seconds("window_end").alias("window_end"),
        *metrics,
    )
