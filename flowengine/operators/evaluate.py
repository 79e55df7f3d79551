"""How well a window design finds known attacks.

Events are numbered in arrival order: `events(i, ip, port)`. Attacks follow
`schema.ATTACK_SCHEMA`; alerts are `(idx, ip)`, with idx the last event of the window.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowengine.operators.windows import all_windows, fits_in_a_stretch, pane_of

EVENTS_PER_SECOND = 10.0

TUMBLING, SLIDING = "TUMBLING", "SLIDING"

# The mean latency of a design that raised no alert.
NO_ALERT_SECONDS = {TUMBLING: 10.0, SLIDING: 5.0}

# Event numbers one group of an address's timeline may span, and stretches a group of totals.
STRETCH_EVENTS = 1 << 16
SPAN_STRETCHES = 1 << 12


def label_events(events: DataFrame, attacks: DataFrame, block_bits: int = 8) -> DataFrame:
    """Each event with the first attack in list order whose interval holds it.

    An interval is cut into aligned pieces whose lengths are powers of two: at most two of each
    length, so their number grows with the logarithm of the interval's. Attacks with the same
    piece are merged into the first of them. Blocks of 2^`block_bits` events look up the larger
    pieces above them and gather the smaller ones within; an event then joins one block's row.
    """
    block = F.shiftright("i", block_bits)
    owner = F.min(F.struct("attack_no", "type")).alias("owner")
    pieces = _aligned_pieces(attacks).groupBy("level", "piece").agg(owner)
    small = pieces.filter(F.col("level") < block_bits).select(
        F.expr(f"shiftright(piece, {block_bits} - level)").alias("block"),
        F.expr("shiftleft(piece, level)").alias("lo"),
        F.expr("shiftleft(piece + 1, level)").alias("hi"),
        "owner",
    )
    highest = pieces.select(F.max("level")).scalar()
    levels = F.sequence(F.lit(block_bits), F.greatest(highest, F.lit(block_bits)))
    above = (
        events.select(block.alias("block")).distinct()
        .select("block", F.explode(levels).alias("level"))
        .withColumn("piece", F.expr(f"shiftright(block, level - {block_bits})"))
        .join(pieces, ["level", "piece"])
        .groupBy("block")
        .agg(F.min("owner").alias("owner"))
        .select(
            "block",
            F.shiftleft("block", block_bits).alias("lo"),
            F.shiftleft(F.col("block") + 1, block_bits).alias("hi"),
            "owner",
        )
    )
    # merged pieces within a block are fewer than twice its events
    blocks = (
        small.unionByName(above).groupBy(F.col("block").alias("its_block"))
        .agg(F.collect_list(F.struct("lo", "hi", "owner")).alias("pieces"))
    )
    holding = F.filter(
        "pieces", lambda p: (p["lo"] <= F.col("i")) & (F.col("i") < p["hi"])
    )
    owned = F.array_min(F.transform(holding, lambda p: p["owner"]))
    return (
        events.withColumn("its_block", block)
        .join(blocks, "its_block", "left")
        .withColumn("owner", owned)
        .select(
            *events.columns,
            F.col("owner.attack_no").alias("attack_no"),
            F.col("owner.type").alias("attack_type"),
            F.col("owner").isNotNull().alias("is_anomaly"),
        )
    )


def _aligned_pieces(attacks: DataFrame) -> DataFrame:
    """(attack_no, type, level, piece): piece p of a level covers the events from p * 2^level to
    (p + 1) * 2^level. On each level the interval has a piece of its own on the left if its first
    whole piece there is odd, and on the right if the one behind its last is."""
    end = F.col("start_idx") + F.col("duration")
    top = F.floor(F.log2(F.col("duration"))).cast("int") + 1
    by_level = attacks.filter("duration > 0").select(
        "attack_no", "type", "start_idx", end.alias("end_idx"),
        F.explode(F.sequence(F.lit(0), top)).alias("level"),
    )
    ranged = by_level.select(
        "attack_no", "type", "level",
        F.expr("-shiftright(-start_idx, level)").alias("first"),
        F.expr("shiftright(end_idx, level)").alias("behind"),
    ).filter("first < behind")
    odd = F.array(
        F.when(F.col("first") % 2 != 0, F.col("first")),
        F.when(F.col("behind") % 2 != 0, F.col("behind") - 1),
    )
    return ranged.select(
        "attack_no", "type", "level", F.explode(F.array_compact(odd)).alias("piece")
    )


def tumbling_count_alerts(
    events: DataFrame, size: int = 100, min_events: int = 25, n_events: int | None = None
) -> DataFrame:
    """Sources with at least `min_events` events in a bucket of `size` events.

    A bucket the sequence ends in is never evaluated.
    """
    counted = events.groupBy(
        (pane_of(F.col("i"), size) + size).alias("window_end"), F.col("ip")
    ).agg(F.count("*").alias("events"), F.max("i").alias("last"))
    hits = counted.filter(F.col("events") >= min_events)
    last = events.select(F.max("i")).scalar()
    return _closed(hits, last, n_events).select("idx", "ip", "events")


def sliding_count_alerts(
    events: DataFrame,
    size: int = 300,
    slide: int = 50,
    min_ports: int = 15,
    min_events: int = 40,
    n_events: int | None = None,
) -> DataFrame:
    """Every `slide` events over the last `size`, sources with at least `min_ports`
    distinct ports or `min_events` events, and both figures. Same window counts as the time
    windows', in one pass."""
    if size % slide:
        raise ValueError("size must be a multiple of slide")
    hits, last = all_windows(_numbered(events), None, size, slide, None, min_ports, min_events)
    return _closed(_named(hits), last, n_events).select("idx", "ip", "events", "ports")


def count_alerts(
    events: DataFrame,
    bucket: int = 100,
    min_bucket: int = 25,
    size: int = 300,
    slide: int = 50,
    min_ports: int = 15,
    min_events: int = 40,
    n_events: int | None = None,
) -> DataFrame:
    """T7 and T8 in one pass: (design, idx, ip, events, ports), with design `TUMBLING` or
    `SLIDING`; tumbling windows have no number of ports.

    Where 32 slides hold no whole number of buckets, each design has a pass of its own.
    """
    if not fits_in_a_stretch(bucket, size, slide):
        tumbling = tumbling_count_alerts(events, bucket, min_bucket, n_events)
        sliding = sliding_count_alerts(events, size, slide, min_ports, min_events, n_events)
        return _designs(tumbling.withColumn("ports", F.lit(None).cast("bigint")), sliding)
    hits, last = all_windows(
        _numbered(events), bucket, size, slide, min_bucket, min_ports, min_events
    )
    design = F.when(F.col("tumbling"), TUMBLING).otherwise(SLIDING).alias("design")
    return _closed(_named(hits, design), last, n_events).select(
        "design", "idx", "ip", "events", "ports"
    )


def _numbered(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("i").alias("position"), F.col("ip").alias("src_ip"), F.col("port").alias("dst_port")
    )


def _named(hits: DataFrame, *more: Column) -> DataFrame:
    return hits.select(
        *more, "window_end", F.col("src_ip").alias("ip"), F.col("rows").alias("events"),
        F.col("distinct_ports").alias("ports"), "last",
    )


def _designs(tumbling: DataFrame, sliding: DataFrame) -> DataFrame:
    return tumbling.withColumn("design", F.lit(TUMBLING)).unionByName(
        sliding.withColumn("design", F.lit(SLIDING))
    )


def _closed(hits: DataFrame, last: Column, n_events: int | None) -> DataFrame:
    """Windows that end by the last event, of windows with any `last` position near them; that
    one decides nothing, but has the hits share their shuffle with the last event of all."""
    closed = F.col("idx") <= (
        F.lit(n_events - 1) if n_events is not None else F.greatest(last, F.col("last"))
    )
    return hits.withColumn("idx", F.col("window_end") - 1).filter(closed)


def match_alerts(alerts: DataFrame, attacks: DataFrame) -> DataFrame:
    """Per (ip, idx), the alerts, the attacks by that ip begun by then, and the sum
    of their latencies in events. No pair of alert and attack is ever formed."""
    return (
        _timeline(alerts.withColumn("design", F.lit("")), attacks, [""])
        .filter("is_alert")
        .select("ip", F.col("pos").alias("idx"), "alerts", "attacks", "latency_sum")
    )


def attack_detection(
    alerts: DataFrame, attacks: DataFrame, events_per_second: float = EVENTS_PER_SECOND
) -> DataFrame:
    """Per attack, whether and after how many seconds its first alert came."""
    first = (
        _timeline(alerts.withColumn("design", F.lit("")), attacks, [""])
        .filter("NOT is_alert")
        .select(F.col("ip").alias("start_ip"), F.col("pos").alias("start_pos"), "first_latency")
    )
    same_start = F.col("ip").eqNullSafe(F.col("start_ip")) & (F.col("start_idx") == F.col("start_pos"))
    return attacks.join(first, same_start).select(
        "attack_no",
        "type",
        "ip",
        F.col("first_latency").isNotNull().alias("detected"),
        (F.col("first_latency") / events_per_second).alias("first_alert_s"),
    )


def _timeline(alerts: DataFrame, attacks: DataFrame, designs: list[str]) -> DataFrame:
    """Per design, address and position, the number of alerts or of attack starts, in order.

    Alerts carry the number of attacks begun and their latencies' sum, starts the events
    until the first alert at or after them. All designs are on one timeline, each with the
    attack starts that are counted once. Running values are taken within stretches of the
    position axis and continued from totals per stretch, and these in the same way within
    longer stretches of stretches; so an address alerting all the time is spread over many
    groups, none of which grows with the length of the axis.
    """
    starts = _counted(attacks, ["ip"], "start_idx", "starts", False).withColumn(
        "design", F.explode(F.array(*map(F.lit, designs)))
    )
    rows = (
        _counted(alerts, ["design", "ip"], "idx", "alerts", True)
        .unionByName(starts, allowMissingColumns=True)
        .withColumn("stretch", pane_of(F.col("pos"), STRETCH_EVENTS))
        .withColumn("start_sum", F.col("starts") * F.col("pos"))
        .withColumn("alert_pos", F.when(F.col("is_alert"), F.col("pos")))
    )
    through = (Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy("design", "ip", "stretch").agg(
        F.sum("starts").alias("n"), F.sum("start_sum").alias("s"), F.min("alert_pos").alias("a")
    )
    # at one position attacks start before alerts are raised; running backwards as well
    # keeps every frame growing at one end, one step per row
    local = Window.partitionBy("design", "ip", "stretch")
    past = local.orderBy("pos", "is_alert").rowsBetween(*through)
    future = local.orderBy(F.desc("pos"), F.desc("is_alert")).rowsBetween(*through)
    return (
        rows.withColumns(
            {
                "local_n": F.coalesce(F.sum("starts").over(past), F.lit(0)),
                "local_s": F.coalesce(F.sum("start_sum").over(past), F.lit(0)),
                "local_a": F.min("alert_pos").over(future),
            }
        )
        .join(_named_total(_carried(totals)), _same_total("stretch"))
        .withColumn("attacks", F.col("earlier_n") + F.col("local_n"))
        .withColumn(
            "latency_sum",
            F.col("pos") * F.col("attacks") - F.col("earlier_s") - F.col("local_s"),
        )
        .withColumn(
            "first_latency",
            F.when(~F.col("is_alert"), F.coalesce("local_a", "later_a") - F.col("pos")),
        )
    )


def _carried(totals: DataFrame) -> DataFrame:
    """What stretches before and behind each one hold, of totals (design, ip, stretch, n, s, a):
    first within a span of `SPAN_STRETCHES`, then over the spans' own totals."""
    spans = totals.withColumn("span", pane_of(F.col("stretch"), STRETCH_EVENTS * SPAN_STRETCHES))
    of_spans = spans.groupBy("design", "ip", "span").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("a").alias("a")
    )
    outer = _beside(of_spans, ["design", "ip"], "span").select(
        F.col("design").alias("total_design"), F.col("ip").alias("total_ip"),
        F.col("span").alias("total_span"), F.col("earlier_n").alias("outer_n"),
        F.col("earlier_s").alias("outer_s"), F.col("later_a").alias("outer_a"),
    )
    return (
        _beside(spans, ["design", "ip", "span"], "stretch")
        .join(outer, _same_total("span"))
        .select(
            "design", "ip", "stretch", (F.col("earlier_n") + F.col("outer_n")).alias("earlier_n"),
            (F.col("earlier_s") + F.col("outer_s")).alias("earlier_s"),
            F.coalesce("later_a", "outer_a").alias("later_a"),
        )
    )


def _beside(totals: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Running totals of the rows before each one of its group, and the first `a` behind it."""
    before = (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(*before)
    later = Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(*before)
    return totals.select(
        "design", "ip", order, *[k for k in keys if k not in ("design", "ip")],
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier_n"),
        F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("earlier_s"),
        F.min("a").over(later).alias("later_a"),
    )


def _named_total(carried: DataFrame) -> DataFrame:
    keys = ("design", "ip", "stretch")
    return carried.withColumnsRenamed({k: f"total_{k}" for k in keys})


def _same_total(unit: str) -> Column:
    # null-safe, so that no filter for one side only keeps Spark from sharing the shuffles
    keys = ("design", "ip", unit)
    return reduce(and_, (F.col(k).eqNullSafe(F.col(f"total_{k}")) for k in keys))


def _counted(
    rows: DataFrame, keys: list[str], position: str, name: str, is_alert: bool
) -> DataFrame:
    return (
        rows.groupBy(*keys, F.col(position).alias("pos"))
        .agg(F.count("*").alias(name))
        .withColumn("is_alert", F.lit(is_alert))
    )


def detection_quality(
    alerts: DataFrame,
    attacks: DataFrame,
    design: str,
    no_alert_latency: float,
    events_per_second: float = EVENTS_PER_SECOND,
) -> DataFrame:
    """One row of figures for a window design, all of them computed.

    `mean_latency_s` is over every alert of an attacker after the attack's start, the
    repeats included (`no_alert_latency` without any); `mean_first_alert_s` only over
    each attack's first. Recall is per attack, precision per alert.
    """
    named = alerts.select(F.lit(design).alias("design"), "idx", "ip")
    return _figures(named, attacks, {design: no_alert_latency}, events_per_second)


def _figures(
    alerts: DataFrame,
    attacks: DataFrame,
    no_alert_latency: dict[str, float],
    events_per_second: float,
) -> DataFrame:
    """The row of each design, with the mean latency of a design that raised no alert."""
    alerts_here, starts_here = F.col("alerts"), F.col("starts")
    matched = F.when(F.col("attacks") > 0, alerts_here)
    detected = F.when(F.col("first_latency").isNotNull(), starts_here)
    mean_latency = F.try_divide(
        F.sum(alerts_here * F.col("latency_sum")), F.sum(alerts_here * F.col("attacks"))
    )
    mean_first = F.try_divide(F.sum(starts_here * F.col("first_latency")), F.sum(detected))
    figures = _timeline(alerts, attacks, list(no_alert_latency)).groupBy("design").agg(
        F.sum(alerts_here).alias("alerts"),
        F.sum(matched).alias("matched_alerts"),
        (mean_latency / events_per_second).alias("mean_latency_s"),
        (mean_first / events_per_second).alias("mean_first_alert_s"),
        F.sum(starts_here).alias("attacks"),
        F.sum(detected).alias("detected_attacks"),
    )
    # a design without alerts and attacks has no row on the timeline
    named = F.array(*[
        F.struct(F.lit(design).alias("its_design"), F.lit(default).alias("default"))
        for design, default in no_alert_latency.items()
    ])
    designs = alerts.sparkSession.range(1).select(F.inline(named))
    counts = ("alerts", "matched_alerts", "attacks", "detected_attacks")
    whole = designs.join(figures, F.col("design") == F.col("its_design"), "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in counts}
    )
    return whole.select(
        F.col("its_design").alias("design"), "alerts", "matched_alerts",
        F.coalesce("mean_latency_s", "default").alias("mean_latency_s"), "mean_first_alert_s",
        "attacks", "detected_attacks",
        F.try_divide("detected_attacks", "attacks").alias("recall"),
        F.try_divide("matched_alerts", "alerts").alias("precision"),
    )


def compare_windows(
    tumbling: DataFrame,
    sliding: DataFrame,
    attacks: DataFrame,
    events_per_second: float = EVENTS_PER_SECOND,
) -> DataFrame:
    """Both designs' figures side by side, of alerts that are there already."""
    columns = ("idx", "ip")
    return compare_designs(
        _designs(tumbling.select(*columns), sliding.select(*columns)), attacks, events_per_second
    )


def compare_designs(
    alerts: DataFrame, attacks: DataFrame, events_per_second: float = EVENTS_PER_SECOND
) -> DataFrame:
    """T11 of `count_alerts`: both designs on one timeline, from one pass over the events."""
    return _figures(alerts, attacks, NO_ALERT_SECONDS, events_per_second)
