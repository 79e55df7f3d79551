"""Attack rules: thresholds on window metrics, and the alerts they raise.

One alert per rule, source and window. Its timestamp and id come from the window's end,
not from the clock, so a replay gives identical rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from flowengine import schema
from flowengine.functions.scalars import alert_id, iso_text
from flowengine.operators import windows as W


@dataclass(frozen=True)
class Rule:
    """What is compared, and how the alert reads."""

    attack_type: str
    tag: str
    severity: str
    metric: str
    threshold: int
    window: str
    details: str  # with the metric and the window seconds


# Fixed values.
FLOOD = Rule(
    "DDoS_FLOOD", "DDoS", "HIGH", "request_count", schema.FLOOD_THRESHOLD, "TUMBLING",
    "Volumetric flood: %d requests in %ds tumbling window.",
)
PORT_SCAN = Rule(
    "PORT_SCAN", "SCAN", "MEDIUM", "distinct_ports", schema.SCAN_THRESHOLD, "SLIDING",
    "Stealth Port Scan: %d distinct ports probed in %ds sliding window.",
)
BRUTE_FORCE = Rule(
    "BRUTE_FORCE", "AUTH", "HIGH", "auth_attempts", schema.BRUTE_FORCE_THRESHOLD, "SLIDING",
    "Brute Force attack: %d auth attempts against administrative services in %ds.",
)


def raise_alerts(windows: DataFrame, rules: Iterable[Rule], size: int) -> DataFrame:
    """Alerts of all rules on the same windows, in one pass and on streams too.

    Windows below every threshold go first, so alert text is only built for the rest.
    """
    rules = list(rules)
    reached = windows.filter(reduce(or_, (F.col(r.metric) >= r.threshold for r in rules)))
    if len(rules) == 1:
        return reached.select(*_alert(rules[0], size))
    candidates = F.array(*[F.struct(*_alert(rule, size)) for rule in rules])
    raised = F.filter(candidates, lambda a: a["metric_count"] >= a["threshold"])
    return reached.select(F.inline(raised))


def flood_alerts(
    flows: DataFrame,
    size: int = schema.FLOOD_SECONDS,
    threshold: int = schema.FLOOD_THRESHOLD,
) -> DataFrame:
    """Sources sending at least `threshold` requests in a tumbling window."""
    return raise_alerts(W.flood_windows(flows, size), [replace(FLOOD, threshold=threshold)], size)


def port_scan_alerts(
    flows: DataFrame,
    size: int = schema.SLIDING_SECONDS,
    slide: int = schema.SLIDE_SECONDS,
    threshold: int = schema.SCAN_THRESHOLD,
) -> DataFrame:
    """Sources probing at least `threshold` distinct ports in a sliding window."""
    windows = W.port_windows(flows, size, slide, threshold)
    return raise_alerts(windows, [replace(PORT_SCAN, threshold=threshold)], size)


def brute_force_alerts(
    flows: DataFrame,
    size: int = schema.SLIDING_SECONDS,
    slide: int = schema.SLIDE_SECONDS,
    threshold: int = schema.BRUTE_FORCE_THRESHOLD,
    ports: Iterable[int] = schema.AUTH_PORTS,
) -> DataFrame:
    """T4: sources with at least `threshold` flows to login ports in a sliding window."""
    windows = W.auth_windows(flows, size, slide, threshold, ports)
    return raise_alerts(windows, [replace(BRUTE_FORCE, threshold=threshold)], size)


def sliding_alerts(
    flows: DataFrame,
    size: int = schema.SLIDING_SECONDS,
    slide: int = schema.SLIDE_SECONDS,
    scan_threshold: int = schema.SCAN_THRESHOLD,
    auth_threshold: int = schema.BRUTE_FORCE_THRESHOLD,
    ports: Iterable[int] = schema.AUTH_PORTS,
) -> DataFrame:
    """Both rules share the state of a stream, and on a batch one pass over the rows."""
    if not flows.isStreaming and size % slide == 0:
        return _in_one_pass(
            flows, None, None, size, slide, scan_threshold, auth_threshold, ports
        )
    windows = W.sliding_windows_by_row(flows, size, slide, ports)
    rules = [
        replace(PORT_SCAN, threshold=scan_threshold),
        replace(BRUTE_FORCE, threshold=auth_threshold),
    ]
    return raise_alerts(windows, rules, size)


def all_alerts(
    flows: DataFrame,
    flood_size: int = schema.FLOOD_SECONDS,
    flood_threshold: int = schema.FLOOD_THRESHOLD,
    size: int = schema.SLIDING_SECONDS,
    slide: int = schema.SLIDE_SECONDS,
    scan_threshold: int = schema.SCAN_THRESHOLD,
    auth_threshold: int = schema.BRUTE_FORCE_THRESHOLD,
    ports: Iterable[int] = schema.AUTH_PORTS,
) -> DataFrame:
    """The alerts of all three rules over a batch of flows, read once.

    Only where 32 slides or fewer hold no whole number of flood windows, those have a pass of
    their own.
    """
    if flows.isStreaming:
        raise ValueError("run flood_alerts and sliding_alerts as two streaming queries")
    if W.fits_in_a_stretch(flood_size, size, slide):
        return _in_one_pass(
            flows, flood_size, flood_threshold, size, slide, scan_threshold, auth_threshold, ports
        )
    floods = flood_alerts(flows, flood_size, flood_threshold)
    return floods.unionByName(
        sliding_alerts(flows, size, slide, scan_threshold, auth_threshold, ports)
    )


def _in_one_pass(
    flows: DataFrame, flood_size: int | None, flood_threshold: int | None, size: int, slide: int,
    scan_threshold: int, auth_threshold: int, ports: Iterable[int],
) -> DataFrame:
    """All rules on the windows of one pass; without a size of its windows no flood rule."""
    found, _ = W.all_windows(
        W.positions(flows, "dst_port"), flood_size, size, slide, flood_threshold, scan_threshold,
        auth_threshold, ports,
    )
    windows = found.withColumn("window_end", F.timestamp_seconds("window_end"))
    tumbling, metric = F.col("tumbling"), F.col("rows")
    scan = replace(PORT_SCAN, threshold=scan_threshold)
    login = replace(BRUTE_FORCE, threshold=auth_threshold)
    raised = [(~tumbling, F.col("distinct_ports"), scan, size), (~tumbling, metric, login, size)]
    if flood_size is not None:
        flood = replace(FLOOD, threshold=flood_threshold)
        raised.append((tumbling, metric, flood, flood_size))
    candidates = F.array(*[
        F.when(kind & (metric >= rule.threshold), F.struct(*_alert(rule, seconds, metric)))
        for kind, metric, rule, seconds in raised
    ])
    return windows.select(F.inline(F.array_compact(candidates)))


def _alert(rule: Rule, size: int, metric: Column | None = None) -> list[Column]:
    metric = F.col(rule.metric) if metric is None else metric
    end = F.col("window_end")
    return [
        alert_id(rule.tag, end, F.col("src_ip")).alias("alert_id"),
        iso_text(end).alias("timestamp"),
        F.col("src_ip"),
        F.lit(rule.attack_type).alias("attack_type"),
        metric.alias("metric_count"),
        F.lit(rule.threshold).alias("threshold"),
        F.lit(f"{rule.window}_{size}S").alias("window_type"),
        F.lit(rule.severity).alias("severity"),
        F.format_string(rule.details, metric, F.lit(size)).alias("details"),
    ]
