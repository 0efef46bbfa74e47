"""The KPI registry: every KPI has one definition, used by every report, snapshot and stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidscope.functions.measures import PythonMeasure


def sql_number(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"CAST('{value!r}' AS DOUBLE)"


@dataclass(frozen=True)
class KPI:
    """A KPI and its aggregate, as a Spark SQL expression, a Column or a ``PythonMeasure``.

    ``inputs`` are the columns the measure reads. Where one is missing the KPI has ``fallback``
    as its value. A KPI of one's own is another instance passed to the reports.
    """

    name: str
    measure: str | Column | PythonMeasure
    unit: str
    category: str
    description: str
    inputs: tuple[str, ...]
    target: float | None = None
    alert_threshold: float | None = None
    higher_is_better: bool = True
    fallback: float | None = None

    def in_python(self, columns: Sequence[str]) -> bool:
        """Whether the KPI needs ``operators.python_aggregate`` over a frame with the given columns."""
        return isinstance(self.measure, PythonMeasure) and set(self.inputs) <= set(columns)

    def value(self, columns: Sequence[str]) -> Column:
        """The KPI as an aggregate over a frame with the given columns."""
        if self.in_python(columns):
            raise TypeError(f"{self.name} is computed in Python and has no Column.")
        measure = self.measure if set(self.inputs) <= set(columns) else sql_number(self.fallback)
        measure = F.expr(measure) if isinstance(measure, str) else measure
        return measure.cast("double").alias(self.name)


# Names, units, targets and thresholds of the eight KPIs.
REGISTRY: tuple[KPI, ...] = (
    KPI(
        name="fill_rate",
        measure="avg(filled)",
        inputs=("filled",),
        unit="ratio",
        category="delivery",
        target=0.85,
        alert_threshold=0.70,
        description="Share of auction requests that delivered an ad.",
    ),
    KPI(
        name="ecpm",
        measure="sum(revenue_usd) / nullif(count(*), 0) * 1000",
        inputs=("revenue_usd",),
        unit="USD",
        category="revenue",
        description="Revenue per thousand auction requests, unfilled ones included.",
    ),
    KPI(
        name="bid_spread",
        measure="avg(bid_spread)",
        inputs=("bid_spread",),
        unit="ratio",
        category="efficiency",
        target=0.08,
        alert_threshold=0.20,
        higher_is_better=False,
        description="Mean distance of the winning bid from the clearing price, relative to the bid.",
    ),
    KPI(
        name="ctr",
        measure="sum(clicked) / greatest(sum(filled), 1)",
        inputs=("clicked", "filled"),
        unit="ratio",
        category="quality",
        target=0.04,
        alert_threshold=0.01,
        description="Clicks per delivered ad.",
    ),
    KPI(
        name="cvr",
        measure="sum(converted) / greatest(sum(clicked), 1)",
        inputs=("converted", "clicked"),
        unit="ratio",
        category="quality",
        target=0.03,
        alert_threshold=0.005,
        description="Conversions per click.",
    ),
    KPI(
        name="auction_depth",
        measure="avg(auction_depth)",
        inputs=("auction_depth",),
        unit="count",
        category="efficiency",
        target=6.0,
        alert_threshold=3.0,
        description="Mean number of bidders per auction.",
    ),
    KPI(
        name="revenue_per_auction",
        measure="avg(revenue_usd)",
        inputs=("revenue_usd",),
        unit="USD",
        category="revenue",
        description="Mean clearing revenue per auction request.",
    ),
    KPI(
        name="below_floor_rate",
        measure="avg(cast(below_floor as int))",
        inputs=("below_floor",),
        fallback=0.0,
        unit="ratio",
        category="delivery",
        target=0.05,
        alert_threshold=0.15,
        higher_is_better=False,
        description="Share of bids under the bid floor.",
    ),
)

BY_NAME: dict[str, KPI] = {kpi.name: kpi for kpi in REGISTRY}

# Fixed value: the KPIs a dashboard shows as cards.
CORE_KPIS = ("fill_rate", "ecpm", "bid_spread", "ctr", "cvr", "auction_depth")


def pick_kpis(chosen: Sequence[str | KPI] | None) -> tuple[KPI, ...]:
    """KPIs by their registered name or as they are; all registered ones by default."""
    return REGISTRY if chosen is None else tuple(BY_NAME[k] if isinstance(k, str) else k for k in chosen)


def status_of(kpi: KPI, value: str) -> str:
    """``alert`` past the threshold, else on or below target, ``ok`` where neither is known.

    The value is compared at nine digits: a mean that equals its threshold must not pass it by the
    last bit of a sum taken in another order.
    """
    if kpi.alert_threshold is None:
        return "'ok'"
    value = f"round({value}, 9)"
    worse, reaches = ("<", ">=") if kpi.higher_is_better else (">", "<=")
    reached = (
        "'ok'"
        if kpi.target is None
        else f"CASE WHEN {value} {reaches} {sql_number(kpi.target)} THEN 'on_target' ELSE 'below_target' END"
    )
    return (
        f"CASE WHEN {value} IS NULL THEN 'ok' "
        f"WHEN {value} {worse} {sql_number(kpi.alert_threshold)} THEN 'alert' ELSE {reached} END"
    )
