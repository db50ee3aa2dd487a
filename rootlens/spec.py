"""What a dataset consists of: its daily fact table, metrics and dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DimensionSpec:
    """One breakdown table; ``detail_col`` rolls up into ``segment_col``."""

    name: str
    table: str
    segment_col: str
    detail_col: str


@dataclass(frozen=True)
class DatasetSpec:
    """Dimension order matters: it breaks ties and picks the headline totals."""

    fact_table: str
    metrics: tuple[str, ...]
    dimensions: tuple[DimensionSpec, ...]
    # Metrics whose segment values may be summed; others are still computed
    # where a breakdown table carries them, but flagged.
    additive: frozenset[str] = field(default_factory=frozenset)

    def dimension(self, name: str) -> DimensionSpec:
        for dim in self.dimensions:
            if dim.name == name:
                return dim
        raise ValueError(f"Unknown dimension: {name}")

    def order_of(self, name: str) -> int:
        return [d.name for d in self.dimensions].index(name)


RETAIL = DatasetSpec(
    fact_table="fact_daily_metrics",
    metrics=("order_count", "customer_count", "total_revenue", "avg_order_value"),
    dimensions=(
        DimensionSpec("geography", "metric_by_geography", "region", "state_code"),
        DimensionSpec("product", "metric_by_product", "product_category_group", "product_category"),
        DimensionSpec("payment", "metric_by_payment", "payment_type_display", "payment_type"),
    ),
    additive=frozenset({"total_revenue", "order_count"}),
)

# Detection defaults.
DEFAULT_THRESHOLD = 2.0
DEFAULT_LOOKBACK = 30
