"""A dashboard: rows of panels, each evaluated and stored as a table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from pulsegrid.plans.panels import PANELS, Range, can_merge, evaluate, merged_tables, of_merged


@dataclass
class Dashboard:
    """Rows of panel ids under a title."""
    title: str
    rows: list[tuple[str, list[str]]] = field(default_factory=list)

    def panel_ids(self) -> list[str]:
        return [panel for _title, panels in self.rows for panel in panels]


def cluster_dashboard(name: str, brokers: int) -> Dashboard:
    return Dashboard(name, [
        ("TOPIC METRICS", ["Q01", "Q02", "Q03", "Q04"]),
        (f"CLUSTER METRICS FOR {brokers} broker(s)", ["Q05", "Q06", "Q07", "Q08", "Q09", "Q10", "Q11"]),
        ("BROKER METRICS", ["Q12", "Q13", "Q14", "Q15"]),
    ])


def evaluate_dashboard(df: DataFrame, dashboard: Dashboard, asked: Range,
                       width: int | None = None) -> dict[str, DataFrame]:
    """Every panel of a dashboard; ``width`` replaces the bucket widths of the panels."""
    return {panel: evaluate(df, panel, asked, width) for panel in dashboard.panel_ids()}


def bundle_dashboard(df: DataFrame, dashboard: Dashboard, asked: Range, path: str,
                     width: int | None = None) -> list[str]:
    """Store every panel of a dashboard under its id. Gives the paths, in panel order.

    All panels whose aggregates merge come from one read and one shuffle of the input; their buckets, a row per
    panel, series and bucket, are kept while each panel is finished and stored. Panels with last values or medians read
    the rows of their measurement.
    """
    ids = dashboard.panel_ids()
    merged = [p for p in ids if can_merge(p)]
    tables = merged_tables(df, merged, asked, width).persist() if merged else None
    try:
        for panel in ids:
            shown = of_merged(tables, panel, asked, width) if panel in merged else evaluate(df, panel, asked, width)
            shown.write.mode("overwrite").parquet(f"{path}/{panel}")
    finally:
        if tables is not None:
            tables.unpersist()
    return [f"{path}/{panel}" for panel in ids]
