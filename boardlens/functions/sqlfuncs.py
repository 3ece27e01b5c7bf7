"""Geometry callable from SQL text, as SQL functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from boardlens.functions.geometry import tier_labels

_BOX = "STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>"
_POLY = "ARRAY<STRUCT<x: INT, y: INT>>"

_BODIES = {
    f"box_iou(a {_BOX}, b {_BOX}) RETURNS FLOAT": """
        CASE WHEN least(a.x2, b.x2) > greatest(a.x1, b.x1) AND least(a.y2, b.y2) > greatest(a.y1, b.y1)
        THEN CAST(
          (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1))
          / nullif((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1)
            - (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)), 0)
          AS FLOAT)
        ELSE CAST(0 AS FLOAT) END""",
    f"axial_gap(a {_BOX}, b {_BOX}) RETURNS DOUBLE": """
        sqrt(power(greatest(0, greatest(a.x1, b.x1) - least(a.x2, b.x2)), 2)
           + power(greatest(0, greatest(a.y1, b.y1) - least(a.y2, b.y2)), 2))""",
    f"is_near(a {_BOX}, b {_BOX}, min_px DOUBLE, rel DOUBLE) RETURNS BOOLEAN": """
        axial_gap(a, b) <= greatest(min_px, rel * least(a.x2 - a.x1, a.y2 - a.y1, b.x2 - b.x1, b.y2 - b.y1))""",
    f"polygon_bbox(p {_POLY}) RETURNS STRUCT<x1: INT, y1: INT, x2: INT, y2: INT>": """
        named_struct('x1', array_min(transform(p, v -> v.x)), 'y1', array_min(transform(p, v -> v.y)),
                     'x2', array_max(transform(p, v -> v.x)), 'y2', array_max(transform(p, v -> v.y)))""",
    f"polygon_area(p {_POLY}) RETURNS DOUBLE": """
        CASE WHEN size(p) < 3 THEN 0D ELSE abs(aggregate(
          transform(p, (v, i) -> CAST(v.x AS DOUBLE) * p[(i + 1) % size(p)].y - CAST(p[(i + 1) % size(p)].x AS DOUBLE) * v.y),
          0D, (acc, v) -> acc + v)) / 2 END""",
}


def register_sql(spark: SparkSession, tiers: dict[str, list[float]] | None = None) -> list[str]:
    """Create the temporary SQL functions. ``tiers`` adds one ``tier_<name>(value)`` per cut list."""
    for head, body in _BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    names = [head.split("(", 1)[0] for head in _BODIES]
    for name, cuts in (tiers or {}).items():
        labels = tier_labels(cuts)
        whens = " ".join(f"WHEN v <= {c!r} THEN '{label}'" for c, label in zip(map(float, cuts), labels))
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION tier_{name}(v DOUBLE) RETURNS STRING "
            f"RETURN CASE {whens} ELSE '{labels[-1]}' END"
        )
        names.append(f"tier_{name}")
    return names
