"""Attributes of groups, levels and arrays, as plain mappings."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from gridloom.spec import DATASET_VERSION, FACTORS, GRID, NODATA, PROJ4, SOURCE_VERSION, DepthInterval, GridSpec, PropertySpec


def spatial_ref(grid: GridSpec = GRID) -> dict[str, object]:
    return {"grid_mapping_name": "interrupted_goode_homolosine", "proj4": PROJ4, "GeoTransform": grid.geotransform, "comment": "no EPSG code exists"}


def coordinates(grid: GridSpec = GRID) -> dict[str, dict[str, str]]:
    axis = lambda a, name: {"axis": a, "units": "m", "standard_name": f"projection_{name}_coordinate"}
    return {"x": axis("X", "x"), "y": axis("Y", "y")}


def property_attributes(spec: PropertySpec, factor: int = 1, extra: dict[str, object] | None = None) -> dict[str, object]:
    """Attributes of a property's array; the values are floats already, so no packing terms."""
    out: dict[str, object] = {
        "units": spec.units,
        "mapped_units": spec.mapped_units,
        "source_conversion_factor": spec.divisor,
        "source_nodata": NODATA,
        "source_run": spec.run,
        "transformation": spec.transformation,
        "source_version": SOURCE_VERSION,
        "dataset_version": DATASET_VERSION,
        "grid_mapping": "spatial_ref",
    }
    if factor > 1:
        out |= {"overview_factor": factor, "resampling": "mean", "derived_from": derived_from(factor)}
    return out | (extra or {})


def derived_from(factor: int, factors: tuple[int, ...] = FACTORS) -> str:
    before = [f for f in factors if f < factor]
    return f"{before[-1]}x" if before else "."


def geo_attributes(height: int, width: int, pixel: float, grid: GridSpec = GRID) -> dict[str, object]:
    """Shape, affine transform and bounding box; no code is given since there is none."""
    return {
        "spatial:shape": [height, width],
        "spatial:transform": [pixel, 0.0, grid.x_min, 0.0, -pixel, grid.y_max],
        "spatial:bbox": [grid.x_min, grid.y_max - height * pixel, grid.x_min + width * pixel, grid.y_max],
        "proj:proj4": PROJ4,
    }


def multiscales(factors: tuple[int, ...] = FACTORS) -> list[dict[str, object]]:
    """The levels from fine to coarse, each with its parent and its scale against it."""
    out: list[dict[str, object]] = [{"asset": ".", "factor": 1}]
    before = 1
    for f in factors:
        out.append({"asset": f"{f}x", "factor": f, "derived_from": "." if before == 1 else f"{before}x", "scale": f // before, "resampling_method": "mean"})
        before = f
    return out


def region_note(grid: GridSpec = GRID) -> dict[str, object]:
    return {"width": grid.width, "height": grid.height, "pixel_m": grid.pixel, "cells": grid.cell_rows * grid.cell_cols, "bbox": [grid.x_min, grid.y_min, grid.x_max, grid.y_max]}


def depth_table(spark: SparkSession, depths: tuple[DepthInterval, ...]) -> DataFrame:
    """The depth dimension: index, label and bounds in cm."""
    rows = [(i, d.label, d.token, d.top_cm, d.bottom_cm) for i, d in enumerate(depths)]
    return spark.createDataFrame(rows, "depth_idx smallint, depth_interval string, token string, depth_top_cm smallint, depth_bottom_cm smallint")


def scope_key(prop: str, factors: tuple[int, ...], cells: list[tuple[int, int]]) -> str:
    """A fingerprint of a piece of work: what it is resumed under."""
    scope = {"property": prop, "factors": list(factors), "cells": sorted([list(c) for c in cells])}
    return hashlib.sha256(json.dumps(scope, sort_keys=True).encode()).hexdigest()[:16]
