"""Queries leave no sample out."""

from __future__ import annotations

import numpy as np
import pytest

from gridlark.operators import thermal
from gridlark.plans import catalogue
from gridlark.schema import Body
from gridlark.sources.tables import samples_view

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, columns", [
    ("footprint_project", ["key", "line"]), ("flat_offsets", ["key", "line"]), ("multilinear_interp", ["key", "line"]), ("interp1d_time", ["orbit"]), ("regular_series", ["orbit"]),
])
def test_no_sample_is_left_out(spark, name, columns):
    want = {tuple(r) for r in samples_view(spark, SF).select(*columns).distinct().collect()}
    assert {tuple(r) for r in catalogue.QUERIES[name](spark, SF).select(*columns).distinct().collect()} == want


@pytest.mark.parametrize("name", ["layer_prefix_product", "brightness_temperature"])
def test_no_key_with_layers_is_left_out(spark, name):
    lines: dict[int, list[int]] = {}
    for x in samples_view(spark, SF).select("key", "line").collect():
        lines.setdefault(x["key"], []).append(x["line"])
    want = {k for k, v in lines.items() if len(v) >= 2 and len(v) == len(set(v))}
    assert {x["key"] for x in catalogue.QUERIES[name](spark, SF).select("key").distinct().collect()} == want


def test_heat_flow_runs_for_the_whole_equilibration_time(spark):
    got = catalogue.FORMS["heat1d_run"](spark, SF).where("lat = 60").toPandas()
    want = thermal.run_models(np.array([0.12]), np.array([60.0]), np.array([0.07]), Body(), thermal.Solver())[0]["temp"]
    means = got.groupby("layer")["temp"].mean().sort_index().to_numpy()
    assert len(means) == len(want)
    assert np.abs(means - want.mean(axis=1))[20:].max() < 0.5  # below the daily wave
