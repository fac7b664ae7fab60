"""Model queries."""

from __future__ import annotations

from catalog.base import Tables, query
from catalog.features import BOUNDS
from strata.operators import features, models

INPUTS = ["estrato", "banos", "habitaciones", "area_construida", "area_privada", "lat", "lon"]


@query("ml_compare")
def _(t: Tables):
    return models.compare(features.gold_features(t.view("v_listing"), **BOUNDS), "precio", INPUTS)


@query("ml_cv")
def _(t: Tables):
    return models.cross_validate(features.gold_features(t.view("v_listing"), **BOUNDS), "precio", INPUTS)
