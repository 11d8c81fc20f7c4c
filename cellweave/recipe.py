"""Recipes: nested dictionaries, checked and brought to one spelling before any plan is built."""

from __future__ import annotations

from dataclasses import dataclass, field

from cellweave.sources.readers import load_recipe

SEED_NAMES = ("random_seed", "random_state", "seed")
TOPOLOGY_NAMES = ("topology_config", "point_cloud_config")


@dataclass(frozen=True)
class Recipe:
    name: str
    base_dir: str
    spatial: dict
    temporal: dict = field(default_factory=dict)
    sources: dict = field(default_factory=dict)
    export_as: str = "parquet"
    aggregate: dict | None = None
    #: Whether provenance holds digests of all input files (it always holds their sizes).
    digests: bool = False


#: Whether a source whose block says nothing about it is on.
ENABLED_BY_DEFAULT = {"occurrences": True}


def topology(source: dict) -> dict:
    """How a source's points meet the grid: kind, mode, method, passes, distribution, seed, quad_segs."""
    raw: dict = {}
    for name in TOPOLOGY_NAMES:
        raw |= source.get(name) or {}
    seed = next((raw[n] for n in SEED_NAMES if n in raw), 42)
    mode = {"classification": "classify"}.get(raw.get("mode", "fractional"), raw.get("mode", "fractional"))
    return {"kind": source.get("output_type", raw.get("kind", "point")), "mode": mode, "method": raw.get("method", "intersect"), "passes": int(raw.get("n_passes", raw.get("passes", 30))), "distribution": raw.get("distribution", "uniform"), "seed": int(seed), "quad_segs": int(raw.get("quad_segs", 8))}


def parse(raw: dict) -> Recipe:
    """ValueError if the parts that every run needs are missing."""
    if missing := [k for k in ("base_dir", "spatial") if not raw.get(k)]:
        raise ValueError(f"the recipe lacks {', '.join(missing)}")
    return Recipe(raw.get("cube_name", "cube"), raw["base_dir"], raw["spatial"], raw.get("temporal") or {}, raw.get("sources") or {}, raw.get("export_as", "parquet"), raw.get("aggregate"), bool(raw.get("digests")))


def load(path: str) -> Recipe:
    return parse(load_recipe(path))


def enabled(recipe: Recipe) -> dict[str, dict]:
    """The sources that are on."""
    return {k: v or {} for k, v in recipe.sources.items() if (v or {}).get("enabled", ENABLED_BY_DEFAULT.get(k, False))}
