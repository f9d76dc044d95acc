"""All registered queries (name → callable(spark, sf_dir)) and their DuckDB oracle SQL."""

from __future__ import annotations

from odspark.registry import distance


def all_queries() -> dict:
    out = {}
    out.update(distance.QUERIES)
    for mod in _optional_modules():
        out.update(mod.QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    out.update(distance.ORACLE)
    for mod in _optional_modules():
        out.update(mod.ORACLE)
    return out


def _optional_modules():
    mods = []
    try:
        from odspark.registry import network
        mods.append(network)
    except ImportError:
        pass
    try:
        from odspark.registry import files
        mods.append(files)
    except ImportError:
        pass
    return mods
