"""Named queries over the driver tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from . import dataset, evaluation, groups, masks, quality, reports, review, scenes, sequences, streams, text

MODULES = (quality, masks, sequences, groups, dataset, review, scenes, evaluation, text, streams, reports)


def all_queries() -> dict:
    found = {}
    for module in MODULES:
        for name, (function, _) in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} defined twice")
            found[name] = function
    return found


def all_sql() -> dict:
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql}
