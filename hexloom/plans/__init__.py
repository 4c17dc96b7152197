"""Named queries and the SQL that checks them."""

from __future__ import annotations

FLAGSHIP = "ent_density"


def modules() -> list:
    from . import assembly, layers, preparation, relations, scoring, surfaces

    return [preparation, layers, scoring, surfaces, assembly, relations]
