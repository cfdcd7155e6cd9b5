"""The public list of postal street suffixes, read from the package's data file."""

from __future__ import annotations

import pkgutil
from functools import cache

#: Suffixes that name a kind of road; the others of the list name features (a glen, a hill) and are also parts of names.
ROADS = (
    "Alley Arcade Avenue Boulevard Bypass Causeway Circle Court Crescent Crossing Drive Expressway Freeway Highway Lane Loop Mews Motorway Parkway Passage Path Pike Place Plaza Road Route Row Skyway Square Street Terrace Throughway Trace "
    "Trafficway Trail Turnpike Walk Way"
).split()


@cache
def suffixes() -> dict[str, str]:
    """Every spelling in lower case and the suffix it stands for."""
    lines = pkgutil.get_data("cairnfield", "data/postal_suffixes.txt").decode().splitlines()
    out = {}
    for name, spellings in (line.split(":") for line in lines if line and not line.startswith("#")):
        out |= dict.fromkeys((name.lower(), *spellings.split()), name)
    return out
