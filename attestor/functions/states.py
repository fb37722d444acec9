"""State names and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestor.functions.exprs import strip

# Postal codes and names of the states and the federal district.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut",
    "DE": "Delaware", "DC": "District of Columbia", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois",
    "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska",
    "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina",
    "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island",
    "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia",
    "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for p in pairs.items() for x in p])


def state_name(code: Column) -> Column:
    """The name of a postal code; null for none."""
    return F.try_element_at(_map(STATES), F.upper(strip(code)))


def state_code(name: Column) -> Column:
    """The postal code of a name in any case; null for none."""
    return F.try_element_at(_map({n.lower(): c for c, n in STATES.items()}), F.lower(strip(name)))
