"""Banding rules and the order the bands sort in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age bands (upper age, label), wait thresholds in minutes with the
# colour shown for each, and the colour of an empty value.
AGE_BANDS = [(17, "0-17"), (35, "18-35"), (55, "36-55"), (None, "56+")]
WAIT_COLOURS = [(25, "#2E7D74"), (40, "#7CAE9E"), (55, "#C9A227"), (70, "#C77B2B"), (None, "#AE3B49")]
NO_WAIT_COLOUR = "#DEE6E3"
# Wait thresholds in minutes and the satisfaction score they earn.
WAIT_SCORES = [(25, 5), (40, 4), (55, 3), (70, 2), (None, 1)]


def banded(value: Column, bands) -> Column:
    """The label of the first band whose inclusive upper edge holds ``value``; NULL has none."""
    *edged, (_, last) = bands
    out = F
    for edge, label in edged:
        out = out.when(value <= edge, label)
    return out.when(value.isNotNull(), last)


def band_order(label: Column, bands) -> Column:
    labels = [name for _, name in bands]
    out = F
    for position, name in enumerate(labels, 1):
        out = out.when(label == name, position)
    return out


def age_band(age: Column) -> Column:
    return banded(age, AGE_BANDS)


def band_birthdays(birth: Column) -> dict[str, Column]:
    """The birthday that ends each bounded band. Known per patient, so a visit needs date
    comparisons only, and no calendar arithmetic of its own."""
    return {f"_until{edge}": F.add_months(birth, 12 * (edge + 1)) for edge, _ in AGE_BANDS if edge is not None}


def age_band_on(day: Column) -> Column:
    """The age band on ``day`` for rows that carry ``band_birthdays``; NULL without a birth date."""
    *edged, (_, last) = AGE_BANDS
    out = F
    for edge, label in edged:
        out = out.when(day < F.col(f"_until{edge}"), label)
    return out.when(day.isNotNull() & F.col(f"_until{edged[-1][0]}").isNotNull(), last)


def wait_colour(wait: Column) -> Column:
    return F.when(wait.isNull(), NO_WAIT_COLOUR).otherwise(banded(wait, WAIT_COLOURS))
