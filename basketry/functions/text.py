"""Text normalisation for city and category values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accent-folding map of the customer-city rule. Each character of
# ACCENTED is replaced by the character at the same position of PLAIN. The map holds
# lower-case letters only, so values are lower-cased before folding.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüç"
PLAIN = "aaaaaeeeeiiiiooooouuuuc"


def fold_accents(col: Column | str) -> Column:
    """Replace the accented lower-case letters of the fixed map by plain ASCII."""
    return F.translate(F.col(col) if isinstance(col, str) else col, ACCENTED, PLAIN)


def normalize_city(col: Column | str) -> Column:
    """Lower-case, then fold accents ('SÃO PAULO' -> 'sao paulo')."""
    c = F.col(col) if isinstance(col, str) else col
    return fold_accents(F.lower(c))
