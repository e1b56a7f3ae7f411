"""Column-level helpers: text normalisation, tolerant casts, money arithmetic."""

from basketry.functions.casts import to_double, to_int_score, to_timestamp
from basketry.functions.money import money, money_out
from basketry.functions.text import fold_accents, normalize_city

__all__ = [
    "fold_accents",
    "money",
    "money_out",
    "normalize_city",
    "to_double",
    "to_int_score",
    "to_timestamp",
]
