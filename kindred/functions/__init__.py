from kindred.functions.pair import first_of, pair_key, second_of, symmetric_pair_key
from kindred.functions.rating import denormalized, normalized, rounded_similarity, safe_ratio, scale, similarity_units, units_similarity

__all__ = [
    "denormalized",
    "first_of",
    "normalized",
    "pair_key",
    "rounded_similarity",
    "safe_ratio",
    "scale",
    "second_of",
    "similarity_units",
    "symmetric_pair_key",
    "units_similarity",
]
