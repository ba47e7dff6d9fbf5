"""Column expressions shared by the operators."""

from immolens.functions.parse import (  # noqa: F401
    CITY_PATTERN, DEFAULT_CITY, PRICE_PATTERN, ROOMS_PATTERN, SURFACE_PATTERN,
    amount_parts, epoch_day_to_date, extract_city, extract_fr_int, extract_int, is_http_url,
    listing_id, mean2, mean_of_parts, price_per_m2, round2, tolerant_date, whole_price_per_m2,
)
from immolens.functions.text import (  # noqa: F401
    capitalize_first, clean_text, collapse_newlines, collapse_whitespace,
)
