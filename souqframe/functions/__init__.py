from souqframe.functions.amounts import numeric_amount
from souqframe.functions.text import (
    arabic_to_western,
    clean_text,
    correction_struct,
    normalize_currency_text,
    normalize_numeric_text,
    remove_currency,
)

__all__ = [
    "arabic_to_western",
    "clean_text",
    "correction_struct",
    "normalize_currency_text",
    "normalize_numeric_text",
    "numeric_amount",
    "remove_currency",
]
