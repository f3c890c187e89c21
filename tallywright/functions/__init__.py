"""Column functions: Column in, Column out, no UDFs."""

from .dates import clean_date, whole_days_between
from .money import DIFF, MONEY, clean_amount, exposure_first, exposure_max
from .similarity import lcs_ratio
from .text import clean_email, clean_name, clean_phone

__all__ = [
    "DIFF",
    "MONEY",
    "clean_amount",
    "clean_date",
    "clean_email",
    "clean_name",
    "clean_phone",
    "exposure_first",
    "exposure_max",
    "lcs_ratio",
    "whole_days_between",
]
