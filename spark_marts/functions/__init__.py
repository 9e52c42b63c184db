"""Column-level helpers: tolerant casts and string normalisation."""

from .columns import EXCLUDED_STATUSES, initcap_trim, try_cast

__all__ = ["EXCLUDED_STATUSES", "initcap_trim", "try_cast"]
