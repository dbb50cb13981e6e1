"""All check queries; importing the modules registers them."""

from __future__ import annotations

from curvemill.standin import (  # noqa: F401
    dense_book, enriching, forms, hedged_book, loading, losses, matching, reading, unhedged_book)
from curvemill.standin.registry import QUERIES, SQL  # noqa: F401
