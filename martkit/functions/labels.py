"""Codes to display labels."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.functions.portable import Name, as_col

# Labels shown for the codes.
PAYMENT_LABELS = {1: "Carte", 2: "Espèces", 3: "Gratuit", 4: "Litige", 5: "Inconnu"}
PAYMENT_DEFAULT = "Autre"
WEEKDAY_LABELS = {1: "Lun", 2: "Mar", 3: "Mer", 4: "Jeu", 5: "Ven", 6: "Sam", 7: "Dim"}


def label_codes(c: Name, mapping: Mapping[int, str], default: str | None = None) -> Column:
    """Label of an integer code; codes outside the mapping, and null, get the default."""
    pairs = [(F.lit(code).cast("bigint"), F.lit(label)) for code, label in mapping.items()]
    found = F.try_element_at(F.create_map(*chain.from_iterable(pairs)), as_col(c).cast("bigint"))
    return found if default is None else F.coalesce(found, F.lit(default))
