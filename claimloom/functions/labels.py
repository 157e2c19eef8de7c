"""Label vocabularies of the mapping stage and of the cleaning stage."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from claimloom.functions.text import strip

# Raw spellings and the label they mean, per stage.
MAPPING_LABELS = {
    "falso": "fake", "falsa": "fake", "mentira": "fake", "fake": "fake",
    "misleading": "mixed", "duvidoso": "mixed", "parcialmente falso": "mixed",
    "partly false": "mixed", "partly_true": "mixed", "mixed": "mixed",
    "verdadeiro": "true", "verdadeira": "true", "real": "true", "true": "true",
    "verdade": "true", "1": "fake", "0": "true",
}
MAPPING_NULLS = ("-1", "none", "nan")
CLEANING_LABELS = {
    "falso": "fake", "falsa": "fake", "fake": "fake", "false": "fake",
    "verdadeiro": "true", "verdadeira": "true", "true": "true", "real": "true",
}
CLEANING_NULLS = ("-1", "none", "nan", "")
KEPT_LABELS = ("fake", "true")


def _map_labels(c: Column, meanings: dict[str, str], nulls: tuple[str, ...]) -> Column:
    spelled = F.lower(strip(c.cast("string")))
    mapped = F.when(spelled.isin(*nulls), F.lit(None))
    for meaning in dict.fromkeys(meanings.values()):
        mapped = mapped.when(spelled.isin(*[k for k, v in meanings.items() if v == meaning]), meaning)
    return mapped.otherwise(spelled)


def mapping_label(c: Column) -> Column:
    """Raw label to fake / mixed / true; unknown spellings are kept, lower-cased."""
    return _map_labels(c, MAPPING_LABELS, MAPPING_NULLS)


def cleaning_label(c: Column) -> Column:
    """Second pass over labels before the fake/true filter."""
    return _map_labels(c, CLEANING_LABELS, CLEANING_NULLS)


def is_kept_label(c: Column) -> Column:
    return c.isin(*KEPT_LABELS)
