"""Reading a claim-review response."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RESPONSE_SCHEMA = (
    "claims array<struct<claimant:string,"
    "claimReview:array<struct<textualRating:string,url:string>>>>"
)
REVIEW_COLUMNS = ("factcheck_rating", "factcheck_claimant", "factcheck_url")


def review_fields(response_json: Column) -> Column:
    """Struct of rating, claimant and URL of the first review of the first claim.

    No claim (or unreadable JSON): three nulls. A claim with a missing field
    or without reviews: empty strings.
    """
    claim = F.get(F.from_json(response_json, RESPONSE_SCHEMA)["claims"], 0)
    review = F.get(claim["claimReview"], 0)
    fields = (review["textualRating"], claim["claimant"], review["url"])
    return F.struct(
        *[
            F.when(claim.isNotNull(), F.coalesce(value, F.lit(""))).alias(name)
            for name, value in zip(REVIEW_COLUMNS, fields)
        ]
    )
