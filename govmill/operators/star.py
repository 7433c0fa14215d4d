"""The relationships of both report models, and the rows of all their tables joined with products."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from govmill.functions.columns import normalise_id

ID, DESCRIPTION = "DataProductId", "DataProductDescription"


@dataclass(frozen=True)
class Relationship:
    """From a column of a table to a column of the product table. Reports follow the active ones only."""

    fact: str
    column: str
    to: str = ID
    active: bool = True
    model: str = ""

    @property
    def name(self) -> str:
        return f"{self.model}{self.fact}{'' if self.active else ' (inactive)'}"


#: Saved relationships of both models (fixed values).
RELATIONSHIPS = (
    Relationship("inventory", "DataProductId"), Relationship("gap_no_compute", "DataProductId"), Relationship("gap_not_confidential", "DataProductId"),
    Relationship("classification", "DataProductId"), Relationship("asset_counts", "DataProductName", DESCRIPTION),
    Relationship("eligibility", "DataProductID"), Relationship("cc", "DataProductId"), Relationship("queue", "DataProductId"),
    Relationship("residency", "DataProductDescription", active=False), Relationship("defender", "dataProductId"),
    Relationship("tag", "dataProductId"), Relationship("summary", "DataProductId"),
    Relationship("queue", "DataProductId", model="scores: "), Relationship("cc", "DataProductId", model="scores: "),
    Relationship("summary", "DataProductId", active=False, model="scores: "),
)


def path(fact: str, active_only: bool = True, model: str = "") -> Relationship:
    """The relationship that joins a table of a model with products; inactive ones only on request."""
    found = [r for r in RELATIONSHIPS if r.fact == fact and r.model == model and (r.active or not active_only)]
    if not found:
        raise KeyError(f"no {'active ' if active_only else ''}relationship from {fact}")
    return found[0]


def product_rows(facts: dict[str, DataFrame], products: DataFrame) -> DataFrame:
    """(fact, fact_key, ProductId, ProductDisplayName) for every row of every table, inactive relationships included.

    All tables are stacked as narrow rows, and both columns that relationships end at are stacked on the other side, so one join
    serves all relationships. Rows without a key get a salted one of their own, so they do not meet in one task.
    """
    narrow = reduce(DataFrame.unionByName, (facts[r.fact].select(
        F.lit(r.name.replace("scores: cc", "scores: signals")).alias("fact"), F.col(r.column).alias("fact_key"), F.lit(r.to).alias("_to")) for r in RELATIONSHIPS))
    ends = reduce(DataFrame.unionByName, (products.filter(F.col(c).isNotNull()).select(
        F.lit(c).alias("_to"), normalise_id(F.col(c)).alias("_key"), F.col("DataProductId").alias("ProductId"),
        F.col("DataProductDisplayName").alias("ProductDisplayName")) for c in (ID, DESCRIPTION)))
    own = F.concat(F.lit("none:"), F.monotonically_increasing_id().cast("string"))
    keyed = narrow.withColumn("_key", F.coalesce(normalise_id(F.col("fact_key")), own))
    return keyed.join(ends, ["_to", "_key"], "left").select("fact", "fact_key", "ProductId", "ProductDisplayName")
