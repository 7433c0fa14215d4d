"""The input frames of one data folder, and the tables built from them, each made on first use."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from govmill.operators import drift, evidence, gold, owners, scores
from govmill.plans import eligibility, residency_change, tag_change
from govmill.session import configure, shared_folder
from govmill.sources import tables
from govmill.sources.fixtures import fixture, resources

RUN_TS = "2024-03-01 00:00:00"
PARENT_TERM = "P-REGION"
TARGET_CLASS = "PERSONAL.NAME"
TENANTS = {"tenant-a": ("S0", "S1", "S2"), "tenant-b": ("S3", "S4")}
OWNER_FALLBACK = ("Data Office", "data-office@example.com")
PRODUCT_PATTERN = r"^dp-\d+$"
ACTOR, SOURCE, TAG_REQUEST = "steward", "console", "tags-1"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._stored: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        """Fixture views by name without their prefix: ``product``, ``term``, ``h_asset``, ``documents``."""
        if name.startswith("_"):
            raise AttributeError(name)
        known = name if name.startswith("h_") or name in ("documents", "events", "nation", "part") else f"g_{name}"
        frame = fixture(self.spark, self.sf_dir, known)
        self.__dict__[name] = frame
        return frame

    def stored(self, name: str) -> DataFrame:
        """A table written once to the shared folder and read back, for jobs that use it several times."""
        if name not in self._stored:
            path = f"{shared_folder(self.spark)}/{name}"
            getattr(self, name).write.parquet(path)
            self._stored[name] = self.spark.read.parquet(path)
            # What is built from it later on reads the table as well.
            self.__dict__[name] = self._stored[name]
        return self._stored[name]

    def database(self) -> str:
        """A new database whose tables lie in the shared folder."""
        folder = shared_folder(self.spark)
        name = f"govmill_{folder[-12:]}"
        self.spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
        return name

    @cached_property
    def resource(self) -> DataFrame:
        return resources(self.spark, self.sf_dir)

    @cached_property
    def gold(self) -> DataFrame:
        return gold.gold_residency(self.product, self.term_assignment, self.term, PARENT_TERM)

    @cached_property
    def classification(self) -> DataFrame:
        return gold.fullname_classification(self.product, self.product_asset, self.asset_column,
                                            self.column_class, getattr(self, "class"), TARGET_CLASS, RUN_TS)

    @cached_property
    def base(self) -> DataFrame:
        return gold.base_products(self.gold, self.classification)

    @cached_property
    def dimension(self) -> DataFrame:
        return gold.product_dimension(self.gold)

    @cached_property
    def asset_counts(self) -> DataFrame:
        return gold.gold_asset_counts(self.product, self.product_asset, self.asset)

    @cached_property
    def inventory(self) -> DataFrame:
        return evidence.compute_inventory(self.resource, TENANTS, RUN_TS)

    @cached_property
    def residency(self) -> DataFrame:
        return self.residency_from(gold.applicability(gold.categorise_products(self.dimension).withColumn(
            "HasFullNameClassification", F.lit(0))), self.known_evidence())

    def residency_from(self, base: DataFrame, found: DataFrame | None = None) -> DataFrame:
        return scores.score_residency(base, self.resource, self.bucket, self.approved_region, RUN_TS, found)

    @cached_property
    def all_found(self) -> DataFrame:
        """Evidence of all domains, from one pass over the resources."""
        return evidence.product_evidence(self.resource, self.pricing, self.assessment, self.alert)

    def known_evidence(self) -> DataFrame | None:
        """The stored evidence, where a job has asked for that of all domains; a single scorecard gathers its own."""
        return self._stored.get("all_found")

    @cached_property
    def cc(self) -> DataFrame:
        return scores.score_cc(self.stored("base"), self.resource, self.patch, self.sku, RUN_TS, found=self.known_evidence())

    @cached_property
    def tag(self) -> DataFrame:
        return scores.score_tag(self.stored("base"), self.resource, RUN_TS, found=self.known_evidence())

    @cached_property
    def defender(self) -> DataFrame:
        return scores.score_defender(self.stored("base"), self.resource, self.pricing, self.assessment, self.alert, RUN_TS)

    @cached_property
    def protection(self) -> DataFrame:
        """Protection counts per product."""
        return self.stored("all_found").select("DataProductId", "protection.*")

    @cached_property
    def defender_points(self) -> DataFrame:
        """The threat-protection card without audit texts, for jobs that only read scores."""
        points = scores.defender_points(scores.defender_evidence(self.stored("base"), self.protection), RUN_TS)
        return points.withColumnRenamed("DataProductId", "dataProductId")

    @cached_property
    def summary(self) -> DataFrame:
        """All scorecards from the stored base and one stored table of evidence."""
        for name in ("gold", "base", "all_found"):
            self.stored(name)
        return scores.compliance_summary(self.gold, self.residency_from(self.base, self.all_found), self.cc, self.defender_points, self.tag)

    @cached_property
    def eligibility(self) -> DataFrame:
        return eligibility.residency_eligibility(self.stored("residency"), self.approved_region, RUN_TS)

    @cached_property
    def owners(self) -> DataFrame:
        return owners.owner_contact(self.owner, self.owner_contact, *OWNER_FALLBACK, RUN_TS)

    @cached_property
    def queue(self) -> DataFrame:
        return owners.cc_investigation_queue(self.cc, self.owners, self.gold)

    @cached_property
    def gap_no_compute(self) -> DataFrame:
        return evidence.gap_no_compute(self.stored("classification"), self.inventory, RUN_TS)

    @cached_property
    def gap_not_confidential(self) -> DataFrame:
        return evidence.gap_not_confidential(self.stored("classification"), self.inventory, RUN_TS)

    @cached_property
    def plan(self) -> DataFrame:
        return residency_change.residency_change_plan(self.residency_request, self.term_assignment, self.term,
                                                      self.product, PARENT_TERM, PRODUCT_PATTERN)

    @cached_property
    def applied(self) -> tuple[DataFrame, DataFrame]:
        return residency_change.residency_change_apply(self.stored("plan"), self.term_assignment, self.term, PARENT_TERM)

    @cached_property
    def tag_plan(self) -> DataFrame:
        return tag_change.tag_merge_plan(self.tag_item, self.resource, dry_run=False, confirm=True)

    @cached_property
    def catalog_deltas(self) -> DataFrame:
        return drift.catalog_deltas(self.h_catalog)

    @cached_property
    def asset_deltas(self) -> DataFrame:
        return drift.asset_count_deltas(self.h_asset)

    @cached_property
    def residency_deltas(self) -> DataFrame:
        return drift.residency_deltas(self.h_residency)

    @cached_property
    def timeline(self) -> DataFrame:
        return drift.kpi_timeline(self.h_catalog, self.h_asset, self.h_residency)

    @cached_property
    def newest_asset_time(self):
        return self.h_asset.select(F.max("SnapshotTS")).scalar()

    @cached_property
    def catalog_snapshot(self) -> DataFrame:
        return tables.snapshot_single_row(self.asset, RUN_TS)
