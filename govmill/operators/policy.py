"""Tag policies, identity audit and policy-state counts over cloud resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import is_true, normalise_id

# Resource type -> (origin value, zone value) that policy sets.
ENFORCED = {V.VM_TYPE: ("azure", "standard"), V.ARC_TYPE: ("arc", "comprehensive")}


def enforce_tag_policy(resource: DataFrame) -> DataFrame:
    """Tags that policy would add or replace: origin first, then the zone that follows from it.

    The zone rule reads the origin the first rule has set. Policy compares without regard to case.
    One row per changed tag.
    """
    kind = normalise_id(F.col("ResourceType"))
    governed = resource.filter(kind.isin(*ENFORCED))
    origin = F.when(kind == V.VM_TYPE, ENFORCED[V.VM_TYPE][0]).otherwise(ENFORCED[V.ARC_TYPE][0])
    zone = F.when(kind == V.VM_TYPE, ENFORCED[V.VM_TYPE][1]).otherwise(ENFORCED[V.ARC_TYPE][1])

    def change(rule: str, tag: str, value):
        before = F.try_element_at("Tags", F.lit(tag))
        differs = ~is_true(F.lower(before) == value)
        return F.when(differs, F.struct(F.lit(rule).alias("rule"), F.lit(tag).alias("tag"),
                                        before.alias("before"), value.alias("after")))

    changes = F.array_compact(F.array(change("origin", V.ORIGIN_TAG, origin), change("zone", V.ZONE_TAG, zone)))
    return governed.select("ResourceId", F.inline_outer(changes)).filter("rule IS NOT NULL")


def audit_managed_identity(resource: DataFrame) -> DataFrame:
    """Hybrid machines without a system-assigned identity."""
    has = is_true(F.lower("IdentityType").contains("systemassigned"))
    return resource.filter((normalise_id(F.col("ResourceType")) == V.ARC_TYPE) & ~has).select("ResourceId", "IdentityType")


def policy_state_rollup(state: DataFrame) -> DataFrame:
    return state.groupBy("resourceId").agg(F.count_if("isCompliant").alias("compliant"),
                                           F.count_if(~F.col("isCompliant")).alias("nonCompliant"))


def policy_state_by_control(state: DataFrame) -> DataFrame:
    """Counts per control group. States are counted per list of groups before lists are taken apart."""
    per_list = state.groupBy("groupNames").agg(F.count_if("isCompliant").alias("c"), F.count_if(~F.col("isCompliant")).alias("n"))
    return (per_list.select(F.explode(F.split("groupNames", ",")).alias("control"), "c", "n")
            .groupBy("control").agg(F.sum("c").alias("compliant"), F.sum("n").alias("nonCompliant")))
