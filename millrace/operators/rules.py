"""Three-valued evaluation of declared rules over contexts and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def closed_tags(rules: DataFrame) -> DataFrame:
    """rule_uid, tags: a rule's excluded tags and those of the rules it also excludes from (one level, missing rules refused)."""
    own = rules.select("rule_uid", F.coalesce("excludes_tags", F.array().cast("array<string>")).alias("tags"), F.explode_outer(F.coalesce("also_excludes_from_uids", F.array().cast("array<string>"))).alias("other"))
    others = rules.select(F.col("rule_uid").alias("other"), F.coalesce("excludes_tags", F.array().cast("array<string>")).alias("more"))
    joined = own.join(others, "other", "left").withColumn("more", F.when(F.col("other").isNotNull() & F.col("more").isNull(), F.raise_error(F.concat(F.lit("no rule "), F.col("other"))).cast("array<string>")).otherwise(F.coalesce("more", F.array().cast("array<string>"))))
    return joined.groupBy("rule_uid").agg(F.array_sort(F.array_distinct(F.flatten(F.concat(F.collect_list("more"), F.collect_list("tags"))))).alias("tags"))


def standing_rules(rules: DataFrame, order: str = "rule_uid") -> DataFrame:
    """group, standing_uid: a group's standing rule; of several the last by the column order, ties by rule_uid."""
    last = F.max_by("rule_uid", F.struct(F.col(order).alias("o"), F.col("rule_uid").alias("u")))
    return rules.select(F.explode("standing_for_groups").alias("group"), *{order: 1, "rule_uid": 1}).groupBy("group").agg(last.alias("standing_uid"))


def decide(requests: DataFrame, occasions: DataFrame, rules: DataFrame, order: str = "rule_uid") -> DataFrame:
    """The requests with state, item_value, abstain and governing (the rules that decided).

    requests: occasion_uid and item (map of tag to boolean, the tags assessed). occasions: occasion_uid, group, rule_uid, status. rules:
    rule_uid, rule_class (narrowing, admits_nothing, no_exclusion), source_executable, destination_executable, excludes_tags,
    also_excludes_from_uids, standing_for_groups. An undeclared occasion isn't applicable, an unknown one has insufficient evidence,
    and nothing unknown ever passes. A standing rule of the group holds besides a narrowing rule whatever its own class and flags, unless
    that rule already excludes from it; where the occasion itself excludes nothing, it holds if it narrows and its source can be
    evaluated. order tells which of several standing rules is the last. Rule tables are made by hand; they are broadcast only by Spark's own size estimate.
    """
    also = rules.select("rule_uid", F.coalesce("also_excludes_from_uids", F.array().cast("array<string>")).alias("also"))
    r = rules.select("rule_uid", "rule_class", "source_executable", "destination_executable").join(closed_tags(rules), "rule_uid")
    o = occasions.select("occasion_uid", F.col("group").alias("_g"), F.col("rule_uid").alias("_ru"), F.col("status").alias("_st"), F.lit(True).alias("_known"))
    first = r.join(also, "rule_uid").toDF("_ru", "_c", "_src", "_dst", "_tags", "_also")
    stand = standing_rules(rules, order).join(r, F.col("standing_uid") == F.col("rule_uid")).select(F.col("group").alias("_g"), F.col("standing_uid").alias("_su"), F.col("rule_class").alias("_sc"), F.col("source_executable").alias("_ss"), F.col("destination_executable").alias("_sd"), F.col("tags").alias("_stags"))
    j = requests.join(o, "occasion_uid", "left").join(first, "_ru", "left").join(stand, "_g", "left")
    narrow = F.col("_c") == "narrowing"
    open_rule = F.coalesce(F.col("_c") == "no_exclusion", F.lit(False)) | (F.col("_ru").isNull() & (F.col("_st") == "confirmed_no_constraint"))
    standing = F.coalesce((F.col("_sc") == "narrowing") & F.col("_ss"), F.lit(False))
    extra = F.coalesce(F.col("_su").isNotNull() & (F.col("_su") != F.col("_ru")) & ~F.array_contains("_also", F.col("_su")), F.lit(False))

    def per_item(tags: Column, executable: Column) -> Column:
        true = F.exists(tags, lambda t: (t == "*") | F.coalesce(F.try_element_at(F.col("item"), t), F.lit(False)))
        false = F.forall(tags, lambda t: F.coalesce(~F.try_element_at(F.col("item"), t), F.lit(False)))
        return F.when(~F.coalesce(executable, F.lit(False)), "UNKNOWN").when(F.coalesce(true, F.lit(False)), "FAIL").when(F.coalesce(false, F.lit(False)), "PASS").otherwise("UNKNOWN")

    own = per_item(F.when(extra, F.array_union("_tags", "_stags")).otherwise(F.col("_tags")), F.col("_dst") & F.when(extra, F.col("_sd")).otherwise(True))
    by_standing = per_item(F.col("_stags"), F.col("_sd"))
    unknown = F.struct(F.lit("INSUFFICIENT_EVIDENCE").alias("state"), F.lit("UNKNOWN").alias("item_value"), F.lit(False).alias("abstain"))

    def out(state: str, value: Column, abstain: bool = False) -> Column:
        return F.struct(F.lit(state).alias("state"), value.alias("item_value"), F.lit(abstain).alias("abstain"))

    result = (
        F.when(F.col("occasion_uid").isNull(), out("NOT_APPLICABLE", F.lit(None).cast("string")))
        .when(F.col("_known").isNull(), unknown)
        .when(open_rule & standing, out("EVALUABLE_CONSTRAINT", by_standing))
        .when(open_rule, out("NO_ADDITIONAL_RESTRICTION", F.lit("NO_CONSTRAINT")))
        .when(F.col("_c").isNull(), unknown)
        .when(F.col("_c") == "admits_nothing", out("EXPLICIT_PROHIBITION", F.lit("FAIL"), True))
        .when(narrow & ~F.coalesce("_src", F.lit(False)), unknown)
        .when(narrow, out("EVALUABLE_CONSTRAINT", own))
        .otherwise(F.struct(F.raise_error(F.concat(F.lit("unknown rule class "), F.col("_c"))).cast("string").alias("state"), F.lit(None).cast("string").alias("item_value"), F.lit(None).cast("boolean").alias("abstain")))
    )
    governing = F.array_compact(F.array(F.when(narrow | (F.col("_c") == "admits_nothing"), F.col("_ru")), F.when((open_rule & standing) | (narrow & extra), F.col("_su"))))
    return j.withColumn("_o", result).select(*requests.columns, "_o.state", "_o.item_value", "_o.abstain", governing.alias("governing"))
