"""Queries over contracts, digests, texts and evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import scalar as X
from millrace.functions import text as T
from millrace.operators import contracts as C
from millrace.operators import digests as D
from millrace.operators import evidence as E
from millrace.plans.registry import Registry
from millrace.session import table

R = Registry()

_B, _A = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def _words(*words: str) -> str:
    return f"{_B}(?:{'|'.join(words)}){_A}"


LEXICON: dict[str, tuple[str, str | None]] = {
    "milk": (_words("milk", "butter", "cream", "cheese", "yogurt", "paneer", "ghee"), r"(?:coconut|almond|oat|soy)[ -]milk|peanut butter|butter ?nut"),
    "egg": (_words("eggs?", "egg yolk"), r"egg ?plant|eggless"),
    "fish": (_words("fish", "salmon", "tuna", "codfish", "anchov(?:y|ies)"), None),
    "nuts": (_words("almonds?", "walnuts?", "cashews?", "pecans?", "hazelnuts?"), r"nutmeg|coconut"),
    "soy": (_words("soy", "tofu", "edamame", "tempeh"), None),
}


def _sql_match(c: str, positive: str, negative: str | None) -> str:
    text = f"regexp_replace({c}, '{negative}', ' ', 'gi')" if negative else c
    return f"coalesce(regexp_matches({text}, '{positive}', 'i'), false)"


_LEX_SQL = " UNION ALL ".join(f"SELECT lang, '{k}' AS class, CAST(sum(CASE WHEN {_sql_match('text', *v)} THEN 1 ELSE 0 END) AS BIGINT) AS n, count(*) AS total FROM documents GROUP BY lang" for k, v in LEXICON.items())


@R.query("lexicon_scan_counts", _LEX_SQL)
def lexicon_scan_counts(spark: SparkSession, root: str) -> DataFrame:
    return E.lexicon_counts(table(spark, root, "documents"), ["lang"], "text", LEXICON)


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "phone_intl": r"\+\d{1,3}[\s-]?\d{6,14}", "long_digits": r"\d{11,}"}


@R.query("pii_scan_matrix", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{n}' AS pattern, CAST(sum(CASE WHEN coalesce(regexp_matches({c}, '{p}'), false) THEN 1 ELSE 0 END) AS BIGINT) AS n FROM documents" for c in ("text", "source") for n, p in PII.items()))
def pii_scan_matrix(spark: SparkSession, root: str) -> DataFrame:
    return C.pii_counts(table(spark, root, "documents"), ["text", "source"], PII)


@R.query("pii_redact", f"SELECT doc_id, regexp_replace(regexp_replace(text, '{PII['email']}', '[redacted-email]', 'g'), '{PII['phone_intl']}', '[redacted-phone]', 'g') AS redacted FROM documents")
def pii_redact(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", T.redact(F.col("text"), {"email": PII["email"], "phone": PII["phone_intl"]}).alias("redacted"))


@R.query("text_length_guard", "SELECT source, max(length(text)) AS longest, CAST(sum(CASE WHEN length(text) > 2000 THEN 1 ELSE 0 END) AS BIGINT) AS n_long FROM documents GROUP BY source")
def text_length_guard(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").groupBy("source").agg(F.max(F.length("text")).alias("longest"), F.sum(F.coalesce((F.length("text") > 2000).cast("long"), F.lit(0))).alias("n_long"))


@R.query("pk_contract", "SELECT 'recipe_id is null' AS \"check\", CAST(sum(CASE WHEN recipe_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM recipes_structured UNION ALL SELECT 'split_v3 outside its domain', CAST(sum(CASE WHEN split_v3 IS NULL OR split_v3 NOT IN ('train', 'val', 'test') THEN 1 ELSE 0 END) AS BIGINT) FROM recipes_structured UNION ALL SELECT 'ratingcount out of range', CAST(sum(CASE WHEN ratingcount < 0 OR ratingcount > 1000000000 THEN 1 ELSE 0 END) AS BIGINT) FROM recipes_structured UNION ALL SELECT 'rated recipes have an average', CAST(sum(CASE WHEN ratingcount > 0 AND ratingaverage IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM recipes_structured UNION ALL SELECT 'url out of shape', CAST(sum(CASE WHEN url IS NULL OR NOT regexp_full_match(url, 'https?://[a-z0-9.\\-]+/r/[0-9]+') THEN 1 ELSE 0 END) AS BIGINT) FROM recipes_structured UNION ALL SELECT 'recipe_id repeats', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM recipes_structured WHERE recipe_id IS NOT NULL GROUP BY recipe_id)")
def pk_contract(spark: SparkSession, root: str) -> DataFrame:
    contract = C.Contract("recipes").key("recipe_id").domain("split_v3", ["train", "val", "test"]).between("ratingcount", 0, 1e9).implies("rated recipes have an average", F.col("ratingcount") > 0, F.col("ratingaverage").isNotNull()).shape("url", r"https?://[a-z0-9.\-]+/r/[0-9]+")
    return contract.run(table(spark, root, "recipes_structured"))


@R.query("orphan_references", "SELECT recipe_id, count(*) AS n FROM documents d WHERE recipe_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM recipes_structured r WHERE r.recipe_id = d.recipe_id) GROUP BY 1")
def orphan_references(spark: SparkSession, root: str) -> DataFrame:
    return C.orphans(table(spark, root, "documents"), "recipe_id", table(spark, root, "recipes_structured"), "recipe_id")


@R.query("grid_completeness", "SELECT user_id, count(*) AS n_rows, count(DISTINCT CASE WHEN event_type IN ('click', 'view', 'error', 'purchase', 'signup') THEN event_type END) AS n_classes FROM (SELECT DISTINCT user_id, event_type FROM events WHERE value > 30) GROUP BY user_id HAVING count(*) <> 5 OR count(DISTINCT event_type) <> 5")
def grid_completeness(spark: SparkSession, root: str) -> DataFrame:
    return C.incomplete_grid(table(spark, root, "events").where("value > 30").select("user_id", "event_type").distinct(), "user_id", "event_type", ["click", "view", "error", "purchase", "signup"])


@R.query("split_contract", "SELECT g AS \"group\", v AS value, count(DISTINCT s) AS n_splits FROM (SELECT 'title_normalized' AS g, lower(trim(title_normalized)) AS v, coalesce(split_v3, '∅') AS s FROM recipes_structured UNION ALL SELECT 'sourcesite', lower(trim(sourcesite)), coalesce(split_v3, '∅') FROM recipes_structured) WHERE coalesce(v, '') <> '' GROUP BY ALL HAVING count(DISTINCT s) > 1")
def split_contract(spark: SparkSession, root: str) -> DataFrame:
    return C.split_problems(table(spark, root, "recipes_structured"), ["title_normalized", "sourcesite"], "split_v3")


@R.query("row_digests", "SELECT recipe_id, sha256(coalesce(recipename, '') || chr(0) || coalesce(url, '') || chr(0) || coalesce(lang, '')) AS digest, 'rcp_' || substr(sha256(coalesce(recipename, '') || chr(10) || coalesce(lang, '')), 1, 16) AS short FROM recipes_structured")
def row_digests(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "recipes_structured").select("recipe_id", X.joined_digest(F.col("recipename"), F.col("url"), F.col("lang")).alias("digest"), X.short_id("rcp_", F.col("recipename"), F.col("lang")).alias("short"))


@R.query("rehydration_index", "SELECT recipe_id, sha256(coalesce(ingredientslist, '') || chr(0) || coalesce(allergens_v2, '')) AS digest, nullif(regexp_extract(url, '^https?://([^/:?#]+)', 1), '') AS host, trim(coalesce(ingredientslist, '')) <> '' AS had_ingredientslist, trim(coalesce(allergens_v2, '')) <> '' AS had_allergens_v2 FROM recipes_structured")
def rehydration_index(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "recipes_structured").select("recipe_id", X.joined_digest(F.col("ingredientslist"), F.col("allergens_v2")).alias("digest"), X.url_host(F.col("url")).alias("host"), (~X.is_blank(F.col("ingredientslist"))).alias("had_ingredientslist"), (~X.is_blank(F.col("allergens_v2"))).alias("had_allergens_v2"))


@R.query("logical_digest")
def logical_digest(spark: SparkSession, root: str) -> DataFrame:
    """A digest of the interactions that doesn't depend on row order."""
    return D.logical_digest(table(spark, root, "interactions"))


@R.query("group_digests", "SELECT dup_family_id, 'q1_' || sha256(string_agg(CAST(recipe_id AS VARCHAR), ',' ORDER BY CAST(recipe_id AS VARCHAR))) AS digest FROM recipes_structured WHERE dup_family_id IS NOT NULL GROUP BY 1")
def group_digests(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured").where("dup_family_id IS NOT NULL").select("dup_family_id", F.col("recipe_id").cast("string").alias("id"))
    return D.group_digest(r, ["dup_family_id"], "id", "q1_")


@R.query("rating_bins", "SELECT recipe_id, CASE WHEN ratingcount IS NULL OR isnan(ratingcount) OR ratingcount < 0 OR isinf(ratingcount) THEN 'unknown' WHEN ratingcount = 0 THEN 'zero' WHEN ratingcount < 10 THEN '1_9' WHEN ratingcount < 100 THEN '10_99' ELSE '100_plus' END AS bin, CASE lower(trim(coalesce(diet, ''))) WHEN 'vegan' THEN 'Vegan' WHEN 'vegetarian' THEN 'Vegetarian' ELSE 'undeclared' END AS diet_class, coalesce(nullif(trim(home_region), ''), 'unknown') AS region, CASE WHEN home_region IN ('Aldane', 'Northmarch') THEN 'N' WHEN home_region IN ('Sundar Delta') THEN 'S' ELSE 'O' END AS zone FROM recipes_structured")
def rating_bins(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "recipes_structured").select(
        "recipe_id",
        X.count_bin(F.col("ratingcount")).alias("bin"),
        X.closed_vocabulary(F.col("diet"), {"vegan": "Vegan", "vegetarian": "Vegetarian"}, "undeclared").alias("diet_class"),
        X.or_unknown(F.trim("home_region")).alias("region"),
        X.zone(F.col("home_region"), {"N": ["Aldane", "Northmarch"], "S": ["Sundar Delta"]}).alias("zone"),
    )


@R.query("text_cards", "SELECT recipe_id, 'name: ' || coalesce(nullif(trim(recipename), ''), 'unknown') || chr(10) || 'region: ' || coalesce(nullif(trim(home_region), ''), 'unknown') AS card FROM recipes_structured")
def text_cards(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured")
    return r.select("recipe_id", T.card({"name": F.trim("recipename"), "region": F.col("home_region")}).alias("card"))


@R.query("traffic_lights", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 3 THEN 'green' WHEN l_quantity > 17.5 THEN 'red' WHEN l_quantity IS NOT NULL THEN 'amber' END AS band, l_quantity * 0.0025 AS salt FROM lineitem")
def traffic_lights(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", X.traffic_light(F.col("l_quantity"), 3, 17.5).alias("band"), X.salt_from_sodium(F.col("l_quantity")).alias("salt"))


@R.query("text_tokens", "SELECT doc_id, array_to_string(regexp_extract_all(coalesce(text, ''), '[0-9]+'), ' ') AS numbers, length(text) = n_chars AS length_agrees, lower(coalesce(text, '')) LIKE '%minutes%' AS names_minutes FROM documents")
def text_tokens(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "documents")
    numbers = F.array_join(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit("[0-9]+"), F.lit(0)), " ")
    return d.select("doc_id", numbers.alias("numbers"), (F.length("text") == F.col("n_chars")).alias("length_agrees"), F.contains(F.lower(F.coalesce("text", F.lit(""))), F.lit("minutes")).alias("names_minutes"))


@R.query("label_conflicts", " UNION ALL ".join(f"SELECT '{l}' AS label, '{c}' AS class, CAST(sum(CASE WHEN diet = '{l}' THEN 1 ELSE 0 END) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN diet = '{l}' AND {_sql_match('ingredientslist', *LEXICON[c])} THEN 1 ELSE 0 END) AS BIGINT) AS n_conflicts FROM recipes_structured" for l, c in (("Vegan", "milk"), ("Vegan", "egg"), ("Vegetarian", "fish"))))
def label_conflicts(spark: SparkSession, root: str) -> DataFrame:
    return E.label_conflicts(table(spark, root, "recipes_structured"), "diet", {"Vegan": ["milk", "egg"], "Vegetarian": ["fish"]}, "ingredientslist", LEXICON)


@R.query("gold_set_audit", f"WITH gold AS (SELECT diet AS query, recipe_id AS item FROM recipes_structured WHERE diet IS NOT NULL UNION ALL SELECT 'absent', -1) SELECT query, count(*) AS n, CAST(sum(CASE WHEN t.recipe_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing, CAST(sum(CASE WHEN coalesce(f.flag, false) THEN 1 ELSE 0 END) AS BIGINT) AS flagged, CAST(sum(CASE WHEN {_sql_match('t.ingredientslist', *LEXICON['milk'])} THEN 1 ELSE 0 END) AS BIGINT) AS named, CAST(sum(CASE WHEN coalesce(f.flag, false) OR {_sql_match('t.ingredientslist', *LEXICON['milk'])} THEN 1 ELSE 0 END) AS BIGINT) AS either, CAST(sum(CASE WHEN f.flag IS NULL AND t.ingredientslist IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS both_null FROM gold LEFT JOIN (SELECT recipe_id, contains(lower(allergens_v2), 'milk') AS flag FROM recipes_structured) f ON item = f.recipe_id LEFT JOIN recipes_structured t ON item = t.recipe_id GROUP BY query")
def gold_set_audit(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "recipes_structured")
    gold = r.where("diet IS NOT NULL").select(F.col("diet").alias("query"), F.col("recipe_id").alias("item")).unionByName(spark.createDataFrame([("absent", -1)], "query string, item bigint"))
    flags = r.select("recipe_id", F.contains(F.lower("allergens_v2"), F.lit("milk")).alias("flag"))
    return E.two_leg_audit(gold, "query", "item", flags, "flag", r.select("recipe_id", "ingredientslist"), "ingredientslist", "recipe_id", *LEXICON["milk"])


_POLICY = "CASE WHEN l = 'present' THEN 'present' WHEN l = 'unassessed' OR s OR NOT a OR k <> 'text_silent' THEN 'unknown' ELSE 'absent' END"


@R.query("status_policy_table", f"SELECT l AS legacy, k AS kind, s AS scan_incomplete, a AS assessable, {_POLICY} AS status, CASE {_POLICY} WHEN 'present' THEN 'FAIL' WHEN 'unknown' THEN 'UNKNOWN' ELSE 'PASS_SILVER_ONLY' END AS decision FROM (SELECT unnest(['present', 'absent', 'unassessed']) AS l), (SELECT unnest(['explicit', 'implicit_name', 'ambiguous_carrier', 'text_silent', 'unassessed']) AS k), (SELECT unnest([true, false]) AS s), (SELECT unnest([true, false]) AS a)")
def status_policy_table(spark: SparkSession, root: str) -> DataFrame:
    rows = [(l, k, s, a) for l in E.LEGACY for k in E.KINDS for s in (True, False) for a in (True, False)]
    grid = spark.createDataFrame(rows, "legacy string, kind string, scan_incomplete boolean, assessable boolean")
    status = E.status_policy(F.col("legacy"), F.col("kind"), F.col("scan_incomplete"), F.col("assessable"))
    return grid.withColumn("status", status.getField("status")).withColumn("decision", E.constraint(F.col("status")))


#: Evidence patterns of five classes, for the queries here.
CLASSES = {
    "milk": {"explicit": r"\bmilk\b", "implicit": r"\b(?:paneer|ghee|feta|mozzarella|parmesan|cream|yogurt|buttermilk)\b", "carriers": [(r"\bchocolate\b", None)], "strip": r"\b(?:coconut|almond) milk\b"},
    "egg": {"explicit": r"\beggs?\b", "implicit": r"\bmayonnaise\b"},
    "peanut": {"explicit": r"\bpeanuts?\b", "carriers": [(r"\boil\b", r"\b(?:olive|sunflower|mustard)\b")]},
    "soy": {"explicit": r"\bsoy\b", "implicit": r"\b(?:tofu|edamame|tempeh|miso)\b", "carriers": [(r"\bsauce\b", r"\b(?:fish|oyster) sauce\b")]},
    "fish": {"explicit": r"\bfish\b", "implicit": r"\b(?:salmon|tuna|codfish|anchovy)\b"},
}
_LINE_ENDS, _LABEL_ENDS = r"[;|\n\r\t•]+", r"[;|,/&+\n\r\t•\[\]\" ]+"


def _legacy(labels: Column) -> Column:
    """Statuses of the classes above from a label set."""
    pairs = []
    for c in CLASSES:
        blank = (F.size(labels) == 0) | F.array_contains(labels, "unknown")
        pairs += [F.lit(c), F.when(F.array_contains(labels, c), "present").when(blank, "unassessed").otherwise("absent")]
    return F.create_map(*pairs)


def _evidence_sql() -> str:
    """The grid in SQL: mentions are marked by signs, and a mention counts that is left once denied ones are taken out."""

    def some(lines: str, test: str) -> str:
        return f"len(list_filter({lines}, lambda x: {test})) > 0"

    denied_before = r"\b(?:no|without|omit|avoid|excluding)\s*⟪"
    rows = []
    for c, v in CLASSES.items():
        bare = f"list_transform(items, lambda x: regexp_replace(x, '{v['strip']}', ' ', 'gi'))" if v.get("strip") else "items"
        marks = {k: f"list_transform({bare}, lambda x: regexp_replace(x, '({v[k]})', '⟪\\1⟫', 'gi'))" for k in ("explicit", "implicit") if v.get(k)}
        whens = []
        for k, marked in marks.items():
            left = rf"contains(regexp_replace(regexp_replace(x, '{denied_before}[^⟫]*⟫', '', 'gi'), '⟪[^⟫]*⟫[ -]?free\b', '', 'gi'), '⟪')"
            whens.append(f"WHEN {some(marked, left)} THEN '{'explicit' if k == 'explicit' else 'implicit_name'}'")
        pieces = rf"flatten(list_transform({bare}, lambda x: regexp_split_to_array(x, ';|\bor\b|\band\b')))"
        for p, no in v.get("carriers", ()):
            but = f" AND NOT regexp_matches(x, '{no}', 'i')" if no else ""
            cond = f"regexp_matches(x, '{p}', 'i'){but}"
            whens.append(f"WHEN {some(pieces, cond)} THEN 'ambiguous_carrier'")
        for marked in marks.values():
            whens.append("WHEN " + some(marked, rf"regexp_matches(x, '{denied_before}|⟫[ -]?free\b', 'i')") + " THEN 'negated'")
        rows.append(f"SELECT recipe_id, '{c}' AS class, s, a, CASE WHEN list_contains(labels, '{c}') THEN 'present' WHEN len(labels) = 0 OR list_contains(labels, 'unknown') THEN 'unassessed' ELSE 'absent' END AS l, CASE WHEN NOT a THEN 'unassessed' {' '.join(whens)} ELSE 'text_silent' END AS k FROM base")
    reasons = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in E.EVIDENCE_REASONS.items())
    return rf"WITH base AS (SELECT recipe_id, coalesce(allergen_scan_incomplete, true) AS s, items, labels, len(items) > 0 AND coalesce(lang_base, '') = 'en' AS a FROM (SELECT recipe_id, allergen_scan_incomplete, lang_base, list_filter(list_transform(regexp_split_to_array(lower(coalesce(ingredientslist, '')), '{_LINE_ENDS}'), lambda x: trim(x)), lambda x: x NOT IN ('', '[]', 'null')) AS items, list_filter(regexp_split_to_array(lower(coalesce(allergens_v2, '')), '{_LABEL_ENDS}'), lambda x: x NOT IN ('', 'null')) AS labels FROM recipes_structured)), judged AS (SELECT *, CASE WHEN l = 'present' THEN 'legacy_positive_preserved' WHEN l = 'unassessed' THEN 'legacy_unassessed' WHEN s THEN 'scan_incomplete' WHEN k = 'unassessed' THEN 'ingredient_evidence_unassessed' WHEN k IN ('explicit', 'implicit_name') THEN 'name_conflicts_with_legacy_absence' WHEN k IN ('ambiguous_carrier', 'negated') THEN 'text_open_legacy_absence' ELSE 'silver_inferred_absence_not_verified_safe' END AS reason FROM ({' UNION ALL '.join(rows)})) SELECT recipe_id, class, l AS legacy_status, CASE k WHEN 'negated' THEN 'ambiguous_carrier' ELSE k END AS kind, CASE k {reasons} END AS evidence_reason, CASE WHEN l = 'present' THEN 'present' WHEN reason LIKE 'silver%' THEN 'absent' ELSE 'unknown' END AS status, reason, CASE WHEN l = 'present' THEN 'FAIL' WHEN reason LIKE 'silver%' THEN 'PASS_SILVER_ONLY' ELSE 'UNKNOWN' END AS decision FROM judged"


@R.query("evidence_grid", _evidence_sql())
def evidence_grid(spark: SparkSession, root: str) -> DataFrame:
    """recipe_id, class, legacy_status, kind, evidence_reason, status, reason, decision over all recipes, by the lines of their lists."""
    lines = F.filter(F.transform(F.split(F.lower(F.coalesce("ingredientslist", F.lit(""))), _LINE_ENDS), lambda x: F.trim(x)), lambda x: ~x.isin("", "[]", "null"))
    labels = F.filter(F.split(F.lower(F.coalesce("allergens_v2", F.lit(""))), _LABEL_ENDS), lambda x: ~x.isin("", "null"))
    r = table(spark, root, "recipes_structured").select("recipe_id", "allergen_scan_incomplete", "lang_base", lines.alias("items"), labels.alias("labels"))
    return E.evidence_grid(r, "recipe_id", F.col("items"), _legacy(F.col("labels")), F.col("allergen_scan_incomplete"), (F.size("items") > 0) & F.coalesce(F.col("lang_base") == "en", F.lit(False)), CLASSES)


@R.query("evidence_summary", f"WITH g AS ({_evidence_sql()}) SELECT class, status, reason, count(*) AS n FROM g GROUP BY GROUPING SETS ((class, status, reason), (status, reason))")
def evidence_summary(spark: SparkSession, root: str) -> DataFrame:
    """Statuses by class, with a row for all classes."""
    return evidence_grid(spark, root).groupingSets([["class", "status", "reason"], ["status", "reason"]], "class", "status", "reason").agg(F.count("*").alias("n"))


@R.query("review_queue", f"WITH g AS ({_evidence_sql()}) SELECT recipe_id, class, legacy_status, kind, status, concat_ws(',', CASE WHEN reason = 'name_conflicts_with_legacy_absence' THEN reason END, CASE WHEN evidence_reason = 'negated_name_requires_review' THEN evidence_reason END) AS why FROM g WHERE reason = 'name_conflicts_with_legacy_absence' OR evidence_reason = 'negated_name_requires_review'")
def review_queue(spark: SparkSession, root: str) -> DataFrame:
    """Cells to look at: a name against an absent label, or only denied names."""
    return E.review_queue(evidence_grid(spark, root), ["name_conflicts_with_legacy_absence", "negated_name_requires_review"], "recipe_id")


@R.query("wide_flags", "SELECT user_id, bool_or(event_type = 'purchase') AS purchase, bool_or(event_type = 'error') AS error, bool_or(event_type = 'purchase') AND NOT bool_or(event_type = 'error') AS clean_buyer FROM events GROUP BY user_id")
def wide_flags(spark: SparkSession, root: str) -> DataFrame:
    flags = table(spark, root, "events").groupBy("user_id").agg(*[F.bool_or(F.col("event_type") == t).alias(t) for t in ("purchase", "error")])
    return flags.withColumn("clean_buyer", F.col("purchase") & ~F.col("error"))


METHOD = {"placeholder": r"\b(?:watch|see) the video\b|coming soon", "verb": r"\b(?:heat|add|mix|stir|cook|boil|fry|bake|pour|whisk|fold|season|simmer|soak|scatter|grind|knead|press)\b", "finish": r"\b(?:serve|ready|enjoy|done|garnish)\b"}


@R.query("method_statuses")
def method_statuses(spark: SparkSession, root: str) -> DataFrame:
    """status and n of the documents' texts, read as methods, per source."""
    d = table(spark, root, "documents").select("source", E.method_status(F.col("text"), METHOD).alias("status"))
    return d.groupBy("source", "status").agg(F.count("*").alias("n"))


@R.query("sentence_tails")
def sentence_tails(spark: SparkSession, root: str) -> DataFrame:
    """Sentences, the last three and the later half of every text."""
    d = table(spark, root, "documents")
    return d.select("doc_id", F.size(T.sentences(F.col("text"))).alias("n_sentences"), T.last_sentences(F.col("text"), 3).alias("tail"), T.later_half(F.col("text")).alias("later"), T.affirmed(F.col("text"), r"\badd (?:the )?(?:water|milk|stock)\b", r"\b(?:no|not|never|without)\b[^.]{0,25}$").alias("liquid"))
