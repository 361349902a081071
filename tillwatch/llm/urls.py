"""URL filtering by mined token combinations (operator 9).

A small policy of allow and block rules (host and path) decides the URLs it
fits. Those URLs are the labelled ones: Spark's FP-growth mines combinations of
their tokens together with the verdict, and combinations that imply a verdict
with enough support and confidence judge the URLs that no rule fits.

Rules are matched through an inverted index from token to mined rules: a mined
rule fits a URL if as many of its tokens are found there as it has. URLs are
matched once for each distinct set of indexed tokens, and not one by one.

Defined cases: a null URL or one without ``://`` has an empty host and path and
no tokens, so no rule fits and it is allowed; with no labelled URLs nothing is
mined and all the rest is allowed; ties between mined rules go to confidence,
support, fewer tokens, then text order. Repeated rows are kept. All of a URL is
tokens; FP-growth drops those below the support before it builds its trees. Tokens
that stand in the same labelled URLs are mined as one, so a long common path adds
one token and not a factor of two for each segment; the rules are then unfolded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.llm.shared import ascii_lower, staged, without
from tillwatch.operators.joins import lookup

# The policy, as (verdict, host and path).
POLICY = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
VERDICTS = ("allow", "block")
DEFAULT = "allow"
MIN_SUPPORT = 0.005  # of the labelled URLs
MIN_CONFIDENCE = 0.9
CLASS = "verdict="
COLUMNS = ("host", "path", "rule", "verdict", "mined", "confidence")


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return ascii_lower(part(1)), part(2)


def policy_rule(host: Column, path: Column, policy: Sequence[tuple[str, str]] = POLICY) -> tuple[Column, Column]:
    """The longest policy rule that fits, and its verdict; nulls where none does."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(policy, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, each marked with its place.

    Scheme, host labels by place from the right, their number, path segments by
    depth and the last one's extension, query parameters in any order, and whether
    there is a fragment. Runs of digits count as one digit.
    """
    labels = F.reverse(F.split(host, r"\."))
    segments = F.filter(F.split(F.regexp_replace(path, r"\d+", "0"), "/"), lambda s: s != "")
    query = F.split(F.regexp_replace(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), r"\d+", "0"), "&")
    marked = lambda mark, value: F.concat(F.lit(mark), F.nullif(value, F.lit("")))
    placed = lambda mark, items: F.transform(items, lambda v, i: F.concat(
        F.lit(mark), (i + 1).cast("string"), F.lit(":"), F.nullif(v, F.lit(""))))
    single = F.array(
        marked("scheme:", ascii_lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
        F.concat(F.lit("labels:"), F.size(labels).cast("string")),
        marked("ext:", F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)),
        F.when(F.instr(url, "#") > 0, F.lit("fragment")),
    )
    found = F.concat(single, placed("host", labels), placed("path", segments),
                     F.transform(query, lambda q: marked("query:", q)))
    return F.when(host != "", F.array_distinct(F.array_compact(found))).otherwise(F.array().cast("array<string>"))


def twins(labelled: DataFrame, min_support: float) -> dict[str, list[str]]:
    """Frequent tokens that stand in the same labelled URLs as others, under the least of them.

    At most (mean tokens of a URL) / min_support tokens are frequent.
    """
    least = min_support * labelled.count() * (1 - 1e-9)
    baskets = labelled.groupBy("tokens", "verdict").agg(F.count("*").alias("n"))
    where = [F.bit_xor(F.xxhash64(F.lit(seed), "tokens", "verdict")).alias(f"where_{seed}") for seed in (1, 2)]
    alike = (
        baskets.select("*", F.explode(F.array_distinct("tokens")).alias("token"))
        .groupBy("token").agg(F.sum("n").alias("n"), *where).filter(F.col("n") >= least)
        .groupBy("n", "where_1", "where_2").agg(F.array_sort(F.collect_list("token")).alias("same"))
        .filter(F.size("same") > 1).select("same").collect()
    )
    return {r.same[0]: list(r.same) for r in alike}


def unfolded(items: Column, same: dict[str, list[str]]) -> Column:
    """All token sets that ``items`` stands for."""
    names = F.create_map(*[c for k, v in same.items() for c in (F.lit(k), F.array(*map(F.lit, v)))])
    choices = F.transform(items, lambda t: F.coalesce(F.try_element_at(names, t), F.array(t)))
    return F.transform(
        F.reduce(choices, F.array(F.array().cast("array<string>")), lambda sets, one: F.flatten(
            F.transform(sets, lambda s: F.transform(one, lambda t: F.concat(s, F.array(t)))))), lambda s: F.array_sort(s))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         most_tokens: int | None = None) -> DataFrame:
    """``labelled`` (tokens, verdict) as rules (rule_id, items, verdict, confidence, support).

    A rule goes if it is no surer than the same verdict without one of its tokens.
    Rules have any number of tokens unless ``most_tokens`` is given. Support bounds the
    single tokens; tokens that are frequent together, but not always together, have a
    rule for each subset of them.
    """
    same = twins(labelled, min_support)
    spare = F.array(*[F.lit(t) for first, all_ in same.items() for t in all_ if t != first]).cast("array<string>")
    baskets = labelled.select(
        F.concat(F.array_except("tokens", spare), F.array(F.concat(F.lit(CLASS), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = (
        model.associationRules
        .filter(F.startswith(F.element_at("consequent", 1), F.lit(CLASS)))
        .filter(F.lit(True) if most_tokens is None else F.size("antecedent") <= most_tokens)
        .select(F.array_sort("antecedent").alias("items"),
                F.expr(f"substring(consequent[0], {len(CLASS) + 1})").alias("verdict"), "confidence", "support")
    )
    shorter = rules.select(F.col("items").alias("_less"), F.col("verdict").alias("_same"),
                           F.col("confidence").alias("_sure"))
    less = rules.withColumn("_one", F.explode("items")).withColumn("_less", F.array_except("items", F.array("_one")))
    redundant = (
        less.join(shorter, (less["_less"] == shorter["_less"]) & (F.col("verdict") == F.col("_same"))
                  & (F.col("_sure") >= F.col("confidence")), "left_semi")
        .select("items", "verdict").distinct()
    )
    rules = rules.join(redundant, ["items", "verdict"], "left_anti")
    if same:
        rules = rules.withColumn("items", F.explode(unfolded(F.col("items"), same)))
    return (
        rules.withColumn("rule_id", F.concat_ws(" ", F.concat_ws(" + ", "items"), F.lit("=>"), "verdict"))
    )


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct sets of indexed tokens in ``urls`` (_known, as JSON) with the best mined rule of each."""
    index = rules.select("rule_id", "verdict", "confidence", "support", F.size("items").alias("_need"),
                         F.explode("items").alias("_token"))
    found = (
        urls.select("_known").distinct().withColumn("_token", F.explode(F.from_json("_known", "array<string>")))
        .join(index, "_token")
        .groupBy("_known", "rule_id", "verdict", "confidence", "support", "_need")
        .agg(F.count("*").alias("_have"))
        .filter("_have = _need")
    )
    rank = F.struct(F.col("confidence"), F.col("support"), -F.col("_need"), F.col("rule_id"))
    return found.groupBy("_known").agg(
        F.max_by(F.struct("rule_id", "verdict", "confidence"), rank).alias("_best"))


def judge(pages: DataFrame, policy: Sequence[tuple[str, str]] = POLICY, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE, most_tokens: int | None = None) -> DataFrame:
    """``pages`` (url, ...) with host, path, policy rule, verdict, mined rule and its confidence."""
    pages = without(pages, *COLUMNS)
    host, path = host_and_path(F.col("url"))
    parsed = pages.withColumn("host", host).withColumn("path", path)
    rule, verdict = policy_rule(F.col("host"), F.col("path"), policy)
    parsed = parsed.withColumns({"rule": rule, "_policy": verdict,
                                 "_tokens": tokens(F.col("url"), F.col("host"), F.col("path"))})
    labelled = parsed.filter(F.col("_policy").isNotNull()).select(
        F.col("_tokens").alias("tokens"), F.col("_policy").alias("verdict"))
    rules = staged(mine(labelled, min_support, min_confidence, most_tokens), "rules")
    # At most (mean tokens of a URL) / min_support tokens are frequent, so the index's vocabulary is bounded.
    vocabulary = sorted(r[0] for r in rules.select(F.explode("items")).distinct().collect())
    indexed = F.array(*map(F.lit, vocabulary)).cast("array<string>")
    known = parsed.withColumn("_known", F.to_json(F.array_sort(F.array_intersect("_tokens", indexed))))
    best = match(known, rules)
    # Most URLs may have one set of tokens; ``lookup`` splits such keys.
    return (
        lookup(known, best, "_known", skew_from=known.select("_known"), spread_by=["url"])
        .withColumns({
            "verdict": F.coalesce("_policy", "_best.verdict", F.lit(DEFAULT)),
            "mined": F.col("_best.rule_id"), "confidence": F.col("_best.confidence")})
        .select(*pages.columns, *COLUMNS)
    )
