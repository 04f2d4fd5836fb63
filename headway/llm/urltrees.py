"""URL filter: rules for hosts and paths, and gradient-boosted trees on lexical features for the URLs without a rule.

The trees learn from a bounded sample of the URLs that rules decide (`most` rows as expected, picked by a hash of the URL),
and all features are column expressions: lengths, depth, digit ratio, entropy of the characters, numbers of parameters, and
statistics of the host's suffixes of one and two labels: URLs per host, mean length, and the share that rules block; the last
also for the host's first label and the path's first part. Hosts fall into folds by a hash, and the share a URL gets is that
of the other folds, so no feature tells a host its own labels. These are counted over all URLs before; as tables of their own,
keyed by suffix and fold, they are joined, and Spark's size check decides how. Allowed and blocked URLs weigh the same in training, so that a verdict does not follow the commoner label.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.shared import keep

Rule = tuple[str, str]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST = 20_000
FOLDS = 5
FEATURES = (
    "url_length host_length path_length depth labels digit_ratio host_digits hyphens entropy host_entropy parameters "
    "has_query has_fragment secure last_length extension suffix_host_urls suffix_host_length suffix_block domain_host_urls domain_host_length domain_block "
    "first_block section_block"
).split()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; then the path up to `?`, `#` or the end.

    Both are empty for null and for texts without `://`.
    """
    after = F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, action) of the longest rule that fits; null if none does.

    A rule is written host and path, like `example.com/en/`. It fits its host and all hosts below, if the path starts with
    the rule's. Of equally long ones the first in order of text is taken. Rules are settings, a list of the query's author.
    """
    fitting = []
    for action, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        fitting.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))))
    return F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<rule: string, action: string>")


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters of a text in bits, 0 for an empty one."""
    n = F.length(text)
    shares = F.transform(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")), lambda c: (n - F.length(F.replace(text, c))) / n)
    return F.aggregate(shares, F.lit(0.0), lambda total, p: total - p * F.log2(p))


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def lexical(urls: DataFrame) -> DataFrame:
    """`urls` (url, host, path, …) with the features that the URL alone gives, and its suffix and domain."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    last = F.substring_index(path, "/", -1)
    made = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
        "labels": F.size(F.split(host, r"\.")),
        "digit_ratio": _count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
        "host_digits": _count(host, "[0-9]"),
        "hyphens": _count(host, "-"),
        "entropy": entropy(url),
        "host_entropy": entropy(host),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")),
        "has_query": url.contains("?").cast("int"),
        "has_fragment": url.contains("#").cast("int"),
        "secure": url.startswith("https://").cast("int"),
        "last_length": F.length(last),
        "extension": last.contains(".").cast("int"),
    }
    numbers = {name: column.cast("double") for name, column in made.items()}
    return urls.withColumns(numbers | {
        "suffix": F.substring_index(host, ".", -1),
        "domain": F.substring_index(host, ".", -2),
        "first": F.substring_index(host, ".", 1),
        "section": F.regexp_extract(path, "^/([^/]*)/", 1),
    })


def _tally(urls: DataFrame, *key: str) -> DataFrame:
    """(key …, fold, urls, decided, blocked): how many URLs there are, rules decide, and rules block."""
    blocked = F.count(F.when(F.col("action") == "block", 1)).alias("blocked")
    return urls.groupBy(*key, "fold").agg(F.count("*").alias("urls"), F.count("action").alias("decided"), blocked)


def _total(name: str, key: str) -> Column:
    # A row per fold, so a value of the key has FOLDS rows at most.
    return F.sum(name).over(Window.partitionBy(key))


def blocked_elsewhere(key: str) -> Column:
    """The share blocked in the other folds, drawn to a half."""
    return ((_total("blocked", key) - F.col("blocked") + 1) / (_total("decided", key) - F.col("decided") + 2)).alias(f"{key}_block")


def suffix_statistics(hosts: DataFrame, key: str) -> DataFrame:
    """For each value of `key` and fold: log of the URLs per host, mean length of a host, and the share blocked elsewhere.

    All folds that the suffix's hosts fall into have a row.
    """
    sums = hosts.groupBy(key, "fold").agg(
        F.count("*").alias("hosts"), F.sum(F.length("host")).alias("letters"), *(F.sum(c).alias(c) for c in ("urls", "decided", "blocked"))
    )
    urls = F.log1p(_total("urls", key) / _total("hosts", key)).alias(f"{key}_host_urls")
    return sums.select(key, "fold", urls, (_total("letters", key) / _total("hosts", key)).alias(f"{key}_host_length"), blocked_elsewhere(key))


def featured(pages: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url", hidden: int | None = None) -> DataFrame:
    """(id, url, host, path, rule, action, fold, …) with all features; rule and action are null where no rule fits.

    What rules decide in the fold `hidden` is left out of all statistics.
    """
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rows = rows.withColumn("met", matching_rule(F.col("host"), F.col("path"), rules))
    rows = lexical(rows.select("id", "url", "host", "path", "met.rule", "met.action"))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int"))
    counted = rows if hidden is None else rows.withColumn("action", F.when(F.col("fold") != hidden, F.col("action")))
    hosts = keep(_tally(counted, "suffix", "domain", "first", "host"))
    tables = {key: suffix_statistics(hosts, key) for key in ("suffix", "domain")}
    for key, tally in (("first", hosts), ("section", _tally(counted, "section"))):
        sums = tally.groupBy(key, "fold").agg(*(F.sum(c).alias(c) for c in ("decided", "blocked")))
        tables[key] = sums.select(key, "fold", blocked_elsewhere(key))
    for key, found in tables.items():
        rows = rows.join(keep(found), [key, "fold"])
    return rows


def tallied(rows: DataFrame) -> dict[str, int]:
    """Number of rows of each action, of which there are two at most."""
    return {r.action: r.n for r in rows.where("action is not null").groupBy("action").agg(F.count("*").alias("n")).toLocalIterator()}


def judge(pages: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url", most: int = MOST, trees: int = 20, depth: int = 4) -> DataFrame:
    """One row per page: id, host, path, rule, verdict (allow or block) and block_score, null where a rule decides.

    Null and empty URLs have an empty host and path. Without any URL that a rule decides, the others are allowed; if rules
    decide all alike, the others share that verdict. Repeated rows give repeated rows, an empty table an empty one; other
    columns are not read.
    """
    rows = featured(pages, rules, id, url)
    decided = tallied(rows)
    kept = ["id", "host", "path", "rule", "action"]
    if len(decided) < 2:
        only = next(iter(decided), "allow")
        judged = rows.select(*kept, F.lit(only).alias("guess"), F.lit(None).cast("double").alias("block_score"))
    else:
        model = fit(rows, decided, most, trees, depth)
        scored = model.transform(rows)
        share = vector_to_array("probability")[1]
        judged = scored.select(*kept, F.when(share > 0.5, "block").otherwise("allow").alias("guess"), F.when(F.col("action").isNull(), share).alias("block_score"))
    return judged.select(
        F.col("id").alias(id), "host", "path", "rule", F.coalesce("action", "guess").alias("verdict"), "block_score"
    )


def fit(rows: DataFrame, decided: dict[str, int], most: int, trees: int, depth: int) -> PipelineModel:
    """Boosted trees on a sample of the rows with an action, of which `decided` has the numbers."""
    total = sum(decided.values())
    share = int(min(1.0, most / total) * (1 << 20))
    drawn = rows.where(F.col("action").isNotNull() & (F.pmod(F.xxhash64("url", "id"), F.lit(1 << 20)) < share))
    weight = F.create_map([F.lit(x) for action, n in decided.items() for x in (action, total / (len(decided) * n))])[F.col("action")]
    sample = keep(drawn.select(*FEATURES, weight.alias("weight"), (F.col("action") == "block").cast("double").alias("label")))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, weightCol="weight").fit(assembler.transform(sample))
    return PipelineModel([assembler, boosted])


def held_out_auc(pages: DataFrame, rules: list[Rule], most: int = MOST, trees: int = 20, depth: int = 4) -> float | None:
    """Area under the curve for the ruled URLs of one fold of hosts, by trees and statistics of the other hosts.

    Null if either part lacks one of the labels. Equal scores, rounded to 4 places, count half.
    """
    rows = featured(pages, rules, hidden=0)
    out = F.col("fold") == 0
    decided = tallied(rows.where(~out))
    if len(decided) < 2:
        return None
    scored = fit(rows.where(~out), decided, most, trees, depth).transform(rows.where(out & F.col("action").isNotNull()))
    pairs = scored.select((F.col("action") == "block").cast("long").alias("y"), F.round(vector_to_array("probability")[1], 4).alias("p"))
    steps = pairs.groupBy("p").agg(F.sum("y").alias("b"), F.sum(1 - F.col("y")).alias("a"))
    below = F.sum("a").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))  # 10,001 steps at most
    ranked = steps.withColumn("won", F.col("b") * (F.coalesce(below, F.lit(0)) + F.col("a") / 2))
    return ranked.agg(F.try_divide(F.sum("won"), F.sum("b") * F.sum("a"))).first()[0]
