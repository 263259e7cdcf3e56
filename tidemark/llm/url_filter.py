"""URL filter: allow and block rules, and gradient-boosted trees on lexical features for what no rule decides.

DataFrame functions and Spark ML only. Features of a URL are its lengths, depths, digit ratios, entropies, parameter and
hyphen counts, and statistics of its suffixes: how many labelled URLs share its top-level label, its domain, its
first path segment or its file extension, and what share of them is blocked. Suffixes are hashed to BUCKETS, so
that the statistics, taken over all labelled URLs, are a table of bounded size. A URL that the trees are fitted on
sees the statistics of the other folds only, so that they tell of a suffix, not of the URL itself.

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule, and the trees' verdict
on what is left; URLs of any length are read whole; repeated URLs are judged alike and fitted on once; an empty table gives an
empty table; without labels of both kinds every URL gets the only label there is, or else 0. Other columns,
whatever their names, pass through; only the names of added columns must be free.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, written

#: At most so many different labelled URLs (those with the smallest hashes) fit the trees: a documented bound.
SAMPLE = 20_000
BUCKETS, FOLDS = 4096, 5
TREES, DEPTH, RATE, SEED = 20, 3, 0.3, 11
#: A suffix counts as if it had so many more labelled URLs of the average kind.
PRIOR = 20
#: Rules are a setting that is compiled into the plan, not data.
MOST_RULES = 500
KINDS = ("top", "domain", "section", "extension")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rules(lines: list[str]) -> list[Rule]:
    """Rules from lines such as ``block example.org/es/``."""
    if len(lines) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    rules = []
    for line in lines:
        verdict, _, target = line.strip().partition(" ")
        host, slash, path = target.strip().partition("/")
        if verdict not in ("allow", "block") or not host:
            raise ValueError(f"not a rule: {line!r}")
        rules.append(Rule(verdict, host.lower(), slash + path))
    return rules


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, else null; of equally long ones a block comes first."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in sorted(rules, key=lambda r: (-len(r.text), r.verdict == "allow", r.text))
    ]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fits, none)


def _entropy(text: Column) -> Column:
    """Bits per character; 0 for an empty text."""
    n = F.length(text)

    def part(c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -p * F.log2(p)

    each = F.transform(F.array_distinct(F.split(text, "")), part)
    return F.when(n > 0, F.aggregate(each, F.lit(0.0), lambda a, b: a + b)).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical(url: Column) -> dict[str, Column]:
    """Features by name. ``url`` must not be null."""
    host, path, n = host_of(url), path_of(url), F.length(url)
    params = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)

    def share(pattern: str, text: Column) -> Column:
        return F.when(F.length(text) > 0, _count(text, pattern) / F.length(text)).otherwise(0.0)

    return {
        "length": n.cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "host_depth": _count(host, r"[.]"),
        "path_depth": _count(path, "/"),
        "digits": share("[0-9]", url),
        "host_digits": share("[0-9]", host),
        "path_digits": share("[0-9]", path),
        "host_hyphens": _count(host, "-"),
        "host_entropy": _entropy(host),
        "path_entropy": _entropy(path),
        "parameters": _count(params, "[^&]+"),
        "escapes": _count(url, "%[0-9A-Fa-f]{2}"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "secure": lower_ascii(url).startswith("https://").cast("double"),
    }


def suffixes(url: Column) -> dict[str, Column]:
    """For each kind the hash bucket of the URL's suffix of that kind."""
    host, path = host_of(url), path_of(url)
    found = {
        "top": F.substring_index(host, ".", -1),
        "domain": F.substring_index(host, ".", -2),
        "section": F.regexp_extract(path, "^/([^/]*)", 1),
        "extension": F.regexp_extract(path, r"[.]([A-Za-z0-9]{1,8})$", 1),
    }
    return {kind: F.pmod(F.xxhash64(F.lit(kind), text), F.lit(BUCKETS)).cast("int") for kind, text in found.items()}


def _fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("fold"), url), F.lit(FOLDS)).cast("int")


def _statistics(labelled: DataFrame) -> DataFrame:
    """(kind, bucket, n0, ones0, n1, ...): labelled URLs and blocked ones by fold; at most 4 * BUCKETS rows."""
    url = F.col("url")
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), b.alias("bucket")) for k, b in suffixes(url).items()])
    each = labelled.select("label", _fold(url).alias("fold"), F.explode(keys).alias("key"))
    sums = [
        F.sum(F.when(F.col("fold") == f, value).otherwise(0)).cast("double").alias(f"{name}{f}")
        for f in range(FOLDS)
        for name, value in (("n", F.lit(1)), ("ones", F.col("label")))
    ]
    return each.groupBy("key.kind", "key.bucket").agg(*sums)


def _featured(urls: DataFrame, statistics: DataFrame, share: float, out_of_fold: bool) -> DataFrame:
    """``urls`` (url, other columns under free names) with the column ``features``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    names = lexical(url)
    found = urls.select(
        "*",
        F.array(*names.values()).alias("lexical"),
        _fold(url).alias("fold"),
        *[b.alias(f"bucket_{kind}") for kind, b in suffixes(url).items()],
    )
    columns = [F.col("lexical")[i].alias(name) for i, name in enumerate(names)]
    for kind in KINDS:
        counts = [F.array(*[F.col(f"{name}{f}") for f in range(FOLDS)]).alias(f"{name}_{kind}") for name in ("n", "ones")]
        part = statistics.where(F.col("kind") == kind).select(F.col("bucket").alias(f"bucket_{kind}"), *counts)
        found = found.join(F.broadcast(part), f"bucket_{kind}", "left")  # at most BUCKETS rows

        def total(name: str, kind: str = kind) -> Column:
            values = F.col(f"{name}_{kind}")
            others = F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
            return F.coalesce(others - F.element_at(values, F.col("fold") + 1) if out_of_fold else others, F.lit(0.0))

        columns += [
            ((total("ones") + share * PRIOR) / (total("n") + PRIOR)).alias(f"{kind}_share"),
            F.log1p(total("n")).alias(f"{kind}_count"),
        ]
    ready = found.select(*[F.col(c) for c in urls.columns], *columns)
    inputs = [*names, *[f"{kind}_{what}" for kind in KINDS for what in ("share", "count")]]
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(ready).drop(*inputs)


@dataclass(frozen=True)
class Model:
    """Suffix statistics with the boosted trees, or the one label that all labelled URLs have."""

    statistics: DataFrame
    share: float
    trees: GBTClassificationModel | None
    only: float


def fit(labelled: DataFrame, url: str = "url", label: str = "label") -> Model:
    """Fit on labelled URLs (1: block, 0: allow; others and nulls are left out)."""
    rows = labelled.select(labelled[url].alias("url"), labelled[label].alias("label")).where("url IS NOT NULL AND label IN (0, 1)")
    distinct = rows.groupBy("url").agg(F.max("label").alias("label"))
    statistics = written(_statistics(distinct), "url-statistics")
    ones, n = (
        statistics.where("kind = 'top'")
        .select(*[sum(F.col(f"{name}{f}") for f in range(FOLDS)).alias(name) for name in ("ones", "n")])
        .agg(F.sum("ones"), F.sum("n"))
        .first()
    )
    if not n or ones in (0, n):
        return Model(statistics, float(bool(n and ones)), None, float(bool(n and ones)))
    share = ones / n
    sample = distinct.orderBy(F.xxhash64("url"), "url").limit(SAMPLE)
    fitted = written(_featured(sample, statistics, share, out_of_fold=True).select("features", F.col("label").cast("double")), "url-sample")
    trees = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=SEED)
    return Model(statistics, share, trees.fit(fitted), share)


def with_scores(urls: DataFrame, model: Model, url: str = "url", name: str = "score") -> DataFrame:
    """``urls`` with the trees' probability that a URL is to be blocked."""
    if name.lower() in map(str.lower, urls.columns):
        raise ValueError(f"column {name!r} exists already")
    if model.trees is None:
        return urls.withColumn(name, F.lit(model.only))
    packed = urls.select(F.struct(*[urls[c] for c in urls.columns]).alias("row"), urls[url].alias("url"))
    judged = model.trees.transform(_featured(packed, model.statistics, model.share, out_of_fold=False))
    return judged.select("row.*", vector_to_array("probability")[1].alias(name))


def judge(urls: DataFrame, rules: list[Rule], model: Model, url: str = "url") -> DataFrame:
    """``urls`` with host, path, rule, score and verdict: the longest rule's, else block from a score of 0.5."""
    scored = with_scores(urls, model, url)
    host, path = host_of(scored[url]), path_of(scored[url])
    for name in ("host", "path", "rule", "verdict"):
        if name in map(str.lower, urls.columns):
            raise ValueError(f"column {name!r} exists already")
    named = scored.withColumns({"host": host, "path": path})
    ruled = rule_of(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return named.withColumns({"rule": ruled["rule"], "verdict": F.coalesce(ruled["verdict"], by_method)})


def label_by_rules(urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """(url, label) of the URLs that a rule decides."""
    ruled = rule_of(host_of(urls[url]), path_of(urls[url]), rules)
    return urls.select(urls[url].alias("url"), (ruled["verdict"] == "block").cast("int").alias("label")).where("label IS NOT NULL")
