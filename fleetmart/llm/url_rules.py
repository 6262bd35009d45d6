"""Filtering URLs by host and path rules, and by association rules mined from labelled URLs.

FP-growth finds the frequent combinations of URL tokens together with the label. A combination whose rows carry one
label often enough becomes a rule, unless a part of it is a rule at least as certain. Rules are kept in an inverted
index under their rarest token: a URL looks up its own tokens, checks the rules it meets, and takes the verdict of the
most certain one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.store import Workspace

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "label:"


@dataclass(frozen=True)
class HostRule:
    """Fits its host and all subdomains where the path starts with its path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the numbered query.
HOST_RULES = (HostRule("block", "net", "/"), HostRule("allow", "example.net", "/en/"), HostRule("block", "example.com", "/de/"), HostRule("allow", "org", "/fr/"))


@dataclass(frozen=True)
class UrlMining:
    """Parameters. Support is a share of all labelled rows."""

    support: float = 0.01
    confidence: float = 0.8
    otherwise: str = "allow"


def host(url: Column | str) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column | str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host_col: str, path_col: str, rules: Sequence[HostRule]) -> tuple[Column, Column]:
    """(rule name, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((F.col(host_col) == rule.host) | F.endswith(host_col, F.lit("." + rule.host))) & F.startswith(path_col, F.lit(rule.path))
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _marked(kind: str, values: Column) -> Column:
    return F.transform(values, lambda x: F.concat(F.lit(kind + ":"), x))


def tokens(url: str = "url") -> Column:
    """The different tokens of a URL: scheme, host labels and their hyphenated words, domain, path segments with
    numbers as ``#``, file ending, names of query parameters, and whether there is a fragment."""
    labels = F.filter(F.split(host(url), "\\."), lambda x: x != "")
    n = F.size(labels)
    domain = F.when(n >= 2, F.array(F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), "."))).otherwise(labels)
    inner = F.when(n > 2, F.slice(labels, 1, F.greatest(n - 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    words = F.filter(F.flatten(F.transform(inner, lambda x: F.split(x, "-"))), lambda x: x != "")
    steps = F.filter(F.split(F.translate(path(url), _UPPER, _LOWER), "/"), lambda x: x != "")
    shape = F.transform(steps, lambda x: F.regexp_replace(F.regexp_replace(x, "\\.[a-z0-9]+$", ""), "[0-9]+", "#"))
    ending = F.filter(F.transform(steps, lambda x: F.regexp_extract(x, "\\.([a-z][a-z0-9]*)$", 1)), lambda x: x != "")
    asked = F.regexp_extract(url, "^[^#?]*\\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(asked, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1)), lambda x: x != "")
    scheme = F.filter(F.array(F.translate(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1), _UPPER, _LOWER)), lambda x: x != "")
    fragment = F.when(F.contains(F.col(url), F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    top = F.when(n >= 1, F.array(F.element_at(labels, -1))).otherwise(F.array().cast("array<string>"))
    parts = [_marked("scheme", scheme), _marked("top", top), _marked("domain", domain), _marked("host", inner), _marked("word", words),
             _marked("path", shape), _marked("ending", ending), _marked("asks", names), fragment]
    return F.when(F.col(url).isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(*parts)))


def mine_rules(labelled: DataFrame, work: Workspace, params: UrlMining = UrlMining()) -> DataFrame:
    """(wants, verdict, confidence, support, key) from rows with tokens and verdict; ``wants`` is the set of tokens."""
    rows = work.save(labelled.where("verdict is not null").select(F.array_append("tokens", F.concat(F.lit(_LABEL), "verdict")).alias("items")), "labelled")
    schema = "wants array<string>, verdict string, confidence double, support double, key string"
    if rows.isEmpty():
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=params.support, minConfidence=params.confidence).fit(rows)
    rules = model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(_LABEL)))
    rules = rules.select(
        F.array_sort("antecedent").alias("wants"), F.substring(F.col("consequent")[0], len(_LABEL) + 1, 100).alias("verdict"), "confidence", "support"
    ).where(~F.exists("wants", lambda x: F.startswith(x, F.lit(_LABEL))))
    rules = work.save(rules, "rules")
    # A rule goes if leaving out one token gives a rule that is at least as certain.
    shorter = rules.select("wants", "confidence", F.explode("wants").alias("_t")).select("wants", "confidence", F.array_remove("wants", F.col("_t")).alias("part"))
    known = rules.select(F.col("wants").alias("part"), F.col("confidence").alias("_c"))
    needless = shorter.join(known, "part").where("_c >= confidence").select("wants").distinct()
    rules = rules.join(needless, "wants", "left_anti")
    counts = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = rules.select("wants", F.explode("wants").alias("token")).join(counts, "token").groupBy("wants").agg(F.min(F.struct("freq", "token"))["token"].alias("key"))
    return work.save(rules.join(rarest, "wants").select("wants", "verdict", "confidence", "support", "key"), "index")


def match_rules(urls: DataFrame, index: DataFrame) -> DataFrame:
    """(url, mined, mined_verdict) for the URLs (url, tokens) that fit a mined rule: the most certain, then the best supported one."""
    met = urls.select("url", "tokens", F.explode("tokens").alias("key")).join(index, "key").where(F.size(F.array_except("wants", "tokens")) == 0)
    name = F.array_join("wants", " ")
    best = met.groupBy("url").agg(F.max(F.struct("confidence", "support", name.alias("mined"), F.col("verdict").alias("verdict"))).alias("best"))
    return best.select("url", F.col("best.mined").alias("mined"), F.col("best.verdict").alias("mined_verdict"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[HostRule] = HOST_RULES, params: UrlMining = UrlMining(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, mined), one row per row of ``pages``.

    The verdict is that of the longest host rule that fits, else of the best mined rule, else ``params.otherwise``.
    Rules are mined from all pages that have a label: the verdict of a host rule, or else one in ``labels`` (id, verdict).
    A null url, or one without ``://``, has an empty host and path. Repeated rows are judged alike; rows of ``labels``
    that repeat an id count by their least verdict. Without any label nothing is mined. An empty table gives an empty
    result; further columns are not read.
    """
    work = Workspace(pages.sparkSession, "url-rules")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    told = rows.withColumn("host", host("url")).withColumn("path", path("url"))
    name, verdict = rule_for("host", "path", rules)
    told = told.withColumn("rule", name).withColumn("rule_verdict", verdict)
    marks = labels.groupBy("id").agg(F.min("verdict").alias("label"))
    labelled = told.withColumn("tokens", tokens()).join(marks, F.col("page_id") == F.col("id"), "left")
    index = mine_rules(labelled.select("tokens", F.coalesce("rule_verdict", "label").alias("verdict")), work, params)
    open_urls = told.where("rule is null and url is not null").select("url").distinct().withColumn("tokens", tokens())
    judged = told.join(match_rules(open_urls, index), "url", "left")
    final = F.coalesce("rule_verdict", "mined_verdict", F.lit(params.otherwise))
    return judged.select("page_id", "host", "path", "rule", final.alias("verdict"), F.when(F.col("rule").isNull(), F.col("mined")).alias("mined"))
