"""URL filter: rules first, then a reputation of hosts by empirical Bayes.

Labelled page outcomes (bad or not) are counted by host. A host's share of bad
pages is shrunk towards that of its registered domain, the domain's towards
that of its suffix, the suffix's towards that of all pages. Each level is beta-
binomial: children scatter about their parent's share with a strength that the
moments of the counts give. A host is blocked if the lower bound of its
posterior share (mean less `z` standard deviations of the beta) is over `limit`.
A host without labels has its domain's share, and so on upwards.

Size. Outcomes leave the scan already summed by host. Pages are reduced to their
distinct hosts before anything is looked up, and only blocked hosts go back to
the pages. Every looked-up table is staged and counted: up to `few` rows it is
broadcast, beyond that both sides are shuffled as they are, so that adaptive
execution can split a hot host.

Defined results. A url that is null or lacks `://` has an empty host and path,
fits no rule and is judged like an unknown host. Labels that are null in every
column are no outcome; a document with several labels is bad if one says so.
Pages that repeat count each. No labels: every share is zero, and every page without a rule is allowed. User names and ports stay part of `host`, but not of the name that reputation goes by.
An address of digits, and a name without a dot, is its own domain and suffix. Other columns of
the input play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.llm.shared import columns, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Fits `host` and its subdomains, if the path begins with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def label(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    limit: float = 0.35
    z: float = 1.645
    #: Bounds of a level's strength, in pages.
    least: float = 2.0
    most: float = 1000.0
    #: Rows of a looked-up table that may be broadcast.
    few: int = 100_000
    #: Public suffixes of two labels; any other suffix is the last label.
    suffixes: tuple[str, ...] = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "co.kr", "co.in",
                                 "com.br", "com.cn", "com.mx", "com.tr", "co.za")


@dataclass(frozen=True)
class Reputation:
    """Shares and strengths of the levels; `hosts` and `domains` and `suffixes` are staged tables."""

    hosts: DataFrame
    domains: DataFrame
    suffixes: DataFrame
    share: float
    strength: float
    settings: Settings


def parts(url: Column) -> dict[str, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return {"host": F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)}


def name_of(host: Column) -> Column:
    """The host without user name and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r":[0-9]*$", "")


def levels(name: Column, suffixes: Sequence[str]) -> dict[str, Column]:
    """Suffix and registered domain of a host's name."""
    label = F.split(name, r"\.")
    last, before, third = (F.try_element_at(label, F.lit(-k)) for k in (1, 2, 3))
    two = F.concat(before, F.lit("."), last)
    single = before.isNull() | name.rlike(r"^[0-9.]*$")
    long = F.coalesce(two.isin(*suffixes), F.lit(False)) if suffixes else F.lit(False)
    return {"suffix": F.when(single, name).when(long, two).otherwise(last),
            "domain": F.when(single, name).when(~long, two).otherwise(F.coalesce(F.concat(third, F.lit("."), two), two))}


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of its label and verdict; missing if none does."""
    out = F.lit(None).cast("struct<label:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.label), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.label).alias("label"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def small(df: DataFrame, few: int) -> DataFrame:
    """A staged table, to be broadcast if it is counted to be small."""
    return F.broadcast(df) if df.count() <= few else df


def outcomes(pages: DataFrame, labels: DataFrame, document: Column, settings: Settings = Settings()) -> DataFrame:
    """Labelled pages and bad ones among them, by host's name. `document` is the labelled document that a page shows."""
    verdicts = (columns(labels, doc="doc_id", quality="quality", toxic="toxic").where("doc IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
                .groupBy("doc").agg(F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)).alias("bad")))
    shown = pages.select(name_of(parts(F.col("url"))["host"]).alias("name"), document.alias("doc")).where("doc IS NOT NULL")
    joined = shown.join(small(stage(verdicts, "page-labels"), settings.few), "doc")
    return joined.groupBy("name").agg(F.count("*").alias("n"), F.sum("bad").alias("x"))


def _squares(of: str, by: str) -> Column:
    """Exact sum of floor(SCALE * of^2 / by), whatever the order of the rows."""
    value = F.floor(F.col(of).cast("double") * F.col(of).cast("double") / F.col(by).cast("double") * SCALE)
    return F.sum(value.cast("decimal(28,0)"))


def _strength(children: DataFrame, attach: Callable[[DataFrame], DataFrame], key: list[str], settings: Settings) -> float:
    """How strongly children keep to their parent's share, by the method of moments.

    With v the variance of one page under the parent's shrunk share and rho the
    correlation of pages of one child, the scatter of k children is expected to be
    v * ((k - 1) * (1 - rho) + rho * (n - sum(n_child^2) / n)). `attach` adds
    a parent's counts and share to the sums over its children.
    """
    per = children.groupBy(*key).agg(F.count("*").alias("k"), _squares("x", "n").alias("xx"), _squares("n", "n_parent").alias("nn"))
    joined = attach(per)
    n, x, k, share = (F.col(c).cast("double") for c in ("n_parent", "x_parent", "k", "share"))
    n, one = F.when(n != 0, n), share * (1 - share)
    fixed = {"a": F.col("xx").cast("double") - F.floor(x * x / n * SCALE), "b": F.floor(one * (k - 1) * SCALE),
             "c": F.floor(one * (n - F.col("nn").cast("double") / SCALE) * SCALE)}
    a, b, c = joined.select(*[F.sum(v.cast("decimal(28,0)")).alias(k) for k, v in fixed.items()]).first()
    if a is None or a <= b or c <= b:
        return settings.most
    rho = float(a - b) / float(c - b)
    return min(max(1.0 / rho - 1.0, settings.least), settings.most)


def _shrunk(df: DataFrame, above: Column | float, strength: float) -> Column:
    return (F.col("x").cast("double") + above * F.lit(strength)) / (F.col("n").cast("double") + F.lit(strength))


def fit(counts: DataFrame, settings: Settings = Settings()) -> Reputation:
    """Shares of suffixes and domains and the strengths of all levels, from the counts of `outcomes`.

    Three numbers of each level reach the driver.
    """
    hosts = stage(counts.withColumns(levels(F.col("name"), settings.suffixes)), "hosts")
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("x"), F.lit(0)).alias("x")).first()
    share = (float(total["x"]) + 0.5) / (float(total["n"]) + 1.0) if total["n"] else 0.0
    root = {"n_parent": F.lit(total["n"]), "x_parent": F.lit(total["x"]), "share": F.lit(share)}

    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    strong = _strength(suffixes.withColumn("n_parent", root["n_parent"]), lambda per: per.withColumns(root), [], settings)
    suffixes = stage(suffixes.withColumn("share", _shrunk(suffixes, F.lit(share), strong)), "suffixes")
    of_suffix = small(suffixes.select("suffix", F.col("n").alias("n_parent"), F.col("x").alias("x_parent"), "share"), settings.few)

    domains = stage(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).join(of_suffix, "suffix"), "domains")
    strong = _strength(domains, lambda per: per.join(of_suffix, "suffix"), ["suffix"], settings)
    domains = stage(domains.select("domain", "n", "x", _shrunk(domains, F.col("share"), strong).alias("share")), "domain-shares")
    of_domain = small(domains.select("domain", F.col("n").alias("n_parent"), F.col("x").alias("x_parent"), "share"), settings.few)

    strong = _strength(hosts.join(of_domain, "domain"), lambda per: per.join(of_domain, "domain"), ["domain"], settings)
    return Reputation(hosts, domains, suffixes, share, strong, settings)


def bounds(names: DataFrame, known: Reputation) -> DataFrame:
    """Posterior mean and lower bound of the bad share of each row's host `name`."""
    s = known.settings
    at = names.withColumns(levels(F.col("name"), s.suffixes))
    for table, key in ((known.suffixes, "suffix"), (known.domains, "domain")):
        at = at.join(small(table.select(key, F.col("share").alias(f"{key}_share")), s.few), key, "left")
    at = at.join(small(known.hosts.select("name", "n", "x"), s.few), "name", "left")
    prior = F.coalesce("domain_share", "suffix_share", F.lit(known.share))
    n, x = (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("n", "x"))
    mean = (x + F.lit(known.strength) * prior) / (n + F.lit(known.strength))
    sd = F.sqrt(mean * (1 - mean) / (n + F.lit(known.strength + 1.0)))
    return at.select("name", mean.alias("bad_share"), (mean - F.lit(s.z) * sd).alias("bad_at_least"))


def judge(pages: DataFrame, known: Reputation, rules: Sequence[Rule] = (), carry: Sequence[str] = ("page_id",)) -> DataFrame:
    """Host, path, fitting rule and verdict of each page; `carry` columns come along."""
    found = parts(F.col("__url"))
    at = columns(pages, **{f"__{i}": c for i, c in enumerate(carry)}, __url="url").withColumns(found).drop("__url")
    at = at.withColumns({"__rule": rule_of(F.col("host"), F.col("path"), rules), "__name": name_of(F.col("host"))})
    names = at.where("__rule IS NULL AND __name <> ''").select(F.col("__name").alias("name")).distinct()
    limit = F.lit(known.settings.limit)
    blocked = stage(bounds(names, known).where(F.col("bad_at_least") > limit).select(F.col("name").alias("__name"), F.lit("block").alias("__blocked")), "blocked")
    out = at.join(small(blocked, known.settings.few), "__name", "left")
    return out.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(carry)], "host", "path", F.col("__rule.label").alias("rule"),
                      F.coalesce("__rule.verdict", "__blocked", F.lit("allow")).alias("verdict"))
