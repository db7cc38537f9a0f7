"""URL filter: host and path rules first, then an empirical-Bayes reputation of the host.

Labelled page outcomes are counted by host. Counts of hosts are shrunk through beta-binomial priors: all pages
give the prior of a suffix, the suffix's posterior that of its registered domains, a domain's posterior that of its hosts.
Each level's prior strength is fitted to how far its members' rates differ beyond chance. A host passes unless its record
or its domain's brings the lower posterior bound of its rate of good pages below that of a host with as many pages at the rate of all. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitnet.llm.common import SEPARATORS

#: (host, path, verdict) of the contract's rules.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
#: A host passes if its lower bound, the 5 % quantile of its posterior, is at least this share of that of a host with as many pages, prior ones included, at the rate of all.
LEAST_SHARE = 0.97
#: How many standard deviations the normal distribution's 5 % quantile lies below its mean.
DEVIATIONS = 1.6448536269514722
#: Second labels that belong to the suffix before a country's two letters; fixed values.
SECOND = ("ac", "co", "com", "edu", "go", "gov", "ne", "net", "or", "org")
#: A suffix of two labels, behind a name; an address instead of a name.
TWO_LABELS, ADDRESS = rf"\.(?:{'|'.join(SECOND)})\.[a-z]{{2}}$", r"^[0-9.]+$|[\[\]:]"
#: The bounds of a prior's strength, in pages, and the strength where one member can't tell.
WEAKEST, STRONGEST, UNKNOWN = 2.0, 200.0, 20.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): behind the first "://" up to "/", "?", "#" or the end, in lower case; then up to "?" or "#"."""
    part = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def matching_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, as strings; null if none does.

    A rule fits its host and all below it, for paths that start with its own. Of equally long rules the first listed counts.
    """
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def site_of(host: Column) -> Column:
    """The host as reputations know it: without user, port and trailing dots."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), r"\.+$", "")


def domain_of(site: Column) -> Column:
    """The registered domain: the suffix and the label before it; an address is its own."""
    return F.when(site.rlike(ADDRESS), site).when(site.rlike(TWO_LABELS), F.substring_index(site, ".", -3)).otherwise(F.substring_index(site, ".", -2))


def suffix_of(site: Column) -> Column:
    """The last label, or two such as co.uk; all addresses are one suffix."""
    return F.when(site.rlike(ADDRESS), F.lit("address")).when(site.rlike(TWO_LABELS), F.substring_index(site, ".", -2)).otherwise(F.substring_index(site, ".", -1))


def _strengths(counts: DataFrame, above: str) -> DataFrame:
    """counts: (above, good, n) of each member. By ``above``: good, n and the strength of its members' common prior.

    By moments, the members' variance beyond the binomial one, from sums that combine before the shuffle:
    E[sum n_i (r_i - r)^2] = r (1 - r) ((k - 1) + rho (n - k)), rho the correlation within a member.
    """
    sums = counts.groupBy(above).agg(
        F.sum("good").alias("good"),
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("n") > 0, 1.0).otherwise(0.0)).alias("members"),
        F.sum(F.coalesce(F.try_divide(F.col("good") * F.col("good"), F.col("n")), F.lit(0.0))).alias("squares"),
    )
    good, n, k = F.col("good"), F.col("n"), F.col("members")
    rate = (good + 0.5) / (n + 1)
    spread = F.greatest(F.col("squares") - F.coalesce(F.try_divide(good * good, n), F.lit(0.0)), F.lit(0.0))
    rho = F.coalesce(F.try_divide(spread / (rate * (1 - rate)) - (k - 1), n - k), F.lit(0.0))
    fitted = F.when(rho > 0, F.least(F.greatest(F.try_divide(1 - rho, rho), F.lit(WEAKEST)), F.lit(STRONGEST))).otherwise(STRONGEST)
    return sums.select(above, "good", "n", F.when(k > 1, fitted).otherwise(UNKNOWN).alias("strength"))


def host_reputation(hosts: DataFrame) -> DataFrame:
    """(host, alpha, beta, bound, usual) of each host of (host, good, n): its beta posterior, a lower bound of its rate, and the bound
    that as many pages at the rate of all would give.

    n counts labelled pages, 0 or null if there are none; such a host has its domain's prior alone. A prior is worth so many
    pages that one at least is good and one bad. Sums are combined before they are shuffled, so a host with a third of all pages is one row for each task.
    """
    some = F.coalesce(F.col("n"), F.lit(0)).cast("double"), F.coalesce(F.col("good"), F.lit(0)).cast("double")
    hosts = hosts.where("host is not null").groupBy("host").agg(F.sum(some[1]).alias("good"), F.sum(some[0]).alias("n"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host")))
    domains = _strengths(hosts, "domain").withColumn("suffix", suffix_of(F.col("domain")))
    suffixes = _strengths(domains, "suffix").withColumn("every", F.lit(1))
    every = _strengths(suffixes.drop("strength"), "every").select("every", ((F.col("good") + 0.5) / (F.col("n") + 1)).alias("m0"), F.col("strength").alias("k0"))
    shrunk = lambda m, k: (F.col("good") + F.col(m) * F.col(k)) / (F.col("n") + F.col(k))
    suffixes = suffixes.join(every, "every").select("suffix", "m0", shrunk("m0", "k0").alias("m1"), F.col("strength").alias("k1"))
    domains = domains.join(suffixes, "suffix").select("domain", "m0", shrunk("m1", "k1").alias("m2"), F.col("strength").alias("k2"))
    clipped = lambda m: F.least(F.greatest(m, F.lit(0.01)), F.lit(0.99))
    most = lambda m, n: F.greatest(n, 1 / F.least(clipped(m), 1 - clipped(m)))
    worth = lambda m, n: (clipped(m) * most(m, n), (1 - clipped(m)) * most(m, n))
    prior = worth(F.col("m2"), F.col("k2"))
    domains = domains.select("domain", "m0", prior[0].alias("a"), prior[1].alias("b"))
    out = hosts.join(domains, "domain").select("host", "m0", (F.col("good") + F.col("a")).alias("alpha"), (F.col("n") - F.col("good") + F.col("b")).alias("beta"))
    usual = posterior_bound(*worth(F.col("m0"), F.col("alpha") + F.col("beta")))
    return out.select("host", "alpha", "beta", posterior_bound(F.col("alpha"), F.col("beta")).alias("bound"), usual.alias("usual"))


def posterior_bound(alpha: Column, beta: Column) -> Column:
    """The 5 % quantile of a beta distribution with both parameters 1 or more, by the approximation of Cornish and Fisher (Abramowitz and Stegun, 26.5.22)."""
    a, b = 1 / (2 * alpha - 1), 1 / (2 * beta - 1)
    h, tail = 2 / (a + b), (DEVIATIONS * DEVIATIONS - 3) / 6
    w = DEVIATIONS * F.sqrt(tail + h) / h - (b - a) * (tail + 5 / 6 - 2 / (3 * h))
    return alpha / (alpha + beta * F.exp(2 * w))


def longest_line(text: Column) -> Column:
    """The longest line without ASCII white space at its ends, of equally long ones the last by code point; "" if there is none."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(SEPARATORS)))
    return F.coalesce(F.array_max(F.transform(lines, lambda x: F.struct(F.length(x).alias("n"), x.alias("line"))))["line"], F.lit(""))


def page_text(html: Column) -> Column:
    """The text between a page's tags, each tag being a line break."""
    text = F.regexp_replace(html, "<[^<>]*>", "\n")
    for code, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def article_outcomes(pages: DataFrame, docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(host, good, n): pages whose article is a labelled document, counted by host.

    A page's article is the document that has the same longest line: titles and openings are shared by different texts. A page whose line
    several labelled documents share counts as good by the share of them that are. Only hashes of lines are shuffled.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    key = lambda text: F.when(longest_line(text) != "", F.sha2(longest_line(text), 256))
    known = docs.select("doc_id", key(F.col("text")).alias("article")).where("article is not null").join(marked, "doc_id").groupBy("article").agg(F.avg("y").alias("rate"))
    seen = pages.select(site_of(url_parts(F.col("url"))[0]).alias("host"), key(page_text(F.col("html"))).alias("article")).where("article is not null and host <> ''")
    # The same article on the same host is one row before it is shuffled, so a frequent one doesn't gather in a task.
    seen = seen.groupBy("host", "article").agg(F.count("*").alias("n"))
    return seen.join(known, "article").groupBy("host").agg(F.sum(F.col("n") * F.col("rate")).alias("good"), F.sum("n").alias("n"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound) of every page: its rule's verdict, else its host's by the bound.

    outcomes: (host, good, n), of which any may be missing: a host without outcomes has its domain's prior. bound is the host's.
    A null url, or one without "://", has an empty host and path, fits no rule and is blocked: nothing is known of it. Hosts that differ
    by user, port or trailing dots alone share a reputation; host is returned as it stands in the url. Of rules of one length the first
    listed counts. Very long urls are read once, from the start. Rows that repeat a page_id are judged each; other columns are ignored,
    also those named as a result. An empty table gives no rows.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), site_of(host).alias("_site"))
    known = rows.groupBy(F.col("_site").alias("host")).agg(F.lit(0.0).alias("good"), F.lit(0.0).alias("n"))
    known = known.union(outcomes.select(site_of(F.col("host")), F.col("good").cast("double"), F.col("n").cast("double")))
    reputation = host_reputation(known).select(F.col("host").alias("_site"), "bound", "usual")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("_site") != "") & (F.col("bound") >= LEAST_SHARE * F.col("usual")), "allow").otherwise("block")
    return rows.join(reputation, "_site").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "bound")
