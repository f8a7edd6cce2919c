"""URL filter by empirical-Bayes host reputation, in DataFrame operations only.

Labelled pages count as good or bad outcomes of their host. A host's rate has a beta prior whose mean is the rate of its registered
domain, the domain's rate one around that of its public suffix, and the suffix's one around the corpus rate. What a name has itself is
left out of the mean above it, so nothing counts twice. How strongly a level holds together, the prior's weight in pages, is
estimated for each level from the counts by moments: the spread of rates of names under one parent beyond what chance alone gives is
the intraclass correlation r, and the weight 1 / r - 1, between ``LEAST`` and ``MOST``; ``NO_PAIRS`` where no parent has two names with
outcomes. A host is blocked when its posterior, a beta distribution, gives rates up to ``most_bad`` a probability of at most
``doubt``, that is when its quantile at ``doubt`` passes ``most_bad`` (by Paulson's normal approximation of beta probabilities). A
host without outcomes has its domain's mean and a wide posterior, so it takes a clearly bad domain to block it. Rules come before that:
of the rules that fit a URL the longest decides.

Counts are aggregated before any shuffle, and kept in one table with a row a host. Joins on a document, a suffix, a domain or a host
are split: a key that at least one in ``HOT_SHARE`` of the rows has (there can't be more than ``HOT_SHARE`` such keys) is joined by
broadcast, the others by shuffle, and rows without a key not at all, so no task gets a hot key.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and gets the verdict of the host of that
name; a user part, a port and a final dot are no part of the domain, and a numeric address is a domain of its own; very long URLs are
read whole; unlabelled pages are no outcomes, and with no labels all hosts that no rule blocks are allowed; repeated rows count each and
come out repeated; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.joins import HOT_SHARE, joined
from rillflow.llm.store import table

LEAST, MOST, NO_PAIRS = 1.0, 1000.0, 8.0

#: The rules of the query's contract; fixed values.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: Public suffixes of two labels: a kind of body under a country, and hosts of others' sites; fixed values.
TWO_LABELS = r"^(?:(?:ac|co|com|edu|gen|go|gob|gov|id|ltd|mil|ne|net|nom|or|org|plc|sch)\.[a-z][a-z]|(?:blogspot|herokuapp|wordpress)\.com|(?:github|gitlab)\.io|(?:netlify|vercel|web)\.app|pages\.dev)\z"
#: What isn't part of a host's name: a user part before, a port or dots after; and names that are addresses.
USER, TAIL, ADDRESS = r"^(?:[^@]*@)+", r":[0-9]*\z|[.]+\z", r"^(?:[0-9.]+\z|\[)"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def domain(host: Column) -> Column:
    """The suffix and one label more."""
    name = F.regexp_replace(F.regexp_replace(host, USER, ""), TAIL, "")
    labels = F.split(name, r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    three = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".")
    return F.when(name.rlike(ADDRESS), name).when(two.rlike(TWO_LABELS), three).otherwise(two)


def suffix(of_domain: Column) -> Column:
    return F.when(of_domain.rlike(f"{ADDRESS}|{TWO_LABELS}"), of_domain).otherwise(F.regexp_replace(of_domain, r"^[^.]*\.", ""))


def rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does. Of rules as long as each other the first wins."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, where, start in reversed(ordered):
        fits = ((host == where) | host.endswith(f".{where}")) & path.startswith(start)
        name, verdict = F.when(fits, where + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def counted(rows: DataFrame, *keys: str) -> DataFrame:
    """By keys: n and bad, names with outcomes, and the sums that :func:`strength` takes, of rows with n and bad."""
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.when(F.col("n") > 0, 1)).alias("names"), F.sum(n * n).alias("squares"), F.sum(F.when(n > 0, bad * bad / n).otherwise(0.0)).alias("rates")]
    return rows.groupBy(*keys).agg(*sums, F.count("*").alias("c"))


def strength(parents: DataFrame) -> float:
    """The weight, in pages, of the prior of names under these parents."""
    n, bad, more = F.col("n").cast("double"), F.col("bad").cast("double"), F.col("names") - 1
    chance = bad / n * (1 - bad / n)
    over, room = F.sum(F.col("rates") - bad * bad / n - chance * more), F.sum(chance * (n - F.col("squares") / n - more))
    found = parents.where("n > 0").agg(over.alias("over"), room.alias("room")).first()
    if found.room is None or found.room <= 1e-9:
        return NO_PAIRS
    r = found.over / found.room
    return MOST if r <= 1 / (1 + MOST) else LEAST if r >= 1 / (1 + LEAST) else 1 / r - 1


def without_own(parent: tuple[str, str], own: tuple[str, str], mean: Column, weight: float) -> Column:
    """The mean above a name, from the parent's n and bad without the name's own."""
    n, bad = (F.col(p) - F.col(o) for p, o in zip(parent, own, strict=True))
    return (bad + mean * weight) / (n + weight)


def passes(mean: Column, weight: Column, limit: float, doubt: float) -> Column:
    """Whether a beta distribution of this mean and weight gives values up to ``limit`` a probability of at most ``doubt``."""
    a, b = mean * weight, (1 - mean) * weight
    f = F.pow(b * limit / (a * (1 - limit)), F.lit(1 / 3))
    z = ((1 - 1 / (9 * b)) * f - (1 - 1 / (9 * a))) / F.sqrt(f * f / (9 * b) + 1 / (9 * a))
    return z <= NormalDist().inv_cdf(doubt)


def reputations(hosts: DataFrame, doubt: float = 0.05, most_bad: float = 0.5) -> DataFrame:
    """host, pages, rep_n, rep_mean and rep_block, from a table with a row for each host: host, pages, n (labelled pages) and bad."""
    hosts = hosts.withColumn("domain", domain(F.col("host"))).withColumn("suffix", suffix(F.col("domain")))
    domains = table(counted(hosts, "domain", "suffix"), "domains")
    suffixes = table(counted(domains.select("suffix", "n", "bad"), "suffix"), "suffixes")
    total = counted(suffixes.select("n", "bad"))
    of_suffix, of_domain, of_host = strength(total), strength(suffixes), strength(domains)
    all_ = total.select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad")).first()
    corpus = (all_.bad - F.col("bad") + 1) / (all_.n - F.col("n") + 2.0)
    above = suffixes.select("suffix", F.col("n").alias("s_n"), F.col("bad").alias("s_bad"), corpus.alias("corpus"))
    rows = domains.select("domain", "suffix", F.col("n").alias("d_n"), F.col("bad").alias("d_bad"), F.col("c").alias("d_c"))
    rows = joined(rows, above, "suffix", suffixes.select("suffix", "c"), HOT_SHARE)
    rows = rows.withColumn("m1", without_own(("s_n", "s_bad"), ("d_n", "d_bad"), F.col("corpus"), of_suffix))
    rows = rows.select("domain", "d_n", "d_bad", "m1")
    out = joined(hosts.select("host", "pages", "n", "bad", "domain"), rows, "domain", domains.select("domain", "c"), HOT_SHARE)
    out = out.withColumn("m2", without_own(("d_n", "d_bad"), ("n", "bad"), F.col("m1"), of_domain))
    mean = (F.col("bad") + F.col("m2") * of_host) / (F.col("n") + of_host)
    out = out.select("host", "pages", F.col("n").alias("rep_n"), mean.alias("rep_mean"))
    return out.withColumn("rep_block", passes(F.col("rep_mean"), F.col("rep_n") + of_host, most_bad, doubt))


def outcomes(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """host, pages, n and bad, a row for each host, from the host and path of pages. ``labels`` has doc_id, quality and toxic; a page's
    document is the number that starts the second part of its path, and a bad outcome is one of no quality or toxic."""
    bad = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.expr("if(coalesce(quality, 1) = 0 or coalesce(toxic, 0) = 1, 1, 0)")).alias("is_bad"))
    of_page = rows.select("host", F.expr("try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]+)', 1), '') as long)").alias("doc_id"))
    per_host = table(of_page.groupBy("host", "doc_id").agg(F.count("*").alias("pages")), "host_documents")
    known = joined(per_host, bad, "doc_id", per_host.groupBy("doc_id").agg(F.count("*").alias("c")), HOT_SHARE)
    return known.groupBy("host").agg(F.sum("pages").alias("pages"), F.sum(F.when(F.col("is_bad").isNotNull(), F.col("pages")).otherwise(0)).alias("n"), F.sum(F.coalesce("is_bad", F.lit(0)) * F.col("pages")).alias("bad"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] | None = None, **how: float) -> DataFrame:
    """page_id, host, path, rule, verdict and the reputation."""
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rep = table(reputations(table(outcomes(rows, labels), "hosts"), **how), "reputations")
    both = joined(rows, rep.drop("pages"), "host", rep.select("host", F.col("pages").alias("c")), HOT_SHARE)
    name, verdict = rule(F.col("host"), F.col("path"), rules or RULES)
    return both.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("rep_block"), "block").otherwise("allow")).alias("verdict"), "rep_n", F.round("rep_mean", 9).alias("rep_mean"))
