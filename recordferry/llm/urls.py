"""URL filters: path rules first, empirical-Bayes host reputation for the rest.  DataFrame functions only.

Reputation: labelled page outcomes (bad or not) are counted per host, registered domain and suffix.  The suffix is the last
label, or the last two where they are one of SUFFIXES; the registered domain has one label more.  A port does not count; an
address of numbers is a domain of its own, and all such addresses share one suffix.  Each level shrinks to the one above: a suffix to the rate of all outcomes, a domain to its suffix, a host to its
domain.  Given the parent's mean m, the prior of a level is Beta(k m, k (1 - m)); its strength k is estimated from the
spread of that level's observed rates around their parents' means (method of moments).  A host is blocked where the lower
bound of its posterior bad rate, mean - Z * standard deviation, exceeds LIMIT.  Hosts without outcomes stand at their
parent's posterior.

Null urls, or urls without "://", have empty host and path; such pages share the empty host.  Repeated pages are rows of
their own.  Null outcomes are no outcomes.  Empty tables: no outcomes allow all, no pages give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordferry.llm.common import join_counted, saved

#: (rule, verdict); a rule is a host and a path prefix.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Public suffixes of two labels, under which names are registered.
SUFFIXES = tuple("""
co.uk org.uk ac.uk gov.uk me.uk ltd.uk plc.uk net.uk sch.uk nhs.uk com.au net.au org.au edu.au gov.au id.au co.nz org.nz net.nz
ac.nz govt.nz co.jp or.jp ne.jp ac.jp go.jp co.kr or.kr ne.kr go.kr com.cn net.cn org.cn gov.cn edu.cn com.tw org.tw edu.tw
com.hk org.hk com.sg edu.sg com.my com.ph com.vn com.pk co.id or.id co.th in.th co.in net.in org.in gov.in ac.in com.tr org.tr
com.br net.br org.br gov.br com.mx org.mx gob.mx com.ar com.co com.pe com.ve com.uy com.ec co.za org.za com.ng co.ke com.eg
com.sa co.il org.il ac.il com.pl net.pl org.pl com.ua com.ru com.gr com.pt com.es
""".split())
ADDRESS = r"^([0-9]+(\.[0-9]+){3}|\[.*\])$"
LIMIT, Z = 0.5, 1.645
STRENGTH = (0.5, 1000.0)
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.lit(2147483647))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), CAPITALS, CAPITALS.lower())
    return F.when(F.instr(url, "://") > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.lit(2147483647))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null.  `rules` is a policy list, compiled into one expression."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        on, _, under = rule.partition("/")
        fits = ((host == on) | F.endswith(host, F.lit(f".{on}"))) & F.startswith(path, F.lit(f"/{under}"))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    address, two = bare.rlike(ADDRESS), F.substring_index(bare, ".", -2)
    long = two.isin(*SUFFIXES)
    suffix = F.when(address, "address").when(long, two).otherwise(F.substring_index(bare, ".", -1))
    return suffix, F.when(address, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(two)


def _mean(bad: str, n: str, k: float, parent: str) -> Column:
    return (F.col(bad) + F.lit(k) * F.col(parent)) / (F.col(n) + F.lit(k))


def strength(level: DataFrame, bad: str, n: str, parent: str) -> float:
    """k of the beta prior from one row of sums: E[(p - m)^2] = m (1 - m) (1/n + (1 - 1/n) / (k + 1)), weighted by n."""
    m, rate = F.col(parent), F.col(bad) / F.col(n)
    noise = m * (1 - m)
    row = level.filter(F.col(n) > 0).agg(F.sum(F.col(n) * (rate - m) ** 2), F.sum(noise), F.sum((F.col(n) - 1) * noise)).first()
    spread, base, room = (float(x or 0.0) for x in row)
    excess = spread - base
    if excess <= 0 or room <= 0:
        return STRENGTH[1]
    return min(max(room / excess - 1, STRENGTH[0]), STRENGTH[1])


def reputation(hosts: DataFrame) -> DataFrame:
    """host, mean, sd, low from `hosts` (host, bad, n), one row per host; bad of the n labelled outcomes are bad.

    Sums per domain and suffix are pre-aggregated and joined back to hosts, never to pages.
    """
    suffix, domain = suffix_and_domain(F.col("host"))
    named = hosts.select("host", "bad", "n", suffix.alias("suffix"), domain.alias("domain"))
    # one domain lies in one suffix, one host in one domain, so each level is summed from the one below
    domains = saved(named.groupBy("domain", "suffix").agg(F.sum("bad").alias("d_bad"), F.sum("n").alias("d_n"), F.count("*").alias("hosts")))
    suffixes = domains.groupBy("suffix").agg(F.sum("d_bad").alias("s_bad"), F.sum("d_n").alias("s_n"), F.count("*").alias("domains"))
    bad, n, n_hosts, n_domains = domains.agg(F.sum("d_bad"), F.sum("d_n"), F.sum("hosts"), F.count("*")).first()
    overall = (bad + 0.5) / (n + 1.0) if n else 0.0
    suffixes = suffixes.withColumn("all_mean", F.lit(float(overall)))
    suffixes = suffixes.withColumn("s_mean", _mean("s_bad", "s_n", strength(suffixes, "s_bad", "s_n", "all_mean"), "all_mean"))
    # a suffix may hold most domains, a domain most hosts
    domains = saved(join_counted(domains, suffixes.select("suffix", "domains", "s_mean"), "suffix", "domains", n_domains or 0))
    domains = domains.withColumn("d_mean", _mean("d_bad", "d_n", strength(domains, "d_bad", "d_n", "s_mean"), "s_mean"))
    named = saved(join_counted(named, domains.select("domain", "hosts", "d_mean"), "domain", "hosts", n_hosts or 0))
    k = F.lit(strength(named, "bad", "n", "d_mean"))
    a, b = k * F.col("d_mean") + F.col("bad"), k * (1 - F.col("d_mean")) + F.col("n") - F.col("bad")
    shaped = named.select("host", a.alias("a"), b.alias("b"))
    mean, total = F.col("a") / (F.col("a") + F.col("b")), F.col("a") + F.col("b")
    sd = F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
    return shaped.select("host", mean.alias("mean"), sd.alias("sd"), (mean - F.lit(Z) * sd).alias("low"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, low for every page.  `outcomes` (page_id, bad 0/1) may cover some pages only."""
    rows = pages.select(pages["page_id"], host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path"))
    known = outcomes.filter("bad is not null and page_id is not null").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    hosts = saved(rows.select("page_id", "host").join(known, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("bad").alias("n"), F.count("*").alias("pages")))
    total = hosts.agg(F.sum("pages")).first()[0] or 0
    found = saved(hosts.select("host", "pages").join(reputation(hosts), "host"))
    judged = join_counted(rows, found.select("host", "pages", "low"), "host", "pages", total)
    rule = rule_for(F.col("host"), F.col("path"), rules)
    verdict = F.when(F.col("low") > F.lit(limit), "block").otherwise("allow")
    for name, says in rules:
        verdict = F.when(F.col("rule") == name, says).otherwise(verdict)
    return judged.withColumn("rule", rule).withColumn("verdict", verdict).select(
        "page_id", "host", "path", "rule", "verdict", "low")
