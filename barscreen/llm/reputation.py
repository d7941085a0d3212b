"""URL filter: rules first, then empirical-Bayes reputation of hosts.

Labelled pages give each host a number of bad outcomes. Few hosts have many labelled pages, so
their rates are shrunk: the suffix towards the overall rate, the registered domain towards its
suffix, the host towards its domain. How far is learned: the beta-binomial correlation of the
children of each level, by moments over all of them. A host is blocked if even the lower bound
of its posterior bad rate exceeds the limit. The bound is no tighter than the pages of the whole
domain and the prior of the domain allow, so that a few pages block no host.

Everything is DataFrame functions. Tables shrink to one row a host before any join but the one
with labels; the last join, pages to hosts, splits a host with many pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barscreen.llm.common import attach, staged

#: Under a country's two letters these names are public suffixes (co.nz, ac.uk, com.cn, ...).
#: Registries differ in more than that; a table of suffixes can be given instead.
CATEGORIES = (
    "ac", "asn", "biz", "co", "com", "ed", "edu", "firm", "gen", "go", "gob", "gouv", "gov", "govt", "gv", "id",
    "ind", "info", "int", "k12", "ltd", "me", "mi", "mil", "name", "ne", "net", "nhs", "nic", "nom", "or", "org",
    "plc", "pro", "res", "sch", "school", "web",
)
CATEGORY_SUFFIX = rf"^(.*\.)?({'|'.join(CATEGORIES)})\.[a-z][a-z]$"
#: Limits of a level's learned correlation, so that its prior weighs 1 to 999 pages.
LEAST, MOST = 0.001, 0.5
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def levels(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Adds `suffix` and `domain` (the registered one) to a table of distinct `host`s.

    A host's suffix is its longest ending in `suffixes` (a table with a column `suffix`, without
    wildcards), else its last label, or two by CATEGORIES if no table is given. The domain has one
    label more; a host that is a suffix is its own domain. A port is no part of them, a numeric
    address is its own domain and suffix, an empty host has empty ones.
    """
    name = F.regexp_replace("host", ":[0-9]*$", "")
    labels = F.split(name, r"\.")
    if suffixes is None:
        hosts = hosts.withColumn("_wide", F.when(name.rlike(CATEGORY_SUFFIX), 2).otherwise(1))
    else:
        known = staged(suffixes.select(F.col("suffix").alias("_ending")).distinct(), "suffixes")
        width = F.explode(F.sequence(F.lit(1), F.size(labels)))
        endings = hosts.select("host", labels.alias("_labels"), width.alias("_size"))
        endings = endings.withColumn("_ending", F.array_join(F.slice("_labels", -F.col("_size"), F.col("_size")), "."))
        found = attach(endings, known, ["_ending"], "inner").groupBy("host").agg(F.max("_size").alias("_wide"))
        hosts = hosts.join(found, "host", "left").fillna(1, ["_wide"])

    def ending(wide: Column) -> Column:
        return F.array_join(F.slice(labels, F.greatest(F.size(labels) - wide + 1, F.lit(1)), wide), ".")

    number = name.rlike(r"^[0-9.]+$")
    return hosts.withColumns({
        "suffix": F.when(number, name).otherwise(ending(F.col("_wide"))),
        "domain": F.when(number, name).otherwise(ending(F.col("_wide") + 1)),
    }).drop("_wide")


def _correlation(children: DataFrame, mean: str) -> float:
    """Correlation of outcomes within a child, by moments: the excess of the squared deviations
    of counts over what independent pages would give."""
    m = F.col(mean)
    row = children.agg(
        F.sum((F.col("k") - F.col("n") * m) ** 2 / (m * (1 - m))).alias("seen"),
        F.sum("n").alias("alone"),
        F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"),
    ).first()
    if not row.pairs:
        return MOST
    return min(MOST, max(LEAST, (row.seen - row.alone) / row.pairs))


def posteriors(hosts: DataFrame, z: float = 1.645, suffixes: DataFrame | None = None) -> DataFrame:
    """(host, n, k, bad_rate, lower_bound) of (host, n labelled pages, k bad of them)."""
    known = staged(levels(hosts, suffixes), "hosts")
    domains = staged(known.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "domains")
    tops = staged(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "tops")
    total = tops.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    overall = (total.k + 1.0) / (total.n + 2.0)

    def shrunk(children: DataFrame, parent: str) -> tuple[DataFrame, Column, Column]:
        weight = F.lit(1.0 / _correlation(children, parent) - 1.0)
        size = F.col("n") + weight
        return children, (F.col("k") + weight * F.col(parent)) / size, size

    rows, mean, _ = shrunk(tops.withColumn("overall", F.lit(overall)), "overall")
    upper = staged(rows.select("suffix", mean.alias("suffix_rate")), "suffix_rates")
    rows, mean, size = shrunk(attach(domains, upper, ["suffix"]), "suffix_rate")
    upper = rows.select("domain", "suffix", mean.alias("domain_rate"), size.alias("domain_size"))
    upper = staged(upper, "domain_rates")
    rows, mean, size = shrunk(attach(known, upper, ["suffix", "domain"]), "domain_rate")
    # The domain's rate is an estimate too, and of a lone host from the same pages.
    size = F.least(size, F.col("domain_size"))
    return rows.withColumn("bad_rate", mean).select(
        "host", "n", "k", "bad_rate",
        (F.col("bad_rate") - z * F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (size + 1))).alias("lower_bound"),
    )


def rules_of(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules) for hosts under a rule's host: structs, the longest rule first; of equally
    long ones the longer host, then allow. A row holds the rules of one host's own names."""
    labels = F.split("host", r"\.")
    above = hosts.select("host", F.explode(F.expr("sequence(1, size(split(host, '[.]')))")).alias("at"))
    above = above.select("host", F.array_join(F.slice(labels, F.col("at"), F.size(labels)), ".").alias("rule_host"))
    ranked = rules.select(
        "rule_host",
        F.struct(
            (-F.length(F.concat("rule_host", "rule_path"))).alias("size"), (-F.length("rule_host")).alias("host_size"),
            F.col("verdict"), F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_path"),
        ).alias("found"),
    )
    return attach(above, staged(ranked, "rules"), ["rule_host"], "inner").groupBy("host").agg(
        F.array_sort(F.collect_set("found")).alias("rules")
    )


def judged(
    pages: DataFrame, outcomes: DataFrame, rules: DataFrame, limit: float = 0.5, z: float = 1.645,
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_rate, lower_bound) of every page.

    `outcomes` are (page_id, bad), null outcomes are passed over and repeated ones count each;
    `rules` are (rule_host, rule_path, verdict), `suffixes` public suffixes (see `levels`). Pages may repeat; null urls and urls without
    `://` have an empty host, which is judged like any other. Other columns are left out.
    """
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    cut = staged(cut, "urls")
    seen = outcomes.where(F.col("bad").isNotNull()).groupBy("page_id").agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("k")
    )
    hosts = cut.join(seen, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")
    )
    known = staged(posteriors(hosts, z, suffixes), "posteriors")
    known = staged(known.join(rules_of(known, rules), "host", "left"), "judged_hosts")
    rows = attach(cut, known.select("host", "rules", "bad_rate", "lower_bound"), ["host"])
    fits = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r.rule_path)), F.lit(0))
    rows = rows.withColumn("found", fits)
    return rows.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(
            F.col("found.verdict"), F.when(F.col("lower_bound") > limit, "block").otherwise("allow")
        ).alias("verdict"),
        "bad_rate", "lower_bound",
    )


# The comparison SQL: (1) the address, (2) counts a host, (3) moments and rates level by level.
_MOMENTS = (
    "SELECT least(0.5, greatest(0.001, coalesce((sum((k - n * m) ** 2 / (m * (1 - m))) - sum(n))"
    " / nullif(sum(n * (n - 1)), 0), 0.5))) AS rho FROM {0}"
)
SQL = f"""
WITH cut AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '{ADDRESS}', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '{ADDRESS}', 2), '') AS path
  FROM pages),
seen AS (SELECT doc_id, count(*) AS n, sum((quality = 0 OR toxic = 1)::INT) AS k FROM labels
  WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
counted AS (SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(k), 0)::DOUBLE AS k
  FROM cut LEFT JOIN seen ON doc_id = page_id GROUP BY host),
named AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name, split(name, '.') AS l,
    regexp_matches(name, '{CATEGORY_SUFFIX}') AS two,
    regexp_matches(name, '^[0-9.]+$') AS num FROM counted),
known AS (SELECT host, n, k,
    CASE WHEN num THEN name WHEN two THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix,
    CASE WHEN num THEN name WHEN two THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain
  FROM named),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k, ((SELECT sum(k) FROM known) + 1.0) / ((SELECT sum(n) FROM known) + 2.0) AS m
  FROM known GROUP BY suffix),
sr AS ({_MOMENTS.format("s")}),
su AS (SELECT suffix, (k + (1 / rho - 1) * m) / (n + (1 / rho - 1)) AS m FROM s, sr),
d AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM known JOIN su USING (suffix) GROUP BY ALL),
dr AS ({_MOMENTS.format("d")}),
du AS (SELECT suffix, domain, n + (1 / rho - 1) AS held, (k + (1 / rho - 1) * m) / held AS m FROM d, dr),
h AS (SELECT host, n, k, m, held FROM known JOIN du USING (suffix, domain)),
hr AS ({_MOMENTS.format("h")}),
p AS (SELECT host, (k + (1 / rho - 1) * m) / (n + (1 / rho - 1)) AS bad_rate,
    bad_rate - 1.645 * sqrt(bad_rate * (1 - bad_rate) / (least(n + (1 / rho - 1), held) + 1)) AS lower_bound FROM h, hr),
r(rh, rp, v) AS (VALUES {{rules}}),
fits AS (SELECT page_id, url_host, url_path, arg_min(struct_pack(rule := rh || rp, v := v), (-length(rh || rp), -length(rh), v)) AS f
  FROM (SELECT DISTINCT page_id, host AS url_host, path AS url_path FROM cut)
  JOIN r ON (url_host = rh OR ends_with(url_host, '.' || rh)) AND starts_with(url_path, rp) GROUP BY ALL)
SELECT cut.page_id, cut.host, cut.path, f.rule AS rule,
  coalesce(f.v, CASE WHEN lower_bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  round(bad_rate, 6) + 0.0 AS bad_rate, round(lower_bound, 6) + 0.0 AS lower_bound
FROM cut JOIN p USING (host) LEFT JOIN fits
  ON fits.page_id IS NOT DISTINCT FROM cut.page_id AND url_host = cut.host AND url_path = cut.path
"""
