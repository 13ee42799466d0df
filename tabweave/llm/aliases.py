"""URL filters with redirect equivalence.

A url is judged by the longest rule that fits its host and path. Pages name other addresses of themselves by
canonical links and by refreshing to them; these edges are contracted to components by repeated distributed
rounds, and a block decision on any address of a component, whether it is a page here or only a target, reaches all
its aliases. A rule that fits an alias itself comes first, so an explicit allow is not overruled.

Addresses are compared without fragment, scheme and host in lower case (A-Z). Links are read from `link` and `meta`
elements outside comments, scripts and the like, resolved against the page's url or its `base`. Nodes are 128-bit
hashes of addresses. Links, components and verdicts stay in tables; only rules, at most `MOST_RULES`, are literals.

Edge cases: a null url or one without `://` has empty host and path, no rule and no aliases (allow); null html
has no links; links to nowhere, to the page itself or that cannot be resolved are none; rows that repeat are
judged each; rules of equal length that both fit: allow before block; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import ascii_lower, bounded, sliced, stored, table
from tabweave.llm.components import components

MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """What happens to a host with its subdomains, where the path starts so."""
    verdict: str
    host: str
    path: str = "/"

    def __str__(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What two urls of one address have in common; null where there is none."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(ascii_lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1)), F.lit("://"), host_of(url), rest))


def node(url: Column) -> Column:
    return F.unhex(F.md5(address(url)))


def fitting(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The rule that fits, as struct<rule, verdict>; null where none does."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(str(r)), r.verdict == "allow")):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(str(rule)).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


#: Elements whose content is no markup are passed over as a whole; of the others link, meta and base count.
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template)\b.*?(?:</\1|\Z)|<(link|meta|base)\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)", re.I | re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_REFRESH = re.compile(r"\s*[\d.]*\s*[;,]?\s*url\s*=\s*(?:\"([^\"]*)|'([^']*)|(\S+))", re.I)


def targets(url: str, html: str) -> list[str]:
    """Absolute urls that a page gives as its canonical address or sends its readers to."""
    base, found = url, []
    for match in _MARKUP.finditer(html):
        if not match[2]:
            continue
        attributes: dict[str, str] = {}
        for name, *values in _ATTRIBUTE.findall(match[3]):
            attributes.setdefault(name.lower(), entities.unescape("".join(values)).strip())
        kind = match[2].lower()
        if kind == "base":
            base = _joined(url, attributes.get("href")) or base
        elif kind == "link" and "canonical" in attributes.get("rel", "").lower().split():
            found.append(attributes.get("href"))
        elif kind == "meta" and attributes.get("http-equiv", "").lower() == "refresh" and (to := _REFRESH.match(attributes.get("content", ""))):
            found.append(to[1] or to[2] or to[3])
    return [to for href in found if (to := _joined(base, href))]


def _joined(base: str, href: str | None) -> str | None:
    try:
        out = urljoin(base, href.strip()) if href else ""
    except ValueError:  # a malformed host
        return None
    return out if "://" in out else None


def edges(pages: DataFrame) -> DataFrame:
    """pages: url, html. Returns url and target, both absolute, a row a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(url, to) for url, html in sliced(batch, 0, 1) for to in targets(url, html)]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.string()) for i in range(2)], ["url", "target"])
    some = pages.where(F.contains("url", F.lit("://")) & F.col("html").rlike("(?i)canonical|http-equiv")).select("url", "html")
    return some.mapInArrow(run, "url string, target string")


def blocked_aliases(links: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """links: url, target. Returns the nodes of all components that have a blocked address, as `alias`."""
    def blocked(url: str) -> Column:
        return F.coalesce(fitting(host_of(F.col(url)), path_of(F.col(url)), rules)["verdict"] == "block", F.lit(False))
    ends = stored(links.select(node(F.col("url")).alias("a"), node(F.col("target")).alias("b"), blocked("url").alias("bad_a"), blocked("target").alias("bad_b")).where("a <> b").distinct(), "edges")
    roots = components(ends.select("a", "b"))
    bad = ends.where("bad_a").select(F.col("a").alias("node")).union(ends.where("bad_b").select(F.col("b").alias("node"))).distinct()
    bad_roots = roots.join(bounded(bad, "blocked"), "node").select("root").distinct()
    return roots.join(bounded(bad_roots, "blocked-roots"), "root").select(F.col("node").alias("alias"))


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """pages: page_id, url, html. Returns page_id, host, path, rule, verdict for every row."""
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node(url).alias("node"))
    rows = rows.withColumn("fits", fitting(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "fits.rule", "fits.verdict", "node")
    aliases = bounded(blocked_aliases(edges(pages), rules), "blocked-aliases")
    free = F.col("rule").isNull() & F.col("node").isNotNull()  # only these take part in the join
    asked = rows.where(free).join(aliases, F.col("node") == F.col("alias"), "left")
    names = ["page_id", "host", "path", "rule"]
    asked = asked.select(*names, F.when(F.col("alias").isNotNull(), "block").otherwise("allow").alias("verdict"))
    return asked.unionByName(rows.where(~free).select(*names, F.coalesce("verdict", F.lit("allow")).alias("verdict")))


def op12_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


OP12_SQL = r"""
WITH RECURSIVE p AS (SELECT page_id, html, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
links AS (SELECT url, unnest(regexp_extract_all(html, '(?i)<link\s+rel="canonical"\s+href="([^"]*://[^"]*)"', 1) || regexp_extract_all(html, '(?i)<meta\s+http-equiv="refresh"\s+content="[0-9]*;\s*url=([^"]*://[^"]*)"', 1)) AS target FROM p),
named AS (SELECT url AS raw FROM links UNION SELECT target FROM links UNION SELECT url FROM p WHERE url LIKE '%://%'),
n AS (SELECT DISTINCT raw, translate(regexp_extract(raw, '(?s)^(.*?://[^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(raw, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS address,
  translate(regexp_extract(raw, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(raw, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM named),
e AS (SELECT a.address AS a, b.address AS b FROM links l JOIN n a ON a.raw = l.url JOIN n b ON b.raw = l.target UNION SELECT b.address, a.address FROM links l JOIN n a ON a.raw = l.url JOIN n b ON b.raw = l.target),
bad AS (SELECT DISTINCT address FROM n WHERE (('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/')) OR (('.' || host) LIKE '%.net' AND starts_with(path, '/') AND NOT (('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/')))),
r AS (SELECT e.b AS address FROM e JOIN bad ON bad.address = e.a UNION SELECT e.b FROM r JOIN e ON e.a = r.address),
ruled AS (SELECT p.*, CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/' WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN EXISTS (SELECT 1 FROM n JOIN r ON r.address = n.address WHERE n.raw = ruled.url) THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""
