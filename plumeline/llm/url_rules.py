"""URL rules and their spread over redirects and canonical links.

A url takes the longest rule on its host or a parent domain whose path it starts with.  Urls that
name the same page, by a redirect or a canonical link, are connected components of
those edges; a url without a rule takes over what a rule says of an alias, and an
explicit allow of any alias goes before every block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urldefrag, urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline.llm import html_text
from plumeline.llm.common import Scratch, components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
REFRESH = re.compile(r"\s*[\d.]*\s*[;,]\s*url\s*=\s*['\"]?([^'\"]+)", re.I)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A url as a node of the graph: without fragment, scheme and host in lower case."""
    bare = F.regexp_extract(url, r"^[^#]*", 0)
    at = F.instr(bare, "://")
    head = F.length(F.regexp_extract(F.substring(bare, at + 3, F.length(bare)), r"^[^/?]*", 0))
    upto = at + 2 + head
    lowered = F.concat(F.translate(F.substring(bare, F.lit(1), upto), UPPER, LOWER), F.substring(bare, upto + 1, F.length(bare)))
    return F.when(at > 0, lowered).otherwise(bare)


def _head_tags(page: str) -> Iterator[html_text.Node]:
    """``base``, ``link`` and ``meta`` elements of a page's head, whether its tags are written or left out."""
    open_nodes = [html_text.parse(page)]
    while open_nodes:
        node = open_nodes.pop()
        if node.tag in ("base", "link", "meta"):
            yield node
        elif node.tag in ("html", "head"):
            open_nodes += [c for c in reversed(node.children) if isinstance(c, html_text.Node)]


def links_of(page: str, url: str) -> list[str]:
    """Targets of canonical links and of refreshes in a page's head, resolved against its first ``base`` or its url."""
    found: list[str] = []
    base = None
    for node in _head_tags(page):
        fields, target = node.fields, None
        if node.tag == "base":
            base = base or fields.get("href", "").strip() or None
        elif node.tag == "link" and "canonical" in fields.get("rel", "").lower().split():
            target = fields.get("href")
        elif node.tag == "meta" and fields.get("http-equiv", "").lower() == "refresh":
            match = REFRESH.match(fields.get("content", ""))
            target = match and match[1]
        if target and target.strip():
            found.append(target.strip())
    resolved = []
    for target in found:
        try:
            resolved.append(urldefrag(urljoin(urljoin(url, base) if base else url, target))[0])
        except ValueError:  # not a url
            continue
    return resolved


def _page_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(u, v) for u, page in zip(batch["url"].to_pylist(), batch["html"].to_pylist()) for v in links_of(page, u)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["u", "v"])


def page_edges(pages: DataFrame) -> DataFrame:
    """``(u, v)``: page url and the url it redirects to or calls canonical.  Only pages whose
    text names either are parsed."""
    named = pages.select("url", "html").where("url is not null and html is not null")
    return named.where(F.col("html").rlike("(?i)canonical|refresh")).mapInArrow(_page_links, "u string, v string")


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls (…, host, path)`` with ``rule`` and ``rule_verdict``, null where none fits.

    ``rules (host, path, verdict)`` may be a long table, also for a single host: beginnings of the distinct
    paths, of the lengths that rules on the host's domains have, meet the rules by an equi-join.  A url that
    fills a third of the table is looked up once.  Of equally long rules an allow goes first, then the greater text.
    """
    named = rules.select(F.col("host").alias("domain"), F.col("path").alias("prefix"), "verdict")
    # One number per length in use: bounded by the longest path of a rule.
    lengths = named.groupBy("domain").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    places = urls.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    wide = places.select("host").distinct().withColumn("domain", F.explode(domains)).join(lengths, "domain")
    wide = wide.select("host", "domain", F.explode("lengths").alias("n"))
    asked = places.join(wide, "host").where(F.col("n") <= F.length("path")).select(
        "host", "path", "domain", F.substring("path", F.lit(1), F.col("n")).alias("prefix")
    )
    rule = F.concat("domain", "prefix")
    entry = F.struct(F.length(rule).alias("length"), (F.col("verdict") == "allow").alias("allow"), rule.alias("rule"), "verdict")
    fitting = asked.join(named, ["domain", "prefix"]).groupBy("host", "path").agg(F.max(entry).alias("_best"))
    return urls.join(fitting, ["host", "path"], "left").select(
        *urls.columns, F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("rule_verdict")
    )


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Verdict of every page's url: ``page_id, host, path, rule, verdict, alias_verdict``.

    ``pages`` needs ``page_id, url, html``, ``rules`` ``host, path, verdict``; ``redirects (u, v)``
    are more edges.  ``verdict`` is the rule's; without a rule an alias's (allow before block);
    else allow.  Null urls and urls without ``://`` have no host and no path, fit no rule and
    are allowed unless an alias decides; repeated rows are judged each; no rows give no rows.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.union(redirects.select("u", "v"))
    edges = edges.where("u is not null and v is not null").select(node_of(F.col("u")).alias("u"), node_of(F.col("v")).alias("v"))
    groups = scratch.save(components(edges, scratch))
    urls = groups.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))})
    ruled = apply_rules(urls, rules)
    said = ruled.groupBy("component").agg(
        F.max(F.col("rule_verdict") == "allow").alias("allowed"), F.max(F.col("rule_verdict") == "block").alias("blocked")
    )
    alias = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block")
    aliases = groups.join(said.select("component", alias.alias("alias_verdict")).where("alias_verdict is not null"), "component")
    aliases = aliases.select(F.col("node").alias("_alias"), "alias_verdict")
    parsed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = apply_rules(parsed, rules)
    judged = judged.join(aliases, node_of(F.col("url")) == F.col("_alias"), "left")
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", "alias_verdict", F.lit("allow")).alias("verdict"), "alias_verdict",
    )
