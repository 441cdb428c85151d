"""Candidates from the HTML of alert mails (op ids P1, P2, W4)."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import identifiers as ids
from ..functions import text as tx

# Elements that have no end tag.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ROWS = "mail_uid string, ord int, anchor string, href string, context string, snippet string"


class _Tree(HTMLParser):
    """A tree of elements, each a list [tag, attributes, children, parent]; texts are strings."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = ["", {}, [], None]
        self.at = self.root

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs), [], self.at]
        self.at[2].append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node[0] != tag:
            node = node[3]
        if node is not None and node[3] is not None:
            self.at = node[3]

    def handle_data(self, data):
        self.at[2].append(data)


def _text(node) -> str:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            stack.extend(reversed(x[2]))
    return " ".join(" ".join(out).split())


def anchors(html: str) -> list[tuple[str, str, str, str]]:
    """(text, href, text of the parent, text of the element after the parent) of every link in document order."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    out, stack = [], [tree.root]
    while stack:
        node = stack.pop()
        if node[0] == "a" and node[1].get("href"):
            parent = node[3]
            above = parent[3]
            after = ""
            if above is not None:
                kin = [c for c in above[2] if not isinstance(c, str)]
                i = next(k for k, c in enumerate(kin) if c is parent)
                after = _text(kin[i + 1]) if i + 1 < len(kin) else ""
            out.append((_text(node), node[1]["href"], _text(parent), after))
        stack.extend(c for c in reversed(node[2]) if not isinstance(c, str))
    return out


def candidates(mails: DataFrame) -> DataFrame:
    """Candidates of (mail_uid, body_html): links with a target whose text may be a title, first of equal titles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(uid, i, *a) for uid, html in zip(pdf["mail_uid"], pdf["body_html"], strict=True) if html for i, a in enumerate(anchors(html))]
            yield pd.DataFrame(rows, columns=["mail_uid", "ord", "anchor", "href", "context", "snippet"])

    links = mails.select("mail_uid", "body_html").mapInPandas(run, _ROWS)
    target = F.coalesce(ids.unwrapped(F.col("href")), F.col("href"))
    bare = F.trim(F.regexp_replace("anchor", r"(?i)^\s*\[(html|pdf)\]\s*", ""))
    rows = links.select("mail_uid", "ord", bare.alias("raw_title"), F.when(ids.unwrapped(F.col("href")).isNotNull(), F.col("href")).alias("scholar_wrapper_url"), target.alias("target_url"), tx.resource_type(F.col("anchor"), target).alias("resource_type_hint"), "context", "snippet", tx.snippet_parts(F.col("snippet")).alias("s"))
    kept = rows.where(tx.plausible_title(F.col("raw_title")) & F.col("target_url").rlike("(?i)^https?://"))
    firsts = kept.groupBy("mail_uid", F.lower("raw_title").alias("low")).agg(F.min_by(F.struct(*kept.columns[1:]), "ord").alias("x"))
    place = F.row_number().over(Window.partitionBy("mail_uid").orderBy("x.ord"))  # among the links of one mail
    flat = firsts.select("mail_uid", place.alias("candidate_index_in_mail"), "x.*")
    return flat.select(ids.candidate_id(F.col("mail_uid"), F.col("candidate_index_in_mail"), F.col("raw_title")).alias("candidate_id"), "mail_uid", "candidate_index_in_mail", "raw_title", F.col("s.authors").alias("raw_authors"), F.col("context").alias("raw_source_text"), F.col("target_url").alias("raw_link"), F.col("snippet").alias("raw_snippet"), "scholar_wrapper_url", "target_url", "resource_type_hint", F.col("s.venue").alias("venue_guess"), F.col("s.year").alias("year_guess"))
