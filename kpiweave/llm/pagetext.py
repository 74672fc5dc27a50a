"""Main text of pages by a site style tree.

The DOMs of a host's pages are merged: nodes with the same path of styles (tag and class) are one
node of the host's tree. Over the distinct pages of the host that hold a node,

* a *content* node is as important as the entropy of the contents it shows (log base: the number
  of pairs of page and content): the same notice everywhere says nothing, ever new text is what the site is
  for;
* a *presentation* node is as important as the entropy of the child styles it shows;
* a *branch* has ``1 - GAMMA`` times the importance of its own presentation plus ``GAMMA`` times the
  mean importance of the contents below it.

Branches of low importance are removed from every page, as is what HTML itself names as no part of
an article (menus, forms, scripts, comments ...). An article or main element is evidence beside the
tree:

* the element itself and what it stands in are not removed, only branches inside it; and these not
  if they make up most of its text, so an article that a host shows on many pages stays one;
* text outside of it goes with the rest of the page, unless what the tree leaves outside is more
  than what it leaves inside: then the element is a teaser or the like, and both stay.

The tree is a table keyed by host and path, built by partial aggregates. Pages meet it through
thin rows, and only pages that lose a branch are shuffled with their html.

Defined results: a null page is empty and gives an empty text; pages without a host (null or odd
urls) and nodes seen on fewer than ``LEAST_PAGES`` different pages are not judged by the tree; equal
pages of a host count once in it, and so do equal contents of a node within a page.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm import bloom
from kpiweave.llm.common import stored, text_key
from kpiweave.llm.dom import Block, blocks

GAMMA = 0.9
LEAST_PAGES = 5
LOW = 0.4
STEP = 200  # pages handled together


def host(url: str = "url"):
    """The host of a url in lower case; empty if there is none."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(found)


def _hash(text: str) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(text)).view(np.int64))


def _path(path: tuple[str, ...]) -> int:
    return _hash("\x1f".join(path))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, row_key, kind, path, value, n, paths) of each page: its contents (kind 0), the
    child styles of its elements (1), the branches the tree may remove from it (2); and, once per
    batch, the branches above each content path (3). ``n`` is 1 in one of the rows that a page has
    for a path and a kind, so that its sum counts pages."""
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    kinds.append(pa.list_(pa.int64()))
    names = ["host", "row_key", "kind", "path", "value", "n", "paths"]
    for batch in batches:
        for i in range(0, batch.num_rows, STEP):
            part = batch.slice(i, STEP)
            rows: list[tuple] = []
            above: dict[tuple, list[int]] = {}
            for name, key, html in zip(*part.to_pydict().values(), strict=True):
                found, elements = blocks(html or "")
                texts: dict[tuple, dict[str, None]] = {}
                for b in found:
                    texts.setdefault(b.path, {})[b.text] = None
                for path in texts:
                    if path not in above:
                        above[path] = [_path(path[:k]) for k in _ends(path)]
                shown: dict[tuple, list[str]] = {}
                for path, style in elements:
                    shown.setdefault(path, []).append(style)
                rows += [
                    (name, key, 0, _path(path), _hash(text), int(k == 0), None)
                    for path, own in texts.items()
                    for k, text in enumerate(own)
                ]
                rows += [
                    (name, key, 1, _path(path), _hash(" ".join(styles)), 1, None)
                    for path, styles in shown.items()
                ]
                ends = {(b.path, b.article) for b in found if not b.foreign}
                branches = {h for p, article in ends for h in _judged(above[p], p, article)}
                rows.append((name, key, 2, None, None, None, sorted(branches)))
            rows += [(None, None, 3, _path(p), None, None, up) for p, up in above.items()]
            columns = zip(*rows) if rows else [()] * 7
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.record_batch(arrays, names=names)


def _ends(path: tuple[str, ...]) -> range:
    """Lengths of the branches that may be removed: never the document or its body."""
    return range(min(3, len(path)), len(path) + 1)


def _judged(above: list, path: tuple[str, ...], article: int) -> list:
    """Of the branches ``above`` a path, those inside its nearest article element."""
    return above[max(0, article + 1 - _ends(path).start) :] if article else above


def site_nodes(pages: DataFrame) -> DataFrame:
    keyed = pages.select(host().alias("host"), text_key("html").alias("row_key"), "html")
    return keyed.where("host <> '' AND html IS NOT NULL").mapInArrow(
        _nodes,
        "host string, row_key bigint, kind int, path bigint, value bigint, n bigint,"
        " paths array<bigint>",
    )


def style_tree(nodes: DataFrame) -> DataFrame:
    """host, path, importance: every branch of every host's tree, from ``site_nodes``."""
    own = ["host", "path", "kind", "value"]
    once = nodes.where("kind < 2").groupBy(*own, "row_key").agg(F.max("n").alias("first"))
    values = once.groupBy(*own).agg(F.count("*").alias("n"), F.sum("first").alias("pages"))
    log = F.col("n") * F.log(F.col("n").cast("double"))
    summed = values.groupBy("host", "path", "kind").agg(
        F.sum("n").cast("double").alias("n"), F.sum(log).alias("nlogn"), F.sum("pages").alias("pages")
    )
    # The entropy of shares n_i / N, log base N, is 1 - (sum n_i log n_i) / (N log N).
    entropy = F.round(1 - F.col("nlogn") / (F.col("n") * F.log("n")), 9)
    judged = summed.withColumn("i", F.when(F.col("pages") >= LEAST_PAGES, entropy).otherwise(1.0))
    up = nodes.where("kind = 3").select("path", "paths").distinct()
    leaves = judged.where("kind = 0").join(up, "path")
    below = leaves.select("host", F.explode("paths").alias("path"), "n", "i").groupBy(
        "host", "path"
    ).agg((F.sum(F.col("i") * F.col("n")) / F.sum("n")).alias("below"))
    shown = judged.where("kind = 1").select("host", "path", F.col("i").alias("own"))
    both = below.join(shown, ["host", "path"], "left")
    importance = (1 - GAMMA) * F.coalesce("own", "below") + GAMMA * F.col("below")
    return both.select("host", "path", importance.alias("importance"))


def _chars(found: list[Block]) -> int:
    return sum(len(b.text) for b in found)


def _chosen(found: list[Block], low: frozenset[int]) -> list[str]:
    """The blocks outside foreign elements and low branches, with article elements as evidence."""
    own = kept = [b for b in found if not b.foreign]
    if low:
        known: dict[tuple, bool] = {}
        for b in own:
            if (b.path, b.article) not in known:
                above = [_path(b.path[:k]) for k in _ends(b.path)]
                known[b.path, b.article] = low.isdisjoint(_judged(above, b.path, b.article))
        kept = [b for b in own if known[b.path, b.article]]
    article = [b for b in own if b.article]
    inside = [b for b in kept if b.article]
    if 2 * _chars(inside) < _chars(article):
        inside, kept = article, [b for b in own if b.article or known[b.path, b.article]]
    if inside and 2 * _chars(inside) >= _chars(kept):
        kept = inside
    return [b.text for b in kept]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, STEP):
            part = batch.slice(i, STEP)
            texts = []
            for html, low in zip(part.column("html"), part.column("low"), strict=True):
                found, _ = blocks(html.as_py() or "")
                texts.append("\n".join(_chosen(found, frozenset(low.as_py() or ()))))
            columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
            yield pa.record_batch(columns, names=["page_id", "url", "text"])


def _known_to(filter_, yes: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(bloom.has(filter_.value, keys) == yes))

    return rows


def extract(pages: DataFrame, low: float = LOW) -> DataFrame:
    """page_id, url, text of every page (page_id, url, html)."""
    nodes = stored(site_nodes(pages), "site-nodes")
    tree = stored(style_tree(nodes), "style-tree")
    dull = tree.where(F.col("importance") < low).select("host", "path")
    open_ = nodes.where("kind = 2").select("host", "row_key", F.explode("paths").alias("path"))
    hit = open_.distinct().join(dull, ["host", "path"]).groupBy("host", "row_key")
    lost = stored(hit.agg(F.collect_list("path").alias("low")), "lost-branches")
    keyed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text_key("html").alias("row_key"),
        host().alias("host"),
        "html",
    )
    # Only pages that lose a branch (and the few the filter mistakes for such) are shuffled.
    kind = "page_id bigint, url string, row_key bigint, host string, html string"
    filter_ = pages.sparkSession.sparkContext.broadcast(bloom.build(lost, "row_key"))
    whole = keyed.mapInArrow(_known_to(filter_, False), kind)
    whole = whole.withColumn("low", F.lit(None).cast("array<bigint>"))
    cut = keyed.mapInArrow(_known_to(filter_, True), kind).join(lost, ["host", "row_key"], "left")
    return whole.unionByName(cut).mapInArrow(_texts, "page_id bigint, url string, text string")


def report(pages: DataFrame) -> DataFrame:
    text = F.col("text")
    return extract(pages).withColumn("n_chars", F.length(text).cast("bigint"))
