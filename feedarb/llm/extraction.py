"""Main text of pages by gradient-boosted trees over DOM nodes.

Trees judge each block element by its tag, the words of its attributes and those around it,
depth, text and tag density of its subtree, links and siblings.  Words and tags go in by how
they lean in the sample.  A page is then decoded as a whole: what is below a rejected element
is rejected, and the set of kept elements with the highest likelihood wins, found from the
leaves up.  So a block is kept only with everything above it.

The trees are fitted on about ``SAMPLE`` pages at most, drawn by the hash of their ids.  No labels are needed:
pages with an ``article`` or ``main`` element say by their own markup which blocks are text
(inside) and which are not (outside, or in nav, aside, footer, form and the like).  To judge
other markup too, the blocks of these pages are also set into ``VARIANTS`` other layouts each,
with the parts that pages have besides their text: menus, sidebars, notices, adverts, forms,
comments.  Without such pages in the table, the markup of the layouts alone is learned.

Null pages are empty; pages without text give an empty text.  Text outside all elements is judged
with the body, so a page of plain text is its own text.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedarb.llm.dom import Page, describe, parse
from feedarb.llm.shared import slices, unit

SAMPLE = 250
VARIANTS = 3
TREES, DEPTH = 20, 4
#: What a kept element gains by each kept child, in log-odds: blocks of a text stand together.
TOGETHER = 0.5

# Words and tags of the layouts; pages in the table add what they use themselves.
_TEXT_SHELLS = (
    "article", "main", "div class=content", "div id=main-content", "div class=post", "section class=post-body",
    "div class=entry-content", "div class=article-body", "div class=story", "main class=page", "div id=article",
    "div itemprop=articleBody class=text", "section class=article", "div role=main", "td class=content",
)
_NEUTRAL_SHELLS = (
    "div", "div class=container", "div class=wrapper", "div id=page", "div class=row", "section", "div class=col",
    "div class=inner", "div id=site", "div class=layout",
)
_BESIDE = (
    "nav", "nav class=menu", "div class=navbar", "ul class=nav", "div id=menu", "div class=breadcrumbs", "ol class=breadcrumb",
    "header", "header class=site-header", "div class=header", "div id=masthead", "footer", "div class=footer", "footer class=site-footer",
    "div class=copyright", "aside", "aside class=sidebar", "div class=sidebar", "div id=sidebar", "div class=widget", "div class=related",
    "section class=related-posts", "div class=recommended", "div class=share", "ul class=social", "div class=social-links",
    "div class=ad", "div class=advert", "div class=advertisement", "div class=ads", "div class=banner", "div class=sponsored",
    "div class=promo", "aside class=promotion", "div id=google_ads", "div class=cookie-notice", "div class=cookie", "div class=consent",
    "div class=notice", "div role=alert class=alert", "div class=popup", "div class=modal", "div class=overlay", "div class=gdpr",
    "form", "form class=search", "form class=newsletter", "div class=subscribe", "form class=login", "div class=signup",
    "section class=comments", "div id=comments", "ol class=comment-list", "div class=comment", "div class=reply", "section class=discussion",
    "div class=reader-comments", "div class=responses", "div class=pagination", "nav class=pager", "div class=toolbar", "div class=tags",
    "div class=disclaimer", "div role=navigation", "div role=banner", "div role=contentinfo", "div role=complementary", "div class=paywall",
)
_MEANT_TEXT = {"article", "main"}
_MEANT_OTHER = {"nav", "aside", "footer", "form", "head", "noscript", "template", "button", "select", "dialog", "menu"}
_OTHER_WORDS = {part.split("=")[1] for shell in _BESIDE for part in shell.split()[1:] if "class" in part or "id=" in part}


def _tag(shell: str) -> tuple[str, str]:
    name, *rest = shell.split()
    return "<" + " ".join([name, *(f'{k}="{v}"' for k, v in (r.split("=") for r in rest))]) + ">", f"</{name}>"


def _beside(draw: random.Random, other: list[str], text: list[str]) -> str:
    """A part besides the text; its blocks are short or as long as those of a text."""
    start, end = _tag(draw.choice(_BESIDE))
    kind = draw.randrange(4)
    if kind == 0:
        parts = "".join(f'<li><a href="#">{html.escape(draw.choice(other))}</a></li>' for _ in range(draw.randint(2, 8)))
        return f"{start}<ul>{parts}</ul>{end}"
    parts = [html.escape(draw.choice(other if kind == 1 else other + text)) for _ in range(draw.randint(1, 4))]
    if kind == 3:
        return f"{start}{parts[0]}{end}"
    tag = draw.choice(("p", "div", "li"))
    return start + "".join(f"<{tag}>{p}</{tag}>" for p in parts) + end


def layout(draw: random.Random, text: list[str], other: list[str]) -> tuple[str, list[str]]:
    """A page with these blocks of text in a layout of its own, and the blocks as they are in it."""
    used = text[: draw.randint(1, 12)]
    inner = []
    for at, block in enumerate(used):
        tag = draw.choice(("h1", "h1", "h2")) if at == 0 else draw.choice(("p",) * 8 + ("h2", "h3", "blockquote", "li", "div", "pre"))
        body = html.escape(block)
        inner.append(f"<ul><li>{body}</li></ul>" if tag == "li" else f"<{tag}>{body}</{tag}>")
        if draw.random() < 0.12:
            inner.append(_beside(draw, other, text))
    start, end = _tag(draw.choice(_TEXT_SHELLS))
    page = start + "".join(inner) + (_beside(draw, other, text) if draw.random() < 0.2 else "") + end
    for _ in range(draw.randint(0, 3)):
        start, end = _tag(draw.choice(_NEUTRAL_SHELLS))
        before, after = ([_beside(draw, other, text) for _ in range(draw.randint(0, 2))] for _ in range(2))
        page = start + "".join(before) + page + "".join(after) + end
    before, after = ([_beside(draw, other, text) for _ in range(draw.randint(1, 3))] for _ in range(2))
    return f"<html><head><title>x</title></head><body>{''.join(before)}{page}{''.join(after)}</body></html>", used


def kept_by_markup(page: Page) -> list[bool] | None:
    """Which nodes lead to text or are text, as article and main say; None if there is neither."""
    nodes = page.nodes
    if not any(n.tag in _MEANT_TEXT for n in nodes):
        return None
    inside, outside = [False] * len(nodes), [False] * len(nodes)
    for at, node in enumerate(nodes):
        above = node.parent
        outside[at] = above >= 0 and outside[above] or node.tag in _MEANT_OTHER or bool(_OTHER_WORDS.intersection(node.tokens))
        inside[at] = not outside[at] and (node.tag in _MEANT_TEXT or above >= 0 and inside[above])
    return _with_ancestors(page, inside)


def _with_ancestors(page: Page, kept: list[bool]) -> list[bool]:
    kept = list(kept)
    for at in range(len(kept) - 1, 0, -1):
        if kept[at]:
            kept[page.nodes[at].parent] = True
    return kept


def examples(source: str, seed: int, variants: int = VARIANTS) -> list[tuple[Page, list[bool]]]:
    """A page as its markup labels it, and other layouts of its blocks."""
    page = parse(source)
    kept = kept_by_markup(page)
    if kept is None:
        return []
    text = [t for at, t in page.blocks if kept[at] and page.nodes[at].tag not in ("html", "body")]
    other = [t for at, t in page.blocks if not kept[at]]
    found = [(page, kept)]
    draw = random.Random(seed)
    for _ in range(variants if text else 0):
        source, used = layout(draw, text, other or ["menu", "home"])
        made = parse(source)
        wanted = [False] * len(made.nodes)
        outside = [False] * len(made.nodes)
        for at, node in enumerate(made.nodes):
            shell = _shell_of(node)
            outside[at] = at > 0 and outside[node.parent] or shell in _BESIDE_SHELLS
        for at, block in made.blocks:
            wanted[at] |= not outside[at] and block in used
        found.append((made, _with_ancestors(made, wanted)))
    return found


def _shell_of(node) -> tuple[str, tuple[str, ...]]:
    return node.tag, node.tokens


_BESIDE_SHELLS = {(n.tag, n.tokens) for shell in _BESIDE for n in parse("".join(_tag(shell))).nodes[1:2]}


def leanings(pages: list[tuple[Page, list[bool]]]) -> dict[str, float]:
    """Log-odds of being kept by tag ("<tag") and attribute word; wrappers of both count half."""
    counts: dict[str, list[float]] = defaultdict(lambda: [1.0, 1.0])
    for page, kept in pages:
        for node, is_kept in zip(page.nodes, kept):
            for word in (f"<{node.tag}", *node.tokens):
                counts[word][is_kept] += 1
    return {w: math.log(yes / no) for w, (no, yes) in counts.items() if no + yes >= 8}


class Trees:
    """Boosted trees read from the description of a fitted model; evaluated on arrays."""

    def __init__(self, description: str):
        self.trees: list[tuple[float, tuple]] = []
        lines = iter(description.splitlines()[1:])
        for line in lines:
            if found := re.match(r"\s*Tree \d+ \(weight ([-\d.eE]+)\)", line):
                self.trees.append((float(found[1]), self._read(lines)))

    def _read(self, lines: Iterator[str]) -> tuple:
        line = next(lines).strip()
        if line.startswith("Predict:"):
            return (float(line.split()[1]),)
        found = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line)
        low = self._read(lines)
        next(lines)  # Else
        return int(found[1]), float(found[2]), low, self._read(lines)

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of being kept."""
        total = np.zeros(len(rows))
        for weight, tree in self.trees:
            self._add(total, rows, np.arange(len(rows)), weight, tree)
        return 2 * total

    def _add(self, total, rows, at, weight, tree) -> None:
        if not len(at):
            return
        if len(tree) == 1:
            total[at] += weight * tree[0]
            return
        low = rows[at, tree[0]] <= tree[1]
        self._add(total, rows, at[low], weight, tree[2])
        self._add(total, rows, at[~low], weight, tree[3])


def decode(page: Page, odds: np.ndarray) -> list[str]:
    """Blocks of the kept elements, where none is kept below a rejected one.

    Log-likelihoods: ``out[n]`` for all of n's subtree rejected, ``kept[n]`` for n kept and
    each child's subtree as is best for it.
    """
    yes = -np.logaddexp(0, -odds)
    no = -np.logaddexp(0, odds)
    out, kept = no.copy(), yes.copy()
    nodes = page.nodes
    for at in range(len(nodes) - 1, 0, -1):
        above = nodes[at].parent
        out[above] += out[at]
        kept[above] += max(out[at], kept[at] + TOGETHER)
    stays = np.zeros(len(nodes), bool)
    stays[0] = True
    for at in range(1, len(nodes)):
        stays[at] = stays[nodes[at].parent] and kept[at] + TOGETHER > out[at]
    return [text for at, text in page.blocks if at and stays[at]]


def fit(pages: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], str]:
    """Leanings of words and the description of the fitted trees."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    spark = pages.sparkSession
    share = sample / max(1, pages.select("page_id").count())
    drawn = pages.where((unit(F.col("page_id"), F.col("html"), seed=11) < share) & F.col("html").isNotNull())
    rows = sorted(drawn.select("page_id", "html").collect(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["html"]))
    found = [e for seed, row in enumerate(rows) for e in examples(row["html"], seed)]
    if not found:  # nothing to learn from in the table
        draw = random.Random(0)
        stand_in = [f"{w}." * draw.randint(4, 30) for w in ("word ", "text ", "some ")]
        found = [e for seed in range(50) for e in examples(f"<article>{''.join(f'<p>{b}</p>' for b in stand_in)}</article>", seed)]
    lean = leanings(found)
    data = [
        (float(kept), values)
        for page, marks in found
        for kept, values in zip(marks[1:], describe(page, lean)[1:].tolist())
    ]
    frame = spark.createDataFrame(data, "label double, own array<double>").select(
        "label", array_to_vector("own").alias("features")
    )
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5, maxMemoryInMB=64).fit(frame.coalesce(2))
    return lean, model._java_obj.toDebugString()


def extracted(pages: DataFrame, lean: dict[str, float], description: str) -> DataFrame:
    """``page_id``, ``url`` and ``text``, the kept blocks of ``html`` in page order, one a line."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(description)
        for batch in batches:
            for part in slices(batch, "html", 1 << 20):
                parsed = [parse(h.as_py()) for h in part.column("html")]
                rows = [describe(page, lean) for page in parsed]
                odds = np.split(trees.odds(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
                found = ["\n".join(decode(page, own)) for page, own in zip(parsed, odds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"]
                )

    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return pages.mapInArrow(texts, "page_id long, url string, text string")
