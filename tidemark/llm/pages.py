"""Main text of web pages: flat text blocks, a decision tree, a small labelled table.

A page is cut at every tag that is not inline into blocks of text. A block has eight
features: its words and the share of them inside links, both also of the block before and
of the block after, what the elements around it say, and whether it is a heading. A tree
that is grown by Gini impurity from the blocks of labelled pages decides which blocks stay.
It learns each page also as if no element said anything, so that the words and links of a
block and its neighbours must do where names are missing.

What the elements say: 1 inside an article or main part or an element whose class, id or
role is named like one; -1 inside navigation, footer, aside, form and the like or an
element named like an advert, a notice, a menu, comments and so on; 0 if nothing is said.
A name counts against the text only as a whole: `sidebar` or `sidebar-left`, but neither
`with-sidebar` nor `search-methods`. The tag or a name of a main part weighs against it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, table
from tidemark.llm.page_samples import KEEP, SAMPLES

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "around", "heading")

#: Questions that lead to a leaf at most, and labelled blocks in a leaf at least.
DEPTH, LEAF = 10, 2
#: Words that, with links around, can be told from a text without names.
SHORT = 6
#: How often a page counts as it is, for once without what its elements say.
NAMED = 4

#: Elements of the markup, by what they mean for text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
UNSEEN = "script style noscript template title textarea select option button iframe object svg math canvas audio video".split()
PLAIN = frozenset("div section ul ol dl table tbody thead tr td th figure details fieldset blockquote center".split())
MAIN = frozenset(("article", "main"))
ASIDE = frozenset("nav footer aside form dialog menu header".split())
#: Words of the names in class, id and role. A name is cut at what is no letter.
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share "
    "sharing social related recommended recommendations sidebar aside menu nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager comment comments disqus reply replies respond footer foot header masthead "
    "topbar toolbar widget widgets complementary contentinfo search form".split()
)
COMMENT_NAMES = frozenset("comment comments reply replies disqus".split())
#: Readers' words beside a text; inside a main part they may be a chapter of it.
TALK_NAMES = frozenset("discussion discussions feedback response responses".split())
MAIN_NAMES = frozenset("article main content post entry story maincontent articlebody".split())
#: Next to a main name in one name, as in `entry-header` or `content-sidebar`, these say nothing.
LAYOUT_NAMES = frozenset(
    "header head masthead sidebar aside menu nav navbar widget widgets toolbar topbar search form notice notices "
    "alert banner".split()
)
#: Words of place and shape, which leave the meaning of a name as it is.
SHAPE_NAMES = frozenset(
    "area articles author bar block body bottom box btn button buttons card cards center col column container desktop div "
    "first fixed global google gpt group holder icon icons inner item items last left link links list media middle "
    "mobile outer page panel placeholder posts primary right row secondary section site slot sticky stories text "
    "title top unit user users wall wrap wrapper zone".split()
)

# Every part matches in one way only, so a broken page takes no more steps than a whole one.
_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|(?P<cut>\Z)))"
    rf"|<(?P<unseen>{'|'.join(UNSEEN)})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</(?P=unseen)\s*>|(?P<cut2>\Z))"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>{_ATTRIBUTES})>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"  # quotes without an end
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
#: What begins a tag or a comment; without an end it takes all the rest of the page.
_BEGINS = re.compile(r"<[a-zA-Z/!?]")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_HEADING = re.compile(r"h[1-6]$")


@dataclass(frozen=True)
class Tree:
    """A leaf, or a question: is the feature below the border?"""

    keep: float
    feature: int = -1
    border: float = 0.0
    below: Tree | None = None
    above: Tree | None = None

    def decide(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.keep >= 0.5)
        low = rows[:, self.feature] < self.border
        out = np.empty(len(rows), bool)
        out[low], out[~low] = self.below.decide(rows[low]), self.above.decide(rows[~low])
        return out


def grow(rows: np.ndarray, keep: np.ndarray, depth: int = 6, leaf: int = 1) -> Tree:
    """Tree whose questions each lower the Gini impurity the most; of equally good ones the
    first feature and lowest border win. Each side of a question has `leaf` rows or more."""
    share = float(keep.mean())
    if depth == 0 or share in (0.0, 1.0):
        return Tree(share)
    best: tuple[float, int, float] | None = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for border in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] < border
            if min(low.sum(), (~low).sum()) < leaf:
                continue
            p, q = keep[low].mean(), keep[~low].mean()
            impurity = low.sum() * p * (1 - p) + (~low).sum() * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = (float(impurity), f, float(border))
    if best is None:
        return Tree(share)
    low = rows[:, best[1]] < best[2]
    below, above = (grow(rows[side], keep[side], depth - 1, leaf) for side in (low, ~low))
    return Tree(share, best[1], best[2], below, above)


def _named(rest: str, inside: bool) -> tuple[bool, bool, bool]:
    """Whether the names of an element are those of a main part, of an aside, of comments;
    `inside`: within a main part."""
    main = aside = comments = False
    for m in _NAMED.finditer(rest):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = {w for w in _WORD.findall(name) if len(w) > 1}
            known = words & (ASIDE_NAMES if inside else ASIDE_NAMES | TALK_NAMES)
            if known and words <= known | SHAPE_NAMES:
                aside = True
                comments |= bool(known & COMMENT_NAMES)
            elif known and words <= known | SHAPE_NAMES | MAIN_NAMES:
                aside |= not known & LAYOUT_NAMES
            else:
                main |= bool(words & MAIN_NAMES)
    return main, aside, comments


def _says(tag: str, rest: str, above: int, fixed: bool) -> tuple[int, bool]:
    """What an element says about text in it, and whether nothing inside can unsay it."""
    if fixed:
        return above, True
    main = aside = comments = False
    if "=" in rest and tag not in ("html", "body"):
        main, aside, comments = _named(rest, above == 1)
    if comments and not main and tag != "main":
        return -1, True
    # One sign of a main part makes the name doubtful, two or the tag `main` outweigh it.
    signs = main + (tag in MAIN)
    if aside and signs < 2 and tag != "main":
        return (above, False) if signs and tag not in ASIDE else (-1, False)
    if tag in ASIDE:
        # The heading part of an article is part of it.
        return (1, False) if tag == "header" and above == 1 else (-1, tag != "header")
    if tag in MAIN:
        return 1, False
    if above == 0 and main:
        return 1, False
    return above, False


def blocks(page: str) -> Iterator[tuple[str, int, int, int, bool]]:
    """Text, words, words in links, what the elements say, heading: of each block."""
    stack: list[tuple[str, int, bool]] = []
    text: list[str] = []
    linked: list[str] = []
    around, fixed, link, heading, at = 0, False, False, False, 0

    def block() -> tuple[str, int, int, int, bool] | None:
        words = html.unescape("".join(text)).split()
        inside = len(html.unescape(" ".join(linked)).split()) if linked else 0
        text.clear()
        linked.clear()
        return (" ".join(words), len(words), min(inside, len(words)), around, heading) if words else None

    # Behind the last `>` no tag ends; what begins there, or goes on there, is cut.
    behind = page.rfind(">") + 1
    begins = _BEGINS.search(page, behind)
    shown = begins.start() if begins else len(page)
    for m in _TOKEN.finditer(page, 0, behind):
        if m.start() > at:
            text.append(page[at : m.start()])
            if link:
                linked.append(page[at : m.start()])
        at = m.end()
        if m["cut"] is not None or m["cut2"] is not None:
            shown = at
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag, closes, rest = tag.lower(), bool(m["close"] or m["close2"]), m["rest"] or m["rest2"] or ""
        if tag in INLINE:
            if tag == "a":
                link = not closes
            continue
        if made := block():
            yield made
        if closes:
            heading = False
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    _, around, fixed = stack[i]
                    del stack[i:]
                    link = False
                    break
        else:
            heading = bool(_HEADING.match(tag))
            if tag in PLAIN or tag in MAIN or tag in ASIDE:
                if not rest.endswith("/"):
                    stack.append((tag, around, fixed))
                    around, fixed = _says(tag, rest, around, fixed)
    text.append(page[at:shown])
    if made := block():
        yield made


def features(found: list[tuple[str, int, int, int, bool]]) -> list[tuple[float, ...]]:
    """The features of a page's blocks; a block that is missing has no words."""
    size = [(float(b[1]), b[2] / b[1]) for b in found]
    edge = [(0.0, 0.0)]
    return [
        (*here, *before, *after, float(b[3]), float(b[4]))
        for b, here, before, after in zip(found, size, edge + size, size[1:] + edge, strict=False)
    ]


def labelled(samples: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the blocks of labelled pages, and whether they are main text.

    Each page counts as it is and without what its elements say; there, blocks that only
    an element tells apart (links in a text; prose beside it, or words without links
    around) are left out.
    """
    rows, keep = [], []
    around, links = FEATURES.index("around"), [FEATURES.index(f) for f in ("links", "links_before", "links_after")]
    for page in samples:
        found = list(blocks(page))
        for block, row in zip(found, features(found), strict=True):
            main = block[0].startswith(KEEP)
            rows += [row] * NAMED
            keep += [main] * NAMED
            told = block[1] < SHORT and max(row[i] for i in links) >= 0.5
            link = row[links[0]] >= 0.5
            if row[around] and (not link if main else told or link):
                rows.append((*row[:around], 0.0, *row[around + 1 :]))
                keep.append(main)
    return np.array(rows), np.array(keep)


@lru_cache(maxsize=1)
def trained() -> Tree:
    return grow(*labelled(SAMPLES), DEPTH, LEAF)


def main_texts(pages: list[str | None]) -> list[str]:
    """Main text of each page, its blocks joined by one space."""
    each = [list(blocks(p)) if p else [] for p in pages]
    rows = [row for found in each for row in features(found)]
    if not rows:
        return [""] * len(pages)
    stays = iter(trained().decide(np.array(rows)).tolist())
    return [" ".join([b[0] for b in found if next(stays)]) for found in each]


def extract(df: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """`df` with `text`, the main text of `page`; empty for a null or empty page. Whole
    pages, 256 at a time. A column named like the result is replaced, others pass."""
    at = df.columns.index(page)
    rest = [i for i, c in enumerate(df.columns) if c.lower() != text.lower()]
    schema = df.select(*[f"`{df.columns[i]}`" for i in rest]).withColumn(text, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                found = main_texts(batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in rest], pa.array(found, pa.string())],
                    [*[batch.schema.names[i] for i in rest], text],
                )

    return in_arrow(df, run, schema)


def op8_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages)
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
