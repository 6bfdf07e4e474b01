"""HTML extraction (operator 7): two-pass block rules.

A page is cut into blocks at block-level tags. Elements that never hold main
text (scripts, styles, forms, menus, page headers and footers, sidebars) and
elements whose class or id names a notice, an advert or reader comments are
left out, with all they hold. The first pass classifies every block by length,
link density and stop-word density as good, bad or undecided (short, or few
stop words). In the second pass undecided blocks inherit the label of the
nearest decided blocks before and after them; if those differ, a heading goes
with what follows and any other block is good only between good ones. A heading
that is kept counts as decided for the short blocks below it; after the last
decided block the one decided neighbour is the one before. Where no block at
all is decided good, the undecided ones are the text.

An element that is furniture by its class, id or role alone, or is a form, is
read after all if it holds the page's ``article`` or ``main``, or more than half of
the text outside links; one that names reader comments never is. Words such as
``has-sidebar`` or ``no-comments`` speak about the page and hide nothing.

The stop words are those of four languages. On a page where the blocks with
stop words hold less than half of the text that is not linked and not short,
and for blocks in another script than Latin, the list does not apply: there the
first pass goes by length and link density. A wide (East Asian) character
counts as two.

A page whose ``article`` or ``main`` elements hold at least half of the text
that is neither hidden nor linked has its text inside them: blocks outside are
bad, and undecided blocks inside are good. Other pages, such as one with an
article element for a teaser, go by the block rules alone. Character references
are decoded, white space inside a block becomes one space, blocks are joined in
page order by a line feed.

Defined cases: NULL and empty pages give an empty text; tags that are not
closed end with their parent or the page, a hidden element without an end tag
(a button, an option, a drawing) before the next block; a tag cut off at the
end of a page is dropped; equal
pages give equal texts. Only the html column and the columns asked for are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names and words that name page furniture.
RAW = "script style textarea title".split()
HIDDEN = "noscript template svg math iframe object select option button".split()
FURNITURE = "head nav footer aside form menu dialog".split()
BLOCKS = (
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
HINTS = (
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices popup modal overlay sidebar menu navbar navigation breadcrumb breadcrumbs footer masthead comment "
    "comments commentlist disqus respond reply replies share sharing social related recommended newsletter subscribe signup "
    "widget toolbar skip pagination pager"
).split()
REMARKS = "comment comments commentlist disqus respond reply replies".split()  # of the hints, never the main part
STOP_WORDS = (
    "the of and to in a is that it for was on are as with be this by at from or an not have has but they which you we his her "
    "der die das und in den von zu mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son "
    "el que y los se del las por con para una su al lo como mas pero sus le ya o este si porque esta entre cuando muy sin sobre"
).split()
SHORT, LONG, MANY_LINKS, FEW_STOPS, STOPS = 70, 200, 0.33, 0.10, 0.25

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(" + "|".join(RAW) + r")(?![\w:-])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
PAIRED = re.compile(r"<(/?)(" + "|".join(HIDDEN) + r")(?![\w:-])", re.IGNORECASE)
MARK = re.compile(r"(?<![\w:.-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
NAME = re.compile(r"[a-z]+")
LAYOUT = re.compile(r"(?:has|have|no|not|with|without|is|show|hide|hidden)[-_].*")  # has-sidebar: about the page, not the element
LATIN = re.compile(r"[A-Za-z\u00aa-\u024f\u1e00-\u1eff]")
LETTER = re.compile(r"[^\W\d_]")
WIDE = re.compile(r"[\u1100-\u115f\u2e80-\ua4cf\uac00-\ud7a3\uf900-\ufaff\uff00-\uff60\U00020000-\U0003fffd]")


def closed_tags(page: str) -> set[int]:
    """Places of the start tags of hidden elements that have an end tag of their own."""
    out: set[int] = set()
    waiting: dict[str, list[int]] = {}
    for m in PAIRED.finditer(page):
        places = waiting.setdefault(m[2].lower(), [])
        if not m[1]:
            if m[2].lower() in ("button", "option", "select", "iframe"):  # never inside one another
                places.clear()
            places.append(m.start())
        elif places:
            out.add(places.pop())
    return out


class Block:
    __slots__ = ("parts", "linked", "heading", "inside")

    def __init__(self, inside: bool):
        self.parts, self.linked, self.heading, self.inside = [], 0, False, inside


class Reader:
    """Blocks of one page, in page order."""

    def __init__(self) -> None:
        self.concealed, self.furniture, self.blocks_at, self.void = set(HIDDEN), set(FURNITURE), set(BLOCKS), set(VOID)
        self.hints, self.remarks = set(HINTS), set(REMARKS)

    def named(self, attributes: str, hints: set[str]) -> bool:
        return any(
            not hints.isdisjoint(NAME.findall(token))
            for m in MARK.finditer(attributes) for token in (m[1] or m[2] or m[3] or "").lower().split() if not LAYOUT.fullmatch(token)
        )

    def read(self, page: str) -> tuple[list[tuple[str, float, bool, bool]], bool]:
        """([(text, link density, is a heading, inside the main part)], has a main part with most of the text).

        Elements that only their names or being a form make furniture are read
        after all if they hold more than half of the text outside links.
        """
        found, has_main, whole = self.pass_over(page, frozenset())
        return self.pass_over(page, whole)[:2] if whole else (found, has_main)

    def pass_over(self, page: str, whole: frozenset[int]) -> tuple[list[tuple[str, float, bool, bool]], bool, frozenset[int]]:
        """The blocks, and the places of elements named like furniture that hold most of the text; those in ``whole`` are read."""
        out: list[Block] = []
        block, at = Block(False), 0
        # name, starts furniture or a hidden element, is so by its name only, place, characters read or hidden before it
        open_tags: list[tuple[str, bool, bool, int, int]] = []
        opened: Counter = Counter()  # how many of each name are open
        hard = 0  # open furniture and hidden elements that are so by their element
        plain = 0  # characters outside links, hard furniture left out
        large: list[tuple[int, int]] = []  # (place, characters) of elements hidden by their name
        closed = closed_tags(page)
        unclosed = 0  # open hidden elements without an end tag, named "" in open_tags: they end at the next block
        hidden = links = mains = 0
        has_main = False

        def close() -> None:
            nonlocal block
            if block.parts:
                out.append(block)
            block = Block(mains > 0)

        def leave() -> str:
            """Close the innermost open tag."""
            nonlocal hidden, hard, links, mains, unclosed
            n, starts, soft, place, seen = open_tags.pop()
            opened[n] -= 1
            hidden -= starts
            hard -= starts and not soft
            links -= n == "a"
            unclosed -= n == ""
            if soft:
                large.append((place, plain - seen))
            return n

        def text(piece: str) -> None:
            nonlocal plain
            if not hard and not links and piece:
                plain += len(piece.strip())
            if not hidden and piece:
                decoded = html.unescape(piece)
                block.parts.append(decoded)
                if links:
                    block.linked += len(decoded.strip())

        for m in TOKEN.finditer(page):
            text(page[at : m.start()])
            at = m.end()
            name = m[3]
            if name is None:
                if m[1] is None or m[1].lower() not in ("script", "style"):
                    text(" ")
                continue
            name, ends = name.lower(), bool(m[2])
            if name == "br":
                text(" ")
                continue
            if name in self.concealed and not ends and name not in ("noscript", "template"):
                text(" ")
            if name in self.blocks_at:
                while unclosed:
                    leave()
                close()
            if name in self.void or m[4].endswith("/") and not ends and name not in self.blocks_at:
                continue
            if ends:
                if opened[name] > 0:
                    while open_tags:
                        n = leave()
                        mains -= n in ("article", "main")
                        if n == name:
                            break
                block.inside = mains > 0
                continue
            if name in ("p", "li") and any(t[0] == name for t in open_tags[-3:]):
                while open_tags:  # a new paragraph ends the open one
                    if leave() == name:
                        break
            starts = name in self.concealed or name in self.furniture and name != "form" or (name == "header" and not mains) or (
                name not in ("html", "body", "article", "main") and self.named(m[4], self.remarks))
            named = name not in ("html", "body", "main") and (name == "form" or self.named(m[4], self.hints))
            if name == "article":
                named = named and hidden > 0  # a comment among comments, not the article of the page
            soft = named and not starts and m.start() not in whole
            if name in ("article", "main") and hidden and not hard and not has_main and not named:
                # what holds the main part is no furniture, whatever its name
                open_tags = [(n, s and not f, False, p, c) for n, s, f, p, c in open_tags]
                hidden = 0
            if name in self.concealed and m.start() not in closed:
                name = ""
                unclosed += 1
            open_tags.append((name, starts or soft, soft, m.start(), plain))
            opened[name] += 1
            hidden += starts or soft
            hard += starts
            links += name == "a"
            if name in ("article", "main"):
                mains += 1
                has_main = has_main or not hidden
            block.inside = mains > 0
            block.heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
        tail = page[at:]
        cut = re.search(r"<(?=[a-zA-Z/!?])[^>]*\Z", tail)
        text(tail[: cut.start()] if cut else tail)
        close()
        found, free = [], [0, 0]  # characters not linked: outside and inside the main part
        for b in out:
            words = " ".join("".join(b.parts).split())
            if words:
                found.append((words, b.linked / len(words), b.heading, b.inside))
                free[b.inside] += max(0, len(words) - b.linked)
        while open_tags:
            leave()
        most = frozenset(place for place, size in large if 2 * size > plain) if not whole and not has_main else frozenset()
        if has_main and free[0] > free[1]:
            return [(words, links, heading, False) for words, links, heading, _ in found], False, most
        return found, has_main, most


def latin(words: str) -> bool:
    """Whether at least half of the letters are Latin."""
    return words.isascii() or 2 * len(LATIN.findall(words)) >= len(LETTER.findall(words))


def classify(blocks: list[tuple[str, float, bool, bool]], has_main: bool, stops: set[str]) -> list[bool]:
    """Which blocks are main text."""
    label: list[bool | None] = []
    measured: list[tuple[int, float, bool]] = []  # (size, stop-word density, in Latin script)
    known = other = 0  # characters of the blocks that are not short, with and without stop words
    for words, links, _heading, _inside in blocks:
        tokens = words.lower().split()
        density = sum(t.strip(".,;:!?") in stops for t in tokens) / len(tokens)
        size = len(words) if words.isascii() else len(words) + len(WIDE.findall(words))
        measured.append((size, density, latin(words)))
        if size >= SHORT and links <= MANY_LINKS and measured[-1][2]:
            if density >= FEW_STOPS:
                known += size
            else:
                other += size
    for (words, links, _heading, inside), (size, density, script) in zip(blocks, measured):
        if has_main and not inside:
            label.append(False)
        elif links > (0.8 if inside else MANY_LINKS):
            label.append(False)
        else:
            if size >= SHORT and density >= STOPS or size >= LONG and density >= FEW_STOPS:
                label.append(True)
            elif size >= SHORT and (not script or known < other):  # not a language of the list
                label.append(True)
            elif size >= LONG and not inside:
                label.append(False)
            else:
                label.append(None)
    before: list[bool | None] = []
    last = None
    for x, (_, _, _, inside) in zip(label, blocks):
        before.append(last)
        last = x if x is not None and (inside or not has_main) else last
    out, after, follow = [False] * len(blocks), [False] * len(blocks), None
    for i in range(len(blocks) - 1, -1, -1):
        _, _, heading, inside = blocks[i]
        here = label[i]
        after[i] = follow is True or follow is None and before[i] is True
        if here is None:
            # in the main part only link lists are bad, and they don't spoil what stands beside them
            here = (has_main and inside) or follow is True and (heading or before[i] is True) or not heading and follow is None and before[i] is True
        elif inside or not has_main:
            follow = here
        out[i] = here
    if not has_main:
        if not any(out):  # only short blocks: nothing speaks against those that are undecided
            return [x is None for x in label]
        for i in range(1, len(blocks)):  # a heading that is kept is a decided neighbour of what it stands above
            if label[i] is None and not out[i] and out[i - 1] and (blocks[i - 1][2] or label[i - 1] is None) and after[i]:
                out[i] = True
    return out


def main_text(page: str | None, reader: Reader, stops: set[str]) -> str:
    blocks, has_main = reader.read(page or "")
    return "\n".join(b[0] for b, good in zip(blocks, classify(blocks, has_main, stops)) if good)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns in ``keep``, then (text, n_chars) of every row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, stops = Reader(), set(STOP_WORDS)
        for batch in batches:
            texts: list[str] = []
            for start in range(0, batch.num_rows, 64):
                texts += [main_text(p, reader, stops) for p in batch.column(len(keep)).slice(start, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select(*[F.col(c) for c in keep], F.col(html_col)).mapInArrow(read, f"{kinds}, text string, n_chars long")
