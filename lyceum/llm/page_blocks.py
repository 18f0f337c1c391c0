"""Leaf blocks of a web page with the path of elements above them, and training pages made by a rule."""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Elements by their role in HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript head title svg math iframe select textarea".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title head html".split())
DRAWN = frozenset(("svg", "math"))  # what is inside is not HTML, but for what stands in one of POINTS
POINTS = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
ENDS_DRAWN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
ENDS_SELECT = frozenset("input keygen textarea select".split())
TABLE_PARTS = frozenset("caption table tbody tfoot thead tr td th".split())
CLOSES_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                 "th": ("td", "th"), "option": ("option",)}
NAMES = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text of a leaf block; ``path`` from the root, each element with its class and id names."""

    path: tuple[tuple[str, tuple[str, ...]], ...]
    text: str
    linked: int
    label: int = 0


@dataclass
class Element:
    tag: str
    names: tuple[str, ...]
    label: int | None = None
    before: int = 0  # blocks found before this element


@dataclass
class Reader(HTMLParser):
    """Blocks of one page.  Elements left open are closed as browsers do it: a new paragraph, list item or
    cell ends the one before, any block ends a paragraph, and an end tag ends what is open inside.  A head
    ends at the first tag or text that may not stand in it, a drawing or formula at the first tag that only
    HTML has, a list of options at the next control.  What an object holds is shown in its place if it cannot
    be: it is left out if the object has an end tag, else nobody knows where the object ends, and it is read."""

    blocks: list[Block] = field(default_factory=list)
    open: list[Element] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    silent: int = 0
    links: int = 0
    headed: bool = False  # a head was seen, or what comes behind it

    def __post_init__(self) -> None:
        super().__init__(convert_charrefs=True)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                label = next((e.label for e in reversed(self.open) if e.label is not None), 0)
                path = tuple((e.tag, e.names) for e in self.open if e.tag not in INLINE)
                self.blocks.append(Block(path, text, min(self.linked, len(text)), label))
            self.parts = []
        self.linked = 0

    def shut(self, place: int) -> None:
        for element in self.open[place:]:
            self.silent -= element.tag in SILENT
            self.links -= element.tag == "a"
        del self.open[place:]

    def shut_last(self, tags: tuple[str, ...], stop: tuple[str, ...]) -> None:
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place].tag in tags:
                return self.shut(place)
            if self.open[place].tag in stop:
                return None
        return None

    def end_head(self) -> None:
        if self.open and self.open[-1].tag == "head":
            self.shut(len(self.open) - 1)
        self.headed = True

    def end_drawn(self) -> None:
        first = None
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place].tag in POINTS:
                break
            if self.open[place].tag in DRAWN:
                first = place
        if first is not None:
            self.shut(first)

    def end_select(self, tag: str) -> bool:
        """Ends the list of options that a tag may not stand in; true if there was one."""
        tags = [e.tag for e in self.open]
        if "select" not in tags or not (tag in ENDS_SELECT or (tag in TABLE_PARTS and "table" in tags)):
            return False
        self.shut(tags.index("select"))
        return True

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_DRAWN or (tag == "font" and any(key in ("color", "face", "size") for key, _ in attrs)):
            self.end_drawn()
        if tag == "head" and self.headed:
            return
        if tag == "head":
            self.headed = True
        elif tag not in IN_HEAD:
            self.end_head()
        if self.end_select(tag) and tag == "select":
            return
        if tag == "br":
            self.parts.append(" ")
        if tag in INLINE and tag not in VOID:
            self.open.append(Element(tag, ()))
            self.links += tag == "a"
            return
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        self.flush()
        if tag in CLOSES_ITSELF:
            self.shut_last(CLOSES_ITSELF[tag], ("ul", "ol", "dl", "table"))
        self.shut_last(("p",), ("table", "td", "th", "button", "object"))
        found, label = [], None
        for key, value in attrs:
            if value and key in ("class", "id", "role"):
                found += NAMES.findall(value.lower())
            elif key == "data-label":
                label = int(value or 0)
        self.open.append(Element(tag, tuple(found), label, len(self.blocks)))
        self.silent += tag in SILENT

    def handle_endtag(self, tag: str) -> None:
        if tag in ("p", "br"):
            self.end_drawn()
        if tag not in INLINE:
            self.flush()
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place].tag == tag:
                if tag == "object":
                    del self.blocks[self.open[place].before:]
                return self.shut(place)
            if tag in INLINE and self.open[place].tag not in INLINE:
                return None
        return None

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1].tag == "head" and data.strip():
            self.end_head()
        if not self.silent:
            self.headed = self.headed or bool(data.strip())
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks_of(html: str | None) -> list[Block]:
    """Blocks in page order; none for null, empty, or pages without text."""
    if not html:
        return []
    reader = Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


# Names that pages give to the parts of a page.
ASIDE = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc topbar tabs",
    "header": "header masthead banner logo site-title tagline",
    "footer": "footer bottom copyright legal colophon",
    "sidebar": "sidebar aside widget related recommended trending popular more-stories",
    "notice": "notice cookie consent gdpr alert warning announcement modal popup",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad",
    "form": "form newsletter subscribe signup login search contact",
    "comments": "comments comment replies reply discussion responses disqus",
    "share": "share social follow tags meta pagination",
}
TAGS = {
    "menu": ("nav", "div", "ul", "header"), "header": ("header", "div"), "footer": ("footer", "div"),
    "sidebar": ("aside", "div", "section"), "notice": ("div", "section", "p"), "advert": ("div", "aside", "section", "p"),
    "form": ("form", "div"), "comments": ("section", "div", "ol", "aside"), "share": ("div", "ul", "p"),
}
MAIN = "content main article post entry story body text main-content post-content entry-content article-body"


class Maker:
    """Pages with labelled parts, from a seed: the parts, their elements, names and order vary."""

    def __init__(self, seed: int):
        self.draw = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        d = self.draw
        found = ["".join(d.choice("bcdfglmnprst") + d.choice("aeiou") for _ in range(d.randint(1, 4)))
                 for _ in range(d.randint(low, high))]
        return " ".join(found).capitalize()

    def sentence(self, low: int = 1, high: int = 30) -> str:
        return self.words(low, high) + self.draw.choice((".", ".", ".", "!", "?", ""))

    def text(self) -> str:
        return " ".join(self.sentence() for _ in range(self.draw.randint(1, 6)))

    def named(self, kind: str, inside: str) -> str:
        d, tag = self.draw, self.draw.choice(TAGS[kind])
        name = d.choice(ASIDE[kind].split())
        key = d.choice(("class", "class", "id"))
        plain = tag in ("nav", "footer", "aside", "form", "header") and d.random() < 0.5
        return f'<{tag}{"" if plain else f" {key}={chr(34)}{name}{chr(34)}"} data-label="0">{inside}</{tag}>'

    def links(self) -> str:
        items = [f'<a href="/{k}">{self.words(1, 3)}</a>' for k in range(self.draw.randint(2, 7))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.draw.random() < 0.7 else " | ".join(items)

    def inside(self, kind: str) -> str:
        d = self.draw
        if kind in ("menu", "share"):
            return self.links()
        if kind == "sidebar":
            return f"<h3>{self.words(1, 3)}</h3>" + (self.links() if d.random() < 0.6 else f"<p>{self.text()}</p>")
        if kind == "comments":
            one = lambda: f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.text()}</p></div>'
            return f"<h3>{self.words(1, 2)}</h3>" + "".join(one() for _ in range(d.randint(1, 4)))
        if kind == "form":
            return f"<label>{self.words(1, 4)}</label><input name=q><button>{self.words(1, 2)}</button><p>{self.sentence()}</p>"
        if kind == "footer":
            return f"&copy; {self.words(1, 5)} &middot; {self.sentence()}"
        if kind == "header":
            return f"<p>{self.words(1, 4)}</p>" + (self.links() if d.random() < 0.5 else "")
        return d.choice(("{}", "<p>{}</p>", '<p>{} <a href="/x">more</a></p>')).format(self.sentence(2, 20))

    def part(self, kind: str) -> str:
        return self.named(kind, self.inside(kind))

    def article(self) -> str:
        d, found = self.draw, []
        title = f"<h1>{self.sentence(1, 12)}</h1>"
        found.append(f"<header>{title}</header>" if d.random() < 0.2 else title if d.random() < 0.9 else "")
        for _ in range(d.randint(0, 12)):
            x = d.random()
            if x < 0.7:
                found.append(f"<p>{self.text()}</p>" if d.random() < 0.8 else f"<p><b>{self.sentence()}<br>")
            elif x < 0.78:
                found.append(f"<h2>{self.words(1, 6)}</h2>")
            elif x < 0.86:
                found.append("<ul>" + "".join(f"<li>{self.sentence(1, 12)}</li>" for _ in range(d.randint(1, 5))) + "</ul>")
            elif x < 0.9:
                found.append(f"<blockquote>{self.text()}</blockquote>")
            elif x < 0.93:
                found.append("<table><tr>" + "".join(f"<td>{self.words(1, 3)}</td>" for _ in range(3)) + "</tr></table>")
            else:
                found.append(self.part(d.choice(("advert", "share", "form", "notice", "sidebar"))))
        if d.random() < 0.15:
            found.append(self.part("comments"))
        inside, x = "".join(found), d.random()
        if x < 0.55:
            return f'<article data-label="1">{inside}</article>'
        name = d.choice(MAIN.split())
        tag = "main" if x < 0.7 else d.choice(("div", "section"))
        return f'<{tag} {d.choice(("class", "id"))}="{name}" data-label="1">{inside}</{tag}>'

    def page(self) -> str:
        d = self.draw
        before = [self.part(k) for k in ("header", "menu", "notice", "advert") if d.random() < 0.6]
        after = [self.part(k) for k in ("comments", "sidebar", "share", "form", "advert", "footer") if d.random() < 0.45]
        d.shuffle(before)
        middle = self.article()
        if d.random() < 0.3:
            middle = f"<main>{middle}</main>" if "<main" not in middle else middle
        if d.random() < 0.3:
            middle = f'<div class="{d.choice(("wrapper", "container", "page", "row"))}">{middle}</div>'
        return f"<html><head><title>{self.words(1, 5)}</title></head><body>{''.join(before)}{middle}{''.join(after)}</body></html>"


def labelled_pages(n: int = 400, seed: int = 7) -> list[list[Block]]:
    """Blocks of ``n`` pages with labels: 1 for the main text, 0 for all else."""
    maker = Maker(seed)
    return [blocks for blocks in (blocks_of(maker.page()) for _ in range(n)) if blocks]
