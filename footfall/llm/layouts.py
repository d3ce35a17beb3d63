"""Made-up page layouts with known main text, to train on.

Real pages carry no labels. Their text is dealt anew into layouts whose parts are known: an article between
menus, headers, sidebars, notices, adverts, forms and comments, under element names and attributes that are
sometimes telling and sometimes not.
"""

from __future__ import annotations

import random
from html import escape

#: Element names and attribute words that page authors give to the parts of a page.
PARTS = {
    "menu": ("nav div ul section", "menu nav navigation navbar breadcrumb breadcrumbs tabs pagination pager toolbar links categories tags"),
    "header": ("header div", "header masthead top topbar logo branding banner"),
    "footer": ("footer div", "footer foot bottom copyright colophon legal"),
    "sidebar": ("aside div section", "sidebar side aside rail widget related recommended trending popular more"),
    "notice": ("div section dialog aside p", "cookie cookies consent notice alert gdpr popup modal overlay message paywall subscribe newsletter warning"),
    "advert": ("div aside section p span", "ad ads advert adverts advertisement sponsor sponsored promo promoted promotion"),
    "form": ("form div", "form search login signup register contact"),
    "comments": ("section div ol ul", "comments comment discussion replies reply respond disqus thread responses reader reviews"),
    "share": ("div ul p", "share social sharing follow buttons tools"),
}
MAIN = ("article main div section td", "article content main post entry story body text prose copy document maincontent")
NEUTRAL = ("div section", "wrapper container page row col column grid inner outer site layout block box group root")


class Writer:
    def __init__(self, seed: int, blocks: list[str], phrases: list[str]):
        self.random = random.Random(seed)
        self.blocks, self.phrases = blocks, phrases

    def name(self, words: str) -> str:
        word = self.random.choice(words.split())
        other = self.random.choice(["list", "box", "wrap", "item", "area", "x", "1", "left", "right", "v2"])
        return self.random.choice([word, word, f"{word}-{other}", f"{other}_{word}", word + other.title(), word.title()])

    def attributes(self, words: str, telling: float) -> str:
        if self.random.random() > telling:
            return self.random.choice(["", f' class="{self.gibberish()}"', f" id='{self.gibberish()}'"])
        kind = self.random.choice(["class", "id", "class", "role"])
        extra = f" {self.gibberish()}" if self.random.random() < 0.3 else ""
        return f' {kind}="{self.name(words)}{extra}"'

    def gibberish(self) -> str:
        return "".join(self.random.choice("bcdfghjklmnpqrstvwxz") for _ in range(self.random.randint(2, 7)))

    def element(self, names: str, words: str, inside: str, main: int | None, telling: float = 0.8) -> str:
        name = self.random.choice(names.split())
        if name not in ("div", "section", "p", "span", "ul", "ol", "td") and self.random.random() < 0.5:
            telling = 0  # the element's name tells enough
        mark = "" if main is None else f" data-main={main}"
        if name == "td":
            return f"<table><tr><td{mark}{self.attributes(words, telling)}>{inside}</td></tr></table>"
        if name in ("p", "span"):
            inside = self.phrase()
        return f"<{name}{mark}{self.attributes(words, telling)}>{inside}</{name}>"

    def phrase(self, most: int = 14) -> str:
        words = self.random.choice(self.phrases).split()
        at = self.random.randrange(len(words))
        return escape(" ".join(words[at : at + self.random.randint(1, most)]))

    def links(self) -> str:
        rows = []
        shape = self.random.choice(["<li><a href='/x'>{}</a></li>", "<a href='/x'>{}</a> ", "<div><a href='#'>{}</a></div>", "<li>{}</li>"])
        for _ in range(self.random.randint(2, 12)):
            rows.append(shape.format(self.phrase(4)))
        rows = "".join(rows)
        return f"<ul>{rows}</ul>" if shape.startswith("<li") else rows

    def prose(self) -> str:
        text = escape(self.random.choice(self.blocks))
        kind = self.random.random()
        if kind < 0.1:
            text = f"<b>{text}<br>" if self.random.random() < 0.5 else f"<em>{text}</em>"
        elif kind < 0.2:
            words = text.split()
            at = self.random.randrange(len(words))
            words[at] = f"<a href='/y'>{words[at]}</a>"
            text = " ".join(words)
        return text

    def paragraphs(self, least: int, most: int) -> str:
        shape = self.random.choices(["<p>{}</p>", "<p>{}", "<div>{}</div>", "{}<br><br>"], [7, 2, 2, 1])[0]
        rows = []
        for _ in range(self.random.randint(least, most)):
            kind = self.random.random()
            if kind < 0.07:
                rows.append(f"<h{self.random.choice('234')}>{self.phrase(6)}</h2>")
            elif kind < 0.15:
                rows.append("<ul>" + "".join(f"<li>{self.phrase()}</li>" for _ in range(self.random.randint(2, 5))) + "</ul>")
            elif kind < 0.22:
                rows.append(shape.format(self.random.choice([self.phrase(2), "|", "*", self.phrase(1) + "."])))
            elif kind < 0.25:
                rows.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
            else:
                rows.append(shape.format(self.prose()))
        return "".join(rows)

    def part(self, kind: str, telling: float = 0.8) -> str:
        names, words = PARTS[kind]
        if kind == "menu":
            inside = self.links()
        elif kind == "comments":
            shape = self.random.choice(["<div class=comment><p>{}</p></div>", "<li>{}</li>", "<p>{}</p>", "<article>{}</article>"])
            inside = "<h3>{}</h3>".format(self.phrase(2)) + "".join(shape.format(self.prose()) for _ in range(self.random.randint(1, 6)))
        elif kind == "form":
            inside = f"<label>{self.phrase(3)}</label><input name=q><input type=submit>" + (f"<p>{self.phrase()}</p>" if self.random.random() < 0.4 else "")
        elif kind in ("sidebar", "header", "footer"):
            inside = self.random.choice([self.links(), f"<p>{self.phrase()}</p>", self.phrase(), f"&copy; {self.phrase(6)}", f"<h3>{self.phrase(4)}</h3>" + self.links()])
        elif kind == "share":
            inside = self.links()
        else:
            inside = self.random.choice([self.phrase(20), f"<p>{self.phrase(20)}</p>", f"<p>{self.prose()}</p>", f"{self.phrase()} <a href='/z'>{self.phrase(2)}</a>"])
        return self.element(names, words, inside, 0, telling)

    def some(self, kinds: list[str], chance: float = 0.5) -> str:
        kinds = [k for k in kinds if self.random.random() < chance]
        self.random.shuffle(kinds)
        return "".join(self.part(k) for k in kinds)

    def page(self) -> str:
        title = f"<h1>{self.phrase(10)}</h1>" if self.random.random() < 0.7 else ""
        if title and self.random.random() < 0.2:
            title = f"<header>{title}</header>"  # an article's own
        inside = title + self.paragraphs(1, 4)
        for _ in range(self.random.choice([0, 0, 0, 1, 2])):
            # Inside an article, only what its markup names can be told from the article's own lists and lines.
            inside += self.part(self.random.choice(["advert", "share", "sidebar", "notice"]), 1) + self.paragraphs(0, 4)
        if self.random.random() < 0.4:
            inside += self.paragraphs(3, 12)
        if self.random.random() < 0.2:
            inside += "".join(self.part(kind, 1) for kind in ("share", "form", "comments") if self.random.random() < 0.5)
        names, words = MAIN
        page = self.element(names, words, inside, 1)
        page = self.some(["sidebar", "menu"], 0.2) + page + self.some(["sidebar", "comments"], 0.3)
        for _ in range(self.random.choice([0, 0, 1, 2])):
            page = self.element(*NEUTRAL, page, None)
        before = self.some(["header", "menu", "notice", "advert", "form"])
        page = before + page + self.some(["comments", "sidebar", "footer", "notice", "advert", "form", "menu"])
        head = f"<head><title>{self.phrase(8)}</title><style>p{{}}</style></head>"
        page = f"<!DOCTYPE html><html>{head}<body>{page}</body></html>"
        return page[: self.random.randint(len(page) // 3, len(page))] if self.random.random() < 0.1 else page
