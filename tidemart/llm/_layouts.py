"""Invented pages with known main text, to train and to test the block labeller.

Sections, their names and their order are drawn at random; texts come from a pool.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from html import escape

# Names that sites give to parts of a page, and phrases found there (fixed values).
MAIN = """article content main main-content post post-content post-body entry entry-content story
story-body article-body body-text page-content single hentry blog-post articleBody""".split()
NAV = "nav menu navbar navigation main-menu topnav breadcrumb breadcrumbs sitemap pagination pager tabs".split()
HEADER = "header site-header masthead topbar page-header branding banner logo".split()
FOOTER = "footer site-footer bottom colophon copyright legal page-footer".split()
SIDE = "sidebar aside widget rail secondary related related-posts trending popular recommended".split()
ADVERT = "ad ads advert advertisement sponsor sponsored promo adslot promoted ad-banner".split()
NOTICE = "cookie cookie-banner consent notice alert gdpr popup modal message paywall announcement".split()
FORM = "search search-form login subscribe newsletter contact-form signup".split()
COMMENTS = "comments comment-list comment responses replies discussion disqus reader-comments".split()
META = "share social share-buttons byline tags author-box post-meta article-meta".split()
NEUTRAL = "container wrapper row col inner box grid left right center block layout page wrap cell".split()
PHRASES = {
    "nav": """Home|About|Contact|Archive|News|Sports|Blog|Login|Sign up|Next page|Previous|Products
        |Skip to content|Startseite|Kontakt|Accueil|Inicio|Menu|World|Shop|Help|Topics""",
    "header": "Daily News|My Blog|The Herald|Welcome|Your source for everything|Search this site",
    "footer": """© 2024 All rights reserved.|Privacy policy|Terms of use|Imprint|Impressum|Powered by
        |Contact us|Copyright|Mentions légales|Aviso legal|Follow us|Sitemap""",
    "side": """Related articles|Most read|You may also like|Trending now|Recent posts|Categories
        |Popular|Tags|Archives|More from this section""",
    "advert": "Advertisement|Sponsored|Buy now and save|Anzeige|Publicité|Publicidad|Special offer",
    "notice": """We use cookies to improve your experience.|Accept all cookies|This site uses cookies.
        |Subscribe to continue reading.|Diese Website verwendet Cookies.|You have been logged out.
        |Javascript is disabled in your browser.|Ce site utilise des cookies.""",
    "form": "Search|Your e-mail|Sign up for our newsletter|Password|Subscribe|Name|Leave a reply|Send",
    "meta": """Share this|Tweet|By the editors|Published on 3 May 2021|5 min read|Print
        |Filed under|Updated yesterday|Share on Facebook""",
    "comments": "Comments|3 comments|Leave a comment|Reply|Report|Join the discussion|Responses",
}
PHRASES = {k: [p.strip() for p in v.split("|")] for k, v in PHRASES.items()}
SECTION = {
    "nav": ("nav", NAV),
    "header": ("header", HEADER),
    "footer": ("footer", FOOTER),
    "side": ("aside", SIDE),
    "advert": ("div", ADVERT),
    "notice": ("div", NOTICE),
    "form": ("form", FORM),
    "meta": ("div", META),
    "comments": ("section", COMMENTS),
}


class Layout:
    """One page: its markup, and whether each block in it is main text."""

    def __init__(self, rng: random.Random, pool: Sequence[str], spare: Sequence[str] = ()) -> None:
        self.rng, self.pool, self.spare = rng, pool, spare
        # Some sites name nothing, or name all with words not seen elsewhere.
        self.named = rng.random() < 0.8
        self.semantic = rng.random() < 0.6
        self.html: list[str] = []
        self.main: list[bool] = []
        self._page()

    def _some(self, names: Sequence[str]) -> str:
        return self.rng.choice(names)

    def _attr(self, names: Sequence[str], always: bool = False) -> str:
        if not (self.named or always) and self.rng.random() < 0.9:
            names = NEUTRAL if self.rng.random() < 0.5 else [f"x{self.rng.randrange(999)}"]
        kind = self._some(["class", "class", "class", "id"])
        value = self._some(names)
        if kind == "class" and self.rng.random() < 0.3:
            value += " " + self._some(NEUTRAL)
        return f' {kind}="{value}"'

    def _open(self, tag: str, names: Sequence[str] = (), chance: float = 0.9) -> str:
        """Opens a section, under its own element if the site uses such; returns its name."""
        own = self.semantic or tag in ("form", "div")
        name = tag if own else "div"
        always = not own and self.rng.random() < 0.6
        attr = self._attr(names, always) if names and self.rng.random() < (chance if own else 1) else ""
        self.html.append(f"<{name}{attr}>")
        return name

    def _block(self, tag: str, text: str, main: bool, attr: str = "") -> None:
        text = " ".join(text.split())
        if not text:
            return
        close = "" if tag in ("p", "li") and self.rng.random() < 0.15 else f"</{tag}>"
        self.html.append(f"<{tag}{attr}>{self._inline(text)}{close}")
        self.main.append(main)

    def _inline(self, text: str) -> str:
        words = text.split(" ")
        if len(words) > 4 and self.rng.random() < 0.3:
            at = self.rng.randrange(len(words) - 2)
            tag = self._some(["b", "i", "em", "strong", "a", "span"])
            inner = escape(" ".join(words[at : at + 2]))
            attr = ' href="/x"' if tag == "a" else ""
            parts = [escape(" ".join(words[:at])), f"<{tag}{attr}>{inner}</{tag}>"]
            return " ".join([*parts, escape(" ".join(words[at + 2 :]))]).strip()
        return escape(text)

    def _prose(self, least: int = 8, most: int = 60) -> str:
        words = self.rng.choice(self.pool).split()
        n = self.rng.randint(least, most)
        at = self.rng.randrange(max(1, len(words) - n + 1))
        return " ".join(words[at : at + n])

    def _short(self, kind: str) -> str:
        what = self.rng.random()
        if what < 0.5:
            return self._some(PHRASES[kind])
        if what < 0.7 and self.spare:
            return self._some(self.spare)
        return self._prose(1, 8)

    def _links(self, kind: str, n: int) -> None:
        item = self._some(["li", "li", "div", "p"])
        self.html.append("<ul>" if item == "li" else "")
        for _ in range(n):
            self.html.append(f'<{item}><a href="/{self.rng.randrange(99)}">{escape(self._short(kind))}</a></{item}>')
            self.main.append(False)
        self.html.append("</ul>" if item == "li" else "")

    def _other(self, kind: str) -> None:
        """A section that is not main text."""
        tag, names = SECTION[kind]
        name = self._open(tag, names)
        if self.rng.random() < 0.3:
            self.html.append(f"<div{self._attr(NEUTRAL)}>")
            name = f"div></{name}"
        if kind == "comments":
            self._block(self._some(["h2", "h3", "h4"]), self._some(PHRASES[kind]), False)
            item = self._some(["div", "div", "li", "article", ""])
            author = self.rng.random() < 0.7
            for _ in range(self.rng.randint(1, 5)):
                self.html.append(f"<{item}{self._attr(COMMENTS)}>" if item else "")
                if author:
                    self._block(self._some(["div", "p", "h4"]), self._prose(1, 2), False)
                self._block("p", self._prose(5, 50), False)
                self.html.append(f"</{item}>" if item else "")
        elif kind in ("nav", "footer", "side"):
            if kind == "side" or self.rng.random() < 0.2:
                self._block(self._some(["h2", "h3", "h4", "div"]), self._short(kind), False)
            self._links(kind, self.rng.randint(1, 8))
            if kind != "nav":
                for _ in range(self.rng.randint(0, 2)):
                    self._block("p", self._prose(3, 30) if kind == "side" else self._short(kind), False)
        elif kind == "form":
            for _ in range(self.rng.randint(1, 3)):
                self._block(self._some(["label", "p", "div"]), self._short(kind), False)
                self.html.append('<input type="text"><div></div>')
        else:
            for _ in range(self.rng.randint(1, 3)):
                tag = "h1" if kind == "header" and self.rng.random() < 0.3 else self._some(["p", "div", "p"])
                text = self._prose(3, 25) if kind == "advert" and self.rng.random() < 0.6 else self._short(kind)
                self._block(tag, text, False)
        self.html.append(f"</{name}>")

    def _main(self) -> None:
        depth = self.rng.randint(1, 3)
        closing = []
        for k in range(depth):
            tag = self._some(["article", "main", "div", "section"]) if k < 2 else "div"
            closing.append(self._open(tag, MAIN if k == depth - 1 or self.rng.random() < 0.5 else NEUTRAL, 0.6))
        heading = self.rng.random() < 0.9
        if heading:
            header = self.rng.random() < 0.2
            self.html.append("<header>" if header and self.semantic else "")
            self._block("h1", self._prose(3, 14), True)
            if self.rng.random() < 0.3:
                self._other("meta")
            self.html.append("</header>" if header and self.semantic else "")
        for _ in range(self.rng.randint(1, 12)):
            what = self.rng.random()
            if what < 0.03:  # short lines, the same again and again
                line = self._prose(1, 4)
                for _ in range(self.rng.randint(1, 6)):
                    self._block("p", line, True)
            elif what < 0.06:  # what other sections say, said by the article
                self._block("p", self._some(PHRASES[self._some(list(PHRASES))]), True)
            elif what < 0.72:
                self._block("p", self._prose(1 if self.rng.random() < 0.15 else 8, 60), True)
            elif what < 0.79:
                self._block(self._some(["h2", "h3"]), self._prose(2, 8), True)
            elif what < 0.85:
                self.html.append("<ul>")
                for _ in range(self.rng.randint(2, 5)):
                    self._block("li", self._prose(2, 20), True)
                self.html.append("</ul>")
            elif what < 0.89:
                self.html.append("<blockquote>")
                self._block("p", self._prose(6, 30), True)
                self.html.append("</blockquote>")
            elif what < 0.91:
                self._block("pre", self._prose(6, 30), True)
            elif what < 0.93:
                self.html.append('<figure><img src="/i.png">')
                self._block("figcaption", self._prose(3, 14), True)
                self.html.append("</figure>")
            elif what < 0.95:
                self.html.append("<table>")
                for _ in range(self.rng.randint(1, 3)):
                    self.html.append("<tr>")
                    self._block("td", self._prose(1, 4), True)
                    self._block("td", self._prose(1, 4), True)
                    self.html.append("</tr>")
                self.html.append("</table>")
            else:
                self._other(self._some(["advert", "advert", "meta", "side", "form"]))
        if self.rng.random() < 0.25:
            self._other(self._some(["meta", "side", "comments"]))
        for tag in reversed(closing):
            self.html.append(f"</{tag}>")

    def _page(self) -> None:
        chance = self.rng.random
        self.html.append("<html><head><title>t</title><style>p{}</style></head><body>")
        outer = [self._open("div", NEUTRAL) for _ in range(self.rng.randint(0, 2))]
        for kind, p in (("notice", 0.3), ("header", 0.5), ("nav", 0.7), ("advert", 0.4), ("form", 0.2), ("side", 0.25)):
            if chance() < p:
                self._other(kind)
        self._main()
        for kind, p in (("advert", 0.2), ("comments", 0.35), ("side", 0.4), ("nav", 0.2), ("form", 0.2), ("footer", 0.8), ("notice", 0.2)):
            if chance() < p:
                self._other(kind)
        self.html += [f"</{tag}>" for tag in reversed(outer)]
        if chance() < 0.9:
            self.html.append("</body></html>")

    @property
    def page(self) -> str:
        return "".join(self.html)
