"""Labelled pages for the main-text model: text of real pages laid out as sites do.

A main element carries the attribute ``data-main``, an element inside it that is no main text ``data-other``.
"""

from __future__ import annotations

import html as _html
import random
import re

from swathbook.llm.html_blocks import parse

# Names that sites give to the parts of their pages.
MAIN_NAMES = (
    "article article-body article-content article-text content content-body entry entry-content main main-content page-content "
    "post post-body post-content story story-body text body-text blog-post single"
).split()
MENU_NAMES = "nav navbar navigation menu main-menu top-menu breadcrumb breadcrumbs site-nav tabs pagination toc".split()
HEADER_NAMES = "header site-header page-header masthead topbar top-bar banner branding logo".split()
FOOTER_NAMES = "footer site-footer page-footer bottom copyright legal colophon credits".split()
SIDE_NAMES = "sidebar side aside widget related related-posts recommended trending popular more-stories share social sharing tags".split()
ADVERT_NAMES = "ad ads advert advertisement ad-slot ad-banner sponsored sponsor promo promotion adsbygoogle".split()
NOTICE_NAMES = "notice cookie-notice cookie-banner cookies consent gdpr alert warning popup modal overlay paywall message toast".split()
FORM_NAMES = "form search search-form login signup subscribe newsletter contact-form poll survey".split()
COMMENT_NAMES = "comments comment-list comment comment-body reader-comments replies reply discussion responses disqus reactions".split()
#: Elements that mark such a part by themselves.
OWN_TAGS = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form", "main": "article"}

_ARTICLE = re.compile(r"<article(?=[\s/>])", re.I)


def marked(page: str) -> str:
    """A page whose first article element is its main text, with that element marked."""
    return _ARTICLE.sub("<article data-main", page, count=1)


def texts_of(page: str) -> tuple[list[str], list[str]]:
    """(prose, short texts) of a page: blocks of an article, or without one long ones without links; all other blocks."""
    blocks, _ = parse(marked(page))
    article = any(b.node.main for b in blocks)
    inside = [b.node.main if article else len(b.text) > 80 and b.links == 0 for b in blocks]
    return [b.text for b, i in zip(blocks, inside, strict=True) if i], [b.text for b, i in zip(blocks, inside, strict=True) if not i]


class _Writer:
    def __init__(self, rng: random.Random, prose: list[str], short: list[str]):
        self.rng, self.prose, self.short = rng, prose, short or ["Home"]
        self.mark = ""

    def sentence(self, words: int) -> str:
        all_words = self.rng.choice(self.prose).split()
        at = self.rng.randrange(len(all_words))
        return _html.escape(" ".join(all_words[at : at + words]) or self.rng.choice(self.short))

    def box(self, kind: str, names: list[str], inner: str, plain: float = 0.15, mark: str = "") -> str:
        """An element around ``inner``: by its own tag or a div, with or without a name, sometimes inside a further div."""
        rng = self.rng
        own = kind in OWN_TAGS and rng.random() < 0.5
        tag = OWN_TAGS[kind] if own else rng.choice(["div", "div", "div", "section"] + (["ul"] if kind == "menu" and "<li>" in inner else []))
        name = "" if rng.random() < (0.6 if own else plain) else f' {rng.choice(["class", "class", "id"])}="{self._styled(rng.choice(names))}"'
        out = f"<{tag}{name}{mark or self.mark}>{inner}</{tag}>"
        return f'<div class="{rng.choice(["row", "col", "wrap", "inner", "container", "box"])}">{out}</div>' if rng.random() < 0.3 else out

    def _styled(self, name: str) -> str:
        parts = name.split("-")
        style = self.rng.randrange(4)
        if style == 0:
            return "_".join(parts)
        if style == 1:
            return parts[0] + "".join(p.capitalize() for p in parts[1:])
        return name if style == 2 else f"{name} {self.rng.choice(['clearfix', 'box', 'x1', 'col-8', 'mb-2'])}"

    def links(self, count: int) -> str:
        each = [f'<a href="/{i}">{self.sentence(self.rng.randint(1, 4))}</a>' for i in range(count)]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{a}</li>" for a in each) + "</ul>"
        return self.rng.choice([" | ", " ", " &middot; "]).join(each)

    def menu(self) -> str:
        return self.box("menu", MENU_NAMES, self.links(self.rng.randint(2, 9)))

    def header(self) -> str:
        inner = f"<{(t := self.rng.choice(['div', 'h1', 'h2', 'p']))}>{self.sentence(self.rng.randint(1, 6))}</{t}>"
        return self.box("header", HEADER_NAMES, inner + (self.menu() if self.rng.random() < 0.5 else ""), 0.05)

    def footer(self) -> str:
        rng = self.rng
        inner = rng.choice([f"&copy; {self.sentence(2)} &middot; {self.sentence(rng.randint(3, 15))}", f"<p>{self.sentence(rng.randint(4, 30))}</p>", f"<p>&copy; 20{rng.randint(10, 29)} {self.sentence(3)}</p>"])
        return self.box("footer", FOOTER_NAMES, inner + (self.links(rng.randint(2, 6)) if rng.random() < 0.4 else ""), 0.05)

    def side(self) -> str:
        rng = self.rng
        inner = f"<h3>{self.sentence(rng.randint(1, 4))}</h3>" + rng.choice([self.links(rng.randint(2, 6)), f"<p>{self.sentence(rng.randint(5, 40))}</p>"])
        return self.box("side", SIDE_NAMES, inner, 0.02)

    def advert(self) -> str:
        text = self.sentence(self.rng.randint(2, 30))
        return self.box("advert", ADVERT_NAMES, self.rng.choice([text, f"<p>{text}</p>", f'<a href="/x">{text}</a>']), 0.0)

    def notice(self) -> str:
        text = self.sentence(self.rng.randint(3, 40))
        if self.rng.random() < 0.15:
            return self.rng.choice([f'<div role="alert"{self.mark}>{text}</div>', f"<dialog open{self.mark}><p>{text}</p></dialog>", f"<div hidden{self.mark}><p>{text}</p></div>", f'<p style="display:none"{self.mark}>{text}</p>'])
        return self.box("notice", NOTICE_NAMES, self.rng.choice([text, f"<p>{text}</p><button>OK</button>"]), 0.0)

    def form(self) -> str:
        inner = f"<label>{self.sentence(2)}</label><input name=q>" + self.rng.choice(["", f"<p>{self.sentence(self.rng.randint(4, 30))}</p>", f"<h3>{self.sentence(4)}</h3>"]) + "<button>Go</button>"
        return self.box("form", FORM_NAMES, inner if self.rng.random() < 0.6 else f"<form>{inner}</form>", 0.0)

    def comments(self) -> str:
        rng = self.rng
        each = ""
        for _ in range(rng.randint(1, 5)):
            body = f"<p>{self.sentence(rng.randint(3, 60))}</p>"
            tag, name = rng.choice(["div", "li", "article", "section"]), rng.choice(["comment", "reply", "comment-body", ""])
            each += f'<{tag} class="{name}">{rng.choice(["", f"<b>{self.sentence(1)}</b>", f"<h4>{self.sentence(2)}</h4>"])}{body}</{tag}>' if name else f"<{tag}>{body}</{tag}>"
        return self.box("comments", COMMENT_NAMES, f"<h3>{self.sentence(rng.randint(1, 3))}</h3>" * (rng.random() < 0.6) + each, 0.0)

    def paragraph(self, text: str) -> str:
        rng, text = self.rng, _html.escape(text)
        words = text.split(" ")
        if len(words) > 8 and rng.random() < 0.3:
            i = rng.randrange(len(words) - 3)
            tag = rng.choice(["b", "em", "a href=/y", "span class=hl"])
            words[i] = f"<{tag}>{words[i]}"
            words[i + 2] += f"</{tag.split()[0]}>"
        text = " ".join(words)
        kind = rng.random()
        if kind < 0.72:
            return rng.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br></p>", f"<div>{text}</div>"])
        if kind < 0.8:
            return f"<ul><li>{text}</li><li>{self.sentence(rng.randint(2, 14))}</li></ul>"
        if kind < 0.88:
            return f"<h2>{self.sentence(rng.randint(1, 7))}</h2><p>{text}</p>"
        if kind < 0.92:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.95:
            return f"<table><tr><th>{self.sentence(2)}</th><td>{text}</td></tr></table>"
        return rng.choice([f"<pre>{text}</pre>", f"<figure><img src=x><figcaption>{text}</figcaption></figure>", f"<dl><dt>{self.sentence(2)}<dd>{text}</dl>"])

    def main(self) -> tuple[str, str]:
        """The marked main element and its heading; boxes of other kinds may lie in it, unmarked."""
        rng = self.rng
        start = rng.randrange(len(self.prose))
        texts = (self.prose[start:] + self.prose[:start])[: rng.randint(1, 9)]
        heading = " ".join(texts[0].split()[: rng.randint(2, 10)])
        parts = [f"<div>{self.paragraph(t)}</div>" if rng.random() < 0.1 else self.paragraph(t) for t in texts]
        if rng.random() < 0.75:
            head = f"<h1>{_html.escape(heading)}</h1>"
            parts.insert(0, f"<header>{head}</header>" if rng.random() < 0.1 else head)
        return "".join(parts), heading


def laid_out(prose: list[str], short: list[str], seed: int) -> str:
    """A labelled page of the given texts (``prose`` not empty) with the usual parts around and inside its main text."""
    rng = random.Random(seed)
    w = _Writer(rng, prose, short)
    before = [w.header] * (rng.random() < 0.6) + [w.menu] * (rng.random() < 0.6) + [w.advert] * (rng.random() < 0.5) + [w.notice] * (rng.random() < 0.4) + [w.form] * (rng.random() < 0.3) + [w.side] * (rng.random() < 0.3)
    after = [w.comments] * (rng.random() < 0.5) + [w.side] * (rng.random() < 0.5) + [w.advert] * (rng.random() < 0.3) + [w.form] * (rng.random() < 0.3) + [w.notice] * (rng.random() < 0.2)
    rng.shuffle(before)
    rng.shuffle(after)
    after += [w.footer] * (rng.random() < 0.8)
    inner = [w.advert, w.advert, w.side, w.notice, w.form, w.menu, w.comments]
    body, heading = w.main()
    pieces = re.split(r"(?=<h2>|<p>|<ul>)", body)
    for _ in range(rng.choice([0, 1, 2, 4])):
        w.mark = " data-other"
        pieces.insert(rng.randint(1, len(pieces)), rng.choice(inner)())
        w.mark = ""
    main = w.box("main", MAIN_NAMES, "".join(pieces), 0.12, " data-main")
    if rng.random() < 0.15:
        main = f"<main>{main}</main>"
    parts = [b() for b in before] + [main] + [b() for b in after]
    middle = "".join(parts)
    if rng.random() < 0.1:
        middle = "<table><tr>" + "".join(f"<td>{p}</td>" for p in parts) + "</tr></table>"
    head = f"<head><title>{_html.escape(heading)}</title><style>p{{}}</style></head>" if rng.random() < 0.8 else ""
    return f"<!DOCTYPE html><html>{head}<body>{middle}</body></html>"
