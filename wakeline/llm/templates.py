"""Pages of known parts, to teach the extractor what surrounds an article."""

from __future__ import annotations

import random

# Fixed lists: ways to wrap an article, and to write each kind of thing around and inside it.
ARTICLE = (
    ("<article>", "</article>"), ("<article>", "</article>"), ('<article class="post">', "</article>"), ("<main>", "</main>"),
    ('<main id="main"><article>', "</article></main>"), ('<div class="post-content">', "</div>"), ('<div id="content">', "</div>"),
    ('<section class="entry-content">', "</section>"), ('<div class="article-body" itemprop="articleBody">', "</div>"),
    ('<div id="main-content"><div class="story">', "</div></div>"), ('<div class="wrapper"><article><div class="body">', "</div></article></div>"),
)
MENU = (("<nav>", "</nav>"), ('<nav class="menu">', "</nav>"), ('<div class="menu">', "</div>"), ('<div id="nav">', "</div>"), ('<ul class="breadcrumb">', "</ul>"), ('<div role="navigation">', "</div>"))
HEADER = (("<header>", "</header>"), ('<div id="header">', "</div>"), ('<header class="site-header">', "</header>"), ('<div class="masthead" role="banner">', "</div>"))
FOOTER = (("<footer>", "</footer>"), ('<footer class="site-footer">', "</footer>"), ('<div id="footer">', "</div>"), ('<div class="footer copyright">', "</div>"))
ADVERT = (('<div class="ad">', "</div>"), ('<div class="advert">', "</div>"), ('<div class="ads banner">', "</div>"), ('<aside class="sponsored">', "</aside>"), ('<div id="promo">', "</div>"), ('<p class="ad">', "</p>"), ('<section class="advertisement">', "</section>"))
NOTICE = (('<div class="cookie-notice">', "</div>"), ('<div class="notice">', "</div>"), ('<div id="consent" role="dialog">', "</div>"), ('<div class="cookie-banner popup">', "</div>"), ('<p class="notice">', "</p>"), ('<div role="alert">', "</div>"), ('<div class="subscribe newsletter">', "</div>"))
SIDEBAR = (("<aside>", "</aside>"), ('<aside class="sidebar">', "</aside>"), ('<div class="sidebar">', "</div>"), ('<div id="sidebar">', "</div>"), ('<section class="related">', "</section>"), ('<div class="widget">', "</div>"), ('<div class="share social">', "</div>"))
COMMENTS = (('<section class="comments">', "</section>"), ('<div id="comments">', "</div>"), ('<div class="comment-list">', "</div>"), ('<ol class="comments">', "</ol>"), ('<section id="responses" class="reader-comments">', "</section>"), ('<div class="comment">', "</div>"))
FORM = (("<form>", "</form>"), ('<form class="search">', "</form>"), ('<form action="/login">', "</form>"), ('<div class="form"><form>', "</form></div>"))
MARK = "\x01"  # begins every text of the article


def page(rng: random.Random, pool: list[str]) -> str:
    """One page; the texts of its article begin with MARK."""
    some = lambda: rng.choice(pool)
    word = lambda: rng.choice(some().split() or ["word"])

    def wrapped(kinds, inner):
        a, b = rng.choice(kinds)
        return a + inner + b

    def links(n):
        if rng.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(n)) + "</ul>"
        return "".join(f'<a href="#">{word()}</a> ' for _ in range(n))

    def loose():
        return rng.choice((some(), f"<p>{some()}</p>", f"<h3>{word()}</h3><p>{some()}</p>", f'<a href="/x">{some()}</a>', f"<span>{some()}</span>"))

    def fields():
        return "".join(rng.choice((f"<label>{word()}</label><input>", f"<button>{word()}</button>", f"<p>{some()}</p>", "<textarea></textarea>")) for _ in range(rng.randint(1, 3)))

    def remarks():
        items = "".join(rng.choice(("<li><p>{}</p></li>", "<div><b>name</b><p>{}</p></div>", "<article><p>{}</p></article>", '<div class="comment"><p>{}</p></div>', "<p>{}</p>")).format(some()) for _ in range(rng.randint(1, 4)))
        return wrapped(COMMENTS, (f"<h2>{word()}</h2>" if rng.random() < 0.5 else "") + items)

    def around():
        return rng.choice((
            lambda: wrapped(ADVERT, loose()), lambda: wrapped(NOTICE, loose()), lambda: wrapped(SIDEBAR, links(3) if rng.random() < 0.4 else loose()),
            lambda: wrapped(FORM, fields()),
        ))()

    def paragraph():
        text = MARK + some()
        kind = rng.random()
        if kind < 0.55:
            return f"<p>{text}</p>"
        if kind < 0.65:
            return f"<p><b>{text}<br>"
        if kind < 0.72:
            return f'<p>{text} <a href="/a">{MARK}{word()}</a> {MARK}{word()}</p>'
        if kind < 0.78:
            return f"<h2>{MARK}{word()} {word()}</h2><p>{text}</p>"
        if kind < 0.84:
            return "<ul>" + "".join(f"<li>{MARK}{some()}</li>" for _ in range(rng.randint(2, 4))) + "</ul>"
        if kind < 0.88:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.92:
            return f"<table><tr><td>{text}</td><td>{MARK}{word()}</td></tr></table>"
        if kind < 0.96:
            return f"<div>{text}</div>"
        return f"<p>{MARK}{word()}</p>"

    title = f"<h1>{MARK}{some()[:60]}</h1>"
    body = [f"<header>{title}</header>" if rng.random() < 0.15 else title] if rng.random() < 0.9 else []
    for _ in range(rng.choice((1, 1, 2, 3, 4, 6, 9, 14))):
        body.append(paragraph())
        if rng.random() < 0.08:
            body.append(around())
    if rng.random() < 0.1:
        body.append(remarks())
    a, b = rng.choice(ARTICLE)
    article = a + "".join(body) + b
    top = [wrapped(MENU, links(rng.randint(2, 8)))] if rng.random() < 0.9 else []
    if rng.random() < 0.35:
        top.append(wrapped(HEADER, f"<h1>{word()}</h1>" + (links(3) if rng.random() < 0.5 else f"<p>{some()}</p>")))
    top += [around() for _ in range(rng.choice((0, 1, 1, 2)))]
    rng.shuffle(top)
    low = [around() for _ in range(rng.choice((0, 0, 0, 1, 2)))] + ([remarks()] if rng.random() < 0.35 else [])
    if rng.random() < 0.9:
        low.append(wrapped(FOOTER, rng.choice((f"&copy; {word()} &middot; {some()}", f"<p>{some()}</p>", links(3) + some()))))
    inner = "".join(top) + article + "".join(low)
    if rng.random() < 0.3:
        inner = f'<div class="{rng.choice(("page", "container", "wrap", "site"))}">{inner}</div>'
    tail = "</body></html>" if rng.random() < 0.9 else ""
    return f"<!DOCTYPE html><html><head><title>{word()}</title><style>p{{}}</style></head><body>{inner}{tail}"
