"""Generated web pages with labelled main text, for training the extraction model.

Pages vary in their layout (semantic elements, named or nameless containers), in which
page furniture they have and where, in lengths and in link density. Words are random, so
only structure can be learned. MARK stands in every piece of main text.
"""

from __future__ import annotations

import random

MARK = "\x01"


def generated(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return [_page(rng) for _ in range(n)]


def _words(rng: random.Random, low: int, high: int) -> str:
    letters = "etaoinshrdlucmfwypvbgkéüñ"
    out = ["".join(rng.choices(letters, k=rng.randint(1, 10))) for _ in range(rng.randint(low, high))]
    for i in range(len(out)):
        if rng.random() < 0.1:
            out[i] += rng.choice(".,.,?!")
    return " ".join(out).capitalize() + rng.choice([".", ".", ""])


def _name(rng: random.Random, names: str) -> str:
    """A class or id attribute with one of the names, plain or part of a longer word, or none."""
    if rng.random() < 0.25:
        return ""
    name = rng.choice(names.split())
    name = rng.choice([name, name, f"{name}-box", f"site-{name}", f"{name} c{rng.randint(1, 99)}", f"{name}_wrap"])
    return f' {rng.choice(["class", "class", "id"])}="{name}"'


def _links(rng: random.Random, n: int) -> str:
    items = "".join(f'<li><a href="/{i}">{_words(rng, 1, 4)}</a></li>' for i in range(n))
    plain = " ".join(f'<a href="/{i}">{_words(rng, 1, 3)}</a>' for i in range(n))
    return rng.choice([f"<ul>{items}</ul>", f"<ul>{items}</ul>", plain, f"<p>{plain}</p>"])


def _box(rng: random.Random, tag: str, names: str, inner: str) -> str:
    """Furniture in its own element, or in a div that always says what it is."""
    if tag != "div" and rng.random() < 0.6:
        return f"<{tag}{_name(rng, names)}>{inner}</{tag}>"
    name = rng.choice(names.split())
    return f'<div {rng.choice(["class", "id", "role"])}="{name}">{inner}</div>'


def _furniture(rng: random.Random) -> dict[str, str]:
    p = lambda lo, hi: f"<p>{_words(rng, lo, hi)}</p>"
    say = lambda lo, hi: rng.choice([_words(rng, lo, hi), p(lo, hi)])
    comment = lambda: f'<div class="{rng.choice(["comment", "reply", "comment-body"])}">{p(1, 3)}{p(3, 60)}</div>'
    replies = "".join(comment() for _ in range(rng.randint(1, 6)))
    teasers = "".join(f'<li><a href="/t">{_words(rng, 4, 12)}</a></li>' for _ in range(rng.randint(2, 6)))
    return {
        "header": _box(rng, "header", "header masthead topbar banner branding", rng.choice(["", "<h1>" + _words(rng, 1, 3) + "</h1>"]) + say(1, 10)),
        "nav": _box(rng, "nav", "nav menu navigation navbar breadcrumb", _links(rng, rng.randint(2, 14))),
        "ad": _box(rng, "div", "ad ads advert advertisement sponsor sponsored promo", say(1, 50)),
        "notice": _box(rng, "div", "cookie consent notice alert popup notification message", say(4, 60)),
        "aside": _box(rng, "aside", "sidebar widget aside rail related", rng.choice(["<h3>" + _words(rng, 1, 4) + "</h3>", ""]) + _links(rng, rng.randint(1, 8)) + rng.choice(["", p(2, 70)])),
        "related": _box(rng, "aside", "related recommended popular more teaser trending", f"<h3>{_words(rng, 1, 3)}</h3><ul>{teasers}</ul>"),
        "share": _box(rng, "div", "share social sharing follow tools", _links(rng, rng.randint(1, 5))),
        "form": f'<form{_name(rng, "search subscribe newsletter login form")}><label>{_words(rng, 1, 5)}</label><input name="q">{rng.choice(["", p(2, 30)])}<button>{_words(rng, 1, 2)}</button></form>',
        "comments": _box(rng, "section", "comments comment-list respond discussion replies reader-comments", f"<h3>{_words(rng, 1, 3)}</h3>{replies}"),
        "footer": _box(rng, "footer", "footer foot bottom copyright", "&copy; " + say(1, 30) + rng.choice(["", _links(rng, rng.randint(1, 8))])),
    }


def _main(rng: random.Random, extra: list[str]) -> str:
    """The article's inside: marked text in usual elements, with furniture between some of them."""
    tiny = rng.random() < 0.25
    m = lambda lo, hi: MARK + _words(rng, 1 if tiny else lo, 4 if tiny else hi)
    parts = []
    title = f"<h{rng.choice('1112')}>{m(2, 14)}</h1>"
    parts.append(rng.choice([title, title, f"<header>{title}<p>{m(3, 20)}</p></header>", ""]))
    for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12, 20])):
        kind = rng.random()
        if kind < 0.62:
            parts.append(f"<p>{m(1, 130)}</p>")
        elif kind < 0.68:
            parts.append(f"<p><b>{m(3, 80)}<br>")
        elif kind < 0.73:
            parts.append(f'<p>{m(3, 50)} <a href="/x">{_words(rng, 1, 4)}</a> {_words(rng, 2, 30)}</p>')
        elif kind < 0.79:
            parts.append(f"<h{rng.choice('23')}>{m(1, 8)}</h2>")
        elif kind < 0.86:
            tag = rng.choice(["ul", "ol"])
            parts.append(f"<{tag}>" + "".join(f"<li>{m(1, 30)}</li>" for _ in range(rng.randint(2, 7))) + f"</{tag}>")
        elif kind < 0.9:
            parts.append(f"<blockquote>{rng.choice([m(3, 40), f'<p>{m(3, 40)}</p>'])}</blockquote>")
        elif kind < 0.93:
            rows = "".join(f"<tr><td>{m(1, 5)}</td><td>{m(1, 5)}</td></tr>" for _ in range(rng.randint(1, 5)))
            parts.append(f"<table>{rows}</table>")
        elif kind < 0.96:
            parts.append(f"<pre>{m(3, 40)}</pre>")
        else:
            parts.append(f'<figure><img src="i"><figcaption>{m(2, 20)}</figcaption></figure>')
    for x in extra:
        parts.insert(rng.randint(1, len(parts)), x)
    return "".join(parts)


def _page(rng: random.Random) -> str:
    f = _furniture(rng)
    has = lambda share: rng.random() < share
    inside = [f[k] for k, share in (("ad", 0.2), ("share", 0.15), ("related", 0.1)) if has(share)]
    body = _main(rng, inside)
    if has(0.15):
        body += rng.choice([f["comments"], f["form"], f["share"]])
    names = "article post entry story content main-text"
    article = rng.choice([
        f"<article>{body}</article>", f"<article>{body}</article>", f"<article{_name(rng, names)}>{body}</article>", f"<main>{body}</main>",
        f"<main><article>{body}</article></main>", f'<div class="{rng.choice(names.split())}">{body}</div>', f"<div>{body}</div>", f"<section{_name(rng, names)}>{body}</section>",
    ])
    top = "".join(f[k] for k, share in (("notice", 0.3), ("header", 0.5), ("nav", 0.75), ("ad", 0.45), ("form", 0.2)) if has(share))
    side = "".join(f[k] for k, share in (("aside", 0.35), ("related", 0.2), ("ad", 0.15)) if has(share))
    end = "".join(f[k] for k, share in (("share", 0.2), ("comments", 0.3), ("form", 0.2), ("related", 0.2), ("footer", 0.8), ("notice", 0.15)) if has(share))
    middle = rng.choice([side + article, article + side])
    if has(0.35):
        middle = f"<div{_name(rng, 'container wrapper page layout row content')}>{middle}</div>"
    head = f"<head><title>{_words(rng, 1, 8)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
    return f"<!DOCTYPE html><html>{head if has(0.9) else ''}<body>{top}{middle}{end}</body></html>"
