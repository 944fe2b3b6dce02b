"""Main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between the starts and ends of
block elements. Each block has binary features: the tags, class and id words and
roles of its ancestors, its own element, its text (length, share of links and
digits, punctuation, in scripts with and without blanks; stock phrases in short
blocks), whether it shares its parent with the block before, whether a heading of
comments came before it, and how much text the page has. The chain has two
labels, main text or not. It is trained by maximum likelihood (forward and
backward sums, Adam) on labelled pages that ``training_pages`` makes from a seed:
articles of any length in many kinds of mark-up and several scripts, alone or
among menus, headers, footers, sidebars, notices, adverts, forms and comments,
some of them without any telling class. Pages are decoded by Viterbi; of two
equally likely labels it takes "not". The trained weights, a few kilobytes, go to
the tasks; a page is handled in one of them.

Only scripts, styles, templates, frames, text areas, titles of the head and the
mark-up itself are left out before the chain decides. Blocks keep their whole
text, however long: character references decoded, white space turned into single
spaces, trimmed; empty blocks go. Main blocks are joined by line feeds in page
order.

Defined cases: null html is empty and gives the empty text; unclosed, stray and
misnested tags are tolerated; a ``<`` that starts no tag is text; repeated rows
and null ids are rows of their own; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import cache
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Elements by kind, from the public HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "template", "iframe", "textarea", "title")
#: Elements that are blocks of their own outside of a paragraph, and parts of its text in it.
EITHER = frozenset("audio canvas noscript object svg video".split())
#: Elements that a new start of one of the same kind closes, and where that search ends.
CLOSES_ITSELF = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",),
}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
_WORD = re.compile(r"[a-z]+")
#: Letters of scripts that write no blanks, and how many of them make a word, about.
_DENSE = ((re.compile(r"[\u2e80-\u9fff\U00020000-\U0003ffff]"), 2), (re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]"), 5))
#: Punctuation within and at the end of sentences, in several scripts.
_MARKS, _ENDS = ",.;\u060c\u3001\uff0c\uff1b\u3002\u0964", ".!?:\u2026\u061f\u06d4\u0964\u3002\uff01\uff1f\uff1a"
#: Stock phrases of what surrounds articles, in a few languages.
_SAYS = {
    "comments": r"\b(comments?|repl(?:y|ies)|responses?|discussion|commentaires?|r\u00e9ponses?|kommentare?|antworten|comentarios?|respuestas)\b",
    "consent": r"\b(cookies?|consent|privacy|javascript|datenschutz|confidentialit\u00e9|privacidad)\b",
    "offer": r"\b(subscribe|newsletter|sign (?:up|in)|log ?in|abonnieren|inscrivez|suscr\w+|sponsored|advertisement|anzeige|publicit\u00e9|publicidad)\b",
    "more": r"\b(related|read (?:more|next)|see also|share|popular|tags|mehr zum thema|\u00e0 lire aussi|m\u00e1s le\u00eddo)\b",
    "rights": r"\u00a9|\b(all rights reserved|copyright|terms of use|imprint|impressum)\b",
}
_SAYS = {k: re.compile(v, re.I) for k, v in _SAYS.items()}
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*+>", re.I) for t in RAW}


class Block:
    """A leaf block: its text, the characters of it in links, its ancestors' features (shared), its parent's number."""

    __slots__ = ("links", "parent", "path", "text")

    def __init__(self, text: str, links: int, path: tuple, parent: int):
        self.text, self.links, self.path, self.parent = text, links, path, parent


def blocks(html: str, known: frozenset[str] | None = None) -> list[Block]:
    """The leaf blocks of a page; paths hold only ``known`` features, if given. Time is linear in the page."""
    out: list[Block] = []
    stack: list[tuple[str, tuple, int]] = [("", (), 0)]  # tag, features of it and its ancestors, number
    buffer: list[str] = []
    state = {"link": 0, "links": 0, "n": 0}
    opened: Counter = Counter()  # elements on the stack, by tag
    unclosed: set[str] = set()  # raw elements whose end was looked for in vain
    last = html.rfind(">")

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            if text:
                out.append(Block(text, min(state["links"], len(text)), stack[-1][1], stack[-1][2]))
            buffer.clear()
        state["links"] = state["link"] = 0

    def pop_to(depth: int) -> None:
        flush()
        opened.subtract(x[0] for x in stack[depth:])
        del stack[depth:]

    def find(tags: tuple, stop: tuple = ()) -> int:
        if not any(opened[t] > 0 for t in tags):
            return 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in stop:
                return 0
        return 0

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0 or lt > last:
            lt = n  # no tag ends after this
        if lt > at:
            text = html[at:lt]
            buffer.append(text)
            if state["link"]:
                state["links"] += len(text)
        if lt == n:
            break
        m = _TOKEN.match(html, lt)
        if m is None:
            buffer.append("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        at = at + 1 if at < n and html[at] == ">" else html.find(">", lt) + 1  # a quote that never ends
        tag, closing = m[2].lower(), bool(m[1])
        if tag in _RAW_END and not closing:
            end = None if tag in unclosed else _RAW_END[tag].search(html, at)
            if end is None:
                unclosed.add(tag)
            at = end.end() if end else n if tag in ("script", "style") else at
        elif tag == "a":
            state["link"] = 0 if closing else 1
        elif tag == "br" or tag not in BLOCKS and tag in ("img", "input", "button", "label", "wbr"):
            buffer.append(" ")
        elif tag in BLOCKS or tag in EITHER and (opened[tag] > 0 if closing else not opened["p"]):
            if closing:
                depth = find((tag,))
                pop_to(depth) if depth else flush()
                continue
            flush()
            depth = find(("p",), ("td", "th", "table", "li", "div", "blockquote"))
            if depth:
                pop_to(depth)
            if tag in CLOSES_ITSELF:
                same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
                depth = find(same, CLOSES_ITSELF[tag])
                if depth:
                    pop_to(depth)
            if tag not in VOID:
                state["n"] += 1
                opened[tag] += 1
                stack.append((tag, _path(stack[-1][1], tag, m[3], known), state["n"]))
    flush()
    return out


def _path(above: tuple, tag: str, attributes: str, known: frozenset[str] | None) -> tuple:
    """Features of an element and its ancestors; the last names the element itself."""
    own = [f"in:{tag}"]
    if attributes.strip():
        for m in _ATTRIBUTE.finditer(attributes):
            own += [f"has:{w}" for w in _WORD.findall((m[2] or m[3] or m[4] or "").lower())]
    if known is not None:
        own = [f for f in own if f in known]
    return (*dict.fromkeys([*above[:-1], *own]), f"own:{tag}")


def _steps(value: float, marks: tuple) -> int:
    return sum(value >= m for m in marks)


def words_in(text: str) -> int:
    """Words, about: by blanks, and by letters in scripts that have none."""
    n = text.count(" ") + 1
    return n if text.isascii() else n + sum(len(letters.findall(text)) // each for letters, each in _DENSE)


def features(found: list[Block]) -> list[list[str]]:
    """Features of each block, besides those of its path."""
    out = []
    sizes = [words_in(b.text) for b in found]
    page = f"page:{_steps(sum(sizes), (12, 40, 150))}"
    long = f"prose:{_steps(sum(n >= 12 for n in sizes), (1, 2, 4))}"
    after = False
    for i, (b, words) in enumerate(zip(found, sizes, strict=True)):
        text = b.text
        marks = sum(map(text.count, _MARKS))
        said = [k for k, r in _SAYS.items() if r.search(text)] if words <= 12 else []
        own = [
            "bias",
            page,
            long,
            f"words:{_steps(words, (2, 4, 8, 16, 32, 64))}",
            f"links:{_steps(b.links / len(text), (0.01, 0.3, 0.7))}",
            f"marks:{_steps(marks / words, (0.01, 0.05, 0.2))}",
            f"end:{text[-1] in _ENDS}",
            f"digits:{sum(map(text.count, '0123456789')) > len(text) / 8}",
            f"sign:{any(c in text for c in '©|»›·')}",
            f"same:{i > 0 and found[i - 1].parent == b.parent}",
            f"after:{after}",
            *(f"says:{k}" for k in said),
        ]
        after = after or "comments" in said and words <= 4
        if i == 0:
            own.append("first")
        if i == len(found) - 1:
            own.append("last")
        if len(found) == 1:
            own.append("only")
        out.append(own)
    return out


class Chain:
    """The trained field: a weight per feature, and transitions between the labels."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray, start: np.ndarray):
        self.names, self.weights, self.moves, self.start = names, weights.tolist(), moves.tolist(), start.tolist()
        self.known = frozenset(names)
        self._paths: dict[tuple, float] = {}

    def _of_path(self, path: tuple) -> float:
        if path not in self._paths:
            if len(self._paths) > 10_000:
                self._paths.clear()
            self._paths[path] = sum(self.weights[self.names[f]] for f in path if f in self.names)
        return self._paths[path]

    def scores(self, found: list[Block]) -> list[float]:
        get, w = self.names.get, self.weights
        return [self._of_path(b.path) + sum(w[k] for f in own if (k := get(f)) is not None) for b, own in zip(found, features(found), strict=True)]

    def decode(self, found: list[Block]) -> list[bool]:
        """The most likely labels (Viterbi); ``scores`` are those of label 1 against label 0."""
        if not found:
            return []
        m, back = self.moves, []
        scores = self.scores(found)
        zero, one = self.start[0], self.start[1] + scores[0]
        for s in scores[1:]:
            from_zero = (zero + m[0][0] >= one + m[1][0], zero + m[0][1] >= one + m[1][1])
            zero, one = max(zero + m[0][0], one + m[1][0]), max(zero + m[0][1], one + m[1][1]) + s
            back.append(from_zero)
        label = one > zero
        labels = [label]
        for from_zero in reversed(back):
            label = not from_zero[label]
            labels.append(label)
        return labels[::-1]

    def extract(self, html: str) -> str:
        found = blocks(html, self.known)
        return "\n".join(b.text for b, keep in zip(found, self.decode(found), strict=True) if keep)


# --- training ---

#: Pages to train on, their seed, the steps of training, their rate, and the weight of the penalty.
PAGES, SEED, STEPS, RATE, PENALTY = 1600, 11, 200, 0.3, 1e-5


#: Syllables or letters to make words from, the blank between words, comma and full stops, by script.
SCRIPTS = (
    (["ba", "den", "er", "ion", "lo", "mu", "tar", "ish", "que", "ou", "ver", "ent", "al", "ze", "ny", "pol", "gra", "ti", "su", "ké"], " ", ",", ". . . ! ?"),
    ([a + b for a in "бвгдклмнпрст" for b in "аеиоу"], " ", ",", ". . . ! ?"),
    ([a + b for a in "βγδκλμνπρστ" for b in "αειο"], " ", ",", ". . . !"),
    (list("ابتجدرسعفقكلمنهوي"), " ", "،", ". . . ؟"),
    ([a + b for a in "कगचजतदनपबमरलस" for b in ("", "ा", "ि", "े")], " ", ",", "। । ? !"),
    ([chr(0x4E00 + 97 * i % 5000) for i in range(160)], "", "，", "。 。 。 ！ ？"),
    (list("กขคงจชดตนบปพมยรลวสหอ"), "", " ", ". ! ?"),
)


class _Maker:
    """Labelled pages. Main text is written between \x01 and \x02, which the labeller reads and removes."""

    def __init__(self, rng: random.Random):
        self.r = rng
        self.write_in(0)

    def write_in(self, script: int) -> None:
        parts, self.blank, self.comma, stops = SCRIPTS[script]
        self.stops = stops.split()
        self.words = ["".join(self.r.choice(parts) for _ in range(self.r.randint(1, 4))) for _ in range(120)]

    def some(self, low: int, high: int) -> str:
        return self.blank.join(self.r.choice(self.words) for _ in range(self.r.randint(low, high)))

    def cue(self, text: str, *phrases: str) -> str:
        """The text, or at times a stock phrase with or without it."""
        return self.r.choice([text, text, self.r.choice(phrases), f"{self.r.choice(phrases)} {text}"])

    def prose(self, low: int = 1, high: int = 5) -> str:
        out = []
        for _ in range(self.r.randint(low, high)):
            words = [self.r.choice(self.words) for _ in range(self.r.randint(1, 24))]
            out.append(self.blank.join(w + self.comma if self.r.random() < 0.1 else w for w in words).capitalize() + self.r.choice(self.stops))
        text, odd = (self.blank if self.blank else self.r.choice(["", "", " "])).join(out), self.r.random()  # some prose is odd: signs between words, digits, capitals
        if odd < 0.06:
            return text.replace(" ", self.r.choice([" | ", "### ", " · ", "&amp;&amp; "]))
        if odd < 0.1:
            return self.r.choice([text.upper(), text.replace(" ", f" {self.r.randint(10, 9999)} "), text + " &copy;"])
        if odd < 0.12:
            return text + " " + self.r.choice(["Read the comments.", "The privacy of users matters.", "See also the newsletter.", "They share it."])
        return text

    def main(self, text: str) -> str:
        return f"\x01{text}\x02"

    def pick(self, *names: str) -> str:
        """An attribute with one of the names; sometimes none."""
        name = self.r.choice(names)
        return self.r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {self.some(1, 1)}"', f" class='x-{name}'", ""])

    def link(self) -> str:
        return f'<a href="/{self.some(1, 1)}">{self.some(1, 3)}</a>'

    def menu(self) -> str:
        items = [self.link() for _ in range(self.r.randint(3, 9))]
        body = self.r.choice(["<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", "<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>", " | ".join(items), "".join(f"<div>{x}</div>" for x in items)])
        return self.r.choice([f"<nav>{body}</nav>", f"<div{self.pick('menu', 'nav', 'navbar', 'navigation', 'breadcrumb', 'topmenu')}>{body}</div>", f'<div role="navigation">{body}</div>'])

    def header(self) -> str:
        body = self.r.choice([f"<h1>{self.some(1, 4)}</h1>", f"<p>{self.some(2, 8)}</p>", self.some(1, 5), f"<div{self.pick('logo', 'tagline', 'site-title')}>{self.some(1, 4)}</div>"])
        return self.r.choice([f"<header>{body}</header>", f"<div{self.r.choice([' class=header', ' id=masthead', ' class=banner', ' class=top'])}>{body}</div>"])

    def footer(self) -> str:
        if self.r.random() < 0.2:  # nothing tells but the words
            tag, rights = self.r.choice(["div", "p", "center"]), self.r.choice(["&copy; 2024", "Copyright 2023", "© 2021 All rights reserved.", "Copyright 2024. Terms of use"])
            return f"<{tag}>{self.r.choice([rights, f'{rights} {self.some(1, 3)}', f'{rights} {self.link()}'])}</{tag}>"
        body = self.r.choice([f"&copy; {self.some(1, 3)} &middot; {self.prose(1, 1)}", f"<p>{self.cue(self.some(1, 4), 'All rights reserved.', 'Terms of use', 'Copyright 2024')}</p>", f"<p>{self.prose(1, 2)}</p>", f"<p>&copy; 2024 {self.some(1, 3)}</p><p>{self.link()} {self.link()}</p>", self.some(2, 8)])
        return self.r.choice([f"<footer>{body}</footer>", f"<footer>{body}</footer>", f"<div{self.r.choice([' class=footer', ' id=footer', ' class=copyright', ' class=bottom'])}>{body}</div>"])

    def advert(self) -> str:
        names = ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "adsense")
        return f'<div class="{self.r.choice(names)}">{self.cue(self.r.choice([self.prose(1, 3), f"<p>{self.prose(1, 2)}</p>", self.link()]), "Advertisement", "Sponsored")}</div>'

    def notice(self) -> str:
        names = ("notice", "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "disclaimer", "newsletter", "subscribe")
        if self.r.random() < 0.05:
            return f"<noscript>{self.cue(self.prose(1, 1), 'Please enable JavaScript.', 'This site needs JavaScript to work.')}</noscript>"
        text = self.cue(self.prose(1, 2), "We use cookies.", "Your privacy matters to us.", "Subscribe to our newsletter.")
        return f'<div class="{self.r.choice(names)}"{self.r.choice(["", " role=alert", " role=dialog"])}>{self.r.choice([text, f"<p>{text}</p><p>{self.link()}</p>"])}</div>'

    def links(self) -> str:
        """A box of links without a telling name."""
        items = self.r.choice(["<br>", " | ", "<p>", "</li><li>"]).join(self.link() for _ in range(self.r.randint(2, 6)))
        return f"<b>{self.some(1, 2)}</b><br>{items}" if self.r.random() < 0.5 else items

    def sidebar(self) -> str:
        if self.r.random() < 0.15:
            return f"<div>{self.links()}</div>"
        names = ("sidebar", "related", "widget", "recent", "popular", "trending", "recommended", "tags", "social", "share")
        body = "".join(self.r.choice([f"<h3>{self.some(1, 4)}</h3>", f"<p>{self.prose(1, 2)}</p>", f"<ul>{''.join(f'<li>{self.link()}</li>' for _ in range(self.r.randint(2, 6)))}</ul>"]) for _ in range(self.r.randint(1, 4)))
        return self.r.choice([f"<aside>{body}</aside>", f'<div class="{self.r.choice(names)}">{body}</div>', f'<section id="{self.r.choice(names)}">{body}</section>', f'<div role="complementary">{body}</div>'])

    def form(self) -> str:
        body = self.r.choice([
            f"<label>{self.some(1, 4)}</label><input name=q><p>{self.prose(1, 1)}</p><button>{self.some(1, 2)}</button><select><option>{self.some(1, 2)}<option>{self.some(1, 2)}</select>",
            f"<p>{self.cue(self.some(1, 6), 'Subscribe to our newsletter', 'Sign in')}</p><input type=email><button>{self.some(1, 2)}</button>",
            f"<label>{self.some(1, 3)}<input></label> <label>{self.some(1, 3)}<input></label><input type=submit value=x>",
            f"<fieldset><legend>{self.some(1, 3)}</legend><div>{self.some(1, 5)} <input></div><div>{self.prose(1, 1)}</div></fieldset>",
            f"{self.some(1, 6)} <input> <button>{self.some(1, 2)}</button>",
            f"<p>{self.prose(1, 2)}</p><label>{self.some(1, 2)}</label><input><button>{self.some(1, 2)}</button>",
            f"<h3>{self.some(1, 4)}</h3><p>{self.prose(1, 3)}</p><p>{self.prose(1, 1)}</p><input>",
        ])
        return f"<form{self.r.choice(['', f' action=/{self.some(1, 1)}', ' method=post'])}>{body}</form>"

    def comments(self) -> str:
        one = lambda: self.r.choice([f"<p>{self.prose(1, 3)}</p>", self.prose(1, 2), f"<b>{self.some(1, 2)}</b> {self.prose(1, 2)}", f"<div{self.pick('author', 'meta')}>{self.some(1, 2)}</div><p>{self.prose(1, 2)}</p>"])
        n = self.r.randint(1, 5)
        name = self.r.choice(["comments", "comment-list", "responses", "discussion", "replies", "disqus"])
        count = self.r.choice([f"{n} comments", "Comments", f"Comments ({n})", f"{n} replies", "Discussion", "Reader comments", "Commentaires", "Kommentare", "Comentarios", f"{n} responses"])
        if self.r.random() < 0.45:  # nothing tells but the heading
            inner = self.r.choice(["".join(f"<div>{one()}</div>" for _ in range(n)), "<ol>" + "".join(f"<li>{one()}</li>" for _ in range(n)) + "</ol>", "<ul>" + "".join(f"<li>{one()}" for _ in range(n)) + "</ul>", "".join(f"<p>{self.prose(1, 3)}</p>" for _ in range(n))])
            inner = self.r.choice([f"<h2>{count}</h2>", f"<h3>{count}</h3>", f"<h4>{count}</h4>", f"<p><b>{count}</b></p>"]) + inner
            return self.r.choice([inner, inner, f"<section>{inner}</section>", f"<div>{inner}</div>"])
        inner = self.r.choice(["".join(f'<div class="comment">{one()}</div>' for _ in range(n)), "<ol>" + "".join(f"<li>{one()}</li>" for _ in range(n)) + "</ol>", "".join(f'<article class="comment">{one()}</article>' for _ in range(n))])
        head = self.r.choice([self.some(1, 3), count])
        return self.r.choice([f'<section id="{name}"><h2>{head}</h2>{inner}</section>', f'<div class="{name}">{inner}</div>'])

    def paragraph(self) -> str:
        inner = self.main(self.prose(1, 6))
        return self.r.choice([f"<p>{inner}</p>", f"<p>{inner}</p>", f"<p>{inner}", f"<p><b>{inner}<br>", f"<p>{self.main(self.prose(1, 2) + ' ' + self.link() + ' ' + self.prose(1, 1))}</p>", f"<div>{inner}</div>"])

    def piece(self) -> str:
        r = self.r.random()
        if r < 0.75:
            return self.paragraph()
        items = [self.main(self.r.choice([self.prose(1, 1), self.some(1, 8)])) for _ in range(self.r.randint(1, 5))]
        return self.r.choice([
            f"<h2>{self.main(self.some(1, 8))}</h2>" + self.paragraph(),
            "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>",
            "<ol>" + "".join(f"<li>{x}" for x in items) + "</ol>",
            f"<blockquote><p>{items[0]}</p></blockquote>",
            f"<pre>{items[0]}</pre>",
            "<table>" + "".join(f"<tr><td>{x}</td><td>{self.main(self.some(1, 3))}</td></tr>" for x in items) + "</table>",
            f"<figure><img src=x><figcaption>{items[0]}</figcaption></figure>",
            f"<{(tag := self.r.choice(['noscript', 'object', 'video', 'audio', 'canvas']))}>{self.main(self.prose(1, 2))}</{tag}>",
            f"<svg><text>{self.main(self.some(1, 3))}</text></svg>" + self.paragraph(),
            f"<dl><dt>{self.main(self.some(1, 3))}<dd>{items[0]}</dl>",
        ])

    def article(self) -> str:
        title = f"<h1>{self.main(self.r.choice([self.some(1, 9), self.prose(1, 2)[:60]]))}</h1>"
        body = [self.piece() for _ in range(self.r.choice([1, 1, 2, 3, 5, 8, 12]))]
        for extra in (self.advert, self.advert, self.notice, self.sidebar, self.form):
            if self.r.random() < (0.3 if extra == self.form else 0.12):
                body.insert(self.r.randint(0, len(body)), extra())
        if self.r.random() < 0.2:
            body.append(f'<div class="{self.r.choice(["share", "social", "tags", "related"])}">{self.link()} {self.link()}</div>')
        inner = (title if self.r.random() < 0.85 else "") + "".join(body) + (self.comments() if self.r.random() < 0.08 else "")
        names = ("content", "post", "entry", "story", "main", "text", "body", "article")
        if self.r.random() < 0.05:  # a layout table
            return f"<table><tr><td>{inner}</td><td>{self.links()}</td></tr></table>"
        return self.r.choice([f"<article>{inner}</article>", f"<article>{inner}</article>", f"<main>{inner}</main>", f'<div class="{self.r.choice(names)}">{inner}</div>', f'<div id="{self.r.choice(names)}">{inner}</div>', f"<main><article>{inner}</article></main>", f"<div>{inner}</div>", f"<div><div>{inner}</div></div>", inner])

    def bare(self) -> str:
        """A page that is little else than one text."""
        text = self.main(self.r.choice([self.prose(1, 1), self.prose(1, 4), self.prose(3, 12), self.some(1, 12)]))
        body = self.r.choice([f"<article><p>{text}</p></article>", f"<p>{text}</p>", f"<div>{text}</div>", f"<div><div>{text}</div></div>", f"<pre>{text}</pre>", text, f"<main><p>{text}</p></main>", f"<article>{text}</article>", f"<div><p>{text}</p></div>"])
        top = self.menu() if self.r.random() < 0.3 else ""
        low = self.footer() if self.r.random() < 0.2 else ""
        if not top and not low and self.r.random() < 0.3:
            return body
        return f"<html><body>{top}{body}{low}</body></html>"

    def page(self) -> str:
        self.write_in(self.r.choice([0, 0, 0, 0, 0, 0, 1, 2, 3, 4, 5, 5, 6]))
        if self.r.random() < 0.15:
            return self.bare()
        top = [x() for x in (self.notice, self.header, self.menu, self.advert, self.form, self.sidebar) if self.r.random() < 0.5]
        low = [x() for x in (self.comments, self.sidebar, self.advert, self.form, self.notice, self.menu) if self.r.random() < 0.35]
        if self.r.random() < 0.85:
            low.append(self.footer())
        if self.r.random() < 0.12:  # nothing but the text
            top, low = [], low[:1] if self.r.random() < 0.3 else []
        inner = "".join(top) + self.article() + "".join(low)
        if self.r.random() < 0.3:
            inner = f'<div class="{self.r.choice(["wrapper", "container", "page", "site"])}">{inner}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.some(1, 5)}</title><style>p{{}}</style></head><body>{inner}</body></html>"


def training_pages(n: int = PAGES, seed: int = SEED) -> list[tuple[list[Block], list[bool]]]:
    """Blocks of made pages with their labels."""
    maker, out = _Maker(random.Random(seed)), []
    for _ in range(n):
        found = blocks(maker.page())
        labels = ["\x01" in b.text or "\x02" in b.text for b in found]
        for b in found:
            b.text = b.text.replace("\x01", "").replace("\x02", "").strip() or "-"
        out.append((found, labels))
    return out


@cache
def train(n: int = PAGES, seed: int = SEED, steps: int = STEPS) -> Chain:
    """Maximum likelihood with a small penalty on the squared weights."""
    data = training_pages(n, seed)
    lists = [[[*b.path, *own] for b, own in zip(found, features(found), strict=True)] for found, _ in data]
    seen: dict[str, int] = {}
    for f in (f for page in lists for own in page for f in own):
        seen[f] = seen.get(f, 0) + 1
    names = {f: i for i, f in enumerate(sorted(f for f, c in seen.items() if c >= 3))}
    longest = max(map(len, lists))
    y, mask = np.zeros((longest, len(data)), int), np.zeros((longest, len(data)))
    cells, columns = [], []  # a feature that a block has, and which: pages are sparse
    for j, (page, (_, labels)) in enumerate(zip(lists, data, strict=True)):
        for i, own in enumerate(page):
            known = {names[f] for f in own if f in names}
            cells += [i * len(data) + j] * len(known)
            columns += sorted(known)
            y[i, j], mask[i, j] = labels[i], 1
    cells, columns, size = np.array(cells), np.array(columns), longest * len(data)
    w, moves, start = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    slots = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, moves, start)]
    pages = np.arange(len(data))
    for step in range(1, steps + 1):
        score = np.zeros((longest, len(data), 2))
        score[:, :, 1] = np.bincount(cells, w[columns], size).reshape(longest, len(data))
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[0] = start + score[0]
        for t in range(1, longest):
            new = np.logaddexp(ahead[t - 1][:, 0, None] + moves[0], ahead[t - 1][:, 1, None] + moves[1]) + score[t]
            ahead[t] = np.where(mask[t][:, None] > 0, new, ahead[t - 1])
        total = np.logaddexp(ahead[-1][:, 0], ahead[-1][:, 1])
        for t in range(longest - 2, -1, -1):
            nxt = score[t + 1] + behind[t + 1]
            new = np.logaddexp(moves[:, 0][None] + nxt[:, :1], moves[:, 1][None] + nxt[:, 1:])
            behind[t] = np.where(mask[t + 1][:, None] > 0, new, 0)
        p = np.exp(ahead + behind - total[None, :, None]) * mask[:, :, None]
        grad_w = np.bincount(columns, (y * mask - p[:, :, 1]).ravel()[cells], len(w)) - PENALTY * len(data) * w
        grad_moves = np.zeros((2, 2))
        for t in range(1, longest):
            pair = np.exp(ahead[t - 1][:, :, None] + moves[None] + (score[t] + behind[t])[:, None, :] - total[:, None, None]) * mask[t][:, None, None]
            grad_moves -= pair.sum(axis=0)
            np.add.at(grad_moves, (y[t - 1], y[t]), mask[t])
        grad_start = -p[0].sum(axis=0)
        np.add.at(grad_start, y[0], mask[0])
        for value, grad, (first, second) in zip((w, moves, start), (grad_w, grad_moves, grad_start), slots, strict=True):
            g = grad / len(pages)
            first *= 0.9
            first += 0.1 * g
            second *= 0.999
            second += 0.001 * g * g
            value += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Chain(names, w, moves, start)


def extract(pages: DataFrame, html_col: str = "html", chain: Chain | None = None) -> DataFrame:
    """``pages`` with struct ``__main`` (text, n_chars); ``chain`` defaults to the one trained here."""
    field = chain or train()
    state = (field.names, np.array(field.weights), np.array(field.moves), np.array(field.start))

    @F.pandas_udf("text string, n_chars long")
    def of(html: pd.Series) -> pd.DataFrame:
        own = Chain(*state)
        texts = [own.extract(h) for h in html]
        return pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    return small_batches(pages).withColumn("__main", of(F.coalesce(F.col(html_col), F.lit(""))))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars."""
    return extract(pages.select(id_col, url_col, html_col), html_col).select(id_col, url_col, F.col("__main.text").alias("text"), F.col("__main.n_chars").alias("n_chars"))
