"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks: the text between two block-level tags, in page order. Each block is a vector of its hashed tag
path (tags, classes, ids and roles of what encloses it), its hashed words and a few shape measures. A bidirectional
LSTM in numpy reads a page's whole sequence of blocks and gives each its chance of being main text, so a block
is judged by what stands before and after it as well. It is trained on the driver on pages made by
``made_page``, whose parts are known; no page of the input is used.

Defined results: a null or empty html gives an empty text; scripts, styles, comments and markup are never text; unclosed
tags end with what encloses them; character references are decoded once; repeated rows repeat; an empty table gives no
rows. Pages are read whole, however long. Only the named columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import functools
import html as _html
import random
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, table

PATH_DIM, WORD_DIM, SHAPE_DIM = 96, 64, 8
HIDDEN = 24
PAGES, EPOCHS, BATCH, RATE = 3600, 14, 32, 0.01
#: Share of the tag paths left out in training.
UNREAD = 0.1
#: Blocks (padding included) labelled at a time.
CELLS = 1 << 15

BLOCK_TAGS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag ends: tags closed, and tags beyond which nothing is closed.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
_word = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_mark = re.compile(r"[>\"']")
#: Elements that hold no text of the page. Of one that is never closed, a script, style or iframe takes the rest of the page with it, as
#: browsers have it; of the others the tag alone is dropped, and of these a tag that closes itself is whole.
SILENT = frozenset("script style noscript template svg iframe object".split())
TO_THE_END = frozenset("script style iframe".split())
NESTING = frozenset("template svg object".split())
#: Of what encloses a block, so many levels count, innermost first.
LEVELS = 64
_named = re.compile(r"""(?<![\w-])(class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_part = re.compile(r"[a-z]+")
_digit = re.compile(r"\d")


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # what encloses the block, outermost first, as "tag name name"; the LEVELS innermost
    linked: float  # share of its characters in links


class Scan:
    """A page's marks, found in one pass: whatever is looked for in vain is not looked for again."""

    def __init__(self, page: str):
        self.page = page
        self.missing: dict[str, int] = {}  # what is not there from some place on
        self.astray: set[int] = set()  # quotes from which no tag's end is reached
        self.ends: dict[int, int] = {}  # of quotes from which one is

    def find(self, what: str, at: int) -> int:
        if at >= self.missing.get(what, len(self.page) + 1):
            return -1
        if (found := self.page.find(what, at)) < 0:
            self.missing[what] = at
        return found

    def tag_end(self, at: int) -> int:
        """The place of the first ``>`` outside quotes, or -1."""
        passed = []
        end = -1
        while at < self.missing.get("mark", len(self.page) + 1):
            if not (m := _mark.search(self.page, at)):
                self.missing["mark"] = at
                break
            if m[0] == ">":
                end = m.start()
                break
            if m.start() in self.astray:
                break
            if m.start() in self.ends:
                end = self.ends[m.start()]
                break
            passed.append(m.start())
            close = self.find(m[0], m.end())
            if close < 0:
                break
            at = close + 1
        if end < 0:
            self.astray.update(passed)
        else:
            self.ends.update(dict.fromkeys(passed, end))
        return end

    def tag(self, at: int) -> tuple[bool, str, str, int] | None:
        """(closing, name, attributes, end) of the tag that begins at ``<``; None if none does."""
        closing = self.page.startswith("/", at + 1)
        name = _word.match(self.page, at + 1 + closing)
        if not name or (end := self.tag_end(name.end())) < 0:
            return None
        return closing, name[0].lower(), self.page[name.end() : end], end + 1

    def past(self, tag: str, attributes: str, at: int) -> int:
        """Where the page goes on after an element without text whose opening tag ends at ``at``."""
        if tag not in TO_THE_END and attributes.endswith("/"):
            return at
        if self.missing.get(f"</{tag}>", len(self.page) + 1) <= at:
            return len(self.page) if tag in TO_THE_END else at
        depth, here = 1, at  # templates, drawings and objects may stand inside one another
        pattern = _inner[tag]
        while m := pattern.search(self.page, here):
            here = m.end()
            if m[1]:
                if (end := self.find(">", here)) < 0:
                    break
                depth, here = depth - 1, end + 1
                if not depth:
                    return here
            elif tag in NESTING and (end := self.tag_end(here)) >= 0:
                depth += self.page[end - 1] != "/"
                here = end + 1
        self.missing[f"</{tag}>"] = min(at, self.missing.get(f"</{tag}>", at))
        return len(self.page) if tag in TO_THE_END else at


#: Closing tags of an element, and of those that may stand inside one another the opening ones.
_inner = {tag: re.compile(rf"<({'/' if tag not in NESTING else '/?'}){tag}(?![a-zA-Z0-9:-])", re.I) for tag in SILENT}


class Open:
    """What is open at a place of the page: as ``list`` of (tag, names), with the places of each tag."""

    def __init__(self):
        self.all: list[tuple[str, str]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, tag: str, names: str) -> None:
        self.places.setdefault(tag, []).append(len(self.all))
        if tag in BLOCK_TAGS:
            self.blocks.append(len(self.all))
        self.all.append((tag, names))

    def last(self, *tags: str) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def cut(self, at: int) -> None:
        while len(self.all) > at:
            tag, _ = self.all.pop()
            self.places[tag].pop()
            if tag in BLOCK_TAGS:
                self.blocks.pop()


def blocks(page: str | None) -> list[Block]:
    """The page's blocks that have text; time is in proportion to the page."""
    out: list[Block] = []
    open_ = Open()
    parts: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        if parts:
            raw = "".join(parts)
            text = " ".join(_html.unescape(raw).split())
            if text:
                out.append(Block(text, tuple(x[1] for x in open_.all[-LEVELS:]), min(1.0, links / max(1, len(raw.strip())))))
            parts.clear()
        links = 0

    def close(tags, beyond) -> None:
        if (at := open_.last(*tags)) > open_.last(*beyond):
            flush()
            open_.cut(at)

    def say(text: str) -> None:
        nonlocal links
        parts.append(text)
        links += len(text) if open_.places.get("a") else 0

    page = page or ""
    scan, here = Scan(page), 0
    while here < len(page):
        if page[here] != "<":
            start, here = here, scan.find("<", here)
            here = len(page) if here < 0 else here
            say(page[start:here])
            continue
        if page.startswith("<!--", here):
            end = scan.find("-->", here + 4)
            here = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), here) and (end := scan.find(">", here)) >= 0:
            here = end + 1
            continue
        if (found := scan.tag(here)) is None:
            say("<")
            here += 1
            continue
        closing, tag, attributes, here = found
        if closing:
            if tag in BLOCK_TAGS:
                flush()
            # a tag that is no block's ends nothing beyond the block that it stands in
            if (at := open_.last(tag)) >= 0 and (tag in BLOCK_TAGS or not open_.blocks or open_.blocks[-1] < at):
                open_.cut(at)
            continue
        if tag in SILENT:
            if tag in ("iframe", "object"):
                flush()
            here = scan.past(tag, attributes, here)
            continue
        if tag == "br":
            parts.append("\n")
            continue
        if tag in BLOCK_TAGS:
            flush()
            if tag not in ("option", "button", "select", "textarea"):
                close({"p"}, {"td", "th", "div", "li", "article", "section", "body", "button", "blockquote"})
            if tag in ENDS:
                close(*ENDS[tag])
        if tag in VOID_TAGS or attributes.endswith("/"):
            continue
        names = " ".join(_part.findall(" ".join(a or b or c for _, a, b, c in _named.findall(attributes)).lower())) if "=" in attributes else ""
        open_.push(tag, f"{tag} {names}" if names else tag)
    flush()
    return out


def _hashed(word: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return h % size, 1.0 if h & 0x10000 else -1.0


class _Codes(dict):
    """Word to its place among WORD_DIM positive and as many negative ones; forgets all when large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        i, sign = _hashed(word, WORD_DIM)
        self[word] = code = i if sign > 0 else i + WORD_DIM
        return code


_codes = _Codes()


@functools.lru_cache(50_000)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(PATH_DIM, dtype=np.float32)
    for back, level in enumerate(reversed(path)):
        tag, *names = level.split()
        weight = 1.0 if back < 3 else 0.7
        for word, w in [(("t0:" if back == 0 else "t:") + tag, weight), *(("n:" + x, 1.5 * weight) for x in names)]:
            i, sign = _hashed(word, PATH_DIM)
            v[i] += sign * w
    return v


def vectors(page: list[Block]) -> np.ndarray:
    out = np.zeros((len(page), PATH_DIM + WORD_DIM + SHAPE_DIM), dtype=np.float32)
    for k, b in enumerate(page):
        out[k, :PATH_DIM] = _path_vector(b.path)
        found = b.text.lower().split()
        row, n, distinct = out[k], len(found), set(found)
        counts = np.bincount([_codes[w] for w in distinct], minlength=2 * WORD_DIM)
        row[PATH_DIM : PATH_DIM + WORD_DIM] = (counts[:WORD_DIM] - counts[WORD_DIM:]) / len(distinct) ** 0.5
        letters = len(b.text)
        row[PATH_DIM + WORD_DIM :] = (np.log1p(n) / 3, np.log1p(letters) / 5, b.linked, b.text[-1] in ".!?…\"'", len(_digit.findall(b.text)) / letters, b.text[0].isupper(), k / len(page), 1.0)
    return out


class Lstm:
    """One direction: all gates' weights in one array (input, state and bias stacked)."""

    def __init__(self, w: np.ndarray):
        self.w = w

    def run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """States (time, batch, hidden); ``mask`` stops the state where a page has ended."""
        t, n, d = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        from_input = (x.reshape(t * n, d) @ self.w[:d] + self.w[-1]).reshape(t, n, -1)
        states, kept = np.empty((t, n, HIDDEN), np.float32), []
        for k in range(t):
            g = from_input[k] + h @ self.w[d:-1]
            s = 1 / (1 + np.exp(-np.clip(g[:, : 3 * HIDDEN], -20, 20)))
            i, f, o, u = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(g[:, 3 * HIDDEN :])
            m = mask[k][:, None]
            new_c = m * (f * c + i * u) + (1 - m) * c
            tc = np.tanh(new_c)
            new_h = m * (o * tc) + (1 - m) * h
            if keep:
                kept.append((i, f, o, u, c, tc, h, m))
            h, c = new_h, new_c
            states[k] = h
        return states, kept

    def back(self, x: np.ndarray, kept: list, grad: np.ndarray) -> np.ndarray:
        """Gradient of the weights, given that of the states."""
        t, n, d = x.shape
        out = np.zeros_like(self.w)
        gh, gc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        gates = np.empty((t, n, 4 * HIDDEN), np.float32)
        for k in range(t - 1, -1, -1):
            i, f, o, u, c, tc, h, m = kept[k]
            gh = gh + grad[k]
            own_h, pass_h = gh * m, gh * (1 - m)
            own_c = gc * m + own_h * o * (1 - tc * tc)
            gates[k] = np.concatenate([own_c * u * i * (1 - i), own_c * c * f * (1 - f), own_h * tc * o * (1 - o), own_c * i * (1 - u * u)], axis=1)
            gh = gates[k] @ self.w[d:-1].T + pass_h
            gc = own_c * f + gc * (1 - m)
        flat = gates.reshape(t * n, -1)
        out[:d] = x.reshape(t * n, d).T @ flat
        out[d:-1] = np.stack([k[6] for k in kept]).reshape(t * n, HIDDEN).T @ flat
        out[-1] = flat.sum(0)
        return out


class Labeller:
    def __init__(self, forward: np.ndarray, backward: np.ndarray, out: np.ndarray):
        self.forward, self.backward, self.out = Lstm(forward), Lstm(backward), out

    @staticmethod
    def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        t = max(len(p) for p in pages)
        x, mask = np.zeros((t, len(pages), pages[0].shape[1]), np.float32), np.zeros((t, len(pages)), np.float32)
        for n, p in enumerate(pages):
            x[: len(p), n], mask[: len(p), n] = p, 1
        return x, mask

    def states(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        a, ka = self.forward.run(x, mask, keep)
        b, kb = self.backward.run(x[::-1], mask[::-1], keep)
        return np.concatenate([a, b[::-1], np.ones((*mask.shape, 1), np.float32)], axis=2), ka, kb

    def chances(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Chance of main text for each block of each page; pages of like length are read together."""
        order = sorted((k for k, p in enumerate(pages) if len(p)), key=lambda k: len(pages[k]))
        out = [np.zeros(0)] * len(pages)
        while order:
            longest = len(pages[order[-1]])
            now = order[-max(1, CELLS // longest) :]
            del order[-len(now) :]
            h, _, _ = self.states(*self.padded([pages[k] for k in now]))
            p = 1 / (1 + np.exp(-np.clip(h @ self.out, -30, 30)))
            for n, k in enumerate(now):
                out[k] = p[: len(pages[k]), n]
        return out


SYLLABLES = ("an er in th on re at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve".split(), "la que de ción os ar el en ra do mi ta es ue bo".split(), "ein sch ung ich der ver ge en be zu keit lich ä ü ß".split(), "eau eux é è ment tion le ou ai re que an".split())
#: Words that boilerplate is made of, by kind.
SAID = {
    "menu": "home about contact news products services login register search blog shop faq help more menu sports world business".split(),
    "ad": "advertisement sponsored buy now sale offer deal click here limited promoted free shipping discount".split(),
    "notice": "we use cookies to improve your experience accept all privacy policy settings by continuing you agree consent".split(),
    "form": "subscribe to our newsletter enter your email address sign up submit name password send".split(),
    "comment": "reply says posted by anonymous great post thanks for sharing i agree login to comment likes ago report".split(),
    "side": "related articles popular posts recent tags archives categories read next share tweet follow us you may also like".split(),
    "foot": "copyright all rights reserved terms of service privacy contact sitemap powered by © ·".split(),
    "head": "site logo welcome edition daily skip to content sign in search".split(),
}
#: The like in German, French and Spanish.
SAID_ELSEWHERE = {
    "menu": "startseite politik sport kultur wirtschaft kontakt anmelden suche über uns accueil actualités rubriques boutique connexion inicio noticias deportes tienda contacto buscar",
    "ad": "anzeige werbung jetzt kaufen angebot publicité acheter maintenant offre publicidad comprar ahora oferta",
    "notice": "diese website verwendet cookies speichert daten zustimmen akzeptieren einstellungen ce site utilise des cookies accepter refuser paramètres este sitio utiliza cookies aceptar this website stores data such as",
    "form": "newsletter abonnieren e-mail adresse eingeben absenden inscrivez-vous votre adresse envoyer suscríbete su correo enviar nombre",
    "comment": "kommentare antworten sagt danke schöner beitrag commentaires répondre dit merci comentarios responder dice gracias",
    "side": "meistgelesen verwandte artikel teilen weiterlesen articles liés à lire aussi partager lo más leído relacionados compartir",
    "foot": "impressum datenschutz agb alle rechte vorbehalten mentions légales tous droits réservés conditions aviso legal todos los derechos reservados condiciones",
    "head": "willkommen ausgabe bienvenue édition bienvenido edición",
}
UNITS = ("", "", "g", "kg", "ml", "km", "%", "h", "cm")
PLACES = {
    "menu": ["<table><tr><td>{}</td></tr></table>", "<div>{}</div>", "<section>{}</section>", "<nav>{}</nav>", '<div class="menu">{}</div>', '<div id="navbar" class="nav main-nav">{}</div>', '<ul class="breadcrumb">{}</ul>', '<div role="navigation">{}</div>'],
    "ad": ['<div class="ad">{}</div>', '<div class="ads banner">{}</div>', '<div id="advert">{}</div>', '<aside class="promo sponsor">{}</aside>', '<div class="advertisement">{}</div>', '<section class="sponsored">{}</section>'],
    "notice": ['<div class="cookie-notice">{}</div>', '<div id="consent-banner" role="dialog">{}</div>', '<div class="notice alert">{}</div>', '<div class="popup modal">{}</div>'],
    "form": ["<section>{}</section>", "<div>{}</div>", "<form>{}</form>", '<form class="newsletter">{}</form>', '<div class="subscribe"><form>{}</form></div>', '<form role="search">{}</form>'],
    "comment": ['<section id="comments">{}</section>', '<div class="comments">{}</div>', '<ol class="commentlist">{}</ol>', '<div class="comment-thread discussion">{}</div>', '<div id="disqus" class="reviews">{}</div>'],
    "side": ["<section>{}</section>", "<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div class="widget related">{}</div>', '<div class="share social">{}</div>', '<div id="secondary" class="side">{}</div>', '<aside class="sidebar">{}</aside>'],
    "foot": ["<table><tr><td>{}</td></tr></table>", "<div>{}</div>", "<section>{}</section>", "<footer>{}</footer>", '<div id="footer">{}</div>', '<div class="site-footer">{}</div>', '<footer role="contentinfo">{}</footer>'],
    "head": ["<header>{}</header>", '<div id="header">{}</div>', '<div class="masthead top">{}</div>', '<header role="banner">{}</header>'],
    "main": ["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>', '<div id="content" class="post entry">{}</div>', '<div class="article-body story">{}</div>', '<section class="main">{}</section>', '<div role="main">{}</div>', "<div>{}</div>", "{}", "<section>{}</section>", "<table><tr><td>{}</td></tr></table>", '<div class="container"><div class="text">{}</div></div>'],
}


def made_page(rng: random.Random) -> tuple[str, list[int]]:
    """A page of known parts and, for each of its blocks, whether it is main text."""
    labels: list[int] = []
    syllables = rng.choices(SYLLABLES, k=2)

    def prose(n: int, of: int = 0) -> str:
        found = ["".join(rng.choices(syllables[of], k=rng.randint(1, 3))) for _ in range(n)]
        between = " " if rng.random() < 0.9 else rng.choice([" | ", " * ", "### ", ", ", "... ", " - "])
        return between.join(found).capitalize() + ("." if rng.random() < 0.85 else "")

    def other(kind: str) -> str:
        rows = []
        for _ in range(rng.randint(1, 6 if kind in ("menu", "side", "comment") else 2)):
            own = SAID[kind] if rng.random() < 0.65 else SAID_ELSEWHERE[kind].split()
            says = rng.choice([" ", " ", " ", " | ", " · "]).join(rng.choices(own, k=rng.randint(1, 5)))
            if rng.random() < 0.4:
                says = says.capitalize() + rng.choice(["", ".", "!"])
            if kind == "foot" and rng.random() < 0.4:
                says = f"{rng.choice(['Copyright', '©', 'copyright ©'])} {rng.randint(1995, 2026)} {prose(rng.randint(0, 3), 1).strip('.').title()}".strip()
            if kind in ("ad", "foot", "comment", "side", "notice") and rng.random() < 0.6:
                says = (says + " " if rng.random() < 0.4 else "") + prose(rng.randint(3, 40), 1)
            if kind == "menu" and rng.random() < 0.5:
                says = prose(rng.randint(1, 2)).strip(".")
            shape = ("<a href='/x'>{}</a>" if rng.random() < (0.85 if kind in ("menu", "side") else 0.15) else "{}").format(says)
            tags = {"menu": ["<li>{}</li>"], "side": ["<li>{}</li>", "<h3>{}</h3>", "<p>{}</p>", "<div>{}</div>"], "form": ["<label>{}</label><br><button>ok</button>", "<p>{}</p>", "<option>{}</option>"], "comment": ["<li>{}</li>", "<p>{}</p>", "<div class='comment'>{}</div>"]}.get(kind, ["<p>{}</p>", "<div>{}</div>", "<span>{}</span><hr>", "{}<hr>", "{}<hr>"])
            row = rng.choice(tags).format(shape)
            rows.append(row)
            labels.extend([0] * len(blocks(row)))
        inside = "".join(rows)
        return rng.choice(PLACES[kind]).format(f"<ul>{inside}</ul>" if kind == "menu" and rng.random() < 0.7 else inside)

    def item() -> str:
        """A few words, or a number, as lists and tables have them."""
        number = f"{rng.choice([rng.randint(1, 20), rng.randint(1, 2000), round(rng.random() * 100, 1)])} {rng.choice(UNITS)}".strip()
        said = " ".join("".join(rng.choices(syllables[0], k=rng.randint(1, 3))) for _ in range(rng.choice([1, 1, 2, 2, 3, 4, 6])))
        said = said.capitalize() if rng.random() < 0.5 else said
        return rng.choice([number, f"{number} {said}", said, said, said + "."])

    def several() -> str:
        """A list, a table or pictures with many short parts."""
        n, kind = rng.randint(2, 9), rng.choice(["ul", "ol", "dl", "table", "figure", "p", "ul", "table"])
        if kind in ("ul", "ol"):
            return f"<{kind}>" + "".join(f"<li>{item()}</li>" for _ in range(n)) + f"</{kind}>"
        if kind == "dl":
            return "<dl>" + "".join(f"<dt>{item()}</dt><dd>{item() if rng.random() < 0.5 else prose(rng.randint(2, 12))}</dd>" for _ in range(n)) + "</dl>"
        if kind == "figure":
            return "".join(f"<figure><img src='x'><figcaption>{item()}</figcaption></figure>" for _ in range(min(n, 4)))
        if kind == "p":
            return "".join(f"<p>{item()}</p>" for _ in range(min(n, 5)))
        columns, head = rng.randint(2, 4), rng.choice(["row", "column", "none"])
        cell = lambda r, c: "th" if (head == "row" and not r) or (head == "column" and not c) else "td"
        return "<table>" + "".join("<tr>" + "".join(f"<{cell(r, c)}>{item()}</{cell(r, c)}>" for c in range(columns)) + "</tr>" for r in range(min(n, 6))) + "</table>"

    def main() -> str:
        rows = []
        if rng.random() < 0.85:
            rows.append(f"<h1>{prose(rng.randint(1, 12))}</h1>")
        for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 14])):
            if rng.random() < 0.15:
                rows.append(several())
                continue
            text = prose(rng.choice([1, 2, 4, 8, 20, 40, 90]), int(rng.random() < 0.15))
            shape = rng.choices(["<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<div>{}</div>", "<table><tr><td>{}</td></tr></table>", "<p><a href='/y'>{}</a></p>", "<pre>{}</pre>", "<figure><img src='x'><figcaption>{}</figcaption></figure>", "<p><svg class='i'/>{}</p>"], [0.5, 0.08, 0.08, 0.08, 0.07, 0.04, 0.05, 0.04, 0.03, 0.03, 0.1, 0.02])[0]
            rows.append(shape.format(text))
        rows = "".join(rows)
        labels.extend([1] * len(blocks(rows)))
        return rng.choice(PLACES["main"]).format(rows)

    title = prose(rng.randint(2, 10))
    labels.append(0)
    before = [k for k in ("notice", "head", "menu", "ad", "side", "menu", "form") if rng.random() < 0.4]
    # on many pages the article stands between a head and a foot alone
    plain = rng.random() < 0.5
    after = [k for k in (("foot",) if plain else ("ad", "side", "form", "comment", "side", "notice", "foot")) if rng.random() < (0.75 if plain else 0.4)]
    body = "".join(map(other, before)) + main() + "".join(map(other, after))
    if rng.random() < 0.3:
        body = f'<div class="{rng.choice(["wrapper", "page", "container", "site"])}">{body}</div>'
    return f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{body}</body></html>", labels


@functools.lru_cache(1)
def trained(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 11) -> Labeller:
    """Fit the labeller on made pages by back-propagation through time, with Adam."""
    rng, chance = np.random.default_rng(seed), random.Random(seed)
    data = []
    while len(data) < pages:
        page, labels = made_page(chance)
        found = blocks(page)
        if len(found) == len(labels):
            data.append((vectors(found), np.array(labels, np.float32)))
    d = data[0][0].shape[1]
    start = lambda: np.concatenate([rng.normal(0, 0.1, (d + HIDDEN, 4 * HIDDEN)), np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)][None]]).astype(np.float32)
    weights = [start(), start(), rng.normal(0, 0.1, 2 * HIDDEN + 1).astype(np.float32)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, mean, averaged = 0, [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        order = np.concatenate(sorted((order[i : i + 4 * BATCH] for i in range(0, len(order), 4 * BATCH)), key=len)[::-1])
        for at in range(0, len(order), BATCH):
            rows = [data[k] for k in order[at : at + BATCH]]
            model = Labeller(*weights)
            x, mask = model.padded([r[0] for r in rows])
            if epoch:  # some paths unread, so that words and neighbours count too
                x[:, :, :PATH_DIM] *= (rng.random((*mask.shape, 1)) > UNREAD).astype(np.float32)
            y = np.zeros_like(mask)
            for n, r in enumerate(rows):
                y[: len(r[1]), n] = r[1]
            h, ka, kb = model.states(x, mask, keep=True)
            p = 1 / (1 + np.exp(-np.clip(h @ weights[2], -30, 30)))
            g = (p - y) * mask / mask.sum()
            gh = g[:, :, None] * weights[2][None, None, :-1]
            grads = [model.forward.back(x, ka, gh[:, :, :HIDDEN]), model.backward.back(x[::-1], kb, gh[::-1, :, HIDDEN:]), (h * g[:, :, None]).sum((0, 1))]
            step += 1
            rate = RATE * (1 - epoch / (epochs + 1))
            for k, gr in enumerate(grads):
                gr = gr * min(1.0, 5 / (np.linalg.norm(gr) + 1e-9))
                first[k], second[k] = 0.9 * first[k] + 0.1 * gr, 0.999 * second[k] + 0.001 * gr * gr
                weights[k] = weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
                weights[k] = weights[k].astype(np.float32)
            if epoch >= epochs // 2:  # the mean of the later weights depends less on the order of pages than the last ones do
                averaged += 1
                for m, w in zip(mean, weights, strict=True):
                    m += (w - m) / averaged
    return Labeller(*mean)


def main_texts(pages: list[str | None], model: Labeller) -> list[str]:
    found = [blocks(p) for p in pages]
    chances = model.chances([vectors(b) for b in found])
    return ["\n\n".join(b.text for b, p in zip(page, own, strict=True) if p >= 0.5) for page, own in zip(found, chances, strict=True)]


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Labeller | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    bounded_batches(pages.sparkSession)
    model = model or trained()
    weights = (model.forward.w, model.backward.w, model.out)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller(*weights)
        for batch in batches:
            texts = main_texts(batch.column(2).to_pylist(), own)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    chosen = pages.selectExpr(f"`{id_col}` AS page_id", f"`{url_col}` AS url", f"`{html_col}` AS html")
    return chosen.mapInArrow(read, f"page_id {kinds[id_col]}, url string, text string, n_chars bigint")


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
