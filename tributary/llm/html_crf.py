"""Main text of pages: a linear-chain conditional random field over the leaf blocks of each page.

Every block has features of its ancestors (element names, words of class, id and role) and of its
text (length, links, marks, place on the page, its neighbours). Two states, main text or not, follow
each other with learned weights; Viterbi finds the best sequence. The weights are fitted, on the
driver, by stochastic gradients of the conditional likelihood on labelled pages: GENERATED pages of
varied make-up whose labels are known, and at most LABELLED pages of the table that mark their
article with an element of its own. Every page is then decoded whole.

Results: a null or empty html, or one without main text, gives an empty text. Repeated rows are extracted
each. An empty table gives no row. Columns other than page_id, url and html play no part.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.html_blocks import Block, blocks

GENERATED = 900
LABELLED = 200
EPOCHS = 8
RATE = 0.3
SHRINK = 1e-5
SEED = 5

MAIN = ""

# Elements and class words that mean something else than the article.
ASIDE = frozenset("in:nav in:aside in:footer in:form in:header".split())
ASIDE_WORDS = (
    "ad ads advert banner sponsor promo nav menu navbar breadcrumb breadcrumbs sidebar widget related share social footer header masthead"
    " cookie notice alert popup modal newsletter subscribe comment comments reply disqus login search form tags meta byline author"
).split()
MAIN_WORDS = "content post article entry story body main text page".split()


def features(page: list[Block]) -> list[list[str]]:
    """Features of every block."""
    words = [b.text.count(" ") + 1 for b in page]
    size = [min(7, int(math.log2(w))) for w in words]
    out = []
    for k, b in enumerate(page):
        links = min(3, int(3.99 * b.linked / max(1, len(b.text))))
        last = b.text[-1]
        end = "." if last in ".!?…。\"'”’" else "," if not last.isalnum() else "a"
        before, after = size[k - 1] if k else "-", size[k + 1] if k + 1 < len(page) else "-"
        out.append(
            [*b.around, f"tag:{b.tag}", f"path:{b.parent}>{b.tag}", f"size:{size[k]}", f"links:{links}", f"end:{end}", f"tag:{b.tag} size:{size[k]}",
             f"links:{links} size:{size[k]}", f"before:{before}", f"after:{after}", f"around:{before},{size[k]},{after}",
             "first" if not k else "last" if k + 1 == len(page) else "inner", "bias"]
            + ["sign"] * ("©" in b.text or "@" in b.text or "|" in b.text)
            + ["like before"] * (k > 0 and page[k - 1].tag == b.tag and page[k - 1].around == b.around)
        )
    return out


class Field:
    """Weights of the features for main text, and of the steps between the two states."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.steps = [[0.0, 0.0], [0.0, 0.0]]

    def _emissions(self, page: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in own]) for own in page]

    def train(self, pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS) -> Field:
        rng = random.Random(SEED)
        order = list(range(len(pages)))
        for epoch in range(epochs):
            rng.shuffle(order)
            rate = RATE / (1 + epoch)
            for k in order:
                self._step(*pages[k], rate)
            for f in self.weights:
                self.weights[f] *= 1 - SHRINK * len(pages)
        return self

    def _step(self, page: list[list[str]], labels: list[int], rate: float) -> None:
        """One gradient step on the log likelihood of a page's labels (forward and backward sums)."""
        if not page:
            return
        e = np.array(self._emissions(page))
        t = np.array(self.steps)
        n = len(e)
        score = np.stack([np.zeros(n), e], axis=1)
        front, back = np.empty((n, 2)), np.zeros((n, 2))
        front[0] = score[0]
        for k in range(1, n):
            front[k] = np.logaddexp(front[k - 1][0] + t[0], front[k - 1][1] + t[1]) + score[k]
        for k in range(n - 2, -1, -1):
            ahead = score[k + 1] + back[k + 1]
            back[k] = np.logaddexp(t[:, 0] + ahead[0], t[:, 1] + ahead[1])
        total = np.logaddexp(*front[-1])
        main = np.exp(front[:, 1] + back[:, 1] - total)
        scale = rate / math.sqrt(n)
        for own, y, p in zip(page, labels, main, strict=True):
            d = scale * (y - p)
            if abs(d) > 1e-4:
                for f in own:
                    self.weights[f] = self.weights.get(f, 0.0) + d / 4
        for k in range(1, n):
            pair = np.exp(front[k - 1][:, None] + t + (score[k] + back[k])[None, :] - total)
            pair[labels[k - 1], labels[k]] -= 1
            for a in (0, 1):
                for b in (0, 1):
                    self.steps[a][b] -= scale * pair[a, b] / 4

    def decode(self, page: list[list[str]]) -> list[int]:
        """The most likely states of a page's blocks (Viterbi)."""
        if not page:
            return []
        (t00, t01), (t10, t11) = self.steps
        e = self._emissions(page)
        other, main, came = 0.0, e[0], []
        for x in e[1:]:
            a, b = other + t00 >= main + t10, other + t01 >= main + t11
            came.append((0 if a else 1, 0 if b else 1))
            other, main = (other + t00 if a else main + t10), (other + t01 if b else main + t11) + x
        state = int(main > other)
        out = [state]
        for step in reversed(came):
            state = step[state]
            out.append(state)
        return out[::-1]


class _Maker:
    """Labelled pages of varied make-up. Main blocks begin with the mark MAIN."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        parts = [a + b for a in ("", "b", "d", "k", "l", "m", "n", "r", "s", "t", "st", "ch", "é", "ü", "ñ") for b in "aeiou"]
        self.words = ["".join(self.rng.choices(parts, k=self.rng.randint(1, 4))) for _ in range(800)]

    def some(self, least: int, most: int) -> str:
        return " ".join(self.rng.choices(self.words, k=self.rng.randint(least, most)))

    def sentence(self, least: int = 4, most: int = 25) -> str:
        odd = self.rng.random()
        words = self.some(least, most)
        if odd < 0.03:
            return words.upper() + "!!"
        if odd < 0.06:
            return " ".join(w + self.rng.choice(["###", "%%%", "&amp;&amp;", "$$", ","]) for w in words.split()) + "."
        return words.capitalize() + self.rng.choice(["."] * 7 + ["?", "!", ""])

    def named(self, words: list[str], chance: float = 0.8) -> str:
        if self.rng.random() > chance:
            return ""
        word = self.rng.choice(words)
        extra = self.rng.choice(["", "", "-" + self.rng.choice(["box", "wrap", "area", "list", "inner", "block"]), " " + self.rng.choice(self.words)])
        return f' {self.rng.choice(["class", "class", "id"])}="{self.rng.choice(["", "", "site-", "page-", "the_"])}{word}{extra}"'

    def links(self, n: int) -> str:
        return "".join(f"<li><a href='/{k}'>{self.some(1, 3).title()}</a></li>" for k in range(n))

    def paragraph(self) -> str:
        body = " ".join(self.sentence() for _ in range(self.rng.choice([1, 1, 2, 3, 5, 9])))
        odd = self.rng.random()
        if odd < 0.12:
            body = f"<b>{MAIN}{body}"
            return f"<p>{body}<br>" if odd < 0.08 else f"<p>{body}</b></p>"
        if odd < 0.25:
            cut = body.split(" ")
            k = self.rng.randrange(len(cut))
            cut[k] = f"<a href='#'>{cut[k]}</a>" if odd < 0.2 else f"<em>{cut[k]}</em>"
            body = " ".join(cut)
        return f"<p>{MAIN}{body}" + ("</p>" if odd < 0.95 else "")

    def article_parts(self) -> list[str]:
        out = []
        for _ in range(self.rng.choice([1, 2, 3, 4, 6, 9, 14])):
            odd = self.rng.random()
            if odd < 0.82:
                out.append(self.paragraph())
            elif odd < 0.88:
                out.append(f"<h2>{MAIN}{self.some(1, 7).capitalize()}</h2>")
            elif odd < 0.93:
                out.append("<ul>" + "".join(f"<li>{MAIN}{self.sentence(2, 15)}</li>" for _ in range(self.rng.randint(2, 5))) + "</ul>")
            elif odd < 0.95:
                out.append(f"<blockquote>{MAIN}{self.sentence()}</blockquote>")
            elif odd < 0.97:
                out.append(f"<pre>{MAIN}{self.some(3, 20)}</pre>")
            else:
                out.append("<table><tr>" + "".join(f"<td>{MAIN}{self.some(1, 4)}</td>" for _ in range(3)) + "</tr></table>")
        return out

    def aside(self) -> str:
        """Something that is not the article."""
        kind = self.rng.randrange(12)
        text = " ".join(self.sentence() for _ in range(self.rng.choice([1, 1, 1, 2, 4])))
        named = self.named
        if kind == 0:
            return f"<nav{named(['nav', 'menu', 'breadcrumb'], 0.5)}><ul>{self.links(self.rng.randint(2, 9))}</ul></nav>"
        if kind == 1:
            return f"<div{named(['menu', 'nav', 'navbar', 'breadcrumbs'], 1)}><ul>{self.links(self.rng.randint(2, 9))}</ul></div>"
        if kind == 2:
            return f"<div{named(['ad', 'ads', 'advert', 'banner', 'sponsor', 'promo'], 1)}>{self.rng.choice([text, f'<p>{text}</p>', f'<a href=x>{text}</a>'])}</div>"
        if kind == 3:
            return f"<aside{named(['sidebar', 'related', 'widget'], 0.5)}><h3>{self.some(1, 3)}</h3>{self.rng.choice([f'<p>{text}</p>', f'<ul>{self.links(4)}</ul>'])}</aside>"
        if kind == 4:
            tag = self.rng.choice(["div", "section"])
            return f"<{tag}{named(['sidebar', 'related', 'widget', 'share', 'social', 'tags'], 1)}><h4>{self.some(1, 3)}</h4><p>{text}</p><ul>{self.links(3)}</ul></{tag}>"
        if kind in (5, 6):
            tag = self.rng.choice(["div", "section", "ol", "ul"])
            inner = "li" if tag in ("ol", "ul") else "div"
            each = "".join(
                f"<{inner}{named(['comment', 'reply'], 0.7)}><b>{self.some(1, 2)}</b><p>{' '.join(self.sentence() for _ in range(self.rng.choice([1, 2, 4])))}</p></{inner}>"
                for _ in range(self.rng.randint(1, 5))
            )
            return f"<{tag}{named(['comments', 'comment-list', 'discussion', 'replies', 'disqus'], 1)}>{self.rng.choice(['', f'<h3>{self.some(1, 3)}</h3>'])}{each}</{tag}>"
        if kind == 7:
            fields = "".join(f"<label>{self.some(1, 3)}</label><input name=x>" for _ in range(self.rng.randint(1, 3)))
            return f"<form{named(['login', 'search', 'newsletter', 'subscribe', 'form'], 0.5)}><p>{self.sentence(3, 12)}</p>{fields}<button>{self.some(1, 2)}</button></form>"
        if kind in (8, 9):
            return f"<div{named(['cookie', 'notice', 'alert', 'popup', 'modal', 'consent', 'message', 'warning', 'gdpr'], 1)}><p>{text}</p><button>{self.some(1, 2)}</button></div>"
        if kind == 10:
            return f"<div{named(['meta', 'byline', 'author', 'date', 'info'], 1)}>{self.some(1, 6)} | {self.some(1, 3)}</div>"
        return f"<p{named(['copyright', 'legal', 'disclaimer', 'notice', 'ad'], 1)}>&copy; {text}</p>"

    def header(self) -> str:
        if self.rng.random() < 0.5:
            tag, named = ("header", self.named(["header", "masthead", "top"], 0.4)) if self.rng.random() < 0.6 else ("div", self.named(["header", "masthead", "top", "logo"], 1))
            return f"<{tag}{named}><{self.rng.choice(['h1', 'div', 'p', 'span'])}>{self.some(1, 4)}</a>{self.rng.choice(['', f'<p>{self.sentence(2, 8)}</p>'])}</{tag}>"
        return ""

    def footer(self) -> str:
        text = self.rng.choice(["&copy; ", "", "© 2020 "]) + self.sentence(2, 20) + self.rng.choice(["", " &middot; " + self.some(1, 4)])
        tag, named = ("footer", self.named(["footer"], 0.4)) if self.rng.random() < 0.7 else ("div", self.named(["footer", "bottom", "copyright"], 1))
        return f"<{tag}{named}>{self.rng.choice([text, f'<p>{text}</p>', f'<p>{text}</p><ul>{self.links(3)}</ul>'])}</{tag}>"

    def page(self) -> str:
        rng = self.rng
        title = f"<{rng.choice(['h1', 'h1', 'h2'])}>{MAIN}{self.some(2, 12).capitalize()}</h1>" if rng.random() < 0.85 else ""
        body = self.article_parts()
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            body.insert(rng.randint(0, len(body)), self.aside())
        if rng.random() < 0.2:
            body.append(self.aside())
        tag = rng.choice(["article", "article", "article", "main", "div", "div", "section", "td"])
        named = self.named(MAIN_WORDS, 0.4 if tag in ("article", "main") else 0.9)
        inner = f"<{tag}{named}>{title}{''.join(body)}</{tag}>"
        if tag == "td":
            inner = f"<table><tr>{inner}<td{self.named(['sidebar', 'menu'], 1)}>{self.links(3)}</td></tr></table>"
        if rng.random() < 0.3:
            outer = rng.choice(["div", "main", "div"])
            inner = f"<{outer}{self.named(['wrapper', 'container', 'page', 'content', 'main'], 0.8)}>{self.aside() if rng.random() < 0.4 else ''}{inner}{self.aside() if rng.random() < 0.4 else ''}</{outer}>"
        before = "".join(self.aside() for _ in range(rng.choice([0, 1, 1, 2])))
        after = "".join(self.aside() for _ in range(rng.choice([0, 0, 1, 2, 3])))
        end = rng.choice(["</body></html>", "</body></html>", ""])
        return f"<!DOCTYPE html><html><head><title>{self.some(2, 6)}</title></head><body>{self.header()}{before}{inner}{after}{self.footer() if rng.random() < 0.85 else ''}{end}"


def made_pages(many: int, seed: int) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels of generated pages."""
    maker, out = _Maker(seed), []
    for _ in range(many):
        found = blocks(maker.page())
        labels = [int(MAIN in b.text) for b in found]
        out.append(([b._replace(text=b.text.replace(MAIN, "") or "-") for b in found], labels))
    return out


def marked_page(page: str | None) -> tuple[list[Block], list[int]] | None:
    """Blocks and labels of a page that marks its article; None for other pages."""
    found = blocks(page)
    inside = [bool({"in:article", "in:main"} & set(b.around)) for b in found]
    if not any(inside):
        return None
    outside = ASIDE | {f"is:{w}" for w in ASIDE_WORDS}
    return found, [int(i and not outside & set(b.around)) for i, b in zip(inside, found, strict=True)]


def fitted(pages: DataFrame, generated: int = GENERATED, labelled: int = LABELLED) -> Field:
    """The field, fitted on generated pages and on the `labelled` pages with the smallest hashes of their ids."""
    ids = pages.where("html IS NOT NULL").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(labelled)
    chosen = [r.page_id for r in ids.collect() if r.page_id is not None]
    some = pages.where(F.col("page_id").isin(chosen)).select("page_id", F.col("html").cast("string").alias("html"))
    rows = some.groupBy("page_id").agg(F.min("html").alias("html")).orderBy("page_id").collect() if chosen else []
    real = [m for r in rows if (m := marked_page(r.html))]
    return Field().train([(features(b), y) for b, y in made_pages(generated, SEED) + real])


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, y in zip(found, field.decode(features(found)), strict=True) if y)


def extracted(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    field = field or fitted(pages)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def extract(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [main_text(h.as_py(), field) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], schema=schema)

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    done = chosen.mapInArrow(extract, "page_id long, url string, text string")
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
