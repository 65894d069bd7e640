"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import hash_prefix, table, whole_batches
from tabloom.llm.html_blocks import NAMES, Block, blocks

TRAINING_PAGES = 300
SEED = 3
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_END = re.compile(r"[.!?:;…»\"'”)]$")
_STOCK = re.compile(r"©|\bcookies?\b|all rights reserved|copyright|subscribe|newsletter|sign (in|up)|log ?in|read more|share|advertis|sponsored|privacy|terms", re.I)


def _step(value: float, limits: tuple) -> int:
    return sum(value >= x for x in limits)


def block_features(page: list[Block]) -> list[list[str]]:
    """Names of the features of each block: ancestors, tag and text, and whether the neighbours share them."""
    out = []
    for k, b in enumerate(page):
        words = b.text.count(" ") + 1
        inner = NAMES[b.inner] if b.inner >= 0 else "none"
        length = _step(words, (2, 4, 8, 16, 32))
        link = _step(b.link_chars / len(b.text), (0.01, 0.3, 0.7))
        sentence = bool(_END.search(b.text))
        names = ["bias", f"tag={'h' if b.tag in _HEADING else b.tag}", f"inner={inner}", f"words={length}", f"link={link}", f"end={sentence}"]
        names += [f"in={name}" for j, name in enumerate(NAMES) if b.marks >> j & 1]
        names += [f"inner={inner},words={length}", f"words={length},link={link}", f"words={length},end={sentence}"]
        if _STOCK.search(b.text):
            names += ["stock", f"stock,words={length}"]
        if k == 0:
            names.append("first")
        if k == len(page) - 1:
            names.append("last")
        names.append("as_before" if k and page[k - 1].tag == b.tag and page[k - 1].marks == b.marks else "other_than_before")
        out.append(names)
    return out


class Crf:
    """Two labels (0 rest, 1 main text); weights of the features per label and of the steps between labels."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray):
        self.weights, self.steps = weights, steps

    @classmethod
    def fit(cls, pages: list[tuple[list[list[str]], list[int]]], rounds: int = 250, rate: float = 0.15, penalty: float = 2e-3) -> Crf:
        """Maximum conditional likelihood by Adam; forward and backward sums run over all pages at once.

        Only the difference between the labels matters, so a feature has one
        weight. Without pages the weights are zero and every block is rest.
        """
        pages = [p for p in pages if p[0]]
        names = sorted({n for features, _ in pages for block in features for n in block})
        index = {n: k for k, n in enumerate(names)}
        if not pages:
            return cls({}, np.zeros((2, 2)))
        longest, count = max(len(f) for f, _ in pages), len(pages)
        x = np.zeros((count, longest, len(names)), np.float32)
        y = np.zeros((count, longest), int)
        real = np.zeros((count, longest), bool)
        for i, (features, labels) in enumerate(pages):
            for t, block in enumerate(features):
                x[i, t, [index[n] for n in block]] = 1
            y[i, : len(labels)], real[i, : len(labels)] = labels, True
        flat, total = x.reshape(-1, len(names)), real.sum()
        both = real[:, 1:] & real[:, :-1]
        seen_steps = np.zeros((2, 2))
        np.add.at(seen_steps, (y[:, :-1][both], y[:, 1:][both]), 1)
        w, s = np.zeros(len(names)), np.zeros((2, 2))
        moments = [np.zeros(len(names)), np.zeros(len(names)), np.zeros((2, 2)), np.zeros((2, 2))]
        for step in range(1, rounds + 1):
            e = np.zeros((count, longest, 2))
            e[:, :, 1] = (flat @ w.astype(np.float32)).reshape(count, longest)
            e[~real] = 0
            a, b = np.zeros_like(e), np.zeros_like(e)
            a[:, 0] = e[:, 0]
            for t in range(1, longest):
                moved = np.logaddexp.reduce(a[:, t - 1, :, None] + s, axis=1) + e[:, t]
                a[:, t] = np.where(real[:, t, None], moved, a[:, t - 1])
            for t in range(longest - 2, -1, -1):
                moved = np.logaddexp.reduce(s + (e[:, t + 1] + b[:, t + 1])[:, None, :], axis=2)
                b[:, t] = np.where(real[:, t + 1, None], moved, b[:, t + 1])
            z = np.logaddexp.reduce(a[:, -1], axis=1)
            p = np.exp(a + b - z[:, None, None])[:, :, 1] * real
            pair = np.exp(a[:, :-1, :, None] + s + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both[:, :, None, None]
            slopes = [flat.T @ ((p - y) * real).reshape(-1) / total + penalty * w, (pair.sum((0, 1)) - seen_steps) / total + penalty * s]
            for k, (value, slope) in enumerate(zip((w, s), slopes)):
                moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * slope
                moments[2 * k + 1] = 0.999 * moments[2 * k + 1] + 0.001 * slope**2
                value -= rate * (moments[2 * k] / (1 - 0.9**step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.999**step)) + 1e-8)
        return cls({n: float(v) for n, v in zip(names, w)}, s)

    def decode(self, features: list[list[str]]) -> list[int]:
        """The most probable labels, by Viterbi."""
        (s00, s01), (s10, s11) = self.steps.tolist()
        get = self.weights.get
        back = []
        best0 = best1 = 0.0
        for k, block in enumerate(features):
            emitted = sum([get(n, 0.0) for n in block])
            if k == 0:
                best1 = emitted
                continue
            from1_to0, from1_to1 = best1 + s10 > best0 + s00, best1 + s11 >= best0 + s01
            back.append((from1_to0, from1_to1))
            best0, best1 = (best1 + s10 if from1_to0 else best0 + s00), (best1 + s11 if from1_to1 else best0 + s01) + emitted
        if not features:
            return []
        label = int(best1 > best0)
        labels = [label]
        for came in reversed(back):
            label = int(came[label])
            labels.append(label)
        return labels[::-1]


def main_text(page: str, model: Crf) -> str:
    """Blocks of the main text in page order, joined by one line break."""
    found = blocks(page)
    return "\n".join(b.text for b, label in zip(found, model.decode(block_features(found))) if label)


MARK = "\ue000"  # set before the main blocks of a labelled page and taken off before the features


def from_marked(page: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a labelled page: a block is main text when it starts with MARK."""
    found = blocks(page)
    labels = [int(b.text.startswith(MARK)) for b in found]
    return block_features([b._replace(text=b.text.lstrip(MARK) or "-") for b in found]), labels


class Layouts:
    """Labelled pages: page layouts with known main blocks, filled with real texts."""

    def __init__(self, long: list[str], short: list[str], seed: int = SEED):
        self.rng = random.Random(seed)
        self.long, self.short = long or ["Some words of text, and some more."], short or ["Link"]

    def paragraph(self) -> str:
        return self.rng.choice(self.long).replace("<", "&lt;")

    def label(self) -> str:
        return " ".join(self.rng.choice(self.short).replace("<", "&lt;").split()[: self.rng.randint(1, 4)]) or "Link"

    def links(self, many: int) -> str:
        return "".join(f'<li><a href="/{k}">{self.label()}</a></li>' for k in range(many))

    def box(self, inside: str, *openings: str) -> str:
        opening = self.rng.choice(openings)
        return f"<{opening}>{inside}</{opening.split()[0]}>"

    def main(self) -> str:
        rng = self.rng
        title = f"<h1>{MARK}{self.label()} {self.label()}</h1>"
        out = [rng.choice([title, title, title, f"<header>{title}</header>"])] if rng.random() < 0.9 else []
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            text = self.paragraph()
            if kind < 0.5:
                out.append(f"<p>{MARK}{text}</p>")
            elif kind < 0.62:
                out.append(f"<p>{MARK}<b>{text}<br>")
            elif kind < 0.69:
                out.append(f"<h2>{MARK}{self.label()}</h2>")
            elif kind < 0.75:
                out.append("<ul>" + "".join(f"<li>{MARK}{self.paragraph() if rng.random() < 0.6 else self.label() + '.'}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.79:
                out.append(f"<blockquote>{MARK}{text}</blockquote>")
            elif kind < 0.82:
                out.append(f"<pre>{MARK}{self.label()} = {self.label()}</pre>")
            elif kind < 0.85:
                out.append(f"<table><tr><td>{MARK}{self.label()}</td><td>{MARK}{self.label()}</td></tr></table>")
            elif kind < 0.88:
                out.append(f'<p>{MARK}{text} <a href="/x">{self.label()}</a> {self.paragraph()}</p>')
            else:
                inside = rng.choice([f"<p>{text}</p>", f"<p>{text}</p><p>{self.paragraph()}</p>", f"<h3>{self.label()}</h3><ul>{self.links(3)}</ul>"])
                out.append(self.box(inside, "aside", "aside", 'div class="sidebar"', 'div class="ad"', 'div class="newsletter-box"', 'aside class="related"', 'div class="share"', "form", "nav"))
        if rng.random() < 0.15:
            out.append(self.comments())
        return "".join(out)

    def comments(self) -> str:
        talk = "".join(
            self.box(self.box(self.label(), "b", "span", "h4") + f"<p>{self.paragraph()}</p>", "div", "li", 'div class="comment"')
            for _ in range(self.rng.randint(1, 4))
        )
        return self.box(self.box(self.label(), "h2", "h3") + talk, 'section id="comments"', 'div class="comments"', 'div class="comment-list"')

    def page(self) -> str:
        rng, some = self.rng, lambda p: self.rng.random() < p
        parts = []
        if some(0.5):
            parts.append(self.box(self.box(self.label(), "div", "h1", "p", "a") + (self.box(self.paragraph(), "p") if some(0.3) else ""), "header", 'div class="site-header"', 'div id="masthead"'))
        if some(0.9):
            parts.append(self.box(f"<ul>{self.links(rng.randint(2, 8))}</ul>", "nav", 'div class="menu"', 'div id="main-nav"', 'ul class="breadcrumbs"'))
        if some(0.4):
            parts.append(self.box(f"<p>{rng.choice(['We use cookies.', self.paragraph(), 'Subscribe to our newsletter.'])}</p><button>OK</button>", 'div class="cookie-banner"', 'div class="notice"', "dialog", 'div class="alert"'))
        if some(0.6):
            parts.append(self.box(self.paragraph(), 'div class="ad"', 'div class="sponsored"', 'div id="advert-top"', "ins"))
        if some(0.25):
            parts.append(self.box(f"<label>{self.label()}</label><input><button>Go</button>", "form", 'form class="search"', 'div class="login-form"'))
        parts.append(self.box(self.main(), "article", "article", "main", 'div class="content"', 'div id="post"', 'section class="entry"', "div", 'div class="article-body"'))
        if some(0.35):
            parts.append(self.comments())
        if some(0.45):
            side = self.box(self.label(), "h3", "h2") + f"<ul>{self.links(3)}</ul>" + (f"<p>{self.paragraph()}</p>" if some(0.6) else "")
            parts.insert(rng.choice([len(parts), max(0, len(parts) - 2)]), self.box(side, "aside", 'div class="sidebar"', 'div class="widget"', 'div id="related"'))
        if some(0.9):
            text = rng.choice([f"&copy; {self.label()} &middot; {self.paragraph()}", self.label(), f"<p>Copyright {self.label()}</p>", f"<p>{self.paragraph()}</p>"])
            parts.append(self.box(text, "footer", 'div class="footer"', 'div id="site-footer"'))
        return f"<html><head><title>{self.label()}</title></head><body>{''.join(parts)}</body></html>"


def training_pages(pages: DataFrame, rows: int = TRAINING_PAGES) -> list[str]:
    """Labelled pages, as many as rows: layouts filled with the block texts of at most `rows` different pages, the first by a hash of the html.

    `rows` bounds what reaches the driver. Without pages a stock text fills them.
    """
    html = pages.select(F.col("html").cast("string").alias("html")).filter(F.col("html").isNotNull())
    order = F.xxhash64("html", F.lit(SEED))
    first = hash_prefix(html, html.count(), rows, order).distinct().orderBy(order, "html").limit(rows)
    some = [r.html for r in first.collect()]
    texts = [b.text for page in some for b in blocks(page)]
    layouts = Layouts([t for t in texts if t.count(" ") >= 8], [t for t in texts if t.count(" ") < 8])
    return [layouts.page() for _ in range(rows)]


def extract(pages: DataFrame, model: Crf, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): one row per page, whole pages, no shuffle.

    A null or empty html, and a page without main text, give an empty text.
    Equal rows give equal rows; other columns are not looked at; an empty table
    gives no rows. The model, a few hundred weights, goes with the tasks.
    """
    whole_batches(pages.sparkSession)
    shipped = pages.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(page, shipped.value) for page in frame["html"]]
            yield frame[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    kind = pages.schema[id_column].dataType.simpleString()
    wanted = pages.select(
        pages[id_column].alias("page_id"), pages[url_column].cast("string").alias("url"), F.coalesce(pages[html_column].cast("string"), F.lit("")).alias("html")
    )
    return wanted.mapInPandas(run, f"page_id {kind}, url string, text string, n_chars bigint")


def op1_html_crf(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extract(pages, Crf.fit([from_marked(p) for p in training_pages(pages)]))


QUERIES = {"op1_html_crf": op1_html_crf}
SQL: dict[str, str] = {}
