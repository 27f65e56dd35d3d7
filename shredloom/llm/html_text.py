"""Main text of web pages by a recurrent block labeller.

A bidirectional LSTM in numpy reads the blocks of a page in order, each as its tag path and its
hashed words, and labels every block with the whole page in view. It is fitted on pages laid
out at random from the words of a bounded sample, where each block's label is known.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from html import escape
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shredloom.llm.html_blocks import page_blocks

PATH_DIMS, WORD_DIMS, OTHER_DIMS, HIDDEN = 160, 32, 8, 16
SAMPLE_PAGES = 120      # pages whose words the labeller is fitted on, at most
SAMPLE_CHARS = 40_000   # of a page in the sample, at most
LAYOUTS = 8             # random layouts for each page of the sample
EPOCHS, BATCH, RATE = 8, 30, 0.02
SEED = 7
CHUNK = 192             # pages read at once, at most
CHARS = 4 << 20         # of their markup
CELLS = 16_384          # blocks of pages labelled at once, padding included; of a piece of a longer page

# Words that layouts are made of.
MAIN_NAMES = ("content", "article", "post", "entry", "story", "main", "body", "text", "page",
              "post content", "article body", "entry content", "story text", "main content")
MENU_NAMES = ("menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "links", "tabs")
HEAD_NAMES = ("header", "masthead", "top", "banner", "site header", "logo", "branding")
FOOT_NAMES = ("footer", "bottom", "copyright", "colophon", "site footer", "legal")
SIDE_NAMES = ("sidebar", "aside", "widget", "related", "popular", "recommended", "rail",
              "trending", "tags", "share", "social", "teaser")
AD_NAMES = ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "promotion", "adbox",
            "sponsor", "banner ad")
NOTICE_NAMES = ("cookie", "notice", "consent", "cookie banner", "alert", "popup", "modal",
                "gdpr", "overlay", "newsletter", "paywall", "disclaimer")
COMMENT_NAMES = ("comment", "comments", "replies", "discussion", "comment list", "responses",
                 "reader comments", "disqus", "user comment")
FORM_NAMES = ("login", "search", "subscribe", "signup", "contact form", "form", "newsletter")
NOTICE_WORDS = ("we use cookies to improve your experience accept all privacy policy settings "
                "subscribe to continue sign up for our newsletter").split()
FOOT_WORDS = "copyright all rights reserved terms privacy contact about imprint".split()
MENU_WORDS = "home about news contact products services login search blog shop help".split()
FORM_WORDS = "email name password submit search send your message sign in".split()
FILLER = ("the of and to in that it was for on with as at by from this had not are but "
          "time year people way day man thing woman life child world school").split()


def path_tokens(path: str) -> set[str]:
    """Tags and names of a path, and each with its place seen from the block."""
    entries = [entry.split() for entry in path.split("/") if entry]
    tokens = {token for entry in entries for token in entry}
    for depth, entry in enumerate(reversed(entries[-3:])):
        tokens.update(f"{depth}:{token}" for token in entry)
    return tokens


def path_vector(path: str) -> np.ndarray:
    vector = np.zeros(PATH_DIMS, np.float32)
    for token in path_tokens(path):
        vector[crc32(token.encode()) % PATH_DIMS] += 1
    return vector


def text_vector(text: str, linked: int, place: int, count: int) -> np.ndarray:
    """Hashed words of the whole block, and its length, links, end mark and place."""
    vector = np.empty(WORD_DIMS + OTHER_DIMS, np.float32)
    slots = np.fromiter(map(crc32, text.lower().encode().split()), np.int64)
    counts = np.bincount(slots % WORD_DIMS, minlength=WORD_DIMS)
    vector[:WORD_DIMS] = counts / np.sqrt((counts * counts).sum())
    n = len(text)
    vector[WORD_DIMS:] = (
        np.log1p(n) / 5, np.log1p(len(slots)) / 3, min(linked / n, 1.0), text[-1] in ".!?…",
        place / max(count - 1, 1), "©" in text, len(slots) < 5, 1.0)
    return vector


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Labeller:
    """A bidirectional LSTM over block vectors with one output per block."""

    def __init__(self, seed: int = SEED, weights: dict[str, np.ndarray] | None = None):
        if weights is not None:
            self.weights = weights
            return
        draw = np.random.default_rng(seed)
        dims = PATH_DIMS + WORD_DIMS + OTHER_DIMS
        self.weights = {}
        for way in ("f", "b"):
            self.weights[f"W{way}"] = draw.normal(0, dims ** -0.5, (dims, 4 * HIDDEN))
            self.weights[f"U{way}"] = draw.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN:2 * HIDDEN] = 1.0  # keep the state at first
            self.weights[f"c{way}"] = bias
        self.weights["V"] = draw.normal(0, HIDDEN ** -0.5, (2 * HIDDEN, 1))
        self.weights["v"] = np.zeros(1)
        self.weights = {k: w.astype(np.float32) for k, w in self.weights.items()}

    def run(self, inputs: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None,
            start: tuple | None = None):
        """States (pages, blocks, hidden) in one direction from inputs already multiplied by W,
        and the state to go on from; `start` is one left by the blocks before."""
        pages, blocks = mask.shape
        u = self.weights[f"U{way}"]
        h, c = start or (np.zeros((pages, HIDDEN), np.float32),) * 2
        states = np.zeros((pages, blocks, HIDDEN), np.float32)
        for t in range(blocks) if way == "f" else range(blocks - 1, -1, -1):
            z = inputs[:, t] + h @ u
            i, f, o = (sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t:t + 1]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tanh_c, m))
            c, h = m * new_c + (1 - m) * c, m * (o * tanh_c) + (1 - m) * h
            states[:, t] = h
        return states, (h, c)

    def scores(self, inputs: dict[str, np.ndarray], mask: np.ndarray) -> np.ndarray:
        states = np.concatenate(
            [self.run(inputs[way], mask, way)[0] for way in ("f", "b")], axis=2)
        return (states @ self.weights["V"])[:, :, 0] + self.weights["v"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over the blocks, by backpropagation through time."""
        w, kept = self.weights, {"f": [], "b": []}
        states = {way: self.run(x @ w[f"W{way}"] + w[f"c{way}"], mask, way, kept[way])[0]
                  for way in ("f", "b")}
        both = np.concatenate([states["f"], states["b"]], axis=2)
        error = ((sigmoid((both @ w["V"])[:, :, 0] + w["v"]) - y) * mask / mask.sum())[:, :, None]
        grads = {"V": np.einsum("pbh,pbo->ho", both, error), "v": error.sum((0, 1))}
        for n, way in enumerate(("f", "b")):
            above = error @ w["V"][n * HIDDEN:(n + 1) * HIDDEN].T
            dz_all = np.zeros((*mask.shape, 4 * HIDDEN), np.float32)
            d_u = np.zeros_like(w[f"U{way}"])
            dh = dc = np.zeros((len(mask), HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tanh_c, m in reversed(kept[way]):
                dh = dh + above[:, t]
                new_dh, skip_h = m * dh, (1 - m) * dh
                new_dc = m * dc + new_dh * o * (1 - tanh_c ** 2)
                dz = np.concatenate([
                    new_dc * g * i * (1 - i), new_dc * c * f * (1 - f),
                    new_dh * tanh_c * o * (1 - o), new_dc * i * (1 - g ** 2)], axis=1)
                dz_all[:, t] = dz
                d_u += h.T @ dz
                dh, dc = dz @ w[f"U{way}"].T + skip_h, new_dc * f + (1 - m) * dc
            grads[f"U{way}"] = d_u
            grads[f"W{way}"] = np.einsum("pbx,pbz->xz", x, dz_all, optimize=True)
            grads[f"c{way}"] = dz_all.sum((0, 1))
        return grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS,
            seed: int = SEED) -> Labeller:
        """Adam over batches of pages of like length."""
        moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in self.weights.items()}
        draw, step = random.Random(seed), 0
        pages = sorted(pages, key=lambda page: len(page[1]))
        batches = [pages[k:k + BATCH] for k in range(0, len(pages), BATCH)]
        for epoch in range(epochs):
            draw.shuffle(batches)
            for batch in batches:
                x, mask = padded([p[0] for p in batch])
                y = padded([p[1][:, None] for p in batch])[0][:, :, 0]
                step += 1
                rate = RATE * (1 - epoch / epochs)
                for k, grad in self.gradients(x, mask, y).items():
                    grad = np.clip(grad, -1, 1)
                    first, second = moments[k]
                    first += 0.1 * (grad - first)
                    second += 0.01 * (grad ** 2 - second)
                    self.weights[k] -= rate * (first / (1 - 0.9 ** step)) / (
                        np.sqrt(second / (1 - 0.99 ** step)) + 1e-6)
        return self


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(r) for r in rows)
    out = np.zeros((len(rows), longest, rows[0].shape[1]), np.float32)
    mask = np.zeros((len(rows), longest), np.float32)
    for k, r in enumerate(rows):
        out[k, :len(r)], mask[k, :len(r)] = r, 1
    return out, mask


class Reader:
    """Labels the blocks of many pages with a fitted labeller."""

    def __init__(self, labeller: Labeller):
        self.model = labeller
        self.known: dict[str, dict[str, np.ndarray]] = {}

    def path_part(self, path: str) -> dict[str, np.ndarray]:
        if path not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            vector = path_vector(path)
            self.known[path] = {way: vector @ self.model.weights[f"W{way}"][:PATH_DIMS]
                                + self.model.weights[f"c{way}"] for way in ("f", "b")}
        return self.known[path]

    def texts(self, pages: list[str | None]) -> list[str]:
        """Main text of each page: the blocks labelled as such, one per line."""
        found = [page_blocks(html) for html in pages]
        order = sorted((k for k, blocks in enumerate(found) if blocks),
                       key=lambda k: len(found[k]))
        out = [""] * len(pages)
        start = 0
        while start < len(order):
            # Pages of like length together, the padding bounded by the longest one's blocks.
            stop = start + 1
            while stop < len(order) and len(found[order[stop]]) <= min(
                    2 * len(found[order[start]]) + 8, CELLS // (stop - start + 1)):
                stop += 1
            some = order[start:stop]
            for k, good in zip(some, self.label([found[k] for k in some])):
                out[k] = "\n".join(b[1] for b, use in zip(found[k], good) if use)
            start = stop
        return out

    def label_long(self, blocks: list[tuple[str, str, int]]) -> np.ndarray:
        """The labels of one page in pieces; each direction carries its state from piece to piece."""
        scores = np.zeros(len(blocks), np.float32) + self.model.weights["v"]
        starts = range(0, len(blocks), CELLS)
        for n, way in enumerate(("f", "b")):
            state, out = None, self.model.weights["V"][n * HIDDEN:(n + 1) * HIDDEN, 0]
            for low in starts if way == "f" else reversed(starts):
                piece = blocks[low:low + CELLS]
                inputs = np.empty((1, len(piece), 4 * HIDDEN), np.float32)
                for k, (path, text, linked) in enumerate(piece):
                    inputs[0, k] = text_vector(text, linked, low + k, len(blocks)) @ (
                        self.model.weights[f"W{way}"][PATH_DIMS:]) + self.path_part(path)[way]
                states, state = self.model.run(
                    inputs, np.ones((1, len(piece)), np.float32), way, start=state)
                scores[low:low + len(piece)] += states[0] @ out
        return scores > 0

    def label(self, pages: list[list[tuple[str, str, int]]]) -> list[np.ndarray]:
        if len(pages[0]) > CELLS:  # alone
            return [self.label_long(pages[0])]
        inputs = {}
        vectors = [np.stack([text_vector(text, linked, place, len(blocks))
                             for place, (_, text, linked) in enumerate(blocks)])
                   for blocks in pages]
        for way in ("f", "b"):
            rows = [v @ self.model.weights[f"W{way}"][PATH_DIMS:]
                    + np.stack([self.path_part(path)[way] for path, _, _ in blocks])
                    for v, blocks in zip(vectors, pages)]
            inputs[way], mask = padded(rows)
        scores = self.model.scores(inputs, mask)
        return [scores[k, :len(blocks)] > 0 for k, blocks in enumerate(pages)]


class Layout:
    """Draws pages whose blocks have known labels."""

    def __init__(self, texts: list[str], draw: random.Random):
        self.draw, self.texts = draw, texts
        self.words = [w for t in texts for w in t.split()][:20_000] or FILLER

    def some(self, words, low, high) -> str:
        return " ".join(self.draw.choice(words) for _ in range(self.draw.randint(low, high)))

    def prose(self) -> str:
        if self.texts and self.draw.random() < 0.8:
            return self.draw.choice(self.texts)
        return self.some(self.words, 1, 80).capitalize() + self.draw.choice((".", ".", "!", "?"))

    def box(self, tags, names, inner: str) -> str:
        tag = self.draw.choice(tags)
        name = self.draw.choice(names).replace(" ", self.draw.choice((" ", "-", "_")))
        kind = self.draw.choice(("class", "class", "id"))
        attribute = "" if tag not in ("div", "section", "ul", "p", "span") and (
            self.draw.random() < 0.7) else f' {kind}="{name}"'
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def menu(self) -> str:
        links = [f'<li><a href="/x">{escape(self.some(self.draw.choice((self.words, MENU_WORDS)), 1, 3))}'
                 "</a></li>" for _ in range(self.draw.randint(2, 9))]
        if self.draw.random() < 0.2:
            return self.box(("nav", "div"), MENU_NAMES, " | ".join(
                x[4:-5] for x in links))
        return self.box(("nav", "div", "nav"), MENU_NAMES, "<ul>" + "".join(links) + "</ul>")

    def paragraphs(self, low, high) -> str:
        return "".join(f"<p>{escape(self.prose())}</p>" for _ in range(
            self.draw.randint(low, high)))

    def noise(self, kind: str) -> str:
        draw = self.draw
        text = escape(self.prose())
        inner = draw.choice((text, f"<p>{text}</p>", f"<p>{text}</p><p>{escape(self.prose())}</p>"))
        link = f'<a href="/y">{escape(self.some(self.words, 1, 8))}</a>'
        if kind == "ad":
            return self.box(("div", "aside", "section", "p"), AD_NAMES, draw.choice((inner, link)))
        if kind == "notice":
            own = escape(self.some(NOTICE_WORDS, 4, 20))
            return self.box(("div", "section", "div"), NOTICE_NAMES, draw.choice(
                (own, f"<p>{own}</p><button>OK</button>", inner)))
        if kind == "side":
            return self.box(("aside", "div", "section"), SIDE_NAMES, draw.choice((
                inner, f"<h3>{escape(self.some(self.words, 1, 4))}</h3><ul>" + "".join(
                    f"<li>{link}</li>" for _ in range(draw.randint(1, 6))) + "</ul>")))
        if kind == "comments":
            return self.box(("div", "section", "ul"), COMMENT_NAMES, "".join(
                self.box(("div", "li", "article", "p"), COMMENT_NAMES, draw.choice((
                    text, f"<p>{escape(self.prose())}</p>",
                    f"<b>{escape(self.some(self.words, 1, 2))}</b><p>{escape(self.prose())}</p>")))
                for _ in range(draw.randint(1, 4))))
        if kind == "form":
            return "<form" + draw.choice(("", f' class="{draw.choice(FORM_NAMES)}"')) + (
                f"><label>{escape(self.some(FORM_WORDS, 1, 4))}</label><input name=q>"
                f"<p>{draw.choice((text, self.some(FORM_WORDS, 2, 8)))}</p>"
                "<button>Send</button></form>")
        if kind == "head":
            return self.box(("header", "div", "header"), HEAD_NAMES, draw.choice((
                f"<h1>{escape(self.some(self.words, 1, 4))}</h1>", inner, link)))
        copy = draw.choice(("&copy; ", "", "&copy; ")) + self.some(FOOT_WORDS, 1, 6)
        return self.box(("footer", "div", "footer"), FOOT_NAMES, draw.choice((
            copy, f"&copy; example.org &middot; {text}", f"<p>{copy}</p><p>{text}</p>")))

    def main(self) -> str:
        draw, out = self.draw, []
        if draw.random() < 0.9:
            out.append(f"<h1>{escape(self.some(self.words, 2, 10))}</h1>")
        for _ in range(draw.choice((1, 2, 3, 5, 8, 14))):
            kind = draw.random()
            text = escape(self.prose())
            if kind < 0.7:
                out.append(draw.choice((f"<p>{text}</p>", f"<p>{text}</p>", f"<p><b>{text}<br>",
                                        f"<div>{text}</div>", f"<p>{text} <em>x</em></p>")))
            elif kind < 0.8:
                out.append(f"<h2>{escape(self.some(self.words, 1, 7))}</h2><p>{text}</p>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{escape(self.some(self.words, 2, 14))}</li>"
                                            for _ in range(draw.randint(2, 5))) + "</ul>")
            elif kind < 0.91:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.94:
                out.append("<table><tr><td>" + "</td><td>".join(
                    escape(self.some(self.words, 1, 3)) for _ in range(3)) + "</td></tr></table>")
            elif kind < 0.97:
                out.append(f"<figure><img src=x><figcaption>{text}</figcaption></figure>")
            else:
                out.append(f'<p>{text} <a href="/z">{escape(self.some(self.words, 1, 4))}</a></p>')
        return "".join(out)

    def page(self) -> tuple[list[tuple[str, str, int]], list[bool]]:
        """Blocks and labels of one page. Marks around what is not main text give the labels."""
        draw = self.draw
        noise = [lambda k=k: self.noise(k) for k in ("ad", "notice", "side", "head", "form")]
        before = [self.menu()] * (draw.random() < 0.8) + [
            draw.choice(noise)() for _ in range(draw.randint(0, 3))]
        draw.shuffle(before)
        after = [self.noise("comments")] * (draw.random() < 0.45) + [
            draw.choice(noise)() for _ in range(draw.randint(0, 2))] + [
            self.menu()] * (draw.random() < 0.15)
        draw.shuffle(after)
        after += [self.noise("foot")] * (draw.random() < 0.85)
        inside = self.main()
        cut = inside.find("</p><", len(inside) // 3)
        if cut > 0 and draw.random() < 0.4:  # something else in the middle of the article
            extra = draw.choice((self.noise("ad"), self.noise("side"), self.noise("form"),
                                 self.noise("notice")))
            inside = inside[:cut + 4] + MARK[0] + extra + MARK[1] + inside[cut + 4:]
        if draw.random() < 0.2:
            inside += MARK[0] + self.noise("comments") + MARK[1]
        if draw.random() < 0.55:
            body = f"<article>{inside}</article>"
        else:
            body = self.box(("main", "div", "div", "section", "article"), MAIN_NAMES, inside)
        if draw.random() < 0.3:
            body = self.box(("main", "div", "div"), MAIN_NAMES + ("wrapper", "container"), body)
        title = f"<head><title>{escape(self.some(self.words, 2, 9))}</title></head>"
        out = "".join(MARK[0] + x + MARK[1] for x in before) + body + "".join(
            MARK[0] + x + MARK[1] for x in after)
        if draw.random() < 0.3:
            wrapper = draw.choice(("page", "wrapper", "container", "site"))
            out = f'<div id="{wrapper}">{out}</div>'
        blocks = page_blocks(f"<html>{MARK[0]}{title}{MARK[1]}<body>{out}</body></html>")
        outside, clean, labels = False, [], []
        for path, text, linked in blocks:
            if text in ("\ue000", "\ue001"):
                outside = text == "\ue000"
            else:
                clean.append((path, text, linked))
                labels.append(not outside)
        return clean, labels


#: Private characters in elements of their own: each becomes a block that no page has.
MARK = ("<hr>\ue000<hr>", "<hr>\ue001<hr>")


def fit_labeller(samples: list[str], layouts: int = LAYOUTS, seed: int = SEED) -> Labeller:
    """A labeller fitted on random layouts of the samples' words and blocks."""
    draw, pages = random.Random(seed), []
    for sample in samples or [""]:
        texts = [text for _, text, _ in page_blocks(sample)]
        layout = Layout(texts, draw)
        for _ in range(layouts if samples else layouts * 20):
            blocks, labels = layout.page()
            if blocks:
                vectors = np.stack([np.concatenate([
                    path_vector(path), text_vector(text, linked, place, len(blocks))])
                    for place, (path, text, linked) in enumerate(blocks)])
                pages.append((vectors, np.array(labels, np.float32)))
    return Labeller(seed).fit(pages, seed=seed)


def sample_pages(pages: DataFrame, html: str, rows: int = SAMPLE_PAGES,
                 chars: int = SAMPLE_CHARS) -> list[str]:
    """At most `rows` pages of at most `chars` characters, the same ones in every run.

    The bound on their hashes is found from hashes alone; only the pages below it reach the
    driver.
    """
    short = pages.select(F.col(html).alias("html"), F.xxhash64(html).alias("place")).where(
        F.length("html").between(1, chars))
    lowest = [row.place for row in short.select("place").orderBy("place").limit(rows).collect()]
    if not lowest:
        return []
    found = short.where(F.col("place") <= lowest[-1]).select("html").limit(rows).collect()
    return sorted(row.html for row in found)


def extract_main_text(pages: DataFrame, html: str = "html", name: str = "text",
                      labeller: Labeller | None = None) -> DataFrame:
    """The other columns and the main text of each whole page, empty where there is none.

    Null and empty pages give an empty text. Pages of any length are read whole. Repeated rows
    are read each. A column of the input with the added name is replaced. An empty table gives
    no rows. Without a labeller one is fitted on a sample bounded by SAMPLE_PAGES and
    SAMPLE_CHARS, on the driver; pages are labelled where they lie, nothing is shuffled.
    """
    fitted = labeller or fit_labeller(sample_pages(pages, html))
    shared = pages.sparkSession.sparkContext.broadcast(fitted.weights)
    rest = [c for c in pages.columns if c not in (html, name)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Labeller(weights=shared.value))
        for batch in batches:
            for rows in bounded(batch, html):
                texts = reader.texts(rows.column(html).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in rest] + [pa.array(texts, pa.string())],
                    names=[*rest, name])

    schema = pages.select(*rest, F.lit("").alias(name)).schema
    return pages.select(*rest, html).mapInArrow(read, schema)


def bounded(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The rows in slices of `CHUNK` rows and `CHARS` bytes of a column, or one longer row."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = held = 0
    for at, size in enumerate(sizes):
        if at > start and (at - start >= CHUNK or held + size > CHARS):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if batch.num_rows:
        yield batch.slice(start)
