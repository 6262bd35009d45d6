"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Each is given by a vector of its tag path (hashed names of the elements around it
and of their classes), a vector of its hashed words, and a few numbers. A bidirectional LSTM in numpy reads the whole
sequence in both directions and classifies every block, so each decision sees the whole page.

It is trained here on a bounded sample of pages. Their labels come from the elements and class names that say what a
part is; as pages of one site look alike, every sampled page is also rendered into other layouts, with the parts
that a main text must do without (menus, notices, adverts, forms, comments) around and inside it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.blocks import TRUTH, Block, Place, blocks
from fleetmart.llm.store import Workspace
from fleetmart.llm.words import each_slice


@dataclass(frozen=True)
class Labeller:
    """Parameters."""

    #: Pages of the training sample; each is used as it is and in ``layouts`` other layouts.
    pages: int = 150
    layouts: int = 3
    path_size: int = 96
    word_size: int = 24
    hidden: int = 16
    epochs: int = 10
    batch: int = 24
    rate: float = 0.01
    seed: int = 11
    #: Longest text a sampled page may have in training.
    train_blocks: int = 60


#: Names that say what a part of a page is (fixed lists).
MAIN = frozenset("article main .article .content .post .entry .story .main .body".split())
ASIDE = frozenset(
    "nav header footer aside form button menu dialog .nav .navigation .navbar .menu .breadcrumb .breadcrumbs .header .masthead .footer .sidebar .aside .widget .related .ad .ads .advert "
    ".advertisement .banner .promo .sponsored .sponsor .cookie .cookies .consent .notice .alert .popup .modal .newsletter .subscribe .signup .login .search .share .social .comment .comments "
    ".disqus .replies .pagination .pager .copyright .legal .toolbar .tags .complementary .contentinfo".split()
)


def taught(path: tuple[str, ...]) -> bool | None:
    """Label of a block by the names around it: the innermost one that says something decides; None if none does."""
    for token in reversed(path):
        if token in ASIDE:
            return False
        if token in MAIN:
            return True
    return None


def taught_blocks(page: list[Block]) -> list[bool | None]:
    """``taught`` of all blocks of a page; every element is looked at once."""
    known: dict[Place | None, bool | None] = {None: None}
    for b in page:
        unknown = list(takewhile(lambda p: p not in known, b.place.outwards())) if b.place else []
        for p in reversed(unknown):
            own = taught(p.names)
            known[p] = own if own is not None else known[p.around]
    return [known[b.place] for b in page]


_WORK_MAIN = ["<article>", "<main>", '<div class="content">', '<div id="main">', '<div class="post-content">', '<section class="entry">', '<div class="article-body">', '<div class="story">', '<div role="main">', "<div>", "<td>"]
_WORK_ASIDE = [
    ("<nav>", "li"), ('<div class="menu">', "li"), ('<ul class="navigation">', "li"), ("<header>", "div"), ('<div id="header">', "div"), ("<aside>", "p"), ('<div class="sidebar">', "p"), ('<div class="ad">', ""),
    ('<div class="advert">', "p"), ('<div class="banner">', ""), ('<div class="sponsored">', "p"), ('<div class="cookie-notice">', "p"), ('<div class="notice">', "p"), ('<div id="consent">', "p"), ("<form>", "label"),
    ('<div class="newsletter">', "p"), ('<div class="related">', "li"), ('<div class="share">', "li"), ('<div class="breadcrumb">', "span"),
]
_WORK_END = [("<footer>", "p"), ('<div class="footer">', "p"), ('<div id="footer">', ""), ('<div class="copyright">', "")]
_WORK_TALK = [('<div class="comments">', "p"), ('<section id="comments">', "div"), ('<ol class="comment-list">', "li"), ('<div class="comment">', "p")]


def _closing(opening: str) -> str:
    return f"</{opening[1:-1].split()[0]}>"


def _part(opening: str, inner: str, texts: list[str], main: bool) -> str:
    marked = f"{opening[:-1]} {TRUTH}=\"{int(main)}\">"
    body = "".join(f"<{inner}>{t}</{inner}>" if inner else t for t in texts)
    return marked + body + _closing(opening)


def render(main: list[str], other: list[str], talk: list[str], rng: np.random.Generator) -> str:
    """A page in a random layout around given texts."""

    def some(kinds: list, texts: list[str], most: int) -> str:
        opening, inner = kinds[rng.integers(len(kinds))]
        n = int(rng.integers(1, most + 1))
        return _part(opening, inner, [texts[rng.integers(len(texts))] for _ in range(n)], False) if texts else ""

    before = "".join(some(_WORK_ASIDE, other, 6) for _ in range(rng.integers(0, 4)))
    after = "".join(some(_WORK_ASIDE, other, 6) for _ in range(rng.integers(0, 3)))
    if rng.random() < 0.5:
        after = some(_WORK_TALK, talk, 5) + after
    after += some(_WORK_END, other, 2)
    paragraphs = [f"<h1>{main[0]}</h1>" if main else "", *[f"<p>{t}</p>" for t in main[1:]]]
    if len(paragraphs) > 2 and rng.random() < 0.4:
        paragraphs.insert(int(rng.integers(1, len(paragraphs))), some(_WORK_ASIDE, other, 3))
    if rng.random() < 0.15:
        paragraphs.append(some(_WORK_TALK, talk, 3))
    opening = _WORK_MAIN[rng.integers(len(_WORK_MAIN))]
    body = f"{opening[:-1]} {TRUTH}=\"1\">" + "".join(paragraphs) + _closing(opening)
    wrap = '<div class="page">{}</div>' if rng.random() < 0.3 else "{}"
    return f"<html><head><title>x</title></head><body>{wrap.format(before + body + after)}</body></html>"


_hash_of: dict[str, int] = {}


def _slot(token: str) -> int:
    if token not in _hash_of:
        if len(_hash_of) > 100_000:
            _hash_of.clear()
        _hash_of[token] = zlib.crc32(token.encode("utf-8", "replace"))
    return _hash_of[token]


def features(page: list[Block], p: Labeller) -> np.ndarray:
    """(block, feature) of one page."""
    n = len(page)
    x = np.zeros((n, p.path_size + p.word_size + 8), np.float32)
    # The names around a block weigh 1, 0.9, ... from the innermost outwards, and all further ones a quarter. The sum of
    # all open names goes along with the page, so a name is added and taken away once, however deep the page is.
    around, at = np.zeros(p.path_size, np.int64), None

    def add(place: Place, times: int) -> None:
        for token in place.names:
            slot = _slot(token)
            around[slot % p.path_size] += times if slot >> 16 & 1 else -times

    for i, b in enumerate(page):
        if i and b.place is at:
            x[i, : p.path_size] = x[i - 1, : p.path_size]
            continue
        entered, to = [], b.place
        while at is not to:
            if to is None or (at is not None and at.depth >= to.depth):
                add(at, -1)
                at = at.around
            else:
                entered.append(to)
                to = to.around
        for place in reversed(entered):
            add(place, 1)
        at = b.place
        row = 0.25 * around
        inner = chain.from_iterable(reversed(place.names) for place in at.outwards()) if at else ()
        for k, token in enumerate(islice(inner, 8)):
            slot = _slot(token)
            row[slot % p.path_size] += (1 if slot >> 16 & 1 else -1) * (0.75 - 0.1 * k)
        x[i, : p.path_size] = row
    lengths = np.array([len(b.text) for b in page], np.float32)
    for i, j, h, first in each_slice(pa.array([b.text for b in page], pa.string()), lower=True):
        counts = np.diff(first)
        owner = np.repeat(np.arange(j - i), counts)
        bag = np.zeros((j - i, p.word_size), np.float32)
        np.add.at(bag, (owner, (h % np.uint64(p.word_size)).astype(int)), np.where(h >> np.uint64(63), 1, -1).astype(np.float32))
        x[i:j, p.path_size : -8] = bag / np.sqrt(np.maximum(counts, 1))[:, None]
        x[i:j, -8] = np.log1p(counts) / 4
    x[:, -7] = np.array([b.link_chars for b in page], np.float32) / np.maximum(lengths, 1)
    x[:, -6] = np.array([sum(map(b.text.count, ".,;!?")) for b in page], np.float32) / np.maximum(lengths, 1) * 10
    x[:, -5] = np.arange(n) / max(n, 1)
    x[:, -4] = np.arange(n) < 3
    x[:, -3] = np.arange(n) >= n - 3
    x[:, -2] = [b.place.size / 10 if b.place else 0 for b in page]
    x[:, -1] = 1
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """Two LSTMs over padded sequences (time, batch, feature), one from each end, and a linear layer on both states."""

    def __init__(self, size: int, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        make = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.w = {}
        for side in "fb":
            self.w |= {side + "x": make(size, 4 * hidden), side + "h": make(hidden, 4 * hidden), side + "c": np.zeros(4 * hidden, np.float32)}
            self.w[side + "c"][hidden : 2 * hidden] = 1
        self.w |= {"o": make(2 * hidden, 1), "oc": np.zeros(1, np.float32)}

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray, tape: list | None) -> np.ndarray:
        n, d = x.shape[1], self.hidden
        h, c = np.zeros((n, d), np.float32), np.zeros((n, d), np.float32)
        given = x @ self.w[side + "x"] + self.w[side + "c"]
        out = np.zeros((len(x), n, d), np.float32)
        for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            gates = given[t] + h @ self.w[side + "h"]
            i, f, o = (_sigmoid(gates[:, k * d : (k + 1) * d]) for k in range(3))
            g = np.tanh(gates[:, 3 * d :])
            new = f * c + i * g
            tanh = np.tanh(new)
            m = mask[t][:, None]
            if tape is not None:
                tape.append((t, h, c, i, f, o, g, tanh))
            c = np.where(m, new, c)
            h = np.where(m, o * tanh, h)
            out[t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate((self._run("f", x, mask, None), self._run("b", x, mask, None)), 2)
        return (both @ self.w["o"])[:, :, 0] + self.w["oc"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        tapes = {"f": [], "b": []}
        both = np.concatenate([self._run(s, x, mask, tapes[s]) for s in "fb"], 2)
        score = (both @ self.w["o"])[:, :, 0] + self.w["oc"]
        off = (_sigmoid(score) - y) * mask / mask.sum()
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        grads["o"] = (both.reshape(-1, both.shape[2]).T @ off.reshape(-1, 1)).astype(np.float32)
        grads["oc"] = np.array([off.sum()], np.float32)
        back = off[:, :, None] * self.w["o"][:, 0]
        d = self.hidden
        for k, s in enumerate("fb"):
            dh, dc = np.zeros((x.shape[1], d), np.float32), np.zeros((x.shape[1], d), np.float32)
            for t, h0, c0, i, f, o, g, tanh in reversed(tapes[s]):
                m = mask[t][:, None]
                up = dh + back[t][:, k * d : (k + 1) * d]
                do, dn = up * tanh, dc + up * o * (1 - tanh * tanh)
                step = np.concatenate((dn * g * i * (1 - i), dn * c0 * f * (1 - f), do * o * (1 - o), dn * i * (1 - g * g)), 1) * m
                grads[s + "x"] += x[t].T @ step
                grads[s + "h"] += h0.T @ step
                grads[s + "c"] += step.sum(0)
                dh = np.where(m, step @ self.w[s + "h"].T, up)
                dc = np.where(m, dn * f, dc)
        return grads


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(p) for p in pages)
    x, mask = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32), np.zeros((longest, len(pages)), bool)
    for k, page in enumerate(pages):
        x[: len(page), k], mask[: len(page), k] = page, True
    return x, mask


def training_pages(sample: list[str], p: Labeller) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, labels) of the sampled pages as they are and in other layouts."""
    rng = np.random.default_rng(p.seed)
    parsed = [list(zip(read, taught_blocks(read)))[: p.train_blocks] for read in map(blocks, sample)]
    main = [[b.text for b, y in page if y] for page in parsed]
    other = [[b.text for b, y in page if y is False] for page in parsed]
    out = [(features([b for b, _ in page], p), np.array([bool(y) for _, y in page], np.float32)) for page in parsed if page and any(y for _, y in page)]
    for k, texts in enumerate(main):
        for _ in range(p.layouts if texts else 0):
            strange = int(rng.integers(len(sample)))
            page = blocks(render(texts, other[k] or other[strange] or ["x"], main[strange][1:6] or texts[:1], rng))
            out.append((features(page, p), np.array([bool(b.truth) for b in page], np.float32)))
    return [x for x in out if len(x[0])]


def train(sample: list[str], p: Labeller) -> BiLstm | None:
    """The network after Adam steps on the sample; None if no page of it says where its main text is."""
    pages = training_pages(sample, p)
    if not pages:
        return None
    rng = np.random.default_rng(p.seed + 1)
    net = BiLstm(pages[0][0].shape[1], p.hidden, rng)
    first, second, step = {k: 0.0 for k in net.w}, {k: 0.0 for k in net.w}, 0
    for _ in range(p.epochs):
        # Pages of similar length share a batch.
        order = np.argsort([len(x[0]) + rng.random() * 4 for x in pages])
        starts = rng.permutation(np.arange(0, len(order), p.batch))
        for low in starts:
            chosen = [pages[k] for k in order[low : low + p.batch]]
            x, mask = _padded([c[0] for c in chosen])
            y = np.zeros(mask.shape, np.float32)
            for k, c in enumerate(chosen):
                y[: len(c[1]), k] = c[1]
            step += 1
            for k, g in net.gradients(x, mask, y).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.w[k] = (net.w[k] - p.rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def label(pages: list[list[Block]], net: BiLstm | None, p: Labeller, most: int = 20_000) -> list[np.ndarray]:
    """For every page, which of its blocks are main text. Pages are read in batches of about ``most`` blocks."""
    out: list[np.ndarray] = [np.zeros(len(page), bool) for page in pages]
    if net is None:
        return out
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and stop - at < 256 and (stop - at + 1) * len(pages[order[stop]]) <= most:
            stop += 1
        chosen = order[at:stop]
        x, mask = _padded([features(pages[k], p) for k in chosen])
        score = net.scores(x, mask)
        for k, page in enumerate(chosen):
            out[page] = score[: len(pages[page]), k] > 0
        at = stop
    return out


def _extractor(net: BiLstm | None, p: Labeller):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                pages = [blocks(page) for page in part.column("html").to_pylist()]
                texts = ["\n".join(b.text for b, keep in zip(page, kept) if keep) for page, kept in zip(pages, label(pages, net, p))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
                )

    return run


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", params: Labeller = Labeller()) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``.

    ``text`` joins the blocks labelled as main text in page order by one line end; a null or empty page, and one without
    main text, gives an empty text. If no sampled page names its parts there is nothing to learn from and all texts are
    empty. Whole pages are read, also very long and broken ones. Repeated rows are labelled alike; an empty table gives
    an empty result; further columns are not read. At most about ``params.pages`` pages come to the driver for training.
    """
    work = Workspace(pages.sparkSession, "labeller")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    full = rows.where(F.length("html") > 0)
    n = full.count()
    million = 1_000_000
    drawn = full.where(F.pmod(F.xxhash64("html"), F.lit(million)) < min(million, -(-million * params.pages // max(n, 1)))) if n > params.pages else full
    # A page that very many rows repeat is drawn once; the order is that of the hash, so a repeated run trains alike.
    sample = drawn.select("html", F.xxhash64("html").alias("h")).distinct().orderBy("h", "html").limit(2 * params.pages).select("html").collect()
    net = train([r["html"] for r in sample], params)
    return rows.mapInArrow(_extractor(net, params), "page_id long, url string, text string, n_chars long")
