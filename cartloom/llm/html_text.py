"""Main text of web pages: a linear-chain CRF over the blocks of the page.

A page is cut into leaf blocks, runs of text between block-level tags. Each block is
described by the tags and the words of class and id of its ancestors and by traits of its
text. A chain over a page's blocks, trained here in numpy, labels each as main text or
not; Viterbi decoding picks the best labelling of the whole page.

Training pages are marked with the attribute x-label on elements: a bounded sample of
pages whose <article> says where the text is, and the same texts set in other layouts.
"""

import random
import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import first_by_hash, table

SAMPLE_PAGES = 150
LAYOUT_PAGES = 600
STEPS, RATE, RIDGE = 250, 0.1, 1e-3
CHAIN_BLOCKS = 256  # longer pages are learnt from as several chains

# Fixed values of HTML: elements without an end tag, and those inside a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
HIDDEN = frozenset(
    "script style noscript template title head svg math object iframe select option textarea "
    "button".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main nav ol p pre section table ul".split()
)
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
TOKEN = re.compile(r"[a-z]+")


class Open(NamedTuple):
    """An open element: `at` is the nearest block-level tag, `label` the nearest x-label."""

    tag: str
    names: set[str]
    at: str
    label: str | None
    number: int


class Blocks(HTMLParser):
    """Leaf blocks of a page in order: (text, features, label or None).

    What the open elements say of a block is kept up to date as they open and close, so
    a block costs its own text and distinct features, however deep it lies.

    `open_ended` are the numbers of hidden elements known to lack their end tag: they end
    where a block begins, a head where anything but its own elements does. A page is read
    once to find them, as `unclosed`, and again if there are any.
    """

    def __init__(self, open_ended=frozenset()):
        super().__init__(convert_charrefs=True)
        self.open_ended, self.unclosed = open_ended, set()
        self.started = 0  # elements so far
        self.stack: list[Open] = []
        self.of_tag: Counter[str] = Counter()  # open elements by tag
        self.around: Counter[str] = Counter()  # features of the open elements, with repeats
        self.hidden: list[int] = []  # places of hidden elements on the stack
        self.heads: list[int] = []  # those of heads
        self.ended = 0  # hidden elements on the stack that have an end tag
        self.blocks: list[tuple[str, list[str], str | None]] = []
        self.parts: list[str] = []
        self.linked = 0

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            label = self.stack[-1].label if self.stack else None
            self.blocks.append((text, self.describe(text), label))
        self.parts, self.linked = [], 0

    def describe(self, text: str) -> list[str]:
        found = ["bias", f"tags:{min(9, len(self.stack))}", *self.around]
        found.append(f"at:{self.stack[-1].at if self.stack else ''}")
        words = text.count(" ") + 1
        found.append(f"words:{min(6, words.bit_length())}")
        found.append(f"links:{min(3, 4 * self.linked // max(1, len(text)))}")
        if text[-1] in ".!?…:;\"'»”)":
            found.append("ends:stop")
        if "©" in text or "|" in text:
            found.append("has:mark")
        return found

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        self._end_hidden(tag)
        if tag in CLOSES_P:
            self._close("p", CLOSES_P - {"p"})
        if tag == "li":
            self._close("li", {"ul", "ol"})
        if tag in VOID:
            return
        values = dict(attrs)
        said = " ".join(values.get(k) or "" for k in ("class", "id", "role", "aria-label"))
        names = {f"name:{x}" for x in TOKEN.findall(said.lower())}
        if tag not in INLINE:
            names.add(f"in:{tag}")
        above = self.stack[-1] if self.stack else None
        at = tag if tag not in INLINE else above.at if above else ""
        label = values.get("x-label") or (above.label if above else None)
        if tag in HIDDEN:
            self.hidden.append(len(self.stack))
            self.ended += self.started not in self.open_ended
        if tag == "head":
            self.heads.append(len(self.stack))
        self.stack.append(Open(tag, names, at, label, self.started))
        self.of_tag[tag] += 1
        self.around.update(names)
        self.started += 1

    def handle_startendtag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        self._end_hidden(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        if tag not in VOID:
            self._close(tag, ())

    def _close(self, tag, stop):
        """Close the nearest open element of the name, and all in it, unless `stop` is nearer."""
        if not self.of_tag[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                self._cut(i, i + 1)
                return
            if self.stack[i].tag in stop:
                return

    def _cut(self, start, unclosed):
        """End the elements from `start` on; hidden ones from `unclosed` on had no end tag."""
        while len(self.stack) > start:
            gone = self.stack.pop()
            self.of_tag[gone.tag] -= 1
            for name in gone.names:
                if self.around[name] == 1:
                    del self.around[name]
                else:
                    self.around[name] -= 1
            if gone.tag in HIDDEN:
                self.hidden.pop()
                self.ended -= gone.number not in self.open_ended
                if len(self.stack) >= unclosed:
                    self.unclosed.add(gone.number)
            if gone.tag == "head":
                self.heads.pop()

    def _end_hidden(self, tag):
        """End the outermost hidden element if what begins here cannot be in it."""
        if not self.hidden or self.ended:  # `ended`: inside one that has its end tag
            return
        if tag in CLOSES_P or tag == "body":
            at = self.hidden
        else:
            at = self.heads if tag not in IN_HEAD else ()
        if at:
            self._cut(at[0], at[0])

    def close(self):
        super().close()
        self.flush()
        self._cut(0, 0)

    def handle_data(self, data):
        if self.stack and self.stack[-1].tag == "head" and data.strip():
            self._end_hidden("")
        if not self.hidden:
            self.parts.append(data)
            self.linked += len(data) if self.of_tag["a"] else 0


def leaf_blocks(html: str | None) -> list[tuple[str, list[str], str | None]]:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    if parser.unclosed:
        parser = Blocks(frozenset(parser.unclosed))
        parser.feed(html or "")
        parser.close()
    return parser.blocks


class Chain:
    """Two-label linear-chain CRF: a weight per feature for label 1 against label 0."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def decode(self, features: list[list[str]]) -> list[int]:
        """Viterbi: the best labels of a page's blocks."""
        if not features:
            return []
        (stay0, up), (down, stay1) = self.moves.tolist()
        zero, one, back = 0.0, 0.0, []
        for k, names in enumerate(features):
            score = sum(self.weights.get(f, 0.0) for f in names)
            if k == 0:
                zero, one = 0.0, score
                continue
            from0, from1 = zero >= one + down - stay0, zero + up >= one + stay1
            back.append((0 if from0 else 1, 0 if from1 else 1))
            zero, one = max(zero + stay0, one + down), max(zero + up, one + stay1) + score
        labels = [int(one > zero)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def train_chain(pages, steps: int = STEPS) -> Chain:
    """Maximum conditional likelihood with a ridge, by Adam; pages are lists of (features, label).

    Blocks are kept as lists of the numbers of their features. Pages are cut into chains of
    at most CHAIN_BLOCKS blocks, all of which are learnt from; longest first, position by
    position, the blocks of all chains lie together, so that forward and backward sums
    run over whole positions and memory goes by blocks and their features.
    """
    place: dict[str, int] = {}
    chains = []
    for page in pages:
        numbered = [([place.setdefault(f, len(place)) for f in sorted(fs)], y) for fs, y in page]
        chains += [numbered[i : i + CHAIN_BLOCKS] for i in range(0, len(numbered), CHAIN_BLOCKS)]
    chains.sort(key=len, reverse=True)
    sizes = np.array([len(c) for c in chains], int)
    longest = len(chains[0]) if chains else 0
    counts = [int((sizes > t).sum()) for t in range(longest)]
    begins = np.concatenate([[0], np.cumsum(counts)]).astype(int)
    blocks = [chains[i][t] for t in range(longest) for i in range(counts[t])]
    y = np.array([label for _, label in blocks], float)
    flat = np.array([f for fs, _ in blocks for f in fs], np.int32)
    many = np.array([len(fs) for fs, _ in blocks], int)
    owner = np.repeat(np.arange(len(blocks)), many)
    starts = np.concatenate([[0], np.cumsum(many)[:-1]]).astype(int)  # no block is without features
    # a chain's block at one position and the next, as places among the blocks
    after = np.arange(begins[1] if longest else 0, len(blocks))
    before = np.concatenate([[0], *[begins[t] + np.arange(counts[t + 1]) for t in range(longest - 1)]])
    before = before[1:].astype(int)
    last = begins[sizes - 1] + np.arange(len(chains)) if chains else np.zeros(0, int)
    chain = np.concatenate([[0], *[np.arange(n) for n in counts]])[1:].astype(int)

    weights, moves = np.zeros(len(place)), np.zeros((2, 2))
    target_w = np.bincount(flat, y[owner], len(place))
    target_m = np.zeros((2, 2))
    np.add.at(target_m, (y[before].astype(int), y[after].astype(int)), 1)
    first, second = np.zeros(len(place) + 4), np.zeros(len(place) + 4)
    for step in range(1, steps + 1 if chains else 1):
        own = np.zeros((len(blocks), 2))
        own[:, 1] = np.add.reduceat(weights[flat], starts)
        ahead, behind = own.copy(), np.zeros_like(own)
        for t in range(1, longest):
            past = ahead[begins[t - 1] : begins[t - 1] + counts[t]]
            ahead[begins[t] : begins[t + 1]] += np.logaddexp(past[:, :1] + moves[0], past[:, 1:] + moves[1])
        for t in range(longest - 2, -1, -1):
            nxt = own[begins[t + 1] : begins[t + 2]] + behind[begins[t + 1] : begins[t + 2]]
            found = np.logaddexp(nxt[:, :1] + moves[:, 0], nxt[:, 1:] + moves[:, 1])
            behind[begins[t] : begins[t] + counts[t + 1]] = found
        total = np.logaddexp(ahead[last, 0], ahead[last, 1])[chain]
        chance = np.exp(ahead[:, 1] + behind[:, 1] - total)
        pair = ahead[before][:, :, None] + moves + (own + behind)[after][:, None, :]
        pair = np.exp(np.minimum(pair - total[after][:, None, None], 0)).sum(axis=0)
        found_w = np.bincount(flat, chance[owner], len(place))
        slope = np.concatenate([found_w - target_w, (pair - target_m).ravel()]) / len(chains)
        slope += RIDGE * np.concatenate([weights, moves.ravel()])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        change = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, moves = weights - change[:-4], moves - change[-4:].reshape(2, 2)
    return Chain(dict(zip(place, weights.tolist(), strict=True)), moves)


# What parts of a page are commonly called, by role; each layout picks one name of each.
NAMES = {
    role: names.split()
    for role, names in {
        "nav": "nav navbar menu main-menu navigation breadcrumb topnav site-nav",
        "header": "header site-header masthead page-header top-bar banner",
        "footer": "footer site-footer page-footer bottom copyright colophon",
        "side": "sidebar side widget related related-posts recommended trending most-read toc",
        "ad": "ad ads advert advertisement sponsored promo ad-slot ad-banner adsense",
        "notice": "notice cookie cookie-notice cookie-banner consent alert gdpr popup modal message",
        "form": "newsletter subscribe login search signup contact-form search-form",
        "comments": "comments comment-list responses replies discussion disqus reader-comments",
        "comment": "comment comment-body reply response",
        "share": "share social share-buttons tags meta byline author-bio",
        "main": "content main-content article-body post post-content entry entry-content story "
        "story-body text body-text main",
    }.items()
}
PLAIN = ("div", "section", "td", "ul", "p")  # elements that need a name to say their role


class LayoutPage:
    """A marked page in a random layout, with paragraphs of real text in every part of it."""

    def __init__(self, texts: list[str], rng: random.Random):
        self.texts, self.rng = texts, rng
        self.names = {role: rng.choice(names) for role, names in NAMES.items()}

    def text(self) -> str:
        return self.rng.choice(self.texts)

    def short(self) -> str:
        return " ".join(self.text().split()[: self.rng.randint(1, 8)])

    def maybe(self, html: str, chance: float = 0.5) -> str:
        return html if self.rng.random() < chance else ""

    def paragraphs(self, least: int, most: int) -> str:
        return "".join(f"<p>{self.text()}</p>" for _ in range(self.rng.randint(least, most)))

    def part(self, role: str, inner: str, *tags: str) -> str:
        tag = self.rng.choice(tags or ("div", "section"))
        named = f' {self.rng.choice(("class", "id"))}="{self.names[role]}"'
        return f"<{tag}{named if tag in PLAIN else self.maybe(named)}>{inner}</{tag}>"

    def links(self) -> str:
        count = self.rng.randint(2, 6)
        items = (f'<li><a href="/{i}">{self.short()}</a></li>' for i in range(count))
        return f"<ul>{''.join(items)}</ul>"

    def nav(self) -> str:
        return self.part("nav", self.links(), "nav", "div")

    def header(self) -> str:
        name = self.short()
        title = self.rng.choice((f"<h1>{name}</h1>", f"<a href='/'>{name}</a>", f"<p>{name}</p>"))
        return self.part("header", title + self.maybe(self.nav()), "header", "div")

    def ad(self) -> str:
        inner = self.rng.choice((self.short(), self.text(), self.paragraphs(1, 1)))
        return self.part("ad", inner, "div", "aside", "section")

    def notice(self) -> str:
        inner = self.rng.choice((self.text(), self.paragraphs(1, 1)))
        return self.part("notice", inner, "div", "section")

    def form(self) -> str:
        fields = f"<label>{self.short()}</label><p>{self.short()}</p><input type=text>"
        html = f"<form action=/s>{fields}<button>{self.short()}</button></form>"
        return self.rng.choice((html, self.part("form", html, "div")))

    def side(self) -> str:
        inner = self.rng.choice((self.links(), self.paragraphs(1, 3)))
        return self.part("side", f"<h3>{self.short()}</h3>{inner}", "aside", "div")

    def share(self) -> str:
        return self.part("share", self.short(), "div", "div", "ul")

    def comment(self) -> str:
        signed = f"<b>{self.short()}</b><p>{self.text()}</p>"
        inner = self.rng.choice((self.paragraphs(1, 1), signed, self.text()))
        return self.part("comment", inner, "div", "div", "section", "article")

    def comments(self) -> str:
        said = "".join(self.comment() for _ in range(self.rng.randint(1, 4)))
        return self.part("comments", f"<h3>{self.short()}</h3>{said}", "section", "div")

    def footer(self) -> str:
        mark = f"&copy; {self.short()}"
        inner = self.rng.choice((mark, self.paragraphs(1, 1), f"{mark} &middot; {self.text()}"))
        return self.part("footer", inner, "footer", "div")

    def inside(self, html: str, chance: float) -> str:
        """Now and then, a part that is no main text in the midst of it."""
        return self.maybe(html.replace(">", " x-label=0>", 1), chance)

    def main(self) -> str:
        items = "".join(f"<li>{self.short()}</li>" for _ in range(3))
        body = [
            f"<h1>{self.short()}</h1>",
            self.paragraphs(1, 3),
            self.inside(self.ad(), 0.3),
            self.maybe(f"<h2>{self.short()}</h2>"),
            self.maybe(f"<ul>{items}</ul>", 0.3),
            self.maybe(f"<blockquote>{self.paragraphs(1, 1)}</blockquote>", 0.2),
            self.maybe(self.paragraphs(1, 3), 0.7),
            self.inside(self.share(), 0.3),
            self.inside(self.form(), 0.1),
            self.inside(self.side(), 0.1),
            self.inside(self.comments(), 0.2),
        ]
        tag = self.rng.choice(("article", "article", "main", "div", "div", "section", "td"))
        named = f' class="{self.names["main"]}"'
        named = named if tag in PLAIN else self.maybe(named, 0.4)
        html = f"<{tag}{named} x-label=1>{''.join(body)}</{tag}>"
        if tag == "td":
            html = f"<table><tr>{self.part('nav', self.links(), 'td')}{html}</tr></table>"
        around = (
            html,
            f"<main>{html}{self.maybe(self.comments(), 0.3)}</main>",
            f"<div class=wrapper>{html}{self.maybe(self.side(), 0.3)}</div>",
        )
        return self.rng.choice(around)

    def html(self) -> str:
        maybe = self.maybe
        top = self.header() if self.rng.random() < 0.6 else self.nav()
        before = [maybe(self.notice(), 0.3), top, maybe(self.ad(), 0.3), maybe(self.form(), 0.2)]
        after = [
            maybe(self.share(), 0.2),
            maybe(self.comments(), 0.4),
            maybe(self.side(), 0.4),
            maybe(self.form(), 0.2),
            maybe(self.ad(), 0.2),
            maybe(self.notice(), 0.2),
        ]
        self.rng.shuffle(after)
        parts = [*before, maybe(self.side(), 0.2), self.main(), *after, self.footer()]
        head = f"<html><head><title>{self.short()}</title></head>"
        return f"{head}<body x-label=0>{''.join(parts)}</body></html>"


def marked_pages(htmls: list[str], layouts: int = LAYOUT_PAGES, seed: int = 5):
    """Training pages from raw ones: those with one <article>, marked, and other layouts."""
    rng = random.Random(seed)
    marked = [
        h.replace("<article", '<article x-label="1"').replace("<body", '<body x-label="0"')
        for h in htmls
        if h.count("<article") == 1
    ]
    texts = [t for h in htmls for t, _, _ in leaf_blocks(h)] or ["text"]
    texts = [t.replace("&", "&amp;").replace("<", "&lt;") for t in texts]
    yield from marked
    for _ in range(layouts):
        yield LayoutPage(texts, rng).html()


def fit_pages(htmls: list[str], layouts: int = LAYOUT_PAGES) -> Chain:
    """A chain from whole pages, of which one at a time is held as marked text."""
    marked = marked_pages(htmls, layouts)
    return train_chain([(f, int(label == "1")) for _, f, label in leaf_blocks(h)] for h in marked)


def main_text(html: str | None, chain: Chain) -> str:
    blocks = leaf_blocks(html)
    labels = chain.decode([features for _, features, _ in blocks])
    return " ".join(text for (text, _, _), label in zip(blocks, labels, strict=True) if label)


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Chain:
    """A chain from the first `sample` pages by a hash of page_id."""
    rows = first_by_hash(pages.filter("html IS NOT NULL"), "page_id", sample)
    return fit_pages([r["html"] for r in rows.select("html").collect()])


def extract(pages: DataFrame, chain: Chain) -> DataFrame:
    """pages(html, ...) as (row, text): row holds all columns of pages.

    Character references are decoded, white space in a block becomes one blank, blocks
    are joined by one blank in page order. A null, empty or tag-only page has an empty
    text; broken markup is read as far as it can be; repeated rows repeat.
    """
    model = pages.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        for batch in batches:
            row = batch.column("row")
            htmls = batch.column("html").to_pylist()
            texts = [main_text(h, model.value) for h in htmls]
            yield pa.RecordBatch.from_arrays([row, pa.array(texts, pa.string())], ["row", "text"])

    others = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != "html"])
    rows = pages.select(others.alias("row"), F.col("html").cast("string"))
    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row}, text string")


def op8_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, train(pages)).select(
        "row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars")
    )
