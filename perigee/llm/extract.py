"""Main text of pages: boosted trees over the features of DOM elements, decoded hierarchically.

Every block element, and every run of text outside them as an implied one, is scored by gradient-boosted trees over its subtree's density, its attributes' tokens, its
depth, siblings and ancestors. Decoding maximises the summed log-odds under the rule that a kept element's
ancestors are kept, so no choice contradicts another. The trees are fitted by MLlib on a bounded number of
labelled pages which Spark tasks generate from a grammar of usual layouts.
"""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import fit_boosted, map_rows, table
from perigee.llm.dom import BLOCK, RAW, RUN, SCORED, Page, joined
from perigee.session import stable

#: Labelled pages, trees and depth.
SAMPLE_PAGES, TREES, DEPTH = 400, 20, 5
#: Share of labelled pages whose article stands directly in body or in inline elements.
BARE_SHARE = 0.2

#: Tokens of class, id, role and aria-label that tell content or its opposite.
GOOD = frozenset("article content main post story entry text body blog page column".split())
BAD = frozenset(
    "ad ads advert advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs footer header masthead "
    "sidebar side aside widget related recommended cookie cookies consent notice alert popup modal overlay subscribe newsletter signup "
    "login form search share social comment comments reply discussion disqus meta tags pager pagination copyright legal toolbar".split())
GROUPS = {
    "tag_good": {"article", "main"}, "tag_bad": {"nav", "footer", "header", "aside", "form", "menu", "dialog", "select", "button", "fieldset", "search"},
    "tag_p": {"p"}, "tag_head": {"h1", "h2", "h3", "h4", "h5", "h6"}, "tag_list": {"ul", "ol", "li", "dl", "dt", "dd"},
    "tag_cell": {"table", "tbody", "thead", "tr", "td", "th"}, "tag_quote": {"blockquote", "pre", "figure", "figcaption", "details"},
}
FEATURES = [
    *GROUPS, "token_good", "token_bad", "in_good", "in_bad", "under_token_good", "under_token_bad", "depth", "log_chars", "share", "link_density",
    "words_per_block", "stops", "elements", "paragraphs", "inputs", "place", "sibling_place", "siblings", "same_siblings", "parent_share",
    "holds_good", "own_chars", "loose",
]


def _tokens(page: Page, element: int) -> set[str]:
    if not page.attributes[element].strip():
        return set()
    named = page.named(element)
    words = " ".join(named.get(k, "") for k in ("class", "id", "role", "aria-label"))
    return set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", words).lower()))


def page_features(page: Page) -> tuple[list[int], np.ndarray]:
    """The scored elements in page order, and a row of numbers for each."""
    n = len(page.tag)
    chars, links, stops, words = [0] * n, [0] * n, [0] * n, [0] * n
    before, seen = [0] * n, 0
    first: dict[int, int] = {}
    in_link, in_raw = [False] * n, [False] * n
    depth, tokens = [0] * n, [set()] * n
    for i in range(1, n):
        p = page.parent[i]
        in_link[i] = in_link[p] or page.tag[i] == "a"
        depth[i] = depth[p] + 1
        tokens[i] = _tokens(page, i)
    for (element, _, text), within in zip(page.texts, page.within, strict=True):
        size = len(text) - text.count(" ") - text.count("\n")
        if not size:
            continue
        first.setdefault(element, seen)
        seen += size
        chars[element] += size
        words[element] += len(text.split())
        stops[element] += text.count(".") + text.count("!") + text.count("?")
        if in_link[within]:
            links[element] += size
    own = list(chars)
    elements, paragraphs, inputs, blocks, holds = [1] * n, [0] * n, [0] * n, [0] * n, [0] * n
    start = [first.get(i, None) for i in range(n)]
    for i in range(n - 1, 0, -1):
        p, t = page.parent[i], page.tag[i]
        paragraphs[i] += t == "p"
        inputs[i] += t in ("input", "button", "select", "textarea")
        blocks[i] += t in BLOCK
        holds[i] += t in GROUPS["tag_good"]
        for x in (chars, links, stops, words, elements, paragraphs, inputs, blocks, holds):
            x[p] += x[i]
        if start[i] is not None:
            start[p] = start[i] if start[p] is None else min(start[p], start[i])
    children: dict[int, int] = {}
    alike: dict[tuple[int, str], int] = {}
    order = [0] * n
    for i in range(1, n):
        if page.tag[i] in BLOCK:
            order[i] = children.get(page.parent[i], 0)
            children[page.parent[i]] = order[i] + 1
            alike[page.parent[i], page.tag[i]] = alike.get((page.parent[i], page.tag[i]), 0) + 1
    in_good, in_bad, t_good, t_bad = [False] * n, [False] * n, [False] * n, [False] * n
    scored, rows = [], []
    total = max(1, chars[0])
    for i in range(1, n):
        p, t = page.parent[i], page.tag[i]
        good, bad = bool(tokens[i] & GOOD), bool(tokens[i] & BAD)
        if t in SCORED:
            scored.append(i)
            brothers = children.get(p, 1)
            rows.append([
                *(float(t in g) for g in GROUPS.values()), good, bad, in_good[p], in_bad[p], t_good[p], t_bad[p], min(depth[i], 30),
                np.log1p(chars[i]), chars[i] / total, links[i] / max(1, chars[i]), words[i] / max(1, blocks[i]), min(stops[i], 50),
                min(elements[i], 500), min(paragraphs[i], 100), min(inputs[i], 20), (start[i] if start[i] is not None else seen) / total,
                order[i] / brothers, min(brothers, 100), min(alike.get((p, t), 1), 100), chars[i] / max(1, chars[p]), min(holds[i], 3), min(own[i], 2000), t == RUN])
        in_good[i] = in_good[p] or t in GROUPS["tag_good"]
        in_bad[i] = in_bad[p] or t in GROUPS["tag_bad"]
        t_good[i], t_bad[i] = t_good[p] or good, t_bad[p] or bad
    return scored, np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


def margins(model: list[tuple], x: np.ndarray) -> np.ndarray:
    """Margins of fit_boosted's trees for rows of numbers."""

    def values(tree: tuple, rows: np.ndarray, out: np.ndarray) -> None:
        if not len(rows):
            return
        if tree[0] == "leaf":
            out[rows] = tree[1]
            return
        left = x[rows, tree[1]] <= tree[2]
        values(tree[3], rows[left], out)
        values(tree[4], rows[~left], out)

    total, out, rows = np.zeros(len(x)), np.empty(len(x)), np.arange(len(x))
    for weight, tree in model:
        values(tree, rows, out)
        total += weight * out
    return total


def decoded(page: Page, scored: list[int], margin: np.ndarray) -> list[bool]:
    """Kept elements: the choice of largest summed log-odds in which every kept element's ancestors are kept."""
    n = len(page.tag)
    odds = [0.0] * n
    for i, m in zip(scored, margin, strict=True):
        odds[i] = 2.0 * float(m)  # MLlib's margin is half the log-odds
    gain = list(odds)  # best sum of a subtree if its root is kept; dropping it counts 0
    for i in range(n - 1, 0, -1):
        if gain[i] > 0:
            gain[page.parent[i]] += gain[i]
    is_scored = set(scored)
    keep, held = [False] * n, [False] * n  # held: the element's own texts count
    keep[0] = True
    for i in range(1, n):
        p = page.parent[i]
        if page.tag[i] in RAW:
            continue
        if i in is_scored:
            keep[i] = held[i] = keep[p] and gain[i] > 0
        else:
            keep[i], held[i] = keep[p], held[p]
    return held


# ---- labelled pages


def labelled_page(seed: int) -> str:
    """A page of a usual layout; the attribute k is 1 on elements that are content or hold it, else 0."""
    r, bare = random.Random(seed), random.Random(-seed - 1)
    syllables = "an en er on the re ti es or ed ha st in nd ou ea le un que ich ver der lla ción os ment eau".split()

    def word() -> str:
        return "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))

    def words(low: int, high: int) -> str:
        out = [word() + ("," if r.random() < 0.08 else "") for _ in range(r.randint(low, high))]
        return " ".join(out).capitalize() + r.choice([".", ".", ".", "", "!", "?"])

    def attribute(*names: str) -> str:
        return f' {r.choice(["class", "class", "id"])}="{r.choice(names)}{r.choice(["", "", "-" + word()])}"' if names and r.random() < 0.75 else ""

    def tag(name: str, label: int, inner: str, attributes: str = "") -> str:
        return f"<{name}{attributes} k={label}>{inner}</{name}>"

    def links(low: int, high: int) -> str:
        return tag("ul", 0, "".join(tag("li", 0, f'<a href="/{word()}">{words(1, 3)}</a>') for _ in range(r.randint(low, high))))

    def paragraph(label: int) -> str:
        text = words(1, 5) if r.random() < 0.25 else words(5, 90)
        if r.random() < 0.15:
            text += f' <a href="/{word()}">{words(1, 3)}</a> ' + words(1, 12)
        if r.random() < 0.15:
            return f"<p k={label}><b>{text}<br>"
        return tag("p", label, text)

    def extra() -> str:
        kind = r.randrange(9)
        div = r.choice(["div", "div", "section", "aside"])
        if kind == 0:
            return tag(r.choice(["nav", "div"]), 0, links(3, 10), attribute("nav", "menu", "breadcrumbs", "navbar") or ' class="menu"')
        if kind == 1:
            return tag(div, 0, words(2, 25) if r.random() < 0.6 else paragraph(0), f' class="{r.choice(["ad", "ads", "advert", "sponsored", "banner", "promo"])}"')
        if kind == 2:
            return tag(r.choice(["aside", "div"]), 0, tag("h3", 0, words(1, 4)) + links(2, 6), ' class="sidebar"')
        if kind == 3:
            return tag("div", 0, paragraph(0) + tag("button", 0, words(1, 2)), f' class="{r.choice(["cookie-notice", "consent", "notice", "popup", "alert"])}"')
        if kind == 4:
            return tag("form", 0, f"{words(1, 6)}<input name=q>" + tag("button", 0, words(1, 2)), attribute("search", "newsletter", "login"))
        if kind == 5:
            inner = "".join(tag(r.choice(["div", "li", "article"]), 0, tag("h4", 0, word()) + tag("p", 0, words(3, 40)), attribute("comment", "reply")) for _ in range(r.randint(1, 5)))
            return tag(r.choice(["section", "div"]), 0, tag("h2", 0, "Comments") + inner, f' {r.choice(["id", "class"])}="{r.choice(["comments", "discussion", "comment-list"])}"')
        if kind == 6:
            return tag(div, 0, tag("h3", 0, words(1, 3)) + links(2, 5), f' class="{r.choice(["related", "recommended", "widget"])}"')
        if kind == 7:
            return tag("div", 0, "".join(f'<a href="#">{word()}</a> ' for _ in range(4)), ' class="share social"')
        return tag("p", 0, words(2, 10), f' class="{r.choice(["meta", "copyright", "tags"])}"')

    title = words(2, 12)
    inner = [tag("h1", 1, title)] if r.random() < 0.85 else []
    for _ in range(r.randint(1, 14)):
        roll = r.random()
        if roll < 0.78:
            inner.append(paragraph(1))
        elif roll < 0.86:
            inner.append(tag(r.choice(["h2", "h3"]), 1, words(1, 6)))
        elif roll < 0.91:
            inner.append(tag(r.choice(["ul", "ol"]), 1, "".join(tag("li", 1, words(2, 15)) for _ in range(r.randint(2, 6)))))
        elif roll < 0.94:
            inner.append(tag("blockquote", 1, tag("p", 1, words(5, 30))))
        elif roll < 0.96:
            inner.append(tag("table", 1, "".join(tag("tr", 1, tag("td", 1, words(1, 6)) + tag("td", 1, words(1, 6))) for _ in range(3))))
        else:
            inner.append(extra())
    body = "".join(inner)
    if bare.random() < BARE_SHARE:
        return bare_page(bare, title, words, tag, paragraph, extra)
    style = r.random()
    if style < 0.55:
        core = tag("article", 1, body, attribute("post", "story"))
    elif style < 0.7:
        core = tag("main", 1, tag("article", 1, body) if r.random() < 0.5 else body)
    else:
        core = tag(r.choice(["div", "section"]), 1, body, f' {r.choice(["id", "class"])}="{r.choice(["content", "main", "post-body", "article", "entry", "story text"])}"')
    if r.random() < 0.3:
        core = tag("div", 1, core + (extra() if r.random() < 0.5 else ""), attribute("page", "wrapper", "container", "row"))
    head = tag("header", 0, (tag("h1", 0, words(1, 3)) if r.random() < 0.3 else words(1, 4)) + (links(2, 6) if r.random() < 0.5 else ""), attribute("header", "masthead")) if r.random() < 0.5 else ""
    nav = tag("nav", 0, links(3, 9)) if r.random() < 0.7 else ""
    if bare.random() < 0.15:
        nav = bare.choice(['<a href="#main" k=0>' + word() + "</a>", f"<span k=0>{words(1, 6)}</span>"]) + nav
    foot = tag("footer", 0, "&copy; " + words(2, 20) + (links(1, 4) if r.random() < 0.3 else ""), attribute("footer")) if r.random() < 0.8 else ""
    if not foot and r.random() < 0.5:
        foot = tag("div", 0, "&copy; " + words(2, 20), ' class="footer legal"')
    before = "".join(extra() for _ in range(r.randint(0, 2)))
    after = "".join(extra() for _ in range(r.randint(0, 2)))
    return f"<html><head><title>{title}</title><style>p{{}}</style></head><body>{head}{nav}{before}{core}{after}{foot}</body></html>"


def bare_page(r: random.Random, title: str, words, tag, paragraph, extra) -> str:
    """A page whose article is loose text, between line breaks or other blocks; words, tag, paragraph and extra make parts."""

    def text() -> str:
        out = words(1, 6) if r.random() < 0.2 else words(5, 90)
        if r.random() < 0.2:
            out += f" <b>{words(1, 6)}</b> " + words(1, 12)
        if r.random() < 0.15:
            out += f' <a href="/x">{words(1, 3)}</a> ' + words(1, 12)
        return out

    def article() -> str:
        out = [tag("h1", 1, title)] if r.random() < 0.5 else []
        for _ in range(r.randint(1, 6)):
            roll = r.random()
            if roll < 0.65:
                out.append(r.choice(["<br>", "<br><br>"]).join(text() for _ in range(r.randint(1, 4))))
            else:
                out.append(paragraph(1) + "</p>" if roll < 0.85 else tag("h2", 1, words(1, 6)) if roll < 0.93 else "<hr>")
        return "".join(out)

    def junk() -> str:
        if r.random() < 0.4:
            return extra()
        if r.random() < 0.5:
            return " | ".join(f'<a k=0 href="/x">{words(1, 2)}</a>' for _ in range(r.randint(2, 8)))
        return r.choice([f"<small k=0>&copy; {words(2, 12)}</small>", f'<span k=0 class="copyright">{words(2, 12)}</span>'])

    inline = r.choice(["", "", "b", "span", "font", "my-story"])
    core = article() if r.random() < 0.75 else text()
    core = tag(inline, 1, core) if inline else core
    if r.random() < 0.3:  # nothing else on the page
        return core if inline else f"<body k=1>{core}"
    before = junk() + "<hr>" if r.random() < 0.5 else ""
    after = "<hr>" + junk() if r.random() < 0.7 else ""
    return f"<html><head><title>{title}</title></head><body k=1>{before}{core}{after}</body></html>"


def labelled_samples(spark: SparkSession, pages: int = SAMPLE_PAGES, first: int = 0) -> DataFrame:
    """Features and label of every block element of generated pages."""

    def task():
        def work(columns):
            out: dict[str, list] = {k: [] for k in [*FEATURES, "label"]}
            for seed in columns[0]:
                page = Page(labelled_page(seed))
                scored, x = page_features(page)
                for i, row in zip(scored, x.tolist(), strict=True):
                    for name, value in zip(FEATURES, row, strict=True):
                        out[name].append(value)
                    out["label"].append(float(page.named(i).get("k", "0") == "1"))
            return out

        return work

    return map_rows(spark.range(first, first + pages, numPartitions=4), task, ", ".join(f"{f} double" for f in [*FEATURES, "label"]))


_fitted: dict[tuple, list[tuple]] = {}


def fit(spark: SparkSession, pages: int = SAMPLE_PAGES) -> list[tuple]:
    """The trees, fitted once in a Spark application."""
    known = (spark.sparkContext.applicationId, pages)
    if known not in _fitted:
        _fitted[known] = fit_boosted(stable(labelled_samples(spark, pages)), FEATURES, TREES, DEPTH)
    return _fitted[known]


def extract_texts(sources: list[str | None], model: list[tuple]) -> list[str]:
    """Main texts of some pages; all their elements are scored at once."""
    pages = [Page(s or "") for s in sources]
    parts = [page_features(p) for p in pages]
    margin = margins(model, np.concatenate([x for _, x in parts])) if parts else np.empty(0)
    out, at = [], 0
    for page, (scored, x) in zip(pages, parts, strict=True):
        out.append(joined(page, decoded(page, scored, margin[at : at + len(x)])))
        at += len(x)
    return out


def extract(pages: DataFrame, model: list[tuple] | None = None) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    A null or empty html, and a page without main text, give an empty text. Repeated rows and null ids stay as they
    are; other columns are left out.
    """
    model = model or fit(pages.sparkSession)

    def task():
        def work(columns):
            texts = extract_texts(columns[2], model)
            return {"page_id": columns[0], "url": columns[1], "text": texts, "n_chars": [len(t) for t in texts]}

        return work

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return map_rows(rows, task, "page_id long, url string, text string, n_chars long")


def op7_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
