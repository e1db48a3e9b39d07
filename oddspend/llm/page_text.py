"""Main text of web pages from flat text blocks.

A page is read once, tag by tag, into blocks of text between block-level tags. A block is
described by its word count and link density, those of the blocks beside it, those of the
list, table or named element around it, and where it stands (inside an article, inside a
menu, aside, footer or form element). Class and id names are a hint in two grades: a few
hardly ever name main text (comments, cookie), many may (tags, legal, discussion), and then
the counts decide. A decision tree trained on a small labelled table decides which blocks
are main text; a part of its pages has neither names nor article elements.

Null and empty html give an empty text. Unclosed tags, comments and quotes end with the
page. Pages are independent: ties and repeated rows are extracted alike, other columns are
ignored, an empty table gives an empty result.
"""

import html
import random
import re

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "group_words", "group_links",
    "in_article", "in_aside", "named", "heading", "item",
)

# names that elements, classes and ids go by on the web
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style noscript template svg iframe object canvas title select textarea audio video math".split())
HEADINGS = {f"h{k}" for k in range(1, 7)}
ITEMS = {"li", "td", "th", "dt", "dd", "option"}
MAIN = set("article main story post entry content body text".split())
BOILERPLATE_TAGS = set("nav aside footer form menu dialog button label fieldset".split())
#: Names that hardly ever stand around main text, and names that may.
STRONG = set(
    "ad ads adv advert adverts advertisement breadcrumb breadcrumbs comment comments consent cookie cookies footer gdpr "
    "login masthead modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion "
    "sidebar signup skip sponsor sponsored toolbar topbar".split()
)
WEAK = set(
    "alert banner copyright discussion disclaimer form header legal links menu overlay reader readers recommended related "
    "replies reply respond search share sharing social subscribe tags teaser trending widget".split()
)
#: Words beside which a name tells the state of a page, not what an element holds (comments-open, no-sidebar).
STATES = set("no has with without open closed enabled disabled".split())
GROUPS = set("ul ol dl table".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ENDS = {name: re.compile(f"</{name}\\b[^>]*(?:>|\\Z)", re.I) for name in SKIPPED}
BODY = re.compile(r"</head\b[^>]*>|<(?=body\b)", re.I)


def named(attributes: str) -> set[str]:
    """Words in class, id, role and label, and `hidden` for what is not shown."""
    found = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role", "aria-label"):
            for part in value.split():
                words = {x.lower() for x in WORD_PARTS.findall(part)}
                if not words & STATES:
                    found |= words
        elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower():
            found.add("hidden")
    return found


def blocks(page: str) -> list[dict]:
    """Text blocks in page order: text, words, link density, place, and the words and link
    density of the outermost list, table or named element around the block."""
    out, text, linked, links = [], [], 0, 0
    # open tags: name, in an article, in a menu, aside, footer or form, grade of names, group
    stack: list[tuple[str, bool, str, int, int]] = []
    outside = ("", False, "", 0, -1)
    groups: list[list[int]] = []  # words, characters in links, characters

    def close():
        nonlocal text, linked
        whole = " ".join("".join(text).split())
        if whole:
            _, main, aside, grade, group = stack[-1] if stack else outside
            names = {x[0] for x in stack}
            if group < 0:  # a group of its own
                group = len(groups)
                groups.append([0, 0, 0])
            words = whole.count(" ") + 1
            groups[group] = [x + y for x, y in zip(groups[group], (words, min(linked, len(whole)), len(whole)))]
            out.append({
                "text": whole, "words": words, "links": min(1.0, linked / len(whole)), "group": group, "in_article": main,
                "in_aside": bool(aside), "named": grade, "heading": bool(names & HEADINGS), "item": bool(names & ITEMS),
            })
        text, linked = [], 0

    def add(raw: str):
        nonlocal linked
        plain = html.unescape(raw)
        text.append(plain)
        if links:
            linked += len(" ".join(plain.split()))

    at, n = 0, len(page)
    while at < n:
        tag = TOKEN.search(page, at)
        if tag is None:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                add(tag[0][9:].removesuffix("]]>"))
            continue
        if not tag[1] and name in SKIPPED:
            if not tag[3].endswith("/"):
                end = ENDS[name].search(page, at)
                if end is None or name == "title":  # one that never ends, ends with the head
                    body = BODY.search(page, at)
                    end = body if end is None or body is not None and body.start() < end.start() else end
                at = n if end is None else end.start() if end[0] == "<" else end.end()
            if name in ("select", "textarea"):
                text.append(" ")
            continue
        if name in BLOCKS:
            close()
        elif name == "br":
            text.append(" ")
        if name in VOID or name == "head":  # the end of a head may be left out; what it holds is skipped by itself
            continue
        if tag[1]:
            if any(x[0] == name for x in stack):
                while stack and stack.pop()[0] != name:
                    pass
            if name == "a" or not any(x[0] == "a" for x in stack):  # a link ends with what it stands in
                links = 0
            continue
        if name == "p":  # a paragraph ends where the next one starts
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    del stack[k:]
                    links = links and int(any(x[0] == "a" for x in stack))
                    break
                if stack[k][0] in BLOCKS:
                    break
        words = named(tag[3])
        _, main, aside, grade, group = stack[-1] if stack else outside
        if name == "a":
            links = int(any(x.lower() == "href" for x, _ in ATTRIBUTE.findall(tag[3])))
        if name in ("article", "main") and aside == "form":  # a form around the whole page
            aside = ""
        if name in BOILERPLATE_TAGS or "hidden" in words or name == "header" and not main:
            aside = "form" if name == "form" and aside in ("", "form") else name
        if name not in ("body", "html"):
            own = 0 if name in ("article", "main") or main and words <= {"header"} else 2 if words & STRONG else int(bool(words & WEAK))
            grade = max(grade, own)
            main = main or name in ("article", "main") or bool(words & MAIN)
            if group < 0 and (own or name in GROUPS):
                group = len(groups)
                groups.append([0, 0, 0])
        stack.append((name, main, aside, grade, group))
    close()
    for b in out:
        n_words, n_linked, n_chars = groups[b.pop("group")]
        b["group_words"], b["group_links"] = n_words, n_linked / n_chars
    return out


def features(page: list[dict]) -> list[list[float]]:
    near = [(b["words"], b["links"]) for b in page]
    edge = (0, 0.0)
    return [
        [float(x) for x in (*near[k], *(near[k - 1] if k else edge), *(near[k + 1] if k + 1 < len(page) else edge), *(b[x] for x in FEATURES[6:]))]
        for k, b in enumerate(page)
    ]


MARK = "␟"  # marks main text in the labelled pages


def labelled_pages(n: int = 900, seed: int = 7):
    """Invented pages in several layouts; the main text is marked. The bound of the labelled
    table is the parameter n."""
    rng = random.Random(seed)

    def words(low, high):
        return " ".join("".join(rng.choice("bdfklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high)))

    def link_list(k):
        return "".join(f"<li><a href='/{i}'>{words(1, 3)}</a></li>" for i in range(k))

    def body(tag="p", adverts=True, least=1):
        out = []
        for _ in range(rng.randint(1, 9)):
            inner = MARK + words(least, 90 if rng.random() < 0.8 else 5 * least)
            if rng.random() < 0.2:
                inner += f" <a href='#'>{words(1, 3)}</a> {words(3, 30)}"
            if adverts and rng.random() < 0.06:
                inner = f"{MARK}{words(0, 3)} <a href='#'>{MARK}{words(1, 9)}</a>"
            out.append(f"<{tag}>{inner}</{tag}>" if rng.random() < 0.8 else f"<h2>{MARK}{words(1, 6)}</h2>")
            if rng.random() < 0.1:
                out.append("<ul>" + "".join(f"<li>{MARK}{words(2, 12)}</li>" for _ in range(3)) + "</ul>")
            if adverts and rng.random() < 0.1:
                out.append(f"<div class='ad'>{words(2, 14)}</div>")
            if adverts and rng.random() < 0.15:  # a name that tells little, around prose or around links
                name, prose = rng.choice(weak), rng.random() < 0.6
                inside = f"<h3>{MARK}{words(1, 4)}</h3><p>{MARK}{words(15, 90)}</p><p>{MARK}{words(2, 60)}</p>" if prose else rng.choice((f"<ul>{link_list(3)}</ul>", f"<p>{words(1, 6)}</p>", f"{words(1, 2)}: <a href='/t'>{words(1, 2)}</a>, <a href='/u'>{words(1, 2)}</a>"))
                out.append(f"<section class='{name}'>{inside}</section>" if rng.random() < 0.6 or not prose else f"<p class='{name}'>{MARK}{words(14, 90)}</p>")
        return "".join(out)

    weak = sorted(WEAK - {"reader", "readers", "reply", "replies", "respond"})
    for k in range(n):
        title = f"<h1>{MARK}{words(1, 12)}</h1>" if rng.random() < 0.75 else ""
        menu, foot = link_list(rng.randint(2, 9)), f"{words(2, 16)} <a href='/'>{words(1, 2)}</a>"
        remarks = "".join(f"<div><b>{words(1, 2)}</b><p>{words(3, 40)}</p></div>" for _ in range(rng.randint(0, 4)))
        aside = f"<h3>{words(1, 3)}</h3><ul>{link_list(4)}</ul><p>{words(3, 25)}</p>"
        name = rng.choice(weak)
        maybe = lambda x: x if rng.random() < 0.75 else ""  # noqa: E731, B023  parts that a page may lack
        yield (
            lambda: maybe(f"<nav><ul>{menu}</ul></nav>") + maybe(f"<div class='ad'>{words(3, 12)}</div>") + f"<article>{title}{body()}</article>" + maybe(f"<footer>{foot}</footer>"),
            lambda: maybe(f"<header><h2>{words(1, 4)}</h2><ul>{menu}</ul></header>") + f"<main><article>{title}{body()}</article><section class='comments'>{remarks}</section></main>" + maybe(f"<aside>{aside}</aside>") + maybe(f"<footer>{foot}</footer>"),
            lambda: maybe(f"<div id='menu'>{menu}</div>") + maybe(f"<div class='cookie-notice'><p>{words(8, 40)}</p></div>") + f"<div id='content'>{title}{body()}</div>" + maybe(f"<div id='sidebar'>{aside}</div>") + maybe(f"<div id='footer'>{foot}</div>"),
            lambda: maybe(f"<ul>{menu}</ul>") + title + body("div", False) + maybe(f"<ul>{link_list(5)}</ul><p><a href='/'>{words(1, 3)}</a> | <a href='/b'>{words(1, 3)}</a></p>"),
            lambda: maybe(f"<div class='topbar'>{words(1, 6)}</div>") + f"<div class='post'>{title}{body()}</div>" + maybe(f"<form><label>{words(1, 3)}</label><p>{words(3, 12)}</p><button>{words(1, 2)}</button></form>") + f"<div id='comments'>{remarks}</div>" + maybe(f"<footer><p>{foot}</p></footer>"),
            lambda: maybe(f"<table><tr><td><a href='/'>{words(1, 2)}</a></td><td><a href='/x'>{words(1, 2)}</a></td></tr></table>") + f"<div>{title}{body('p', False)}</div>" + maybe(f"<div class='related'>{link_list(3)}</div>") + maybe(f"<div class='footer'>{foot}</div>"),
            # neither names nor article elements: counts and neighbours alone tell
            lambda: maybe(f"<div>{words(1, 3)}</div>") + f"<div>{menu}</div><div>{MARK}{words(4, 12)}</div>{body('p', False, 6)}<div>{link_list(4)}</div>" + maybe(f"<div>{words(2, 5)} <a href='/'>{words(2, 4)}</a></div>"),
            lambda: maybe(f"<div class='{name}-bar'><p>{words(2, 12)}</p></div>") + f"<div class='{rng.choice(('post', 'article', 'story'))}'>{title}{body()}</div><div class='{name}'><p>{words(3, 40)}</p><p>{words(3, 20)}</p></div>",
            lambda: maybe(f"<div id='banner'>{words(1, 5)}</div>") + f"<div class='{name}-{rng.choice(('article', 'text', 'story'))}'>{MARK}{words(5, 60)}<p>{MARK}{words(15, 60)}</p><p>{MARK}{words(1, 30)}</p></div>" + maybe(f"<footer>{foot}</footer>"),
        )[k % 9]()


def labelled_blocks(n: int = 900):
    """(features, label) of each block of the labelled pages."""
    for page in labelled_pages(n):
        found = blocks(page)
        labels = [float(MARK in b["text"]) for b in found]
        for b in found:
            b["text"] = b["text"].replace(MARK, "")
        yield from zip(features(found), labels)


def train(spark: SparkSession, n: int = 900, depth: int = 12) -> tuple:
    """A decision tree over FEATURES as nested tuples (feature, threshold, low side, high side)."""
    rows = spark.createDataFrame([(x, y) for x, y in labelled_blocks(n)], "x array<double>, label double")
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=4, seed=1).fit(rows.select(array_to_vector("x").alias("features"), "label"))

    def walk(node):
        if node.subtreeDepth() == 0:
            return node.prediction() > 0.5
        low, high = walk(node.leftChild()), walk(node.rightChild())
        return low if low == high else (node.split().featureIndex(), node.split().threshold(), low, high)

    return walk(model._call_java("rootNode"))


def is_main(tree, x: list[float]) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(tree, page: str | None) -> str:
    found = blocks(page or "")
    return "\n\n".join(b["text"] for b, x in zip(found, features(found)) if is_main(tree, x))


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """page_id, url, text, n_chars for each page."""
    tree = train(pages.sparkSession) if tree is None else tree

    def run(batches):
        for batch in batches:
            texts = [main_text(tree, page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
