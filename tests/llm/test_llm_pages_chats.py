import hashlib

import public_tokenizers
import pytest

from oddspend.llm import chat, page_text
from oddspend.llm.queries import PROBE

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tree(spark):
    return page_text.train(spark)


def test_tree_on_held_out_layouts(tree):
    """Pages of the same layouts with other words, lengths and order."""
    right = total = 0
    for page in page_text.labelled_pages(120, seed=99):
        found = page_text.blocks(page)
        labels = [page_text.MARK in b["text"] for b in found]
        for b in found:
            b["text"] = b["text"].replace(page_text.MARK, "")
        right += sum(page_text.is_main(tree, x) == y for x, y in zip(page_text.features(found), labels))
        total += len(labels)
    assert right / total > 0.95


PROSE = "The long prose of a paragraph that tells of things at some length, with commas and a full stop at its very end."
LESS = "A second paragraph is shorter than that but still holds a sentence of its own."


@pytest.mark.parametrize(
    "page, texts",
    [
        # names that may stand around main text
        (f"<article><h1>T</h1><p class='tags'>{PROSE}</p></article>", ["T", PROSE]),
        (f"<div class='legal-article'><p>The court held. {PROSE}</p><p>So ordered.</p></div>", [f"The court held. {PROSE}", "So ordered."]),
        (f"<article><h1>T</h1><p>{LESS}</p><section id='discussion'><h2>Discussion</h2><p>{PROSE}</p></section></article>", ["T", LESS, "Discussion", PROSE]),
        # layouts that the labelled pages do not have
        (f"<body><form id='aspnet'><div><a href='/'>Home</a> <a href='/n'>News</a></div><main><h1>Of the town</h1><p>{PROSE}</p></main></form></body>", ["Of the town", PROSE]),
        (f"<article class='post comments-open'><div class='row no-sidebar'><p>{PROSE}</p></div></article><div class='comment-list'><p>{LESS}</p></div>", [PROSE]),
        (f"<div><div><a href='/'>Home</a></div><div><a href='/n'>News and more</a></div></div><div><h2>Of the town</h2><div>{PROSE}</div><div>{LESS}</div></div><div><a href='/i'>Imprint</a></div>", ["Of the town", PROSE, LESS]),
        (f"<table><tr><td><a href='/'>Home</a></td></tr></table><section role='main' class='story'><h1>Of the town</h1><blockquote>{PROSE}</blockquote><p>{LESS}</p><ol><li>{LESS}</li></ol></section><ul class='social'><li><a href='/s'>Share</a></li></ul>", ["Of the town", PROSE, LESS, LESS]),
        (f"<article><h1>T</h1><p>{PROSE}</p><div class='tags'>Tags: <a href='/x'>one</a>, <a href='/y'>two</a></div><div class='ad'>{PROSE}</div></article><section class='reader-comments'><p>{PROSE}</p></section>", ["T", PROSE]),
    ],
)
def test_pages_in_other_layouts(tree, page, texts):
    assert page_text.main_text(tree, page) == "\n\n".join(texts)


def test_tree_uses_counts_and_neighbours(tree):
    def used(node):
        return {page_text.FEATURES[node[0]]} | used(node[2]) | used(node[3]) if isinstance(node, tuple) else set()

    found = used(tree)
    assert {"words", "links", "group_words", "group_links"} <= found and any(x.endswith(("_before", "_after")) for x in found)


def test_what_is_left_out_and_how_text_is_joined(tree):
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body class="post">
    <header><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
    <div class="cookie-notice">We use cookies on this site for you and for others.</div>
    <article><h1>A &amp; B</h1><p>First&nbsp;<b>para</b>graph with   some
    words &lt;here&gt;.<br>And a line.<p>Second paragraph, unclosed, of enough words to be read.
    <div class="ad">Buy now</div><!-- <p>gone</p> --></article>
    <section id="comments"><p>Nice post, thank you very much for it.</p></section>
    <form><p>Write to us, please do.</p><input></form><footer>Imprint</footer></body>"""
    assert page_text.main_text(tree, page) == (
        "A & B\n\nFirst paragraph with some words <here>. And a line.\n\nSecond paragraph, unclosed, of enough words to be read."
    )


def test_odd_pages(spark, tree):
    html = [None, "", "   ", "plain words without a tag", "<p>", "<" * 3000, "<a href='" * 500, "<div>" * 5000 + "deep", "<p>" + "word " * 50_000 + "</p>", "a < b and c > d", "<script>never closed"]
    df = spark.createDataFrame([(k, None, h, "x") for k, h in enumerate(html)] + [(None, "u", "<article><p>a b c</p></article>", "x")] * 2, "page_id bigint, url string, html string, text string")
    rows = page_text.extract(df, tree).collect()
    assert len(rows) == len(html) + 2 and all(r["n_chars"] == len(r["text"]) for r in rows)
    by = {r["page_id"]: r["text"] for r in rows}
    assert by[0] == by[1] == by[2] == by[4] == by[10] == "" and by[None] == "a b c"
    assert page_text.extract(df.limit(0), tree).count() == 0


def test_pages_of_the_table(spark, tree):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in page_text.extract(pages, tree).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert texts[r["page_id"]] == "\n\n".join(b for b in blocks if b)


def test_escapes_are_reversible():
    for text in (PROBE, "<|", "<\\|", "<\\\\|x", "a<", "|", "<<||>>", "\\", ""):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text + "\n\\n")) == text + "\n\\n"
        assert chat.read_turns(chat.turn_text(text, text) * 2) == [(text, text)] * 2


def conversations(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} " * (t % 7 + 1) + PROBE * (t % 3 == 0)) for t in range(1200)]
    rows += [(2, 0, "system", "be kind"), (2, 1, "user", "a" * 3000), (2, 2, "assistant", "word " * 3000), (2, 3, "assistant", "ok")]
    rows += [(3, None, None, None), (3, 1, "assistant", ""), (3, 1, "assistant", ""), (3, 1, "user", "tie"), (4, 0, "system", "alone")]
    rows += [(None, 0, "assistant", "no id"), (5, 0, "rôle\nx\\n", "<|im_start|>")]
    return rows, spark.createDataFrame([(*r, 9, 8) for r in rows], "conv_id bigint, turn bigint, role string, text string, n int, cell int")


@pytest.mark.parametrize("budget,history", [(1024, 128), (64, 16), (20, 0)])
def test_windows_read_back(spark, budget, history):
    rows, df = conversations(spark)
    windows = chat.format_windows(df, PATH, budget, history).cache()
    out = {r["conv_id"]: r for r in chat.digests(windows).collect()}
    turns = {}
    for r in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        turns.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(out) == set(turns)
    for conv, every in turns.items():
        loss = "".join(t for role, t in every if role == "assistant")
        r = out[conv]
        assert r["n_turns"] == len(every) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in every).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    for w in windows.collect():
        found = chat.read_turns(w["text"])
        own = [t for t in found[w["repeated"] :] if t[0] != "system"]
        assert w["n_tokens"] <= budget or len(own) <= 1
        if w["conv_id"] == 2:
            assert found[0] == ("system", "be kind")
        assert all(w["text"][t["last"] :].startswith(chat.END) for t in w["targets"])
    assert windows.filter("conv_id = 1").count() > 1
    assert chat.format_windows(df.limit(0), PATH).count() == 0


def test_heads_without_an_end_and_anchors_that_are_no_links():
    for page in ("<html><head><title>t</title><style>s</style><meta charset=x><p>one two</p>", "<head><title>t<body><p>one two</p>", "<head><title>t</title><script>'<p>'</script></head><p>one two</p>"):
        assert [b["text"] for b in page_text.blocks(page)] == ["one two"]
    for page in ("<p><a name=x>one</p><p>two</p>", "<p><a id=x />one</p><p>two</p>"):
        assert [b["links"] for b in page_text.blocks(page)] == [0, 0]
    assert [b["links"] for b in page_text.blocks("<div><a href=x>one</div><div>two</div>")] == [1, 0]
    assert [b["links"] for b in page_text.blocks("<p><a href=x>one<p>two<p>three")] == [1, 0, 0]
    assert [b["links"] for b in page_text.blocks("<a href=x><h3>one</h3><p>two</p></a><p>three</p>")] == [1, 1, 0]
