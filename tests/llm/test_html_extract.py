import html
import re

from cellstar.llm import html_extract as he

W = {"p": 0.0, "h1": 0.0, "b": 0.0, "br": 0.0}


def test_blocks_and_containers():
    page = ("<html><head><title>no</title><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>"
            "<div class='cookie-notice'>We use cookies here</div><article><h1>Top &amp; more</h1><p>One <b>wo</b>rd,\n two"
            "<br>three.</p><div class=ad>Buy now</div><p>Here are quite a few more words to end with &lt;x&gt;.</p></article>"
            "<div id='comments'><p>first comment by a reader</p></div><form>Name <input></form><footer>&copy; us</footer>")
    assert he.main_text(page, W) == "Top & more One word, two three. Here are quite a few more words to end with <x>."


def test_odd_markup():
    assert he.main_text(None, W) == he.main_text("", W) == he.main_text("<p></p>", W) == ""
    assert he.main_text("plain text", W) == "plain text"
    assert he.main_text("<!-- c --><script>var t='</p>';</script>a < b", W) == "a < b"
    assert he.main_text("<p>unclosed <b>bold<p>next", W) == "unclosed bold next"
    for s in ("<" * 50_000, "<a " * 30_000, '<a "' * 30_000, "<script>" * 20_000, "<div>" * 20_000):
        he.main_text(s, W)


def test_best_run():
    import random
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randint(-5, 5) for _ in range(rng.randint(0, 20))]
        a, b = he.best_run(s)
        assert sum(s[a:b]) == max([sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)] + [0])


def test_labelled_pages(spark):
    """Every page of the table gives its article's whole text, by learned weights."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = he.learn_weights(pages)
    assert weights["p"] > -0.1 and weights["footer"] < -1 and weights["li*"] < -1
    source = {r.page_id: r.html for r in pages.collect()}
    for r in he.extract(pages, weights).collect():
        page = source[r.page_id]
        own = page[page.index("<article>") + 9:page.index("</article>")]
        own = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", own))
        assert r.text == " ".join(html.unescape(own).split()) and r.n_chars == len(r.text)


def test_wrappers_are_no_other_matter():
    words = "Here are quite a few words of the page that all belong to its one article."
    for name in ("has-sidebar", "no-sidebar", "with-nav", "search-results", "site-search page", "modal"):
        for open_, close in (("<article>", "</article>"), ("<main>", "</main>"), ("", "")):
            page = (f"<html><body><div class='{name}'><nav>Home</nav>{open_}<p>{words}</p>{close}"
                    "<div class='sidebar'>Other links</div></div></body></html>")
            assert he.main_text(page, W) == words, page
    assert he.main_text(f"<form id=aspnet><article><p>{words}</p></article></form>", W) == words


def test_self_closed_raw_elements_are_empty():
    for tag in ("<svg class='x' />", "<iframe src='a'/>", "<svg/>", '<svg viewBox="0 0 1 1"/>'):
        assert he.main_text(f"<p>one {tag}two three</p><p>four</p>", W) == "one two three four"
    assert he.main_text("<p>one <svg><text>no</text></svg>two</p>", W) == "one two"


def test_short_blocks_up_to_the_articles_end():
    page = ("<nav>Home</nav><article><p>Here are quite a few words to begin with.</p>"
            "<div class=ad>Buy this very fine thing now, today and for ever</div><p>The end.</p></article><footer>us</footer>")
    assert he.main_text(page, W) == "Here are quite a few words to begin with. The end."


def test_containers_are_learned(spark):
    """A class word that only stands outside of articles, and a listed one that holds them."""
    words = "quite a few words that belong to the article of this page"
    rows = [(i, None, f"<div class='modal'><div class='zzbox'>links to other places {i}</div><article><p>{words} {i}</p>"
                      "</article></div>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    learned = he.learn_weights(pages)
    assert learned[".zzbox"] > 0.8 and learned[".modal"] < 0.2
    page = f"<div class='zzbox'>a lot of links to some other places here</div><div class='modal'><p>{words}</p></div>"
    assert he.main_text(page, learned) == words


def test_unclosed_elements_swallow_nothing():
    words = "Here are quite a few words of the page that all belong to its one article."
    body = f"<nav>Home</nav><article><p>{words}</p></article><footer>us</footer>"
    for page in (f"<html><head><title>x</title><body>{body}", f"<html><head><title>x</title><meta charset=u>{body}",
                 f"<head><title>x</title><script>var a='<iframe>';</script></head><body>{body}</body>",
                 f"<body><iframe src=x>{body}", f"<body><svg class=a>{body}", f"<body><select name=s>{body}",
                 f"<object data=x>{body}", f"<math>{body}", f"<noscript>{body}", f"<template>{body}",
                 f"<iframe src=x>{body}<iframe src=y>no</iframe>", f"{body}</svg></iframe></select>",
                 f"<svg><g>no</g><svg><text>no</text></svg><text>no</text></svg>{body}",
                 f"<noscript><p>Please enable it, now and in every other browser</p></noscript>{body}"):
        assert he.main_text(page, W) == words, page
    assert he.main_text(f"<article><select><option>no<option>nor</select><p>{words}</article>", W) == words
    assert he.main_text(f"<article><p>{words}<script>never closed {words}</article>", W) == words


def test_labels_and_buttons_in_a_sentence():
    words = "Here are quite a few words of the page."
    page = (f"<article><p>{words} Press <button>Start</button> beside <label>Name</label> now.</p>"
            f"<form><p>Your <label>Address</label> <button>Send</button></p></form><p>{words}</p></article><button>Share</button>")
    assert he.main_text(page, W) == f"{words} Press Start beside Name now. {words}"
