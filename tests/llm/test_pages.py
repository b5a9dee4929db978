from __future__ import annotations

import time

import pytest

from wearspan.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">two</a></li></ul></nav><div class="ad">Buy this now please</div>
<article><h1>Head &amp; line</h1><p>First   paragraph with<br>many words in it &lt;ok&gt;.<p>Second one, <b>bold</b> words, unclosed
<div class="promo">not this</div><form><p>nor this</p></form><p>Third&nbsp;part of the text</p>
<section id="comments"><p>reader says hello there</p></section></article>
<aside>side bar words</aside><footer>&copy; foot words</footer></body></html>"""
TEXT = "Head & line\n\nFirst paragraph with many words in it <ok>.\n\nSecond one, bold words, unclosed\n\nThird part of the text"


def test_main_text_with_and_without_training(spark):
    rows = [(i, "u", PAGE) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    weights = pages.fit_weights(df)
    assert pages.main_text(PAGE, weights) == TEXT
    bare = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    assert pages.main_text(bare, weights) == TEXT


def test_region_is_the_best_of_all():
    import itertools
    import random

    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.choice((-2.0, -1.0, 0.5, 1.0)) for _ in range(rng.randrange(1, 12))]
        first, last = pages.best_region(scores)
        best = max([0.0] + [sum(scores[a:b]) for a, b in itertools.combinations(range(len(scores) + 1), 2)])
        assert sum(scores[first:last]) == best


def test_odd_pages(spark):
    odd = [(1, "a", None), (2, "b", ""), (3, None, "no markup at all"), (4, "d", "<p>cut <a href='"), (None, "e", "<nav>only menu</nav>"), (6, "f", "<article><p>" + "w " * 50_000)]
    df = spark.createDataFrame(odd + odd[2:3], "page_id long, url string, html string").selectExpr("*", "'x' AS text")
    out = {r["page_id"]: r for r in pages.page_texts(df).collect()}
    assert out[1]["text"] == out[2]["text"] == "" and out[3]["text"] == "no markup at all"
    assert out[6]["n_chars"] == 99_999 and out[None]["text"] == ""
    assert pages.page_texts(df).count() == 7
    assert pages.page_texts(df.limit(0)).count() == 0


def test_excluded_parts_neither_win_nor_cut(spark):
    links = "<ul>" + "".join(f'<li><a href="/{i}">link</a></li>' for i in range(10)) + "</ul>"
    reader = "<p>" + "reader " * 100 + "</p>"
    one, two = "first " * 20, "second " * 12
    behind = f"<p>{one}</p>{links}<section class=comments>{reader}</section>"
    split = f"<p>{one}</p><section class=comments>{'<p>x</p>' * 60}{reader}</section><p>{two}</p>"
    bare = pages.PageWeights({})
    assert pages.main_text(behind, bare) == one.strip()
    assert pages.main_text(split, bare) == f"{one.strip()}\n\n{two.strip()}"
    # Learned from pages whose comments outweigh the article, behind it and inside.
    rows = [(1, "u", f"<article><p>{one}</p></article>{links}<section class=comments>{reader * 9}</section>"), (2, "u", f"<article>{split}</article>{links}")]
    learned = pages.fit_weights(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert learned.of("w:p") > 0 > learned.of("w:li+a")
    assert pages.main_text(behind, learned) == one.strip()
    assert pages.main_text(split, learned) == f"{one.strip()}\n\n{two.strip()}"


@pytest.mark.parametrize("name", ["content no-sidebar", "page has-sidebar", "layout with-nav", "post category-social", "entry tag-ads", "story header-large"])
def test_listed_words_in_longer_names_lose_no_article(name):
    body = "".join(f"<p>{'many words of the article ' * 8}</p>" for _ in range(4))
    page = f"<nav><a href=x>Menu</a></nav><div class='{name}'><h1>Head</h1>{body}<div class='ad'>buy this</div><section class='comments'><p>reader says</p></section></div>"
    text = pages.main_text(page, pages.PageWeights({}))
    assert text.count("many words") == 32 and "buy" not in text and "reader" not in text


def test_listed_parts_of_names_are_learned(spark):
    article = f"<article><p>{'first words ' * 30}</p></article>"
    rows = [(i, "u", f"{article}<div class='share-box'><p>{'tell your friends ' * 8}</p></div>") for i in range(9)]
    learned = pages.fit_weights(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert learned.of("w:p") > 0 > learned.of("w:p+n")
    bare = f"<div><p>{'first words ' * 30}</p></div><div class='share-box'><p>{'tell your friends ' * 8}</p></div>"
    assert pages.main_text(bare, learned) == ("first words " * 30).strip()
    assert pages.PageWeights({}).of("w:p+n") == pages.PageWeights({}).of("w:p")


def test_deep_pages_take_time_in_proportion():
    began = time.monotonic()
    assert pages.main_text("<div><i>x " * 100_000, pages.PageWeights({}, tag=-0.1)).startswith("x")
    pages.main_text("<b>y" * 50_000 + "</u>" * 50_000 + "<p>" * 50_000, pages.PageWeights({}))
    assert time.monotonic() - began < 30
