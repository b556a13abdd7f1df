"""Rows, pages and labels that once got less than the whole job."""

from __future__ import annotations

import time

import messy
import pytest
from pyspark.sql import functions as F

from signalgrid.llm import html_text, langid, lines


def test_boilerplate_goes_whatever_its_share_of_a_text(spark):
    notice = "a notice longer than what stands beside it\nand a footer of the same kind"
    rows = [(i, f"{notice}\nown {i}", f"s{i}") for i in range(12)]
    rows += [(50, notice, "s50"), (51, notice, "s51"), (52, f"\n{notice}", "s52")]
    # A page on twelve sites spreads none of its own lines, and loses what is boilerplate.
    rows += [(100 + i, f"a page copied around\nas a whole\n{notice}", f"s{i}") for i in range(12)]
    rows += [(200, "as a whole\nbut quoted", "s200"), (201, None, None), (202, notice, None)]
    # Ten texts, each on the same two sites: two sites at most.
    rows += [(300 + 2 * i + j, f"shared by two\nand {i}", f"t{j}") for i in range(10) for j in range(2)]
    docs = spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, source string, lines_removed string")
    found = {row.doc_id: (row.text, row.lines_removed) for row in lines.drop_boilerplate(docs.repartition(5)).collect()}
    want = {i: (f"own {i}", 2) for i in range(12)} | {50: ("", 2), 51: ("", 2), 52: ("", 2), 202: ("", 2)}
    want |= {100 + i: ("a page copied around\nas a whole", 2) for i in range(12)}
    want |= {row[0]: (row[1], 0) for row in rows if row[0] >= 300}
    assert found == want | {200: ("as a whole\nbut quoted", 0), 201: (None, 0)}
    assert lines.drop_boilerplate(docs).columns == docs.columns
    assert lines.drop_boilerplate(messy.nothing(spark)).isEmpty()


@pytest.mark.parametrize("small", [0, 200_000])
def test_boilerplate_is_counted_exactly_around_the_threshold(spark, monkeypatch, small):
    monkeypatch.setattr(lines, "SMALL", small)
    rows = [(100 * n + i, f"on {n} sites\n{n} {i}", f"s{i // 3}") for n in range(1, 31) for i in range(3 * n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    found = {row.doc_id: row.lines_removed for row in lines.drop_boilerplate(docs).collect()}
    assert found == {doc: int(text.startswith("on") and int(text.split()[1]) >= 10) for doc, text, _ in rows}


BODY = "<p>" + "</p><p>".join(f"Paragraph {i} has words, and a second clause; it ends here." for i in range(6)) + "</p>"
TEXT = BODY.replace("</p><p>", "\n").removeprefix("<p>").removesuffix("</p>")


@pytest.mark.parametrize(
    "page",
    [
        f'<body class="has-sidebar">{BODY}</body>',
        f'<body class="sidebar">{BODY}</body>',
        f'<main class="content no-sidebar">{BODY}</main>',
        f'<article class="post comments-open">{BODY}</article>',
        f'<div class="widget">{BODY}</div><p>x</p>',
        f'<div class="widget"><article>{BODY}</article></div>',
        f'<form action="/"><div>{BODY}</div><select><option>a</select></form>',
        f"<form><main>{BODY}</main></form>",
        f'<main><form><div>{BODY}</div></form></main>',
        f'<div aria-hidden="false">{BODY}</div>',
        f'<div data-visibility="hidden" title="hidden gems" data-class="ad">{BODY}</div>',
        f'<article>{BODY}<p hidden>x</p><p aria-hidden="true">y</p><p style="display: none">z</p></article>',
        f'<article>{BODY}</article><div class="site-footer">f</div><div class="ad-slot-2 big">g</div>',
        f'<article>{BODY}</article><div class="comments"><article>{BODY}</article><article>{BODY}</article></div>',
    ],
)
def test_names_put_out_parts_of_a_page_and_not_the_page(page):
    assert html_text.main_text(page) in (TEXT, TEXT + "\nx")


@pytest.mark.parametrize(
    "junk",
    [
        f'<div class="comments">{BODY * 3}</div>',
        f'<section id="comment-list"><article>{BODY}</article><article>{BODY}</article></section>',
        f'<div class="cookie-notice">{BODY * 2}</div>',
        f'<p class=notice>{TEXT}</p>',
        f'<div class=copyright>{BODY * 2}</div>',
        f'<div class="google_ads_1">{BODY * 2}</div><ins class="adsbygoogle">{BODY}</ins>',
        f'<div class="newsletter"><div class="content">{BODY * 2}</div></div>',
    ],
)
def test_comments_and_notices_are_never_text_however_long(junk):
    assert html_text.main_text(f"<body><div class=story>{BODY}</div>{junk}</body>") == TEXT
    assert html_text.main_text(f"<body><article>{BODY}{junk}</article></body>") == TEXT
    assert html_text.main_text(f"<body>{junk}</body>") == ""


@pytest.mark.parametrize("piece", ["<b>", "<a ", '<a "', "<div></span>", "<i></i></u>", "<!", "<p><em>"])
def test_long_broken_pages_take_time_in_proportion(piece):
    page = f"<article>{BODY}" + piece * (300_000 // len(piece))
    begin = time.process_time()
    assert html_text.main_text(page).startswith(TEXT[:200])
    assert time.process_time() - begin < 6


LONG = "<p>" + "</p><p>".join(["A sentence, and more; so on: words. " * 11 + str(i) for i in range(3)]) + "</p>"
PLAIN = LONG.replace(" </p><p>", "\n").replace("</p><p>", "\n").removeprefix("<p>").removesuffix("</p>")
MENU = "<ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul>"
SOURCES = "<h2>Sources</h2><ul><li><a href=c>A source</a></li><li><a href=d>Another source</a></li></ul>"
LISTED = "Sources\nA source\nAnother source"


@pytest.mark.parametrize(
    "page, want",
    [
        (f"{MENU}<article>{LONG}{SOURCES}</article>{MENU}", f"{PLAIN}\n{LISTED}"),
        (f"{MENU}<div class=post>{LONG}{SOURCES}</div>{MENU}", f"{PLAIN}\n{LISTED}"),
        (f"<body>{MENU}{LONG}{SOURCES}<p>Then an end, with text.</p>{MENU}", f"{PLAIN}\n{LISTED}\nThen an end, with text."),
        (f"<body>{MENU}<h1>A headline of thirty letters xx</h1><div id=b>{LONG}</div>{MENU}", f"A headline of thirty letters xx\n{PLAIN}"),
        (f"<body>{MENU}<div><h1>A headline</h1><p>Lead</p></div><div id=b>{LONG}</div><div>End</div>{MENU}<p>c", f"A headline\nLead\n{PLAIN}\nEnd\nc"),
        (f"<div><div><h1>A headline</h1></div></div><section><div id=b>{LONG}</div></section>", f"A headline\n{PLAIN}"),
        (f"<p>x</p><nav>m</nav><article>{LONG}</article>", PLAIN),
    ],
)
def test_blocks_of_the_article_and_at_its_border_stay(page, want):
    assert html_text.main_text(page) == want


def test_labels_of_few_texts_in_many_copies_are_learned(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(langid, "train", lambda windows, target, labels: seen.update(windows=len(windows), labels=labels))
    by = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    words = spark.range(4000).select(F.format_string("oui eau %d", "id").alias("text"))
    # Texts that a rate by rows would leave out, one that it would take, in copies.
    few = words.where(by > (1 << 29)).limit(3).withColumn("lang", F.lit("few"))
    one = words.where(by < (1 << 24)).limit(1).withColumn("lang", F.lit("one"))
    copies = few.union(one).crossJoin(spark.range(4000).select()).repartition(8)
    copies = copies.union(words.limit(20).withColumn("lang", F.lit("one")))
    langid.fit(copies)
    assert seen["labels"] == ["few", "one"]
    distinct = copies.distinct().count()
    assert 23 <= distinct == seen["windows"]
