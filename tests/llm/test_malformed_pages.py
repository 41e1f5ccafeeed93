from __future__ import annotations

import random
import time

import pytest

from countermill.llm import html_extract, language_id
from countermill.llm.page_blocks import blocks
from tests.llm.data import prose

SIZE = 1 << 20
UNITS = ["<a ", "<script>", '"', "<div>", "<a '\"", '<a "x" ', "<!x", "</b>", '<a href="', "<a b='<\"", "<!--", "<"]


def seconds(text: str) -> float:
    start = time.process_time()
    blocks(text)
    return time.process_time() - start


@pytest.mark.parametrize("unit", UNITS)
def test_time_is_linear_in_markup_without_end(unit):
    assert seconds(unit * (SIZE // len(unit))) < 10


def test_time_is_linear_in_mixed_markup():
    rng = random.Random(2)
    bits = ["<a ", '"', "'", "<", "=", "x", "<b y='", "<!"]
    half, whole = ("".join(rng.choice(bits) for _ in range(n)) for n in (200_000, 400_000))
    assert seconds(whole) < 4 * seconds(half) + 2


def test_what_a_block_knows_of_its_ancestors():
    page = '<div class="outer"><section id="in-ner"><p>one <a href="x">two</a><p>three</section>four</div>five<li>a<li data-keep=1>b'
    found = [(b.text, sorted(b.tags), b.inner, sorted(b.names), sorted(b.near), b.linked, b.label) for b in blocks(page)]
    assert found == [
        ("one two", ["div", "p", "section"], "p", ["in", "ner", "outer"], ["in", "ner"], 3, 0),
        ("three", ["div", "p", "section"], "p", ["in", "ner", "outer"], ["in", "ner"], 0, 0),
        ("four", ["div"], "div", ["outer"], ["outer"], 0, 0),
        ("five", [], "", [], [], 0, 0),
        ("a", ["li"], "li", [], [], 0, 0),
        ("b", ["li"], "li", [], [], 0, 1),
    ]


def test_a_tag_without_end_is_text():
    assert [b.text for b in blocks("<p>1 < 2 and <b x='y")] == ["1 < 2 and <b x='y"]
    assert [b.text for b in blocks("<p>a<b title=\"<>\">c</b> <i <p>d</p>")] == ["ac d"]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, language string, host int")


def page_rows():
    rows = [(i, f"http://h{i % 3}.site.org/{i}", f'<html lang="en"><p>{prose(i)}</p></html>', "own", "mine", i) for i in range(30)]
    hard = [u * (SIZE // 8 // len(u)) for u in ("<script>", "<a ", "<html ", "<style ")]
    rows += [(100 + i, "http://h1.site.org/x", text, "own", "mine", i) for i, text in enumerate(hard)]
    return rows + [(1, rows[1][1], rows[1][2], "own", None, 1), (None, None, None, None, None, None), (200, "nowhere", "", "", "", 0)]


def test_pages_keep_their_columns_and_hard_ones_end(spark):
    frame = pages(spark, page_rows())
    start = time.time()
    out = language_id.identify_pages(frame)
    assert out.columns == ["page_id", "url", "html", "text", "host", "language", "confidence", "kept"]
    found = out.collect()
    assert time.time() - start < 120
    assert len(found) == len(page_rows())
    assert {r.text for r in found if r.page_id is not None and r.page_id < 200} == {"own"}
    kept = {r.page_id for r in found if r.kept}
    assert set(range(30)) <= kept
    assert language_id.identify_pages(frame.limit(0)).count() == 0


def test_extraction_of_hard_pages_ends(spark):
    start = time.time()
    out = html_extract.extract(pages(spark, page_rows()).drop("text", "language", "host"))
    assert out.count() == len(page_rows())
    assert time.time() - start < 120
