from __future__ import annotations

from countermill.llm import html_extract, license_scan
from countermill.llm.page_blocks import blocks
from tests.llm.data import SCHEMA, clashing_documents, edge_documents, edge_rows, no_documents, prose


def test_scan_by_brute_force(spark):
    import random

    rng = random.Random(7)
    lines = [t for texts in license_scan.TEMPLATES.values() for t in texts] + [*license_scan.PHRASES, prose(1, 20)]
    texts = []
    for _ in range(200):
        made = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(lines).split()
            made.append(" ".join(w for w in words if rng.random() > 0.1))
        texts.append(rng.choice("\n ").join(made))
    texts += ["MIT-License apache license2", "mit\nlicense", "mit", "license mit license mit license"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    for r in license_scan.scan(docs).collect():
        assert (r.n_base, r.base_labels, r.labels) == license_scan.brute_force(texts[r.doc_id])
        assert (r.first_word is None) == (r.n_base == 0) and 0 <= r.score <= 1


def test_scan_places(spark):
    docs = spark.createDataFrame([(1, "a b MIT License, c mit license", "en", "s", 0), (2, "x", "en", "s", 0)], SCHEMA)
    out = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.score) for r in license_scan.scan(docs).collect()}
    assert out == {1: (7, 2, 2, 5, 1.0), 2: (1, 0, None, None, 0.0)}


def test_scan_edges(spark):
    for docs in (edge_documents(spark), clashing_documents(spark)):
        out = license_scan.scan(docs).collect()
        assert len(out) == len(edge_rows()) and {r.labels for r in out} == {""}
    assert license_scan.scan(no_documents(spark)).count() == 0


def page(content: str, around: str = "") -> str:
    return f'<html><body><nav><ul><li><a href="/">Home</a></li></ul></nav>{around}<article>{content}</article><footer>&copy; x</footer></body></html>'


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars string")


def test_blocks_tolerate_markup():
    found = [b.text for b in blocks("<p>a &amp; <b>b\n  c<br><p>d</i><script>var t='</p>'</script>e<!-- x --> f<div>g</p>h")]
    assert found == ["a & b c", "d", "e f", "g", "h"] or found == ["a & b c", "de f", "g", "h"]
    assert blocks(None) == blocks("") == blocks("<p></p>") == []
    assert [b.text for b in blocks("<p>x < y and <b")] == ["x < y and <b"]


def test_main_text(spark):
    rows = []
    for i in range(60):
        body = "".join(f"<p>{line}</p>" for line in prose(i, 60).split("\n"))
        rows.append((i, f"http://e.org/{i}", page(f"<h1>Title {i}</h1>{body}<p>Ti.</p>", f'<div class="ad">{prose(i + 500, 15)}</div>'), "own", "o"))
    want = {i: f"Title {i}\n" + prose(i, 60) + "\nTi." for i in range(60)}
    rows += [(100, None, None, None, None), (101, "u", "", None, None), (101, "u", "", None, None), (None, "u", page("<p>Hello, there.</p>"), None, None)]
    rows.append((102, "u", page("<p>" + "</p><p>".join(prose(9, 20) for _ in range(400)) + "</p>"), None, None))
    out = html_extract.extract(pages(spark, rows))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    found = out.collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert {i: texts[i] for i in range(60)} == want
    assert texts[100] == texts[101] == "" and texts[None] == "Hello, there."
    assert texts[102].count("\n") == 399
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_extract.extract(pages(spark, [])).count() == 0


def test_other_layouts_are_learned():
    pages = [page("".join(f"<p>{x}</p>" for x in prose(i, 60).split("\n")), f'<div class="ad">{prose(i + 500, 15)}</div>') for i in range(60)]
    model = html_extract.ChainModel(html_extract.labelled_sequences(pages))
    text = model.main_text(
        '<div id="header">My site</div><ul class="menu"><li><a href="/">Home</a></li></ul><div class="content"><h1>Title here</h1>'
        '<p>This is a first paragraph, with words and an end.</p><div class="ad">Buy now, really.</div><p>Second one.</p></div>'
        '<aside><p>More to read, perhaps.</p></aside><form><label>Your name</label></form>'
    )
    assert text == "Title here\nThis is a first paragraph, with words and an end.\nSecond one."


def test_wrapped_licences_by_brute_force(spark):
    import random
    import textwrap

    rng = random.Random(11)
    named = [(label, t) for label, texts in license_scan.TEMPLATES.items() for t in texts]
    texts, whole = [], []
    for i in range(300):
        label, template = named[i % len(named)]
        words = [w for w in template.split() if i < 100 or rng.random() > 0.1]
        wrapped = textwrap.wrap(f"{prose(i, 6)} {' '.join(words)} {prose(i + 900, 6)}", rng.choice([20, 40, 70]))
        texts.append("\n".join(rng.choice(["", " * ", "# "]) + line for line in wrapped))
        whole.append(label if i < 100 else None)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    for r in license_scan.scan(docs).collect():
        assert (r.n_base, r.base_labels, r.labels) == license_scan.brute_force(texts[r.doc_id])
        if whole[r.doc_id]:
            assert whole[r.doc_id] in r.labels.split(",") and r.score == 1
