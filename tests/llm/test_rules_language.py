from __future__ import annotations

from pyspark.sql import functions as F

from countermill.llm import language_id, quality_rules
from tests.llm.data import SCHEMA, clashing_documents, edge_documents, edge_rows, no_documents, prose


def test_base_figures(spark):
    texts = ["a b c a b c", "x\ny\nx\n \nx", "#a $b <c>", " \t", None, "one"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    out = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    figures = {i: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for i, r in out.items()}
    assert figures == {
        0: (6, 6, 0, 0, 6),
        1: (4, 4, 0, 2, 0),
        2: (3, 7, 4, 0, 0),
        3: (0, 0, 0, 0, 0),
        4: (0, 0, 0, 0, 0),
        5: (1, 3, 0, 0, 0),
    }
    assert not any(r.kept for r in out.values())


def test_repeated_windows_by_brute_force(spark):
    import random

    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    for r in quality_rules.judge(docs).collect():
        words = texts[r.doc_id].split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        assert r.n_repeat_words == len(covered)


def test_failing_lines_go_and_too_much_loss_rejects(spark):
    good = prose(1, 100)
    menu = "Home | News | Sport | Weather"
    cookie = "Please accept all cookies to read on and on."
    rows = [
        (1, f"{menu}\n{good}\n{cookie}\nno end", "en", "s", 0),
        (2, "\n".join(["a b c d e f g h | i | j | k"] * 1 + [f"w{i} x{i} y{i} | z{i} | q | r" for i in range(20)]), "en", "s", 0),
        (3, good, "en", "s", 0),
        (4, "\n".join(f"W{i}!! X{i}!! Y{i}!! Z{i}!!" for i in range(20)), "en", "s", 0),
        (5, "\n".join(f"w{i}### x{i}$$$ y{i}" for i in range(30)), "en", "s", 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r.doc_id: r.text for r in quality_rules.clean(docs).collect()}
    assert kept == {1: good, 3: good}
    verdicts = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.judge(docs).collect()}
    assert verdicts[2] == verdicts[4] == verdicts[5] == (False, False)


def test_rules_edges(spark):
    out = quality_rules.judge(edge_documents(spark))
    assert out.count() == len(edge_rows())
    assert quality_rules.judge(no_documents(spark)).count() == 0
    kept = quality_rules.clean(clashing_documents(spark))
    assert kept.columns == clashing_documents(spark).columns
    assert {(r.language, r.kept) for r in kept.collect()} == {("own", False)}
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_a_filter_on_the_verdict_stays_above_it(spark):
    judged = quality_rules.judge(edge_documents(spark)).where("kept").select("text")
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter (isnotnull(kept") < plan.index("Generate")


WORDS = {
    "en": "the that with from this have which there their would about these other",
    "de": "der die und nicht auch sich nach eine einer wird noch über für",
    "fr": "les des une pour dans avec être cette mais nous vous après où",
}


def languages(spark, extra=()):
    import random

    rng = random.Random(5)
    rows = []
    for i in range(120):
        lang = ("en", "de", "fr")[i % 3]
        text = " ".join(rng.choice(WORDS[lang].split()) for _ in range(30))
        rows.append((i, text, lang, f"{lang}.example.org", 0))
    return spark.createDataFrame(rows + list(extra), SCHEMA)


def test_evidence_is_fused(spark):
    extra = [
        (500, " ".join(WORDS["de"].split() * 3), "en", "de.example.org", 0),
        (501, "xq", "fr", "fr.example.org", 0),
        (502, "xq", None, "de.example.org", 0),
        (503, "12 34", "fr", "fr.example.org", 0),
        (504, None, "fr", "fr.example.org", 0),
    ]
    out = {r.doc_id: r for r in language_id.identify_documents(languages(spark, extra)).collect()}
    assert all(out[i].language == ("en", "de", "fr")[i % 3] and out[i].kept for i in range(120))
    assert out[500].language == "de"  # text against declaration
    assert out[501].language == "fr" and out[502].language == "de"  # declaration and host where the text is silent
    assert (out[503].language, out[503].kept) == (out[504].language, out[504].kept) == ("und", False)


def test_pages_by_markup_suffix_and_host(spark):
    rows = [
        (i, f"http://www.{lang}.example.{lang}/x", f'<html lang="{lang}"><script>var der="die"</script><p>{WORDS[lang] * 2}</p>')
        for i, lang in enumerate(["en", "de", "fr"] * 10)
    ] + [(99, None, None), (100, "nonsense", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = {r.page_id: (r.language, r.kept) for r in language_id.identify_pages(pages).collect()}
    assert all(out[i] == (["en", "de", "fr"][i % 3], True) for i in range(30))
    assert out[99] == out[100] == ("und", False)


def test_language_edges(spark):
    out = language_id.identify_documents(edge_documents(spark))
    assert out.count() == len(edge_rows())
    assert language_id.identify_documents(no_documents(spark)).count() == 0
    kept = language_id.keep_identified(clashing_documents(spark))
    assert kept.columns == clashing_documents(spark).columns
    assert {(r.language, r.kept) for r in kept.collect()} == {("own", False)}
    nothing = edge_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.language for r in language_id.identify_documents(nothing).collect()} == {"und"}


def test_rare_and_many_languages_are_modelled(spark):
    import random

    rng = random.Random(6)
    rows = []
    for k in range(150):  # each language has words and rows of its own, more languages than a block
        words = ["".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(6)) for _ in range(12)]
        rows += [(8 * k + i, " ".join(rng.choice(words) for _ in range(60)), f"l{k:03}", f"h{k}.org", 0) for i in range(8)]
    common = [(10_000 + i, " ".join(rng.choice(WORDS["en"].split()) for _ in range(20)), "en", "en.org", 0) for i in range(9000)]
    docs = spark.createDataFrame(rows + common, SCHEMA).repartition(4)
    out = {r.doc_id: (r.language, r.kept) for r in language_id.identify_documents(docs).collect()}
    assert len(out) == len(rows) + len(common)
    assert all(out[r[0]] == (r[2], True) for r in rows + common)
