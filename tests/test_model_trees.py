from __future__ import annotations

import pytest

from countermill.sources import model_trees, node_models
from tests.helpers import rows

DEEP = "".join(f'<EntityDef name="n{i}"><Components section="s{i}">' for i in range(6)) + '<EntityRef name="end" a="1"/>'
GOOD = [
    '<?xml version="1.0"?><!DOCTYPE x><EntityDef name="m1"><A>1 &amp;amp; 2</A><!-- c <x> --><B><![CDATA[a<b & c]]></B><C/><D></D>'
    '<Components section="S"><EntityDef name="e1"><P>x</P><P>y</P></EntityDef><EntityRef name="r1" a="1" b=\'2 > 1\'/>'
    '<EntityDef name="e2"><Components section="T"><EntityDef name="f1"/><EntityRef name="q"></EntityRef></Components></EntityDef>'
    "</Components><Z>tail &#233;&#x4F60; t<!--x-->u</Z></EntityDef>",
    '<EntityDef name="m2"><A>1</A>\n <Components section="S">\n</Components></EntityDef>\n',
    '<EntityDef name="m3"/>',
    '<EntityDef name="m4"><Prop>v<Sub name="s"><X>1</X></Sub>w</Prop><Components section="S"><EntityRef name="r" k="v">'
    '<Ignored>1</Ignored><Components section="U"><EntityDef name="deep"><V>9</V></EntityDef></Components></EntityRef></Components>'
    '<Components section="S2"><EntityDef name="a1"/></Components></EntityDef>',
    '<EntityDef name="m5"><Components section="S"><EntityRef name="&quot;x&quot;" a="&lt;&#65;"/><EntityRef name="twice" a="1"/>'
    '<EntityRef name="twice" a="2"/></Components><T>line\nbreak</T></EntityDef>',
    DEEP + "</Components></EntityDef>" * 6,
    '<EntityDef name="long">' + "".join(f"<P{i}>{'x' * (i % 50)}</P{i}>" for i in range(3000)) + "</EntityDef>",
]
BAD = ['<EntityDef name="bad"><A>1</EntityDef>', "", "<a><b></a></b>", None, "text", "<a/><b/>", "<a>1 < 2</a>", "<a/>tail", "</a>"]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(list(enumerate([*GOOD, *BAD])), "id INT, value STRING")


def test_rows_equal_those_of_a_walk_by_document(documents):
    assert rows(model_trees.tree_rows(documents, "id").drop("doc")) == rows(node_models.model_rows(documents))


def test_malformed_documents_are_told(documents):
    found = model_trees.faulty_trees(documents, "id")
    assert sorted(r.doc for r in found.collect()) == list(range(len(GOOD), len(GOOD) + len(BAD)))
    assert node_models.unreadable_models(documents).count() == len(BAD)


def test_tokens_are_shuffled_and_sorted_once_without_python(documents):
    plan = model_trees.tree_rows(documents, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1
    assert "InPandas" not in plan and "Python" not in plan


def test_files_and_no_documents(spark, tmp_path):
    for i, text in enumerate(GOOD[:3]):
        (tmp_path / f"{i}.xml").write_text(text)
    found = model_trees.scan_tree_rows(spark, str(tmp_path))
    assert found.select("doc").distinct().count() == 3
    assert rows(found.drop("doc")) == rows(node_models.scan_model_rows(spark, str(tmp_path)))
    assert model_trees.tree_rows(spark.createDataFrame([], "id INT, value STRING"), "id").count() == 0


def test_one_token_for_a_leaf_and_markup_dealt_by_documents(spark):
    markup = """<a><b x="1>">t &lt;</b>\n<c/> mixed <d ></d ><ab>1</ab><a>2</a></a>"""
    tokens = model_trees.tree_tokens(spark.createDataFrame([(1, markup)], "id INT, value STRING"), "id")
    found = [(r.kind, r.tag, r.inner, r.behind, r.running) for r in tokens.orderBy("pos").collect()]
    assert found == [
        ("open", "a", "", None, 1), ("single", "b", "t &lt;", "\n", 1), ("single", "c", None, " mixed ", 1), ("single", "d", "", "", 1),
        ("single", "ab", "1", "", 1), ("single", "a", "2", "", 1), ("close", "a", None, "", 0),
    ]
    # As many tasks as there are cores, however small the markup is before it is cut up.
    assert tokens.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_close_tags_that_only_begin_like_the_start(spark):
    bad = spark.createDataFrame([(1, "<ab>x</a>"), (2, "<a>x</ab>"), (3, "<a/>x"), (4, "x<a/>"), (5, "<a>1</a>x")], "id INT, value STRING")
    assert sorted(r.doc for r in model_trees.faulty_trees(bad, "id").collect()) == [1, 2, 3, 4, 5]


def test_depth_is_not_looked_up_beforehand(spark, documents):
    spark.sparkContext.setJobGroup("plan of trees", "no job before the result is read")
    try:
        found = model_trees.tree_rows(documents, "id")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan of trees")
        assert found.count() > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_long_and_deep_documents(spark):
    order = '<EntityDef name="o%d"><S>a &lt; b</S><!-- x --><Components section="L"><EntityRef name="r" a="%d"/></Components></EntityDef>'
    long = '<EntityDef name="m"><Components section="O">' + "".join(order % (i, i) for i in range(700)) + "</Components><Z/></EntityDef>"
    deep = "".join(f'<EntityDef name="n{i}"><P>{i}</P><Components section="s{i}">' for i in range(40)) + "</Components></EntityDef>" * 40
    odd = [
        '<EntityRef name="x" a="1"><Components section="S"><EntityDef name="y"/></Components></EntityRef>',
        '<EntityDef><Components><EntityDef name="u"><Q a="&gt;">1<R/>2</Q></EntityDef><EntityRef b = "1"\n c=\'&amp;lt;\'/></Components></EntityDef>',
        '<EntityDef name="z"><Components section="S"/><P><![CDATA[</P>]]>x<?i > ?></P><Components section="T"><Other/></Components></EntityDef>',
    ]
    documents = spark.createDataFrame(list(enumerate([long, deep])), "id INT, value STRING")
    assert rows(model_trees.tree_rows(documents, "id").drop("doc")) == rows(node_models.model_rows(documents))
    # Paths of entities and sections without a name hold an empty one here.
    documents = spark.createDataFrame(list(enumerate(odd)), "id INT, value STRING")
    without = ["path", "parent_path", "section"]
    found, walked = model_trees.tree_rows(documents, "id").drop("doc"), node_models.model_rows(documents)
    assert rows(found.drop(*without)) == rows(walked.drop(*without))
    paths = {r.path for r in found.collect()}
    assert paths == {"x", "x/S:y", "", "/:u", "/:", "z", "z/T:"}


def test_documents_with_one_key_are_read_token_by_token(spark):
    twice = [(1, '<a name="x"><P>1</P></a>')] * 2 + [(None, '<a name="y"><P>2</P></a>'), (2, "<a/>"), (2, None)]
    found = model_trees.tree_rows(spark.createDataFrame(twice, "id INT, value STRING"), "id")
    assert rows(found) == rows(
        spark.createDataFrame(
            [(1, "x", "x", None, None, "x", 0, 0, "a", ""), (None, "y", "y", None, None, "y", 0, 0, "P", "2")], found.schema
        )
    )
