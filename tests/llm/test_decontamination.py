from __future__ import annotations

from countermill.llm import decontamination
from tests.llm.data import SCHEMA, clashing_documents, edge_documents, edge_rows, no_documents, prose

ITEMS = "item_id bigint, text string"


def bench(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def found(frame):
    return sorted((r.doc_id, r.item_id, r.start) for r in frame.collect())


def test_items_are_found_where_they_stand(spark):
    item, long_item = prose(100, 20).replace("\n", " "), prose(101, 60).replace("\n", " ")
    words = item.split()
    changed = " ".join(words[:2] + ["other"] + words[3:])
    rows = [
        (1, f"{prose(1, 40)} {item} {prose(2, 40)}", "en", "s", 0),
        (2, f"{prose(3, 40)}\n{item.upper()}!", "en", "s", 0),
        (3, prose(4, 200), "en", "s", 0),
        (4, f"{long_item} {item}", "en", "s", 0),
        (5, " ".join(words[:8]) + " " + prose(6, 50), "en", "s", 0),
        (6, f"x y z {changed}", "en", "s", 0),
        (6, f"x y z {item}", "en", "s", 0),
    ]
    out = decontamination.contaminated(spark.createDataFrame(rows, SCHEMA), bench(spark, [(7, item), (8, long_item), (9, None), (10, "two words")]))
    assert found(out) == [(1, 7, 40), (2, 7, 40), (4, 7, 60), (4, 8, 0), (6, 7, 3)]  # the changed one has 13 of 19 shingles


def test_one_changed_word_of_a_long_item(spark):
    item = prose(200, 50).replace("\n", " ")
    words = item.split()
    near = " ".join(words[:20] + ["changed"] + words[21:])
    far = " ".join(w if i % 6 else "changed" for i, w in enumerate(words))
    rows = [(1, prose(1, 30) + " " + near, "en", "s", 0), (2, far, "en", "s", 0)]
    out = decontamination.contaminated(spark.createDataFrame(rows, SCHEMA), bench(spark, [(7, item)]))
    assert [(r.doc_id, r.start, 0.75 <= r.similarity < 1) for r in out.collect()] == [(1, 30, True)]


def test_edges(spark):
    items = bench(spark, [(1, prose(1)), (2, prose(2)), (None, prose(3, 40)), (1, prose(1))])
    out = decontamination.contaminated(edge_documents(spark), items)
    assert {(r.doc_id, r.item_id) for r in out.collect()} >= {(1, 1), (2, 1), (None, 2)}
    assert found(decontamination.contaminated(no_documents(spark), items)) == []
    assert found(decontamination.contaminated(edge_documents(spark), bench(spark, []))) == []


def test_decontaminate_keeps_other_columns(spark):
    docs = clashing_documents(spark)
    kept = decontamination.decontaminate(docs, bench(spark, [(1, prose(1))]))
    assert kept.columns == docs.columns
    gone = {1, 2, 3}
    want = sorted((r[0] for r in edge_rows() if r[0] not in gone), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want
    assert {r._key for r in kept.collect()} == {"k"}


def test_main_path_has_no_python(spark):
    rows = decontamination.contaminated(edge_documents(spark), bench(spark, [(1, prose(1))]))
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_near_copy_of_a_repeated_item(spark):
    words = prose(300, 50).split()
    near = " ".join(words[:25] + ["changed"] + words[26:])
    docs = spark.createDataFrame([(1, prose(1, 30) + " " + near, "en", "s", 0)], SCHEMA)
    items = [(i, " ".join(words)) for i in range(5)]
    out = decontamination.contaminated(docs, bench(spark, items))
    assert found(out) == [(1, i, 30) for i in range(5)]
    once = decontamination.contaminated(docs, bench(spark, items[:1])).collect()
    five = decontamination.contaminated(docs, bench(spark, items)).collect()
    assert {r.similarity for r in five} == {once[0].similarity} == {0.803922}  # 41 of 51 shingles
    assert decontamination.decontaminate(docs, bench(spark, items)).count() == 0


def test_near_copies_of_short_items(spark):
    items, rows = [], []
    for i in range(100):
        words = prose(1000 + i, 20).split()
        items.append((i, " ".join(words)))
        rows.append((i, prose(i, 20) + " " + " ".join([*words[:-2], "unmistakably", "different"]), "en", "s", 0))
    out = decontamination.contaminated(spark.createDataFrame(rows, SCHEMA), bench(spark, items))
    right = set(found(out))
    assert right <= {(i, i, 20) for i in range(100)}  # 14 of 18 shingles
    assert len(right) >= 95  # the radius is still a bound: 97, and 58 with that of long items
