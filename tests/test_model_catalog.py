from __future__ import annotations

import pytest

from countermill.operators import model_catalog, models
from countermill.sources import model_trees, node_models
from tests.helpers import rows
from tests.test_catalog_models import PACK

OTHER = (
    '<EntityDef name="P2"><TECHPACK_NAME>P</TECHPACK_NAME><Components section="REPORTABLE_ENTITIES"><EntityDef name="COMMON">'
    '<Components section="REPORTABLE_ENTITIES_COLUMNS"><EntityDef name="c"/></Components></EntityDef><EntityDef name="E2">'
    "<MAPPED_MO>M</MAPPED_MO></EntityDef></Components></EntityDef>"
)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(1, PACK), (2, OTHER), (3, "<broken")], "id INT, value STRING")


@pytest.mark.parametrize("walk", ["windows", "python"])
def test_one_pass_gives_the_tables_of_eleven(spark, tmp_path, documents, walk):
    properties = model_trees.tree_rows(documents, "id").drop("doc") if walk == "windows" else node_models.model_rows(documents)
    counts = model_catalog.write_model_catalog(properties, str(tmp_path / "c"))
    found = model_catalog.read_model_catalog(spark, str(tmp_path / "c"))
    wanted = models.catalog_from_model(node_models.model_rows(documents))
    assert set(found) == set(wanted)
    for table, frame in wanted.items():
        assert rows(found[table].select(*frame.columns)) == rows(frame), table
        assert dict(found[table].dtypes) == dict(frame.dtypes) | {c: t for c, t in found[table].dtypes if c not in frame.columns}, table
        assert counts[table] == frame.count(), table


def test_writing_again_replaces(spark, tmp_path, documents):
    properties = model_trees.tree_rows(documents, "id").drop("doc")
    for _ in range(2):
        model_catalog.write_model_catalog(properties, str(tmp_path / "c"))
    assert model_catalog.read_model_catalog(spark, str(tmp_path / "c"))["reportable_entity"].count() == 3


def test_documents_are_read_once(documents):
    plan = model_catalog.tagged_rows(model_trees.tree_rows(documents, "id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
