from __future__ import annotations

import json

import pytest

from countermill.operators import kpi
from countermill.sources.kpi_definitions import scan_kpi_definitions
from tests.helpers import rows


def cells(spark):
    return spark.createDataFrame(
        [("n1", 4, 2, 0), ("n1", 2, None, 0), ("n2", None, 3, 1), ("n3", 0, 0, 0)], "node STRING, a BIGINT, b BIGINT, c BIGINT"
    )


@pytest.mark.parametrize(
    ("expression", "expected"),
    [
        ("pm://T.a + pm://T.b * 2", [("n1", 10.0), ("n2", None), ("n3", 0.0)]),
        ("(pm://T.a + pm://T.b) * 2", [("n1", 16.0), ("n2", None), ("n3", 0.0)]),
        ("100*(pm://T.a-pm://T.b)/(pm://T.a+pm://T.b)", [("n1", 50.0), ("n2", None), ("n3", None)]),
        ("1.5 - -pm://T.c", [("n1", 1.5), ("n2", 2.5), ("n3", 1.5)]),
        ("pm://T.b / pm://T.c / 2", [("n1", None), ("n2", 1.5), ("n3", None)]),
        ("pm://T.a - pm://T.a", [("n1", 0.0), ("n2", None), ("n3", 0.0)]),
    ],
)
def test_arithmetic_of_sums(spark, expression, expected):
    found = kpi.kpi_table({"T": cells(spark)}, [kpi.parse_formula("k", expression, ["node"])])
    assert rows(found) == expected


@pytest.mark.parametrize(
    "expression",
    ["pm://T.a **  2", "pm://T.a +", "f(pm://T.a)", "pm://T.a if 1 else 2", "2 * 3", "pm://T.a + 'x'", "_7 + pm://T.a", "x + pm://T.a", "",
     "__import__('os')", "pm://T.a // 2", "True + pm://T.a"],
)
def test_anything_else_is_refused(spark, expression):
    with pytest.raises(ValueError, match="k: "):
        kpi.parse_formula("k", expression, ["node"])


def test_definitions_of_documents_may_mix_forms(spark, tmp_path):
    listed = [
        {"name": "ratio", "expression": "pm://T.a / pm://T.b", "aggregation_type": "SUM", "aggregation_period": 60, "aggregation_elements": ["node"]},
        {"name": "sum", "expression": "pm://T.a", "aggregation_type": "SUM", "aggregation_period": 60, "aggregation_elements": ["node"]},
        {"name": "share", "expression": "pm://T.a/(pm://T.a + pm://U.d)", "aggregation_type": "SUM", "aggregation_period": 60, "aggregation_elements": ["node"]},
    ]
    (tmp_path / "k.json").write_text(json.dumps({"source": "s", "kpi_definitions": listed}))
    definitions = scan_kpi_definitions(spark, str(tmp_path / "k.json"))
    parsed = kpi.read_kpis(definitions)
    assert sorted(type(k).__name__ for k in parsed) == ["Formula", "Kpi", "Kpi"]
    other = spark.createDataFrame([("n1", 2), ("n1", 4), ("n3", 5)], "node STRING, d BIGINT")
    table = kpi.kpi_table({"T": cells(spark), "U": other}, parsed)
    assert rows(table.select("node", "ratio", "sum", "share")) == [
        ("n1", 3.0, 6.0, 0.5), ("n2", None, None, None), ("n3", None, 0.0, 0.0)
    ]
    with pytest.raises(ValueError, match="more than 2"):
        kpi.read_kpis(definitions, most=2)
