"""Plan shape: no nested loops, no Python, filters at the scan, pre-aggregation before each shuffle."""

import os
import re

import pyarrow.parquet as pq
import pytest

from terroir import catalog
from terroir.plans import controls
from terroir.plans.measures import Modele, ventes
from terroir.params import Contexte
from terroir.plans.warehouse import Warehouse, warehouse

SKIP = {"chargement_brut", "publication"}  # small audit rows built by the driver


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SKIP))
def test_no_nested_loop_and_no_python(name, spark, sf):
    text = plan(catalog.queries()[name](spark, sf))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def test_year_filter_reaches_the_scan(spark, sf):
    m = Modele.of(warehouse(spark, sf))
    text = plan(ventes(m, Contexte(annees=(2025,))).select("prix"))
    assert "GreaterThanOrEqual(date_vente,2025-01-01)" in text
    scan = text[text.index("ReadSchema"):]
    assert "id_mutation" not in scan and "prix" in scan
    assert re.search(r"PartitionFilters: \[[^\]]*annee_partition#\d+ = 2025", text)


def test_sales_take_one_preaggregated_shuffle(spark, sf):
    text = plan(warehouse(spark, sf).plan("int_ventes_logement"))
    body = text.split("Initial Plan")[0]
    assert body.count("Exchange hashpartitioning") == 1
    assert "partial_min" in body
    assert "Join" not in body


def test_all_checks_take_one_scan_of_each_table(spark, sf):
    w = warehouse(spark, sf)
    df = controls.tous(w)
    text = plan(df)
    # The departments are a seed, without a file.
    assert text.count("FileScan") == len(controls.NON_NULS) - 1
    assert text.count("Exchange") <= 3


def test_a_commune_slicer_skips_row_groups(spark, tmp_path):
    """Of facts with one commune of a third of all rows, a slicer on another one reads less than a tenth."""
    rows = spark.range(60_000).selectExpr(
        "concat('V', id) as id_mutation",
        "date_add(date'2021-01-01', int(id * 7919 % 1826)) as date_vente",
        "if(id % 3 = 0, '59001', lpad(string(id * 31 % 400), 5, '0')) as code_commune",
        "if(id % 2 = 0, 'Maison', 'Appartement') as type_logement",
        "double(id) as prix",
    ).repartition(8)
    path = str(tmp_path / "facts")
    Warehouse(spark, {}, str(tmp_path), rows_per_file=500).write(rows, "fct_ventes", path)
    groups = []
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                meta = pq.ParquetFile(os.path.join(folder, name)).metadata
                at = meta.schema.names.index("code_commune")
                stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
                groups += [(s.min, s.max, meta.num_rows) for s in stats]
    read = sum(n for low, high, n in groups if low <= "00123" <= high)
    assert len(groups) > 100 and sum(n for *_, n in groups) == 60_000
    assert read < 0.1 * 60_000
    assert max(n for *_, n in groups) <= 500  # the large commune too


def test_slicers_reach_the_statistics(spark, sf):
    m = Modele.of(warehouse(spark, sf))
    text = plan(ventes(m, Contexte(types=("Maison",), communes=("59001",))).select("prix"))
    pushed = text[text.index("PushedFilters"):]
    assert "EqualTo(type_conforme,maison)" in pushed and "code_commune#" in text[text.index("DataFilters"):text.index("PushedFilters")]
