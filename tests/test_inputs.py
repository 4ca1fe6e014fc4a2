"""Queries over small tables of the test's own: what they build of the raw sources, and how."""

import datetime as dt
import pathlib
import shutil

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from terroir import catalog
from terroir.plans import warehouse as W
from terroir.sources import adapters
from terroir.sources import landing as L


@pytest.fixture(scope="module")
def own(spark, tmp_path_factory):
    """Two hundred sales with two lines each, and three hundred diagnostics."""
    root = tmp_path_factory.mktemp("own")
    i = F.col("id")
    orders = spark.range(1, 201).select(
        i.alias("o_orderkey"), (i % 40 + 1).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        (i * 1000.5).alias("o_totalprice"),
        F.expr("timestamp'1995-01-01 00:00:00' + make_interval(0, 0, 0, cast(id * 9 as int))").alias("o_orderdate"),
        F.lit("3-MEDIUM").alias("o_orderpriority"),
    )
    lines = spark.range(1, 401).select(
        F.ceil(i / 2).alias("l_orderkey"), (i % 30 + 1).alias("l_partkey"), (i % 7 + 1).alias("l_suppkey"),
        (i % 2 + 1).cast("int").alias("l_linenumber"), (i % 40 + 5).cast("double").alias("l_quantity"),
        F.when(i % 4 == 0, "R").otherwise("N").alias("l_returnflag"),
    )
    customer = spark.range(1, 41).select(i.alias("c_custkey"), (i % 25).cast("int").alias("c_nationkey"))
    kinds = F.array(*[F.lit(k) for k in ("STANDARD", "MEDIUM", "ECONOMY", "SMALL")])
    part = spark.range(1, 31).select(
        i.alias("p_partkey"), F.get(kinds, (i % 4).cast("int")).alias("p_type"), (i % 50).cast("int").alias("p_size")
    )
    events = spark.range(1, 301).select(
        i.alias("event_id"), (i % 90 + 1).alias("user_id"), F.lit("view").alias("event_type"),
        (i % 97 * 1.5).alias("value"), F.concat(F.lit('{"k": '), (i % 100).cast("string"), F.lit("}")).alias("props"),
    )
    for name, df in {"orders": orders, "lineitem": lines, "customer": customer, "part": part, "events": events}.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_the_calendar_holds_what_its_days_had(spark, own):
    q = catalog.queries()
    rows = q["dim_date"](spark, own).collect()
    assert len(rows) == 2191 and {r.date for r in rows} >= {dt.date(2021, 1, 1), dt.date(2026, 12, 31)}
    assert sum(r.nb_ventes or 0 for r in rows) == q["fct_ventes"](spark, own).count() > 0
    assert sum(r.nb_dpe or 0 for r in rows) == q["fct_dpe_mensuel"](spark, own).agg(F.sum("nb_dpe")).first()[0] > 0


@pytest.fixture
def fresh(monkeypatch):
    """No warehouse of this application is open."""
    monkeypatch.setattr(W, "_OPEN", {})


def test_a_query_derives_only_the_sources_it_reads(spark, own, fresh):
    q = catalog.queries()
    opened = W.warehouse(spark, own)
    root = pathlib.Path(opened.root).parent / "raw"
    shutil.rmtree(root, ignore_errors=True)
    assert q["fct_dpe_mensuel"](spark, own).count() > 0
    assert [p.name for p in root.iterdir()] == ["dpe_logements"]
    assert q["chargement_brut_dpe"](spark, own).count() == 303
    assert [p.name for p in pathlib.Path(opened.files("dpe_logements")).iterdir()] == ["dpe"]
    # A later query adds the sources it reads, and what is there stays as it is.
    loaded = {r.nom_table: r.nb_lignes for r in q["chargement_brut"](spark, own).collect()}
    assert {p.name for p in pathlib.Path(opened.files()).iterdir()} == {"dpe", "dvf", "insee"}
    assert loaded == {n: opened.table(n).count() for n in opened.raw}
    assert loaded["dvf_mutations"] == 500 and loaded["dpe_logements"] == 303 and opened.table("dpe_logements").inputFiles()


def test_sales_are_written_by_year_without_a_sort(spark, own, fresh, tmp_path, monkeypatch):
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = DataFrameWriter.csv
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, *a: (seen.append(int(spark.conf.get(key))), write(self, *a))[1])
    before, raw = spark.conf.get(key), W.warehouse(spark, own).table("dvf_mutations")
    adapters.write_files({"dvf_mutations": raw}, str(tmp_path))
    years = sorted(p.name for p in (tmp_path / "dvf").iterdir() if p.is_dir())
    assert years == [f"annee={y}" for y in range(2021, 2026)]
    assert seen and min(seen) > len(years) and spark.conf.get(key) == before
    read = L.read_dvf(spark, str(tmp_path))
    assert read.filter(F.col("_annee_fichier") != F.substring("date_mutation", 1, 4)).isEmpty()
    columns = [c for c in raw.columns if c != "_loaded_at"]
    want = raw.select(*[F.nullif(c, F.lit("")).alias(c) for c in columns])
    assert read.count() == 500 and want.exceptAll(read.select(columns)).isEmpty()


def test_lines_are_shuffled_for_their_joins_only(spark, own):
    own_session = spark.newSession()
    own_session.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    sales = adapters.dvf_raw(own_session, own)._jdf.queryExecution().executedPlan().toString()
    diagnostics = adapters.dpe_raw(own_session, own)._jdf.queryExecution().executedPlan().toString()
    # Both sides of three joins; before, lines went through four exchanges and one by round robin.
    assert sales.count("Exchange hashpartitioning") == 6 and sales.count("Exchange") == 6
    assert "Exchange" not in diagnostics
