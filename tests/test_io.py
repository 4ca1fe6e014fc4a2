"""Landing readers, publication and incremental runs on files written to a temporary folder."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from terroir.plans.warehouse import Warehouse, warehouse
from terroir.sinks import publish as K
from terroir.sinks import versions as V
from terroir.sources import landing as L


def gz(path, *members):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"".join(gzip.compress(m.encode()) for m in members))


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    gz(tmp_path / "dvf/2021/02.csv.gz", "id_mutation,code_commune,type_local\n1,02001,Maison\n2,02002,\"\"\n")
    gz(tmp_path / "dvf/2022/59.csv.gz", 'type_local,extra,id_mutation,code_commune\n"Local ""A"", bis",e,3,59001\n')
    gz(tmp_path / "dvf/2022/60.csv.gz", "id_mutation,code_commune,type_local\n4,,Maison\n")
    rows = {r.id_mutation: r for r in L.read_dvf(spark, str(tmp_path)).collect()}
    assert {k: (r.code_commune, r.type_local, r.extra, r._annee_fichier) for k, r in rows.items()} == {
        "1": ("02001", "Maison", None, "2021"),
        "2": ("02002", None, None, "2021"),
        "3": ("59001", 'Local "A", bis', "e", "2022"),
        "4": (None, "Maison", None, "2022"),
    }
    assert rows["3"].filename.endswith("dvf/2022/59.csv.gz")


def test_json_numbers_become_text_and_members_are_read_on(spark, tmp_path):
    one = json.dumps({"numero_dpe": "A", "surface_habitable_logement": 12.0, "inconnu": {"x": 1}}) + "\n"
    two = json.dumps({"numero_dpe": "B", "code_insee_ban": "02001"}) + "\n"
    gz(tmp_path / "dpe/02.ndjson.gz", one, two)
    rows = {r.numero_dpe: r for r in L.read_dpe(spark, str(tmp_path)).collect()}
    assert rows["A"].surface_habitable_logement == "12.0"
    assert rows["B"].code_insee_ban == "02001"


def test_absent_sources_are_skipped_unless_all_are(spark, tmp_path):
    with pytest.raises(L.AucuneSource):
        L.read_raw(spark, str(tmp_path))
    gz(tmp_path / "dpe/02.ndjson.gz", '{"numero_dpe": "A", "code_departement_ban": "02"}\n')
    raw = L.read_raw(spark, str(tmp_path))
    assert list(raw) == ["dpe_logements"]
    assert L.read_raw(spark, str(tmp_path), ["59"])["dpe_logements"].count() == 0
    assert L.read_raw(spark, str(tmp_path), ["02", "59"])["dpe_logements"].count() == 1
    out = str(tmp_path / "raw")
    assert L.land(raw, out) == {"dpe_logements": 1}
    assert L.land(raw, out) == {"dpe_logements": 1}
    assert L.read_landed(spark, out, "dpe_logements").count() == 1


def test_publication_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "pub")
    good = spark.createDataFrame([(1, "a")], "id int, t string")
    assert K.publish({"x": good, "y": good}, root) == {"x": 1, "y": 1}
    broken = good.withColumn("id", F.expr("cast(raise_error('panne') as int)"))
    with pytest.raises(Exception, match="panne"):
        K.publish({"x": good.unionByName(good), "y": broken}, root)
    assert K.read_published(spark, root, "x").count() == 1
    assert K.publish({"x": good.unionByName(good), "y": broken}, root, only=["x"]) == {"x": 2}
    assert K.read_published(spark, root, "x").count() == 2
    with pytest.raises(KeyError):
        K.publish({"x": good}, root, only=["z"])


def test_unsupported_types_are_refused(spark):
    with pytest.raises(TypeError, match="tags"):
        K.check_types(spark.range(1).withColumn("tags", F.array(F.lit(1))))


def test_line_breaks_in_quotes_and_file_counts(spark, tmp_path):
    gz(tmp_path / "dvf/2021/02.csv.gz", 'id_mutation,nom\n1,"a\nb"\n2,"c, ""d"""\n')
    gz(tmp_path / "dvf/2021/59.csv.gz", "id_mutation,nom\n3,e\n")
    df = L.read_dvf(spark, str(tmp_path))
    assert {r.id_mutation: r.nom for r in df.collect()} == {"1": "a\nb", "2": 'c, "d"', "3": "e"}
    assert L.files_read({"dvf_mutations": df}) == {"dvf_mutations": 2}


def test_a_failed_refresh_leaves_the_old_tables(spark, tmp_path):
    out = str(tmp_path / "raw")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    broken = good.withColumn("id", F.expr("cast(raise_error('panne') as int)"))
    assert L.land({"x": good, "y": good}, out) == {"x": 2, "y": 2}
    with pytest.raises(Exception, match="panne"):
        L.land({"x": good.limit(1), "y": broken}, out)
    assert [L.read_landed(spark, out, t).count() for t in "xy"] == [2, 2]
    assert L.land({"x": good.limit(1)}, out) == {"x": 1}
    assert L.read_landed(spark, out, "x").count() == 1


def test_a_refresh_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """At every moment of a refresh, a crash included, readers find the old table or the new one."""
    out = str(tmp_path / "raw")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    L.land({"x": good}, out)
    pinned, seen = L.read_landed(spark, out, "x"), []
    replace = V.replace_file

    def watched(session, path, text):
        seen.append(L.read_landed(spark, out, "x").count())
        replace(session, path, text)
        seen.append(L.read_landed(spark, out, "x").count())

    def fails(*_):
        raise OSError("no pointer")

    monkeypatch.setattr(V, "replace_file", watched)
    L.land({"x": good.limit(1)}, out)
    assert seen == [2, 1] and pinned.count() == 2
    monkeypatch.setattr(V, "replace_file", fails)
    with pytest.raises(OSError, match="no pointer"):
        L.land({"x": good.unionByName(good)}, out)
    assert L.read_landed(spark, out, "x").count() == 1
    monkeypatch.setattr(V, "replace_file", replace)
    L.land({"x": good.unionByName(good)}, out)
    assert L.read_landed(spark, out, "x").count() == 4
    # The first version has expired, the one before is still there; what failed is named nowhere.
    assert len(V.versions(spark, f"{out}/x")) == 2
    with pytest.raises(Exception, match="(?i)not.*exist"):
        pinned.count()


def test_a_table_without_a_version(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        L.read_landed(spark, str(tmp_path), "x")
    with pytest.raises(ValueError, match="stays"):
        V.expire(spark, str(tmp_path), 0)


def test_headers_take_one_job(spark, tmp_path):
    for i in range(40):
        columns = ["id_mutation", "nom", *(["extra"] if i % 2 else [])][:: -1 if i % 3 == 0 else 1]
        row = {"id_mutation": str(i), "nom": "", "extra": f"e, {i}"}
        quoted = ",".join(f'"{row[c]}"' for c in columns)
        gz(tmp_path / f"dvf/2021/{i:02d} a.csv.gz", ("\n" if i == 5 else "") + ",".join(columns) + f"\n{quoted}\n")
    gz(tmp_path / "dvf/2021/empty.csv.gz", "")
    gz(tmp_path / "dvf/2021/header only.csv.gz", '"id_mutation","nom","autre"\n')
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers of all files")
    df = L.read_dvf(spark, str(tmp_path))
    rows = {int(r.id_mutation): (r.nom, r.extra, r.autre) for r in df.collect()}
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows == {i: (None, f"e, {i}" if i % 2 else None, None) for i in range(40)}
    # Listing more than 32 paths is a job of Spark's own.
    assert jobs <= 4


def test_given_raw_tables_are_read_in_place(spark, tmp_path, sf):
    w = warehouse(spark, sf)
    mine = Warehouse(spark, w.raw, str(tmp_path / "built"), departements_csv=str(tmp_path / "dep.csv"))
    (tmp_path / "dep.csv").write_text("code_departement,nom_departement,code_region,nom_region\n13,Bouches,93,PACA\n")
    assert mine.table("dvf_mutations").inputFiles() == w.raw["dvf_mutations"].inputFiles()
    assert [tuple(r) for r in mine.plan("departements").collect()] == [("13", "Bouches", "93", "PACA")]
    mine.table("stg_dpe_logements")
    assert [p.name.rsplit("-", 1)[0] for p in (tmp_path / "built").iterdir()] == ["stg_dpe_logements"]
    mine.remove()
    assert not (tmp_path / "built").exists()
