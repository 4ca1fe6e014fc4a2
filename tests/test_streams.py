"""Incremental runs over files that arrive one after another, each compared with one batch over all of them."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terroir.plans import intermediate, staging
from terroir.plans.warehouse import warehouse
from terroir.sources import landing as L
from terroir.streaming import incremental as S
from terroir.streaming import manifest as M
from terroir.streaming import seen


def diag(i, day, label="C", ban="BAN1"):
    return {
        "numero_dpe": None if i is None else f"DPE{i}", "date_etablissement_dpe": day, "code_insee_ban": "59001",
        "nom_commune_ban": "Un", "code_departement_ban": "59", "identifiant_ban": ban, "type_batiment": "Maison",
        "etiquette_dpe": label, "surface_habitable_logement": 40.0,
    }


class Flow:
    """A folder that files arrive in, and the streams over it."""

    def __init__(self, spark, tmp_path, params):
        self.spark, self.params, self.drop = spark, params, tmp_path / "drop"
        self.out, self.state, self.check = (str(tmp_path / x) for x in ("out", "state", "check"))

    def arrive(self, name, rows):
        self.drop.mkdir(parents=True, exist_ok=True)
        (self.drop / name).write_text("".join(json.dumps(r) + "\n" for r in rows))

    def stream(self, loaded=None):
        stream = S.landing_stream(self.spark, str(self.drop), files_per_batch=1)
        return stream if loaded is None else stream.withColumn("_loaded_at", F.lit(loaded).cast("timestamp"))

    def land(self, loaded=None):
        S.append_unseen(self.stream(loaded), self.out, f"{self.check}-lots", {"mois": S.monthly_partial(self.params)}, paquets=8)

    def close(self):
        S.close_days(self.spark, self.out, f"{self.check}-jours")

    def merge(self):
        S.merge_latest(self.stream(), self.state, f"{self.check}-etat", paquets=16)

    def raw(self):
        raw = self.spark.read.schema(L.text_schema(L.CHAMPS_DPE)).json(str(self.drop))
        return raw.withColumn("_loaded_at", F.current_timestamp())

    def batch_days(self):
        dated = staging.stg_dpe(self.raw()).filter("date_etablissement_dpe is not null")
        return sorted((str(r[0]), r[1], r[2]) for r in dated.groupBy("date_etablissement_dpe", "etiquette_dpe").count().collect())

    def days(self):
        return sorted((str(r.jour), r.etiquette_dpe, r.nb_dpe) for r in S.daily_counts(self.spark, self.out).collect())

    def numbers(self):
        return sorted(str(r.numero_dpe) for r in S.lots(self.spark, self.out).collect())

    def manifest(self):
        return M.load(self.spark, self.out)


@pytest.fixture
def flow(spark, tmp_path, sf):
    return Flow(spark, tmp_path, warehouse(spark, sf).params)


def rows_of(df):
    return sorted(map(str, df.drop("_loaded_at").collect()))


def test_a_copy_counts_once_after_any_delay(flow, spark):
    flow.arrive("1.json", [diag(1, "2023-01-05"), diag(2, "2023-01-20", "F"), diag(1, "2023-01-05"), diag(None, "2023-01-01")])
    flow.land("2024-01-01")
    flow.arrive("2.json", [diag(2, "2023-01-20", "F"), diag(3, "2023-02-01", "G"), diag(None, "2023-01-01")])
    flow.land("2024-03-01")
    flow.arrive("3.json", [diag(1, "2023-01-05"), diag(4, "2021-12-01", "A", "BAN2"), diag(5, "inconnue", "B")])
    flow.land("2025-01-01")
    flow.land("2025-01-02")  # nothing new
    flow.arrive("4.json", [diag(i, "2023-01-05") for i in range(1, 4)])  # nothing but copies
    flow.land("2026-01-01")
    assert flow.numbers() == ["DPE1", "DPE2", "DPE3", "DPE4", "DPE5", "None"]
    counts = S.monthly_counts(spark, flow.out).filter("mois >= '2022-01-01'").collect()
    assert sorted((str(r.mois), r.etiquette_dpe, r.nb_dpe) for r in counts) == [
        ("2023-01-01", "C", 2), ("2023-01-01", "F", 1), ("2023-02-01", "G", 1),
    ]


def test_a_batch_probes_only_its_buckets(flow, spark):
    flow.arrive("1.json", [diag(i, "2023-01-05") for i in range(300)])
    flow.land()
    lots = [seen.Lot.of(text) for text in flow.manifest().folders("vus")]
    assert len(lots) == 1 and set(lots[0].buckets) == set(range(8))
    asked = spark.createDataFrame([("DPE7",), ("new",)], "numero_dpe string").withColumn("paquet", seen.bucket("numero_dpe", 8))
    buckets = {r.numero_dpe: r.paquet for r in asked.collect()}
    files = seen._read(spark, lots, {buckets["DPE7"]}, "keys").inputFiles()
    assert files and all(f"paquet={buckets['DPE7']}/" in f for f in files)
    passed = seen.maybe_known(asked, "numero_dpe", lots)
    assert {r.numero_dpe for r in passed.collect()} == {"DPE7"}  # the filter alone tells most keys apart
    touched = {int(part.split("=")[1]) for f in passed.inputFiles() for part in f.split("/") if part.startswith("paquet=")}
    assert touched <= set(buckets.values())


@pytest.mark.parametrize("paquets", [1, 8])
def test_filters_let_every_known_key_through(spark, tmp_path, paquets):
    keys = spark.range(5000).selectExpr("concat('K', id) as k").unionByName(spark.sql("select cast(null as string) as k"))
    lots = [seen.write_lot(keys.filter(part), "k", str(tmp_path), paquets) for part in ("k < 'K3'", "k >= 'K3' or k is null")]
    asked = keys.unionByName(spark.range(5000, 25_000).selectExpr("concat('K', id) as k")).withColumn("paquet", seen.bucket("k", paquets))
    passed = {r.k for r in seen.maybe_known(asked, "k", lots).collect()}
    known = {f"K{i}" for i in range(5000)} | {None}
    assert known <= passed and len(passed - known) < 60
    assert {r.k for r in seen.known(asked, "k", lots, str(tmp_path / "s")).collect()} == known
    one = seen.compacted(spark, lots, "k", str(tmp_path), paquets)
    assert {r.k for r in seen.known(asked, "k", [one], str(tmp_path / "t")).collect()} == known
    assert seen.write_lot(keys.limit(0), "k", str(tmp_path), paquets) is None
    assert seen.known(asked, "k", [], str(tmp_path / "u")) is None


def test_days_closed_late_and_open_equal_a_batch(flow):
    flow.arrive("1.json", [diag(1, "2023-01-01"), diag(2, "2023-01-01"), diag(3, "2023-03-15", "F"), diag(8, "inconnue")])
    flow.land()
    assert flow.days() == flow.batch_days()  # before any window is closed
    flow.close()
    assert flow.days() == flow.batch_days()
    flow.arrive("2.json", [diag(4, "2023-03-10"), diag(5, "2023-03-15", "F"), diag(3, "2023-03-15", "F")])
    flow.land()
    flow.close()
    assert flow.days() == flow.batch_days()
    flow.arrive("3.json", [diag(6, "2023-06-01"), diag(7, "2022-01-01", "G")])  # the second is late
    flow.land()
    flow.close()
    assert flow.days() == flow.batch_days()
    flow.arrive("4.json", [diag(9, "2023-03-15", "F"), diag(10, "2023-06-02")])  # late for a window that is final
    flow.land()
    flow.close()
    flow.close()  # nothing new
    assert flow.days() == flow.batch_days()
    late = {(str(r.jour), r.nb_dpe) for r in S.lots(flow.spark, flow.out, "tardifs").collect()}
    assert ("2022-01-01", 1) in late and ("2023-03-15", 1) in late
    closed = M.load(flow.spark, f"{flow.out}/jours")
    assert closed.facts["clos"] >= "2023-03-15"
    final = {(str(r.jour), r.nb_dpe) for r in M.read(flow.spark, closed.folders("jours")).collect()}
    assert ("2023-03-15", 2) in final and all(day < "2023-06-01" for day, _ in final)


def test_windows_wait_for_an_interrupted_landing(flow, monkeypatch):
    flow.arrive("1.json", [diag(1, "2023-01-01")])
    flow.land()
    flow.arrive("2.json", [diag(2, "2023-05-01")])
    store = M.store
    monkeypatch.setattr(M, "store", lambda *a: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(Exception, match="crash"):
        flow.land()
    monkeypatch.setattr(M, "store", store)
    assert flow.numbers() == ["DPE1"]  # what the interrupted batch wrote is not seen
    with pytest.raises(RuntimeError, match="interrupted"):
        flow.close()
    flow.land()
    flow.close()
    assert flow.numbers() == ["DPE1", "DPE2"] and flow.days() == flow.batch_days()


def test_a_batch_that_is_replayed_counts_once(flow, spark, monkeypatch):
    """A crash after the manifest and before the checkpoint: Spark gives the same batch again."""
    flow.arrive("1.json", [diag(1, "2023-01-01"), diag(2, "2023-01-02")])
    store = M.store

    def stored_then_lost(*args):
        store(*args)
        raise OSError("crash")

    monkeypatch.setattr(M, "store", stored_then_lost)
    for run in (flow.land, flow.merge):
        with pytest.raises(Exception, match="crash"):
            run()
    monkeypatch.setattr(M, "store", store)
    flow.land()
    flow.merge()
    assert flow.numbers() == ["DPE1", "DPE2"]
    assert flow.manifest().batch == 0 and len(flow.manifest().folders("nouveaux")) == 1
    assert rows_of(S.current_rows(spark, flow.state)) == rows_of(intermediate.dpe_dernier(staging.stg_dpe(flow.raw())))


@pytest.fixture
def landed(flow):
    for i in range(4):
        flow.arrive(f"{i}.json", [diag(10 * i + j, f"2023-0{i + 1}-1{j}") for j in range(5)] + [diag(1, "2023-01-11")])
        flow.land()
    return flow


def test_compaction_keeps_all_rows(landed, spark):
    merges = {"nouveaux": None, "mois": S.monthly_sums, "tardifs": None, "vus": None}
    before = {name: rows_of(S.lots(spark, landed.out, name)) for name in ("nouveaux", "tardifs")}
    months, days, pinned = rows_of(S.monthly_counts(spark, landed.out)), landed.days(), S.lots(spark, landed.out)
    for name, merge in merges.items():
        S.compact(spark, landed.out, name, merge)
        assert len(landed.manifest().folders(name)) == 1
        S.compact(spark, landed.out, name, merge)  # one lot stays as it is
    assert {name: rows_of(S.lots(spark, landed.out, name)) for name in before} == before
    assert rows_of(S.monthly_counts(spark, landed.out)) == months and landed.days() == days == landed.batch_days()
    assert rows_of(pinned) == before["nouveaux"]  # a reader that began before
    landed.arrive("9.json", [diag(1, "2023-01-11"), diag(31, "2023-04-11"), diag(99, "2023-05-01")])
    landed.land()
    assert len(landed.numbers()) == 21 and landed.days() == landed.batch_days()


def test_a_crash_in_compaction_loses_nothing(landed, spark, monkeypatch):
    before = rows_of(S.lots(spark, landed.out))
    during, store = [], M.store

    def fails(*_):
        during.append(rows_of(S.lots(spark, landed.out)))
        raise OSError("crash")

    monkeypatch.setattr(M, "store", fails)
    with pytest.raises(OSError, match="crash"):
        S.compact(spark, landed.out, "nouveaux")
    monkeypatch.setattr(M, "store", store)
    assert during == [before] and rows_of(S.lots(spark, landed.out)) == before
    S.compact(spark, landed.out, "nouveaux")
    assert rows_of(S.lots(spark, landed.out)) == before


def test_retired_lots_are_deleted_after_a_grace(landed, spark, monkeypatch):
    old = landed.manifest().folders("nouveaux")
    S.compact(spark, landed.out, "nouveaux")
    S.compact(spark, landed.out, "mois", S.monthly_sums)
    assert all(os.path.exists(f) for f in old)
    monkeypatch.setattr(M, "GRACE", 0)
    landed.arrive("late.json", [diag(100, "2023-04-01")])
    landed.land()
    assert not any(os.path.exists(f) for f in old) and len(landed.numbers()) == 21
    assert landed.manifest().retired == []


def files(state):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{state}/etat") for f in names if f.endswith(".parquet")}


def test_one_key_rewrites_one_bucket(flow, spark):
    flow.arrive("1.json", [diag(i, "2023-01-05", ban=f"BAN{i}") for i in range(60)])
    flow.merge()
    before, state = files(flow.state), M.load(spark, flow.state).buckets["etat"]
    assert 8 < len(state) <= 16
    flow.arrive("2.json", [diag(1000, "2024-01-05", "G", ban="BAN7"), diag(1001, "2020-01-05", "A", ban="BAN7")])
    flow.merge()
    after = M.load(spark, flow.state).buckets["etat"]
    assert sum(state[b] != after[b] for b in after) == 1
    assert before <= files(flow.state) and len({os.path.dirname(f) for f in files(flow.state) - before}) == 1
    assert rows_of(S.current_rows(spark, flow.state)) == rows_of(intermediate.dpe_dernier(staging.stg_dpe(flow.raw())))


def test_the_state_equals_a_batch_and_can_be_repacked(flow, spark):
    for i in range(4):
        flow.arrive(f"{i}.json", [diag(100 * i + j, f"202{(i * j) % 5}-01-0{j % 9 + 1}", "ABCDEFG"[j % 7], f"BAN{j % 13}") for j in range(30)])
        flow.merge()
        if i == 1:
            S.repack(spark, flow.state, 4)
            assert set(M.load(spark, flow.state).buckets["etat"]) <= {"0", "1", "2", "3"}
    expected = rows_of(intermediate.dpe_dernier(staging.stg_dpe(flow.raw())))
    assert rows_of(S.current_rows(spark, flow.state)) == expected
    counted = Counter(r.cle_logement for r in S.current_rows(spark, flow.state).collect())
    assert max(counted.values()) == 1


def test_nothing_landed(flow, spark):
    with pytest.raises(FileNotFoundError):
        S.lots(spark, flow.out)
    with pytest.raises(FileNotFoundError):
        S.current_rows(spark, flow.state)
    S.compact(spark, flow.out, "nouveaux")
    S.close_days(spark, flow.out, f"{flow.check}-jours")
