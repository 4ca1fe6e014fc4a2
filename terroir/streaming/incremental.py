"""Incremental variants: files landed once, duplicates removed, aggregates and latest rows kept current.

Every micro-batch writes folders of its own and then replaces the manifest (see :mod:`terroir.streaming.manifest`), so
a batch counts once however often it is replayed. What a batch reads of earlier ones is bounded by its own keys: the
filters and key files of its buckets, or the state of its buckets.

Daily counts are event-time windows. A diagnostic is late if its day's window ended before the watermark: the latest day
landed so far, this lot included, less the delay. Late rows are counted in a side table, the others go through Spark's
windowed aggregation in append mode, where they are never too late: its watermark is at most that of their lot. Reading
adds up the final windows, the side table and the days still open.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.operators.latest import first_per_key, last_per_key
from terroir.params import Params
from terroir.plans import intermediate, marts, staging
from terroir.sources.landing import CHAMPS_DPE, text_schema
from terroir.storage import remove
from terroir.streaming import manifest as M
from terroir.streaming import seen

CLE = "numero_dpe"
#: Days for which a day's window waits for more diagnostics.
DELAI = 30


def landing_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Diagnostics files as they arrive; the checkpoint remembers which were read."""
    return (
        spark.readStream.schema(text_schema(CHAMPS_DPE))
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
        .withColumn("_loaded_at", F.current_timestamp())
    )


def append_once(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append everything new to Parquet, each input file exactly once, then stop."""
    (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``write`` on everything new, micro-batch by micro-batch, then stop."""
    (
        stream.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _rewritten(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a folder of its batch, over what an earlier attempt left there, and read again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append_unseen(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    partials: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
    paquets: int = seen.PAQUETS,
    delai: int = DELAI,
) -> None:
    """Append diagnostics whose number no earlier batch had, however long ago; then stop.

    New rows are lots of the table ``nouveaux``; each of ``partials`` gets a batch's new rows, and its result is a lot of
    the table of its name. ``paquets`` is the number of key buckets, set when ``out`` is new: take so many that one
    holds some million numbers. Rows without a number are one diagnostic.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = M.load(spark, out)
        if batch_id <= state.batch:
            return
        number = int(state.facts.get("paquets", paquets))
        lot, scratch = f"lot={batch_id}", f"{out}/_en_cours/lot={batch_id}"
        first = first_per_key(staging.dpe_types(batch), [CLE], ["_loaded_at"]).withColumn("paquet", seen.bucket(CLE, number))
        received = _rewritten(first, f"{scratch}/recus")
        before = [seen.Lot.of(text) for text in state.folders("vus")]
        known = seen.known(received.select(CLE, "paquet"), CLE, before, f"{scratch}/a_verifier")
        new = received.drop("paquet")
        if known is not None:
            new = new.join(known.withColumnRenamed(CLE, "vu"), F.col(CLE).eqNullSafe(F.col("vu")), "left_anti")
        landed = _rewritten(new, f"{out}/nouveaux/{lot}")

        day = F.col("date_etablissement_dpe")
        latest = max(filter(None, (state.facts.get("jour"), landed.agg(F.max(day).cast("string")).first()[0])), default=None)
        watermark = None if latest is None else f"date_sub(date'{latest}', {int(delai)})"
        late = F.lit(False) if watermark is None else F.coalesce(F.date_add(day, 1) <= F.expr(watermark), F.lit(False))
        days = landed.filter(day.isNotNull()).groupBy(day.alias("jour"), "etiquette_dpe", late.alias("tardif")).agg(
            F.count(F.lit(1)).alias("nb_dpe")
        )
        days = _rewritten(days, f"{scratch}/jours")
        new_lots = {"nouveaux": f"{out}/nouveaux/{lot}"}
        for name, rows in {
            "a_dater": days.filter("not tardif").drop("tardif"),
            "tardifs": days.filter("tardif").drop("tardif"),
            **{name: partial(landed) for name, partial in (partials or {}).items()},
        }.items():
            new_lots[name] = f"{out}/{name}/{lot}"
            _rewritten(rows, new_lots[name])
        keys = seen.write_lot(landed, CLE, f"{out}/vus", number)
        if keys is not None:
            new_lots["vus"] = keys.text()
        facts = state.facts | {"paquets": str(number), "delai": str(delai)} | ({"jour": latest} if latest else {})
        M.store(spark, out, replace(state.with_lots(new_lots), batch=batch_id, facts=facts))
        remove(spark, scratch)

    _each_batch(stream, write, checkpoint)


def lots(spark: SparkSession, out: str, name: str = "nouveaux") -> DataFrame:
    """The rows of a table of :func:`append_unseen`, as of the manifest; they stay as they are while it goes on."""
    rows = M.read(spark, M.load(spark, out).folders(name))
    if rows is None:
        raise FileNotFoundError(f"no lot of {name} in {out}")
    return rows


def compact(spark: SparkSession, out: str, name: str, merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Replace the lots of a table by one, with ``merge`` over their rows (counts that add up, say).

    The merged lot is written first and the manifest replaced then: readers see the same rows before, during and after,
    and a crash in between leaves the old lots in place. Runs between batches of the stream, not beside one.
    """
    state = M.load(spark, out)
    old = state.folders(name)
    if len(old) < 2:
        return
    if name == "vus":
        before = [seen.Lot.of(text) for text in old]
        merged = seen.compacted(spark, before, CLE, f"{out}/vus", int(state.facts["paquets"]))
        # A lot of keys is named by its text; its folders are what is retired.
        gone = [f for lot in before for f in (lot.keys, lot.filters)]
        M.store(spark, out, state.compacted(name, old, merged.text()).without(gone))
        return
    rows = spark.read.parquet(*old)
    target = f"{out}/{name}/compact-{uuid.uuid4().hex[:12]}"
    (rows.hint("rebalance") if merge is None else merge(rows)).write.parquet(target)
    M.store(spark, out, state.compacted(name, old, target).without(old))


def monthly_partial(params: Params) -> Callable[[DataFrame], DataFrame]:
    """Monthly counts of one batch; counts and sums add up across batches."""

    def partial(batch: DataFrame) -> DataFrame:
        return marts.dpe_du_flux(batch, params).groupBy(*marts.CLES_FLUX).agg(
            F.count(F.lit(1)).alias("nb_dpe"), F.sum("surface_habitable").alias("surface")
        )

    return partial


def monthly_sums(lots: DataFrame) -> DataFrame:
    """Partial counts of several lots as one."""
    return lots.groupBy(*marts.CLES_FLUX).agg(F.sum("nb_dpe").alias("nb_dpe"), F.sum("surface").alias("surface"))


def monthly_counts(spark: SparkSession, out: str, name: str = "mois") -> DataFrame:
    """The flow fact from all batches so far."""
    return marts.flux_final(monthly_sums(lots(spark, out, name)))


DAILY = "jour date, etiquette_dpe string, nb_dpe long"


def close_days(spark: SparkSession, out: str, checkpoint: str) -> None:
    """Run the windows of the days landed by :func:`append_unseen`; those behind the watermark are final. Then stop."""
    landed = M.load(spark, out)
    if not landed.folders("a_dater"):
        return
    source = f"{out}/a_dater"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{source}/lot=*")
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    if any(int(f.getPath().getName().split("=")[1]) > landed.batch for f in listed):
        raise RuntimeError("the last landing was interrupted; it has to be run again first")

    def write(windows: DataFrame, batch_id: int) -> None:
        state = M.load(spark, f"{out}/jours")
        if batch_id <= state.batch:
            return
        folder = f"{out}/jours/lot={batch_id}"
        closed = _rewritten(windows, folder)
        last = closed.agg(F.max("jour").cast("string")).first()[0]
        facts = state.facts | ({"clos": max(last, state.facts.get("clos", last))} if last else {})
        M.store(spark, f"{out}/jours", replace(state.with_lots({"jours": folder}), batch=batch_id, facts=facts))

    windows = (
        spark.readStream.schema(DAILY)
        .parquet(source)
        .withColumn("instant", F.col("jour").cast("timestamp"))
        .withWatermark("instant", f"{landed.facts['delai']} days")
        .groupBy(F.window("instant", "1 day"), "etiquette_dpe")
        .agg(F.sum("nb_dpe").alias("nb_dpe"))
        .select(F.col("window.start").cast("date").alias("jour"), "etiquette_dpe", "nb_dpe")
    )
    _each_batch(windows, write, checkpoint)


def daily_counts(spark: SparkSession, out: str) -> DataFrame:
    """Diagnostics per day and label: final windows, late rows and open days together."""
    closed_state = M.load(spark, f"{out}/jours")
    parts = [lots(spark, out, "tardifs")]
    open_days = lots(spark, out, "a_dater")
    if "clos" in closed_state.facts:
        # A day on time is never behind the last final one, so what is left of the lots is not in any window yet.
        open_days = open_days.filter(F.col("jour") > F.lit(closed_state.facts["clos"]).cast("date"))
        parts.append(M.read(spark, closed_state.folders("jours")))
    parts.append(open_days)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("jour", "etiquette_dpe").agg(F.sum("nb_dpe").alias("nb_dpe"))


def merge_latest(stream: DataFrame, out: str, checkpoint: str, paquets: int = seen.PAQUETS) -> None:
    """Keep one current row per dwelling; then stop.

    The state is dealt to ``paquets`` buckets by the hash of the dwelling's key. A batch reads the buckets of its own
    keys, merges its rows into them and writes them anew; the manifest then names the new folders of these buckets, the
    others stay untouched. ``paquets`` is set when ``out`` is new; see :func:`repack`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = M.load(spark, out)
        if batch_id <= state.batch:
            return
        number = int(state.facts.get("paquets", paquets))
        scratch = f"{out}/_en_cours/lot={batch_id}"
        latest = intermediate.dpe_dernier(staging.dpe_types(batch))
        latest = _rewritten(latest.withColumn("paquet", seen.bucket("cle_logement", number)), scratch)
        touched = [str(r["paquet"]) for r in latest.select("paquet").distinct().collect()]
        held = [folder for b, folder in state.buckets.get("etat", {}).items() if b in touched]
        merged = latest
        if held:
            before = spark.read.parquet(*held).withColumn("paquet", seen.bucket("cle_logement", number))
            merged = last_per_key(latest.unionByName(before), ["cle_logement"], ["date_etablissement_dpe", "numero_dpe"])
        new = _write_buckets(merged, f"{out}/etat/lot-{batch_id}-{uuid.uuid4().hex[:12]}", touched)
        after = replace(state.with_buckets("etat", new), batch=batch_id, facts=state.facts | {"paquets": str(number)})
        M.store(spark, out, after)
        remove(spark, scratch)

    _each_batch(stream, write, checkpoint)


def _write_buckets(rows: DataFrame, folder: str, buckets: list[str]) -> dict[str, str]:
    """Write rows by their ``paquet``; the folder of each bucket."""
    rows.hint("rebalance", "paquet").write.partitionBy("paquet").parquet(folder)
    return {b: f"{folder}/paquet={b}" for b in buckets}


def repack(spark: SparkSession, out: str, paquets: int) -> None:
    """Deal the state of :func:`merge_latest` to another number of buckets, as it grows; runs between its batches."""
    state = M.load(spark, out)
    old = state.buckets.get("etat", {})
    rows = current_rows(spark, out).withColumn("paquet", seen.bucket("cle_logement", paquets))
    folder = f"{out}/etat/paquets-{paquets}-{uuid.uuid4().hex[:12]}"
    present = [str(r["paquet"]) for r in rows.select("paquet").distinct().collect()]
    new = _write_buckets(rows, folder, present)
    facts = state.facts | {"paquets": str(paquets)}
    after = replace(state, buckets=state.buckets | {"etat": new}, facts=facts)
    M.store(spark, out, after.without(old.values()))


def current_rows(spark: SparkSession, out: str) -> DataFrame:
    """The current state of :func:`merge_latest`."""
    folders = M.load(spark, out).buckets.get("etat", {})
    rows = M.read(spark, list(folders.values()))
    if rows is None:
        raise FileNotFoundError(f"no state in {out}")
    return rows
