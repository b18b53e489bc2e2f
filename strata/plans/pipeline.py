"""The warehouse jobs: raw load, clean load, model build, all three in order.

Storage layout under ``root`` (any Hadoop file system path)::

    <root>/<layer>/<run_id>/<table>/     Parquet written by one run
    <root>/<layer>/<run_id>/_done/       one note for each table that the run has finished
    <root>/<layer>/_published/<n>.json   manifest n: the runs of the layer, each with its tables
    <root>/_audit/                       load audit rows (Parquet, appended)

A layer run writes every table first and publishes only when all of them
succeeded: the manifest is written to a temporary file and renamed to the
next number, never over an existing one, so two writers cannot both win and
a reader never sees half a manifest. Readers take the newest manifest, so a
failed or running load is never visible: the layer is replaced all or
nothing. ``mode="overwrite"`` publishes just the new run; ``mode="append"``
publishes the previous runs plus the new one, so rows loaded twice are there
twice. A table that a manifest lists must be there: reading a lost one fails.
Superseded runs stay readable until ``expire_runs`` removes them.

A run that failed is resumed by giving its ``run_id`` again: tables that it
finished are kept if they were made from what there is to read now (the same
source files, or the same manifest of the layer below), the others are written.

Every table write is audited: rows written (counted during the write),
seconds, key checks for the keyed entities, status and error text; failed
key checks and lost publications get a row too. The tables of a layer are
independent and are submitted together from a few driver threads, so small
tables do not wait for large ones.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.plans import quality
from strata.plans.model import DIMENSIONS, FACTS, Model
from strata.plans.rules import rule_report
from strata.plans.silver import CLEANERS
from strata.sources.csv_source import MULTI_LINE, read_raw_csv
from strata.sources.schemas import ENTITY_ORDER, KEY_CHECKED, KEYS, SECTIONS, SOURCE_FILES

LAYERS = ("raw", "clean", "model")

# Written files are sorted by these columns within each partition (no extra
# shuffle), so Parquet row-group statistics let key lookups skip row groups.
SORT_KEYS = {
    **{e: [k for k in KEYS[e] if k] for e in KEYS if KEYS[e]},
    "fact_order_items": ["order_id"],
    "fact_orders": ["order_id"],
    "fact_payments": ["order_id"],
    "fact_reviews": ["order_id"],
    "product_key_map": ["product_id"],
}

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("null_keys", T.LongType()),
        T.StructField("dup_keys", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


class LoadError(RuntimeError):
    pass


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, threads: int = 4):
        self.spark = spark
        self.root = root.rstrip("/")
        self.threads = threads
        self._views = self._model_views = False
        self._jvm = spark.sparkContext._jvm
        self._hconf = spark.sparkContext._jsc.hadoopConfiguration()

    # -- file system helpers (Hadoop FileSystem API, works on any store) ----
    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def _fs(self, p: str):
        return self._path(p).getFileSystem(self._hconf)

    def _mkdirs(self, p: str) -> None:
        self._fs(p).mkdirs(self._path(p))

    def _exists(self, p: str) -> bool:
        return bool(self._fs(p).exists(self._path(p)))

    def _read_text(self, p: str) -> str:
        fs = self._fs(p)
        stream = fs.open(self._path(p))
        try:
            reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def _create_text(self, p: str, text: str) -> bool:
        """Create ``p`` holding ``text``, whole or not at all; False if it
        already exists. Any other failure is raised."""
        target = self._path(p)
        temporary = self._path(f"{p}.{uuid.uuid4().hex}.tmp")
        fs = self._fs(p)
        if not fs.exists(target.getParent()) or not fs.getFileStatus(target.getParent()).isDirectory():
            raise LoadError(f"{target.getParent()} is not a folder")
        out = fs.create(temporary, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        plain = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(fs.getUri(), self._hconf).rename(temporary, target, plain)
        except Py4JJavaError as failed:
            fs.delete(temporary, False)
            if failed.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    # -- layers and manifests -----------------------------------------------
    def create_layers(self) -> None:
        """Create the three layer folders and the audit folder."""
        for layer in LAYERS:
            self._mkdirs(f"{self.root}/{layer}/_published")
        self._mkdirs(f"{self.root}/_audit")

    def _manifest_numbers(self, layer: str) -> list[int]:
        folder = f"{self.root}/{layer}/_published"
        if not self._exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs(folder).listStatus(self._path(folder))]
        return [int(name[:-5]) for name in names if re.fullmatch(r"[0-9]+[.]json", name)]

    def _manifest(self, layer: str) -> tuple[int, dict]:
        numbers = self._manifest_numbers(layer)
        if not numbers:
            return 0, {"runs": []}
        top = max(numbers)
        return top, json.loads(self._read_text(f"{self.root}/{layer}/_published/{top}.json"))

    def _publish(self, layer: str, run_id: str, mode: str, tables: list[str]) -> None:
        seq, current = self._manifest(layer)
        runs = ([] if mode == "overwrite" else list(current["runs"])) + [{"run": run_id, "tables": sorted(tables)}]
        body = json.dumps({"runs": runs, "published_at": time.time()})
        if not self._create_text(f"{self.root}/{layer}/_published/{seq + 1}.json", body):
            raise LoadError(f"{layer}: another load published manifest {seq + 1} first")

    def runs(self, layer: str) -> list[str]:
        return [r["run"] for r in self._manifest(layer)[1]["runs"]]

    def publish_run(self, layer: str, run_id: str, tables: list[str]) -> None:
        """Append one already written run to a layer (idempotent: a run that
        is already published is left alone)."""
        if run_id not in self.runs(layer):
            self._publish(layer, run_id, "append", tables)

    def table(self, layer: str, name: str) -> DataFrame:
        """The published content of one table: that of every run which the
        manifest says holds it. A listed folder that is gone fails the read."""
        runs = self._manifest(layer)[1]["runs"]
        if not runs:
            raise LoadError(f"layer {layer} has no published load")
        paths = [f"{self.root}/{layer}/{r['run']}/{name}" for r in runs if name in r["tables"]]
        if not paths:
            raise LoadError(f"no published {layer} run holds {name}")
        lost = [p for p in paths if not self._exists(p)]
        if lost:
            raise LoadError(f"published but absent: {', '.join(lost)}")
        return self.spark.read.parquet(*paths)

    def expire_runs(self, keep: int = 2) -> list[str]:
        """Remove, layer by layer, the manifests before the newest ``keep`` and
        every run folder that none of those lists; returns the folders removed.
        For times without a running load: an unpublished run is removed too."""
        if keep < 1:
            raise ValueError("keep at least the newest manifest")
        removed = []
        for layer in LAYERS:
            folder = f"{self.root}/{layer}/_published"
            numbers = sorted(self._manifest_numbers(layer))
            if not numbers:
                continue
            used = {r["run"] for n in numbers[-keep:] for r in json.loads(self._read_text(f"{folder}/{n}.json"))["runs"]}
            for n in numbers[:-keep]:
                self._fs(folder).delete(self._path(f"{folder}/{n}.json"), False)
            for status in self._fs(folder).listStatus(self._path(f"{self.root}/{layer}")):
                run = status.getPath().getName()
                if run != "_published" and run not in used:
                    self._fs(folder).delete(status.getPath(), True)
                    removed.append(f"{layer}/{run}")
        return removed

    def register_views(self) -> list[str]:
        """Expose every published table as a temporary view
        (``raw_<entity>``, ``clean_<entity>``, model tables by name). From
        then on each publication through this object refreshes the views of
        its layer; after one by another process, call this again."""
        self._views = True
        return [name for layer in LAYERS for name in self._refresh_views(layer)]

    def _refresh_views(self, layer: str) -> list[str]:
        names = []
        held = {t for r in self._manifest(layer)[1]["runs"] for t in r["tables"]}
        for t in ENTITY_ORDER if layer != "model" else DIMENSIONS + FACTS:
            if t in held:
                view = t if layer == "model" else f"{layer}_{t}"
                self.table(layer, t).createOrReplaceTempView(view)
                names.append(view)
        return names

    def register_model_views(self) -> list[str]:
        """The model as views over the published clean layer (nothing written):
        ``dim_*``, ``product_key_map``, ``fact_*``. They are defined anew when
        this object publishes a clean load. Nothing behind them is persisted:
        a query on a view computes it from the clean tables."""
        self._model_views = True
        return self._refresh_model_views()

    def _refresh_model_views(self) -> list[str]:
        model = Model({e: self.table("clean", e) for e in ENTITY_ORDER}, keep=False)
        for t in DIMENSIONS + FACTS:
            model[t].createOrReplaceTempView(t)
        return DIMENSIONS + FACTS

    def _after_publish(self, layer: str) -> None:
        if self._views:
            self._refresh_views(layer)
        if self._model_views and layer == "clean":
            self._refresh_model_views()

    # -- audit -------------------------------------------------------------------
    def _write_audit(self, rows: list[dict]) -> None:
        if rows:
            df = self.spark.createDataFrame([tuple(r.get(f.name) for f in AUDIT_SCHEMA) for r in rows], AUDIT_SCHEMA)
            df.coalesce(1).write.mode("append").parquet(f"{self.root}/_audit")

    def audit(self) -> DataFrame:
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(f"{self.root}/_audit")

    # -- generic layer run -------------------------------------------------------
    def _note(self, layer: str, run_id: str, table: str, note: dict | None = None) -> dict | None:
        """What a run noted when it had finished a table; ``note`` replaces it."""
        path = f"{self.root}/{layer}/{run_id}/_done/{table}.json"
        if note is None:
            return json.loads(self._read_text(path)) if self._exists(path) else None
        self._mkdirs(f"{self.root}/{layer}/{run_id}/_done")
        self._fs(path).delete(self._path(path), False)
        self._create_text(path, json.dumps(note))
        return note

    def _run_layer(self, layer: str, jobs: dict, mode: str, run_id: str, publish: bool | list[str] = True, source: str | dict[str, str] = "") -> list[dict]:
        """``jobs``: table -> callable returning (DataFrame, key to check|None).
        Writes every table, audits it, publishes only if all succeeded (and
        ``publish``; the model publishes once, after its facts, naming all of
        its tables). A table that this run finished before from the same
        ``source`` (by table, or one for all) is not written again."""
        rows: list[dict] = []
        if run_id in self.runs(layer):
            raise LoadError(f"{layer}: run {run_id} is published already")
        counts = ("rows", "null_keys", "dup_keys")

        def one(table: str) -> dict:
            t0 = time.perf_counter()
            row = {"run_id": run_id, "layer": layer, "section": SECTIONS.get(table), "table": table}
            read = source if isinstance(source, str) else source[table]
            done = self._note(layer, run_id, table) if read else None
            if done and done["source"] == read:
                return row | {c: done[c] for c in counts} | {"status": "resumed", "seconds": round(time.perf_counter() - t0, 3)}
            try:
                df, post_key = jobs[table]()
                if layer != "raw" and table in SORT_KEYS:
                    df = df.sortWithinPartitions(*SORT_KEYS[table])
                df, obs = quality.observed(df, f"{run_id}-{layer}-{table}")
                path = f"{self.root}/{layer}/{run_id}/{table}"
                df.write.mode("overwrite").parquet(path)
                row["rows"] = int(obs.get["rows"])
                if post_key:
                    chk = quality.key_check(self.spark.read.parquet(path), post_key, table, raw=False).first()
                    row["null_keys"], row["dup_keys"] = int(chk["null_keys"]), int(chk["dup_keys"])
                self._note(layer, run_id, table, {"source": read} | {c: row.get(c) for c in counts})
                row["status"] = "ok"
            except Exception as exc:  # recorded, then re-raised after the audit is written
                row["status"], row["error"] = "failed", f"{type(exc).__name__}: {exc}"
            row["seconds"] = round(time.perf_counter() - t0, 3)
            return row

        with ThreadPoolExecutor(max_workers=self.threads) as pool:
            rows = list(pool.map(one, list(jobs)))
        failed = [r for r in rows if r["status"] == "failed"]
        lost: Exception | None = None
        if not failed and publish:
            try:
                self._publish(layer, run_id, mode, publish if isinstance(publish, list) else list(jobs))
            except Exception as exc:  # audited, then raised again
                lost = exc
                rows.append({"run_id": run_id, "layer": layer, "section": "publish", "table": None, "status": "failed",
                             "error": f"{type(exc).__name__}: {exc}"})
        self._write_audit(rows)
        if failed:
            raise LoadError(f"{layer} load {run_id} failed: " + "; ".join(f"{r['table']}: {r['error']}" for r in failed))
        if lost:
            raise lost
        if publish:
            self._after_publish(layer)
        return rows

    @staticmethod
    def new_run_id() -> str:
        return time.strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]

    # -- the three jobs -------------------------------------------------------------
    def load_raw(self, source_dir: str | None = None, frames: dict[str, DataFrame] | None = None,
                 mode: str = "overwrite", run_id: str | None = None, multi_line: dict[str, bool] | None = None) -> list[dict]:
        """Raw load: every CSV file of ``source_dir`` (or the given all-text
        ``frames``, which must carry ``_ingest_pos``) into the raw layer.
        ``multi_line`` overrides, by entity, whether quoted values may hold
        line breaks; an entity without them is read by several tasks a file."""
        run_id = run_id or self.new_run_id()
        load_seq = self._load_seq(run_id)
        lines = MULTI_LINE | (multi_line or {})
        jobs = {}
        read = {}
        for entity in ENTITY_ORDER:
            if frames is not None:
                jobs[entity] = (lambda e=entity: (frames[e], None))
                read[entity] = ""  # a frame cannot be told from another: written again
            else:
                read[entity] = self._listing(source_dir, entity)
                jobs[entity] = (lambda e=entity: (read_raw_csv(self.spark, self.source_files(source_dir, e), e, load_seq, lines[e]), None))
        return self._run_layer("raw", jobs, mode, run_id, source=read)

    def _load_seq(self, run_id: str) -> int:
        """The load sequence of a raw run: drawn once, kept when it is resumed."""
        folder, drawn = f"{self.root}/raw/{run_id}/_done", time.time_ns()
        self._mkdirs(folder)
        self._create_text(f"{folder}/_load_seq", str(drawn))
        return int(self._read_text(f"{folder}/_load_seq")) if self._exists(f"{folder}/_load_seq") else drawn

    def _listing(self, source_dir: str, entity: str) -> str:
        """An entity's source files with their sizes and times, to tell whether they changed."""
        found = []
        for path in self.source_files(source_dir, entity):
            status, summary = self._fs(path).getFileStatus(self._path(path)), self._fs(path).getContentSummary(self._path(path))
            found.append([path, summary.getLength(), summary.getFileCount(), status.getModificationTime()])
        return json.dumps(found)

    def source_files(self, source_dir: str, entity: str) -> list[str]:
        """An entity's export: ``<stem>.csv`` (a file, or a folder of parts) or
        ``<stem>_<number>.csv``, in the order of their numbers. Nothing else."""
        stem = SOURCE_FILES[entity][: -len(".csv")]
        folder = source_dir.rstrip("/")
        found = []
        for status in self._fs(folder).listStatus(self._path(folder)):
            name = status.getPath().getName()
            if match := re.fullmatch(re.escape(stem) + r"(?:_([0-9]+))?[.]csv", name):
                found.append((int(match[1] or -1), name))
        if not found:
            raise LoadError(f"{folder} has no {stem}.csv")
        return [f"{folder}/{name}" for _, name in sorted(found)]

    def load_clean(self, mode: str = "overwrite", run_id: str | None = None) -> list[dict]:
        """Clean load from the published raw layer; key checks before (on the
        raw rows) and after (on the written rows) for the keyed entities."""
        run_id = run_id or self.new_run_id()
        read = f"raw manifest {self._manifest('raw')[0]}"

        def precheck(entity: str) -> dict:
            t0 = time.perf_counter()
            row = {"run_id": run_id, "layer": "clean-precheck", "section": SECTIONS[entity], "table": entity}
            try:
                chk = quality.key_check(self.table("raw", entity), KEYS[entity][0], entity, raw=True).first()
                row |= {"null_keys": int(chk["null_keys"]), "dup_keys": int(chk["dup_keys"]), "status": "ok"}
            except Exception as exc:  # audited, then raised
                row |= {"status": "failed", "error": f"{type(exc).__name__}: {exc}"}
            return row | {"seconds": round(time.perf_counter() - t0, 3)}

        with ThreadPoolExecutor(max_workers=self.threads) as pool:
            checked = list(pool.map(precheck, KEY_CHECKED))
        self._write_audit(checked)
        failed = [r for r in checked if r["status"] != "ok"]
        if failed:
            raise LoadError(f"clean load {run_id}: key check failed: " + "; ".join(f"{r['table']}: {r['error']}" for r in failed))
        jobs = {}
        for entity in ENTITY_ORDER:
            key = KEYS[entity][0] if entity in KEY_CHECKED else None
            jobs[entity] = (lambda e=entity, k=key: (CLEANERS[e](self.table("raw", e)), k))
        return self._run_layer("clean", jobs, mode, run_id, source=read)

    def build_model(self, run_id: str | None = None) -> list[dict]:
        """Dimensions first (written), then the order context that all facts
        share, then facts reading what was written, so nothing is computed
        twice and the small dimensions broadcast from known file sizes."""
        run_id = run_id or self.new_run_id()
        read = f"clean manifest {self._manifest('clean')[0]}"
        clean = {e: self.table("clean", e) for e in ENTITY_ORDER}
        model = Model(clean)
        rows = self._run_layer("model", {d: _job(model, d) for d in DIMENSIONS}, "overwrite", run_id, publish=False, source=read)
        model.release()
        path = f"{self.root}/model/{run_id}"
        written = {d: self.spark.read.parquet(f"{path}/{d}") for d in DIMENSIONS}
        context = Model(clean, overrides=written)
        rows += self._run_layer("model", {"order_context": _job(context, "order_context")}, "overwrite", run_id, publish=False, source=read)
        context.release()
        written["order_context"] = self.spark.read.parquet(f"{path}/order_context")
        model = Model(clean, overrides=written)
        rows += self._run_layer("model", {f: _job(model, f) for f in FACTS}, "overwrite", run_id, publish=DIMENSIONS + FACTS, source=read)
        model.release()
        return rows

    def run_all(self, source_dir: str | None = None, frames: dict[str, DataFrame] | None = None,
                mode: str = "overwrite") -> list[dict]:
        """raw -> clean -> model, each layer after the one before it."""
        self.create_layers()
        rows = self.load_raw(source_dir=source_dir, frames=frames, mode=mode)
        rows += self.load_clean(mode=mode)
        rows += self.build_model()
        return rows

    # -- checks ----------------------------------------------------------------------
    def reconcile(self) -> DataFrame:
        """Rows per entity in the raw and clean layers and the rows dropped."""
        raw = {e: self.table("raw", e) for e in ENTITY_ORDER}
        clean = {e: self.table("clean", e) for e in ENTITY_ORDER}
        return quality.reconcile(raw, clean)

    def discarded(self) -> DataFrame:
        """Raw rows that the clean layer left out, by entity and reason."""
        return quality.discarded({e: self.table("raw", e) for e in ENTITY_ORDER})

    def discarded_detail(self) -> DataFrame:
        """Each raw row that the clean layer left out, with its key, its position
        and that of the row which was kept instead."""
        return quality.discarded_detail({e: self.table("raw", e) for e in ENTITY_ORDER})

    def check_rules(self) -> DataFrame:
        """The declared rules (see ``strata.plans.rules``) over the clean layer:
        rows checked and rows that break each."""
        return rule_report({e: self.table("clean", e) for e in ENTITY_ORDER})

    def check_objects(self) -> DataFrame:
        """Every expected table of every layer: published and present?"""
        rows = []
        for layer in LAYERS:
            runs = self._manifest(layer)[1]["runs"]
            tables = ENTITY_ORDER if layer != "model" else DIMENSIONS + FACTS
            for t in tables:
                holding = [r["run"] for r in runs if t in r["tables"]]
                present = bool(holding) and all(self._exists(f"{self.root}/{layer}/{r}/{t}") for r in holding)
                rows.append((layer, t, len(holding), present))
        schema = "layer string, table string, published_runs int, present boolean"
        return self.spark.createDataFrame(rows, schema)


def _job(model: Model, name: str):
    return lambda: (model[name], None)
