"""The lakehouse flow: ingest files, transform to the listing model, build marts, export datasets; all steps are logged.

Each command works per source as Spark jobs over all of that source's pending files; the driver sees manifests (a row for
each file), schemas and counts.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.inference import TEXT, coerce, infer_types
from ..functions.names import clean_name
from ..operators import mapping as M
from ..operators import rows as R
from ..operators.export import clear_partitions, delete_folder, export_dataset, folder_names
from ..operators.quarantine import Quarantine, reject_rows
from ..operators.runlog import DONE_INGEST, DONE_TRANSFORM, RunLog, latest_status, stale_sources, status_of, utc_now, worst
from ..operators.schema import KeptSchema, aligned, merged_schema
from ..operators.tables import VersionedTable, bucket_of, snapshot_id
from ..session import SETTINGS
from ..sources import manifest as FM
from ..sources import readers as SR
from ..sources.splits import read_csv_splits
from .features import TARGET, feature_table
from .marts import MARTS

SERVICE = ("_run_id", "_content_hash", "_source_file", "_ingested_at", "_row_ordinal")


#: Session settings without which old charsets aren't read, content hashes can be taken for numbers, and thousands of files
#: or folders are listed by a task each.
NEEDED = ("spark.sql.legacy.javaCharsets", "spark.sql.sources.partitionColumnTypeInference.enabled", "spark.sql.sources.parallelPartitionDiscovery.parallelism")
#: Bytes of the names of a load's files up to which they are broadcast; more are joined by shuffle.
BROADCAST_NAMES = 16 << 20
#: CSV files, and JSON files that hold an array, above these sizes are read in splits by many tasks.
SPLIT_BYTES, ARRAY_BYTES = 128 << 20, 32 << 20
#: Pending files of a source that a scan names one by one, so that only their partitions are read.
PRUNED_FILES = 10_000


@contextlib.contextmanager
def isolated(outcome: dict[str, dict], hashes: list[str]) -> Iterator[None]:
    """An error is noted for the files concerned, and the work goes on."""
    try:
        yield
    except Exception as e:  # noqa: BLE001 - whatever it is, it is this unit's record
        for h in hashes:
            outcome[h]["error"] = outcome[h]["error"] or error_text(e)


def error_text(e: Exception, limit: int = 2000) -> str:
    """The kind of an error and the beginning of what it says, for the run log."""
    return f"{type(e).__name__}: {e}"[:limit]


class Lake:
    """Folders of one lake under ``root``: bronze, silver, gold, quarantine, ops, datasets.

    Each source's silver rows are divided into ``silver_buckets`` by their key; an update reads and writes those it touches.
    """

    def __init__(self, spark: SparkSession, root: str, *, silver_buckets: int = 16):
        self.spark, self.root, self.silver_buckets = spark, root.rstrip("/"), silver_buckets
        for key in NEEDED:
            spark.conf.set(key, SETTINGS[key])
        self.log = RunLog(spark, f"{self.root}/ops/pipeline_runs")
        self.quarantine = Quarantine(spark, f"{self.root}/quarantine")
        self.silver = VersionedTable(spark, f"{self.root}/silver/listings", M.LISTING)

    # -- bronze ------------------------------------------------------------------------------------------------

    def _bronze_path(self, source: str) -> str:
        return f"{self.root}/bronze/{source}"

    def bronze_sources(self) -> list[str]:
        return sorted(folder_names(self.spark, f"{self.root}/bronze"))

    def _kept(self, source: str) -> KeptSchema:
        return KeptSchema(self.spark, self._bronze_path(source))

    def _bronze_schema(self, source: str) -> StructType | None:
        """The kept schema; of a source that was written before schemas were kept, that of its files."""
        if source not in self.bronze_sources():
            return None
        kept, path = self._kept(source).read(), self._bronze_path(source)
        if kept is None and any(name.startswith("_content_hash=") for name in folder_names(self.spark, path)):
            return self.spark.read.option("mergeSchema", "true").parquet(path).schema
        return kept

    def bronze(self, source: str, hashes: list[str] | None = None) -> DataFrame:
        """Rows of a source, of some files only if their content hashes are given; a source without accepted rows is empty."""
        schema = self._bronze_schema(source)
        if schema is None:
            raise ValueError(f"no such source: {source}")
        df = self.spark.read.schema(schema).parquet(self._bronze_path(source))
        return df if hashes is None else df.where(F.col("_content_hash").isin(hashes))

    def ingest(self, paths: list[str], *, source: str | None = None, max_file_bytes: int = FM.MAX_FILE_BYTES, max_field_bytes: int = 200_000, infer_rows: int | None = None, archive: bool = True, json_lines: bool = False) -> dict[str, str]:
        """Take in files; returns file name -> status, of several files of one name the worst (the log has their paths). A file
        seen before by content is skipped, a failed or partial one replayed.

        All files go to the one ``source`` if it is named, else each to that of its name. A new column gets the first type
        that all its values have; ``infer_rows`` looks at the first rows only, in the order of file and row, so that later
        values that don't fit are rejects. ``json_lines`` says that files named .json hold a record a line too. Whatever goes wrong with one source is its record's error and leaves the others alone.
        """
        run_id, started = uuid.uuid4().hex, utc_now()
        files = FM.with_dialect(FM.file_manifest(self.spark, paths, max_bytes=max_file_bytes)).withColumn("refusal", FM.refusal(max_file_bytes)).drop("head")
        done = latest_status(self.log.read().where("stage = 'ingest'"), "content_hash").where(F.col("status").isin(*DONE_INGEST)).select("content_hash", F.lit(True).alias("seen"))
        listed = files.join(done, "content_hash", "left").orderBy("path").collect()  # a row for each file
        records, work = [], []
        base = lambda f: {"run_id": run_id, "stage": "ingest", "started_at": started, "source_file": f.name, "source_path": f.path, "content_hash": f.content_hash, "rows_ok": 0, "rows_quarantined": 0}
        taken = set()
        for f in listed:
            if f.refusal:
                records.append(base(f) | {"status": "failed", "error_message": f.refusal})
            elif f.seen or f.content_hash in taken:
                records.append(base(f) | {"status": "skipped"})
            else:
                taken.add(f.content_hash)
                work.append(f)
        outcome: dict[str, dict] = {f.content_hash: {"ok": 0, "bad": 0, "tables": set(), "schemas": {}, "error": None} for f in work}
        groups: dict[tuple, list] = defaultdict(list)
        with isolated(outcome, list(outcome)):
            headers = FM.first_records(self.spark, {f.path: f.encoding for f in work if f.suffix == "csv" and f.header is None})
            for f in work:
                stem = clean_name(source or f.name.rsplit(".", 1)[0]) or "source"
                groups[(f.suffix, stem, f.encoding, f.delimiter, headers.get(f.path, f.header)) if f.suffix == "csv" else (f.suffix, stem)].append(f)
            if archive and work:
                FM.archive_raw(self.spark, [f.path for f in work], f"{self.root}/raw")
            for kind, members in groups.items():
                with isolated(outcome, [f.content_hash for f in members]):
                    for name, raw, hashes in self._tables(kind, members, outcome, json_lines):
                        with isolated(outcome, hashes):
                            mine = set(hashes)
                            taken_in, rejected, kinds = self._load(name, raw, [f for f in members if f.content_hash in mine], run_id, started, max_field_bytes, infer_rows)
                            for h in hashes:
                                outcome[h]["ok"] += taken_in.get(h, 0)
                                outcome[h]["bad"] += rejected.get(h, 0)
                                outcome[h]["tables"].add(name)
                                outcome[h]["schemas"][name] = kinds
        for f in work:
            o = outcome[f.content_hash]
            records.append(base(f) | {"target_table": ",".join(sorted(o["tables"])), "rows_ok": o["ok"], "rows_quarantined": o["bad"], "schema_json": json.dumps(o["schemas"], ensure_ascii=False), "status": status_of(o["bad"], o["error"]), "error_message": o["error"]})
        self._finish(records)
        states: dict[str, set[str]] = defaultdict(set)
        for r in records:
            states[r["source_file"]].add(r["status"])
        return {name: worst(s) for name, s in states.items()}

    def _finish(self, records: list[dict]) -> None:
        now = utc_now()
        self.log.append([r | {"finished_at": now} for r in records])

    def _tables(self, kind: tuple, files: list, outcome: dict, json_lines: bool):
        """(source, text rows, content hashes) of the logical tables in files of one suffix, name, dialect and header."""
        suffix, stem, *dialect = kind
        suffix = "jsonl" if suffix == "json" and json_lines else suffix
        paths, hashes = [f.path for f in files], [f.content_hash for f in files]
        by_path = {SR.plain_path(f.path): f for f in files}
        if suffix == "csv":
            encoding, delimiter, header = dialect
            names, read = SR.header_names(header, delimiter), {"delimiter": delimiter, "encoding": encoding}
            large = [f.path for f in files if f.bytes > SPLIT_BYTES]
            parts = [read_csv_splits(self.spark, large, names, **read)] if large else []
            if small := [f.path for f in files if f.bytes <= SPLIT_BYTES]:
                parts.append(SR.read_csv(self.spark, small, names, **read))
            yield stem, reduce(DataFrame.unionByName, parts), hashes
        elif suffix == "xlsx":
            # workbooks are parsed once; sheets are then read from the parsed rows
            parsed = f"{self.root}/ops/workbooks/{uuid.uuid4().hex}"
            SR.read_workbooks(self.spark, paths).write.parquet(parsed)
            books = self.spark.read.parquet(parsed)
            try:
                broken = [p for (p,) in books.where("sheet IS NULL").select(SR.FILE).distinct().collect()]  # a row for each file
                for p in broken:
                    outcome[by_path[p].content_hash]["error"] = "not a readable workbook"
                for r in SR.sheet_headers(books.where(~F.col(SR.FILE).isin(broken)) if broken else books).orderBy(SR.FILE, "sheet").collect():  # a row for each sheet
                    name = clean_name(f"{stem}_{r.sheet}") or stem
                    yield name, SR.sheet_table(books, r[SR.FILE], r.sheet, r.header_row, r.names), [by_path[r[SR.FILE]].content_hash]
            finally:
                delete_folder(self.spark, parsed)
        else:
            lines = suffix != "json"
            large = tuple(f.path for f in files if f.bytes > ARRAY_BYTES)
            broken = {r[0] for r in SR.broken_json_files(self.spark, paths, lines=lines, large=large).collect()}
            for p in broken:
                outcome[by_path[p].content_hash]["error"] = "a record is not a JSON object"
            good = [f for p, f in by_path.items() if p not in broken]
            if good:
                yield stem, SR.read_json(self.spark, [f.path for f in good], lines=lines, large=tuple(f.path for f in good if f.path in large)), [f.content_hash for f in good]

    def _load(self, source: str, raw: DataFrame, files: list, run_id: str, started, max_field_bytes: int, infer_rows: int | None) -> tuple[dict[str, int], dict[str, int], dict[str, str]]:
        """Type, split and write one source; returns rows and rejects by content hash, and the columns' types.

        The files' partitions are replaced in bronze and in quarantine: one without new rows is emptied. The source's schema
        is kept before its first row is; files without any row make no source.
        """
        columns = [c for c in raw.columns if c not in (SR.FILE, SR.ORDINAL)]
        known = self.spark.createDataFrame([(SR.plain_path(f.path), f.content_hash, f.name) for f in files], "_p string, _content_hash string, _source_file string")
        known = F.broadcast(known) if sum(len(f.path) + len(f.name) + 200 for f in files) <= BROADCAST_NAMES else known.hint("merge")
        rows = raw.join(known, F.col(SR.FILE) == F.col("_p")).drop("_p").persist()
        try:
            table = self._bronze_schema(source)
            kinds = infer_types(rows if infer_rows is None else rows.orderBy(SR.FILE, SR.ORDINAL).limit(infer_rows), columns)
            if table is not None:
                # the table's type is tried first: a value that doesn't fit it is a reject, unless the batch's own type conflicts
                batch = self.spark.createDataFrame([], ", ".join(f"`{c}` {kinds[c]}" for c in columns)).schema
                whole = merged_schema(table, batch)
                kinds |= {f.name: f.dataType.simpleString() for f in table if f.name in columns and f.dataType.simpleString() in (*SR_KINDS, TEXT)}
            elif not rows.head(1):
                return {}, {}, kinds
            else:
                whole = None
            rules, typed = [(R.oversize(columns, max_field_bytes), f"a cell is larger than {max_field_bytes} bytes")], {}
            for c in columns:
                typed[c], failed = coerce(F.col(f"`{c}`"), kinds[c])
                rules.append((failed, f"{c}: not a {kinds[c]}"))
            judged = rows.drop(SR.FILE).withColumn(R.REASON, R.first_reason(rules))
            service = [F.lit(run_id).alias("_run_id"), "_source_file", F.lit(started).cast("timestamp_ntz").alias("_ingested_at"), SR.ORDINAL, "_content_hash"]
            valid = judged.where(F.col(R.REASON).isNull()).select(*(typed[c].alias(c) for c in columns), *service)
            kept = merged_schema(whole, valid.schema)
            self._kept(source).write(kept)
            aligned(valid, kept).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_content_hash").parquet(self._bronze_path(source))
            self.quarantine.put(reject_rows(judged.where(F.col(R.REASON).isNotNull()), columns, layer="bronze", source=source, run_id=run_id, now=F.lit(utc_now()).cast("timestamp_ntz")))
        finally:
            rows.unpersist()
        # what was written is counted, file by file, from the tables themselves
        hashes = [f.content_hash for f in files]
        mine = self.bronze(source, hashes if len(hashes) <= PRUNED_FILES else None).where(F.col("_run_id") == run_id).groupBy("_content_hash").count()
        ok, bad = {r["_content_hash"]: r["count"] for r in mine.collect()}, self.quarantine.counts("bronze", source, run_id)  # a row for each file
        clear_partitions(self.spark, self._bronze_path(source), "_content_hash", [h for h in hashes if h not in ok])
        self.quarantine.clear("bronze", source, [h for h in hashes if h not in bad])
        return ok, bad, kinds

    # -- silver ------------------------------------------------------------------------------------------------

    def transform(self, mappings: dict[str, str], *, source: str | None = None, reprocess: bool = False) -> dict[str, str]:
        """Normalise pending files of each source by its mapping text; returns source -> status.

        Whatever goes wrong with one source is its record's error and leaves the others alone.
        A mapping that changed since the last run stops its source until it is reprocessed. Reprocessing recomputes a
        source from all its bronze rows and leaves other sources alone.
        """
        run_id, started, result, records = uuid.uuid4().hex, utc_now(), {}, []
        for s in [source] if source else self.bronze_sources():
            base = {"run_id": run_id, "stage": "transform", "started_at": started, "source_file": s, "target_table": "listings", "rows_ok": 0, "rows_quarantined": 0}
            if s not in mappings:
                records.append(base | {"status": "skipped", "error_message": "no mapping"})
                result[s] = "skipped"
                continue
            try:
                made = self._transform_source(s, M.parse_mapping(mappings[s]), run_id, reprocess)
                records += [base | m for m in made]
                states = {m["status"] for m in made}
                result[s] = "partial" if "partial" in states else "success"
            except Exception as e:  # noqa: BLE001 - whatever it is, it is this source's record
                records.append(base | {"status": "failed", "error_message": error_text(e)})
                result[s] = "failed"
        self._finish(records)
        return result

    def _transform_source(self, source: str, mapping: M.Mapping, run_id: str, reprocess: bool) -> list[dict]:
        schema = self._bronze_schema(source)
        if schema is None:
            raise M.MappingError(f"no such source: {source}")
        bronze = self.spark.read.schema(schema).parquet(self._bronze_path(source))
        M.check_inputs(mapping, bronze.columns)
        log = self.log.read()
        if not reprocess and stale_sources(log, self.spark.createDataFrame([(source, mapping.fingerprint)], "source string, fingerprint string")).head(1):
            raise M.MappingError("the mapping has changed: reprocess the source")
        parts = bronze.select(F.col("_content_hash").alias("content_hash")).where("content_hash <> ''").distinct()
        done = latest_status(log.where((F.col("stage") == "transform") & (F.col("source_file") == source) & F.col("content_hash").isNotNull()), "content_hash").where(F.col("status").isin(*DONE_TRANSFORM))
        todo = parts if reprocess else R.pending(parts, done, ["content_hash"])
        pending = [r[0] for r in todo.limit(PRUNED_FILES + 1).collect()]
        if not pending:
            return []
        # few files are named, so that the scan reads their partitions alone
        rows = bronze.where(F.col("_content_hash").isin(pending)) if len(pending) <= PRUNED_FILES else bronze.join(todo, bronze["_content_hash"] == todo["content_hash"], "left_semi")
        mapped = M.apply_mapping(rows, mapping, source, run_id=run_id, now=F.lit(utc_now()).cast("timestamp_ntz")).persist()
        try:
            good = mapped.where(F.col(R.REASON).isNull()).select("_listing.*", F.col("_row_ordinal"))
            # a key counts once, in the file that holds its latest row, also where rows of several files have it
            order = ("_ingested_at", "_source_content_hash", "_row_ordinal")
            latest = R.latest_per_key(good.select(*M.KEY, *order), M.KEY, *order).groupBy(F.col("_source_content_hash").alias("_content_hash")).agg(F.count(F.lit(1)).alias("keys"))
            judged = mapped.groupBy("_content_hash").agg(F.count_if(F.col(R.REASON).isNull()).alias("ok"), F.count_if(F.col(R.REASON).isNotNull()).alias("bad"))
            counts = judged.join(latest, "_content_hash", "left").select("_content_hash", "ok", "bad", F.coalesce("keys", F.lit(0))).collect()  # a row for each file
            if not counts:
                return []
            # a source that isn't divided like this yet is written whole once
            whole = reprocess or self.silver.buckets(source) != self.silver_buckets
            touched = [] if whole else [f"{source}#{r[0]}" for r in good.select(bucket_of(M.KEY, self.silver_buckets)).distinct().collect()]  # buckets at most
            before = self.spark.createDataFrame([], M.LISTING) if reprocess else self.silver.read(parts=[source] if whole else touched)
            merged = R.latest_wins(before, good, M.KEY, *order)
            seen = Observation()
            changes = merged.observe(seen, *(F.count_if(F.col("_change") == c).alias(c) for c in ("inserted", "updated")))
            self.silver.publish_buckets(changes.drop("_change"), source, M.KEY, self.silver_buckets, whole=whole)
            # a plan without updates is cut down to the former rows, and nothing is observed
            inserted, updated = (seen.get["inserted"], seen.get["updated"]) if any(ok for _, ok, *_ in counts) else (0, 0)
            columns = [c for c in rows.columns if c not in SERVICE]
            self.quarantine.put(reject_rows(mapped.where(F.col(R.REASON).isNotNull()), columns, layer="silver", source=source, run_id=run_id, now=F.lit(utc_now()).cast("timestamp_ntz")))
            # only after the new rejects are there
            self.quarantine.clear("silver", source, [h for h, _, bad, _ in counts if not bad])
        finally:
            mapped.unpersist()
        # what the run did to the table stands in its first record; keys that it changed nothing by are the rest of them
        change = {"rows_inserted": inserted, "rows_updated": updated, "rows_unchanged": sum(keys for *_, keys in counts) - inserted - updated}
        rest = dict.fromkeys(change, 0)
        return [{"content_hash": h, "rows_ok": keys, "rows_quarantined": bad, "rows_deduplicated": ok - keys, "schema_json": M.schema_json(mapping), "status": status_of(bad, None)} | (rest if i else change) for i, (h, ok, bad, keys) in enumerate(counts)]

    # -- gold and export ---------------------------------------------------------------------------------------

    def build_gold(self, only: list[str] | None = None, *, small_sample: int = 3) -> dict[str, int]:
        """Rebuild marts and features from one pinned snapshot; returns table -> rows. A new version appears whole.

        Style groups of fewer than ``small_sample`` listings are marked. A table that fails keeps its former version and gets a
        failed record; the others are built.
        """
        if unknown := sorted({*(only or ())} - {*MARTS, "features"}):
            raise ValueError(f"no such table: {unknown}")
        run_id, started, pinned, records, rows = uuid.uuid4().hex, utc_now(), self.silver.snapshot(), [], {}
        silver, now = self.silver.read(pinned), F.lit(started).cast("timestamp_ntz")
        options = {"mart_style_renovation_furniture": {"small_sample": small_sample}}
        plans = {n: f(silver, **options.get(n, {})).withColumn("_computed_at", now).withColumn("_gold_run_id", F.lit(run_id)) for n, f in MARTS.items()}
        plans["features"] = feature_table(silver, snapshot=snapshot_id(pinned), run_id=run_id, now=now)
        for name, df in plans.items():
            if only and name not in only:
                continue
            record = {"run_id": run_id, "stage": "gold", "started_at": started, "target_table": name, "rows_ok": 0, "rows_quarantined": 0}
            try:
                table = VersionedTable(self.spark, f"{self.root}/gold/{name}", df.schema)
                rows[name] = table.read(table.publish(df)).count()
                records.append(record | {"rows_ok": rows[name], "status": "success"})
            except Exception as e:  # noqa: BLE001 - whatever it is, it is this table's record
                records.append(record | {"status": "failed", "error_message": error_text(e)})
        self._finish(records)
        return rows

    def gold(self, name: str) -> DataFrame:
        plan = MARTS[name](self.silver.read({})) if name in MARTS else feature_table(self.silver.read({}), snapshot="", run_id="", now=F.lit(utc_now()).cast("timestamp_ntz"))
        schema = plan.schema if name not in MARTS else plan.withColumn("_computed_at", F.lit(utc_now()).cast("timestamp_ntz")).withColumn("_gold_run_id", F.lit("")).schema
        return VersionedTable(self.spark, f"{self.root}/gold/{name}", schema).read()

    def export(self, formats: tuple[str, ...] = ("parquet", "jsonl")) -> str:
        """Export the feature table as the next dataset version."""
        started, record = utc_now(), {"run_id": uuid.uuid4().hex, "stage": "export", "rows_ok": 0, "rows_quarantined": 0}
        try:
            features = self.gold("features")
            version = export_dataset(features, f"{self.root}/datasets", target=TARGET, snapshot=snapshot_id(self.silver.snapshot()), formats=formats)
            self._finish([record | {"started_at": started, "target_table": f"datasets/{version}", "rows_ok": features.count(), "status": "success"}])
        except Exception as e:
            self._finish([record | {"started_at": started, "target_table": "datasets", "status": "failed", "error_message": error_text(e)}])
            raise
        return version


SR_KINDS = ("boolean", "bigint", "double", "date", "timestamp_ntz")
