"""A refresh that becomes visible at once.

Every run writes its layers to folders of its own version; nothing that a
reader may be reading is touched. A manifest says which version each snapshot
of each layer, and the marts, come from. The run's last act is to write the
next manifest, a small file that appears by one rename: readers see the whole
run or none of it. A run that dies leaves folders that no manifest names
(``remove_unpublished`` deletes them) and the old version readable.

    <root>/<layer>/version=<run>/<date column>=<date>/...
    <root>/marts/version=<run>/<table>/...
    <root>/manifest/<number>.json
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from immolens.operators.gold import to_gold
from immolens.operators.quality import freshness, snapshot_loaded_at
from immolens.plans.refresh import SILVER_COMPRESSION, NoListingsError, RefreshResult, marts_of, pages_to_silver
from immolens.schema import GOLD, GOLD_COLUMNS, SILVER
from immolens.session import remove_folder, scratch
from immolens.sources.files import SILVER_DATE, write_gold, write_history, write_silver

# Layers and their date columns.
LAYERS = {"silver": SILVER_DATE, "gold": "date_scraping", "history": "date_scraping"}


class PublishedMeanwhileError(RuntimeError):
    """Another run published first; this run's work is not visible."""


@dataclass
class Manifest:
    """Versions by layer and date (ISO text), and the marts' version."""
    number: int = 0
    layers: dict[str, dict[str, str]] = field(default_factory=lambda: {layer: {} for layer in LAYERS})
    marts: str | None = None

    def dates(self, layer: str) -> list[dt.date]:
        return sorted(dt.date.fromisoformat(d) for d in self.layers[layer])


class Store:
    """The layers under a root (any Hadoop-compatible URI)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm

    def _path(self, text: str):
        path = self._jvm.org.apache.hadoop.fs.Path(text)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, fs = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    # ---------------------------------------------------------- manifest
    def manifest(self) -> Manifest:
        """The newest manifest (an empty one before the first run)."""
        numbers = [int(n[:-5]) for n in self._names(f"{self.root}/manifest") if n.endswith(".json")]
        if not numbers:
            return Manifest()
        path, fs = self._path(f"{self.root}/manifest/{max(numbers):012d}.json")
        stream = fs.open(path)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def publish(self, new: Manifest) -> None:
        """Makes ``new`` the manifest; its number must follow the newest one."""
        folder = f"{self.root}/manifest"
        draft, fs = self._path(f"{folder}/_draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(new.__dict__, sort_keys=True), "utf-8"))
        finally:
            out.close()
        final, _ = self._path(f"{folder}/{new.number:012d}.json")
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise PublishedMeanwhileError(f"manifest {new.number} exists")

    # ------------------------------------------------------------ layers
    def folder(self, layer: str, version: str) -> str:
        return f"{self.root}/{layer}/version={version}"

    def read(self, layer: str, manifest: Manifest | None = None, dates: list[dt.date] | None = None) -> DataFrame:
        """A layer as published (all snapshots, or some). The read names the
        snapshots' folders, so later runs do not change it."""
        versions = (manifest or self.manifest()).layers[layer]
        if dates is not None:
            versions = {d: v for d, v in versions.items() if dt.date.fromisoformat(d) in dates}
        fields = GOLD if layer != "silver" else T.StructType([*SILVER.fields, T.StructField(SILVER_DATE, T.DateType())])
        if not versions:
            return self.spark.createDataFrame([], fields)
        paths = [f"{self.folder(layer, v)}/{LAYERS[layer]}={d}" for d, v in sorted(versions.items())]
        reader = (self.spark.read.schema(T.StructType([*fields.fields, T.StructField("version", T.StringType())]))
                  .option("basePath", f"{self.root}/{layer}"))
        if layer == "silver":
            rows = (reader.option("header", True).option("escape", '"').option("mode", "FAILFAST").option("multiLine", True)
                    .csv(paths))
        else:
            rows = reader.parquet(*paths)
        return rows.select(*fields.fieldNames())

    def read_mart(self, name: str) -> DataFrame:
        version = self.manifest().marts
        if version is None:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        return self.spark.read.parquet(f"{self.folder('marts', version)}/{name}")

    def remove_unpublished(self) -> list[str]:
        """Deletes the version folders that the newest manifest does not name;
        for times when no run is under way and no reader holds an older
        version. Returns them."""
        now, gone = self.manifest(), []
        for layer in (*LAYERS, "marts"):
            used = {now.marts} if layer == "marts" else set(now.layers[layer].values())
            for name in self._names(f"{self.root}/{layer}"):
                if name.startswith("version=") and name.removeprefix("version=") not in used:
                    gone.append(f"{self.root}/{layer}/{name}")
                    remove_folder(self.spark, gone[-1])
        return gone


def publish_refresh(spark: SparkSession, root: str, pages: DataFrame, origin: str, as_of, number_style: str = "plain",
                    fail_on_checks: bool = True, percentile_method: str = "exact") -> RefreshResult:
    """R1, R2 with one switch at the end: the snapshots of ``pages`` go through
    Silver, Gold and History, the marts are built over the published History
    with these snapshots replaced, and then all of it is published. A stale
    history or failing checks publish nothing."""
    store, run = Store(spark, root), uuid.uuid4().hex
    old = store.manifest()
    new = Manifest(old.number + 1, {layer: dict(v) for layer, v in old.layers.items()}, run)
    with scratch(spark, "parsed") as folder:
        extracted, errors = pages_to_silver(pages, origin, folder)
        write_silver(extracted, store.folder("silver", run), compression=SILVER_COMPRESSION)
        dates = sorted(r[0] for r in extracted.select(SILVER_DATE).distinct().collect() if r[0] is not None)
        parse_errors = errors.count()
    if not dates:
        raise NoListingsError(f"no listings in the pages for {root}")

    def take(layer: str) -> None:
        new.layers[layer].update({d.isoformat(): run for d in dates})

    take("silver")
    write_gold(to_gold(store.read("silver", new, dates), F.col(SILVER_DATE), number_style=number_style), store.folder("gold", run))
    take("gold")
    write_history(store.read("gold", new, dates).select(*GOLD_COLUMNS), store.folder("history", run))
    take("history")
    known = spark.createDataFrame([(d,) for d in new.dates("history")], "date_scraping date")      # one row a snapshot
    fresh = freshness(known, snapshot_loaded_at(), as_of).first().asDict()
    result = marts_of(spark, store.read("history", new), fresh, f"{store.root}/states", store.folder("marts", run),
                      fail_on_checks, percentile_method)
    store.publish(new)
    result.parse_errors = parse_errors
    return result
