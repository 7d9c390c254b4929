"""The medallion build, one written table per layer."""

from __future__ import annotations

import glob
import hashlib
import os
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from attrition.operators import checks, gold, silver
from attrition.operators.filters import PARTITION
from attrition.session import bound_tasks, delete, shared_dir
from attrition.sources import feed, landing, subscribers

# Each layer, in load order, from the layers it reads.
_BUILDERS = {
    "bronze": lambda w: subscribers.read_bronze(w.spark, w.source),
    "silver": lambda w: silver.build_silver(w["bronze"]),
    "feed": lambda w: feed.build_feed(w["silver"]),
    "dim_customer": lambda w: gold.build_dim_customer(w["silver"]),
    "dim_contract": lambda w: gold.build_dim_contract(w["silver"]),
    "dim_service": lambda w: gold.build_dim_service(w.spark),
    "keyed": lambda w: gold.key_subscribers(gold.fact_columns(w["silver"]), w["dim_customer"]),
    "fact_customer_service": lambda w: gold.build_fact_customer_service(w["keyed"], w["dim_service"]),
    "fact_churn": lambda w: gold.build_fact_churn(w["keyed"], w["dim_contract"]),
    "profile": lambda w: gold.build_customer_profile(w["dim_customer"], w["fact_customer_service"]),
    "model": lambda w: gold.build_model(w["fact_churn"], w["dim_contract"], w["profile"]).selectExpr(
        "*", f"concat('=', State) AS {PARTITION}"
    ),
}
LAYERS = list(_BUILDERS)
# Row-level access reads the folders of the states a user may see.
PARTITIONED = {"model": PARTITION}
FACTS = ["keyed", "fact_customer_service", "fact_churn", "profile", "model"]


class Warehouse:
    """Tables under ``root``; a layer is built when first asked for and then read back.

    Reading a written table cuts the lineage, survives lost executors, gives the
    optimizer real sizes to choose broadcasts by, and lets scans prune columns. A layer
    counts as stored once its constraints hold and its entry in ``<root>/stored`` is
    written, so another session, or a later one, takes it over and never half of it.
    """

    def __init__(self, spark: SparkSession, source: str, root: str):
        self.spark, self.source, self.root = spark, source, root
        self._paths: dict[str, str] = {}
        self._frames: dict[str, DataFrame] = {}
        self.seconds: dict[str, float] = {}
        self._profiles = checks.Profiles(self)

    def adopt(self, other: Warehouse, layers: list[str]) -> None:
        """Read these layers from where another warehouse stored them."""
        for layer in layers:
            other[layer]
            self._paths[layer] = other._paths[layer]

    def __getitem__(self, layer: str) -> DataFrame:
        if layer not in self._paths and (path := self._stored(layer)):
            self._paths[layer] = path
        if layer not in self._paths:
            self.build(layer)
        if layer not in self._frames:
            self._frames[layer] = self.spark.read.parquet(self._paths[layer])
        return self._frames[layer]

    def _stored(self, layer: str) -> str | None:
        try:
            entries = self.spark.read.schema("path string").json(f"{self.root}/stored/{layer}").collect()  # one a build
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return max((row["path"] for row in entries), default=None)

    def build(self, layer: str) -> None:
        frame = _BUILDERS[layer](self)
        start = time.monotonic()
        path = f"{self.root}/{layer}-{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        # Nulls of required columns are counted on the way; what is left to check are keys.
        required, nulls = checks.required_columns(layer), Observation()
        if required:
            frame = frame.observe(nulls, *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        landing.write_table(frame, path, by=PARTITIONED.get(layer))
        self.seconds[layer] = time.monotonic() - start
        self._paths[layer] = path
        self._frames.pop(layer, None)
        self._profiles.forget(layer)
        try:
            checks.verify(layer, self, nulls.get if required else {}, self._profiles)
        except ValueError:
            del self._paths[layer]
            raise
        entry = self.spark.range(1).select(F.lit(path).alias("path"))
        entry.write.mode("append").json(f"{self.root}/stored/{layer}")

    def remove(self) -> None:
        """Delete all layers from the store."""
        delete(self.spark, self.root)
        self._paths, self._frames = {}, {}

    def build_all(self) -> None:
        """Full reload: dimensions before the facts that look their keys up."""
        for layer in LAYERS:
            self.build(layer)

    def reload_facts(self) -> None:
        """Facts only, against the stored dimensions."""
        for layer in FACTS:
            self.build(layer)


_OPEN: dict[tuple, Warehouse] = {}


_SEEN: dict[tuple, str] = {}


def _fingerprint(spark: SparkSession, sf_dir: str, refresh: bool) -> str:
    """Changes when an input file is added, replaced or removed.

    Files of a local folder are looked at each time. Listing a remote store takes a job, so
    that is done once in an application, or when asked for.
    """
    paths = [f"{sf_dir}/{name}.parquet" for name in subscribers.INPUT_TABLES]
    if all(os.path.exists(path) for path in paths):
        stats = []
        for path in paths:
            files = [path] if os.path.isfile(path) else glob.glob(f"{path}/**/*.parquet", recursive=True)
            stats += [(name, os.stat(name).st_size, os.stat(name).st_mtime_ns) for name in sorted(files)]
        return hashlib.md5(repr(stats).encode()).hexdigest()[:12]
    place = spark.sparkContext.applicationId, sf_dir
    if refresh or place not in _SEEN:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        marks = files.agg(F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")))
        _SEEN[place] = hashlib.md5(repr(marks.first()[0]).encode()).hexdigest()[:12]
    return _SEEN[place]


def code_mark() -> str:
    """Changes with the code that builds the layers, so that no session takes over an older code's."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    digest = hashlib.md5()
    for folder in ("", "functions", "operators", "plans", "sources"):
        for name in sorted(glob.glob(os.path.join(package, folder, "*.py"))):
            with open(name, "rb") as file:
                digest.update(file.read())
    return digest.hexdigest()[:12]


def open_warehouse(spark: SparkSession, sf_dir: str, refresh: bool = False) -> Warehouse:
    """The warehouse over ``sf_dir``, named by its input files and the code: layers another
    session has stored are read, changed inputs get a warehouse of their own.

    ``refresh`` looks at a remote store's files again; see ``_fingerprint``.
    """
    bound_tasks(spark)
    key = (spark.sparkContext.applicationId, sf_dir, _fingerprint(spark, sf_dir, refresh))
    if key not in _OPEN:
        name = hashlib.md5(repr(key[1:]).encode()).hexdigest()[:12]
        _OPEN[key] = Warehouse(spark, sf_dir, f"{shared_dir(spark)}/attrition/{code_mark()}-{name}")
    return _OPEN[key]
