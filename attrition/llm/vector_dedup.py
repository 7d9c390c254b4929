"""Near-duplicate vectors by an exact metric range join.

Unit vectors with cosine c lie sqrt(2 - 2c) apart. Per label, pivots cut the
vectors into cells: each vector lives in the cell of its nearest pivot and is
also sent to every cell whose pivot the triangle inequality does not rule out
for a partner. All partners of a vector then are in its own cell. Cells are
joined independently, in pairs of blocks of bounded size; copies were collapsed
before, and only counts and a spanning forest of the links leave a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.components import components
from attrition.llm.scratch import store

# Pivots of all labels together, and sampled vectors to choose each from: what the driver holds and broadcasts.
PIVOTS, SAMPLED = 1024, 8
# Vectors a cell should have; cells a vector may be sent to on average; rows of one side of a block pair.
CELL, COPIES, BLOCK = 2000, 4.0, 4000
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Not null, not zero, no null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def needed(distance: np.ndarray, radius: float) -> np.ndarray:
    """Cells in which a vector may have a partner, from its distances to the pivots.

    A partner y whose nearest pivot is p has d(x, p) <= d(y, p) + r <= d(y, h) + r <= d(x, h) + 2 r,
    h being the pivot nearest to x.
    """
    return distance <= distance.min(axis=1, keepdims=True) + 2 * radius + SLACK


def choose_pivots(sample: np.ndarray, wanted: int, radius: float) -> np.ndarray:
    """Pivots of one label, each the farthest from those before; fewer if vectors would go to too many cells."""
    chosen, nearest = [0], apart(sample, sample[:1])[:, 0]
    while len(chosen) < wanted and nearest.max() > 2 * radius:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, apart(sample, sample[chosen[-1:]])[:, 0])
    distance = apart(sample, sample[chosen])
    count = len(chosen)
    while count > 1 and needed(distance[:, :count], radius).sum(axis=1).mean() > COPIES:
        count //= 2
    return sample[chosen[:count]]


def _pivots(distinct: DataFrame, radius: float, cell: int) -> dict:
    """Pivots by (label, length), for labels with enough of all vectors to be cut; at most PIVOTS in all."""
    total = distinct.count()
    share = F.floor(F.lit(PIVOTS) * F.col("size") / F.lit(max(total, 1)))
    sizes = distinct.groupBy("label", "dim").agg(F.count("*").alias("size"))
    wanted = sizes.withColumn("wanted", F.least(share, F.ceil(F.col("size") / cell))).where("wanted >= 2")  # at most PIVOTS / 2 rows
    fraction = F.least(F.lit(1.0), SAMPLED * F.col("wanted") / F.col("size"))
    spot = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) / float(1 << 30)
    sample = distinct.join(F.broadcast(wanted), ["label", "dim"]).where(spot < fraction)
    rows = sample.select("label", "dim", "wanted", "vector", F.xxhash64("vector").alias("h")).toArrow().to_pylist()
    found: dict = {}
    for row in sorted(rows, key=lambda r: (r["h"], r["vector"])):
        found.setdefault((row["label"], row["dim"], row["wanted"]), []).append(row["vector"])
    return {(label, dim): choose_pivots(unit(np.array(v, np.float64)), k, radius) for (label, dim, k), v in found.items()}


def _assigner(shared, radius: float):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            rows = batch.to_pydict()
            out: list[tuple] = []
            groups: dict = {}
            for i, key in enumerate(zip(rows["label"], rows["dim"])):
                groups.setdefault(key, []).append(i)
            for key, members in groups.items():
                units = unit(np.array([rows["vector"][i] for i in members], np.float64))
                if key in pivots:
                    distance = apart(units, pivots[key])
                    home, sent = distance.argmin(axis=1), needed(distance, radius)
                else:
                    home, sent = np.zeros(len(members), np.int64), np.ones((len(members), 1), bool)
                for at, cell in zip(*np.nonzero(sent)):
                    i = members[at]
                    out.append((*key, int(cell), rows["key"][i], rows["n"][i], bool(home[at] == cell), units[at].tobytes()))
            kinds = [batch.schema.field("label").type, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["label", "dim", "cell", "key", "n", "home", "unit"])

    return assign


def forest(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row and column of links that connect all that ``linked`` connects, each row and column added once."""
    rows_left, columns_left = linked.any(axis=1), np.ones(linked.shape[1], bool)
    for first in np.flatnonzero(rows_left).tolist():
        if not rows_left[first]:
            continue
        rows_left[first] = False
        todo = [first]
        while todo:
            row = todo.pop()
            columns = np.flatnonzero(linked[row] & columns_left)
            columns_left[columns] = False
            for column in columns.tolist():
                yield row, column
                more = np.flatnonzero(linked[:, column] & rows_left)
                rows_left[more] = False
                for other in more.tolist():
                    yield other, column
                todo += more.tolist()


def _joiner(cosine: float):
    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        home, all_in = pdf[pdf["home"]], pdf[~pdf["home"]]
        if not len(home) or not len(all_in):
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
        left = np.frombuffer(b"".join(home["unit"]), np.float64).reshape(-1, dim)
        right = np.frombuffer(b"".join(all_in["unit"]), np.float64).reshape(-1, dim)
        left_keys, right_keys = home["key"].to_numpy(), all_in["key"].to_numpy()
        linked = np.empty((len(left), len(right)), bool)
        for at in range(0, len(left), 512):
            linked[at : at + 512] = left[at : at + 512] @ right.T >= cosine
        linked &= left_keys[:, None] != right_keys[None, :]
        n = linked @ all_in["n"].to_numpy()
        some = n > 0
        counts = pd.DataFrame({"a": left_keys[some], "b": left_keys[some], "n": n[some]})
        pairs = np.array(list(forest(linked)), np.int64).reshape(-1, 2)
        return pd.concat([counts, pd.DataFrame({"a": left_keys[pairs[:, 0]], "b": right_keys[pairs[:, 1]], "n": 0})])

    return join


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors(vec_id, embedding, label)``.

    Rows are linked when their labels are equal and not null, their vectors equally long
    and the cosine in double precision is ``cosine`` or more (which has to be positive).
    Rows without an id, and vectors that are null, zero or hold null or non-finite
    components, link with nothing. Each row counts as a vector, so repeated rows link with
    each other. ``component_id`` is the smallest id reachable; an empty table gives no rows.
    """
    radius = float(np.sqrt(2 - 2 * cosine))
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("vector"))
    good = rows.where(usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    copies = good.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    # Numbers stay as they are once the table is written.
    distinct = store(copies.withColumn("dim", F.size("vector")).withColumn("key", F.monotonically_increasing_id()), "vectors")
    shared = vectors.sparkSession.sparkContext.broadcast(_pivots(distinct, radius, cell))
    label = distinct.schema["label"].dataType.simpleString()
    assigned = store(
        distinct.select("label", "dim", "vector", "key", "n").mapInArrow(
            _assigner(shared, radius), f"label {label}, dim int, cell int, key long, n long, home boolean, unit binary"
        ),
        "cells",
    )
    place = ["label", "dim", "cell"]
    sizes = assigned.groupBy(place).agg(
        F.ceil(F.sum(F.col("home").cast("int")) / block).cast("int").alias("lefts"), F.ceil(F.count("*") / block).cast("int").alias("rights")
    )
    sized = assigned.join(store(sizes, "cell-sizes"), place)
    own_left, own_right = F.pmod(F.xxhash64("key"), "lefts").cast("int"), F.pmod(F.xxhash64(F.lit(1), "key"), "rights").cast("int")
    columns = [*place, "key", "n", "unit"]
    lefts = sized.where("home").select(*columns, F.lit(True).alias("home"), own_left.alias("l"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("r"))
    rights = sized.where("lefts > 0").select(*columns, F.lit(False).alias("home"), F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("l"), own_right.alias("r"))
    joined = lefts.union(rights).groupBy(*place, "l", "r").applyInPandas(_joiner(cosine), "a long, b long, n long")
    found = store(joined, "vector-links")

    counts = found.where("a = b").groupBy("a").agg(F.sum("n").alias("linked"))
    roots = components(found.where("a <> b").select("a", "b"))
    judged = distinct.join(counts.withColumnRenamed("a", "key"), "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
    judged = store(
        judged.select(
            "label", "vector", "least", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("root", "key").alias("root")
        ),
        "vector-roots",
    )
    named = store(judged.groupBy("root").agg(F.min("least").alias("component_id")), "vector-names")
    classes = store(judged.join(named, "root").select("label", "vector", "n_links", "component_id"), "vector-classes")
    joined = rows.withColumn("ok", usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    joined = joined.withColumn("vector", F.when(F.col("ok"), F.col("vector"))).join(classes, ["label", "vector"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
