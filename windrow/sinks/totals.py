"""Running totals as a snapshot and the changes since.

    deltas/batch_id=<n>      the totals that micro-batch n changed
    commits/<n>              micro-batch n is complete
    snapshots/<n>-<id>       all totals as they were after micro-batch n
    manifests/<k>            which snapshot holds, and up to which micro-batch

Readers take the newest manifest, its snapshot, and the complete changes behind it. Folding writes a new snapshot
beside the old one and then one manifest, in one step; whoever reads meanwhile sees the state before or
after, which is the same. Folding twice to the same point, or again after a failure, leaves a snapshot that no manifest
names. `remove_folded` clears what the newest manifest does not need.

With a fold every so often, a reader touches each key once and the changes of a few micro-batches, however long the stream has run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from windrow.sinks.commits import last_commit, publish, published, read_published, remove
from windrow.streaming.queries import batch_folder_sink, fan_out


def start_totals(totals: DataFrame, path: str, *, checkpoint: str, every: str | None = None, name: str | None = None) -> StreamingQuery:
    """Log the changes of a running count, visible by micro-batch."""
    sinks = [batch_folder_sink(f"{path}/deltas")]
    return fan_out(totals, sinks, checkpoint=checkpoint, mode="update", every=every, name=name, commits=f"{path}/commits")


def manifest(spark: SparkSession, path: str) -> dict:
    """`snapshot` (a folder's name or None) and `upto` (the last micro-batch in it, -1 before the first fold)."""
    names = published(spark, f"{path}/manifests")
    return json.loads(read_published(spark, f"{path}/manifests", names[-1])) if names else {"snapshot": None, "upto": -1}


def _totals(spark: SparkSession, path: str, keys: Sequence[str], value: str, state: dict, upto: int) -> DataFrame:
    def changes(schema=None) -> DataFrame:
        reader = spark.read if schema is None else spark.read.schema(schema)
        # the folders of micro-batches outside are not listed further
        return reader.parquet(f"{path}/deltas").filter((F.col("batch_id") > state["upto"]) & (F.col("batch_id") <= upto))

    if state["snapshot"] is None:
        rows = changes().select(*keys, value, "batch_id")
    else:
        snapshot = spark.read.parquet(f"{path}/snapshots/{state['snapshot']}")
        rows = snapshot.select(*keys, value, F.lit(state["upto"]).alias("batch_id"))
        if upto > state["upto"]:
            rows = rows.unionByName(changes(f"{','.join(f'`{f.name}` {f.dataType.simpleString()}' for f in snapshot.schema.fields)}, batch_id int"))
    return rows.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))


def read_totals(spark: SparkSession, path: str, keys: Sequence[str], value: str = "cnt") -> DataFrame:
    """The total of each key after the last complete micro-batch."""
    upto = last_commit(spark, f"{path}/commits")
    return _totals(spark, path, keys, value, manifest(spark, path), upto)


def fold_totals(spark: SparkSession, path: str, keys: Sequence[str], value: str = "cnt") -> bool:
    """Fold the complete changes into a new snapshot; False if there are none or another fold was faster."""
    names, upto = published(spark, f"{path}/manifests"), last_commit(spark, f"{path}/commits")
    state = json.loads(read_published(spark, f"{path}/manifests", names[-1])) if names else {"snapshot": None, "upto": -1}
    if upto <= state["upto"]:
        return False
    snapshot = f"{upto:012d}-{uuid.uuid4().hex}"
    _totals(spark, path, keys, value, state, upto).write.parquet(f"{path}/snapshots/{snapshot}")
    number = int(names[-1]) + 1 if names else 0
    return publish(spark, f"{path}/manifests", f"{number:012d}", json.dumps({"snapshot": snapshot, "upto": upto}))


def remove_folded(spark: SparkSession, path: str) -> None:
    """Remove the snapshots and changes that the newest manifest does not need. Run it when no reader of an older one is left."""
    state = manifest(spark, path)
    if state["snapshot"] is None:
        return
    for name in published(spark, f"{path}/snapshots"):
        if name != state["snapshot"] and int(name.split("-")[0]) <= state["upto"]:
            remove(spark, f"{path}/snapshots/{name}")
    for name in published(spark, f"{path}/deltas"):
        if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= state["upto"]:
            remove(spark, f"{path}/deltas/{name}")
