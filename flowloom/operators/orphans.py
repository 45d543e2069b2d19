"""References to catalogue rows that never existed, are retired, or come later.

Keys are 64-bit hashes; the hash space is cut into equal ranges, one per shuffle partition. Each range holds
its parents as sorted arrays, and the references of the range stream past them in Arrow batches that are
probed by binary search. A second hash confirms each hit. Ranges that a hot key overfills are split by a
salt, with the parents of the range repeated for each split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.text import folded, month
from flowloom.session import parallelism, placement_keys

#: A range is split so that no part holds more than so many times the mean number of references.
SPLIT_ABOVE = 1.5
_CAUSES = np.array(["missing", "deleted", "later"])
_NEVER = np.iinfo(np.int64).max


def _range_of(k: Column, ranges: int) -> Column:
    """Range of a 64-bit hash, ascending with the hash."""
    return F.least(F.lit(ranges - 1), F.floor((k.cast("double") / F.lit(2.0**64) + 0.5) * ranges)).cast("int")


def _probe(parents: dict[str, np.ndarray], refs: dict[str, np.ndarray]) -> list[tuple[np.ndarray, int]]:
    """Indexes of the references with each cause. Parents are sorted by k1; kind 0 is a catalogue row, 1 a retirement."""
    n = len(refs["k1"])
    added, deleted = np.full(n, _NEVER), np.full(n, _NEVER)
    if len(parents["k1"]):
        at = np.searchsorted(parents["k1"], refs["k1"], "left")
        open_ = np.arange(n)
        while len(open_):  # as many turns as the code has rows: catalogue rows and a retirement
            i = at[open_]
            open_, i = open_[i < len(parents["k1"])], i[i < len(parents["k1"])]
            same = parents["k1"][i] == refs["k1"][open_]
            open_, i = open_[same], i[same]
            hit = parents["k2"][i] == refs["k2"][open_]
            row = hit & (parents["kind"][i] == 0) & (refs["any_db"][open_] | (parents["db"][i] == refs["db"][open_]))
            gone = hit & (parents["kind"][i] == 1)
            added[open_[row]] = np.minimum(added[open_[row]], parents["at"][i[row]])
            deleted[open_[gone]] = np.minimum(deleted[open_[gone]], parents["at"][i[gone]])
            at[open_] += 1
    when, known = refs["at"], refs["dated"]
    exists = added != _NEVER
    return [(np.flatnonzero(x), c) for c, x in enumerate((~exists, known & (deleted != _NEVER) & (deleted <= when), exists & known & (added > when)))]


def _arrays(b: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {c: b[c].fill_null(0).to_numpy() for c in ("k1", "k2", "db", "at", "row_id")}
    out["kind"] = b["kind"].to_numpy()
    out["tab"] = b["tab"].to_numpy()
    out["any_db"] = b["db"].is_null().to_numpy(zero_copy_only=False)
    out["dated"] = b["at"].is_valid().to_numpy(zero_copy_only=False)
    return out


def _cut(a: dict[str, np.ndarray], rows: slice) -> dict[str, np.ndarray]:
    return {k: v[rows] for k, v in a.items()}


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part, parents first, parents by k1."""
    part, parents = None, []
    whole: dict[str, np.ndarray] | None = None
    for b in batches:
        if not b.num_rows:
            continue
        parts, a = b["part"].to_numpy(), _arrays(b)
        edges = np.flatnonzero(np.diff(parts) | (np.diff(a["kind"] == 2))) + 1
        for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(parts)], strict=True):
            if parts[lo] != part:
                part, parents, whole = parts[lo], [], None
            piece = _cut(a, slice(lo, hi))
            if a["kind"][lo] != 2:
                parents.append(piece)
                continue
            if whole is None:
                whole = {k: np.concatenate([p[k] for p in parents]) if parents else np.zeros(0, piece[k].dtype) for k in piece}
                parents = []
            for index, cause in _probe(whole, piece):
                if len(index):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(piece["tab"][index]), pa.array(piece["row_id"][index]), pa.array(np.repeat(_CAUSES[cause], len(index))), pa.array(piece["at"][index], mask=~piece["dated"][index])],
                        ["tab", "row_id", "cause", "at"],
                    )


def _keys(code: Column) -> list[Column]:
    return [F.xxhash64(code).alias("k1"), F.xxhash64(F.lit("\u0001"), code).alias("k2")]


def orphan_references(references: list[tuple[str, DataFrame]], catalog: DataFrame, deletion: DataFrame) -> DataFrame:
    """table_name, row_id, cause, ref_period of every unsound reference.

    references: (name, DataFrame of row_id, target_code, target_db, recorded_at). Rows without a code refer
    to nothing. Codes and databases are compared trimmed and without case; a blank database stands for any.
    A row gets each cause that holds: 'missing' if the catalogue has no such code and database, 'deleted' if
    the code has a deletion at or before recorded_at, 'later' if the (earliest such) catalogue row was added
    after recorded_at. Without recorded_at only 'missing' can hold, and ref_period is null. A redelivered row
    is named once. Catalogue rows and deletions without a code are ignored; an empty catalogue makes every
    reference missing.
    """
    spark = catalog.sparkSession
    ranges = parallelism(spark)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    names = [n for n, _ in references]
    none = F.lit(None).cast("long")
    refs = None
    for i, (_, df) in enumerate(references):
        one = df.select(folded("target_code").alias("code"), F.xxhash64(folded("target_db")).alias("db"), folded("target_db").isNull().alias("_any"), F.col("row_id").cast("long").alias("row_id"), micros("recorded_at").alias("at"))
        one = one.where(F.col("code").isNotNull()).select(*_keys(F.col("code")), F.when(~F.col("_any"), F.col("db")).alias("db"), F.lit(2).cast("byte").alias("kind"), "at", "row_id", F.lit(i).cast("byte").alias("tab"))
        refs = one if refs is None else refs.unionByName(one)
    row = [F.lit(0).cast("long").alias("row_id"), F.lit(0).cast("byte").alias("tab")]
    rows = catalog.select(folded("code").alias("code"), F.xxhash64(folded("db")).alias("db"), micros("added_at").alias("at")).where(F.col("code").isNotNull())
    # a catalogue row without a date counts as always there
    rows = rows.select(*_keys(F.col("code")), "db", F.lit(0).cast("byte").alias("kind"), F.coalesce("at", F.lit(-(2**62))).alias("at"), *row)
    gone = deletion.select(folded("code").alias("code"), micros("deleted_at").alias("at")).where(F.col("code").isNotNull() & F.col("at").isNotNull())
    gone = gone.groupBy("code").agg(F.min("at").alias("at")).select(*_keys(F.col("code")), none.alias("db"), F.lit(1).cast("byte").alias("kind"), "at", *row)
    # references per range, one number for each range: what overfills a range is split
    counts = {r["r"]: r["count"] for r in refs.select(_range_of(F.col("k1"), ranges).alias("r")).groupBy("r").count().collect()}
    limit = max(1.0, SPLIT_ABOVE * sum(counts.values()) / ranges)
    splits = [max(1, int(np.ceil(counts.get(r, 0) / limit))) for r in range(ranges)]
    first = np.concatenate([[0], np.cumsum(splits)]).tolist()
    places = placement_keys(spark, first[-1])  # each part gets a partition of its own
    plan = F.broadcast(spark.createDataFrame([(r, splits[r], first[r], places[first[r] : first[r + 1]]) for r in range(ranges)], "r int, n int, first int, places array<long>"))
    parents = rows.unionByName(gone).withColumn("r", _range_of(F.col("k1"), ranges)).join(plan, "r").withColumn("s", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    refs = refs.withColumn("r", _range_of(F.col("k1"), ranges)).join(plan, "r").withColumn("s", F.pmod(F.xxhash64("row_id"), F.col("n")).cast("int"))
    columns = [(F.col("first") + F.col("s")).alias("part"), F.col("places")[F.col("s")].alias("place"), "k1", "k2", "db", "kind", "at", "row_id", "tab"]
    parts = parents.select(*columns).unionByName(refs.select(*columns)).repartition(first[-1], "place").sortWithinPartitions("part", F.col("kind") == 2, "k1").drop("place")
    misses = parts.mapInArrow(_stream, "tab byte, row_id long, cause string, at long")
    table_name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("tab").cast("int") + 1)
    return misses.select(table_name.alias("table_name"), "row_id", "cause", month(F.timestamp_micros("at")).alias("ref_period")).distinct()


def catalogue_orphans(mapping: DataFrame, flow_records: DataFrame, catalog: DataFrame, deletion: DataFrame) -> DataFrame:
    """Orphans of `mapping` (rows marked unmatchable refer to nothing) and `flow_records`."""
    m = mapping.where(~F.coalesce(F.col("is_unmatchable"), F.lit(False))).select(F.col("mapping_id").alias("row_id"), "target_code", "target_db", "recorded_at")
    r = flow_records.select(F.col("record_id").alias("row_id"), "target_code", "target_db", "recorded_at")
    return orphan_references([("mapping", m), ("flow_records", r)], catalog, deletion)


def orphans_by_month(orphans: DataFrame) -> DataFrame:
    """table_name, ref_period, cause, n: how many references are unsound in each table and month."""
    return orphans.groupBy("table_name", "ref_period", "cause").agg(F.count(F.lit(1)).alias("n"))
