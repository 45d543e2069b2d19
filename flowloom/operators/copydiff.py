"""Differences between two copies of one dataset, key by key and field by field.

Each copy is first reduced to hashes of its keys and rows. In key order these are cut into content-defined chunks: a
rolling hash over the last keys decides where, so that an inserted or lost row moves no cut but its neighbours'. Chunks
whose fingerprint the other copy has too are done with (an anti-join of fingerprints). The keys of the others mark a
bitmap of fixed size, which goes to the scans: only rows that may lie in an unmatched chunk are read with all their
fields, shuffled and compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.text import folded, number, strip
from flowloom.session import parallelism, placement_keys

#: A cut after every 2**CUT_BITS keys on average, decided by the last WINDOW keys.
CUT_BITS, WINDOW = 3, 4
#: Bits of the bitmap of keys in unmatched chunks (16 MB); keys that share a bit are compared for nothing, never missed.
FILTER_BITS = 27
_PAGE = 32_768
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _coarse(x: Column) -> Column:
    """x rounded to 26 binary digits: equal ones lie within 2e-8 of each other (relative), far inside the tolerance."""
    c = x * F.lit(134217729.0)
    hi = c - (c - x)
    return F.when(F.isnan(hi) | (F.abs(hi) == F.lit(float("inf"))), x).otherwise(hi + F.lit(0.0))


def chunk_starts(keys: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """True where a chunk begins at one of these distinct, sorted key hashes; `before`: the last keys before them, if any."""
    before = np.zeros(0, np.uint64) if before is None else before[-WINDOW:]
    n, m = len(before), len(before) + len(keys)
    every = np.r_[before, keys]
    roll = np.zeros(m, np.uint64)
    for j in range(min(WINDOW, m)):
        roll[j:] += _mix(every[: m - j] + np.uint64(j))
    cut = np.ones(m, bool)
    cut[1:] = (_mix(roll[:-1]) & np.uint64((1 << CUT_BITS) - 1)) == 0
    return cut[n:]


class _Chunks:
    """Chunks of one copy's range, rows coming in batches sorted by key; the open chunk is carried over as two sums and its keys."""

    def __init__(self) -> None:
        self.last = np.zeros(0, np.uint64)  # keys before the batch
        self.sums = np.zeros(2, np.uint64)
        self.keys = np.zeros(0, np.uint64)

    def take(self, k: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints (two arrays), sizes and keys of the chunks that are complete. k, a, b: keys, and two hashes of each row."""
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        if len(self.last):
            new[0] = k[0] != self.last[-1]
        at = np.flatnonzero(new)
        keys = k[at]
        cut = at[chunk_starts(keys, self.last)] if len(at) else at
        starts = cut if len(cut) and cut[0] == 0 else np.r_[0, cut]
        sums = np.stack([np.add.reduceat(a, starts), np.add.reduceat(b, starts)])
        ends = np.r_[np.searchsorted(at, starts[1:]), len(keys)]
        sizes = np.diff(np.r_[0, ends])
        if not (len(cut) and cut[0] == 0) or not len(self.keys):  # the open chunk goes on (or there is none yet)
            sums[:, 0] += self.sums
            sizes[0] += len(self.keys)
        else:
            sums, sizes = np.c_[self.sums, sums], np.r_[len(self.keys), sizes]
        keys = np.r_[self.keys, keys]
        done = len(keys) - sizes[-1]
        self.sums, self.keys, self.last = sums[:, -1].copy(), keys[done:], np.r_[self.last, k[at]][-WINDOW:]
        return sums[0, :-1], sums[1, :-1], sizes[:-1], keys[:done]

    def rest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return self.sums[:1], self.sums[1:], np.array([len(self.keys)]), self.keys


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, h1, h2, rh, side sorted by part, h1, h2, rh -> f1, f2, side, keys: fingerprint and keys (h1) of each chunk.

    Keys with more than one content are given as a chunk of their own with side 2.
    """
    part, side, open_, prev = None, 0, None, None

    def out(f1: np.ndarray, f2: np.ndarray, sizes: np.ndarray, keys: np.ndarray, side: int) -> pa.RecordBatch:
        offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(np.full(len(f1), side, np.int8)), pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64)))], ["f1", "f2", "side", "keys"])

    for b in batches:
        if not b.num_rows:
            continue
        parts, sides = b["part"].to_numpy(), b["side"].to_numpy()
        h1, h2, rh = (b[c].to_numpy().view(np.uint64) for c in ("h1", "h2", "rh"))
        full = _mix(h1 ^ _mix(h2))
        x, y = _mix(full ^ _mix(rh)), _mix(full + _mix(rh ^ _M2))
        cuts = np.r_[0, np.flatnonzero(np.diff(parts)) + 1, len(parts)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if parts[lo] != part:
                if open_ is not None:
                    yield out(*open_.rest(), side)
                part, side, open_, prev = parts[lo], int(sides[lo]), _Chunks(), None
            k = h1[lo:hi]
            several = np.zeros(hi - lo, bool)
            several[1:] = (k[1:] == k[:-1]) & (h2[lo + 1 : hi] == h2[lo : hi - 1])
            several[0] = prev == (k[0], h2[lo])
            prev = (k[-1], h2[hi - 1])
            if several.any():
                odd = np.unique(k[several])
                yield out(odd[:1], odd[-1:], np.array([len(odd)]), odd, 2)
            yield out(*open_.take(k, x[lo:hi], y[lo:hi]), side)
    if open_ is not None:
        yield out(*open_.rest(), side)


def copy_differences(
    left: DataFrame,
    right: DataFrame,
    key: list[str],
    texts: list[str],
    lists: list[str],
    numbers: list[str],
    folded_key: tuple[str, ...] = (),
    sides: tuple[str, str] = ("join", "copy"),
    tolerance: float = 1e-6,
) -> DataFrame:
    """key columns and field_name: 'missing_in_<side>' or the field that differs. Nothing is said of equal rows.

    Keys in `folded_key` are compared and returned trimmed and in lower case, the others as they stand; null
    is a key value of its own. Null, NaN and blank text are one value; text is compared trimmed, lists in
    order of their trimmed elements (an empty list is null), numbers by `tolerance` of the larger magnitude.
    Repeated rows are no difference. Of a key with several contents in a copy, a field differs if any of its
    values in one copy differs from any in the other. An empty copy gives missing rows only. Other columns
    are not read. A key that very many rows share is pre-aggregated before each shuffle.
    """
    spark = left.sparkSession
    fields = [*texts, *lists, *numbers]
    n_text = len(texts) + len(lists)

    def side(df: DataFrame, n: int) -> DataFrame:
        keys = [(folded(c) if c in folded_key else F.col(c).cast("string")).alias(c) for c in key]
        text = [strip(F.col(c).cast("string")) for c in texts]
        joined = [F.array_join(F.transform(F.col(c), lambda x: F.coalesce(strip(x), F.lit(""))), "\u0001") for c in lists]
        hashes = [F.xxhash64(F.coalesce(c, F.lit(""))) for c in [*text, *joined]]
        values = [*hashes, *[number(c) for c in numbers]]
        out = df.select(*keys, F.lit(n).cast("byte").alias("_side"), *[v.alias(f"_v{i}") for i, v in enumerate(values)])
        name = F.concat_ws("\u0001", *[F.coalesce(F.col(c), F.lit("\u0002")) for c in key])
        return out.withColumn("_h1", F.xxhash64(name)).withColumn("_h2", F.xxhash64(F.lit("\u0003"), name))

    rows = side(left, 0).unionByName(side(right, 1))
    # hashes only: key, row, copy; equal rows collapse before the shuffle
    v = [F.col(f"_v{i}") for i in range(len(fields))]
    row_hash = F.xxhash64(*v[:n_text], *[F.isnull(x) for x in v[n_text:]], *[_coarse(x) for x in v[n_text:]])
    narrow = rows.select(F.col("_h1").alias("h1"), F.col("_h2").alias("h2"), row_hash.alias("rh"), F.col("_side").alias("side")).distinct()
    ranges = parallelism(spark)
    at = F.least(F.lit(ranges - 1), F.floor((F.col("h1").cast("double") / F.lit(2.0**64) + 0.5) * ranges)).cast("int")
    places = F.array(*[F.lit(p) for p in placement_keys(spark, 2 * ranges)])
    narrow = narrow.withColumn("part", F.col("side").cast("int") * ranges + at).withColumn("place", F.get(places, F.col("part")))
    narrow = narrow.repartition(2 * ranges, "place").sortWithinPartitions("part", "h1", "h2", "rh").drop("place")
    chunks = narrow.mapInArrow(_chunked, "f1 long, f2 long, side byte, keys array<long>")
    # anti-join of fingerprints: what one copy has and the other lacks
    lone = chunks.groupBy("f1", "f2").agg(F.bit_or(F.expr("shiftleft(1, cast(side as int))")).alias("who"), F.any_value("keys").alias("one"), F.flatten(F.collect_list(F.when(F.col("side") == 2, F.col("keys")))).alias("several"))
    marked = lone.where("who <> 3").select(F.explode(F.when(F.col("who") < 3, F.col("one")).otherwise(F.col("several"))).alias("h1"))
    bit = F.pmod(F.col("h1"), F.lit(1 << FILTER_BITS))
    bits = marked.select(F.floor(bit / _PAGE).cast("int").alias("_page"), (bit % _PAGE).alias("_at")).groupBy("_page").agg(F.bitmap_construct_agg("_at").alias("_bits"))  # at most 2**FILTER_BITS / 8 bytes
    bit = F.pmod(F.col("_h1"), F.lit(1 << FILTER_BITS))
    place = bit % _PAGE
    held = rows.withColumn("_page", F.floor(bit / _PAGE).cast("int")).join(F.broadcast(bits), "_page")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = held.where(F.getbit(byte, (place % 8).cast("int")) == 1)

    def of(n: int, c: Column) -> Column:
        return F.when(F.col("_side") == n, c)

    aggs: list[Column] = []
    for i, x in enumerate(v):
        for n in (0, 1):
            aggs += [F.min(of(n, x)).alias(f"_lo{i}{n}"), F.max(of(n, x)).alias(f"_hi{i}{n}")]
            if i >= n_text:
                aggs.append(F.max(of(n, F.isnull(x))).alias(f"_nu{i}{n}"))
    g = held.groupBy(*key).agg(F.max(of(0, F.lit(True))).alias("_a"), F.max(of(1, F.lit(True))).alias("_b"), *aggs)
    both = F.col("_a") & F.col("_b")

    def differs(i: int) -> Column:
        lo, hi, nu = ([F.col(f"_{c}{i}{n}") for n in (0, 1)] for c in ("lo", "hi", "nu"))
        if i < n_text:
            return (lo[0] != hi[1]) | (hi[0] != lo[1])
        far = lambda x, y: (F.abs(x - y) > F.lit(tolerance) * F.greatest(F.abs(x), F.abs(y))) | ((x != y) & (F.abs(x - y) == F.lit(float("inf"))))
        apart = F.coalesce(far(lo[0], hi[1]) | far(hi[0], lo[1]), F.lit(False))  # the pairs that lie furthest apart
        return apart | (nu[0] & hi[1].isNotNull()) | (nu[1] & hi[0].isNotNull())

    names = [F.when(F.col("_b").isNull(), F.lit(f"missing_in_{sides[1]}")), F.when(F.col("_a").isNull(), F.lit(f"missing_in_{sides[0]}"))]
    names += [F.when(both & differs(i), F.lit(f)) for i, f in enumerate(fields)]
    return g.select(*key, F.explode(F.array_compact(F.array(*names))).alias("field_name"))


def factor_copy_differences(join: DataFrame, copy: DataFrame) -> DataFrame:
    """run_id, method_slug, code, field_name of the flow-level factor tables of two systems."""
    return copy_differences(
        join,
        copy,
        key=["run_id", "method_slug", "code"],
        folded_key=("code",),
        texts=["db", "name", "cas", "sp_match_provenance", "sp_name", "sp_compartment", "sp_sub_compartment"],
        lists=["categories"],
        numbers=["sp_cf", "ef_cf"],
    )
