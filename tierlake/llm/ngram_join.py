"""N-gram Jaccard self-join with Bayesian candidate pruning.

1. Texts become sets of hashed word 5-grams; texts with one set are one class, so
   copies are never paired.  The class keeps a MinHash signature.
2. Classes that agree on any of ``BANDS`` bands of ``ROWS`` MinHash values share a
   bucket.  At the threshold, a pair shares no band with a chance of
   (1 - 0.8^3)^30, below 1e-9.  Within a bucket MinHash values are compared
   incrementally; a pair is dropped when the posterior probability that its
   similarity reaches the threshold (uniform prior, binomial evidence) falls below
   ``TOLERANCE``.  Pairs that others already connect are not compared, and a bucket
   returns a spanning forest, never the pairs.  Connected classes are candidate
   groups; texts that merely share a band do not grow them.
3. The pairs of a candidate group are pruned likewise, and those that remain are
   verified on the whole sets.  The number of links of each class and a spanning
   forest of them are returned, never the pairs.

Buckets and candidate groups are dealt into blocks of bounded size, and each pair of
blocks is one unit of work, so a large one is spread over many tasks.  Where there are
several blocks they are made of sets of like size: sizes fall into strata, each
``STRATUM`` times the one before, and since similar sets lie in one stratum or in
neighbouring ones, no other blocks meet.

Defined cases: a null or wordless text is linked to nothing; a text of one to four
words has one shingle, all its words; repeated rows are copies of each other.
Extra columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.components import components, written
from tierlake.llm.words import mix, text_slices, word_hashes

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 3
HASHES = BANDS * ROWS
STEP = 15                      # MinHash values compared between two looks at the posterior
TOLERANCE = 1e-7
BUCKET_CLASSES = 2048          # classes in a block of a bucket
BLOCK_CLASSES = 256            # classes in a block of a candidate group
BLOCK_SHINGLES = 2_000_000     # about as many shingles at most
STRATUM = 1.01 / THRESHOLD     # above 1 / THRESHOLD, so that rounding parts no similar sets
FILTER_BITS = 1 << 23          # bits of the filter of candidate classes: 1 MiB at any input size

_rng = np.random.default_rng(20240601)
_ODD = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_WORD_MUL = _rng.integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes | None], n: int = SHINGLE_WORDS):
    """(hashes, offsets): the sorted distinct n-gram hashes of each text."""
    words, at = word_hashes(texts)
    counts = np.diff(at)
    full = np.maximum(counts - n + 1, 0)
    first = np.repeat(at[:-1], full) + (np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full))
    grams = np.zeros(len(first), dtype=np.uint64)
    for j in range(n):
        grams += words[first + j] * _WORD_MUL[j]
    owner = np.repeat(np.arange(len(texts)), full)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = np.array([sum(int(w) * int(_WORD_MUL[j]) for j, w in enumerate(words[at[i]:at[i + 1]]))
                          % (1 << 64) ^ int(counts[i]) for i in short], dtype=np.uint64)
        grams, owner = np.concatenate([grams, whole]), np.concatenate([owner, short])
    grams = mix(grams)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    keep = np.ones(len(grams), dtype=bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[keep], owner[keep]
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
    return grams, offsets


def signatures(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values, one row per set that is not empty."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), HASHES), dtype=np.uint32)
    if len(starts):
        for k in range(HASHES):
            v = grams * _ODD[k]
            v += _ADD[k]
            v ^= v >> np.uint64(32)
            out[:, k] = np.minimum.reduceat((v >> np.uint64(16)).astype(np.uint32), starts)
    return out


def _class_keys(grams: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    return [hashlib.blake2b(grams[a:b].tobytes(), digest_size=16).digest() if b > a else None
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in text_slices(batch, "text"):
            grams, offsets = shingle_sets(texts)
            keys = _class_keys(grams, offsets)
            known = iter(signatures(grams, offsets))
            sigs = [next(known) if k else None for k in keys]
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), pa.array(keys, pa.binary()),
                 pa.array([None if s is None else s.tobytes() for s in sigs], pa.binary()),
                 pa.array([None if s is None else s.astype(np.uint8).tobytes() for s in sigs], pa.binary()),
                 pa.array(np.diff(offsets), pa.int64())], names=["row", "key", "sig", "brief", "n"])


def _filter_position(key: bytes) -> int:
    return int.from_bytes(key[:4], "big") % FILTER_BITS


def _shingles_of(wanted: bytes):
    """Shingle sets of the texts whose class may be a candidate."""
    bits = np.frombuffer(wanted, dtype=np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                grams, offsets = shingle_sets(texts)
                keys = _class_keys(grams, offsets)
                got = [i for i, k in enumerate(keys)
                       if k and bits[(p := _filter_position(k)) >> 3] >> (p & 7) & 1]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("row").take(pa.array(got, pa.int64())),
                     pa.array([keys[i] for i in got], pa.binary()),
                     pa.array([grams[offsets[i]:offsets[i + 1]].tobytes() for i in got], pa.binary())],
                    names=["row", "key", "shingles"])
    return run


@lru_cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[tuple[int, int], ...]:
    """(n, m): after n compared values, a pair with fewer than m equal ones is dropped."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        def posterior(m, n=n):   # P(similarity >= threshold | m of n equal), prior uniform
            return sum(comb(n + 1, i) * threshold ** i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1))
        out.append((n, next((m for m in range(n + 1) if posterior(m) >= tolerance), n)))
    return tuple(out)


def possible_forest(brief: np.ndarray, sizes: np.ndarray, left: int | None = None) -> list[tuple[int, int]]:
    """Index pairs that connect all sets whose similarity may reach the threshold: of all
    pairs, or of those of the first ``left`` sets with the others.  ``brief`` has the low
    bytes of the MinHash values; equal values have equal bytes, so no pair is dropped
    that the whole values would keep."""
    label = np.arange(len(sizes))
    edges = []
    for i in range(len(sizes) if left is None else left):
        first = i + 1 if left is None else left
        j = first + np.flatnonzero(label[first:] != label[i])
        j = j[np.minimum(sizes[j], sizes[i]) >= THRESHOLD * np.maximum(sizes[j], sizes[i]) - 1e-9]
        equal, seen = np.zeros(len(j), dtype=np.int64), 0
        for n, least in least_matches():
            if not len(j):
                break
            equal += (brief[j, seen:n] == brief[i, seen:n]).sum(axis=1)
            keep = equal >= least
            j, equal, seen = j[keep], equal[keep], n
        if len(j):
            others, at = np.unique(label[j], return_index=True)
            edges += [(i, k) for k in j[at].tolist()]
            label[np.isin(label, others)] = label[i]
    return edges


def similar_pairs(sig_a, sets_a, sig_b, sets_b, same: bool, threshold: float = THRESHOLD):
    """Index pairs (i in a, j in b; i < j if ``same``) whose Jaccard is at least the threshold."""
    na, nb = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    i, j = np.nonzero(np.minimum.outer(na, nb) >= threshold * np.maximum.outer(na, nb) - 1e-9)
    if same:
        i, j = i[i < j], j[i < j]
    equal = np.zeros(len(i), dtype=np.int64)
    seen = 0
    for n, least in least_matches(threshold):
        if not len(i):
            break
        equal += (sig_a[i, seen:n] == sig_b[j, seen:n]).sum(axis=1)
        keep = equal >= least
        i, j, equal, seen = i[keep], j[keep], equal[keep], n
    if not len(i):
        return i, j
    if len(i) < 4 * (len(sets_a) + len(sets_b)):
        common = np.array([_common(sets_a[x], sets_b[y]) for x, y in zip(i, j)])
    else:
        common = _common_counts(sets_a, sets_b)[i, j]
    # common / union >= t, in whole numbers scaled so that a tie at t counts
    ok = common * (1 + threshold) + 1e-9 >= threshold * (na[i] + nb[j])
    return i[ok], j[ok]


def _common(x: np.ndarray, y: np.ndarray) -> int:
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    return int((x[at] == y).sum())


def _common_counts(sets_a, sets_b) -> np.ndarray:
    """All intersection sizes of two blocks, over slices of the shingles of both."""
    flat_a, flat_b = np.concatenate(sets_a), np.concatenate(sets_b)
    both = np.intersect1d(flat_a, flat_b)
    out = np.zeros((len(sets_a), len(sets_b)), dtype=np.float32)
    wide = 1 << 13
    for at in range(0, len(both), wide):
        part = both[at:at + wide]

        def incidence(sets, part=part):
            m = np.zeros((len(sets), len(part)), dtype=np.float32)
            for r, s in enumerate(sets):
                s = s[np.searchsorted(s, part[0]):np.searchsorted(s, part[-1], "right")]
                k = np.searchsorted(part, s)
                m[r, k[part[k] == s]] = 1
            return m
        out += incidence(sets_a) @ incidence(sets_b).T
    return out.astype(np.int64)


def _each_unit(batches: Iterator[pa.RecordBatch], unit: tuple[str, ...], values: tuple[str, ...]):
    """(unit, its rows) of rows sorted by unit; holds one unit at a time."""
    now, held = None, []
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in unit + values)):
            if r[:len(unit)] != now:
                if held:
                    yield now, held
                now, held = r[:len(unit)], []
            held.append(r[len(unit):])
    if held:
        yield now, held


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a: list[int] = []
    b: list[int] = []
    for (_, x, y), held in _each_unit(batches, ("band", "x", "y"), ("block", "class", "n", "brief")):
        held.sort()                              # blocks in order
        left = None if x == y else sum(r[0] == x for r in held)
        brief = np.frombuffer(b"".join(r[3] for r in held), dtype=np.uint8).reshape(len(held), HASHES)
        for i, j in possible_forest(brief, np.array([r[2] for r in held]), left):
            a.append(held[i][1])
            b.append(held[j][1])
        if len(a) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _stratum(n: str = "n") -> Column:
    """The stratum of a set's size; sizes whose ratio reaches the threshold differ by one at most."""
    return F.floor(F.log(F.col(n)) / F.lit(log(STRATUM))).cast("int")


def _dealt(loads: DataFrame, key: str) -> DataFrame:
    """(key, strata): the number of blocks by stratum, of ``loads`` (key, stratum, blocks)."""
    return loads.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("stratum", "blocks"))).alias("strata"))


def _in_units(df: DataFrame) -> DataFrame:
    """Deals classes into the blocks that ``strata`` gives for their size (null: into one
    block); a row for each pair of blocks with the class's own that may hold similar sets."""
    strata = F.coalesce("strata", F.create_map(F.lit(0), F.lit(1)))
    df = df.withColumn("s", F.when(F.col("strata").isNull(), F.lit(0)).otherwise(_stratum())).withColumn("strata", strata)

    def blocks(stratum: Column) -> Column:
        n = F.col("strata")[stratum]
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(
            stratum.alias("s"), k.alias("k")))).otherwise(F.array().cast("array<struct<s:int,k:int>>"))
    own = F.struct("s", F.pmod(F.xxhash64("class"), F.col("strata")[F.col("s")]).cast("int").alias("k"))
    met = F.concat(blocks(F.col("s") - 1), blocks(F.col("s")), blocks(F.col("s") + 1))
    pairs = F.transform(met, lambda o: F.struct(F.least("block", o).alias("x"), F.greatest("block", o).alias("y")))
    name = {c: (F.col(f"{c}.s").cast("long") * (1 << 32) + F.col(f"{c}.k")).alias(c) for c in ("block", "x", "y")}
    kept = [c for c in df.columns if c not in ("s", "strata")]
    return (df.withColumn("block", own).withColumn("u", F.explode(pairs)).select(*kept, "block", "u.x", "u.y")
            .select(*kept, *name.values()))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []

    def work(unit: tuple, held: list[tuple]) -> None:
        sides = [[r for r in held if r[0] == unit[1]], [r for r in held if r[0] == unit[2]]]
        same = unit[1] == unit[2]
        if same:
            sides[1] = sides[0]
        if not sides[0] or not sides[1]:
            return
        sig = [np.stack([np.frombuffer(r[3], dtype=np.uint32) for r in s]) for s in sides]
        sets = [[np.frombuffer(r[4], dtype=np.uint64) for r in s] for s in sides]
        i, j = similar_pairs(sig[0], sets[0], sig[1], sets[1], same)
        ids = [[r[1] for r in s] for s in sides]
        size = [np.array([r[2] for r in s], dtype=np.int64) for s in sides]
        links: dict[int, int] = {}
        for x, y, side, weight in ((i, j, 0, size[1]), (j, i, 1, size[0])):
            n = np.bincount(x, weight[y], minlength=len(ids[side])).astype(np.int64)
            for k in np.flatnonzero(n):
                links[ids[side][k]] = links.get(ids[side][k], 0) + int(n[k])
        root: dict[int, int] = {}

        def find(v):
            while root.setdefault(v, v) != v:
                root[v] = v = root[root[v]]
            return v
        for x, y in zip(i.tolist(), j.tolist()):
            a, b = find(ids[0][x]), find(ids[1][y])
            if a != b:
                root[max(a, b)] = min(a, b)
        out.extend((c, n, find(c)) for c, n in links.items())

    def drain() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], pa.int64()) for k in range(3)], names=["class", "links", "root"])
        out.clear()
        return made

    for unit, held in _each_unit(batches, ("component", "x", "y"), ("block", "class", "size", "sig", "shingles")):
        work(unit, held)
        if len(out) > 10_000:
            yield drain()
    if out:
        yield drain()


def _candidate_filter(candidates: DataFrame) -> bytes:
    """Bits of the candidates' keys: at most FILTER_BITS / 8 bytes reach the driver."""
    at = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") % FILTER_BITS
    maps = (candidates.select(at.alias("p")).groupBy(F.expr("p div 32768").alias("part"))
            .agg(F.bitmap_construct_agg(F.expr("p % 32768")).alias("bits")))
    out = bytearray(FILTER_BITS // 8)
    for r in maps.collect():
        out[r["part"] * 4096:(r["part"] + 1) * 4096] = r["bits"]
    return bytes(out)


def near_duplicates(spark: SparkSession, documents: DataFrame, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: doc_id, copy_class (its set of shingles; null without
    words), class_id (smallest id of all it is linked to, over any number of links; its
    own id if none) and n_links (documents, copies included, whose similarity to it is
    at least the threshold).  ``doc_id`` may be of any type with an order."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # the id first names the row; equal ids are told apart by their text's class
    named = rows.select(F.col("doc_id").alias("row"), F.col("text").alias("text"))
    sketch = written(spark, named.mapInArrow(
        _sketch, f"row {rows.schema['doc_id'].dataType.simpleString()}, key binary, sig binary, brief binary, n long"), "sketch")
    classes = written(spark, sketch.where("key is not null").groupBy("key").agg(
        F.min("row").alias("rep"), F.count(F.lit(1)).alias("size"), F.max("sig").alias("sig"),
        F.max("brief").alias("brief"), F.max("n").alias("n")).withColumn("class", F.monotonically_increasing_id()), "classes")

    bands = classes.select("class", "n", F.explode(F.array(*[
        F.xxhash64(F.lit(b), F.substring("sig", 4 * ROWS * b + 1, 4 * ROWS)) for b in range(BANDS)])).alias("band"))
    buckets = bands.groupBy("band").agg(
        F.count(F.lit(1)).alias("m"), F.min("class").alias("head"),
        F.bit_xor(F.xxhash64("class")).alias("members")).where("m > 1")
    # bands that bring the same classes together make one bucket
    buckets = buckets.groupBy("m", "head", "members").agg(F.min("band").alias("band"))
    buckets = written(spark, buckets.select("band", "m"), "buckets")
    large = bands.join(buckets.where(F.col("m") > BUCKET_CLASSES), "band").groupBy("band", _stratum().alias("stratum"))
    large = _dealt(large.agg(F.ceil(F.count(F.lit(1)) / BUCKET_CLASSES).cast("int").alias("blocks")), "band")
    meeting = (bands.drop("n").join(buckets.select("band").join(large, "band", "left"), "band")
               .join(classes.select("class", "n", "brief"), "class"))
    possible = written(spark, _in_units(meeting).repartition("band", "x", "y").sortWithinPartitions("band", "x", "y")
                       .mapInArrow(_possible, "a long, b long"), "possible")
    groups = components(spark, possible)

    candidates = written(spark, classes.drop("brief").join(groups.withColumnRenamed("id", "class"), "class"), "candidates")
    of_load = F.greatest(F.ceil(F.col("m") / BLOCK_CLASSES), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    loads = candidates.groupBy("component", _stratum().alias("stratum")).agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
    whole = loads.groupBy("component").agg(F.sum("m").alias("m"), F.sum("s").alias("s")).where(of_load > 1)
    loads = _dealt(loads.select("component", "stratum", of_load.alias("blocks")).join(
        whole.select("component"), "component", "left_semi"), "component")
    wanted = _candidate_filter(candidates)
    sets = named.mapInArrow(_shingles_of(wanted), f"row {rows.schema['doc_id'].dataType.simpleString()}, "
                            "key binary, shingles binary")
    kept = candidates.select(F.col("key").alias("k"), "rep")
    sets = (sets.join(kept, (F.col("key") == F.col("k")) & F.col("row").eqNullSafe(F.col("rep")))
            .dropDuplicates(["key"]).select("key", "shingles"))
    dealt = candidates.join(loads, "component", "left").join(sets, "key")
    units = _in_units(dealt.select("component", "strata", "class", "n", "size", "sig", "shingles"))
    links = written(spark, units.repartition("component", "x", "y").sortWithinPartitions("component", "x", "y")
                    .mapInArrow(_units, "class long, links long, root long"), "links")

    tied = components(spark, links.select(F.col("class").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("class").agg(F.sum("links").alias("links"))
    of_class = (classes.select("key", "class", "rep", "size").join(counted, "class", "left")
                .join(tied.withColumnRenamed("id", "class"), "class", "left"))
    least = of_class.where("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
    of_class = of_class.join(least, "component", "left").select(
        "key", "class", F.coalesce("least", "rep").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    return (sketch.select(F.col("row").alias("doc_id"), "key").join(of_class, "key", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.col("class").alias("copy_class")))
