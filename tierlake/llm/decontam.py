"""Benchmark decontamination by suffix arrays over the training texts.

Every block of documents is a shard.  A shard's words are numbered by the
benchmark's vocabulary (0: not in it), and a sparse suffix array is built: the
suffixes that can match at all, sorted by their first ``window`` words.  Every
suffix of every benchmark item is then binary-searched in the shard; the range
found holds all places where its opening window occurs verbatim.  A document word
inside such a window is hit.

Places from which a match cannot be extended to the left are extended to the right as
far as words agree: these are the maximal verbatim matches, and the longest of each
document and item is reported with its place in both (the first one of equals).  Places
that extend to the left belong to a match that starts earlier, so a text that repeats
itself does not pair each of its places with each place of an item that does so too.

The benchmark is a stated test set.  Spark numbers its items into blocks of at most
``BLOCK_WORDS`` words (one longer item is a block of its own) and writes them to the shared
folder; one block at a time is fetched and broadcast, so what the driver and a task hold
of it is bounded.  With several blocks the documents are written once, with a row number; a block's
pass reads them and writes only the rows in which it found something, and one grouping
by row number merges what the blocks found.

Defined cases: a null or wordless text has no words and no hits; an item without
words matches nothing; items with one id count as one; a null item id counts as
an item but is left out of lists of ids; an item of fewer words than the window
is one window.  Extra columns pass through; those named like a made column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tierlake.llm.components import written
from tierlake.llm.words import text_slices, word_hashes
from tierlake.session import scratch_path

WINDOW = 10
BLOCK_WORDS = 2_000_000

N_WORDS, SPANS, ITEMS, MATCHES = MADE = "__n_words", "__spans", "__items", "__matches"


class TestSuffixes:
    """The windows that open a benchmark block's suffixes, by window length."""

    def __init__(self, texts: list[bytes | None], ids: list, window: int = WINDOW):
        self.window, self.ids = window, ids
        hashes, offsets = word_hashes(texts)
        self.vocab = np.unique(hashes)
        self.coarse = np.zeros(1 << 16, dtype=bool)
        self.coarse[(self.vocab >> np.uint64(48)).astype(np.int64)] = True
        words = np.searchsorted(self.vocab, hashes) + 1
        n = np.diff(offsets)
        self.by_length: dict[int, tuple[np.ndarray, ...]] = {}
        for length in sorted({min(int(k), window) for k in n if k}):
            owners = np.flatnonzero(n >= window if length == window else n == length)
            starts = np.concatenate([np.arange(offsets[i], offsets[i + 1] - length + 1)
                                     for i in owners])
            item = np.repeat(owners, n[owners] - length + 1)
            keys, of = np.unique(self.keys(words, starts, length), return_inverse=True)
            order = np.argsort(of, kind="stable")
            first = np.searchsorted(of[order], np.arange(len(keys) + 1))
            self.by_length[length] = keys, first, item[order], starts[order]
        self.words, self.begin, self.end = words, offsets[:-1], offsets[1:]

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), dtype=np.int64)
        maybe = np.flatnonzero(self.coarse[(hashes >> np.uint64(48)).astype(np.int64)])
        if len(maybe):
            at = np.searchsorted(self.vocab, hashes[maybe])
            at[at == len(self.vocab)] = 0
            out[maybe] = np.where(self.vocab[at] == hashes[maybe], at + 1, 0)
        return out

    def keys(self, words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """The first ``length`` words of each suffix as a sortable byte string."""
        wide = np.empty((len(starts), length), dtype=">u4")
        for j in range(length):
            wide[:, j] = words[starts + j]
        return wide.view(f"S{4 * length}").ravel() if len(starts) else np.zeros(0, f"S{4 * length}")

    def search(self, hashes: np.ndarray, offsets: np.ndarray):
        """Per shard: (hit mask of its words, sorted distinct (text, item) pairs, and for each pair the
        longest match as (place in the shard, place in the item, words))."""
        words = self.numbered(hashes)
        total = len(words)
        stop = np.full(total + 1, total, dtype=np.int64)
        stop[:-1][words == 0] = np.flatnonzero(words == 0)
        stop = np.minimum.accumulate(stop[::-1])[::-1][:-1]
        of_text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        run = np.minimum(stop, offsets[1:][of_text]) - np.arange(total)
        cover = np.zeros(total + 1, dtype=np.int64)
        pairs, longest = [], []
        for length, (tests, first, items, places) in self.by_length.items():
            starts = np.flatnonzero(run >= length)
            if not len(starts):
                continue
            suffix_keys = self.keys(words, starts, length)
            order = np.argsort(suffix_keys, kind="stable")
            array, ranked = starts[order], suffix_keys[order]
            lo, hi = np.searchsorted(ranked, tests, "left"), np.searchsorted(ranked, tests, "right")
            for t in np.flatnonzero(hi > lo):
                at = array[lo[t]:hi[t]]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                texts = np.unique(of_text[at])
                mine = np.unique(items[first[t]:first[t + 1]])
                pairs.append(np.stack([np.repeat(texts, len(mine)), np.tile(mine, len(texts))], 1))
                here = slice(first[t], first[t + 1])
                longest.append(self._maximal(words, of_text, offsets, at, items[here], places[here]))
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        return np.cumsum(cover[:-1]) > 0, found, self._longest(found, words, of_text, offsets, longest)

    def _maximal(self, words, of_text, offsets, at, items, places) -> np.ndarray:
        """(shard place, item number, item place) of the pairs that cannot be extended to the left."""
        def before(of, i, begin):
            """The word before each place; -1 where none is."""
            return np.where(i > begin, of[np.maximum(i - 1, 0)], -1)
        d, b = before(words, at, offsets[of_text[at]]), before(self.words, places, self.begin[items])
        # a document word that no item has extends nothing; neither does a text's beginning
        d = np.where(d <= 0, -2, d)
        out = []
        kinds, of = np.unique(b, return_inverse=True)
        for i, word in enumerate(kinds.tolist()):
            mine, theirs = np.flatnonzero(of == i), np.flatnonzero(d != word)
            if len(theirs):
                out.append(np.stack([np.repeat(at[theirs], len(mine)), np.tile(items[mine], len(theirs)), np.tile(places[mine], len(theirs))], 1))
        return np.concatenate(out) if out else np.zeros((0, 3), np.int64)

    def _longest(self, found, words, of_text, offsets, pairs: list) -> np.ndarray:
        starts = np.concatenate(pairs) if pairs else np.zeros((0, 3), np.int64)
        a, item, p = starts.T
        most = np.minimum(offsets[1:][of_text[a]] - a, self.end[item] - p) if len(a) else np.zeros(0, np.int64)
        n, going = np.zeros(len(a), dtype=np.int64), np.arange(len(a))
        while len(going):
            going = going[n[going] < most[going]]
            going = going[words[a[going] + n[going]] == self.words[p[going] + n[going]]]
            n[going] += 1
        text = of_text[a] if len(a) else a
        order = np.lexsort((p, a, -n, item, text))
        first = np.ones(len(order), dtype=bool)
        first[1:] = (text[order][1:] != text[order][:-1]) | (item[order][1:] != item[order][:-1])
        best = order[first]
        # as many as pairs found, in their order (text, item)
        return np.stack([a[best] - offsets[text[best]], p[best] - self.begin[item[best]], n[best]], 1) if len(best) else np.zeros((0, 3), np.int64)


def _mapper(tests: TestSuffixes, column: str, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, column):
                hashes, offsets = word_hashes(texts)
                hit, found, longest = tests.search(hashes, offsets)
                edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                # a span ends at its text's last word
                inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(hit))]
                split = np.unique(inner[hit[inner] & hit[inner - 1]]) if len(inner) else inner
                begin = np.sort(np.concatenate([np.flatnonzero(edge == 1), split]))
                end = np.sort(np.concatenate([np.flatnonzero(edge == -1), split]))
                text = np.searchsorted(offsets, begin, "right") - 1
                spans: list[list] = [[] for _ in texts]
                for i, a, b in zip(text.tolist(), begin.tolist(), end.tolist()):
                    spans[i].append({"start": a - int(offsets[i]), "n": b - a})
                items: list[list] = [[] for _ in texts]
                matches: list[list] = [[] for _ in texts]
                for (i, k), (a, p, n) in zip(found.tolist(), longest.tolist()):
                    items[i].append(tests.ids[k])
                    matches[i].append({"item": tests.ids[k], "start": a, "item_start": p, "n": n})
                new = {N_WORDS: pa.array(np.diff(offsets), pa.int64())}
                for name, mine in ((SPANS, spans), (ITEMS, items), (MATCHES, matches)):
                    kind = out.field(name).type
                    new[name] = pa.array(mine, kind)
                yield pa.RecordBatch.from_arrays(
                    [new.get(f.name, rows.column(f.name) if f.name in rows.schema.names else None)
                     for f in out], schema=out)
    return run


def find_matches(documents: DataFrame, benchmark: DataFrame, text: str = "text",
                 item_id: str = "item_id", item_text: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """``documents`` (its text column dropped) with ``__n_words``, ``__spans`` (word
    spans hit, merged within a block: struct<start,n>), ``__items`` (ids of items
    of which a window occurs) and ``__matches`` (the longest verbatim match with each of
    these items: struct<item,start,item_start,n>, in words)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                      T.StructField("n", T.LongType())]))
    spark = documents.sparkSession
    kept = [f for f in documents.schema if f.name not in (text, *MADE)]
    made = [T.StructField(N_WORDS, T.LongType()), T.StructField(SPANS, spans),
            T.StructField(ITEMS, T.ArrayType(benchmark.schema[item_id].dataType)),
            T.StructField(MATCHES, T.ArrayType(T.StructType([
                T.StructField("item", benchmark.schema[item_id].dataType), T.StructField("start", T.LongType()),
                T.StructField("item_start", T.LongType()), T.StructField("n", T.LongType())])))]

    def searched(rows: DataFrame, block: DataFrame, carried: list) -> DataFrame:
        found = block.toArrow()
        tests = TestSuffixes([t.encode() if t else None for t in found.column(1).to_pylist()],
                             found.column(0).to_pylist(), window)
        schema = T.StructType(carried + made)
        return rows.select(f"`{text}`", *[f"`{f.name}`" for f in carried]).mapInArrow(
            _mapper(tests, text, to_arrow_schema(schema)), schema)

    blocks = _blocks(benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")))
    documents = documents.drop(*MADE)
    if len(blocks) == 1:
        return searched(documents, blocks[0], kept)
    number = "__row"
    while number in documents.columns:
        number += "_"
    row = T.StructField(number, T.LongType())
    rows = written(spark, documents.withColumn(number, F.monotonically_increasing_id()), "decontam_rows")
    found = None
    for block in blocks[1:]:
        hits = searched(rows, block, [row]).where(F.size(ITEMS) > 0).drop(N_WORDS)
        hits = written(spark, hits, "decontam_hits")
        found = hits if found is None else found.unionByName(hits)
    lists = (SPANS, ITEMS, MATCHES)
    merged = found.groupBy(F.col(number).alias(f"{number}_of")).agg(
        *[F.array_sort(F.flatten(F.collect_list(c))).alias(f"{c}_more") for c in lists])
    first = searched(rows, blocks[0], kept + [row])
    both = [F.concat(c, F.coalesce(f"{c}_more", F.array())).alias(c) for c in lists]
    return first.join(merged, F.col(number) == F.col(f"{number}_of"), "left").select(
        *[F.col(f"`{f.name}`") for f in kept], N_WORDS, *both)


def _blocks(items: DataFrame) -> list[DataFrame]:
    """(item, text) in blocks of bounded size; a small or empty set is one block."""
    # every word but the last takes a character and the one behind it
    sized = items.withColumn("n", F.coalesce((F.length("text") + 1) / 2, F.lit(0)).cast("long") + 1)
    total = sized.agg(F.sum("n")).first()[0] or 0
    if total <= BLOCK_WORDS:
        return [items]
    spark = items.sparkSession
    # shuffled evenly, so that most partitions are one block
    spread = written(spark, sized.repartition(-(-5 * total // (4 * BLOCK_WORDS)))
                     .withColumn("part", F.spark_partition_id())
                     .withColumn("at", F.monotonically_increasing_id()), "decontam_items")
    before = F.sum("n").over(Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    path = scratch_path(spark, "llm", "decontam_blocks")
    spread.withColumn("block", F.floor((before - 1) / BLOCK_WORDS)).write.partitionBy("part", "block").parquet(path)
    blocks = spark.read.parquet(path)
    numbers = sorted(blocks.select("part", "block").distinct().collect())
    return [blocks.where((F.col("part") == p) & (F.col("block") == b)).select("item", "text") for p, b in numbers]


def n_hit():
    """Words in the union of a document's spans."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(F.col(SPANS)), zero, lambda a, s: F.struct(
        F.greatest(a["end"], s["start"] + s["n"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0).cast("long"),
                             s["start"] + s["n"] - F.greatest(a["end"], s["start"]))).alias("n")),
        lambda a: a["n"])


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 (of the sorted ids as
    strings, comma-joined) and contaminated (any word is hit)."""
    ids = F.array_distinct(F.col(ITEMS))
    names = F.array_sort(F.transform(ids, lambda x: x.cast("string")))
    hit = n_hit()
    return found.select(doc_id, F.col(N_WORDS).alias("n_words"), hit.alias("n_hit"),
                        F.size(ids).cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text",
                        most_hit: float = 0.0) -> DataFrame:
    """``documents`` without those whose share of hit words is above ``most_hit``."""
    # the row as a struct: no column of the caller's meets a made one
    found = find_matches(documents.select(F.col(text), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("__row")), benchmark, text)
    clean = found.filter(~(n_hit() > F.lit(most_hit) * F.col(N_WORDS)))
    return clean.select(*[F.col(f"__row.`{c}`").alias(c) for c in documents.columns])
