"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections.

Documents with the same shingle set become one representative. Then

1. Representatives that share a min-hash key point to the smallest one; these
   pairs, one a document, are intersected exactly. They join up most groups of
   copies before any tile is built. Nothing depends on them for completeness.
2. Two sets of the wanted similarity share a shingle among the first
   ``n - ceil(t n) + 1`` of each in any common order; common shingles come last
   in ours. Such a shingle and a size band make a tile; sets of neighbouring
   bands meet in it. Only pairs of different components are needed, and tiles
   that hold a single component are dropped; of the others, the members of the
   largest component meet the rest only. Bit counts of the hashed bitmaps, in
   the tile folded to a fixed width, bound the overlap from above; what passes
   is intersected exactly.

Sets are held as 64-bit shingle hashes. Null, empty and wordless texts have
empty sets that are linked with nothing. Ids are unique but for repeated rows,
which are one node. A row without id has a size but no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm import words as W
from starloom.llm.components import components
from starloom.llm.tables import Scratch, id_text, matching, rebatched, received, send

#: Min-hash keys of a document and minima in each.
KEYS, MINIMA = 8, 3
#: A shingle in this share of all documents goes last in the order.
COMMON = 0.001
#: Rows with texts that go to Python at once.
TEXT_ROWS = 2000
#: Words of a bitmap that an entry of a tile carries at most, a power of two.
TILE_WORDS = 16
#: Documents of a task below which a shingle is not called common.
LEAST_COMMON = 32
_ODD = np.random.default_rng(7).integers(1, 1 << 62, KEYS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sets_of(chunk: W.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and where each row's begin."""
    hashes = chunk.hashes()
    shingles = chunk.windows(hashes, k)
    keep = chunk.room() >= k
    count = np.diff(chunk.bounds)
    for n in range(1, k):
        short = chunk.bounds[:-1][count == n]
        if len(short):
            shingles[short] = chunk.windows(hashes, n)[short] + np.uint64(n)
            keep[short] = True
    row, values = chunk.row_of_words()[keep], shingles[keep]
    order = np.lexsort((values, row))
    row, values = row[order], values[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (values[1:] != values[:-1])
    row, values = row[new], values[new]
    return values, np.searchsorted(row, np.arange(chunk.rows + 1))


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of ``n`` with any partner."""
    return (percent * n + 99) // 100


def bitmap_bits(n: int) -> int:
    """A power of two, at least the size."""
    return max(64, 1 << (n - 1).bit_length())


#: Upper bound of the overlap by the bits that only one of two bitmaps has; the wider one is folded to the other's width.
FOLDED = """CASE WHEN size({0}) > size({1}) THEN zip_with(slice({0}, 1, size({1})), slice({0}, size({1}) + 1, size({1})), (x, y) -> x | y)
    ELSE {0} END"""
ONLY = "aggregate(zip_with({0}, {1}, (x, y) -> bit_count(x & ~y)), 0, (s, x) -> s + x)"


def narrowed(bitmap: str) -> str:
    """The bitmap folded to at most ``TILE_WORDS``: halves are laid over each other until it fits."""
    return f"""CASE WHEN size({bitmap}) <= {TILE_WORDS} THEN {bitmap} ELSE transform(sequence(1, {TILE_WORDS}),
        i -> aggregate(sequence(i, size({bitmap}), {TILE_WORDS}), 0L, (s, j) -> s | element_at({bitmap}, j))) END"""


def overlap_bound() -> str:
    a, b = FOLDED.format("bitmap_a", "bitmap_b"), FOLDED.format("bitmap_b", "bitmap_a")
    return f"least(n_a - {ONLY.format(a, b)}, n_b - {ONLY.format(b, a)})"


def _common(docs: DataFrame, k: int) -> np.ndarray:
    """Hashes of common shingles, at most ``1 / COMMON`` times as many as a document has.

    A task reports those it finds twice in a chunk and often overall. The list
    only sets an order, so what a task leaves out does no harm.
    """
    total = docs.count()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, rows = np.zeros(1 << 20, np.int32), 0
        kept: list[np.ndarray] = []
        for batch in rebatched(batches):
            rows += batch.num_rows
            for chunk in W.chunks(batch["text"], W.space_separated(), W.lower_ascii()):
                values, _ = sets_of(chunk, k)
                place = (values >> np.uint64(44)).astype(np.int64)
                buckets += np.bincount(place, minlength=len(buckets)).astype(np.int32)
                heavy = buckets[place] >= LEAST_COMMON
                found, n = np.unique(values[heavy], return_counts=True)
                kept.append(found[n >= 2])
                if len(kept) > 64:
                    kept = [np.unique(np.concatenate(kept))]
        found = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)
        n = buckets[(found >> np.uint64(44)).astype(np.int64)]
        some = n >= max(LEAST_COMMON, rows * COMMON)
        yield pa.record_batch({"shingle": pa.array(found[some].view(np.int64)), "n": pa.array(n[some].astype(np.int64))})

    found = docs.select("text").mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = found.where(F.col("n") >= max(LEAST_COMMON, total * COMMON)).select("shingle").toArrow()
    return np.sort(found["shingle"].to_numpy().view(np.uint64))


PROFILE = "doc_id bigint, n bigint, s1 bigint, s2 bigint, keys array<bigint>, prefix array<bigint>, bitmap array<bigint>"


def _profiles(docs: DataFrame, k: int, percent: int, common: np.ndarray) -> DataFrame:
    """Size, identity, min-hash keys, prefix and bitmap of each document's set."""
    held = send(docs.sparkSession, common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = received(held)
        for batch in rebatched(batches):
            columns: list[list] = [[], [], [], [], [], []]
            for chunk in W.chunks(batch["text"], W.space_separated(), W.lower_ascii()):
                values, at = sets_of(chunk, k)
                size = np.diff(at)
                some = np.flatnonzero(size)
                mixed = W.mix(values)
                sums = np.zeros((chunk.rows, 2), np.uint64)
                keys = np.zeros((chunk.rows, KEYS), np.uint64)
                if len(some):
                    start = at[:-1][some]
                    sums[some, 0] = np.add.reduceat(mixed, start)
                    sums[some, 1] = np.add.reduceat(W.mix(values + np.uint64(0x51ED27)), start)
                    for key in range(KEYS):
                        for odd in _ODD[key * MINIMA:(key + 1) * MINIMA]:
                            least = np.minimum.reduceat(mixed * odd, start)
                            keys[some, key] = W.mix(keys[some, key] * np.uint64(31) + least + np.uint64(key))
                rare = ~_member(common, values)
                for row in range(chunk.rows):
                    a, b = at[row], at[row + 1]
                    n = int(b - a)
                    mine, first = values[a:b], rare[a:b]
                    prefix = np.concatenate([mine[first], mine[~first]])[:n - int(needed(n, percent)) + 1] if n else mine
                    columns[0].append(n)
                    columns[4].append(prefix.view(np.int64))
                    columns[5].append(_bitmap(mixed[a:b]) if n else mine.view(np.int64))
                columns[1] += sums[:, 0].view(np.int64).tolist()
                columns[2] += sums[:, 1].view(np.int64).tolist()
                columns[3] += [keys[i].view(np.int64) if size[i] else [] for i in range(chunk.rows)]
            longs = pa.list_(pa.int64())
            yield pa.record_batch(
                [batch["doc_id"].cast(pa.int64()), *(pa.array(columns[i], kind) for i, kind in
                 enumerate((pa.int64(), pa.int64(), pa.int64(), longs, longs, longs)))],
                names=["doc_id", "n", "s1", "s2", "keys", "prefix", "bitmap"])

    return docs.mapInArrow(run, PROFILE)


def _member(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(values), bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def _bitmap(mixed: np.ndarray) -> np.ndarray:
    # the low hash bits choose a word of the map, so that its halves fold; the top ones a bit of the word
    bits = bitmap_bits(len(mixed))
    flags = np.zeros(bits, np.uint8)
    word = (mixed & np.uint64(bits // 64 - 1)).astype(np.int64)
    flags[word * 64 + (mixed >> np.uint64(58)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.int64)


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of documents whose sets are similar enough, by exact intersection."""
    def texts(side: str) -> DataFrame:
        ids = pairs.select(F.col(side).alias("doc_id")).distinct()
        found = matching(docs, ids, ids.count())
        return found.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 500):
            sides = []
            for side in "ab":
                rows: list[np.ndarray] = []
                for chunk in W.chunks(batch[f"text_{side}"], W.space_separated(), W.lower_ascii()):
                    values, at = sets_of(chunk, k)
                    rows += [values[at[i]:at[i + 1]] for i in range(chunk.rows)]
                sides.append(rows)
            keep = []
            for x, y in zip(*sides):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(texts("a"), "a").join(texts("b"), "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a bigint, b bigint")


def _starred(reps: DataFrame) -> DataFrame:
    """Pairs of a document and the smallest one that shares a min-hash key."""
    keyed = reps.select("doc_id", F.explode("keys").alias("key"))
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("z")).where("b < z")
    return keyed.join(first, "key").groupBy(F.col("doc_id").alias("a")).agg(F.min("b").alias("b")).where("b < a")


def _tiled(reps: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of different components that share a tile and pass the bounds.

    ``reps`` has ``comp``, the component, and ``weight``, a number of it that
    grows with its size, so that the largest one of a tile is its maximum. Of a
    pair, the smaller set needs a shorter prefix; the places of the shared
    shingle bound what can be shared beside it. Tiles carry bitmaps folded to
    ``TILE_WORDS``; pairs of sets with wider ones are bounded by these after it.
    """
    tiles = reps.select("weight", F.explode("prefix").alias("token")).groupBy("token").agg(
        F.min("weight").alias("low"), F.max("weight").alias("high")).where("low <> high").select("token", "high")
    tiles = scratch.store(tiles, "tokens")
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(log(100 / percent))).cast("int")
    sets = reps.select("doc_id", "n", "comp", "weight", band.alias("band"), F.expr(narrowed("bitmap")).alias("bitmap"))
    entries = reps.select("doc_id", F.posexplode("prefix").alias("at", "token")).join(tiles, "token").join(sets, "doc_id")
    entries = scratch.store(entries.withColumn("main", F.col("weight") == F.col("high")).drop("weight", "high"), "tiles")
    columns = [c for c in entries.columns if c != "token"]
    large = entries.select("token", *[F.col(c).alias(f"{c}_a") for c in columns])
    small = entries.where(f"at <= n - CAST(ceil({2 * percent} * n / {100 + percent}) AS INT)").select(
        "token", *[F.col(c).alias(f"{c}_b") for c in columns])
    wanted = f"{percent} * (n_a + n_b)"
    enough = f"{100 + percent} * {overlap_bound()} >= {wanted}"
    passes = F.expr(f"""comp_a <> comp_b AND band_a - band_b BETWEEN 0 AND 1 AND (n_a > n_b OR (n_a = n_b AND doc_id_a > doc_id_b))
        AND 100 * n_b >= {percent} * n_a
        AND {100 + percent} * (least(at_a, at_b) + 1 + least(n_a - at_a, n_b - at_b) - 1) >= {wanted}
        AND {enough}""")
    met = [large.where(x).join(small.where(y), "token").where(passes).select(
        F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"), "n_a", "n_b") for x, y in (("NOT main_a", "true"), ("main_a", "NOT main_b"))]
    met = scratch.store(met[0].unionAll(met[1]).distinct(), "met")
    scratch.drop(entries)
    wide = f"n_a > {64 * TILE_WORDS}"
    maps = reps.where(f"n > {32 * TILE_WORDS}")
    bounded = met.where(wide)
    for side in "ab":
        bounded = bounded.join(maps.select(F.col("doc_id").alias(side), F.col("bitmap").alias(f"bitmap_{side}")), side)
    return met.where(f"NOT {wide}").select("a", "b").unionAll(bounded.where(enough).select("a", "b"))


def similar_groups(docs: DataFrame, k: int = 4, percent: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest id reachable by links) for every row."""
    docs = id_text(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    scratch = Scratch(docs.sparkSession, "jaccard", TEXT_ROWS)
    with scratch.configured():
        common = _common(docs, k)
    profiles = scratch.store(_profiles(docs, k, percent, common), "profiles")
    whole = profiles.where("n > 0 AND doc_id IS NOT NULL")
    if not whole.groupBy("doc_id").count().where("count > 1").isEmpty():
        docs = docs.dropDuplicates(["doc_id"])
    classes = scratch.store(whole.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = whole.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    stars = scratch.store(_starred(reps), "stars")
    links = scratch.store(verified(stars, docs, k, percent), "links")
    first = components(links)
    size = first.groupBy("component").agg(F.count("*").alias("members"))
    sized = first.join(size, "component").select(F.col("id").alias("doc_id"), "component", "members").unionAll(
        size.select(F.col("component").alias("doc_id"), "component", "members"))
    comp = F.coalesce("component", "doc_id")
    # the size's power of two, then 57 bits of a hash of the id
    weight = F.shiftleft(F.floor(F.log2(F.coalesce("members", F.lit(1)))), 57).bitwiseOR(F.shiftrightunsigned(F.xxhash64(comp), 7))
    ranked = reps.select("doc_id", "n", "prefix", "bitmap").join(sized, "doc_id", "left").select(
        "doc_id", "n", "prefix", "bitmap", comp.alias("comp"), weight.alias("weight"))
    ranked = scratch.store(ranked, "ranked")
    sizes = scratch.store(profiles.select("doc_id", "n", "s1", "s2"), "sizes")
    scratch.drop(profiles, stars)
    tiled = scratch.store(_tiled(ranked, percent, scratch), "tiled")
    scratch.drop(ranked)
    final = components(links.unionAll(scratch.store(verified(tiled, docs, k, percent), "links")))
    named = classes.join(final.withColumnRenamed("id", "rep"), "rep", "left").select(
        "s1", "s2", F.coalesce("component", "rep").alias("component"))
    return sizes.join(named, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
