"""Near-duplicate groups by minhash with tensored banding.

Two collections of short minhash keys are drawn per document; the key of table (i, j) joins key i of the
first with key j of the second.  So t x t tables take the minhashes of 2 t keys.  With ten keys of two
minhashes in each collection, two documents at the threshold of 0.8 share none of the 100 tables with a
probability below 1e-4, and the more alike the less.

Documents with equal sets are one class and compared once.  A key that one document has leads nowhere, so
tables are made of keys that two have.  Pairs are compared in rounds, and what links is merged before the
next one.  A member of a bucket is the more central, the more other members it meets in all its buckets:
the text that others were copied from more so than its copies.  Each bucket names its most central members,
and each member is compared with those that most of its buckets name, in two rounds; at last all pairs of
different components are, each in the first bucket that it shares.  Pairs inside a component are not compared
any more, so a group of copies costs about as many comparisons as it has members.  All links are confirmed
on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lyceum.llm.components import components
from lyceum.llm.exact_dedup import columns_of, unused
from lyceum.llm.shingles import minhashes, set_keys, shingle_sets
from lyceum.llm.words import Hashes, mixed, slices
from lyceum.session import scratch_path

KEYS = 10      # keys in each collection
HUBS = 3       # central members that a bucket names in a round, and that a member is compared with
SKETCH = 256   # smallest members of a set, by which hopeless pairs are told; smaller sets are compared whole
BITS = 512     # one of each of as many further minhashes, by which hopeless pairs of a bucket are told


def table_keys(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """2 x KEYS keys per set, each of two minhashes and its place."""
    found = minhashes(values, bounds, 4 * KEYS)
    with np.errstate(over="ignore"):
        return mixed(found[:, 0::2] * np.uint64(0x9E3779B97F4A7C15) + found[:, 1::2] + np.arange(2 * KEYS, dtype=np.uint64), 5).view(np.int64)


def minhash_bits(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """BITS bits per set, as rows of 64-bit words: one of each minhash drawn after those of the keys."""
    with np.errstate(over="ignore"):
        bits = mixed(minhashes(values, bounds, BITS, seed=20_240_518), 17).astype(np.uint8) & np.uint8(1)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def features(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, tie, n_shingles, set_a, set_b and keys of every document; the last three are null where the
    set is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Hashes()
        for part in slices(batches, "text"):
            values, bounds = shingle_sets(part.column("text").to_pylist(), width, table)
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            own = np.concatenate([bounds[some], bounds[-1:]])
            a, b = set_keys(values, own)
            keys = table_keys(values, own)
            place = np.full(len(sizes), -1)
            place[some] = np.arange(len(some))
            at = pa.array(np.maximum(place, 0), mask=place < 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("tie"), pa.array(sizes, pa.int64()),
                 pa.array(a.view(np.int64)).take(at), pa.array(b.view(np.int64)).take(at),
                 pa.array([None if p < 0 else keys[p] for p in place], pa.list_(pa.int64()))],
                names=["doc_id", "tie", "n_shingles", "set_a", "set_b", "keys"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, tie long, n_shingles long, set_a long, set_b long, keys array<long>")


def whole_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, sketch, bits, keys, members): 16 bits of each of the smallest members, one bit of
    each of some minhashes, the keys of tables, and all members as bytes.  Every set has members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Hashes()
        for part in slices(batches, "text"):
            values, bounds = shingle_sets(part.column("text").to_pylist(), width, table)
            cuts = list(zip(bounds[:-1], bounds[1:], strict=True))
            sketches = [(values[s:min(e, s + SKETCH)] & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16) for s, e in cuts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(sketches, pa.list_(pa.int16())),
                 pa.array(list(minhash_bits(values, bounds)), pa.list_(pa.int64())), pa.array(list(table_keys(values, bounds)), pa.list_(pa.int64())),
                 pa.array([values[s:e].tobytes() for s, e in cuts], pa.binary())],
                names=["doc_id", "n_shingles", "sketch", "bits", "keys", "members"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, n_shingles long, sketch array<smallint>, bits array<long>, keys array<long>, members binary")


def like_sizes(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def may_link(n: Column, m: Column, sketch: Column, other: Column, percent: int) -> Column:
    """False if the sketches have too few members in common.

    Sets of sizes p >= q that are just alike enough have r p members in common, r = s / (1 + s) (1 + q / p),
    and of the k smallest of the larger set r k are expected to be among them, drawn without replacement.
    4.2 standard deviations are allowed, what the other sketch may end earlier, and four members that share
    their 16 bits with another one: a pair alike enough is lost with a probability below 1e-4."""
    s = percent / 100
    p = F.greatest(n, m).cast("double")
    k = F.greatest(F.size(sketch), F.size(other)).cast("double")
    r = F.least(F.lit(s / (1 + s)) * (1 + F.least(n, m) / p), F.lit(1.0))
    rest = 1 - k / p
    slack = 4.2 * F.sqrt(k * r * (1 - r) * rest) + F.sqrt(2 * k * (1 - r) * rest) + 4
    return F.size(F.array_intersect(sketch, other)) >= r * k - slack


def most_apart(percent: int, bits: int = BITS) -> int:
    """How many of ``bits`` minhash bits may differ.

    A bit of sets that are just alike enough differs with a probability of (1 - percent / 100) / 2.  Sums of
    that distribution are exact: a pair alike enough has more differences with a probability below 1e-5."""
    p = (1 - percent / 100) / 2
    rest, d = 1.0, -1
    while rest >= 1e-5:
        d += 1
        rest -= comb(bits, d) * p**d * (1 - p)**(bits - d)
    return d


def bits_near(one: Column, two: Column, percent: int) -> Column:
    """False if too many bits differ."""
    apart = [F.bit_count(F.get(one, F.lit(k)).bitwiseXOR(F.get(two, F.lit(k)))) for k in range(BITS // 64)]
    return sum(apart[1:], apart[0]) <= most_apart(percent)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike enough."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("members").alias("x"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("members").alias("y"))
    both = pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    kind = dict(pairs.dtypes)["a"]
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def shared_buckets(reps: DataFrame) -> DataFrame:
    """(rep, i, j, bucket, n): the buckets of table (i, j) with n members, two at least."""
    keys = reps.select("rep", F.posexplode("keys").alias("k", "x"))
    common = keys.groupBy("x").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high").select("x")
    kept = keys.join(common, "x", "left_semi").groupBy("rep").agg(F.collect_list(F.struct("k", "x")).alias("kept"))  # 2 x KEYS at most
    one, two = F.filter("kept", lambda e: e.k < KEYS), F.filter("kept", lambda e: e.k >= KEYS)
    tables = (kept.select("rep", F.explode(one).alias("p"), two.alias("qs")).select("rep", "p", F.explode("qs").alias("q"))
              .select("rep", F.col("p.k").cast("byte").alias("i"), (F.col("q.k") - KEYS).cast("byte").alias("j"),
                      F.xxhash64("p.x", "q.x").alias("bucket")))
    shared = tables.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    return tables.join(shared, "bucket")


def hubs_of(live: DataFrame, central: DataFrame, turn: int) -> DataFrame:
    """(bucket, hubs): a bucket's most central member, and the most central after draws that lower each
    member's value by up to a third, as signatures do not tell the very middle of a group."""
    def drawn(k: int) -> Column:
        part = F.pmod(F.xxhash64("rep", F.lit(turn), F.lit(k)), F.lit(1000)) / 3000
        return F.max(F.struct((F.col("met") * (1 - part if turn + k else F.lit(1.0))).alias("m"), "rep"))["rep"]

    named = live.join(central.hint("merge"), "rep").groupBy("bucket").agg(*[drawn(k).alias(f"h{k}") for k in range(HUBS)])
    return named.select("bucket", F.array_distinct(F.array(*[f"h{k}" for k in range(HUBS)])).alias("hubs"))


def best_hubs(stars: DataFrame) -> DataFrame:
    """(a, b): each member with the ones that most of its buckets name."""
    counted = stars.select("rep", "hub").repartition("rep").groupBy("rep", "hub").agg(F.count("*").alias("times"))
    best = counted.groupBy("rep").agg(F.collect_list(F.struct("times", "hub")).alias("named"))  # at most HUBS a bucket
    best = best.select(F.col("rep").alias("a"), F.explode(F.slice(F.sort_array("named", asc=False), 1, HUBS)).alias("b"))
    return best.select("a", F.col("b.hub").alias("b"))


def mixed_buckets(marked: DataFrame) -> DataFrame:
    """The rows of buckets that hold members of two components, with the component that has most of them."""
    parts = marked.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    return marked.join(mixed.select("bucket", "main"), "bucket")


def pairs_apart(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components in the same bucket that may link, each in the first bucket that it shares.

    Members of a bucket's largest component do not meet each other: only the others go to the left side.
    A pair has met in an earlier bucket if it shares one of the keys in ``before``, those of smaller places
    in either collection; a key's value tells its place.  Rows may carry minhash
    bits; their sketch may be null, as those of large sets would be most of what is shuffled.  The condition
    is kept short, as the JVM runs long generated methods without compiling them."""
    left, right = (rows.select(*[F.col(c).alias(f"{c}_{x}") for c in rows.columns]) for x in "ab")
    n, m = F.col("n_shingles_a"), F.col("n_shingles_b")
    met = (F.col("bucket_a") == F.col("bucket_b")) & (F.col("component_a") != F.col("component_b")) & like_sizes(n, m, percent)
    met = met & ((F.col("component_b") == F.col("main_b")) | (F.col("rep_a") > F.col("rep_b")))
    if "bits" in rows.columns:
        met = met & bits_near(F.col("bits_a"), F.col("bits_b"), percent)
    met = met & ~F.arrays_overlap("before_a", "before_b")
    met = met & F.coalesce(may_link(n, m, F.col("sketch_a"), F.col("sketch_b"), percent), F.lit(True))
    return left.filter("component_a != main_a").join(right, met).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def hopeful(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out."""
    one = sketches.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("s"))
    two = sketches.select(F.col("rep").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("t"))
    # Tables that grow with the documents are joined by sorting, at every size.
    return (pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b")
            .filter(like_sizes(F.col("n"), F.col("m"), percent) & may_link(F.col("n"), F.col("m"), F.col("s"), F.col("t"), percent))
            .select("a", "b"))


def saved(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents whose sets of ``width``-word shingles are alike: 100 |A & B| >= percent |A | B|.

    Returns one row per input row: doc_id, n_shingles, component_id (the smallest id that links lead to,
    its own included), kept (doc_id = component_id), tie (a hash of the text).  Case of A to Z does not count.  A text of fewer words
    than ``width`` has one shingle, its whole sequence; null and empty texts have none, are linked with
    nothing and kept.  Rows that share an id count as one document.  A row without id belongs to the group
    of the documents with its very set, if there is one; else component_id is null and it is kept.  An
    empty table gives no rows; extra columns are not read.  Intermediate tables go to the shared folder."""
    folder = scratch_path(spark, "near")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    texts = texts.withColumn("tie", F.xxhash64("text"))
    found = saved(features(texts, width), folder, "features")

    sets_of = ["set_a", "set_b"]
    classes = saved(found.filter("n_shingles > 0").groupBy(*sets_of).agg(F.min("doc_id").alias("rep"))
                    .filter("rep is not null"), folder, "classes")
    own = F.col("doc_id") == F.col("rep")
    reps = found.join(classes, sets_of).filter(own).select("rep", "keys")

    live = saved(shared_buckets(reps), folder, "live")
    members = saved(live.select("rep").distinct(), folder, "members")
    sets = saved(whole_sets(texts.drop("tie").join(members, F.col("doc_id") == F.col("rep"), "left_semi"), width), folder, "sets")
    sketches = sets.select(F.col("doc_id").alias("rep"), "n_shingles", "sketch")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        return saved(confirmed(hopeful(pairs, sketches, percent), sets, percent), folder, name)

    def merged(links: DataFrame, name: str) -> DataFrame:
        """``live`` with the component of each member."""
        groups = saved(components(spark, links), folder, name).select(F.col("node").alias("rep"), "component")
        return live.join(groups, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    # Each member with the most central ones of its buckets, then with those of other components.
    central = saved(live.groupBy("rep").agg(F.sum("n").alias("met")), folder, "central")
    stars = live.join(hubs_of(live, central, 0).hint("merge"), "bucket").select("rep", F.explode("hubs").alias("hub")).filter("rep != hub")
    links = linked(best_hubs(stars), "first_links")
    marked = mixed_buckets(merged(links, "first_groups")).drop("main")
    known = marked.groupBy("rep").agg(F.first("component").alias("other")).withColumnRenamed("rep", "hub")
    named = hubs_of(marked, central, 1).select("bucket", F.explode("hubs").alias("hub")).join(known.hint("merge"), "hub")
    stars = marked.join(named.hint("merge"), "bucket").filter("component != other")
    links = links.union(linked(best_hubs(stars), "second_links"))

    # All pairs of different components in a bucket, each in the first bucket that it shares.
    second = merged(links, "second_groups")
    before = F.concat(F.slice("keys", F.lit(1), F.col("i").cast("int")), F.slice("keys", F.lit(KEYS + 1), F.col("j").cast("int")))
    whole = F.when(F.col("n_shingles") <= SKETCH, F.col("sketch")).alias("sketch")
    known = sets.select(F.col("doc_id").alias("rep"), "n_shingles", whole, "bits", "keys")
    rows = (mixed_buckets(second).join(known.hint("merge"), "rep")
            .select("bucket", "main", "rep", "component", "n_shingles", "sketch", "bits", before.alias("before")))
    others = pairs_apart(rows, percent)
    more = saved(confirmed(others, sets, percent), folder, "more_links")
    if more.isEmpty():
        ends = spark.read.parquet(f"{folder}/second_groups").select(F.col("node").alias("rep"), "component")
    else:
        ends = components(spark, links.union(more)).select(F.col("node").alias("rep"), "component")

    named = classes.join(ends, "rep", "left").select(*sets_of, F.coalesce("component", "rep").alias("component_id"))
    result = found.select("doc_id", "tie", "n_shingles", *sets_of).join(named, sets_of, "left")
    component = F.coalesce(F.col("component_id"), F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "tie")


def drop_near_copies(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group with all its columns: the smallest id, and of rows that share it the smallest
    hash of the text.  Rows without id that belong to no document's group all stay."""
    rows = near_duplicates(spark, docs, width, percent, id_col, text_col).filter("kept")
    named = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("tie").alias("tie")).union(
        rows.filter("doc_id is null").select("doc_id", "tie").distinct())
    tie, own_id, own_tie = (unused(docs, x) for x in ("tie", "own_id", "own_tie"))
    named = named.select(F.col("doc_id").alias(own_id), F.col("tie").alias(own_tie))
    marked = docs.withColumn(tie, F.xxhash64(F.col(text_col).cast("string").cast("binary")))
    return marked.join(named, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(tie) == F.col(own_tie)), "left_semi").select(*columns_of(docs))
