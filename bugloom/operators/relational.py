"""Dataflow idioms of the engine: first and last of a key, caps, samples, upserts, zero-filled counts, ranges."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def first_of(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """One row for each key, the first by order, by aggregation: no key is sorted in one task."""
    return _extreme(df, key, order, F.min_by)


def last_of(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    return _extreme(df, key, order, F.max_by)


def _extreme(df: DataFrame, key: list[str], order, pick) -> DataFrame:
    row = F.struct(*df.columns)
    return df.groupBy(*key).agg(pick(row, F.struct(*(o.alias(f"o{i}") for i, o in enumerate(_cols(order))))).alias("_row")).select("_row.*")


#: Rows of a task that counts keys.
COUNTED = 250_000


def counted(df: DataFrame, key: list[str], about: int) -> DataFrame:
    """key, n, in tasks of COUNTED rows; about: how many rows df may have.

    Rows that were joined by a part of the key would be counted where they are, however many a task holds.
    """
    return df.repartition(max(1, -(-about // COUNTED)), *key).groupBy(*key).agg(F.count("*").alias("n"))


def first_n(df: DataFrame, key: list[str], n: int, *order: Column) -> DataFrame:
    """At most n rows of each key, in order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def hash_order(seed: object, *key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(k.cast("string") for k in key)))


def sampled_n(df: DataFrame, group: list[str], n: int, seed: object, *key: Column) -> DataFrame:
    """At most n rows of each group, chosen by a seeded hash of their key."""
    return first_n(df, group, n, hash_order(seed, *key), *key)


def sampled_seeds(df: DataFrame, n: int, seeds: list, *key: Column) -> DataFrame:
    """The union of a sample of n rows for each seed; all rows if there are n or fewer."""
    out = None
    for s in seeds:
        one = df.orderBy(hash_order(s, *key), *key).limit(n)
        out = one if out is None else out.union(one)
    return out.distinct()


def stride(df: DataFrame, most: int, *order: Column) -> DataFrame:
    """Every k-th row by order, k = n // most + 1, if there are more than most; else all.

    Places are counted in two steps, so that no task sorts all rows: rows of each range, then the ranges' sizes.  The
    ranged rows are written to the shared folder: bounds are sampled, and a second run might draw others.
    """
    from ..session import shared_folder

    n = df.count()
    step = n // most + 1 if n > most else 1
    if step == 1:
        return df
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    path = f"{shared_folder(df.sparkSession)}/ranged-{uuid.uuid4().hex}"
    ranged.write.parquet(path)
    parts = df.sparkSession.read.schema(ranged.schema).parquet(path)
    sizes = parts.groupBy("_p").count().orderBy("_p").collect()  # one number for each partition
    base, at = [], 0
    for r in sizes:
        base += [F.lit(r["_p"]), F.lit(at)]
        at += r["count"]
    return parts.filter((F.element_at(F.create_map(*base), F.col("_p")) + F.col("_i")) % step == 0).drop("_p", "_i")


def upsert(old: DataFrame, new: DataFrame, key: list[str], updated: list[str], required: list[str] = ()) -> DataFrame:
    """old with new rows: where the key is there, only updated columns change, to the new value; else the row is added.

    Of several new rows of one key the last by all their values counts; new rows that lack a required value are skipped.
    """
    for c in required:
        new = new.filter(F.col(c).isNotNull())
    new = last_of(new, key, *(c for c in new.columns if c not in key))
    o, n = old.alias("o"), new.alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key]
    old_there, new_there = F.col(f"o.{key[0]}").isNotNull(), F.col(f"n.{key[0]}").isNotNull()
    pick = lambda c: F.when(new_there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if c in updated else F.when(old_there, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
    return o.join(n, on, "full").select(*(pick(c).alias(c) for c in old.columns))


def append_new(old: DataFrame, new: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """old and the new rows whose key isn't there, the first of each key."""
    return old.unionByName(first_of(new, key, *order).join(old.select(*key), key, "left_anti").select(*old.columns))


def with_fallback(primary: DataFrame, fallback: DataFrame, key: list[str], most: int, group: list[str], *order: Column) -> DataFrame:
    """primary, and for keys without a primary row at most `most` fallback rows of each group."""
    rest = fallback.join(primary.select(*key).distinct(), key, "left_anti")
    return primary.unionByName(first_n(rest, group, most, *order).select(*primary.columns))


def zero_filled(counts: DataFrame, names: DataFrame, key: str, count: str = "n") -> DataFrame:
    """A row for each name, also those that counts knows alone; what has no count has 0."""
    return names.join(counts, key, "full").select(key, F.coalesce(count, F.lit(0)).cast("long").alias(count), *(c for c in names.columns if c != key))


def in_ranges(findings: DataFrame, ranges: DataFrame, file: str = "file", line: str = "line", bucket: int = 256) -> DataFrame:
    """findings with in_diff: whether their line lies in a range (start to end, both included) of their file.

    Ranges are cut at multiples of bucket, so the join is on file and bucket rather than on a file's every pair.
    """
    cut = ranges.select(F.col("file").alias("_f"), "start", "end", F.explode(F.sequence(F.floor(F.col("start") / bucket), F.floor(F.col("end") / bucket))).alias("_b"))
    ids = findings.select(file, line).distinct()
    hit = ids.join(cut, (F.col(file) == F.col("_f")) & (F.floor(F.col(line) / bucket) == F.col("_b")) & F.col(line).between(F.col("start"), F.col("end")), "left_semi").withColumn("in_diff", F.lit(True))
    return findings.join(hit, [file, line], "left").withColumn("in_diff", F.coalesce("in_diff", F.lit(False)))


def most_common(df: DataFrame, group: list[str], item: str, n: int, order: str) -> DataFrame:
    """The n most frequent items of each group; of equal counts the one seen first by order."""
    counts = df.groupBy(*group, item).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return first_n(counts, group, n, F.desc("n"), F.col("_first")).drop("_first")


#: Sets of more items meet by one rare item, smaller ones by three.
SMALL = 12
#: Longs of a set's signature: the parity of its items in each of 64 bits a long.
SIGNATURE = 4


def _threes(items: Column) -> Column:
    """Hashes of all threes of an array's items, in order."""
    n = F.size(items)
    of = lambda i, j: F.transform(F.sequence(j + 1, n), lambda k: F.xxhash64(items[i - 1], items[j - 1], items[k - 1]))
    all_of = F.flatten(F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.flatten(F.transform(F.sequence(i + 1, n - 1), lambda j: of(i, j)))))
    return F.when(n >= 3, all_of).otherwise(F.array().cast("array<bigint>"))


def similar_sets(left: DataFrame, right: DataFrame, threshold: float, same: bool = False) -> DataFrame:
    """left_id, right_id, jaccard of pairs of sets (columns id, items) of similarity threshold or more.

    Prefix filtering: a set's rarest items suffice to find its partners, so frequent items don't meet.  What two sets share
    of these and how much of each is left bounds their similarity, as do the places at which they meet and, from below, the
    bits in which their signatures differ, before anything is shuffled; only pairs that may reach the threshold are compared.
    Two sets of at most SMALL items that must share three meet by three of their rarest items, as single items of small sets
    are too frequent in a large table.  same: left and right are one table, whose pairs count once.
    """
    from ..functions.vectors import jaccard

    df = left.select(F.explode("items").alias("item")).union(right.select(F.explode("items").alias("item"))).groupBy("item").count()
    size = F.col("size")
    least = F.ceil(threshold * size - 1e-9)

    def ordered(sets: DataFrame) -> DataFrame:
        ranked = sets.select("id", F.size("items").alias("size"), F.explode("items").alias("item")).join(df, "item")
        long, bit = F.floor(F.pmod(F.xxhash64("item"), F.lit(64 * SIGNATURE)) / 64), F.expr("shiftleft(1L, CAST(pmod(xxhash64(item), 64L) AS INT))")
        parity = [F.bit_xor(F.when(long == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"s{k}") for k in range(SIGNATURE)]
        return ranked.groupBy("id", "size").agg(F.array_sort(F.collect_list(F.struct("count", "item"))).alias("items"), *parity)

    def prefix(ranked: DataFrame, name: str, other: str) -> DataFrame:
        """One item at a time, for each kind of partners that don't meet by threes."""
        small, few = size <= SMALL, least < 3
        kinds = F.array(F.when(~small, "large"), F.when(small & few, "few"), F.when(~small & (threshold * size <= SMALL), name), F.when(small & (size >= threshold * (SMALL + 1) - 1e-9), other))
        rare = F.posexplode(F.slice("items", F.lit(1), (size - least + 1).cast("int"))).alias("pos", "x")
        rows = ranked.select(F.col("id").alias(f"{name}_id"), size.alias(f"{name}_size"), F.array_compact(kinds).alias("kinds"), rare, *(F.col(f"s{k}").alias(f"{name}_s{k}") for k in range(SIGNATURE)))
        left = (F.col(f"{name}_size") - F.col("pos") - 1).alias(f"{name}_left")
        return rows.select(f"{name}_id", f"{name}_size", F.col("pos").alias(f"{name}_pos"), left, F.explode("kinds").alias("kind"), "x.item", *(f"{name}_s{k}" for k in range(SIGNATURE)))

    def threes(ranked: DataFrame, name: str) -> DataFrame:
        rare = F.transform(F.slice("items", F.lit(1), (size - least + 3).cast("int")), lambda x: x["item"])
        return ranked.filter(size <= SMALL).select(F.col("id").alias(f"{name}_id"), size.alias(f"{name}_size"), F.explode(_threes(rare)).alias("three"))

    l, r = ordered(left), ordered(right)
    a, b = F.col("left_size"), F.col("right_size")

    def near(met: DataFrame) -> DataFrame:
        met = met.filter((a >= threshold * b - 1e-9) & (b >= threshold * a - 1e-9))
        return met.filter("left_id < right_id") if same else met

    met = near(prefix(l, "left", "right").join(prefix(r, "right", "left"), ["kind", "item"]))
    shared = F.least("left_pos", "right_pos") + 1 + F.least("left_left", "right_left")
    differ = sum((F.bit_count(F.col(f"left_s{k}").bitwiseXOR(F.col(f"right_s{k}"))) for k in range(SIGNATURE)), F.lit(0))
    met = met.filter(((1 + threshold) * shared >= threshold * (a + b) - 1e-6) & ((1 + threshold) * differ <= (1 - threshold) * (a + b) + 1e-6))
    pairs = met.groupBy("kind", "left_id", "right_id").agg(F.first("left_size").alias("left_size"), F.first("right_size").alias("right_size"), (F.count("*") + F.least(F.min("left_left"), F.min("right_left"))).alias("most"))
    pairs = pairs.filter(F.col("most") >= threshold * (a + b - F.col("most")) - 1e-9).select("left_id", "right_id")
    pairs = pairs.unionByName(near(threes(l, "left").join(threes(r, "right"), "three")).select("left_id", "right_id")).distinct()
    out = pairs.join(left.select(F.col("id").alias("left_id"), F.col("items").alias("a")), "left_id").join(right.select(F.col("id").alias("right_id"), F.col("items").alias("b")), "right_id")
    return out.select("left_id", "right_id", jaccard(F.col("a"), F.col("b")).alias("jaccard")).filter(F.col("jaccard") >= threshold)
