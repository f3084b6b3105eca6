"""Documents whose sets of word n-grams overlap: an exact Jaccard join by vertical partitioning.

Each document is its set of n-gram hashes. Equal sets are one class and meet by a hash of the set, so copies are never
compared. For the classes the global n-gram order (by hash) is cut into fragments, and every set into the segments
that fall into them:

1. A fragment holds all occurrences of its n-grams, so it knows how many sets have each. N-grams of one set only can
   overlap nothing; the others go back to their sets with that count.
2. A set with more n-grams of its own than the similarity allows has no partner and leaves. For the others, a partner
   must share one of the rarest n-grams, of which there are as many as may differ plus one: the prefix.
3. Sets of similar size that share a prefix n-gram are compared with the first of them, their head, segment by
   segment: each counts its part of the overlap and the parts are summed per pair. That is a number of pairs in
   proportion to the input.
4. The comparison also gives each set's difference from its head, and two sets differ by what their differences do
   not share. So two sets with small differences are linked without looking, and others only if they share enough
   of their differences: again a prefix is enough, now of the short differences. Those pairs, if still in different
   components, are compared like the first ones. In a group of a thousand near copies nearly no pair is left.

Hashes have 64 bits; the chance of a wrong answer anywhere is about (number of different n-grams) squared over 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.common import components, slices, written

#: Hashes in a fragment, about; fragments at least; bits of a hash that name its segment when pairs are compared.
FRAGMENT, FRAGMENTS, SEGMENT_BITS = 2_000_000, 64, 1
#: Sets that meet one head and are compared without counting their differences.
FEW = 8
#: Words whose hashes a Python worker remembers.
KNOWN_WORDS = 150_000


class Words(dict):
    """Hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(text: str | None, n: int, known: Words) -> np.ndarray:
    """Sorted distinct hashes of all runs of n words; of the whole sequence if it is shorter; none without words.

    Letters A-Z count as lower case; words end at blanks (space, tab to carriage return).
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    code = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(hashes) - size + 1 + k])
    return np.unique(code)


def set_hash(hashes: np.ndarray) -> int:
    """Signed 64-bit hash of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def least_overlap(size: int, per_cent: int) -> int:
    """Smallest overlap with any partner: a partner is at least that large."""
    return -(-size * per_cent // 100)


def sets_of(docs: DataFrame, n: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, text_key, n_shingles, set): size and hash of each row's set; the hash of an empty set is null."""
    kind = docs.schema[id_column].dataType

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in slices(batches):
            sets = [ngrams(t, n, known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())], names=["doc_id", "text_key", "n_shingles", "set"])

    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(c, T.LongType()) for c in ("text_key", "n_shingles", "set"))])
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("text_key")).mapInArrow(sized, schema)


def _packed(owners: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, counts: np.ndarray | None = None) -> list[bytes]:
    """Columns of a bundle; sizes and lengths take two or four bytes each, as the largest needs."""
    short = lambda x: x.astype("<u2" if not len(x) or x.max() < 1 << 16 else "<u4")
    parts = [owners.astype("<i8"), short(sizes), short(lengths), hashes.astype("<u8")]
    return [p.tobytes() for p in parts] + ([counts.astype("<u4").tobytes()] if counts is not None else [])


def _bundle(key: int, parts: list[bytes], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)], names=["part", *names])


BUNDLE = ["owners", "sizes", "lengths", "hashes"]


def fragments(docs: DataFrame, n: int, count: int, smallest: int, text_column: str) -> DataFrame:
    """The sets cut at equal steps of the hash range: bundles (part, owners, sizes, lengths, hashes) of one fragment each."""
    edges = np.array([(k << 64) // count for k in range(1, count)], np.uint64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in slices(batches, 0):
            sets = {}
            for text in batch.column(0).to_pylist():
                hashes = ngrams(text, n, known)
                if len(hashes) >= smallest:
                    sets[set_hash(hashes)] = hashes
            if not sets:
                continue
            owners = np.fromiter(sets, np.int64, len(sets))
            sizes = np.array([len(s) for s in sets.values()])
            flat = np.concatenate(list(sets.values()))
            owner = np.repeat(np.arange(len(owners)), sizes)
            part = np.searchsorted(edges, flat, side="right")
            order = np.argsort(part, kind="stable")
            flat, owner = flat[order], owner[order]
            bounds = np.searchsorted(part[order], np.arange(count + 1))
            for k in range(count):
                lo, hi = bounds[k], bounds[k + 1]
                if lo < hi:
                    of, length = np.unique(owner[lo:hi], return_counts=True)
                    yield _bundle(k, _packed(owners[of], sizes[of], length, flat[lo:hi]), BUNDLE)

    schema = "part int, " + ", ".join(f"{c} binary" for c in BUNDLE)
    return docs.select(F.col(text_column).alias("text")).mapInArrow(cut, schema)


def _unpacked(table: pa.Table, names: list[str]) -> list[np.ndarray]:
    kinds = {"owners": "<i8", "hashes": "<u8", "counts": "<u4"}
    sets = [len(b.as_buffer()) // 8 for b in table["owners"]]

    def column(name: str) -> np.ndarray:
        buffers = [b.as_buffer() for b in table[name]]
        return np.concatenate([np.frombuffer(b, kinds.get(name) or f"<u{len(b) // n}") for b, n in zip(buffers, sets, strict=True)])

    return [column(n).astype(np.int64) if n in ("sizes", "lengths") else column(n) for n in names]


def shared_ngrams(cut: DataFrame, count: int) -> DataFrame:
    """Of each fragment, the n-grams that several sets have, with the number of those sets; bundles by owner."""
    def shared(table: pa.Table) -> pa.Table:
        owners, sizes, lengths, hashes = _unpacked(table, BUNDLE)
        _, first = np.unique(owners, return_index=True)  # copies of a set that came from different tasks
        if len(first) < len(owners):
            keep = np.zeros(len(owners), bool)
            keep[first] = True
            hashes = hashes[np.repeat(keep, lengths)]
            owners, sizes, lengths = owners[keep], sizes[keep], lengths[keep]
        order = np.argsort(hashes)
        ranked = hashes[order]
        start = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        sets = np.diff(np.append(start, len(ranked)))
        times = np.empty(len(hashes), np.int32)
        times[order] = np.repeat(sets, sets)
        owner = np.repeat(np.arange(len(owners)), lengths)[times > 1]
        hashes, times = hashes[times > 1], times[times > 1]
        bucket = np.mod(owners, count)[owner] if len(owner) else owner
        by = np.argsort(bucket, kind="stable")
        owner, hashes, times, bucket = owner[by], hashes[by], times[by], bucket[by]
        out = []
        bounds = np.searchsorted(bucket, np.arange(count + 1))
        for k in range(count):
            lo, hi = bounds[k], bounds[k + 1]
            if lo < hi:
                of, length = np.unique(owner[lo:hi], return_counts=True)
                out.append(_bundle(k, _packed(owners[of], sizes[of], length, hashes[lo:hi], times[lo:hi]), names))
        return pa.Table.from_batches(out, schema=kinds)

    names = [*BUNDLE, "counts"]
    kinds = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in names)])
    return cut.groupBy("part").applyInArrow(shared, "part int, " + ", ".join(f"{c} binary" for c in names))


def partners(shared: DataFrame, per_cent: int) -> DataFrame:
    """(set, n, prefix, grams) of the sets that may have a partner: prefix n-grams, and all shared n-grams by hash."""
    def gathered(table: pa.Table) -> pa.Table:
        owners, sizes, lengths, hashes, times = _unpacked(table, [*BUNDLE, "counts"])
        name, of = np.unique(owners, return_inverse=True)
        size = np.zeros(len(name), np.int64)
        size[of] = sizes
        owner = np.repeat(of, lengths)
        order = np.lexsort((hashes, times, owner))
        owner, hashes = owner[order], hashes[order]
        bounds = np.searchsorted(owner, np.arange(len(name) + 1))
        rows = []
        for k, n in enumerate(size.tolist()):
            mine = hashes[bounds[k]:bounds[k + 1]]
            may_differ = n - least_overlap(n, per_cent)
            prefix = may_differ + 1 - (n - len(mine))
            if prefix > 0:
                rows.append((int(name[k]), n, mine[:prefix].astype(np.int64), np.sort(mine).astype(np.int64)))
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds.types, strict=True)], schema=kinds)

    kinds = pa.schema([("set", pa.int64()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))])
    return shared.groupBy("part").applyInArrow(gathered, "set long, n long, prefix array<long>, grams array<long>")


def compared(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """``pairs`` (low, high, ...) by segment, with both sides' n-grams of the segment."""
    left = segments.select(F.col("set").alias("low"), "segment", F.col("grams").alias("low_grams"))
    right = segments.select(F.col("set").alias("high"), "segment", F.col("grams").alias("high_grams"))
    return pairs.join(left, "low").join(right, ["high", "segment"])


def enough(both: str, per_cent: int):
    """The overlap ``both`` makes a pair (low_n, high_n) linked."""
    return F.lit(100) * F.col(both) >= F.lit(per_cent) * (F.col("low_n") + F.col("high_n") - F.col(both))


PAIR = ["low", "high", "low_n", "high_n"]


def linked(pairs: DataFrame, segments: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (low, high, low_n, high_n) that overlap enough: each segment counts its part, the parts are summed."""
    parts = compared(pairs, segments).select(*PAIR, F.size(F.array_intersect("low_grams", "high_grams")).alias("part"))
    return parts.groupBy(*PAIR).agg(F.sum("part").alias("both")).where(enough("both", per_cent)).select("low", "high")


def measured(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs with their overlap ``both`` and ``delta``, the shared n-grams that only one side has."""
    parts = compared(pairs, segments).select(
        *PAIR, F.size(F.array_intersect("low_grams", "high_grams")).alias("part"),
        F.concat(F.array_except("low_grams", "high_grams"), F.array_except("high_grams", "low_grams")).alias("delta"))
    return parts.groupBy(*PAIR).agg(F.sum("part").alias("both"), F.flatten(F.collect_list("delta")).alias("delta"))


def by_difference(members: DataFrame, first: DataFrame, per_cent: int) -> tuple[DataFrame, DataFrame]:
    """Links that differences alone prove (low, high), and the pairs that may be linked besides (low, high, low_n, high_n).

    The pairs lie in different components of the links ``first`` and the proved ones.

    ``members`` (head, set, n, own, delta): a set's difference from its head are its ``own`` n-grams and ``delta``. Sets x
    and y differ by |dx| + |dy| - 2 |dx and dy| n-grams, and are linked if that is at most (1 - t) / (1 + t) of the sum
    of their sizes. With slack(x) = |dx| (1 + t) - |x| (1 - t) they surely are if slack(x) + slack(y) <= 0, and otherwise
    must share (slack(x) + slack(y)) / 2 (1 + t) of their differences: then they share one of the rarest, counted among
    the differences from that head. N-grams that only one set has are the rarest and match nothing. In a group of up to
    ``FEW`` sets all pairs are taken.
    """
    plus, minus = 100 + per_cent, 100 - per_cent
    whole = F.col("own") + F.size("delta")
    known = members.withColumn("slack", plus * whole - minus * F.col("n"))
    tight = known.groupBy("head").agg(F.min(F.struct("slack", "set")).alias("tight"))
    known = known.join(tight, "head")
    proved = written(known.where((F.col("slack") + F.col("tight.slack") <= 0) & (F.col("set") != F.col("tight.set"))).select(
        F.col("set").alias("low"), F.col("tight.set").alias("high")), "ngram-proved")
    labels = components(first.unionAll(proved))
    placed = known.join(labels.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    several = placed.groupBy("head").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("m")).where("a < b").select("head", "m")
    prefix = lambda share: whole - F.greatest(F.lit(1), F.ceil(share)) + 1 - F.col("own")
    placed = written(placed.join(several, "head").withColumns({
        "as_low": prefix(F.col("slack") / plus), "as_high": prefix((F.col("slack") + F.col("tight.slack")) / (2 * plus))}), "ngram-members")

    many = placed.where((F.col("m") > FEW) & (F.greatest("as_low", "as_high") > 0))
    tokens = many.select("head", "set", "n", "slack", "component", "as_low", "as_high", F.size("delta").alias("size"), F.explode("delta").alias("token"))
    counts = placed.where(F.col("m") > FEW).select("head", F.explode("delta").alias("token")).groupBy("head", "token").agg(F.count(F.lit(1)).alias("times"))
    rank = F.row_number().over(Window.partitionBy("head", "set").orderBy("times", "token"))
    ranked = written(tokens.join(counts.where("times > 1"), ["head", "token"], "left").withColumn("times", F.coalesce("times", F.lit(1)))
                     .withColumn("rank", rank).where(F.col("rank") <= F.greatest("as_low", "as_high")).where("times > 1")
                     .drop("times"), "ngram-differences")
    few = placed.where(F.col("m") <= FEW).select("head", "set", "n", "slack", "component", F.lit(1).alias("as_low"), F.lit(1).alias("as_high"),
                                                 F.lit((1 << 31) - 1).alias("size"), F.lit(0).cast("bigint").alias("token"), F.lit(1).alias("rank"))
    entries = ranked.unionByName(few)
    side = lambda name: entries.where(F.col("rank") <= F.col(f"as_{name}")).select(
        "head", "token", F.col("set").alias(name), F.col("n").alias(f"{name}_n"), F.col("slack").alias(f"{name}_slack"), F.col("component").alias(f"{name}_component"),
        (F.col("size") - F.col("rank")).alias(f"{name}_rest"))
    ordered = F.struct("low_slack", "low") < F.struct("high_slack", "high")
    # if this is the first n-gram that both differences have, the rest of the shorter one bounds what they share
    reach = (F.least("low_rest", "high_rest").cast("long") + 1) * (2 * plus) >= F.col("low_slack") + F.col("high_slack")
    pairs = side("low").join(side("high"), ["head", "token"]).where(reach).where(
        ordered & (F.col("low_component") != F.col("high_component")) & (F.col("low_slack") + F.col("high_slack") > 0) & near("low_n", "high_n", per_cent))
    return proved, pairs.select(*PAIR).distinct()


def near(low: str, high: str, per_cent: int):
    """Sizes that a pair of this similarity can have."""
    return (F.lit(100) * F.least(low, high) >= F.lit(per_cent) * F.greatest(low, high))


def classes(docs: DataFrame, n: int = 5, per_cent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, set, component, component_id) for each row.

    Documents are linked when the overlap of their sets is at least ``per_cent`` per cent of their union;
    component_id is the smallest id reachable by links, ``component`` a set of the component, ``text_key`` a hash of the text. A null text or one without words is linked with nothing and its
    own component; a null id never names a component unless all of the component's are null. Rows with equal ids are
    different documents. Other columns are not carried.
    """
    rows = written(sets_of(docs, n, id_column, text_column), "ngram-sets")
    smallest = max(1, per_cent // (100 - per_cent)) if per_cent < 100 else 1 << 62
    total = rows.where(F.col("n_shingles") >= smallest).agg(F.sum("n_shingles")).head()[0] or 0
    count = max(FRAGMENTS, total // FRAGMENT)
    cut = fragments(docs, n, count, smallest, text_column)
    alive = written(partners(shared_ngrams(cut, count), per_cent), "ngram-partners")

    def inside(k: int):
        return F.filter("grams", lambda g: F.shiftrightunsigned(g, 64 - SEGMENT_BITS) == k)

    segments = alive.select("set", F.posexplode(F.array(*map(inside, range(1 << SEGMENT_BITS)))).alias("segment", "grams"))

    # sets of one prefix n-gram and similar size meet their head; sizes a link allows are in one class or two neighbouring ones
    ratio = float(np.log(100 / per_cent)) if per_cent < 100 else 1.0
    about = F.floor(F.log(F.col("n")) / ratio)
    postings = alive.select(F.explode("prefix").alias("gram"), "set", "n", F.explode(F.array(about, about + 1)).alias("about"))
    heads = postings.groupBy("gram", "about").agg(F.min(F.struct("set", "n")).alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1")
    stars = postings.join(heads, ["gram", "about"]).where(F.col("set") != F.col("head.set")).select(
        F.col("set").alias("low"), F.col("head.set").alias("high"), F.col("n").alias("low_n"), F.col("head.n").alias("high_n")).distinct()
    met = written(measured(stars, segments), "ngram-stars")
    first = met.where(enough("both", per_cent)).select("low", "high")

    own = alive.select("set", "n", (F.col("n") - F.size("grams")).alias("own"))
    members = met.select(F.col("high").alias("head"), F.col("low").alias("set"), "delta").unionByName(
        met.select(F.col("high").alias("head")).distinct().select("head", F.col("head").alias("set"), F.array().cast("array<long>").alias("delta")))
    members = members.join(own, "set")
    proved, rest = by_difference(members, first, per_cent)
    second = written(linked(rest, segments, per_cent).unionAll(proved), "ngram-links")
    links = first.unionAll(second)
    joined = components(links)

    per_set = rows.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("first"))
    named = written(per_set.join(joined.withColumnRenamed("node", "set"), "set", "left").select(
        "set", "first", F.coalesce("component", "set").alias("component")), "ngram-classes")
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    of_set = named.join(least, "component").select("set", "component", "least")
    return rows.join(of_set, "set", "left").select(
        "doc_id", "text_key", "n_shingles", "set", "component", F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, per_cent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id, once.

    Documents without words stay, repeated ones too; of other rows that repeat an id and a text one stays. Columns and
    their names are kept.
    """
    found = written(classes(docs, n, per_cent, id_column, text_column).where("set is not null"), "ngram-found")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    first = found.groupBy("component").agg(F.min(row).alias("first"))
    gone = found.join(first, "component").where(row != F.col("first")).select(F.col("doc_id").alias("gone"), F.col("text_key").alias("gone_key")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_column).alias("id"), F.xxhash64(text_column).alias("key"))
    kept = whole.join(gone, F.col("id").eqNullSafe(F.col("gone")) & (F.col("key") == F.col("gone_key")), "left_anti")
    again = found.groupBy(F.col("doc_id").alias("again"), F.col("text_key").alias("again_key")).agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    if not again.isEmpty():  # rows that repeat as a whole
        same = F.col("id").eqNullSafe(F.col("again")) & (F.col("key") == F.col("again_key"))
        kept = kept.join(again, same, "left_anti").unionAll(kept.join(again, same, "left_semi").dropDuplicates(["id", "key"]))
    return kept.select("row.*")
