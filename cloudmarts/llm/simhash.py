"""SimHash near-duplicate groups with deletion-variant signatures.

A text's fingerprint is the bitwise majority of its word shingles' XXH64 values.  Two
fingerprints link at ``max_distance`` (at most 2) or fewer differing bits.  64 bits are cut
into max_distance // 2 + 1 segments, so of two linked fingerprints one segment differs by at
most one bit.  Each *distinct* fingerprint is indexed under every segment with one bit
wildcarded (64 signatures); linked fingerprints meet in an equal signature and are verified
by their bit distance.

Skew: copies collapse to one fingerprint before anything is joined.  A signature shared by
many fingerprints (one large family of near copies) is not expanded into pairs: its members
are indexed instead by every fingerprint within one bit of them, where a bucket can hold at
most 65 members, all within two bits of each other, so a star per bucket carries the same
components.  No link is dropped in either form.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloudmarts.llm.components import connected_components, stage
from cloudmarts.operators.joins import checked_broadcast

SEED = 42
_CHUNK = 1 << 16


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def simhash(text: str | None, shingle_words: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one text; 0 for a text without words."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z fold, ASCII blanks
    if not words:
        return 0
    if len(words) < shingle_words:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
        n = len(words) - shingle_words + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, _CHUNK):
        size = min(_CHUNK, n - start)
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g, _ in zip(grams, range(size), strict=False)),
                             dtype="<u8", count=size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle_words: int = 3, text_col: str = "text",
                     out_col: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long in ``out_col`` (null text: 0)."""

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        return pa.array((_signed(simhash(t.as_py(), shingle_words)) for t in texts), pa.int64())

    return docs.withColumn(out_col, fingerprint(F.col(text_col).cast("string")))


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, past last bit) of each segment: two at least, so that one has 32 bits."""
    n = max(2, max_distance // 2 + 1)
    cuts = [64 * i // n for i in range(n + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def _variants(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fp, key): each segment with each of its bits wildcarded; the bit's number stands
    above the 32 bits of the segment."""
    keys = []
    for lo, hi in segments(max_distance):
        segment = F.shiftrightunsigned("fp", lo)
        keys += [segment.bitwiseAND(F.lit(((1 << (hi - lo)) - 1) & ~(1 << (bit - lo))))
                 .bitwiseOR(F.lit(bit << 32)) for bit in range(lo, hi)]
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def _first_meeting(max_distance: int):
    """True at the one key in which the pair (a.fp, b.fp) is to be emitted: in the first
    segment that differs by at most a bit, at that bit (or at its first bit)."""
    diff = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    bit = F.shiftright(F.col("a.key"), 32).cast("int")
    here = F.lit(False)
    for lo, hi in reversed(segments(max_distance)):
        seg = diff.bitwiseAND(F.lit(_signed(((1 << hi) - 1) ^ ((1 << lo) - 1))))
        at = F.when(seg == 0, bit == lo).otherwise(
            seg == F.call_function("shiftleft", F.lit(1).cast("long"), bit))
        here = F.when(F.bit_count(seg) <= 1, at).otherwise(here)
    return here


def fingerprint_links(prints: DataFrame, max_distance: int = 2, pair_limit: int = 64) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) that join exactly the fingerprints at
    ``max_distance`` or fewer bits: every such pair is linked, directly or through
    fingerprints that are themselves that close.

    The signatures are shuffled once, at most ``pair_limit`` + 1 of a key from each task;
    a key with more members than ``pair_limit`` is settled by the one-bit neighbours.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance must be 0, 1 or 2")
    if max_distance == 0:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    # 64 signatures a row: spread the narrow rows first, or a few tasks would sort them all
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sigs = _variants(prints.repartition(n, "fp"), max_distance)
    by_key = Window.partitionBy("key")
    shared = stage(sigs.withColumn("nth", F.row_number().over(by_key.orderBy("fp")))
                   .where(F.col("nth") <= pair_limit + 1)
                   .withColumn("n", F.count("*").over(by_key)).where("n > 1")
                   .select("key", "fp", "n"), "signatures")

    few = shared.where(F.col("n") <= pair_limit)
    pairs = (few.alias("a").join(
        few.alias("b"),
        (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_distance)
        & _first_meeting(max_distance))
        .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))

    many = shared.where(F.col("n") > pair_limit).select("key").distinct()
    family = sigs.join(checked_broadcast(many), "key", "left_semi").select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in range(64)])
    balls = (family.select("fp", F.explode(flips).alias("centre"))
             .groupBy("centre").agg(F.collect_set("fp").alias("fps"))  # at most 65 members
             .where(F.size("fps") > 1))
    if max_distance == 2:
        hub = F.array_min("fps")
    else:
        balls = balls.where(F.array_contains("fps", F.col("centre")))
        hub = F.col("centre")
    stars = balls.select(hub.alias("u"), F.explode("fps").alias("v")).where("u != v")
    return pairs.union(stars).distinct()


def simhash_groups(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, fp signed long, component_id, root: the component's
    key among fingerprints).

    ``component_id`` is the smallest id among all rows reachable over links; rows with equal
    fingerprints are linked, among them all texts without words (fingerprint 0).  Repeated
    rows stay repeated; a null id never is a component's id unless it has no other.  An
    empty table gives an empty result.  Other columns are not read.
    """
    rows = stage(with_fingerprint(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        shingle_words).select("doc_id", "fp"), "fingerprints")
    return rows.join(fingerprint_classes(rows, max_distance), "fp").select("doc_id", "fp", "component_id", "root")


def fingerprint_classes(rows: DataFrame, max_distance: int = 2) -> DataFrame:
    """(doc_id, fp) rows -> one row per distinct fingerprint: fp, component_id, root."""
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    prints = stage(prints, "prints")
    roots = connected_components(fingerprint_links(prints.select("fp"), max_distance))
    named = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return named.select("fp", "root").join(least, "root").select("fp", "component_id", "root")


def fingerprint_hex(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def dedup(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """One document of each group: the row with the group's smallest doc_id, all its
    columns.  Of several rows with that id the first by the plain columns stays; in a group
    whose ids are all null one row stays.

    Texts are fingerprinted once and written beside a row number; all joins before the last are
    on numbers.  The rows that go are told by an anti-join that is broadcast after a check of its
    size; beyond it the texts are exchanged once.
    """
    names = docs.columns
    plain = [f"c{i}" for i in range(len(names))]  # names of their own: any column may be named fp
    text, doc_id = (plain[names.index(n)] for n in ("text", "doc_id"))
    numbered = stage(with_fingerprint(docs.toDF(*plain), shingle_words, text)
                     .withColumn("row", F.monotonically_increasing_id()), "fingerprinted")
    rows = numbered.select(F.col(doc_id).alias("doc_id"), "fp", "row")
    heads = stage(rows.join(fingerprint_classes(rows.select("doc_id", "fp"), max_distance), "fp")
                  .where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("root", "fp", "row"), "heads")
    first = heads.groupBy("root").agg(F.min(F.struct("fp", "row")).alias("head"))
    same = heads.groupBy("root", "fp").agg(F.count("*").alias("n")).join(
        first.select("root", F.col("head.fp").alias("fp")), ["root", "fp"])
    one = first.join(same.where("n = 1"), "root", "left_semi").select("head.row")
    # several rows under the id: the first by the plain columns
    several = heads.join(same.where("n > 1").select("root", "fp"), ["root", "fp"]).select("root", "row")
    order = [F.col(c) for c, f in zip(plain, docs.schema, strict=True)
             if f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    chosen = (numbered.join(checked_broadcast(several.withColumnRenamed("row", "tied")), F.col("row") == F.col("tied"))
              .groupBy("root").agg(F.min(F.struct(*order, "row")).alias("head")).select("head.row"))
    kept = one.unionByName(chosen)
    gone = stage(rows.select("row").join(kept, "row", "left_anti"), "duplicates")
    left = numbered.join(checked_broadcast(gone), "row", "left_anti")
    return left.select(*[F.col(c).alias(n) for c, n in zip(plain, names, strict=True)])
