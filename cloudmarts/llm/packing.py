"""Best-fit packing by a configuration linear program over the length histogram.

A configuration is a multiset of piece lengths that fits one sequence.  The covering LP
"fewest configurations that hold every length as often as it occurs" is solved by
multiplicative weights: lengths still short of their demand gain weight, and an unbounded
knapsack by dynamic programming finds the configuration of most weight.  The fractional
solution is rounded down, the rest goes best-fit decreasing into what is free.  All of that
sees only the histogram (at most ``capacity`` numbers), never the rows.

Rows are matched to places by arithmetic: a piece's rank among the pieces of its length is a
local rank (counted while tokenising a partition) plus the counts of earlier partitions, and
every step of the plan holds a range of ranks.  No group of rows is gathered anywhere.
"""

from __future__ import annotations

import base64
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloudmarts.llm.components import stage
from cloudmarts.llm.token_ids import END_ID, Encoder, split_stretches

CAPACITY = 1024
_SCALES = (1.0, 0.97, 0.93, 0.85, 0.7, 0.5, 0.25)
_RATE, _AHEAD = 10.0, 0.01
SPECIAL = {"<|endoftext|>": 50256}  # the added token of byte_bpe_50k.json, matched inside text
_STRETCH = 2_000  # characters
_ROWS = 256  # documents whose ids a task holds at a time
ROUNDS = 250  # multiplicative-weights rounds: the driver's work is bounded by them


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load_encoder(path: str):
    """The byte-level BPE of the tokenizers file byte_bpe_50k.json, read from its rank list:
    several times faster.  ``token_ids`` gives the ids of that file; ``encode_ordinary`` reads
    the strings of special tokens as ordinary text."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=SPECIAL)


def load_exact(path: str) -> Encoder:
    """The tokenizers file of the same vocabulary, for stretches the rank list's library cannot
    take: it fails on runs of about a million blanks and slows down on long words."""
    return Encoder(path.removesuffix(".tiktoken") + ".json")


def token_ids(encoder, text: str, exact: Callable[[], Encoder] | None = None) -> list[int]:
    """The ids of the tokenizers file with add_special_tokens=False: the added token's string
    is its one id wherever it stands in the text.  Stretches of more than ``_STRETCH``
    characters without a place to cut (see ``token_ids.split_stretches``) go to ``exact``."""
    if len(text) <= _STRETCH:
        return encoder.encode(text, allowed_special="all")
    ids, short = [], []
    for own in split_stretches(text):
        if len(own) <= _STRETCH:
            short.append(own)
            continue
        ids += encoder.encode("".join(short), allowed_special="all")
        short = []
        whole = exact() if exact else load_exact(default_vocabulary())
        ids += np.frombuffer(whole.encode([own])[0], "<u4").tolist()
    return ids + encoder.encode("".join(short), allowed_special="all")


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: one piece if it fits, else full
    pieces after a first one that holds the remainder."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    cuts = ([0] if first else []) + list(range(first, n, capacity))
    return [(a, b - a) for a, b in zip(cuts, [*cuts[1:], n], strict=True)]


def tokenized_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
                     end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit), part, nth: the
    piece's partition and its rank among the partition's pieces of that length.  Written once
    to the shared scratch folder, so ranks and counts come from the same attempt."""
    path = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, exact = load_encoder(path), cache(lambda: load_exact(path))  # few tasks need the second
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in (b.slice(at, _ROWS) for b in batches for at in range(0, b.num_rows, _ROWS)):
            rows, pieces, starts, lengths, ids, nth = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                all_ids = np.array([*token_ids(encoder, text, exact), end_id], dtype="<u4")
                for piece, (start, length) in enumerate(cut(len(all_ids), capacity)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(length)
                    ids.append(all_ids[start:start + length].tobytes())
                    nth.append(seen[length])
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()),
                pa.array([part] * len(rows), pa.int32()), pa.array(nth, pa.int64()),
            ], names=["doc_id", "piece", "start", "length", "ids", "part", "nth"])

    key = dict(docs.dtypes)["doc_id"]
    return stage(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                 .mapInArrow(encode, f"doc_id {key}, piece int, start long, length long, ids binary, "
                                     "part int, nth long"), "pieces")


def _knapsack(weights: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """For every room up to ``capacity``: the piece to take next in its configuration of most
    weight (repeats allowed), or -1."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1, dtype=np.int64)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(lengths, room, "right")
        if fits:
            values = best[room - lengths[:fits]] + weights[:fits]
            top = int(values.argmax())
            best[room], take[room] = values[top], top
    return take


def solve_configurations(lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY,
                         rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Configurations (sorted places in ``lengths``) and how often to use each: the covering
    LP by multiplicative weights.

    The wanted cover rises by 1 / rounds of every demand per round.  A length's weight falls
    exponentially with the part of its demand that is covered ahead of the others; one
    dynamic program then prices all rooms, and each length that lags is used with the best
    filling of the room it leaves, as often as no length runs ahead by more than _AHEAD.
    """
    covered = np.zeros(len(lengths))
    used: dict[tuple[int, ...], float] = defaultdict(float)
    for r in range(1, rounds + 1):
        part = covered / demand
        weights = lengths * np.exp(-_RATE * (part - part.mean()))
        take = _knapsack(weights, lengths, capacity)
        wanted = demand * (r / rounds)
        allowed = demand * min(1.0, r / rounds + _AHEAD)
        for k in range(len(lengths) - 1, -1, -1):
            lag = wanted[k] - covered[k]
            if lag <= 0:
                continue
            counts, room = Counter([k]), capacity - int(lengths[k])
            while room > 0 and take[room] >= 0:
                counts[int(take[room])] += 1
                room -= int(lengths[take[room]])
            times = min(lag, min((allowed[i] - covered[i]) / n for i, n in counts.items()))
            if times > 0:
                for i, n in counts.items():
                    covered[i] += times * n
                used[tuple(sorted(counts.elements()))] += times
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[Counter, int]]:
    """(lengths of one sequence, number of such sequences), holding every piece once.

    The fractional solution is scaled by each of _SCALES and rounded down within what is left
    of each demand; the rest goes, longest first, into the fullest kind of sequence that still
    has room, or a new one.  The rounding with the fewest sequences wins.
    """
    left = {int(n): int(k) for n, k in histogram.items() if k > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a length is out of range")
    whole = {(capacity,): left.pop(capacity)} if capacity in left else {}
    best: dict[tuple, int] = {}
    if left:
        lengths = np.array(sorted(left))
        demand = np.array([left[n] for n in lengths], dtype=np.int64)
        fewest = -(-int(demand @ lengths) // capacity)
        solved = sorted(solve_configurations(lengths, demand.astype(np.float64), capacity, rounds).items(),
                        key=lambda c: (-int(lengths[list(c[0])].sum()), -c[1], c[0]))
        for scale in _SCALES:
            bins = _round(solved, scale, lengths, demand.copy(), capacity)
            if not best or sum(bins.values()) < sum(best.values()):
                best = bins
            if sum(best.values()) <= fewest:
                break
    return [(Counter(c), n) for c, n in [*whole.items(), *sorted(best.items())] if n]


def _round(solved: list, scale: float, lengths: np.ndarray, rest: np.ndarray, capacity: int) -> dict[tuple, int]:
    bins: dict[tuple, int] = {}
    for places, times in solved:
        counts = Counter(places)
        n = min(int(times * scale), *(int(rest[i]) // k for i, k in counts.items()))
        if n > 0:
            for i, k in counts.items():
                rest[i] -= n * k
            kind = tuple(int(lengths[i]) for i in places)
            bins[kind] = bins.get(kind, 0) + n
    _best_fit(bins, {int(n): int(k) for n, k in zip(lengths, rest, strict=True) if k}, capacity)
    return bins


def _best_fit(bins: dict[tuple, int], left: dict[int, int], capacity: int) -> None:
    """Best-fit decreasing over kinds of sequences instead of single ones."""
    by_room: dict[int, dict[tuple, int]] = defaultdict(dict)
    for config, n in bins.items():
        by_room[capacity - sum(config)][config] = n
    bins.clear()
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            room = next((r for r in range(length, capacity) if by_room.get(r)), None)
            if room is None:
                each = capacity // length
                for config, k in (((length,) * each, n // each), ((length,) * (n % each), min(1, n % each))):
                    if k:
                        kind = by_room[capacity - len(config) * length]
                        kind[config] = kind.get(config, 0) + k
                break
            config, k = by_room[room].popitem()
            fit = min(room // length, n)
            full, over = divmod(min(n, k * fit), fit)
            for times, count in ((fit, full), (over, min(1, over))):
                if count:
                    grown = (*config, *(length,) * times)
                    kind = by_room[room - times * length]
                    kind[grown] = kind.get(grown, 0) + count
            unused = k - full - min(1, over)
            if unused:
                by_room[room][config] = by_room[room].get(config, 0) + unused
            n -= full * fit + over
    for kinds in by_room.values():
        for config, n in kinds.items():
            bins[config] = bins.get(config, 0) + n


def place_table(kinds: list[tuple[Counter, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, past last rank, first sequence, each, offset): pieces of that
    length with these ranks go ``each`` to a sequence, from ``offset`` on."""
    rows, given, sequence = [], Counter(), 0
    for config, n in kinds:
        offset = 0
        for length in sorted(config, reverse=True):
            each = config[length]
            rows.append((length, given[length], given[length] + n * each, sequence, each, offset))
            given[length] += n * each
            offset += each * length
        sequence += n
    return rows


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, derive: dict | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset; ``derive``
    (name -> column of a piece) puts digests in the place of ``ids``.

    Null texts count as empty and give the end id alone; repeated rows are packed each; an
    empty table gives an empty result; other columns are not read.  Sequences are at most
    ``capacity`` ids, offsets gapless from 0; sequence ids are distinct numbers.
    """
    pieces = tokenized_pieces(docs, vocabulary, capacity, end_id)
    spark = docs.sparkSession
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = place_table(plan(histogram, capacity))
    places = spark.createDataFrame(rows, "length long, low long, high long, first long, each long, base long")
    # per-partition counts -> first rank; a range of ranks is cut where a partition's begins
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ranges = (starts.join(places, "length")
              .where((F.col("low") < F.col("before") + F.col("n")) & (F.col("before") < F.col("high")))
              .groupBy("length", "part", "before")
              .agg(F.sort_array(F.collect_list(F.struct("low", "high", "first", "each", "base"))).alias("steps")))
    kept = pieces.select("doc_id", "piece", "start", "length", "part", "nth",
                         *([c.alias(n) for n, c in derive.items()] if derive else [F.col("ids")]))
    ranked = kept.join(ranges, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    step = F.filter("steps", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"]))[0]
    at = F.col("rank") - F.col("step.low")
    return (ranked.withColumn("step", step)
            .select("doc_id", "piece", "start", "length", *(derive or ["ids"]),
                    (F.col("step.first") + F.expr("(rank - step.low) div step.each")).alias("sequence_id"),
                    (F.col("step.base") + at % F.col("step.each") * F.col("length")).alias("offset")))
