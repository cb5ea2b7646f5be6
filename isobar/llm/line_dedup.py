"""Line deduplication by a suffix array over sequences of line ids.

1. Lines that occur once cut the documents into sequences of repeated lines; equal sequences are one row with its count,
   so a hot line or a large group of copies is a few rows from here on. Sequences are numbered in the order of their first
   occurrences, so (sid, at) orders all lines as the documents do.
2. Distributed prefix doubling: the suffixes are sorted by their first FIRST line ids, then at each step by their rank and
   the rank 2**k lines further on, until no rank changes. A sort deals rows by ranges, ties by their places, and numbers
   them within; only one row a partition is summed up beside it.
3. Neighbours in the suffix order share prefixes; their length comes from the ranks of all steps, longest first. Intervals
   of neighbours that share least_lines lines or more are the longest-common-prefix intervals: each holds all occurrences of
   one repeated run. The first occurrence stays, the lines of the later ones are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, join_counted, written

#: Lines that the first sort of the suffixes looks at.
FIRST = 8
#: Suffixes in a bucket of the suffix order; one row a bucket is broadcast.
BUCKET = 20
_BLANK = b" \t\n\x0b\x0c\r"


def dense_ranks(df: DataFrame, cols: list[str], out: str, ties: list[str]) -> DataFrame:
    """df with out: numbers from 1 of the different values of cols (integers), in their order.

    Rows are dealt by ranges of cols and ties, so a value of very many rows is spread over partitions; each partition is
    numbered by itself and starts where those before end (a row a partition), less one if it goes on with their last value.
    """
    names = df.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(names.index(c)).to_numpy() for c in cols])
            new = np.ones(b.num_rows, bool)
            new[1:] = (key[:, 1:] != key[:, :-1]).any(0)
            new[0] = last is None or bool((key[:, 0] != last).any())
            k = n + np.cumsum(new, dtype=np.int64)
            last, n = key[:, -1], int(k[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(k)], names=[*names, "_part", "_k"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    numbered = written(df.repartitionByRange(*cols, *ties).sortWithinPartitions(*cols).mapInArrow(number, f"{fields}, _part int, _k bigint"))
    ends = numbered.groupBy("_part").agg(F.min(F.struct(*cols)).alias("a"), F.max(F.struct(*cols)).alias("z"), F.max("_k").alias("n"))
    order = Window.orderBy("_part")
    joined = F.coalesce((F.col("a") == F.lag("z").over(order)).cast("long"), F.lit(0))
    ends = ends.withColumn("_own", F.col("n") - joined).withColumn("_before", F.sum("_own").over(order) - F.col("n"))
    return numbered.join(F.broadcast(ends.select("_part", "_before")), "_part").select(*names, (F.col("_before") + F.col("_k")).alias(out))


def document_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, copy, no, pos, h1, h2): the lines with a word, by place among such lines and among all; h1 and h2 are 128 bits
    of hash of the line without outer space; copy is a hash of the text, which tells rows with one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            n, pos, hashes = [], [], []
            for t in b.column(2):
                bare = [line.strip(_BLANK) for line in t.as_py().encode().split(b"\n")]
                own = [i for i, line in enumerate(bare) if line]
                n.append(len(own))
                pos += own
                hashes += [digest(bare[i]) for i in own]
            size = np.array(n, np.int64)
            row = np.repeat(np.arange(len(n)), size)
            no = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            at = pa.array(row)
            cols = [b.column(0).take(at), b.column(1).take(at), pa.array(no.astype(np.int32)), pa.array(np.array(pos, np.int32)), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "copy", "no", "pos", "h1", "h2"])

    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text")).filter("doc_id is not null and text is not null")
    return own.mapInArrow(run, f"doc_id {kind}, copy bigint, no int, pos int, h1 bigint, h2 bigint")


def repeated_sequences(lines: DataFrame) -> DataFrame:
    """(doc_id, copy, ids, pos): for each document the longest stretches of lines that all occur twice or more, as line
    numbers (from 1) and places. Rows that are alike in id and text count as one document here."""
    often = written(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    ids = written(dense_ranks(often, ["h1", "h2"], "id", []))
    total = ids.agg(F.sum("n")).first()[0] or 0
    kept = join_counted(lines, ids, ["h1", "h2"], "n", total)
    whole = kept.groupBy("doc_id", "copy").agg(F.array_sort(F.collect_set(F.struct("no", "pos", "id"))).alias("own"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(2)
            flat = own.flatten()
            no, pos, ids = (flat.field(k).to_numpy() for k in range(3))
            size = np.diff(own.offsets.to_numpy())
            row = np.repeat(np.arange(b.num_rows), size)
            start = np.ones(len(no), bool)
            start[1:] = (row[1:] != row[:-1]) | (no[1:] != no[:-1] + 1)
            first = np.flatnonzero(start)
            offsets = pa.array(np.append(first, len(no)).astype(np.int32))
            at = pa.array(row[first])
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(pos))], names=["doc_id", "copy", "ids", "pos"])

    kind = lines.schema["doc_id"].dataType.simpleString()
    out = written(whole.mapInArrow(cut, f"doc_id {kind}, copy bigint, ids array<bigint>, pos array<int>"))
    discard(often)
    return out


def suffix_array(sequences: DataFrame) -> tuple[DataFrame, list[str]]:
    """(sid, at, left, i0.., r..) for every suffix of sequences (sid, ids), and the names of the rank columns.

    left: lines from here to the end; i0..: the first FIRST line ids, 0 past the end; a column r a step: the rank of the
    prefix of FIRST, 2 FIRST, 4 FIRST.. lines, of which the last is that of the whole suffix. Equal suffixes have one rank.
    """
    seen = [f"i{k}" for k in range(FIRST)]
    ahead = lambda i: [F.coalesce(F.get("ids", i + k), F.lit(0)).alias(c) for k, c in enumerate(seen)]
    rows = sequences.select("sid", F.explode(F.transform("ids", lambda _, i: F.struct(i.alias("at"), (F.size("ids") - i).alias("left"), *ahead(i)))).alias("s")).select("sid", "s.*")
    state = written(dense_ranks(rows, seen, "r0", ["sid", "at"]))
    longest, count = state.agg(F.max("left"), F.max("r0")).first()
    ranks, reach = ["r0"], FIRST
    while reach < (longest or 0):
        now, then = ranks[-1], f"r{len(ranks)}"
        further = F.coalesce(F.lead(now, reach).over(Window.partitionBy("sid").orderBy("at")), F.lit(0))
        before, state = state, written(dense_ranks(state.withColumn("_ahead", further), [now, "_ahead"], then, ["sid", "at"]).drop("_ahead"))
        discard(before)
        ranks, reach = [*ranks, then], 2 * reach
        before, count = count, state.agg(F.max(then)).first()[0]
        if count == before:  # what no step tells apart, no further one does
            break
    return state, ranks


def common_prefixes(state: DataFrame, ranks: list[str]) -> DataFrame:
    """(rank, size, sid, at, lcp) for every different suffix, in order: how many suffixes are equal to it, the first of them,
    and how many lines it shares with the next one in the order (0 for the last).

    A step takes the longest prefix that the ranks show to be equal and goes on behind it; what FIRST line ids show ends it.
    """
    final, seen = ranks[-1], [f"i{k}" for k in range(FIRST)]
    told = F.struct(*seen, *ranks)
    groups = written(state.groupBy(F.col(final).alias("rank")).agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("sid", "at", told.alias("t"))).alias("f")))
    one = groups.select("rank", F.col("f.sid").alias("s1"), F.col("f.at").alias("a1"), F.col("f.t").alias("x"))
    two = groups.select((F.col("rank") - 1).alias("rank"), F.col("f.sid").alias("s2"), F.col("f.at").alias("a2"), F.col("f.t").alias("y"))
    pairs = one.join(two, "rank").withColumn("lcp", F.lit(0))

    def shared(k: int) -> F.Column:
        same = F.col(f"x.{seen[k]}") == F.col(f"y.{seen[k]}")
        return F.when(same & (F.col(f"x.{seen[k]}") > 0), F.lit(1) + (shared(k + 1) if k + 1 < FIRST else F.lit(0))).otherwise(F.lit(0))

    step, more = shared(0), F.lit(False)
    for k, r in enumerate(ranks):
        equal = F.col(f"x.{r}") == F.col(f"y.{r}")
        step, more = F.when(equal, F.lit(FIRST << k)).otherwise(step), more | equal
    places = state.select("sid", "at", told.alias("t"))
    done, parts = [], []
    for _ in range(len(ranks) + 1):
        pairs = pairs.select("rank", "s1", "a1", "s2", "a2", (F.col("lcp") + F.coalesce(step, F.lit(0))).alias("lcp"), F.coalesce(more, F.lit(False)).alias("more"))
        pairs = written(pairs)
        parts.append(pairs)
        done.append(pairs.filter("not more").select("rank", "lcp"))
        pairs = pairs.filter("more").drop("more")
        if pairs.isEmpty():
            break
        x = places.select(F.col("sid").alias("s1"), F.col("at").alias("_p1"), F.col("t").alias("x"))
        y = places.select(F.col("sid").alias("s2"), F.col("at").alias("_p2"), F.col("t").alias("y"))
        pairs = pairs.withColumn("_p1", F.col("a1") + F.col("lcp")).withColumn("_p2", F.col("a2") + F.col("lcp"))
        pairs = pairs.join(x, ["s1", "_p1"], "left").join(y, ["s2", "_p2"], "left")
    lengths = done[0]
    for d in done[1:]:
        lengths = lengths.unionByName(d)
    out = groups.join(lengths, "rank", "left").select("rank", "size", F.col("f.sid").alias("sid"), F.col("f.at").alias("at"), F.coalesce("lcp", F.lit(0)).alias("lcp"))
    out = written(out)
    for p in [groups, *parts]:
        discard(p)
    return out


def prefix_intervals(chain: DataFrame, least: int) -> DataFrame:
    """chain with before (lines shared with the suffix before) and interval: a number of the longest-common-prefix interval of
    least or more shared lines that the suffix lies in. Counted within buckets of the order and over them."""
    after = chain.select((F.col("rank") + 1).alias("rank"), F.col("lcp").alias("before"))
    rows = written(chain.join(after, "rank", "left").withColumn("before", F.coalesce("before", F.lit(0))).withColumn("_b", F.shiftright("rank", BUCKET)))
    cut = (F.col("before") < least).cast("long")
    sums = rows.groupBy("_b").agg(F.sum(cut).alias("_n"))
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.sum(cut).over(Window.partitionBy("_b").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_k", inside).join(F.broadcast(starts), "_b").withColumn("interval", F.col("_start") + F.col("_k")).drop("_b", "_k", "_start")


def repeated_runs(sequences: DataFrame, least_lines: int) -> DataFrame:
    """(sid, at, left, run, later) for every line of sequences (sid, ids, n: how often the sequence occurs).

    run: lines of the longest run from here that occurs elsewhere too; later: whether the run of least_lines lines from here
    began at a smaller (sid, at) too, which is what its longest-common-prefix interval says.
    """
    state, ranks = suffix_array(sequences)
    chain = written(prefix_intervals(common_prefixes(state, ranks), least_lines))
    firsts = chain.groupBy("interval").agg(F.min(F.struct("sid", "at")).alias("first"), F.count(F.lit(1)).alias("_m"))
    firsts = written(firsts)
    count = chain.count()
    placed = join_counted(chain.select("rank", "size", "lcp", "before", "interval"), firsts, ["interval"], "_m", count)
    placed = written(placed.select("rank", F.col("size").alias("_n"), F.col("size").alias("same"), F.greatest("lcp", "before").alias("lcp"), "first"))
    total = state.count()
    rows = join_counted(state.select("sid", "at", "left", F.col(ranks[-1]).alias("rank")), placed, ["rank"], "_n", total)
    run = F.when(F.col("same") > 1, F.col("left")).otherwise(F.col("lcp"))
    later = (F.col("left") >= least_lines) & (F.struct("sid", "at") > F.col("first"))
    out = written(rows.select("sid", "at", "left", run.alias("run"), later.alias("later")))
    for x in (state, chain, firsts, placed):
        discard(x)
    return out


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, least_lines: int = 1) -> tuple[DataFrame, DataFrame]:
    """The documents without later copies of repeated runs, and the repeated runs.

    First: doc_id, n_lines, n_removed, longest_run, n_runs and clean_text for every row of docs. A line is a line with a
    word, without outer space. A repeated run is a sequence of least_lines or more such lines (lines without words between
    them don't count) that occurs twice or more; its first occurrence, by doc_id and then by place, stays, and every line of
    the later ones is deleted, even where they overlap the first. longest_run: lines of the longest run of the document
    that occurs elsewhere (or elsewhere in it); n_runs: its runs of least_lines or more that can't be made longer at the
    left. Lines without words are kept. Null texts stay null with no lines; rows with a null doc_id or a null text lose
    nothing. Rows that are alike in doc_id and text are one document here and lose the same lines; rows with one doc_id and
    different texts are different documents, in an order of their own. An empty table gives no rows; other columns are ignored.
    Second: (doc_id, copy, pos, run, copies): where the maximal runs start, how many lines they have, and how many copies of
    the whole sequence around there are.
    """
    lines = written(document_lines(docs, doc_id, text))
    occurrences = repeated_sequences(lines)
    different = occurrences.groupBy("ids").agg(F.min(F.struct("doc_id", "copy", F.get("pos", F.lit(0)).alias("start"))).alias("f"), F.count(F.lit(1)).alias("n"))
    ordered = different.repartitionByRange("f.doc_id", "f.copy", "f.start").sortWithinPartitions("f.doc_id", "f.copy", "f.start")
    sequences = written(ordered.select(F.monotonically_increasing_id().alias("sid"), "ids", "n", "f"))
    runs = repeated_runs(sequences.select("sid", "ids", "n"), least_lines)
    # what a sequence tells of its documents: the copies after the first lose all lines, the first what its intervals say
    window = Window.partitionBy("sid").orderBy("at")
    counted = runs.join(sequences.select("sid", "n"), "sid").withColumn("run", F.when(F.col("n") > 1, F.col("left")).otherwise(F.col("run")))
    counted = counted.withColumn("maximal", (F.col("run") >= least_lines) & F.coalesce(F.lag("run").over(window) <= F.col("run"), F.lit(True)))
    of_seq = counted.groupBy("sid").agg(
        F.max("run").alias("longest"), F.count_if("maximal").alias("n_runs"), F.array_sort(F.collect_list(F.when(F.col("later"), F.col("at")))).alias("gone"), F.array_sort(F.collect_list(F.when(F.col("maximal"), F.struct("at", "run")))).alias("runs")
    )
    told = written(sequences.join(of_seq, "sid").select("ids", F.col("n").alias("copies"), "n", "f", "longest", "n_runs", "gone", "runs"))
    total = told.agg(F.sum("n")).first()[0] or 0
    placed = written(join_counted(occurrences, told, ["ids"], "n", total))
    first = (F.col("doc_id") == F.col("f.doc_id")) & (F.col("copy") == F.col("f.copy")) & (F.get("pos", F.lit(0)) == F.col("f.start"))
    every = F.when(F.size("pos") >= least_lines, F.col("pos")).otherwise(F.array().cast("array<int>"))
    reach = F.flatten(F.transform("gone", lambda a: F.slice("pos", a + 1, F.lit(least_lines))))
    marks = placed.withColumn("cut", F.when(first, reach).otherwise(every))
    marks = marks.groupBy("doc_id", "copy").agg(F.max("longest").alias("longest"), F.sum("n_runs").alias("n_runs"), F.array_distinct(F.flatten(F.collect_list("cut"))).alias("cut"))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text")).join(marks, ["doc_id", "copy"], "left")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, lost, kept = [], [], []
            for t, cut in zip(b.column(1), b.column(2), strict=True):
                whole = t.as_py()
                if whole is None:
                    n.append(0), lost.append(0), kept.append(None)
                    continue
                lines, gone = whole.encode().split(b"\n"), set(cut.as_py() or ())
                n.append(sum(1 for x in lines if x.strip(_BLANK)))
                lost.append(len(gone))
                kept.append(b"\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else whole.encode())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), b.column(3), b.column(4), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_lines", "n_removed", "longest_run", "n_runs", "clean_text"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = own.select("doc_id", "text", "cut", F.coalesce("longest", F.lit(0)).cast("long").alias("longest_run"), F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"))
    out = rows.mapInArrow(clean, f"doc_id {kind}, n_lines bigint, n_removed bigint, longest_run bigint, n_runs bigint, clean_text string")
    starts = placed.select("doc_id", "copy", "pos", "copies", F.explode("runs").alias("r"))
    return out, starts.select("doc_id", "copy", F.get("pos", F.col("r.at")).alias("pos"), F.col("r.run").alias("run"), "copies")
