"""Substring dedup with suffix automata: word runs that occur elsewhere are removed.

A window is `window` consecutive words. Its anchor is the leftmost of its `GRAM`-word
runs with the least hash, so equal windows have equal anchors at the same place. Windows
of one document that share an anchor form a region; every window of the corpus is in
exactly one region, and equal windows are in regions of the same anchor hash. That hash
is the shard: only anchors that occur twice are kept, equal regions of an anchor are
merged and counted (a region with a copy is repeated as a whole), and the distinct
regions of an anchor are the shard's reference. Their suffix automaton goes to the one
task that holds the shard, and the regions without a copy are streamed through it;
matching statistics of at least `window` words shared by two regions give the maximal
spans to remove. The corpus is its own reference, whose size has no bound, so automata
are not broadcast to all tasks but built where their shard is.

An anchor with more than `WIDE` distinct regions (a common line in many contexts) is
split by window: windows are then regions of their own, and merging equal ones decides.
The result does not depend on `WIDE`.

Defined results: words are split at white space; a null or short text has no window and
keeps all its words; repeated rows are occurrences of their own; rows with equal id and
text get the same spans; a null id is an id like any other.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm import arrays
from paperloom.llm.automaton import SuffixAutomaton
from paperloom.llm.runtime import free_names, ship, written

GRAM, WIDE = 12, 200
OWNER = ["owner_id", "owner_text"]
REGION_DDL = "owner_id long, owner_text long, lows array<int>, windows int, anchor long, region long"


def _least_of(values, width):
    """Minimum of each run of `width` values, by doubling."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    if width > have:
        values = np.minimum(values[: len(values) - (width - have)], values[width - have :])
    return values


def regions(chunk, window):
    """(row, first window, number of windows, anchor hash, region hash) of each region."""
    found = arrays.words(chunk)
    starts = arrays.runs(found, window)
    empty = np.zeros(0, np.int64)
    if not len(starts):
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    hashes = arrays.FIRST.of_bytes(chunk.data, found.starts, found.ends)
    at = np.arange(len(hashes) - GRAM + 1)
    grams = arrays.FIRST.of_runs(hashes, at, at + GRAM)
    ranked = (grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    least = _least_of(ranked, window - GRAM + 1)[starts]
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    opens = np.ones(len(starts), bool)
    opens[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(opens)
    size = np.diff(np.append(first, len(starts)))
    low = starts[first]
    content = arrays.SECOND.of_runs(hashes, low, low + size + window - 1)
    row = found.row[low]
    return row, low - found.first[row], size, grams[anchor[first]], content


def _regions(window):
    def run(batches):
        for batch in batches:
            for chunk in arrays.chunks(batch.column(2)):
                row, low, size, anchor, content = regions(chunk, window)
                # Equal regions of one text, as in periodic runs, become one row.
                order = np.lexsort((low, content, anchor, row))
                row, low, size, anchor, content = (c[order] for c in (row, low, size, anchor, content))
                fresh = np.ones(len(row), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
                first = np.flatnonzero(fresh)
                bounds = np.append(first, len(row)).astype(np.int32)
                take = pa.array(row[first] + chunk.first_row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.ListArray.from_arrays(bounds, low.astype(np.int32)),
                        pa.array(size[first], pa.int32()),
                        pa.array(arrays.signed(anchor[first])),
                        pa.array(arrays.signed(content[first])),
                    ],
                    names=[*OWNER, "lows", "windows", "anchor", "region"],
                )

    return run


PIECE_DDL = (
    "owner_id long, owner_text long, low int, windows int, anchor long, copies long, words binary, w1 long, w2 long"
)
PIECE_SCHEMA = pa.schema(
    [
        *[(c, pa.int64()) for c in OWNER],
        ("low", pa.int32()),
        ("windows", pa.int32()),
        ("anchor", pa.int64()),
        ("copies", pa.int64()),
        ("words", pa.binary()),
        ("w1", pa.int64()),
        ("w2", pa.int64()),
    ]
)


def _pieces(window):
    """The words of the asked regions, or the hashes of their windows where the anchor is wide."""

    def run(batches):
        for batch in batches:
            asked = batch.column(3)
            out = []
            for row in range(batch.num_rows):
                owner = (batch.column(0)[row].as_py(), batch.column(1)[row].as_py())
                text = (batch.column(2)[row].as_py() or "").encode()
                tokens, hashes = text.split(), None
                for ask in asked[row].as_py():
                    low, size = ask["low"], ask["windows"]
                    same = (ask["anchor"], ask["copies"])
                    if not ask["wide"]:
                        content = b" ".join(tokens[low : low + size + window - 1])
                        out.append((*owner, low, size, *same, content, None, None))
                        continue
                    if hashes is None:
                        chunk = arrays.Chunk(0, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
                        found = arrays.words(chunk)
                        hashes = arrays.FIRST.of_bytes(chunk.data, found.starts, found.ends)
                    at = np.arange(low, low + size)
                    w1 = arrays.signed(arrays.FIRST.of_runs(hashes, at, at + window))
                    w2 = arrays.signed(arrays.SECOND.of_runs(hashes, at, at + window))
                    out.extend((*owner, int(a), 1, *same, None, int(x), int(y)) for a, x, y in zip(at, w1, w2))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_pylist([dict(zip(PIECE_SCHEMA.names, r)) for r in out], PIECE_SCHEMA)
                    out = []
            yield pa.RecordBatch.from_pylist([dict(zip(PIECE_SCHEMA.names, r)) for r in out], PIECE_SCHEMA)

    return run


SPAN_DDL = "owner_id long, owner_text long, low int, windows int"


def _matched(window):
    """Over pieces sorted by anchor: the spans of regions without a copy that others share."""

    def spans_of(shard):
        automaton = SuffixAutomaton(window)
        sequences = [piece[5].split() for piece in shard]
        for words in sequences:
            automaton.add(words)
        for piece, words in zip(shard, sequences):
            if piece[4] > 1:
                continue  # whole regions with copies are known already
            hits = [k - window + 1 for k, size in enumerate(automaton.matching_statistics(words, 2)) if size]
            begin = 0
            for k in range(1, len(hits) + 1):
                if k == len(hits) or hits[k] != hits[k - 1] + 1:
                    yield piece[0], piece[1], piece[2] + hits[begin], k - begin
                    begin = k

    def run(batches):
        shard, current, out = [], None, []
        for batch in batches:
            for piece in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 6)]):
                if piece[3] != current:
                    out.extend(spans_of(shard))
                    shard, current = [], piece[3]
                shard.append(piece)
            yield _span_batch(out)
            out = []
        out.extend(spans_of(shard))
        yield _span_batch(out)

    return run


def _span_batch(rows):
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*OWNER, "low", "windows"]
    )


def _keyed(docs, id_column, text_column):
    return docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("owner_id"),
        F.xxhash64(text_column).alias("owner_text"),
        F.col(text_column).cast("string").alias("text"),
    )


def repeated_windows(docs, window=35, id_column="doc_id", text_column="text", wide=WIDE):
    """(owner_id, owner_text, spans): runs of repeated windows as structs (lows, windows).

    A span covers the words from each `low` to `low + windows + window - 2`.
    """
    if window <= GRAM:
        raise ValueError(f"A window needs more than {GRAM} words")
    ship(docs.sparkSession)
    source = _keyed(docs, id_column, text_column)
    every = written(source.mapInArrow(_regions(window), REGION_DDL))
    # Written, so that Spark can split the rows of a hot anchor in the join that follows.
    twice = written(
        every.groupBy("anchor")
        .agg(F.sum(F.size("lows")).alias("n"), F.min("region").alias("least"), F.max("region").alias("most"))
        .where("n > 1")
        .select("anchor", (F.col("least") == F.col("most")).alias("alike"))
    )
    repeated = written(every.join(twice, "anchor"))
    # Where all regions of an anchor are equal, each of them has a copy.
    copies = repeated.where("alike").select(*OWNER, "lows", "windows")
    left = repeated.where("not alike")
    distinct = left.groupBy("anchor", "region").agg(
        F.sum(F.size("lows")).alias("copies"),
        F.min(F.struct(*OWNER, F.col("lows")[0].alias("low"), "windows")).alias("own"),
    )
    shards = distinct.groupBy("anchor").agg(
        F.count("*").alias("regions"), F.sum((F.col("copies") == 1).cast("long")).alias("alone")
    )
    asked = written(distinct.join(shards, "anchor"))
    whole = left.join(asked.where("copies > 1").select("anchor", "region"), ["anchor", "region"]).select(
        *OWNER, "lows", "windows"
    )
    open_regions = asked.where("alone > 0 and regions > 1").select(
        "own.*", "anchor", "copies", (F.col("regions") > wide).alias("wide")
    )
    by_owner = open_regions.groupBy(*OWNER).agg(
        F.collect_list(F.struct("low", "windows", "anchor", "copies", "wide")).alias("asked")
    )
    texts = source.join(by_owner, OWNER).dropDuplicates(OWNER).select(*OWNER, "text", "asked")
    pieces = written(texts.mapInArrow(_pieces(window), PIECE_DDL))
    narrow = (
        pieces.where("words is not null")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_matched(window), SPAN_DDL)
    )
    split = pieces.where("words is null")
    again = split.groupBy("anchor", "w1", "w2").agg(F.sum("copies").alias("n")).where("n > 1").drop("n")
    by_window = split.where("copies = 1").join(again, ["anchor", "w1", "w2"], "left_semi").select(*OWNER, "low", "windows")
    found = narrow.union(by_window).select(*OWNER, F.array("low").alias("lows"), "windows")
    return (
        copies.union(whole).union(found).groupBy(*OWNER).agg(F.collect_list(F.struct("lows", "windows")).alias("spans"))
    )


def with_spans(docs, spans, id_column="doc_id", text_column="text"):
    """The documents, all their columns, and their spans (null: none) last."""
    own_id, own_text, kept = free_names(docs, "_pl_id", "_pl_text", "_pl_spans")
    keyed = docs.withColumns(
        {own_id: F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))), own_text: F.xxhash64(text_column)}
    )
    right = spans.select(
        F.col("owner_id").alias(own_id), F.col("owner_text").alias(own_text), F.col("spans").alias(kept)
    )
    return keyed.join(right, [own_id, own_text], "left").drop(own_id, own_text)


def covered(spans, n_words, window):
    """Which words the spans cover."""
    change = np.zeros(n_words + 1, np.int64)
    for span in spans or ():
        lows = np.asarray(span["lows"])
        np.add.at(change, lows, 1)
        np.add.at(change, lows + (span["windows"] + window - 1), -1)
    return np.cumsum(change[:-1]) > 0


def without_repeats(docs, window=35, id_column="doc_id", text_column="text"):
    """The documents with the spans cut out of their text; other columns as they are.

    The text between spans keeps its white space; texts without spans stay as they are.
    """
    marked = with_spans(docs, repeated_windows(docs, window, id_column, text_column), id_column, text_column)
    where, names = docs.columns.index(text_column), docs.columns

    def cut(text, spans):
        raw = text.encode()
        chunk = arrays.Chunk(0, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        found = arrays.words(chunk)
        gone = covered(spans, len(found.starts), window)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        parts, at = [], 0
        for low, high in zip(edges[::2], edges[1::2]):
            parts.append(raw[at : found.starts[low]])
            at = found.ends[high - 1]
        return b"".join([*parts, raw[at:]]).decode()

    def run(batches):
        for batch in batches:
            texts, spans = batch.column(where), batch.column(batch.num_columns - 1)
            new = [t.as_py() if not s.is_valid else cut(t.as_py(), s.as_py()) for t, s in zip(texts, spans)]
            columns = batch.columns[:-1]
            columns[where] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return marked.mapInArrow(run, docs.schema)
