"""Byte-level BPE encoding and decoding with recursive DuckDB queries in each partition.

A text is split by the vocabulary's pattern. The distinct pieces of a part of a partition
become rows (word, seat, token), one for each byte. A recursive query joins neighbouring
tokens with the merge table, picks each word's leftmost pair of least rank, contracts it
and goes on until no word has a pair; a word's rows of its last round are its tokens. A
piece that is a token itself is that token, as in the tiktoken library. Decoding joins
(word, seat, token) rows with the vocabulary and aggregates the bytes in order of seats.

A task keeps the pieces it has seen, `KNOWN` at most before it starts anew, so a word is
contracted once and not at each place. A piece of more than `LONG` bytes would need as
many rounds as it has bytes; such pieces are contracted with a heap by the same rule.

Defined results: a null or empty text has no tokens and decodes to nothing; control
strings are ordinary text; repeated rows are encoded alike; an empty table gives an empty
table.
"""

import base64
import hashlib
import heapq

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from paperloom.llm.runtime import ship

KNOWN, LONG, BLOCK, CHUNK = 1_200_000, 1024, 60_000, 2 << 20

_ENCODE = """
WITH RECURSIVE walk(word, seat, token, round) AS (
    SELECT word, seat, token, 0 FROM bytes_in
    UNION ALL
    SELECT w.word,
           w.seat - CASE WHEN w.seat > least % 65536 THEN 1 ELSE 0 END,
           CASE WHEN w.seat = least % 65536 THEN CAST(least // 65536 AS INTEGER) ELSE w.token END,
           w.round + 1
    FROM walk w
    JOIN (
        SELECT a.word, min(CAST(m.rank AS BIGINT) * 65536 + a.seat) AS least
        FROM walk a
        JOIN walk b ON a.word = b.word AND a.seat + 1 = b.seat
        JOIN merges m ON m.first = a.token AND m.second = b.token
        GROUP BY a.word
    ) USING (word)
    WHERE w.seat <> least % 65536 + 1
)
SELECT w.word, w.seat, w.token
FROM walk w JOIN (SELECT word, max(round) AS round FROM walk GROUP BY word) USING (word, round)
ORDER BY w.word, w.seat
"""
_DECODE = """
SELECT word, string_agg(hex, '' ORDER BY seat) AS hex
FROM tokens_in JOIN vocabulary USING (token) GROUP BY word ORDER BY word
"""


def read_ranks(path):
    """Tokens by rank from a file with lines of base64 bytes and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Codec:
    """One vocabulary in a process: its tables and the pieces known so far."""

    def __init__(self, ranks, pattern):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        rows = [
            (ranks[token[:cut]], ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        first, second, rank = (pa.array(c, pa.int32()) for c in zip(*rows))
        merges = pa.table({"first": first, "second": second, "rank": rank})  # noqa: F841
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges")
        vocabulary = pa.table(  # noqa: F841
            {"token": pa.array(list(ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in ranks])}
        )
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")
        self.forget()

    def forget(self):
        """number of each piece; by number: its ids as text, their count, its bytes decoded."""
        self.number, self.ids, self.sizes, self.decoded = {}, [], [], []

    def _table(self, name, word, seat, token):
        table = pa.table({"word": word, "seat": seat, "token": token})
        self.con.register(name, table)

    def contracted(self, words):
        """(word, token) arrays, in order, of byte strings."""
        whole = [(k, self.ranks.get(w)) for k, w in enumerate(words)]
        known = {k: [rank] for k, rank in whole if rank is not None}
        known |= {k: self._by_heap(w) for k, w in enumerate(words) if len(w) > LONG and k not in known}
        rest = np.array([k for k in range(len(words)) if k not in known], np.int32)
        word, token = np.zeros(0, np.int32), np.zeros(0, np.int32)
        if len(rest):
            size = np.array([len(words[k]) for k in rest])
            data = np.frombuffer(b"".join(words[k] for k in rest), np.uint8)
            seat = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
            self._table("bytes_in", np.repeat(rest, size), seat.astype(np.int32), self.single[data])
            found = self.con.execute(_ENCODE).fetchnumpy()
            word, token = np.asarray(found["word"]), np.asarray(found["token"])
        if known:
            word = np.concatenate([word, np.repeat(list(known), [len(v) for v in known.values()])])
            token = np.concatenate([token, np.concatenate([np.asarray(v) for v in known.values()])])
            order = np.argsort(word, kind="stable")
            word, token = word[order], token[order]
        return word, token

    def _by_heap(self, word):
        tokens = [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap = []

        def offer(at):
            if 0 <= at and after[at] < len(word):
                rank = self.ranks.get(tokens[at] + tokens[after[at]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at))

        for at in range(len(word) - 1):
            offer(at)
        while heap:
            rank, at = heapq.heappop(heap)
            if tokens[at] is None or after[at] >= len(word):
                continue
            if self.ranks.get(tokens[at] + tokens[after[at]]) != rank:
                continue
            gone = after[at]
            tokens[at] += tokens[gone]
            tokens[gone] = None
            after[at] = after[gone]
            if after[at] < len(word):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [self.ranks[token] for token in tokens if token is not None]

    def expanded(self, word, token):
        """The bytes of each word that has tokens, in order of words; words count from 0."""
        opens = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        seat = np.arange(len(word)) - np.repeat(opens, np.diff(np.append(opens, len(word))))
        self._table("tokens_in", word.astype(np.int32), seat.astype(np.int32), token.astype(np.int32))
        found = self.con.execute(_DECODE).fetchall()
        return {number: bytes.fromhex(text) for number, text in found}

    def learn(self, pieces):
        """Encode and decode pieces that are not known yet."""
        for start in range(0, len(pieces), BLOCK):
            block = pieces[start : start + BLOCK]
            word, token = self.contracted([piece.encode() for piece in block])
            decoded = self.expanded(word, token)
            bounds = np.searchsorted(word, np.arange(len(block) + 1))
            text = token.astype(str).tolist()
            for k, piece in enumerate(block):
                self.number[piece] = len(self.ids)
                self.ids.append(",".join(text[bounds[k] : bounds[k + 1]]))
                self.sizes.append(int(bounds[k + 1] - bounds[k]))
                self.decoded.append(decoded[k])

    def encoded(self, texts):
        """For each text the numbers of its pieces."""
        split = [self.split(text) for text in texts]
        new = {piece for pieces in split for piece in pieces if piece not in self.number}
        if new and len(self.number) + len(new) > KNOWN:
            self.forget()
            new = {piece for pieces in split for piece in pieces}
        self.learn(sorted(new))
        number = self.number
        return [[number[piece] for piece in pieces] for pieces in split]


_codecs = {}


def codec(ranks, pattern, name):
    """The process keeps one codec for each vocabulary."""
    if name not in _codecs:
        _codecs[name] = Codec(ranks, pattern)
    return _codecs[name]


def _texts(column):
    """Lists of consecutive texts of about CHUNK characters."""
    part, size = [], 0
    for value in column:
        part.append(value.as_py() or "")
        size += len(part[-1])
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def _applied(docs, path, pattern, columns, ddl, id_column, text_column):
    spark = docs.sparkSession
    ship(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(path))  # one vocabulary, below a megabyte
    name = hashlib.sha256(f"{path}\0{pattern}\0{len(ranks.value)}".encode()).hexdigest()

    def run(batches):
        known = codec(ranks.value, pattern, name)
        for batch in batches:
            at = 0
            for texts in _texts(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts))
                at += len(texts)
                numbers = known.encoded(texts)
                made = [pa.array(c, k) for c, k in columns(known, numbers)]
                yield pa.RecordBatch.from_arrays([ids, *made], names=names)

    names = [part.split()[0] for part in ddl.split(", ")]
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string"))
    return source.mapInArrow(run, ddl)


def encode(docs, path, pattern, id_column="doc_id", text_column="text"):
    """(doc_id, ids) with the token ids of every text."""

    def columns(known, numbers):
        lists = [[int(i) for n in row for i in known.ids[n].split(",")] for row in numbers]
        return [(lists, pa.list_(pa.int32()))]

    return _applied(docs, path, pattern, columns, "doc_id long, ids array<int>", id_column, text_column)


def decode(encoded, path, pattern):
    """(doc_id, data) from (doc_id, ids)."""
    spark = encoded.sparkSession
    ship(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(path))
    name = hashlib.sha256(f"{path}\0{pattern}\0{len(ranks.value)}".encode()).hexdigest()

    def run(batches):
        known = codec(ranks.value, pattern, name)
        for batch in batches:
            lists = [row.as_py() or [] for row in batch.column(1)]
            word = np.repeat(np.arange(len(lists)), [len(row) for row in lists])
            found = known.expanded(word, np.array([i for row in lists for i in row], np.int32)) if len(word) else {}
            data = pa.array([found.get(k, b"") for k in range(len(lists))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), data], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs, path, pattern, id_column="doc_id", text_column="text"):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text."""

    def columns(known, numbers):
        ids, decoded, sizes = known.ids, known.decoded, known.sizes
        return [
            ([sum([sizes[n] for n in row]) for row in numbers], pa.int64()),
            ([hashlib.sha256(",".join([ids[n] for n in row]).encode()).hexdigest() for row in numbers], pa.string()),
            ([hashlib.sha256(b"".join([decoded[n] for n in row])).hexdigest() for row in numbers], pa.string()),
        ]

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _applied(docs, path, pattern, columns, ddl, id_column, text_column)
